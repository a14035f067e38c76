"""SentencePiece encoding of merge-type vocabularies by a score-ordered agenda.

A text starts as its characters. The agenda holds every adjacent pair of
symbols whose join is a piece; the pair of highest score (leftmost among
equals) is joined, and the two pairs the new symbol makes enter the agenda.
When no pair is left, a symbol that is no piece is spelled in byte pieces.

A merge never crosses two characters that stand together in no piece, so a
text may be cut there and every part has an agenda of its own: words at their
spaces, and words of great length wherever they can be cut. Words already seen
are remembered in a table of bounded size; new words are merged together, each
with an agenda of its own in one row of a matrix. Neither the cuts nor the
table nor the rows change a result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import prepare

SPACE = "▁"
#: Words in each of the two halves of the table of words seen.
REMEMBERED = 1_000_000
#: Characters up to which a word is remembered, and its agenda is a list
#: searched for its best pair; longer parts have heaps.
SHORT = 48
#: Characters of new words merged together, and of texts looked at together.
MATRIX_CELLS, STEP_CHARS = 1 << 18, 1 << 20
#: Numbers of characters in no piece, in the matrix.
STRANGE = 1 << 24


class Remembered(dict):
    """Results by word, worked out at first sight. A full table becomes the
    older half, out of which words that come again are taken over."""

    def __init__(self, work):
        super().__init__()
        self.work, self.older = work, {}

    def __missing__(self, word: str) -> str:
        found = self.older.get(word) or self.work(word)
        if len(word) <= SHORT:
            self.note(word, found)
        return found

    def note(self, word: str, found: str) -> None:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = found


class Spelled(dict):
    """Decimal ids by number of a symbol; those of characters in no piece
    (``STRANGE`` and the code point) are worked out at first sight."""

    def __init__(self, decimal: list[str], ids):
        super().__init__(enumerate(decimal))
        self.ids = ids

    def __missing__(self, number: int) -> str:
        found = self[number] = ",".join(map(str, self.ids(chr(number - STRANGE))))
        return found


class AgendaEncoder:
    """Encoder over the pieces and scores of one model file.

    Raises ValueError for a model that is not merge-type or that defines
    symbols of its own, which the agenda does not split off."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        kinds = model.SentencePiece
        if model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError(f"{model_path}: not a merge-type vocabulary")
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError(f"{model_path}: user-defined symbols are not supported")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{model_path}: spaces as suffixes are not supported")
        rule = model.normalizer_spec
        self.plain = not rule.precompiled_charsmap and not rule.remove_extra_whitespaces and rule.escape_whitespaces
        self.prefix = SPACE if rule.add_dummy_prefix else ""
        self.pieces, self.unused, self.byte_ids, self.unknown = {}, set(), {}, 0
        for number, p in enumerate(model.pieces):
            if p.type in (kinds.NORMAL, kinds.UNUSED):
                self.pieces[p.piece] = (p.score, number)
                if p.type == kinds.UNUSED:
                    self.unused.add(p.piece)
            elif p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = number
            elif p.type == kinds.UNKNOWN:
                self.unknown = number
        if not model.trainer_spec.byte_fallback:
            self.byte_ids = {}
        self.joins = {a + b for piece in self.pieces for a, b in zip(piece, piece[1:], strict=False)}
        # where no piece goes on with a space after another character, words
        # with the spaces before them are parts
        apart = not any(j[1] == SPACE and j[0] != SPACE for j in self.joins)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s:.+)").findall
        self.spaced = apart and self.plain and self.prefix == SPACE
        self._word = Remembered(self._encode_word)
        # Symbols as numbers: a piece's id; characters in pieces that are no pieces come after
        order = {score: place for place, score in enumerate(sorted({s for s, _ in self.pieces.values()}, reverse=True))}
        self.last = len(order)
        self.number = {c: found[1] for c in {c for p in self.pieces for c in p} if (found := self.pieces.get(c))}
        others = sorted({c for p in self.pieces for c in p} - set(self.number))
        self.number.update({c: len(model.pieces) + k for k, c in enumerate(others)})
        symbol = {p: number for p, (_, number) in self.pieces.items()} | self.number
        self.place, self.joined = {}, {}  # of a pair of numbers: place of its piece by score (equal scores: equal places), and its number
        for piece, (score, number) in self.pieces.items():
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    self.place[a << 32 | b], self.joined[a << 32 | b] = order[score], number
        # The same for rows of a matrix: character -> number, and sorted pairs with their places and numbers
        self.by_code = np.arange(STRANGE, STRANGE + 0x110000)
        for c, n in self.number.items():
            self.by_code[ord(c)] = n
        pairs = sorted(self.place)
        self.pair_keys = np.array([*pairs, np.iinfo(np.int64).max], np.int64)
        self.pair_place = np.array([*map(self.place.get, pairs), self.last], np.int32)
        self.pair_joined = np.array([*map(self.joined.get, pairs), -1], np.int32)
        self.decimal = [str(i) for i in range(len(model.pieces))] + [",".join(map(str, self._ids(c))) for c in others]
        self.spelled = Spelled(self.decimal, self._ids)

    def normalised(self, text: str) -> str:
        """The text the merges work on: the model's own rule."""
        if self.plain:
            return self.prefix + text.replace(" ", SPACE) if text else ""
        return self.library.normalize(text)

    def short(self, part: str) -> str:
        """Ids of a short part: the agenda is the list of its pairs' places."""
        number, place, joined, last = self.number.get, self.place.get, self.joined, self.last
        symbols = [number(c, -1) for c in part]
        pairs = [place(a << 32 | b, last) for a, b in zip(symbols, symbols[1:], strict=False)]
        while pairs and (best := min(pairs)) < last:
            i = pairs.index(best)  # the leftmost of equal scores
            del pairs[i]
            new = joined[symbols[i] << 32 | symbols.pop(i + 1)]
            symbols[i] = new
            if i < len(pairs):
                pairs[i] = place(new << 32 | symbols[i + 1], last)
            if i:
                pairs[i - 1] = place(symbols[i - 1] << 32 | new, last)
        decimal = self.decimal
        if -1 in symbols:  # characters in no piece: in their order
            strange = (c for c in part if c not in self.number)
            return ",".join([decimal[s] if s >= 0 else ",".join(map(str, self._ids(next(strange)))) for s in symbols])
        return ",".join([decimal[s] for s in symbols])

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of what a and b join to."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        at[self.pair_keys[at] != key] = len(self.pair_keys) - 1
        return self.pair_place[at], self.pair_joined[at]

    def matrix(self, words: list[str]) -> list[str]:
        """Ids of short words of similar length: every row is the agenda of
        one word, each round joins the best pair of every row."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        width = int(length.max()) + 2  # a column before and one after
        symbol = np.full((len(words), width), -1, np.int64)
        inside = np.arange(1, width - 1) <= length[:, None]
        symbol[:, 1:-1][inside] = self.by_code[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        flat, last = symbol.reshape(-1), self.last
        places, joined = self._pair(flat, np.append(flat[1:], -1))
        agenda = places.reshape(symbol.shape)
        after, before = np.arange(1, flat.size + 1), np.arange(-1, flat.size - 1)
        rows = np.arange(len(words))
        while len(rows):
            at = rows * width + agenda[rows].argmin(axis=1)  # the leftmost of equal scores
            going = places[at] < last
            rows, at = rows[going], at[going]
            gone, new = after[at], joined[at].astype(np.int64)
            right, left = after[gone], before[at]
            flat[at], flat[gone], places[gone] = new, -1, last
            after[at], before[right] = right, at
            places[at], joined[at] = self._pair(new, flat[right])
            places[left], joined[left] = self._pair(flat[left], new)
        kept = symbol >= 0
        decimal = map(self.spelled.__getitem__, symbol[kept].tolist())
        return [",".join(islice(decimal, n)) for n in kept.sum(axis=1).tolist()]

    def learn(self, new: set[str]) -> None:
        """Note the ids of the short ones of words that are not in the table."""
        if self.unused:  # left to the heap
            return
        older, spaced = self._word.older, self.spaced
        keys = sorted((k for k in new if len(k) < SHORT and k not in older), key=len)
        words = [SPACE + k if spaced and k[0] != SPACE else k for k in keys]
        step = MATRIX_CELLS // SHORT
        for lo in range(0, len(words), step):
            for key, found in zip(keys[lo:lo + step], self.matrix(words[lo:lo + step]), strict=True):
                self._word.note(key, found)

    def long(self, part: str) -> str:
        """Ids of a part of any length: the agenda is a heap."""
        symbols: list[str | None] = list(part)
        left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        pieces, end, made = self.pieces, len(part), {}

        def pair(a: int, b: int) -> tuple | None:
            joined = symbols[a] + symbols[b]
            found = pieces.get(joined)
            return found and (-found[0], a, b, joined)

        todo = [p for a in range(end - 1) if (p := pair(a, a + 1))]
        heapq.heapify(todo)
        while todo:
            _, a, b, joined = heapq.heappop(todo)
            if symbols[a] is None or symbols[b] is None or symbols[a] + symbols[b] != joined:
                continue  # one of the two has been joined to something else since
            if joined in self.unused:
                made[joined] = (symbols[a], symbols[b])
            symbols[a], symbols[b] = joined, None
            right[a] = after = right[b]
            if after < end:
                left[after] = a
                if p := pair(a, after):
                    heapq.heappush(todo, p)
            if (before := left[a]) >= 0 and (p := pair(before, a)):
                heapq.heappush(todo, p)
        out = [s for s in symbols if s is not None]
        while made and any(s in made for s in out):  # unused pieces fall back to what they were joined from
            out = [t for s in out for t in made.get(s, (s,))]
        return ",".join(str(i) for s in out for i in self._ids(s))

    def _ids(self, symbol: str) -> list[int]:
        found = self.pieces.get(symbol)
        if found:
            return [found[1]]
        return [self.byte_ids[b] for b in symbol.encode("utf-8")] if self.byte_ids else [self.unknown]

    def _encode_word(self, key: str) -> str:
        word = SPACE + key if self.spaced and key[0] != SPACE else key
        if len(word) <= SHORT and not self.unused:
            return self.short(word)
        joins, at, parts = self.joins, 0, []
        for i, pair in enumerate(map(add, word, word[1:]), 1):
            if pair not in joins:
                parts.append(word[at:i])
                at = i
        parts.append(word[at:])
        return ",".join([self.short(p) if len(p) <= SHORT and not self.unused else self.long(p) for p in parts])

    def split(self, text: str) -> list[str]:
        """Words of ``text`` as the table has them."""
        if self.spaced and text and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")  # without the space before them
        return self.words(self.normalised(text))

    def joined_ids(self, found: Iterable[str]) -> str:
        """Ids of a text's words as one list."""
        out = ",".join(found)
        if self.byte_ids or not out:
            return out
        unknown = str(self.unknown)  # without byte pieces, neighbouring unknown symbols are one
        ids = out.split(",")
        return ",".join(i for k, i in enumerate(ids) if i != unknown or not k or ids[k - 1] != unknown)

    def encode_decimal(self, text: str) -> str:
        """Ids of ``text`` in decimal, joined by commas (no ids: empty)."""
        return self.joined_ids(map(self._word.__getitem__, self.split(text)))

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[str, str]]:
        """(text, its ids in decimal) of every text, in order; the new words
        of some ``STEP_CHARS`` characters are merged together."""
        step, held = [], 0
        for text in texts:
            step.append(text)
            held += len(text)
            if held >= STEP_CHARS:
                yield from self._step(step)
                step, held = [], 0
        yield from self._step(step)

    def _step(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        word, new, parts = self._word, set(), []
        for text in texts:
            own = self.split(text)
            found = list(map(word.get, own))
            if None in found:
                new.update([w for w, f in zip(own, found, strict=True) if f is None])
                parts.append(own)
            else:
                parts.append(self.joined_ids(found))
        self.learn(new)
        for text, part in zip(texts, parts, strict=True):
            yield text, part if isinstance(part, str) else self.joined_ids(map(word.__getitem__, part))

    def encode(self, text: str) -> list[int]:
        decimal = self.encode_decimal(text)
        return list(map(int, decimal.split(","))) if decimal else []


_ENCODERS: dict[str, AgendaEncoder] = {}


def encoder(model_path: str) -> AgendaEncoder:
    """One encoder per Python worker."""
    if model_path not in _ENCODERS:
        _ENCODERS[model_path] = AgendaEncoder(model_path)
    return _ENCODERS[model_path]


def encode_documents(docs: DataFrame, model_path: str, keep: list[str], with_ids: bool = True) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n_tokens``,
    ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256`` (UTF-8
    of the library's decoding of these ids), ``library_agrees`` and,
    ``with_ids``, the ids (``ids``).

    The library encodes every Arrow batch as well; ``library_agrees`` says
    whether its ids are the agenda's. NULL text is the empty text: no tokens,
    digests of nothing. Repeated rows give repeated rows; an empty table
    gives no rows. Columns of ``docs`` not in ``keep`` are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    fields = [docs.schema[c] for c in keep]
    kept = docs.select(*keep, docs["text"].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        for batch in batches:
            n, ids_sha, dec_sha, agrees, packed = [], [], [], [], []
            for text, decimal in enc.encode_all(value.as_py() or "" for value in batch.column("__text")):
                ids = np.fromstring(decimal, np.int32, sep=",").tolist() if decimal else []
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(decimal.encode("ascii")).hexdigest())
                dec_sha.append(hashlib.sha256(enc.library.decode(ids).encode("utf-8")).hexdigest())
                agrees.append(enc.library.encode(text) == ids)
                if with_ids:
                    packed.append(ids)
            cols = [batch.column(c) for c in keep]
            cols += [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string()), pa.array(agrees, pa.bool_())]
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", "library_agrees"]
            if with_ids:
                cols.append(pa.array(packed, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType()), T.StructField("library_agrees", T.BooleanType())]
                          + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    return kept.mapInArrow(run, schema)
