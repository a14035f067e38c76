"""Byte-level BPE as a lazily determinised transducer, and streaming decode.

A rank table decides every merge, and the encoding of a piece is the only
split into tokens in which each neighbouring pair ``(a, b)`` is *compatible*:
merging the bytes ``a + b`` on their own gives ``[a, b]`` again. So encoding
is a walk of a nondeterministic transducer whose states are ``(last token,
prefix of the next token)``; reading a byte extends the prefix, and at a
prefix that is a token compatible with the last one it may emit it.

``MergeTransducer`` determinises that machine on demand. A determinised state
is the set of live ``(tokens not yet emitted, last token, prefix)``; whatever
all of them agree on is emitted at once, so a token leaves after a lookahead
bounded by the longest token. Transitions are kept in a table of bounded size
(cleared when full, which changes speed and never results).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import prepare, texts_of


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one ``base64(token) rank`` per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f.read().splitlines()) if t}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Reference merge loop on one short byte string: join the neighbouring
    parts of lowest rank, leftmost first, until none has a rank."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class MergeTransducer:
    """Piece of bytes -> token ids.

    ``max_states``: determinised states kept; ``max_pieces``: finished pieces
    remembered. Both only bound memory."""

    START = -1  # "last token" before the first one

    def __init__(self, ranks: dict[bytes, int], max_states: int = 400_000, max_pieces: int = 300_000):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"rank table lacks single bytes {missing[:5]}")
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.max_states, self.max_pieces = max_states, max_pieces
        # prefix tree: node << 8 | byte -> node; node -> token id that ends there
        self.child: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        nodes = 1
        for tok, rank in ranks.items():
            node = 0
            for byte in tok:
                nxt = self.child.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.child[node << 8 | byte] = nodes
                    nodes += 1
                node = nxt
            self.ends[node] = rank
        # edges of each token's merge tree: (part, rank at which it is absorbed)
        self._edges: dict[int, tuple[list, list] | None] = {}
        self._compatible: dict[tuple[int, int], bool] = {}
        self._clear_states()
        self.pieces: dict[bytes, tuple[int, ...]] = {}

    def _clear_states(self) -> None:
        start = (((), self.START, 0),)
        self.number = {start: 0}
        self.members = [start]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.finals: dict[int, tuple[int, ...]] = {}

    def _spines(self, tok: int) -> tuple[list, list] | None:
        """Left and right edge of the merge tree of a token, from the token
        down to a single byte, each part with the rank of the merge that
        absorbs it (none for the token itself). None: merging the token's
        bytes does not give the token, so no encoding contains it."""
        if tok in self._edges:
            return self._edges[tok]
        never = float("inf")
        text = self.token[tok]
        left, right = [(text, never)], [(text, never)]
        out: tuple[list, list] | None = (left, right)
        if len(text) > 1:
            halves = self._last_merge(text)
            if halves is None:
                out = None
            else:
                a, b = (self._spines(self.ranks[h]) for h in halves)
                if a is None or b is None:
                    out = None
                else:
                    left += [(part, min(at, tok)) for part, at in a[0]]
                    right += [(part, min(at, tok)) for part, at in b[1]]
        self._edges[tok] = out
        return out

    def _last_merge(self, text: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge completes ``text``; None if it never completes."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 2:
            ranked = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not ranked:
                return None
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts[0], parts[1]

    def _allowed(self, last: int, tok: int) -> bool:
        """May ``tok`` follow ``last``? Merges happen in order of rank, so the
        border between them is crossed exactly if some part at the end of
        ``last`` and some part at the start of ``tok`` have a joint rank lower
        than the merges that absorb either of them (at equal rank the left
        merge comes first)."""
        after = self._spines(tok)
        if after is None:
            return False
        if last == self.START:
            return True
        key = (last, tok)
        ok = self._compatible.get(key)
        if ok is None:
            if len(self._compatible) > 1_000_000:
                self._compatible.clear()
            ranks = self.ranks
            ok = True
            for x, x_until in self._spines(last)[1]:
                for y, y_until in after[0]:
                    joint = ranks.get(x + y)
                    if joint is not None and joint < x_until and joint <= y_until:
                        ok = False
                        break
                if not ok:
                    break
            self._compatible[key] = ok
        return ok

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        live = []
        child, ends = self.child, self.ends
        for pending, last, node in self.members[state]:
            nxt = child.get(node << 8 | byte)
            if nxt is None:
                continue
            live.append((pending, last, nxt))
            tok = ends.get(nxt)
            if tok is not None and self._allowed(last, tok):
                live.append((pending + (tok,), tok, 0))
        # emit what every live hypothesis agrees on
        agreed = 0
        shortest = min(len(p) for p, _, _ in live)
        while agreed < shortest and len({p[agreed] for p, _, _ in live}) == 1:
            agreed += 1
        out = live[0][0][:agreed]
        target = tuple((p[agreed:], last, node) for p, last, node in live)
        number = self.number.get(target)
        if number is None:
            number = self.number[target] = len(self.members)
            self.members.append(target)
        move = self.moves[state << 8 | byte] = (number, out)
        return move

    def _final(self, state: int) -> tuple[int, ...]:
        done = [pending for pending, _, node in self.members[state] if node == 0]
        if len(done) != 1:
            raise AssertionError("a byte string has exactly one merge result")
        self.finals[state] = done[0]
        return done[0]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        known = self.pieces.get(piece)
        if known is not None:
            return known
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token is that token
            ids: tuple[int, ...] = (whole,)
        else:
            if len(self.members) > self.max_states:
                self._clear_states()
            state, out, moves = 0, [], self.moves
            for byte in piece:
                state, emitted = moves.get(state << 8 | byte) or self._step(state, byte)
                if emitted:
                    out.extend(emitted)
            rest = self.finals.get(state)
            out.extend(self._final(state) if rest is None else rest)
            ids = tuple(out)
        if len(piece) <= 64:
            if len(self.pieces) >= self.max_pieces:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids


class _NeedsContext(Exception):
    """A part whose split depends on its neighbours."""


class _Units(dict):
    """Part of a text between single spaces -> packed ids of space + part."""

    def __init__(self, pack, limit: int):
        self.pack, self.limit = pack, limit

    def __missing__(self, part: str) -> bytes:
        if not part or part[0].isspace() or part[-1].isspace():
            raise _NeedsContext
        ids = self.pack(" " + part)
        if len(part) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[part] = ids
        return ids


class Encoder:
    """Text -> ids as little-endian unsigned 32-bit integers: each match of
    ``pattern`` goes through the transducer.

    The byte-BPE patterns split before a single space that stands between two
    other non-space characters, whatever surrounds it. So a text without
    longer runs of white space around its spaces is the sequence of its
    space-separated parts, and parts seen before are looked up. Any other
    text is split whole (``spaced=False`` does so for every text, for
    patterns without that property)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = True, max_units: int = 600_000):
        self.split = regex.compile(pattern).findall
        self.fst = MergeTransducer(ranks)
        self.spaced = spaced
        self.units = _Units(self._pack, max_units)

    def _pack(self, text: str) -> bytes:
        out: list[int] = []
        piece_ids = self.fst.encode_piece
        for piece in self.split(text):
            out.extend(piece_ids(piece.encode("utf-8")))
        return np.asarray(out, dtype="<u4").tobytes()

    def encode_packed(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if self.spaced and first and not first[0].isspace() and not first[-1].isspace():
            try:
                return self._pack(first) + b"".join(map(self.units.__getitem__, rest))
            except _NeedsContext:
                pass
        return self._pack(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()


def utf8_step(state: tuple[int, int, int], byte: int) -> tuple[tuple[int, int, int], bool, bool]:
    """One byte of the UTF-8 machine. A state is (continuation bytes missing,
    lowest, highest value allowed for the next byte); (0, 0, 0) is between
    characters. Returns (next state, byte accepted, character complete); a
    byte that is not accepted ends the broken character before it and is read
    again between characters."""
    need, low, high = state
    if need:
        if low <= byte <= high:
            need -= 1
            return ((need, 0x80, 0xBF) if need else (0, 0, 0)), True, not need
        return (0, 0, 0), False, False
    if byte < 0x80:
        return (0, 0, 0), True, True
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF), True, False
    if 0xE0 <= byte <= 0xEF:  # no overlong forms, no surrogates
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF), True, False
    if 0xF0 <= byte <= 0xF4:  # no overlong forms, at most U+10FFFF
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF), True, False
    return (0, 0, 0), False, False


class StreamDecoder:
    """ids -> text, incrementally: ``feed`` returns the characters completed
    so far, ``close`` ends the stream. Broken sequences become U+FFFD, one for
    each maximal broken part. The state between two calls is the unfinished
    character's bytes, at most three."""

    def __init__(self, token: dict[int, bytes]):
        self.token = token
        self.held = b""

    @staticmethod
    def _complete(data: bytes) -> int:
        """Length of ``data`` without an unfinished last character: the
        machine runs over the bytes since the last lead byte."""
        start = len(data)
        while start and len(data) - start < 4:
            start -= 1
            if not 0x80 <= data[start] <= 0xBF:
                break
        state = (0, 0, 0)
        for byte in data[start:]:
            state, accepted, _ = utf8_step(state, byte)
            if not accepted:
                return len(data)
        return start if state[0] else len(data)

    @staticmethod
    def _replace(data: bytes) -> str:
        """The machine byte by byte, for data with broken sequences."""
        out, start, state, i = [], 0, (0, 0, 0), 0
        while i < len(data):
            nxt, accepted, complete = utf8_step(state, data[i])
            if accepted:
                i += 1
                if complete:
                    out.append(data[start:i].decode("utf-8"))
                    start = i
            else:
                out.append("\ufffd")
                if not state[0]:
                    i += 1
                start = i
            state = nxt
        if start < len(data):  # what follows is not its continuation
            out.append("\ufffd")
        return "".join(out)

    def feed(self, ids) -> str:
        data = self.held + b"".join(map(self.token.__getitem__, ids))
        cut = self._complete(data)
        self.held, whole = data[cut:], data[:cut]
        try:
            return whole.decode("utf-8")
        except UnicodeDecodeError:
            return self._replace(whole)

    def close(self) -> str:
        rest, self.held = self.held, b""
        return "\ufffd" if rest else ""


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(rank_path: str, pattern: str) -> Encoder:
    """One encoder per Python worker: tables are built once per process."""
    key = (rank_path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(load_ranks(rank_path), pattern)
    return _ENCODERS[key]


DECODE_CHUNK = 1 << 16


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, keep: list[str],
                     with_ids: bool = True) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n_tokens``,
    ``ids_sha256`` (ids as little-endian unsigned 32-bit integers),
    ``decoded_sha256`` (UTF-8 of the streamed decode) and, ``with_ids``, the
    ids themselves as that binary (``ids``).

    NULL text is the empty text: no tokens, digests of nothing. Repeated rows
    give repeated rows; an empty table gives no rows. Columns of ``docs`` not
    in ``keep`` are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    fields = [docs.schema[c] for c in keep]
    kept = docs.select(*keep, docs["text"].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_path, pattern)
        dec = StreamDecoder(enc.fst.token)
        for batch in batches:
            n, ids_sha, dec_sha, packed = [], [], [], []
            for raw in texts_of(batch, "__text"):
                data = enc.encode_packed(raw.decode("utf-8"))
                ids = np.frombuffer(data, "<u4")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(data).hexdigest())
                digest = hashlib.sha256()
                for at in range(0, len(ids), DECODE_CHUNK):
                    digest.update(dec.feed(ids[at:at + DECODE_CHUNK].tolist()).encode("utf-8"))
                digest.update(dec.close().encode("utf-8"))
                dec_sha.append(digest.hexdigest())
                if with_ids:
                    packed.append(data)
            cols = [batch.column(c) for c in keep]
            cols += [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())]
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = T.StructType([*fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())]
                          + ([T.StructField("ids", T.BinaryType())] if with_ids else []))
    return kept.mapInArrow(run, schema)
