"""Fill-in-middle transformation with a sparse exception index.

Cuts are found on UTF-8 bytes and counted in code points. The index of a text
records only its multibyte characters: their code-point positions and the
bytes they have beyond one, summed. A binary search in it converts a cut
either way; between two of its entries, and in a text without any, the
conversion is plain addition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import prepare, texts_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
#: Of 100: documents that are transformed, and transformed ones in suffix-prefix-middle order.
TRANSFORMED, SPM = 50, 80


class ExceptionIndex:
    """Multibyte characters of a UTF-8 text."""

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.after = np.concatenate([[0], np.cumsum(excess)])  # excess bytes before the n-th of them
        self.bytes = lead
        self.points = lead - self.after[:-1]

    def to_byte(self, point: int) -> int:
        """Byte offset of a cut before code point ``point``."""
        return point + int(self.after[np.searchsorted(self.points, point)])

    def to_point(self, byte: int) -> int:
        """Code points before a cut at byte offset ``byte``."""
        return byte - int(self.after[np.searchsorted(self.bytes, byte)])


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the tokens end: a word with the white space
    before it is one, white space after the last word is one."""
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1
    return np.append(ends, len(data)) if len(data) and white[-1] else ends


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit draws of a document (NULL id: of the empty text)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def transform(text: bytes, doc_id, seed: int = SEED, transformed: int = TRANSFORMED,
              spm: int = SPM) -> tuple[int, str, int | None, int | None, bytes]:
    """Tokens, form, code points of prefix and middle (None if plain), output."""
    data = np.frombuffer(text, np.uint8)
    ends = unit_ends(data)
    n = len(ends)
    h = draws(doc_id, seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= transformed:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    index = ExceptionIndex(data)
    prefix_chars = index.to_point(a)
    middle_chars = index.to_point(b) - prefix_chars
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", prefix_chars, middle_chars, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", prefix_chars, middle_chars, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restore(output: bytes, form: str) -> bytes:
    """The text of an output. Its parts hold no mark, and no mark begins
    inside another, so each mark is found at its first occurrence."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return two + middle + one if form == "spm" else one + middle + two


def fill_in_middle(docs: DataFrame, keep: list[str], seed: int = SEED, transformed: int = TRANSFORMED, spm: int = SPM,
                   with_output: bool = True) -> DataFrame:
    """One row per document: the ``keep`` columns, ``n`` tokens, ``form``
    (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (code points;
    NULL if plain), SHA-256 of the output and of the text rebuilt from it and,
    ``with_output``, the output.

    NULL text is the empty text and stays plain. A NULL ``doc_id`` draws from
    the empty text; rows of equal id draw alike. An empty table gives no rows.
    Columns of ``docs`` not in ``keep`` are ignored."""
    spark = docs.sparkSession
    prepare(spark)
    fields = [docs.schema[c] for c in keep]
    kept = docs.select(*keep, docs["doc_id"].alias("__id"), docs["text"].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [transform(t, i, seed, transformed, spm)
                    for i, t in zip(batch.column("__id").to_pylist(), texts_of(batch, "__text"), strict=True)]
            cols = [batch.column(c) for c in keep]
            cols += [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.string()),
                     pa.array([m[2] for m in made], pa.int64()), pa.array([m[3] for m in made], pa.int64()),
                     pa.array([hashlib.sha256(m[4]).hexdigest() for m in made], pa.string()),
                     pa.array([hashlib.sha256(restore(m[4], m[1])).hexdigest() for m in made], pa.string())]
            names = [*keep, "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
            if with_output:
                cols.append(pa.array([m[4].decode("utf-8") for m in made], pa.string()))
                names.append("output")
            yield pa.RecordBatch.from_arrays(cols, names)

    long, string = T.LongType(), T.StringType()
    made = [("n", long), ("form", string), ("prefix_chars", long), ("middle_chars", long), ("output_sha256", string), ("restored_sha256", string)]
    return kept.mapInArrow(run, T.StructType([*fields, *(T.StructField(n, t) for n, t in made + ([("output", string)] if with_output else []))]))
