"""Shared helpers: working folder, materialised steps, Arrow batches, hashing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Documents per Arrow batch. A batch of the longest documents stays well
# below an executor's memory; results do not depend on it.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_root(spark: SparkSession) -> str:
    """Folder shared by the driver and all executors: the cluster's
    ``spark.checkpoint.dir``. Where none is configured, a temporary folder is
    used on one machine (tests) and a cluster is refused: its executors would
    each write to their own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/llm-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and a lost executor costs no recomputation of the steps before it."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give every executor this package (once per application), so Python
    stages run wherever the cluster starts them."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-ship-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, package)))
    spark.sparkContext.addPyFile(archive)  # copied to the executors by the driver
    _SHIPPED.add(app)


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Settings of the Python stages: the package on every executor, Arrow
    batches of at most ``rows`` rows."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def encode_text(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a string column, NULL as empty."""
    for value in batch.column(column).cast(pa.large_binary()):
        raw = value.as_py()
        yield b"" if raw is None else raw


class Numbering(dict):
    """Word -> consecutive number, assigned at first sight."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) over unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive 64-bit hash of two 64-bit hashes."""
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + mix64(b ^ np.uint64(0xD6E8FEB86659FD93)))


class WordHasher:
    """Words of documents as numbers, with a 64-bit hash per distinct word.

    Numbers are local to one task; the table is emptied between documents
    once it holds ``limit`` words, so memory stays bounded. Hashes (XXH64,
    fixed seed) are the same everywhere."""

    def __init__(self, seed: int, limit: int = 1_000_000):
        from xxhash import xxh64_intdigest

        self._digest, self.seed, self.limit = xxh64_intdigest, seed, limit
        self._hashes = np.zeros(1024, np.uint64)
        self._restart()

    def _restart(self) -> None:
        self.number = Noted()
        self._done = 0

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > self.limit:
            self._restart()
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        """Hash by number, for every number given out so far."""
        fresh = self.number.fresh
        if fresh:
            total = len(self.number)
            if total > len(self._hashes):
                grown = np.zeros(max(total, 2 * len(self._hashes)), np.uint64)
                grown[:self._done] = self._hashes[:self._done]
                self._hashes = grown
            digest, seed = self._digest, self.seed
            self._hashes[self._done:total] = np.fromiter((digest(w, seed) for w in fresh), np.uint64, len(fresh))
            self._done = total
            fresh.clear()
        return self._hashes


class Noted(dict):
    """``Numbering`` that lists the words it numbered since last asked."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number
