"""``Sources``: name -> DataFrame lookup for the operational tables.

Two ways to build one:

* ``Sources.from_tables(spark, root)`` – production: one parquet dataset (or
  catalog table) per source name, read lazily so Catalyst prunes columns and
  pushes filters into the scan.
* ``Sources.from_testdata(spark, sf_dir)`` – tests, checks and benches: the
  source tables are projections of the driver's synthetic carrier tables
  (``fixtures.FIXTURE_SQL``), built lazily with ``spark.sql``.

Either way every table is conformed to its contract (``contracts.conform``).
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators import DEFAULT_BROADCAST_LIMIT, estimated_bytes
from .contracts import CONTRACTS, conform
from .fixtures import FIXTURE_SQL, REQUEST_STEPS

CARRIER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SOURCE_TABLES = tuple(FIXTURE_SQL)
_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def fixture_dependencies(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(FIXTURE_SQL[name])))


class Sources(Mapping):
    """Lazy, memoised mapping of source-table name to conformed DataFrame."""

    def __init__(self, spark: SparkSession, build, derived: dict[str, DataFrame] | None = None, pad: bool = False):
        self.spark = spark
        self.pad = pad  # absent contract columns become NULL (fixtures) instead of an error
        self._build = build
        self._cache: dict[str, DataFrame] = {}
        # tables derived from the sources and materialised once per refresh
        # (e.g. the per-portfolio event summary), shared by every product
        self.derived: dict[str, DataFrame] = dict(derived or {})

    def with_tables(self, **frames: DataFrame) -> "Sources":
        """A view of these sources that also carries materialised derived tables."""
        out = Sources(self.spark, self._build, {**self.derived, **frames}, self.pad)
        out._cache = self._cache
        return out

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = conform(name, self._build(name), self.pad)
        return self._cache[name]

    def __iter__(self):
        return iter(SOURCE_TABLES)

    def __len__(self) -> int:
        return len(SOURCE_TABLES)

    # ------------------------------------------------------------------ builders
    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> "Sources":
        def build(name: str) -> DataFrame:
            path = os.path.join(root, name)
            if fmt == "table":
                return spark.table(f"{root}.{name}")
            return spark.read.format(fmt).load(path)

        return cls(spark, build)

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str) -> "Sources":
        """Catalog tables ``schema.<name>`` (e.g. written by
        ``layout.write_source_tables`` with account-key buckets)."""
        return cls(spark, lambda name: spark.table(f"`{schema}`.`{name}`"))

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame], pad: bool = False) -> "Sources":
        return cls(spark, lambda name: frames[name], pad=pad)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, cache: bool = False) -> "Sources":
        """``cache=True`` persists derived tables (memory, spilling to disk)
        on first use, for sessions that run many queries over the same small
        fixtures; a lost block is recomputed from its lineage. Of large tables
        only the requests are kept, which are costly to build: a projection of
        a large file is read again with the columns asked for, where its whole
        rows would fill the memory and then the disk of every executor."""
        carriers: dict[str, DataFrame] = {}
        raw: dict[str, DataFrame] = {}

        def carrier(name: str) -> DataFrame:
            if name not in carriers:
                carriers[name] = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
            return carriers[name]

        # the requests' inner queries are tables of their own, kept like the
        # others: the line items are grouped by order once, for all who read them
        texts = {**FIXTURE_SQL, **REQUEST_STEPS}
        views = f"ledgerline_{uuid.uuid4().hex}"

        def build(name: str) -> DataFrame:
            if name not in raw:
                frames, text = {}, texts[name]
                for dep in sorted(set(_PLACEHOLDER.findall(text))):
                    # fixtures read carriers and earlier fixtures (unconformed,
                    # so helper columns such as bucket30 stay visible)
                    frames[dep] = carrier(dep) if dep in CARRIER_TABLES else build(dep)
                    if dep in REQUEST_STEPS:
                        # spark.sql drops the view of a frame it was given, and
                        # with it what the frame has persisted
                        text, _ = text.replace(f"{{{dep}}}", f"{views}_{dep}"), frames.pop(dep)
                df = spark.sql(text, **frames)
                size = estimated_bytes(df) if cache and name not in REQUEST_STEPS else 0
                keep = cache and size is not None and size <= DEFAULT_BROADCAST_LIMIT
                raw[name] = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df
                if name in REQUEST_STEPS:
                    raw[name].createOrReplaceTempView(f"{views}_{name}")
            return raw[name]

        return cls(spark, build, pad=True)


def write_sources(sources: Sources, root: str, files: int | None = None) -> None:
    """Materialise every source table as parquet under ``root`` (bench set-up).
    ``files``: spread each table over that many files (round robin), as real
    tables are, so scans get one task per file instead of one per table."""
    for name in SOURCE_TABLES:
        df = sources[name]
        if files:
            df = df.repartition(files)
        df.write.mode("overwrite").parquet(os.path.join(root, name))


__all__ = ["Sources", "SOURCE_TABLES", "CARRIER_TABLES", "CONTRACTS", "fixture_dependencies", "write_sources"]
