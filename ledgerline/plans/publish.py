"""Generations of a layer: a set of tables that is published as one.

A refresh builds every table of a new generation beside the published one.
Nothing a reader sees changes until all are built and checked; then a single
step publishes the set: for a folder, one rename of a manifest that names the
generation's tables into place; for a catalog schema, one update of the
schema's properties. A reader takes the manifest once (``current``) and reads
all its tables from that generation. A job that fails or dies at any point
before that step leaves the published generation as it is, and the next
refresh removes what it left behind.

The published and the previous generation are kept, so that a reader that
took the manifest before a switch can finish; older ones go. One refresh of a
layer runs at a time: a second one that publishes meanwhile makes the slower
one fail at its rename, in a folder.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CATALOG_PREFIX = "catalog:"
MANIFESTS, GENERATIONS = "_manifests", "_generations"
PROPERTY = "ledgerline.generation"


def is_catalog(root: str) -> bool:
    return root.startswith(CATALOG_PREFIX)


def schema_of(root: str) -> str:
    return root[len(CATALOG_PREFIX):]


def fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _where(root: str, generation: str, name: str) -> str:
    if is_catalog(root):
        return f"`{schema_of(root)}`.`{name}__g{generation}`"
    return os.path.join(root, GENERATIONS, generation, name)


def _read(spark: SparkSession, root: str, where: str) -> DataFrame:
    return spark.table(where) if is_catalog(root) else spark.read.parquet(where)


@dataclass(frozen=True)
class Published:
    """One published generation: every table is read from it."""
    spark: SparkSession
    root: str
    number: int
    generation: str
    rows: dict[str, int]
    notes: dict = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        if name not in self.rows:
            raise KeyError(f"{name} is not in the published generation {self.generation} of {self.root}")
        return _read(self.spark, self.root, _where(self.root, self.generation, name))


def _manifest_files(spark: SparkSession, root: str) -> list[str]:
    folder, fs = fs_path(spark, os.path.join(root, MANIFESTS))
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(n for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def _manifest(spark: SparkSession, root: str) -> dict | None:
    if is_catalog(root):
        catalog = spark._jsparkSession.sessionState().catalog()
        if not catalog.databaseExists(schema_of(root)):
            return None
        found = catalog.getDatabaseMetadata(schema_of(root)).properties().get(PROPERTY)
        return json.loads(found.get()) if found.isDefined() else None
    files = _manifest_files(spark, root)
    if not files:
        return None
    text = "\n".join(r.value for r in spark.read.text(os.path.join(root, MANIFESTS, files[-1]), wholetext=True).collect())
    return json.loads(text)


def current(spark: SparkSession, root: str) -> Published | None:
    """The published generation of a root, or None where none was published."""
    m = _manifest(spark, root)
    return Published(spark, root, m["number"], m["generation"], m["rows"], m.get("notes", {})) if m else None


@dataclass
class Draft:
    """A generation being built."""
    spark: SparkSession
    root: str
    generation: str = field(default_factory=lambda: time.strftime("%Y%m%d%H%M%S", time.gmtime()) + uuid.uuid4().hex[:8])
    rows: dict[str, int] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)  # kept in the manifest, published with the tables

    def build(self, name: str, df: DataFrame) -> int:
        """Write one table; its rows, counted while it is written and again
        from the files' own counts."""
        seen = Observation()
        out, where = df.observe(seen, F.count(F.lit(1)).alias("rows")), _where(self.root, self.generation, name)
        if is_catalog(self.root):
            out.write.format("parquet").saveAsTable(where)
        else:
            out.write.parquet(where)
        written, stored = seen.get["rows"], self.read(name).count()
        if written != stored:
            raise OSError(f"{name}: {written} rows were written and {stored} are stored")
        self.rows[name] = stored
        return stored

    def read(self, name: str) -> DataFrame:
        return _read(self.spark, self.root, _where(self.root, self.generation, name))

    def publish(self) -> Published:
        """Make this generation the one readers see, then remove older ones."""
        before = _manifest(self.spark, self.root)
        manifest = {"number": (before["number"] if before else 0) + 1, "generation": self.generation,
                    "previous": before["generation"] if before else None, "rows": self.rows, "notes": self.notes}
        if is_catalog(self.root):
            schema = schema_of(self.root)
            self.spark.sql(f"ALTER SCHEMA `{schema}` SET DBPROPERTIES ('{PROPERTY}' = '{json.dumps(manifest)}')")
            self._point_views(schema)
        else:
            self._rename_manifest(manifest)
        _remove_others(self.spark, self.root, {self.generation, manifest["previous"]})
        return Published(self.spark, self.root, manifest["number"], self.generation, dict(self.rows), dict(self.notes))

    def discard(self) -> None:
        """Remove what a failed refresh has built."""
        _remove(self.spark, self.root, self.generation)

    def _rename_manifest(self, manifest: dict) -> None:
        folder = os.path.join(self.root, MANIFESTS)
        name = f"{manifest['number']:08d}.json"
        draft, fs = fs_path(self.spark, os.path.join(folder, f"_{self.generation}"))
        target, _ = fs_path(self.spark, os.path.join(folder, name))
        fs.mkdirs(draft.getParent())
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(manifest).encode("utf-8")))
        finally:
            out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise OSError(f"{self.root}: generation {manifest['number']} was published by another refresh")
        for old in _manifest_files(self.spark, self.root)[:-2]:
            fs.delete(fs_path(self.spark, os.path.join(folder, old))[0], False)

    def _point_views(self, schema: str) -> None:
        """Names for SQL users. Each view moves on its own, after the switch;
        readers that need one generation for several tables use ``current``."""
        tables = {t.name.lower(): t.tableType for t in self.spark.catalog.listTables(schema)}
        for name in self.rows:
            if tables.get(name.lower()) in ("MANAGED", "EXTERNAL"):  # a table of an older layout
                self.spark.sql(f"DROP TABLE `{schema}`.`{name}`")
            self.spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS SELECT * FROM {_where(self.root, self.generation, name)}")


def _generation_tables(spark: SparkSession, schema: str) -> list[tuple[str, str]]:
    """(table, generation) of every physical table of a schema."""
    found = [t.name for t in spark.catalog.listTables(schema) if t.tableType != "VIEW" and "__g" in t.name]
    return [(n, n.rsplit("__g", 1)[1]) for n in found]


def _remove(spark: SparkSession, root: str, generation: str) -> None:
    if is_catalog(root):
        for name, own in _generation_tables(spark, schema_of(root)):
            if own == generation:
                spark.sql(f"DROP TABLE IF EXISTS `{schema_of(root)}`.`{name}`")
        return
    folder, fs = fs_path(spark, os.path.join(root, GENERATIONS, generation))
    fs.delete(folder, True)


def _remove_others(spark: SparkSession, root: str, keep: set[str | None]) -> None:
    if is_catalog(root):
        there = {g for _, g in _generation_tables(spark, schema_of(root))}
    else:
        folder, fs = fs_path(spark, os.path.join(root, GENERATIONS))
        there = {f.getPath().getName() for f in fs.listStatus(folder)} if fs.exists(folder) else set()
    for generation in there - keep:
        _remove(spark, root, generation)
