"""Verified publish: row laws, and generations that switch as one."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.params import Params
from ledgerline.plans import gold, laws, pipeline, publish


def test_row_laws_match_the_products(src):
    prm = Params.testing()
    wanted = laws.expected(laws.GOLD_LAWS, src, prm)
    assert list(laws.GOLD_LAWS) == [n for n, _ in pipeline.GOLD_STEPS] and laws.expected([], src, prm) == {}
    for name, product in pipeline.GOLD_STEPS:
        rows, exact = product(src, prm).count(), laws.GOLD_LAWS[name][1]
        laws.check(name, rows, wanted[name])
        assert rows == wanted[name] if exact else rows >= wanted[name] > rows // 2  # close enough to notice a short table
        for short in (0, wanted[name] - 1):
            with pytest.raises(laws.RowLawError, match=f"{name}.*call for"):
                laws.check(name, short, wanted[name])


def test_an_empty_product_is_not_published(spark, src, monkeypatch):
    """An empty and a short product raise; readers keep the old generation."""
    prm, root = Params.testing(), tempfile.mkdtemp(prefix="ledgerline-publish-")
    steps = [s for s in pipeline.GOLD_STEPS if s[0] in ("Portfolio_Aggregate", "Complaint_Aggregate")]
    monkeypatch.setattr(pipeline, "GOLD_STEPS", steps)
    pipeline.refresh_gold(spark, src, root, prm)
    first = publish.current(spark, root)
    rows = first.read("Complaint_Aggregate").count()
    for cut in (lambda df: df.limit(0), lambda df: df.limit(rows - 1)):
        bad = [(n, (lambda s, p, b=b: cut(b(s, p))) if n == "Complaint_Aggregate" else b) for n, b in steps]
        monkeypatch.setattr(pipeline, "GOLD_STEPS", bad)
        with pytest.raises(laws.RowLawError, match="Complaint_Aggregate"):
            pipeline.refresh_gold(spark, src, root, prm)
        assert publish.current(spark, root) == first
        assert pipeline.read_table(spark, root, "Complaint_Aggregate").count() == rows
        assert os.listdir(os.path.join(root, "_generations")) == [first.generation]  # nothing is left of the failed one


class Killed(BaseException):
    """Not an Exception: no handler cleans up, as when the driver dies."""


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_a_killed_refresh_leaves_one_generation(spark, src, monkeypatch, kind):
    prm = Params.testing()
    root = tempfile.mkdtemp(prefix="ledgerline-publish-") if kind == "folder" else "catalog:ll_publish_test"
    steps = [s for s in pipeline.GOLD_STEPS if s[0] in ("Portfolio", "Portfolio_Aggregate")]
    monkeypatch.setattr(pipeline, "GOLD_STEPS", steps)
    try:
        pipeline.refresh_gold(spark, src, root, prm, max_parallel=1)
        first = publish.current(spark, root)
        kept = {n: first.read(n).count() for n, _ in steps}

        def dies(s, p):
            raise Killed

        # other rows in every table, and the driver dies after the first one is built
        fewer = src.with_tables()
        fewer._cache = {**{n: src[n] for n in src}, "portfolio": src["portfolio"].filter(F.col("Id") % 2 == 0 if dict(src["portfolio"].dtypes)["Id"] != "string" else F.crc32("Id") % 2 == 0)}
        monkeypatch.setattr(pipeline, "GOLD_STEPS", [steps[0], (steps[1][0], dies)])
        with pytest.raises(Killed):
            pipeline.refresh_gold(spark, fewer, root, prm, max_parallel=1)
        assert publish.current(spark, root) == first
        assert {n: pipeline.read_table(spark, root, n).count() for n, _ in steps} == kept
        # the next refresh publishes both tables at once and removes the dead one's files
        monkeypatch.setattr(pipeline, "GOLD_STEPS", steps)
        pipeline.refresh_gold(spark, fewer, root, prm, max_parallel=1)
        second = publish.current(spark, root)
        assert second.number == first.number + 1 and second.generation != first.generation
        new = {n: second.read(n).count() for n, _ in steps}
        assert all(0 < new[n] < kept[n] for n in kept)
        assert {n: first.read(n).count() for n, _ in steps} == kept  # a reader from before the switch can finish
        if kind == "folder":
            assert sorted(os.listdir(os.path.join(root, "_generations"))) == sorted([first.generation, second.generation])
        else:
            assert {g for _, g in publish._generation_tables(spark, "ll_publish_test")} == {first.generation, second.generation}
            assert spark.table("ll_publish_test.Portfolio").count() == new["Portfolio"]
        pipeline.refresh_gold(spark, fewer, root, prm, max_parallel=1)
        with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
            first.read("Portfolio").count()
    finally:
        if kind == "catalog":
            spark.sql("DROP SCHEMA IF EXISTS ll_publish_test CASCADE")


def test_a_second_publisher_fails(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="ledgerline-publish-")
    slow, quick = publish.Draft(spark, root), publish.Draft(spark, root)
    for d in (slow, quick):
        d.build("T", spark.range(3))
    before = publish._manifest(spark, root)
    quick.publish()
    monkeypatch.setattr(publish, "_manifest", lambda *_: before)  # what the slow one had read
    with pytest.raises(OSError, match="another refresh"):
        slow.publish()
    monkeypatch.undo()
    assert publish.current(spark, root).generation == quick.generation
    with pytest.raises(KeyError, match="not in the published"):
        publish.current(spark, root).read("U")


def test_silver_needs_a_published_gold(spark, src):
    with pytest.raises(FileNotFoundError, match="no gold refresh"):
        pipeline.refresh_silver(spark, src, tempfile.mkdtemp(prefix="ledgerline-publish-"), "/tmp/unused", Params.testing())
    assert gold.d01_portfolio(src, Params.testing()).columns
