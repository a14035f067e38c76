"""The event summary as state equals the full one, reading only new files."""

import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.params import Params
from ledgerline.plans import common, event_state, publish


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_state_equals_the_full_summary_with_late_events(spark, src):
    prm, root = Params.testing(), tempfile.mkdtemp(prefix="ledgerline-state-")
    events, state = f"{root}/events", f"{root}/state"
    log = src["portfolio_event"]
    part = F.pmod(F.xxhash64("Id"), F.lit(10))
    # the last files hold the earliest events of every portfolio (late), NULL types and a portfolio of their own
    late = log.select(*[F.lit(None).cast("string").alias(c) if c == "UserId" else (F.col("EventUtc") - F.expr("INTERVAL 9 YEARS")).alias(c) if c == "EventUtc"
                        else F.col(c) for c in log.columns])
    own = log.limit(3).withColumn("PortfolioId", F.lit("P-new")).withColumn("EventType", F.when(F.col("Id") % 2 == 0, F.lit("listed")))
    arrivals = [log.where(part < 6), log.where(part >= 6), late.where(part == 1).unionByName(own)]
    for n, new in enumerate(arrivals):
        new.coalesce(2).write.mode("append").parquet(events)
        done = event_state.advance(spark, events, state, prm, files_per_batch=1 if n == 1 else None)
        assert done.events_read == new.count()  # only what is new
        everything = common.summarise_events(spark.read.parquet(events), prm)
        assert rows(done.state.read(event_state.TABLE)) == rows(everything)
    again = event_state.advance(spark, events, state, prm)
    assert again.events_read == 0 and again.state == done.state
    with pytest.raises(ValueError, match="other event literals"):
        event_state.advance(spark, events, state, prm.with_(psa_event="sold"))


def test_a_replayed_batch_is_not_merged_twice(spark, src, monkeypatch):
    """The driver dies after the state is published and before the checkpoint
    notes the batch: the batch comes again."""
    prm, root = Params.testing(), tempfile.mkdtemp(prefix="ledgerline-state-")
    src["portfolio_event"].coalesce(1).write.parquet(f"{root}/events")
    publish_ = publish.Draft.publish

    def dies(self):
        publish_(self)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(publish.Draft, "publish", dies)
    with pytest.raises(Exception, match="driver lost"):
        event_state.advance(spark, f"{root}/events", f"{root}/state", prm)
    monkeypatch.undo()
    done = event_state.advance(spark, f"{root}/events", f"{root}/state", prm)
    assert done.state.number == 1
    assert rows(done.state.read(event_state.TABLE)) == rows(common.summarise_events(src["portfolio_event"], prm))


def test_merging_is_the_summary_of_the_union(spark, src):
    prm, log = Params.testing(), src["portfolio_event"]
    parts = [common.summarise_events(log.where(F.pmod(F.xxhash64("Id"), F.lit(3)) == i), prm) for i in range(3)]
    full = rows(common.summarise_events(log, prm))
    assert rows(common.merge_summaries(*parts)) == full == rows(common.merge_summaries(parts[2], common.merge_summaries(*parts[:2])))
