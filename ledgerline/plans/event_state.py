"""The event summary kept as state, so that a refresh reads only new event files.

The event log grows without end and a full refresh scans all of it for one
row per portfolio. The summary's columns merge (A05, A09–A11, D14, D15 are
minima, maxima and counts), so the summary of the files that arrived since the
last refresh is merged into the stored one. Structured Streaming's file source
keeps the list of files already read in its checkpoint; each run takes what is
new (trigger ``availableNow``) and stops. The merged state is published as a
generation together with the number of the batch it ends with: a batch that is
replayed after a lost driver finds its number there and is not merged twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..params import Params
from ..sources.contracts import conform
from . import common, publish

TABLE = "EventState"


@dataclass(frozen=True)
class Advance:
    """What one refresh of the state did."""
    state: publish.Published | None
    events_read: int


def advance(spark: SparkSession, events: str, root: str, params: Params | None = None, files_per_batch: int | None = None) -> Advance:
    """Merge the event files under ``events`` that are new since the last call
    into the state under ``root`` (a folder). One state belongs to one set of
    event literals: other literals need another root, and are an error. Files
    must be written once and not changed, as the file source expects."""
    prm = common.params_or_default(params)
    literals = [prm.listed_event, prm.awarded_event, prm.psa_event, prm.sold_event, list(prm.funding_events)]
    before = publish.current(spark, root)
    if before and before.notes["literals"] != literals:
        raise ValueError(f"{root} holds the state of other event literals: {before.notes['literals']}")
    log = conform("portfolio_event", spark.read.parquet(events))  # footers: names and types
    source = spark.readStream.schema(log.schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        state = publish.current(session, root)
        if state and state.notes["batch"] >= number:
            return  # merged before the driver was lost
        fresh = common.summarise_events(batch, prm)
        draft = publish.Draft(session, root, notes={"batch": number, "literals": literals})
        draft.build(TABLE, common.merge_summaries(state.read(TABLE), fresh) if state else fresh)
        draft.publish()

    query = (source.parquet(events).writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/_checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return Advance(publish.current(spark, root), sum(p["numInputRows"] for p in query.recentProgress))
