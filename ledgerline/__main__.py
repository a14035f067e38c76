"""Command line for the refresh jobs, mirroring the reference's two commands.

    python -m ledgerline refresh-gold   --sources ROOT --gold ROOT [--as-of-utc ... --as-of-local ...]
    python -m ledgerline refresh-silver --sources ROOT --gold ROOT --silver ROOT
    python -m ledgerline views          --sources ROOT --gold ROOT --silver ROOT

``views`` creates persistent catalog views, so its roots must be
``catalog:<schema>``. ``--sources`` is a folder with one parquet dataset per source table, or
``catalog:<schema>``; output roots likewise. ``--shuffle-bytes`` and
``--buckets`` apply ``session.cluster_conf``. Each command prints the seconds
per step as JSON. The session comes from ``spark-submit``/the environment;
the product settings (ANSI, UTC, AQE) are applied on top.
"""

from __future__ import annotations

import argparse
import json
import os
from datetime import datetime

from pyspark.sql import SparkSession

from .params import Params
from .plans import event_state, pipeline
from .session import apply_conf, cluster_conf
from .sources import Sources
from .sources.contracts import null_identities


def _sources(spark: SparkSession, root: str) -> Sources:
    if root.startswith(pipeline.CATALOG_PREFIX):
        return Sources.from_catalog(spark, root[len(pipeline.CATALOG_PREFIX):])
    return Sources.from_tables(spark, root)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("command", choices=["refresh-gold", "refresh-silver", "views"])
    ap.add_argument("--sources", required=True)
    ap.add_argument("--gold", required=True)
    ap.add_argument("--silver")
    ap.add_argument("--as-of-utc", type=datetime.fromisoformat)
    ap.add_argument("--as-of-local", type=datetime.fromisoformat)
    ap.add_argument("--parallel", type=int, default=4)
    ap.add_argument("--shuffle-bytes", type=int, help="size of the largest shuffle: sizes the cluster settings")
    ap.add_argument("--event-state", help="folder of the event summary kept as state: refresh-gold reads only new event files (folder sources)")
    ap.add_argument("--check-sources", action="store_true", help="before refresh-gold: fail where a source has rows without an identity")
    ap.add_argument("--buckets", type=int, help="bucket count of the account-keyed source tables")
    a = ap.parse_args(argv)

    spark = apply_conf(SparkSession.builder.appName(f"ledgerline {a.command}").getOrCreate())
    if a.shuffle_bytes:
        for k, v in cluster_conf(a.shuffle_bytes, a.buckets).items():
            spark.conf.set(k, v)
    kw = {k: v for k, v in (("as_of_utc", a.as_of_utc), ("as_of_local", a.as_of_local)) if v is not None}
    params = Params(**kw)
    src = _sources(spark, a.sources)
    if a.check_sources and (found := null_identities(src)):
        raise SystemExit(f"rows without an identity: {found}")
    if a.command == "refresh-gold":
        summary = None
        if a.event_state:
            summary = event_state.advance(spark, os.path.join(a.sources, "portfolio_event"), a.event_state, params).state.read(event_state.TABLE)
        out = pipeline.refresh_gold(spark, src, a.gold, params, max_parallel=a.parallel, event_summary=summary)
    elif a.command == "refresh-silver":
        out = pipeline.refresh_silver(spark, src, a.gold, a.silver, params)
    else:
        out = {"created": pipeline.create_views(spark, a.sources, a.gold, a.silver, params)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
