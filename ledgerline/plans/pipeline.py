"""Refresh jobs D21 (gold) and D22 (silver), and the live views over their
persisted tables.

Each step materialises one product as a parquet table under an output root
(full rebuild) and reports its wall seconds, like the reference's
orchestrators print per step. Gold steps are independent of one another; each
table is checked against its row law (``laws``), and the set of eight is
published as one generation (``publish``). The silver step reads the
Portfolio and Business of one published generation, cuts lineage at the
staging table FormulaComplete, and removes the staging tables at the end.
Writing whole tables to the shared output root also means a lost executor only
recomputes the tasks of the current step.
"""

from __future__ import annotations

import hashlib
import os
import time
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Params
from ..sources import Sources
from . import common, gold, laws, publish, silver, staging, views
from .publish import CATALOG_PREFIX, fs_path as _fs_path

GOLD_STEPS: list[tuple[str, Callable]] = [
    ("Portfolio", gold.d01_portfolio),
    ("Business", gold.d02_business),
    ("Portfolio_Row", gold.d03_portfolio_row),
    ("Portfolio_Aggregate", gold.d04_portfolio_aggregate),
    ("Portfolio_Bid", gold.d05_portfolio_bid),
    ("Complaints", gold.d06_complaints),
    ("Complaint_Aggregate", gold.d07_complaint_aggregate),
    ("PostSale", gold.d12_postsale),
]
SILVER_TABLE = "_EC_Portfolio_Expanded"
# staging tables of the silver refresh, in the order of the reference's steps
STAGES = ["PortfolioEvents", "PortfolioFunding", "AccountFold", "RowAggregates", "BidAggregates", "PostSaleAggregates",
          "ComplaintsByBuyer", "ComplaintsByPortfolio", "SilverBase", "FormulaComplete"]
STAGING_TABLES = STAGES


def ensure_layers(spark: SparkSession, *schemas: str) -> None:
    """Create the layer schemas (databases) if they are missing."""
    for name in schemas:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def _target(root: str, name: str) -> tuple[str, str]:
    """A root is a folder (parquet per table) or ``catalog:<schema>`` (tables
    in the session catalog, e.g. a metastore schema per layer)."""
    if root.startswith(CATALOG_PREFIX):
        return "table", f"`{root[len(CATALOG_PREFIX):]}`.`{name}`"
    return "path", os.path.join(root, name)


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild of one table (K01): write the new version beside the old
    one, move the old one aside, move the new one in, then delete the old. A
    job that fails while writing leaves the previous table intact; if the
    driver dies between the two moves, the previous version is still there
    under ``._previous`` and ``read_table`` finds it."""
    spark = df.sparkSession
    base = path.rstrip("/")
    df.write.mode("overwrite").parquet(base + "._incoming")
    target, fs = _fs_path(spark, path)
    staged, _ = _fs_path(spark, base + "._incoming")
    aside, _ = _fs_path(spark, base + "._previous")
    if fs.exists(target):
        fs.delete(aside, True)
        if not fs.rename(target, aside):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        raise OSError(f"could not move {base}._incoming to {path}")
    fs.delete(aside, True)


def save_table(df: DataFrame, schema: str, name: str) -> None:
    """The same for a catalog table: build under another name, then rename."""
    spark = df.sparkSession
    target, incoming, aside = (f"`{schema}`.`{name}{end}`" for end in ("", "__incoming", "__previous"))
    spark.sql(f"DROP TABLE IF EXISTS {incoming}")
    # a build that failed half-way leaves files without a table under this reserved name
    leftover, fs = _fs_path(spark, f"{spark.catalog.getDatabase(schema).locationUri}/{name.lower()}__incoming")
    fs.delete(leftover, True)
    df.write.format("parquet").saveAsTable(incoming)
    if spark.catalog.tableExists(f"{schema}.{name}"):
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {incoming} RENAME TO {target}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")


def save(df: DataFrame, root: str, name: str) -> None:
    kind, where = _target(root, name)
    if kind == "table":
        save_table(df, root[len(CATALOG_PREFIX):], name)
    else:
        write_table(df, where)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the published generation, where the root has one that holds
    it; else the table of that name, its previous version if a swap was cut
    off. Tables read one by one may come from two refreshes: readers that need
    one take ``publish.current`` once."""
    published = publish.current(spark, root)
    if published and name in published.rows:
        return published.read(name)
    kind, where = _target(root, name)
    if kind == "table":
        schema = root[len(CATALOG_PREFIX):]
        cut_off = not spark.catalog.tableExists(f"{schema}.{name}") and spark.catalog.tableExists(f"{schema}.{name}__previous")
        return spark.table(f"`{schema}`.`{name}__previous`" if cut_off else where)
    if not _exists(spark, root, name) and _exists(spark, root, name + "._previous"):
        where += "._previous"
    return spark.read.parquet(where)


def _timed(fn) -> float:
    t0 = time.monotonic()
    fn()
    return time.monotonic() - t0


def _run_steps(spark: SparkSession, steps: list[tuple[str, Callable[[], None]]], max_parallel: int) -> dict[str, float]:
    """Run independent steps as concurrent Spark jobs (one driver thread each);
    the scheduler interleaves their stages, so one step's stragglers overlap
    with another step's work. Seconds per step, in step order."""
    def one(item):
        name, action = item
        spark.sparkContext.setJobDescription(f"ledgerline refresh: {name}")
        return name, _timed(action)

    if max_parallel <= 1:
        return dict(one(it) for it in steps)
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        done = dict(pool.map(one, steps))
    return {n: done[n] for n, _ in steps}


SUMMARY_STEP = "PortfolioEventSummary"
LAWS_STEP = "RowLaws"


def _exists(spark: SparkSession, root: str, name: str) -> bool:
    kind, where = _target(root, name)
    if kind == "table":
        return spark.catalog.tableExists(where.replace("`", ""))
    p, fs = _fs_path(spark, where)
    return fs.exists(p)


def summary_name(params: Params) -> str:
    """Name of the event summary for these event literals: the summary bakes
    them in, so a refresh with other literals must not read it."""
    literals = (params.listed_event, params.awarded_event, params.psa_event, params.sold_event, params.funding_events)
    return f"{common.EVENT_SUMMARY}_{hashlib.md5(repr(literals).encode()).hexdigest()[:10]}"


def published_gold(spark: SparkSession, gold_root: str) -> publish.Published:
    """The published gold tables, all of one refresh."""
    found = publish.current(spark, gold_root)
    if found is None:
        raise FileNotFoundError(f"no gold refresh was published in {gold_root}")
    return found


def with_shared_tables(src: Sources, tables: publish.Published, params: Params) -> Sources:
    """Sources plus the event summary a gold refresh materialised for the same
    event literals; with other literals the products read the event log."""
    name = summary_name(params)
    return src.with_tables(**{common.EVENT_SUMMARY: tables.read(name)}) if name in tables.rows else src


def warn_unmatched_events(summary: DataFrame, params: Params) -> list[str]:
    """Names of the own-definition event literals that match no event; they
    leave their dates NULL for every portfolio, so this is warned about."""
    found = summary.agg(F.count("PSAConfirmedUtc").alias("psa_event"), F.count("SoldEventUtc").alias("sold_event"),
                        F.coalesce(F.sum("FundingEventCount"), F.lit(0)).alias("funding_events")).first()
    missing = [n for n in ("psa_event", "sold_event", "funding_events") if not found[n]]
    for n in missing:
        warnings.warn(f"no portfolio event matches {n}={getattr(params, n)!r}; set Params.{n}", stacklevel=2)
    return missing


def refresh_gold(spark: SparkSession, src: Sources, gold_root: str, params: Params | None = None,
                 max_parallel: int = 4, verify: bool = True, event_summary: DataFrame | None = None) -> dict[str, float]:
    """Build the eight gold tables and publish them as one generation;
    seconds per step. The per-portfolio event summary (one pass over the event
    log) is materialised first and read by every product instead of each
    scanning the log. No gold table reads another, so the steps then run
    concurrently (``max_parallel=1``: the reference's serial order).

    ``event_summary``: the summary kept as state (``event_state.advance``, for
    the same literals), instead of a scan of the whole log.
    ``verify``: every table's rows must meet its row law, or the refresh
    raises. Whatever fails, readers keep the generation published before."""
    params = common.params_or_default(params)  # one clock for the whole refresh
    if gold_root.startswith(CATALOG_PREFIX):
        ensure_layers(spark, gold_root[len(CATALOG_PREFIX):])
    draft, summary = publish.Draft(spark, gold_root), summary_name(params)

    wanted: dict[str, int] = {}
    tables = [n for n, _ in GOLD_STEPS]
    try:
        seconds = {SUMMARY_STEP: _timed(lambda: draft.build(summary, common.event_summary(src, params) if event_summary is None else event_summary))}
        shared = src.with_tables(**{common.EVENT_SUMMARY: draft.read(summary)})
        steps = [(n, (lambda b=b, n=n: draft.build(n, b(shared, params)))) for n, b in GOLD_STEPS]
        if verify:
            steps.append((LAWS_STEP, lambda: wanted.update(laws.expected(tables, shared, params))))
        seconds.update(_run_steps(spark, steps, max_parallel))
        for n in wanted:
            laws.check(n, draft.rows[n], wanted[n])
        draft.publish()
    except Exception:
        draft.discard()
        raise
    return seconds


def drop_tables(spark: SparkSession, root: str, names: list[str]) -> None:
    """Remove staging tables (DROP TABLE, or a Hadoop FileSystem delete
    of their folders)."""
    for n in names:
        kind, where = _target(root, n)
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {where}")
            continue
        p, fs = _fs_path(spark, where)
        fs.delete(p, True)


def refresh_silver(spark: SparkSession, src: Sources, gold_root: str, silver_root: str,
                   params: Params | None = None) -> dict[str, float]:
    """Staging D14–D18 and D20, each a table of its own (one row per
    portfolio, so lineage stays short and a lost executor costs one step),
    then the expanded table D13, then drop staging; seconds per step. Warns
    about own-definition event literals that match nothing."""
    params = common.params_or_default(params)
    if silver_root.startswith(CATALOG_PREFIX):
        staging_root = silver_root + "_staging"
        ensure_layers(spark, silver_root[len(CATALOG_PREFIX):], staging_root[len(CATALOG_PREFIX):])
    else:
        staging_root = os.path.join(silver_root, "_staging")
    tables = published_gold(spark, gold_root)
    src = with_shared_tables(src, tables, params)
    warn_unmatched_events(common.event_summary(src, params), params)
    portfolio, business = tables.read("Portfolio"), tables.read("Business")
    seconds: dict[str, float] = {}
    built: dict[str, DataFrame] = {}

    def step(name: str, df: DataFrame) -> None:
        seconds[name] = _timed(lambda: save(df, staging_root, name))
        built[name] = read_table(spark, staging_root, name)

    step("PortfolioEvents", staging.d14_portfolio_events(src, params))
    step("PortfolioFunding", staging.d15_portfolio_funding(src, params))
    step("AccountFold", staging.account_fold(src, params))  # the accounts are read once
    folded = staging.from_fold(built["AccountFold"])
    step("RowAggregates", folded["RowAggregates"])
    step("BidAggregates", staging.d17a_bid_aggregates(src, params))
    step("PostSaleAggregates", folded["PostSaleAggregates"])
    step("ComplaintsByPortfolio", folded["ComplaintsByPortfolio"])
    step("ComplaintsByBuyer", staging.d17c_complaints_by_buyer(src, params, by_pid=built["ComplaintsByPortfolio"]))
    step("SilverBase", staging.d18_silver_base(src, params, portfolio=portfolio, business=business, built=built))
    step("FormulaComplete", staging.d20_formula_complete(src, params, base=built["SilverBase"]))
    expanded = silver.d13_silver_expanded(src, params, formula=built["FormulaComplete"])
    seconds[SILVER_TABLE] = _timed(lambda: save(expanded, silver_root, SILVER_TABLE))
    drop_tables(spark, staging_root, STAGING_TABLES)
    return seconds


def live_views(spark: SparkSession, src: Sources, gold_root: str, silver_root: str,
               params: Params | None = None) -> dict[str, DataFrame]:
    """D08–D11 as lazy DataFrames over the persisted tables."""
    params = common.params_or_default(params)
    tables = published_gold(spark, gold_root)
    src = with_shared_tables(src, tables, params)
    expanded = read_table(spark, silver_root, SILVER_TABLE)
    return {
        "VW_Bidders": views.d08_bidders(src, params, expanded=expanded,
                                        bids=tables.read("Portfolio_Bid"), business=tables.read("Business")),
        "VW_Boardmembers_EC_Portfolio_Bid": views.d09_board_bid(src, params),
        "VW_Boardmembers_Buyer_Activity": views.d10_buyer_activity(src, params, expanded=expanded),
        "VW_Boardmembers_ForwardFlow": views.d11_forward_flow(src, params, expanded=expanded),
    }


def register_views(spark: SparkSession, src: Sources, gold_root: str, silver_root: str,
                   params: Params | None = None) -> list[str]:
    """Publish the live views under their names (session temp views)."""
    names = []
    for name, df in live_views(spark, src, gold_root, silver_root, params).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def view_sql(sources: str, gold_schema: str, silver_schema: str, params: Params) -> dict[str, str]:
    """The four live views as SQL over catalog tables. The viewers of a
    portfolio only add rows without a bid, which VW_Bidders drops (Catalyst
    removes that side from the DataFrame form too), so they are left out."""
    expanded = f"`{silver_schema}`.`{SILVER_TABLE}`"
    return {
        "VW_Bidders": f"""
WITH lots AS (SELECT collate(PortfolioNumber, '{views.COLLATION}') AS pid, PortfolioCloseUtc AS closed FROM {expanded}
              WHERE Status <> 'Purged' AND year(PortfolioCloseUtc) > {params.min_close_year}),
     bidders AS (SELECT DISTINCT collate(PortfolioNumber, '{views.COLLATION}') AS pid, collate(BuyerId, '{views.COLLATION}') AS bidder
                 FROM `{gold_schema}`.`Portfolio_Bid` WHERE Status IS NOT NULL),
     parties AS (SELECT collate(Id, '{views.COLLATION}') AS bidder, ClientId, BusinessName FROM `{gold_schema}`.`Business`)
SELECT DISTINCT c.ClientId AS BidderClientId, n.BusinessName AS BuyerName, month(lots.closed) AS BidderMonth, year(lots.closed) AS BidderYear
FROM lots JOIN bidders ON bidders.pid = lots.pid
LEFT JOIN parties c ON c.bidder = bidders.bidder LEFT JOIN parties n ON n.bidder = bidders.bidder""",
        "VW_Boardmembers_EC_Portfolio_Bid": f"""
SELECT bid.*, firm.ClientId, firm_client.Name AS ClientName FROM `{sources}`.`joined_portfolio_bid` bid
LEFT JOIN `{sources}`.`business` firm ON firm.Id = bid.BuyerId LEFT JOIN `{sources}`.`client` firm_client ON firm_client.Id = firm.ClientId""",
        "VW_Boardmembers_Buyer_Activity": f"""
SELECT BuyerClientId, max(PortfolioCloseUtc) AS MaxDate, min(PortfolioCloseUtc) AS MinDate FROM {expanded}
WHERE BuyerClientId IS NOT NULL GROUP BY BuyerClientId HAVING max(PortfolioCloseUtc) IS NOT NULL""",
        "VW_Boardmembers_ForwardFlow": f"""
SELECT agreement.Id, agreement.EndDate, flow.ForwardFlowAgreementId, flow.MaxUploadDate
FROM `{sources}`.`forward_flow_agreement` agreement
JOIN (SELECT ForwardFlowAgreementId, max(UploadDateUtc) AS MaxUploadDate FROM {expanded}
      WHERE ForwardFlowAgreementId IS NOT NULL GROUP BY ForwardFlowAgreementId HAVING count(*) > 1) flow
  ON flow.ForwardFlowAgreementId = agreement.Id""",
    }


def create_views(spark: SparkSession, sources: str, gold_root: str, silver_root: str, params: Params | None = None) -> list[str]:
    """The live views as persistent views of the silver schema. All three
    roots must be ``catalog:<schema>``: a stored view can only name catalog
    tables."""
    roots = {"sources": sources, "gold": gold_root, "silver": silver_root}
    folders = [n for n, r in roots.items() if not r.startswith(CATALOG_PREFIX)]
    if folders:
        raise ValueError(f"persistent views need catalog:<schema> roots; these are folders: {folders}")
    schemas = [r[len(CATALOG_PREFIX):] for r in roots.values()]
    made = []
    for name, sql in view_sql(*schemas, common.params_or_default(params)).items():
        spark.sql(f"CREATE OR REPLACE VIEW `{schemas[2]}`.`{name}` AS {sql}")
        made.append(f"{schemas[2]}.{name}")
    return made


def run_views(spark: SparkSession, src: Sources, gold_root: str, silver_root: str,
              params: Params | None = None, max_parallel: int = 4) -> dict[str, float]:
    """Evaluate every view fully (noop sink) and time it."""
    views_ = live_views(spark, src, gold_root, silver_root, params)
    steps = [(n, (lambda d=d: d.write.format("noop").mode("overwrite").save())) for n, d in views_.items()]
    return _run_steps(spark, steps, max_parallel)

