"""Refresh jobs: idempotent, views over persisted tables, row-count laws."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.params import Params
from ledgerline.plans import gold, pipeline, views


def _snapshot(spark, root, name):
    df = pipeline.read_table(spark, root, name)
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_gold_refresh_idempotent_and_silver_views(spark, src):
    prm = Params.testing()
    root = tempfile.mkdtemp(prefix="ledgerline-test-")
    g, s = os.path.join(root, "gold"), os.path.join(root, "silver")
    secs = pipeline.refresh_gold(spark, src, g, prm)
    assert list(secs) == [pipeline.SUMMARY_STEP] + [n for n, _ in pipeline.GOLD_STEPS] + [pipeline.LAWS_STEP]
    first = {n: _snapshot(spark, g, n) for n, _ in pipeline.GOLD_STEPS}
    pipeline.refresh_gold(spark, src, g, prm)
    assert first == {n: _snapshot(spark, g, n) for n, _ in pipeline.GOLD_STEPS}
    assert list(pipeline.refresh_silver(spark, src, g, s, prm)) == [
        "PortfolioEvents", "PortfolioFunding", "AccountFold", "RowAggregates", "BidAggregates", "PostSaleAggregates", "ComplaintsByPortfolio",
        "ComplaintsByBuyer", "SilverBase", "FormulaComplete", pipeline.SILVER_TABLE]
    assert not os.path.exists(os.path.join(s, "_staging", "FormulaComplete"))
    vs = pipeline.live_views(spark, src, g, s, prm)
    lazy_bidders = views.d08_bidders(src, prm)
    assert sorted(vs["VW_Bidders"].collect()) == sorted(lazy_bidders.collect())
    assert "VW_Boardmembers_ForwardFlow" in pipeline.register_views(spark, src, g, s, prm)
    assert spark.table("VW_Boardmembers_ForwardFlow").count() == views.d11_forward_flow(src, prm).count()
    assert sorted(os.listdir(g)) == ["_generations", "_manifests"]
    # other event literals must not be answered from the summary of these
    other = prm.with_(psa_event="listed")
    pipeline.refresh_silver(spark, src, g, s, other)
    from ledgerline.plans import silver

    lazy = silver.d13_silver_expanded(src, other).where("PSAConfirmedUtc is not null").count()
    assert spark.read.parquet(os.path.join(s, pipeline.SILVER_TABLE)).where("PSAConfirmedUtc is not null").count() == lazy > 0


def _broken(spark):
    return spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken on purpose"))).otherwise(F.col("id")).alias("x"))


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_failed_rebuild_keeps_the_old_table(spark, kind):
    root = tempfile.mkdtemp(prefix="ledgerline-swap-") if kind == "folder" else "catalog:ll_swap_test"
    if kind == "catalog":
        pipeline.ensure_layers(spark, "ll_swap_test")
    pipeline.save(spark.range(5), root, "T")
    with pytest.raises(Exception, match="broken on purpose"):
        pipeline.save(_broken(spark), root, "T")
    assert pipeline.read_table(spark, root, "T").count() == 5
    pipeline.save(spark.range(7), root, "T")
    assert pipeline.read_table(spark, root, "T").count() == 7
    if kind == "folder":
        os.rename(os.path.join(root, "T"), os.path.join(root, "T._previous"))  # a swap cut off between its moves
    else:
        spark.sql("ALTER TABLE ll_swap_test.T RENAME TO ll_swap_test.T__previous")
    assert pipeline.read_table(spark, root, "T").count() == 7
    pipeline.save(spark.range(2), root, "T")
    assert pipeline.read_table(spark, root, "T").count() == 2
    if kind == "catalog":
        spark.sql("DROP SCHEMA IF EXISTS ll_swap_test CASCADE")


def test_unmatched_event_literals_are_reported(spark, src):
    from ledgerline.plans import common

    prm = Params.testing().with_(sold_event="no such event")
    with pytest.warns(UserWarning, match="sold_event"):
        assert pipeline.warn_unmatched_events(common.event_summary(src, prm), prm) == ["sold_event"]


def test_portfolio_aggregate_row_law(src):
    prm = Params.testing()
    pa = src["portfolio_aggregate"]
    p = src["portfolio"].select(F.col("Id").alias("pid"), "SellerId")
    n = src["business_name"].filter("EndDateUtc is null").select("BusinessId")
    b = src["business"].select(F.col("Id").alias("bid"))
    expected = (pa.join(p, pa["PortfolioId"] == p["pid"]).join(b, F.col("SellerId") == b["bid"])
                .join(n, F.col("bid") == n["BusinessId"]).count())
    assert gold.d04_portfolio_aggregate(src, prm).count() == expected


def test_bidders_full_outer_join_is_redundant(src):
    """Catalyst drops the viewer side: same rows without it."""
    prm = Params.testing()
    full = views.d08_bidders(src, prm)
    plan = full._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_refresh_into_catalog_schemas(spark, src):
    prm = Params.testing()
    pipeline.ensure_layers(spark, "ll_gold_test")
    steps = pipeline.GOLD_STEPS
    try:
        pipeline.GOLD_STEPS = [s for s in steps if s[0] in ("Portfolio", "Business")]
        pipeline.refresh_gold(spark, src, "catalog:ll_gold_test", prm, max_parallel=2)
    finally:
        pipeline.GOLD_STEPS = steps
    assert spark.table("ll_gold_test.Portfolio").count() == gold.d01_portfolio(src, prm).count()
    spark.sql("DROP SCHEMA IF EXISTS ll_gold_test CASCADE")


def test_command_line_refresh(spark, src, capsys):
    import json

    from ledgerline.__main__ import main
    from ledgerline.sources import write_sources

    root = tempfile.mkdtemp(prefix="ledgerline-cli-")
    write_sources(src, os.path.join(root, "src"))
    args = ["--sources", os.path.join(root, "src"), "--gold", os.path.join(root, "gold"),
            "--as-of-utc", "2001-06-30", "--as-of-local", "2024-06-30"]
    main(["refresh-gold", *args])
    gold_secs = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(gold_secs) == {pipeline.SUMMARY_STEP, pipeline.LAWS_STEP} | {n for n, _ in pipeline.GOLD_STEPS}
    main(["refresh-silver", *args, "--silver", os.path.join(root, "silver")])
    assert spark.read.parquet(os.path.join(root, "silver", pipeline.SILVER_TABLE)).count() > 0


def test_expanded_table_row_count_law(src):
    """|D13| = sum over kept FormulaComplete rows of
    max(1, goals of the listed month) * max(1, distinct macro rows of the close quarter)."""
    from ledgerline.plans import silver, staging

    prm = Params.testing()
    f = staging.d20_formula_complete(src, prm).filter(
        (F.coalesce("SellerLegalName", F.lit("")) != prm.excluded_seller_legal_name)
        & (F.coalesce("SellerClientName", F.lit("")) != prm.excluded_seller_client))
    goals = (silver.goals_by_month(src, prm).groupBy("GoalYear", "GoalMonth").count()
             .withColumnRenamed("count", "g"))
    macro = (silver.macro_by_quarter(src).groupBy("MacroeconomicDateYear", "MacroeconomicDateQuarter").count()
             .withColumnRenamed("count", "m"))
    x = (f.select("ListedUtcYear", "ListedUtcMonth", F.year("PortfolioCloseUtc").alias("y"),
                  F.quarter("PortfolioCloseUtc").alias("q"))
         .join(goals, (F.col("ListedUtcYear") == F.col("GoalYear")) & (F.col("ListedUtcMonth") == F.col("GoalMonth")), "left")
         .join(macro, (F.col("y") == F.col("MacroeconomicDateYear")) & (F.col("q") == F.col("MacroeconomicDateQuarter")), "left"))
    law = x.select(F.sum(F.greatest(F.coalesce("g", F.lit(1)), F.lit(1))
                         * F.greatest(F.coalesce("m", F.lit(1)), F.lit(1))).alias("n")).first()["n"]
    assert silver.d13_silver_expanded(src, prm).count() == law


def test_portfolio_row_count_law(src):
    """D03 is unaffected by the scrub/payment satellites (first hit only) but
    multiplied by repeated commercial rows: |D03| = sum over accounts of
    sale portfolios of max(1, commercial rows of the account)."""
    prm = Params.testing()
    pid = gold.sale_portfolios(src, prm).select("_p_id")
    pr = src["portfolio_row"].select("PortfolioRowGuid", "PortfolioId")
    comm = src["portfolio_row_commercial"].groupBy(F.col("PortfolioRowGuid").alias("g")).count()
    x = (pr.join(pid, pr["PortfolioId"] == pid["_p_id"])
         .join(comm, pr["PortfolioRowGuid"] == comm["g"], "left"))
    law = x.select(F.sum(F.coalesce("count", F.lit(1))).alias("n")).first()["n"]
    assert gold.d03_portfolio_row(src, prm).count() == law


def test_postsale_row_count_law(src):
    """D12 keeps the multiplication by optional satellites and by the
    open names of seller and buyer."""
    prm = Params.testing()
    one = F.lit(1)

    def per(df, key, name):
        return df.groupBy(F.col(key).alias(f"_{name}")).agg(F.count(one).alias(name))

    r = src["request"].select("Id", "RequestType", "DebtAccountId", "FundingNotificationId")
    rt = src["request_type"].select(F.col("Id").alias("_rt"))
    pr = src["portfolio_row"].select(F.col("PortfolioRowGuid").alias("_g"), F.col("PortfolioId").alias("_pid"))
    p = src["portfolio"].select(F.col("Id").alias("_p"), "SellerId", "BuyerId", "SellerUploadTemplateId")
    t = src["template"].select(F.col("Id").alias("_t"))
    names = src["business_name"].filter("EndDateUtc is null")
    sn = per(names, "BusinessId", "sn")
    bn = per(names.select("BusinessId"), "BusinessId", "bn")
    x = (r.join(rt, r["RequestType"] == rt["_rt"]).join(pr, r["DebtAccountId"] == pr["_g"])
         .join(p, F.col("_pid") == p["_p"]).join(t, F.col("SellerUploadTemplateId") == t["_t"])
         .join(sn, F.col("SellerId") == sn["_sn"], "left").join(bn, F.col("BuyerId") == bn["_bn"], "left"))
    factors = ["sn", "bn"]
    for name in ("info", "legal", "other", "fraud", "bankrupt", "pifsif"):
        s = per(src[name], "RequestId", name)
        x = x.join(s, x["Id"] == s[f"_{name}"], "left")
        factors.append(name)
    fn = per(src["funding_notification"], "Id", "fund")
    x = x.join(fn, x["FundingNotificationId"] == fn["_fund"], "left")
    factors.append("fund")
    prod = one
    for c in factors:
        prod = prod * F.greatest(F.coalesce(F.col(c), one), one)
    law = x.select(F.sum(prod).alias("n")).first()["n"]
    assert gold.d12_postsale(src, prm).count() == law


def test_persistent_views_are_read_by_a_new_session(spark, src):
    from ledgerline.sources import Sources
    from ledgerline.sources.layout import write_source_tables

    prm = Params.testing()
    schemas = ["ll_view_src", "ll_view_gold", "ll_view_silver"]
    try:
        write_source_tables(spark, src, schemas[0], 4)
        roots = [f"catalog:{s}" for s in schemas]
        catalog = Sources.from_catalog(spark, schemas[0])
        pipeline.refresh_gold(spark, catalog, roots[1], prm)
        pipeline.refresh_silver(spark, catalog, roots[1], roots[2], prm)
        made = pipeline.create_views(spark, *roots, prm)
        other = spark.newSession()
        for name, df in pipeline.live_views(spark, catalog, roots[1], roots[2], prm).items():
            assert f"{schemas[2]}.{name}" in made
            stored = other.table(f"{schemas[2]}.{name}")
            assert stored.columns == df.columns
            assert sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect())), name
        with pytest.raises(ValueError, match="folders"):
            pipeline.create_views(spark, "/tmp/sources", *roots[1:], prm)
    finally:
        for s in [*schemas, schemas[2] + "_staging"]:
            spark.sql(f"DROP SCHEMA IF EXISTS {s} CASCADE")


def test_fold_equals_the_separate_aggregates_in_one_account_scan(spark, src, tmp_path):
    from ledgerline.plans import staging
    from ledgerline.sources import Sources

    prm = Params.testing()
    folded = staging.from_fold(staging.account_fold(src, prm))
    for name, separate in (("RowAggregates", staging.d16_row_aggregates), ("PostSaleAggregates", staging.d17b_postsale_aggregates),
                           ("ComplaintsByPortfolio", staging.d17d_complaints_by_pid)):
        want = separate(src, prm)
        assert folded[name].columns == want.columns
        assert sorted(map(repr, folded[name].collect())) == sorted(map(repr, want.collect())), name
    path = str(tmp_path / "accounts")
    src["portfolio_row"].write.parquet(path)
    stored = Sources.from_frames(spark, {n: (spark.read.parquet(path) if n == "portfolio_row" else src[n]) for n in src})

    def scans(df):
        return len(re.findall(r"(?<!InMemory)Relation \[PortfolioRowGuid", df._jdf.queryExecution().optimizedPlan().toString()))

    assert scans(staging.account_fold(stored, prm)) == 1
    fold = staging.account_fold(stored, prm)
    built = {"AccountFold": fold, "ComplaintsByBuyer": staging.d17c_complaints_by_buyer(src, prm)}
    assert scans(staging.d18_silver_base(stored, prm, built=built)) == 1
