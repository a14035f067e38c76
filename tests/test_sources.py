import pytest

from ledgerline.sources import CONTRACTS, SOURCE_TABLES, Sources
from ledgerline.sources.fixtures import FIXTURE_COLUMNS


def test_fixture_schemas_as_declared(spark, sf_dir):
    from ledgerline.sources import Sources

    raw = Sources.from_testdata(spark, sf_dir)._build
    for name in SOURCE_TABLES:
        df = raw(name)
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        assert got == [(c, t) for c, t in FIXTURE_COLUMNS[name]], name


def test_conformed_tables_carry_the_contract(src):
    for name in SOURCE_TABLES:
        cols = set(src[name].columns)
        assert set(CONTRACTS[name]) <= cols, name


def test_fixtures_grow_with_the_data(spark):
    """Requests, events, bids and parties follow the carrier tables, and no event or line item is dropped."""
    def facts(folder):
        s = Sources.from_testdata(spark, folder)
        events, items = (spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("events", "lineitem"))
        assert s["request"].count() == s["portfolio_event"].count() == events
        assert s["portfolio_bid"].count() == items
        return [s["request"].select("DebtAccountId").distinct().count(), s["portfolio_event"].select("PortfolioId").distinct().count(),
                s["portfolio_bid"].select("BuyerId").distinct().count(), s["portfolio"].where("SellerId is not null").select("SellerId").distinct().count()]

    small, large = facts("/root/testdata/sf0.001"), facts("/root/testdata/sf0.01")
    assert all(9 <= b / a <= 11 for a, b in zip(small, large, strict=True)), (small, large)


def test_absent_columns_are_an_error_outside_the_fixtures(spark, src):
    frame = src["portfolio"].drop("SoldUtc")
    strict = Sources.from_frames(spark, {"portfolio": frame})
    with pytest.raises(ValueError, match="portfolio.*SoldUtc"):
        strict["portfolio"]
    assert "SoldUtc" in Sources.from_frames(spark, {"portfolio": frame}, pad=True)["portfolio"].columns


def test_names_are_broadcast_not_shuffled(spark):
    """Seller, buyer and creator names reach the facts of D04 to D07 and D12 by broadcast at sf0.1."""
    from ledgerline.params import Params
    from ledgerline.plans import gold

    s = Sources.from_testdata(spark, "/root/testdata/sf0.1")
    for product in (gold.d04_portfolio_aggregate, gold.d05_portfolio_bid, gold.d06_complaints, gold.d07_complaint_aggregate, gold.d12_postsale):
        plan = product(s, Params.testing())._jdf.queryExecution().executedPlan().toString()
        for key in ("_p_sid", "_p_bid", "SellerId", "BuyerId", "SellerGuid#", "BuyerGuid#", "CreatedByBusinessId"):
            for line in plan.splitlines():
                if "hashpartitioning" in line and "_p" + "n" not in line:
                    keys = line[line.index("hashpartitioning("):].rsplit(")", 1)[0]  # keys may be calls themselves
                    # D07 joins previous months on all party keys together, which is not a name lookup
                    assert keys.count(",") > 2 or key not in keys, (product.__name__, line.strip()[:200])


def test_a_wrong_type_is_an_error_that_names_the_column(spark, src):
    from pyspark.sql import functions as F

    good = src["portfolio"]
    for column, dtype in [("PurchasePriceAmount", "string"), ("SoldUtc", "string"), ("Status", "int"), ("Id", "double")]:
        frame = good.withColumn(column, F.lit(None).cast(dtype))
        with pytest.raises(ValueError, match=f"portfolio.*{column} is {dtype}"):
            Sources.from_frames(spark, {"portfolio": frame})["portfolio"]
    wider = good.withColumn("PurchasePriceAmount", F.col("PurchasePriceAmount").cast("double")).withColumn("SoldUtc", F.col("SoldUtc").cast("date"))
    assert Sources.from_frames(spark, {"portfolio": wider})["portfolio"].columns == good.columns  # other types that hold the same are fine


def test_rows_without_an_identity_are_counted(spark, src):
    from pyspark.sql import functions as F

    from ledgerline.sources.contracts import IDENTITY, null_identities

    tables = {t: src[t] for t in IDENTITY}
    assert null_identities(tables) == {}
    n = tables["auction"].count()
    tables["auction"] = tables["auction"].withColumn("Id", F.lit(None).cast("string"))
    assert null_identities(tables) == {"auction": n}


@pytest.mark.parametrize("name", ["d01_portfolio", "d02_business", "d03_portfolio_row", "d05_portfolio_bid", "d06_complaints", "d12_postsale"])
def test_every_output_column_has_values(src, name):
    """So a wrong mapping of any column shows in the comparison with the oracle."""
    from pyspark.sql import functions as F

    from ledgerline.params import Params
    from ledgerline.plans import gold

    df = getattr(gold, name)(src, Params.testing())
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    assert [c for c, n in row.items() if not n] == []


def test_every_request_has_an_account(spark, tmp_path):
    """Requests are dealt over the orders that have line items, in key order, also where keys are missing."""
    from ledgerline.plans import common as C

    sf = "/root/testdata/sf0.001"
    for table in ("events", "orders"):
        spark.read.parquet(f"{sf}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    items = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey % 3 <> 1")
    items = items.withColumn("l_orderkey", items["l_orderkey"] * 7001).unionByName(items.limit(1).selectExpr("* except (l_orderkey)", "cast(null as bigint) as l_orderkey"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    src = Sources.from_testdata(spark, str(tmp_path))
    keys = sorted(r[0] for r in items.where("l_orderkey is not null").select("l_orderkey").distinct().collect())
    quarter = len(keys) // 4
    got = [(r["Id"], r["DebtAccountId"]) for r in src["request"].select("Id", "DebtAccountId").collect()]
    assert len(got) == spark.read.parquet(f"{sf}/events.parquet").count()
    assert all(account.split("-")[0] == str(keys[i % quarter * 4 + i % quarter % 4]) for i, account in got)
    paid = {a for i, a in got if i % 8 == 1}
    assert {r["DebtAccountId"] for r in C.pifsif_hits(src).collect()} == paid


def test_requests_in_steps_are_the_requests(spark):
    """The steps give the rows of the one query, with repeated, NULL and far apart order keys; all line items are grouped by order once."""
    from ledgerline.sources.fixtures import FIXTURE_SQL, REQUEST_STEPS

    events = spark.range(500).selectExpr("case when id % 50 = 7 then null else id end as event_id", "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) as ts")
    lineitem = spark.range(3000).selectExpr("case when id % 41 = 0 then null else (id % 700) * 37 end as l_orderkey", "cast(id % 5 as int) as l_linenumber",
                                            "id % 90 as l_partkey", "id % 8 as l_suppkey", "cast(id as double) / 7 as l_extendedprice")
    frames = {"events": events, "lineitem": lineitem}
    want = spark.sql(FIXTURE_SQL["request"], **frames)
    frames["request_order"] = spark.sql(REQUEST_STEPS["request_order"], lineitem=lineitem)
    frames["request_span"] = spark.sql(REQUEST_STEPS["request_span"], request_order=frames["request_order"])
    got = spark.sql(REQUEST_STEPS["request"], **{k: v for k, v in frames.items() if k != "lineitem"})
    assert got.schema == want.schema and got.where("DebtAccountId is not null").count() > 400
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "{lineitem}" not in REQUEST_STEPS["request"]


def test_large_projections_are_read_again_and_only_the_requests_kept(spark, monkeypatch):
    """Whole rows of large tables do not fill the executors' memory and disk."""
    from ledgerline.sources import Sources, loader

    sf = "/root/testdata/sf0.001"
    small = Sources.from_testdata(spark, sf, cache=True)
    assert "InMemoryRelation" in small["portfolio_bid"]._jdf.queryExecution().withCachedData().toString()
    spark.catalog.clearCache()
    monkeypatch.setattr(loader, "DEFAULT_BROADCAST_LIMIT", 1024)
    large = Sources.from_testdata(spark, sf, cache=True)
    for name, kept in (("portfolio_bid", False), ("portfolio", False), ("complaint", False), ("request", True)):
        assert ("InMemoryRelation" in large[name]._jdf.queryExecution().withCachedData().toString()) is kept, name
    assert large["portfolio_bid"].count() == small["portfolio_bid"].count()
