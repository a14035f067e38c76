"""Relational helpers against their textbook forms on literal data."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import first_hit, heavy_keys, keyed_join, only_keys, prev_period_join, salted_join


def test_first_hit_equals_count_window_plus_row_number(spark):
    rows = [("a", 3, "x3"), ("a", 1, "x1"), ("a", 2, "x2"), ("b", 5, None), ("c", 9, "z")]
    df = spark.createDataFrame(rows, "k string, id int, v string")
    got = sorted(first_hit(df, "k", ["id"], ["v"], "n").collect())
    w = Window.partitionBy("k")
    ref = (df.withColumn("n", F.count(F.lit(1)).over(w))
           .withColumn("rn", F.row_number().over(w.orderBy("id"))).filter("rn = 1").select("k", "n", "v"))
    assert got == sorted(ref.collect())


def test_first_hit_handles_one_hot_key(spark):
    df = spark.range(0, 200000).select(F.lit("hot").alias("k"), F.col("id"), (F.col("id") * 2).alias("v"))
    df = df.unionByName(spark.createDataFrame([("cold", 7, 14)], "k string, id long, v long"))
    got = {r["k"]: (r["n"], r["v"]) for r in first_hit(df, "k", ["id"], ["v"], "n").collect()}
    assert got == {"hot": (200000, 0), "cold": (1, 14)}


def test_prev_period_join_wraps_year_and_matches_null_keys(spark):
    rows = [("T", None, 12, 2000, 5), ("T", None, 1, 2001, 7), ("T", "b", 1, 2001, 9), ("T", None, 3, 2001, 1),
            ("T", None, None, 2001, 4)]
    df = spark.createDataFrame(rows, "t string, g string, m int, y int, v int")
    out = prev_period_join(df, df, ["t"], ["g"], "m", "y", {"v": "pv"})
    got = sorted(((r["g"], r["m"], r["y"], r["pv"]) for r in out.collect()), key=repr)
    assert got == sorted([(None, 12, 2000, None), (None, 1, 2001, 5), ("b", 1, 2001, None), (None, 3, 2001, None),
                          (None, None, 2001, None)], key=repr)


def test_broadcast_only_behind_size_check(spark):
    from ledgerline.operators import broadcast_if_small, estimated_bytes

    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k2")
    assert estimated_bytes(small) is not None
    hinted = big.join(broadcast_if_small(small, limit=1 << 20), F.col("k2") == F.col("k"))
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plain = big.join(broadcast_if_small(small, limit=0), F.col("k2") == F.col("k"))
        assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_cluster_conf_sizes_partitions():
    from ledgerline.session import cluster_conf

    c = cluster_conf(100 * 1024**4, buckets=16384)
    assert int(c["spark.sql.shuffle.partitions"]) == 16384  # as many as buckets: the bucketed fact is not exchanged
    assert cluster_conf(10 * 1024**3, buckets=16384)["spark.sql.shuffle.partitions"] == "16384"
    assert cluster_conf(100 * 1024**4)["spark.sql.shuffle.partitions"] == "32768"
    assert cluster_conf(100 * 1024**3)["spark.sql.shuffle.partitions"] == "400"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_first_hit_null_order_value_sorts_first(spark):
    rows = [("a", None, "xnull"), ("a", "1", "x1"), ("b", "2", "y2")]
    df = spark.createDataFrame(rows, "k string, id string, v string")
    got = sorted(tuple(r) for r in first_hit(df, "k", ["id"], ["v"], "n").collect())
    assert got == [("a", 2, "xnull"), ("b", 1, "y2")]


def _task_rows(df):
    """Rows per non-empty task of a frame's last stage."""
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_salted_join_deals_out_a_portfolio_with_a_third_of_the_rows(spark):
    """Same rows as the plain join, for a hot key, NULL keys and repeated dim
    rows; and no task over twice the median, where the plain join has one."""
    n = 60_000
    fact = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 997 == 1, F.lit(None))
                                 .otherwise(F.concat(F.lit("p"), F.col("id") % 4000)).alias("pid"), F.col("id").cast("string").alias("guid"))
    dim = spark.createDataFrame([("hot", "a"), ("p7", "b"), ("p7", "b2"), (None, "z")] + [(f"p{i}", "c") for i in range(20, 4000)], "k string, v string")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for how in ("inner", "left"):
            plain = fact.join(dim, F.col("pid") == F.col("k"), how)
            salted = salted_join(fact, dim, "pid", "k", "guid", how, rows_per_task=100)
            assert sorted(map(repr, salted.select("pid", "guid", "v").collect())) == sorted(map(repr, plain.select("pid", "guid", "v").collect()))
        plain, salted = (_task_rows(d) for d in (fact.join(dim, F.col("pid") == F.col("k")), salted_join(fact, dim, "pid", "k", "guid", rows_per_task=100)))
        assert max(salted) <= 2 * salted[len(salted) // 2]
        assert max(plain) > 2 * plain[len(plain) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [tuple(r) for r in heavy_keys(fact, "pid", 1000).collect()] == [("hot", 20)]
    assert heavy_keys(fact.where("pid is null"), "pid", 10).collect() == []  # NULL joins nothing
    with pytest.raises(ValueError, match="inner or left"):
        salted_join(fact, dim, "pid", "k", "guid", "full")


def test_keyed_join_and_only_keys_by_size(spark):
    fact, dim = spark.range(100).select((F.col("id") % 10).alias("k"), "id"), spark.range(5).select(F.col("id").alias("d"))
    plans = {limit: keyed_join(fact, dim, "k", "d", "id", limit=limit)._jdf.queryExecution().optimizedPlan().toString() for limit in (0, 1 << 20)}
    assert "_salt_f" in plans[0] and "_salt_f" not in plans[1 << 20]
    cut = only_keys(fact, dim, "k", "d")
    assert cut.count() == 50 and cut.columns == fact.columns
    assert "LeftSemi" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_d03_satellites_meet_only_sale_accounts(src):
    """The semi join with the sale portfolios stands below every satellite join."""
    from ledgerline.params import Params
    from ledgerline.plans import gold

    plan = gold.d03_portfolio_row(src, Params.testing())._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line.strip(" :+-") for line in plan if "Join " in line]
    depth = {line: len(line) - len(line.lstrip(" :+-")) for line in plan}
    semi = [depth[line] for line in plan if "Join LeftSemi" in line]
    satellites = [depth[line] for line in plan if "Join LeftOuter" in line and "_dec_id" in line or "Join LeftOuter" in line and "_ac_id" in line]
    assert len(semi) == 1 and satellites and joins
    assert semi[0] > max(satellites)


def test_collation_of_ids(spark):
    """Case and trailing spaces are ignored; accents, kana and width are not."""
    from ledgerline.plans.views import ci

    cases = [("Abc", "aBC", True), ("ÉTÉ", "été", True), ("ab ", "AB", True), ("ete", "été", False), ("か", "カ", False), ("ｱ", "ア", False),
             ("Ａ", "A", False), ("Ａ", "ａ", True), (" ab", "ab", False), ("ß", "ss", False), (None, "a", None)]
    df = spark.createDataFrame(cases, "a string, b string, same boolean")
    for r in df.select("a", "b", "same", (ci(F.col("a")) == ci(F.col("b"))).alias("got")).collect():
        assert r.got == r.same, (r.a, r.b)
    left, right = df.select("a").where("a is not null").distinct(), df.select("b")
    joined = left.join(right, ci(left["a"]) == ci(right["b"]))
    assert "SortMergeJoin" in joined.hint("merge")._jdf.queryExecution().executedPlan().toString() or joined.count() > 0


@pytest.mark.parametrize("name", ["d03_portfolio_row", "d05_portfolio_bid", "d12_postsale"])
def test_products_are_the_same_when_salted(src, monkeypatch, name):
    """With no broadcast and a low threshold every product salts its heavy portfolios."""
    from ledgerline.params import Params
    from ledgerline.plans import gold

    prm, product = Params.testing(), getattr(gold, name)
    want = sorted(map(repr, product(src, prm).collect()))

    def salted(fact, dim, fact_key, dim_key, spread, how="inner", basis=None, keys_of=None):
        assert heavy_keys(keys_of, fact_key, 2).count() > 0
        return salted_join(fact, dim, fact_key, dim_key, spread, how, rows_per_task=2, keys_of=keys_of)

    monkeypatch.setattr(gold, "keyed_join", salted)
    monkeypatch.setattr(gold, "only_keys", lambda fact, *_, **__: fact)
    assert sorted(map(repr, product(src, prm).collect())) == want


def test_lookups_by_key_equal_plain_joins(spark):
    """Repeated and missing ids on both sides, references that find nothing, one row or several."""
    from ledgerline.operators import lookups_by_key

    fact = spark.createDataFrame([(1, "a", "b", "x"), (1, "a", "c", "y"), (2, "b", "b", "z"), (2, "b", "b", "z"), (3, None, "a", "u"), (4, "q", None, "v")],
                                 "k int, s string, b string, pay string")
    dim = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2), (None, 9), ("c", None)], "id string, v int")
    got = lookups_by_key(fact, "k", {"s": {"v": "sv"}, "b": {"v": "bv"}}, dim, "id")
    plain = fact.join(dim.selectExpr("id as i1", "v as sv"), fact["s"] == F.col("i1"), "left").join(dim.selectExpr("id as i2", "v as bv"), F.col("b") == F.col("i2"), "left")
    assert sorted(map(str, got.select("k", "s", "b", "pay", "sv", "bv").collect())) == sorted(map(str, plain.select("k", "s", "b", "pay", "sv", "bv").collect()))


def test_wide_rows_are_shuffled_once_beyond_the_broadcast_size(spark, sf_dir, monkeypatch):
    """D01, D06 and D18 with parties too large to broadcast: the same rows, the parties found by row id."""
    from collections import Counter

    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import gold, staging
    from ledgerline.sources import Sources

    src = Sources.from_testdata(spark, sf_dir)
    orphan = src["portfolio"].limit(40).withColumn("Id", F.lit(None).cast("string"))
    frames = {n: src[n] for n in src} | {"portfolio": src["portfolio"].unionByName(orphan).unionByName(src["portfolio"].limit(30))}
    src = Sources.from_frames(spark, frames)
    for product in (gold.d01_portfolio, gold.d06_complaints, staging.d18_silver_base):
        before = product(src, Params.testing())
        with monkeypatch.context() as m:
            m.setattr(relational, "DEFAULT_BROADCAST_LIMIT", -1)
            after = product(src, Params.testing())
        assert after.columns == before.columns
        assert Counter(map(str, after.collect())) == Counter(map(str, before.collect())), product.__name__
        assert after._jdf.queryExecution().optimizedPlan().toString().count("_lk_found") > 0, product.__name__


def test_dealt_by_key_is_the_inner_join(spark):
    """Keys of several parts, repeated rows on both sides, NULL keys; no part longer than about the limit."""
    from ledgerline.operators import dealt_by_key

    fact = spark.range(300).selectExpr("case when id < 200 then 'hot' when id % 9 = 0 then null else concat('k', id % 7) end as k", "cast(id as string) as guid")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5), ("gone", 6)], "d string, v int")
    left, right = dealt_by_key(fact, dim, "k", "d", "guid", "_deal", rows_per_deal=20)
    got = left.join(right, F.col("_deal") == F.col("_deal_of"), "inner").select("k", "guid", "d", "v")
    want = fact.join(dim, F.col("k") == F.col("d"), "inner").select("k", "guid", "d", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert left.where("k = 'hot'").select("_deal").distinct().count() == 10


@pytest.mark.parametrize("name", ["d03_portfolio_row", "d05_portfolio_bid", "d12_postsale"])
def test_parties_beyond_the_broadcast_size_come_back_in_lists(spark, sf_dir, monkeypatch, name):
    """The wide rows are shuffled on one key, with the same rows: also of repeated and NULL portfolio and party ids."""
    from collections import Counter

    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import gold
    from ledgerline.sources import Sources

    src = Sources.from_testdata(spark, sf_dir)
    p, bids = src["portfolio"], src["portfolio_bid"]
    odd = p.limit(40).withColumn("Id", F.lit(None).cast("string"))
    lost = bids.limit(60).withColumn("PortfolioId", F.lit(None).cast("string")).unionByName(bids.limit(50).withColumn("PlacedByUserId", F.lit(None).cast("string")))
    frames = {n: src[n] for n in src} | {"portfolio": p.unionByName(odd).unionByName(p.limit(30)), "portfolio_bid": bids.unionByName(lost).unionByName(bids.limit(20))}
    src, product = Sources.from_frames(spark, frames), getattr(gold, name)
    before = product(src, Params.testing())
    with monkeypatch.context() as m:
        m.setattr(relational, "DEFAULT_BROADCAST_LIMIT", -1)
        after = product(src, Params.testing())
    assert after.columns == before.columns
    assert Counter(map(str, after.collect())) == Counter(map(str, before.collect()))
    assert "_lk_found" in after._jdf.queryExecution().optimizedPlan().toString()


def test_heavy_keys_are_counted_once(spark):
    """Both sides of a salted join read the one kept count."""
    fact, dim = spark.range(100).selectExpr("id % 3 as k", "id"), spark.range(3).selectExpr("id as d")
    plan = salted_join(fact, dim, "k", "d", "id", rows_per_task=10)._jdf.queryExecution().withCachedData().toString()
    assert plan.count("InMemoryRelation") == 2 and "count(1)" not in plan.split("InMemoryRelation")[0]


def _with_odd_rows(spark, sf_dir):
    """Sources with repeated and NULL ids of portfolios, bids, businesses and users, and ids in other case or with trailing spaces."""
    from ledgerline.sources import Sources

    src = Sources.from_testdata(spark, sf_dir)
    p, bids, b, u = (src[n] for n in ("portfolio", "portfolio_bid", "business", "app_user"))
    nameless = p.limit(40).withColumn("Id", F.lit(None).cast("string"))
    lost = bids.limit(60).withColumn("PortfolioId", F.lit(None).cast("string")).unionByName(bids.limit(50).withColumn("PlacedByUserId", F.lit(None).cast("string")))
    spelled = b.filter("Id like 'B1%'").withColumn("Id", F.concat(F.lower("Id"), F.lit(" "))).withColumn("ClientId", F.lit("C1"))
    return Sources.from_frames(spark, {n: src[n] for n in src} | {
        "portfolio": p.unionByName(nameless).unionByName(p.limit(30)), "portfolio_bid": bids.unionByName(lost).unionByName(bids.limit(20)),
        "business": b.unionByName(b.limit(20).withColumn("ClientId", F.lit("C2"))).unionByName(spelled), "app_user": u.unionByName(u.limit(20))})


@pytest.mark.parametrize("name", ["d01_portfolio", "d05_portfolio_bid", "d13_silver_expanded"])
def test_narrow_products_have_the_same_rows(spark, sf_dir, monkeypatch, name):
    from collections import Counter

    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import gold, silver

    src, product = _with_odd_rows(spark, sf_dir), getattr(silver if name.startswith("d13") else gold, name)
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", -1)
    wide, narrow = product(src, Params.testing()), product(src, Params.testing(), narrow=True)
    assert narrow.columns == wide.columns
    assert Counter(map(str, narrow.collect())) == Counter(map(str, wide.collect()))
    assert "_lk_found" not in narrow._jdf.queryExecution().optimizedPlan().toString()


def test_bidders_beyond_the_broadcast_size_are_joined_narrow(spark, sf_dir, monkeypatch):
    """The rows of a plain reading of D13, D05 and D02; no lists of names, and no bid meets the users."""
    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import gold, silver, views

    src, prm = _with_odd_rows(spark, sf_dir), Params.testing()
    pe, pb, b = (f(src, prm).collect() for f in (silver.d13_silver_expanded, gold.d05_portfolio_bid, gold.d02_business))
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", -1)
    got = views.d08_bidders(src, prm)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_lk_found" not in plan and "_su_id" not in plan and "FullOuter" not in plan

    def ci(text):
        return None if text is None else text.lower().rstrip(" ")

    firms = {}
    for r in b:
        firms.setdefault(ci(r.Id), []).append(r)
    bidders = {}
    for r in pb:
        if r.Status is not None:
            bidders.setdefault(ci(r.PortfolioNumber), set()).add(ci(r.BuyerId))
    want = set()
    for r in pe:
        closed = r.PortfolioCloseUtc
        if r.Status is None or r.Status == "Purged" or closed is None or closed.year <= prm.min_close_year:
            continue
        for buyer in bidders.get(ci(r.PortfolioNumber), ()):
            known = firms.get(buyer, [])
            want |= {(c, n, closed.month, closed.year) for c in {x.ClientId for x in known} or {None} for n in {x.BusinessName for x in known} or {None}}
    rows = list(map(tuple, got.collect()))
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100


def test_plain_keys_are_equal_where_the_collation_is(spark):
    """No pair equal under the collation is lost: final sigma, Kelvin sign, dotted I, sharp s, trailing spaces."""
    from ledgerline.plans.views import ci, ci_equal, plain

    texts = ["b1", "B1 ", "B1  ", " b1", "ΑΣ", "ας", "ασ", "ΑΣ ", "ΑΣΑ", "K", "k", "K", "İ", "i̇", "i", "ı", "I", "ß", "ẞ", "SS", "ss", "Å", "å", "ǅ", "Ǆ", "ǆ", "", " ", "B1\t", "é", "É", "é", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    left = rows.select(F.col("i").alias("a"), F.col("t").alias("x"), plain("t").alias("k"))
    right = rows.select(F.col("i").alias("b"), F.col("t").alias("y"), plain("t").alias("l"))
    want = sorted((r.a, r.b) for r in left.crossJoin(right).filter(ci("x") == ci("y")).collect())
    got = left.join(right, (F.col("k") == F.col("l")) & ci_equal("x", "y"), "inner")
    assert sorted((r.a, r.b) for r in got.collect()) == want
    assert len(want) > len(texts)
    assert "SortMergeJoin [collate" not in got._jdf.queryExecution().toString()


def test_likely_keys_lose_no_row_of_a_key_and_few_others_pass(spark, monkeypatch):
    """Repeated and NULL keys on both sides, negative numbers; whole where the fact is small or the keys are of two types."""
    from ledgerline.operators import likely_keys, relational

    fact = spark.range(20000).selectExpr("case when id % 50 = 0 then null else concat('g', id % 9000) end as g", "id % 9000 - 4500 as n", "id")
    keys = spark.range(1200).selectExpr("case when id % 40 = 0 then null else concat('g', id % 900 * 7) end as k", "id % 900 * 7 - 4500 as m")
    assert likely_keys(fact, keys, "g", "k") is fact
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", 16 * 1024)
    assert likely_keys(fact, keys, "g", "m") is fact
    for a, b in (("g", "k"), ("n", "m")):
        some = likely_keys(fact, keys, a, b)
        want = fact.join(keys.select(b).distinct(), F.col(a) == F.col(b), "left_semi")
        assert sorted(map(str, some.join(keys.select(b).distinct(), F.col(a) == F.col(b), "left_semi").collect())) == sorted(map(str, want.collect()))
        assert 1500 < want.count() <= some.count() < 4000
    few = spark.createDataFrame([("g1",), ("lost",)], "k string")
    assert {r["g"] for r in likely_keys(fact, few, "g", "k").collect()} >= {"g1"} and likely_keys(fact, few.limit(0), "g", "k").count() == 0


def test_complaints_move_only_the_accounts_complained_about(spark, sf_dir, monkeypatch):
    """D06 beyond the broadcast size: accounts that no complaint names are not shuffled, with the same rows."""
    from collections import Counter

    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import gold
    from ledgerline.sources import Sources

    src = Sources.from_testdata(spark, sf_dir)
    ct, pr = src["complaint"], src["portfolio_row"]
    ct = ct.unionByName(ct.limit(30)).unionByName(ct.limit(20).withColumn("PortfolioRowId", F.lit(None).cast("string")))
    src = Sources.from_frames(spark, {n: src[n] for n in src} | {"complaint": ct, "portfolio_row": pr.unionByName(pr.limit(40)).unionByName(pr.limit(20).withColumn("PortfolioRowGuid", F.lit(None).cast("string")))})
    before = Counter(map(str, gold.d06_complaints(src, Params.testing()).collect()))
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", 16 * 1024)
    after = gold.d06_complaints(src, Params.testing())
    assert Counter(map(str, after.collect())) == before and len(before) > 500
    assert "bitmap_construct_agg" in after._jdf.queryExecution().optimizedPlan().toString()


def test_silver_base_does_not_shuffle_accounts_without_requests_or_complaints(spark, sf_dir, monkeypatch):
    """D18 and the fold beyond the broadcast size: the same rows, also of repeated and NULL accounts and portfolios."""
    from collections import Counter

    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import staging

    src = _with_odd_rows(spark, sf_dir)
    pr, ct, rq = src["portfolio_row"], src["complaint"], src["request"]
    homeless = pr.limit(300).withColumn("PortfolioId", F.lit(None).cast("string"))
    nameless = pr.limit(20).withColumn("PortfolioRowGuid", F.lit(None).cast("string"))
    frames = {"portfolio_row": pr.unionByName(pr.limit(40)).unionByName(homeless).unionByName(nameless), "complaint": ct.unionByName(ct.limit(30)),
              "request": rq.unionByName(rq.limit(30).withColumn("DebtAccountId", F.lit(None).cast("string")))}
    src = src.from_frames(spark, {n: src[n] for n in src} | frames)
    products = (staging.account_fold, staging.d18_silver_base)
    before = [Counter(map(str, f(src, Params.testing()).collect())) for f in products]
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", 16 * 1024)
    for f, want in zip(products, before):
        after = f(src, Params.testing())
        assert Counter(map(str, after.collect())) == want and len(want) > 1000, f.__name__
        plan = after._jdf.queryExecution().optimizedPlan().toString()
        assert "bitmap_construct_agg" in plan and "_account" in plan, f.__name__
    assert any(r["PortfolioId"] is None and r["ComplaintCount"] and r["RequestCount"] for r in staging.account_fold(src, Params.testing()).collect())


@pytest.mark.parametrize("name", ["d13_silver_expanded", "d20_formula_complete"])
def test_silver_products_are_built_on_the_narrow_fold(src, monkeypatch, name):
    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import silver, staging

    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", 16 * 1024)
    plan = getattr(silver if name.startswith("d13") else staging, name)(src, Params.testing())._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and "_account" in plan


def test_postsale_moves_only_the_accounts_with_requests(spark, sf_dir, monkeypatch):
    """D12 beyond the broadcast size: the same rows, also of repeated and NULL accounts."""
    from collections import Counter

    from ledgerline.operators import relational
    from ledgerline.params import Params
    from ledgerline.plans import gold

    src = _with_odd_rows(spark, sf_dir)
    pr, rq = src["portfolio_row"], src["request"]
    frames = {"portfolio_row": pr.unionByName(pr.limit(40)).unionByName(pr.limit(20).withColumn("PortfolioRowGuid", F.lit(None).cast("string"))),
              "request": rq.unionByName(rq.limit(30).withColumn("DebtAccountId", F.lit(None).cast("string")))}
    src = src.from_frames(spark, {n: src[n] for n in src} | frames)
    before = Counter(map(str, gold.d12_postsale(src, Params.testing()).collect()))
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", 16 * 1024)
    after = gold.d12_postsale(src, Params.testing())
    assert Counter(map(str, after.collect())) == before and len(before) > 500
    assert "bitmap_construct_agg" in after._jdf.queryExecution().optimizedPlan().toString()


def test_bids_portfolios_auctions_and_dates_meet_on_one_deal(src, monkeypatch):
    """D05 beyond the broadcast size: no shuffle of portfolios or auctions on the plain portfolio id."""
    from ledgerline.operators import dealt_by_key, relational
    from ledgerline.params import Params
    from ledgerline.plans import gold

    s = src["portfolio"].sparkSession
    fact = s.range(60).selectExpr("case when id < 40 then 'hot' else 'k' end as k", "cast(id as string) as g")
    dim, side = (s.createDataFrame([("hot", x), ("hot", x + 1), (None, 9)], f"{c} string, {c}v int") for c, x in (("d", 1), ("e", 5)))
    left, right, third = dealt_by_key(fact, dim, "k", "d", "g", "_deal", rows_per_deal=9, more=[(side, "e")])
    got = left.join(right, F.col("_deal") == F.col("_deal_of"), "inner").join(third, F.col("_deal") == F.col("_deal_of1"), "left")
    want = fact.join(dim, F.col("k") == F.col("d"), "inner").join(side, F.col("k") == F.col("e"), "left")
    assert sorted(map(str, got.select("g", "dv", "ev").collect())) == sorted(map(str, want.select("g", "dv", "ev").collect())) and got.count() == 160
    monkeypatch.setattr(relational, "DEFAULT_BROADCAST_LIMIT", -1)
    plan = gold.d05_portfolio_bid(src, Params.testing())._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_p_id" not in plan and "hashpartitioning(_a_pid" not in plan and "hashpartitioning(_deal_of1" in plan
