"""Bucketed source layout: same results, no exchange on account-key joins."""

import re

from ledgerline.params import Params
from ledgerline.plans import gold
from ledgerline.sources import Sources, write_source_tables


def test_bucketed_sources_give_same_rows_without_account_shuffles(spark, src):
    prm = Params.testing()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # >= shuffle partitions (layout.py)
    write_source_tables(spark, src, "ll_layout_test", buckets)
    try:
        bucketed = Sources.from_catalog(spark, "ll_layout_test")
        d03 = gold.d03_portfolio_row(bucketed, prm)
        plan = d03._jdf.queryExecution().executedPlan().toString()
        # no exchange partitions anything on the account key
        assert not re.search(r"Exchange hashpartitioning\((PortfolioRowGuid|DebtAccountId)", plan)
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(key, d03.collect())) == sorted(map(key, gold.d03_portfolio_row(src, prm).collect()))
        d12 = gold.d12_postsale(bucketed, prm)
        assert sorted(map(key, d12.collect())) == sorted(map(key, gold.d12_postsale(src, prm).collect()))
    finally:
        spark.sql("DROP SCHEMA IF EXISTS ll_layout_test CASCADE")
