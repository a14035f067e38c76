"""Physical layout of the source tables for co-located account joins.

The debt-account fact (PortfolioRow) and every table keyed by a debt account
(scrub results, post-sale requests, complaints, commercial data) are written
as catalog tables bucketed – and sorted – on the account key with ONE bucket
count. Spark then plans the products' account-key joins and per-account
aggregations without exchanging either side: D03's five satellites, D12's
request-to-account join and D06's complaint-to-account join read matching
buckets side by side instead of shuffling the largest table.

Choose the bucket count so one bucket of the largest table is a few hundred
MB (e.g. 16 384 buckets for tens of TB of accounts); every table in the family
must use the same count, and it should be at least the session's
``spark.sql.shuffle.partitions``: when a shuffled side meets a bucketed side,
Spark keeps the partitioning with more partitions and re-shuffles the other,
which must be the small side, never the fact.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .loader import SOURCE_TABLES, Sources

# table -> account key column (all hold PortfolioRowGuid values)
ACCOUNT_KEYED = {
    "portfolio_row": "PortfolioRowGuid",
    "portfolio_row_commercial": "PortfolioRowGuid",
    "deceased_result": "DebtAccountId",
    "bankruptcy_result": "DebtAccountId",
    "scra_result": "DebtAccountId",
    "request": "DebtAccountId",
    "complaint": "PortfolioRowId",
}


def write_source_tables(spark: SparkSession, sources: Sources, schema: str, buckets: int,
                        files: int | None = None) -> None:
    """Write every source table into catalog ``schema``; account-keyed tables
    bucketed and sorted on their account key (``buckets`` each), the others
    spread over ``files`` files when given."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for name in SOURCE_TABLES:
        df = sources[name]
        key = ACCOUNT_KEYED.get(name)
        if key is not None:
            # one file per bucket: cluster rows by bucket before writing
            w = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            w = (df.repartition(files) if files else df).write
        w.mode("overwrite").format("parquet").saveAsTable(f"`{schema}`.`{name}`")
