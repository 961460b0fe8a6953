"""Tables whose rows are kept by user, so that questions per user need no shuffle.

A bucket is the hash partition that a grouping by user would put its rows into; each is one file, sorted by user and date. The
catalog knows about it, so plans read the buckets as they are. Bloom filters tell which files hold a user at all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def store_by_user(df: DataFrame, table: str, root: str, buckets: int) -> DataFrame:
    """Store ``df`` (with ``user_address`` and ``date``) as a catalog table of ``buckets`` buckets; the table.

    A user has few rows per date, so buckets are even however active a user is. The files of a table of that name
    that was there before stay for its readers.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, "user_address")  # one file per bucket
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        dealt.write.format("parquet")
        .option("path", f"{root.rstrip('/')}/by_user/{table}-{uuid.uuid4().hex}")
        .option("parquet.bloom.filter.enabled#user_address", "true")
        .bucketBy(buckets, "user_address")
        .sortBy("user_address", "date")
        .saveAsTable(table)
    )
    return spark.table(table)
