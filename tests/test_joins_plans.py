from pyspark.sql import functions as F

from sentilake.operators import joins


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_counted_as_too_large_is_not_broadcast(spark, tmp_path):
    """Its estimated size is small, but every salt gets a copy of it."""
    spark.range(3000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    rows = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") * 7).alias("k"))
    assert not joins.fits_broadcast(table, 1000)
    limit, joins.fits_broadcast.__defaults__ = joins.fits_broadcast.__defaults__, (1000,)
    try:
        got = joins.lookup(rows, table, ["k"])
    finally:
        joins.fits_broadcast.__defaults__ = limit
    assert "Broadcast" not in _plan(got)
    assert got.where(F.col("v").isNotNull()).count() == 429 and got.count() == 500
