from pyspark.sql import functions as F

from sentilake.operators import bayes


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_choice_of_labels_is_not_worked_out_for_every_count(spark):
    """A condition that follows from the row id moved through the join to the counts."""
    counts = spark.range(20).select(F.col("id").alias("row_id"), F.lit("w").alias("term"), F.lit(1).alias("n"))
    labels = spark.range(20).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, "positive").otherwise("negative").alias("y"))
    train = labels.where(F.crc32(F.col("row_id").cast("string").cast("binary")) % 5 != 0)
    vocabulary = spark.createDataFrame([("w",)], "term string")
    model = bayes.fit_multinomial(counts, train, vocabulary)
    assert "crc32" not in _plan(model)
    n = train.count()
    prior = model.where("term IS NULL").collect()[0]["lp"]
    assert abs(sum(2.718281828459045 ** x for x in prior if x != float("-inf")) - 1) < 1e-9 and 0 < n < 20
