"""Seeded samples, stratified splits and folds that do not depend on partitioning."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sentilake.operators.joins import MAX_CLASSES, class_map

HASH_PREFIX = 4  # hex digits: 65,536 buckets per class


def hash_order(row_id: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed))))


def sample_n(df: DataFrame, n: int, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Exactly n rows (or all), chosen by hash: a per-partition top-n, no full sort."""
    return df.orderBy(hash_order(row_id, seed), row_id).limit(n)


def split_quotas(df: DataFrame, label: str, test_share: float = 0.2) -> DataFrame:
    """Test rows per label: ceil(share * n) shared out by largest remainder. Unlabelled rows do not count."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per label from here on.
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    test_total = F.ceil(F.round(F.lit(float(test_share)) * total, 9))
    exact = counts.select(label, "n", test_total.alias("n_test"),
                          (F.col("n") * test_total / total).alias("share"))
    whole = exact.select("*", F.floor("share").alias("base"))
    by_rest = Window.partitionBy(F.lit(1)).orderBy(F.desc(F.col("share") - F.col("base")), label)
    left_over = F.col("n_test") - F.sum("base").over(everything)
    return whole.select(label, F.col("n"), (F.col("base") + F.when(F.row_number().over(by_rest) <= left_over, 1)
                                            .otherwise(0)).cast("bigint").alias("quota"))


def _per_class(stats: DataFrame) -> list[Row]:
    """One row per class on the driver, with the number of classes checked."""
    rows = stats.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError("too many classes for a stratified split")
    return rows


def split_limits(df: DataFrame, label: str, test_share: float = 0.2, seed: int = 42,
                 row_id: str = "row_id") -> list[Row]:
    """(label, hash, row id) of the last test row per label.

    A histogram over hash buckets finds the bucket that holds it; only that bucket, a
    65,536th of the label, is ranked. Runs two small jobs, as fitting a model would.
    """
    keyed = df.select(F.col(label).alias("_y"), F.col(row_id).alias("_id"), hash_order(row_id, seed).alias("_h"))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, HASH_PREFIX))
    histogram = keyed.groupBy("_y", "_b").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_y").orderBy("_b"))
    placed = histogram.select("_y", "_b", "n", upto.alias("upto"))
    # At most 65,536 histogram rows per label meet one quota row per label.
    quotas = split_quotas(df, label, test_share).select(F.col(label).alias("_y"), "quota")
    edge = (placed.join(F.broadcast(quotas), "_y")
            .where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota"))))
    edges = _per_class(edge.select("_y", "_b", (F.col("quota") - (F.col("upto") - F.col("n"))).alias("need")))
    if not edges:
        return []
    in_edge, need = F.lit(False), F.lit(None).cast("bigint")
    for e in edges:
        in_edge = in_edge | ((F.col("_y") == F.lit(e["_y"])) & (F.col("_b") == F.lit(e["_b"])))
        need = F.when(F.col("_y") == F.lit(e["_y"]), F.lit(e["need"])).otherwise(need)
    rank = F.row_number().over(Window.partitionBy("_y").orderBy("_h", "_id"))
    last = keyed.where(in_edge).withColumn("_r", rank).where(F.col("_r") == need)
    return _per_class(last.select("_y", "_h", "_id"))


def stratified_split(df: DataFrame, label: str, test_share: float = 0.2, seed: int = 42,
                     row_id: str = "row_id", name: str = "split") -> DataFrame:
    """Add `split` = train / test with exact per-label quotas.

    Within a label the rows with the smallest hashes are the test rows. Ranking a whole
    label would put it into one task; comparing each row with its label's limit splits
    the data without a shuffle.
    """
    own, is_test = hash_order(row_id, seed), F.lit(False)
    for at in split_limits(df, label, test_share, seed, row_id):
        inside = (own < F.lit(at["_h"])) | ((own == F.lit(at["_h"])) & (F.col(row_id) <= F.lit(at["_id"])))
        is_test = is_test | ((F.col(label) == F.lit(at["_y"])) & inside)
    return df.withColumn(name, F.when(is_test, "test").otherwise("train"))


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42,
                     row_id: str = "row_id", name: str = "fold") -> DataFrame:
    """Add `fold` 0..k-1, dealt out in hash order inside each label."""
    keyed = df.withColumn("_h", hash_order(row_id, seed))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, HASH_PREFIX))
    histogram = keyed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("n"))
    offset = F.sum("n").over(Window.partitionBy(label).orderBy("_b")) - F.col("n")
    # Joined on the keys the ranking window needs, so rows move once.
    offsets = histogram.select(label, "_b", offset.alias("_o"))
    rank = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", row_id)) - 1
    return (keyed.join(offsets, [label, "_b"])
            .withColumn(name, F.pmod(F.col("_o") + rank, F.lit(k)).cast("int"))
            .drop("_h", "_b", "_o"))


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add n / (classes * n_class) per row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    weighted = counts.select(label, (F.sum("n").over(Window.partitionBy(F.lit(1)))
                                     / (F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))) * F.col("n")))
                             .alias("w"))
    return df.withColumn(name, class_map(weighted, label, "w")[F.col(label)])
