"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix."""
from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentilake.llm.common import stash

ROWS_PER_BUCKET = 4096
LOCAL_BITS = 33


def draw_hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` items taken without replacement are good.

    Inverts the distribution outwards from its mode, so the steps follow its spread.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn))
    left = rng.random() - at_mode
    below, above, p_below, p_above = mode, mode, at_mode, at_mode
    while left > 0 and (below > low or above < high):
        if above < high:
            p_above *= (good - above) * (drawn - above) / ((above + 1) * (bad - drawn + above + 1))
            above += 1
            left -= p_above
            if left <= 0:
                return above
        if below > low:
            p_below *= below * (bad - drawn + below) / ((good - below + 1) * (drawn - below + 1))
            below -= 1
            left -= p_below
            if left <= 0:
                return below
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard, drawn as a uniform permutation would send them.

    Row sums are the partition counts; column sums differ by at most one.
    """
    total, rng = sum(counts), random.Random(seed)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for count in counts:
        rest, left, row = sum(room), count, []
        for s in range(shards):
            sent = draw_hypergeometric(rng, room[s], rest - room[s], left)
            rest -= room[s]
            left -= sent
            row.append(sent)
        room = [r - sent for r, sent in zip(room, row)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(rows: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """Deal rows into shards as a uniform random permutation would, with counts at most one apart.

    Each input partition orders its rows at random without moving them. The driver draws
    how many rows each partition sends to each shard (partitions x shards integers, no rows),
    and a row's random rank decides its shard. Within a shard, rows are ordered at random
    again: hash buckets of a few thousand rows are numbered separately and shifted by the
    counts before them, so no shard meets in one task.

    Returns `row` (a struct of all input columns, whatever their names), `shard` (int, from 0)
    and `slot` (long, gapless from 0 in each shard). Equal and repeated rows are dealt one by
    one, and ties of a random key are ordered by partition and rank; nulls and empty texts are
    plain values; an empty table gives no rows. Very long texts travel whole, as any row:
    once with the first ranks, which are written to the shared folder, so that a lost executor cannot deal
    a row anew, and once through the exchange.
    """
    spark = rows.sparkSession
    mixed = rows.select(F.struct("*").alias("row"), F.rand(seed).alias("_key")).sortWithinPartitions("_key")
    place = F.monotonically_increasing_id()
    ranked = stash(mixed.select("row", F.shiftright(place, LOCAL_BITS).alias("part"),
                                place.bitwiseAND((1 << LOCAL_BITS) - 1).alias("rank")), "sharding")
    counts = {r["part"]: r["count"] for r in ranked.groupBy("part").count().collect()}
    parts = sorted(counts)
    matrix = communication_matrix([counts[p] for p in parts], shards, seed)
    plan = []
    for part, row in zip(parts, matrix):
        ends, end = [], 0
        for sent in row:
            end += sent
            ends.append(end)
        plan.append({"part": part, "ends": ends})
    sends = spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(plan)), "array<struct<part: bigint, ends: array<bigint>>>")).alias("s")).select("s.*")
    buckets = max(1, math.ceil(sum(counts.values()) / (shards * ROWS_PER_BUCKET)))
    sent = ranked.join(sends, "part").select(
        "row", "part", "rank",
        F.size(F.filter("ends", lambda end: end <= F.col("rank"))).alias("shard"),
        F.xxhash64(F.lit(seed + 1), "part", "rank").alias("key")).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed + 2), "part", "rank"), F.lit(buckets)))
    before = (sent.groupBy("shard", "bucket").count()
              .withColumn("start", F.coalesce(F.sum("count").over(
                  Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .select("shard", "bucket", "start"))
    order = Window.partitionBy("shard", "bucket").orderBy("key", "part", "rank")
    return (sent.withColumn("n", F.row_number().over(order)).join(before, ["shard", "bucket"])
            .select("row", F.col("shard").cast("int").alias("shard"),
                    (F.col("start") + F.col("n") - 1).cast("long").alias("slot")))
