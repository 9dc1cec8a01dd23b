"""Mixing sources to target weights: token blocks, multinomial draws and index permutations."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentilake.llm.common import WORD, stash

BLOCK_WORDS = 32
SHARD_SLOTS = 65_536
RANGE_SLOTS = 4096
SLOTS_PER_TASK = 1 << 20
GRID = 4096
ROUNDS = 6
WALKS = 24
DOCS_PER_BUCKET = 500


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Target words of every source.

    `sizes` has one row per source (source, source_size). Sources in code-point order, null
    last, take the weights in turn. They share `share` times all words by weight, but none
    gets more than `most` times its own; what is cut off goes to the others by weight. In
    the order of size per weight, the sources that reach their cap come first, so one running
    sum finds them. One row per source is numbered in one task, never documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))))
    by_fill = Window.orderBy("fill", "id").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = (sizes.withColumn("id", rank.cast("long")).withColumn("weight", weight)
              .withColumn("fill", F.lit(most) * F.col("source_size") / F.col("weight"))
              .withColumn("all", F.sum("source_size").over(every) * F.lit(share))
              .withColumn("rest", F.col("all") - F.coalesce(F.sum("source_size").over(by_fill), F.lit(0)) * F.lit(most))
              .withColumn("weights", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_fill), F.lit(0)))
              .withColumn("level", F.col("rest") / F.col("weights"))
              .withColumn("capped", F.col("fill") <= F.col("level")))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)  # that of the first one not capped
    target = F.when(F.col("capped"), F.lit(most) * F.col("source_size")).otherwise(level * F.col("weight"))
    return filled.select("source", "id", "source_size", target.cast("double").alias("target"))


def permuted(index: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0..n-1, keyed.

    A Feistel network over a grid of about n cells; the few cells beyond n are walked on
    from until an index below n comes.
    """
    a = F.ceil(F.sqrt(n)).cast("long")
    b = F.ceil(n / a).cast("long")

    def turn(x: Column, k: Column) -> Column:
        left, right = (x / b).cast("long"), F.pmod(x, b)
        moved_left = F.pmod(left + F.pmod(F.xxhash64(key, k, right), a), a) * b + right
        moved_right = left * b + F.pmod(right + F.pmod(F.xxhash64(key, k, left), b), b)
        return F.when(F.pmod(k, F.lit(2)) == 0, moved_left).otherwise(moved_right)

    def network(x: Column) -> Column:
        return F.aggregate(F.array(*[F.lit(k) for k in range(rounds)]), x, turn)

    return F.aggregate(F.array(*[F.lit(k) for k in range(WALKS)]), network(index.cast("long")),
                       lambda x, k: F.when(x < n, x).otherwise(network(x)))


def pack_blocks(sized: DataFrame, ids: DataFrame, seed: int) -> DataFrame:
    """Lay the documents of every source end to end in a hashed order.

    `sized` has source, doc_id and size; equal rows are counted first and laid out as
    copies. Returns source id, doc_id, size and `offset`, the place of the first word in the
    source's stream. Streams are summed in hash buckets, so a source of any size is spread.
    """
    groups = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    buckets = max(1, math.ceil(sized.count() / DOCS_PER_BUCKET))
    keyed = groups.join(ids.select(F.col("source").alias("_source"), "id"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "id", "doc_id", "size", "copies", (F.col("size") * F.col("copies")).alias("words"),
        F.xxhash64(F.lit(seed), "doc_id", "size").alias("key")).withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.lit(buckets)))
    before = (keyed.groupBy("id", "bucket").agg(F.sum("words").alias("words"))
              .withColumn("start", F.coalesce(F.sum("words").over(Window.partitionBy("id").orderBy("bucket").rowsBetween(
                  Window.unboundedPreceding, -1)), F.lit(0))).select("id", "bucket", "start"))
    order = Window.partitionBy("id", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    return (keyed.withColumn("in_bucket", F.coalesce(F.sum("words").over(order), F.lit(0)))
            .join(before, ["id", "bucket"])
            .select("id", "doc_id", "size", (F.col("start") + F.col("in_bucket")).alias("first"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
            .select("id", "doc_id", "size", (F.col("first") + F.col("copy") * F.col("size")).alias("offset")))


def draw_slots(targets: DataFrame, all_words: float, block: int, shard_slots: int, seed: int) -> DataFrame:
    """The mix as (shard, id, slot of the source, block): which block fills which place.

    Every place of an output shard draws its source by target weight, so the counts of a
    shard are multinomial. Only counts are kept: the slots of a source are numbered through
    all shards, and slot j takes block permutation(j mod blocks) of round j div blocks. Slots
    beyond two rounds stay unused, so no block is taken more than twice.
    """
    spark = targets.sparkSession
    cells = (targets.withColumn("high", F.sum("target").over(Window.orderBy("id")) / F.lit(max(all_words, 1.0)))
             .withColumn("low", F.col("high") - F.col("target") / F.lit(max(all_words, 1.0)))
             .where("target > 0")
             .withColumn("cell", F.explode(F.sequence(
                 F.floor(F.col("low") * GRID), F.least(F.floor(F.col("high") * GRID), F.lit(GRID))))))
    last = F.max("id").over(Window.partitionBy())
    cells = cells.select("id", "cell", "low", F.when(F.col("id") == last, F.lit(2.0)).otherwise(F.col("high")).alias("high"))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11).cast("double") / F.lit(float(1 << 53))
    places = spark.range(math.ceil(all_words / block)).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), u.alias("u")).withColumn("cell", F.floor(F.col("u") * GRID))
    counts = (places.join(cells, "cell").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
              .groupBy("shard", "id").count())
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    before = F.coalesce(F.sum("count").over(Window.partitionBy("id").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    # A few rows say how many; they are cut into short ranges and dealt before the slots are written out.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(all_words / block / SLOTS_PER_TASK))
    most = F.least(F.col("start") + F.col("count"), 2 * F.col("blocks")) - 1
    ranges = (counts.withColumn("start", before).join(targets.select("id", blocks.alias("blocks")), "id")
              .withColumn("most", most).where("start <= most")
              .withColumn("least", F.explode(F.sequence("start", "most", F.lit(RANGE_SLOTS).cast("long"))))
              .repartition(tasks, "id", "least"))
    slots = ranges.select("shard", "id", "blocks", F.explode(F.sequence(
        F.col("least"), F.least(F.col("least") + RANGE_SLOTS - 1, F.col("most")))).alias("slot"))
    round_ = F.floor(F.col("slot") / F.col("blocks"))
    return slots.select("shard", "id", "slot", permuted(
        F.pmod("slot", "blocks"), F.col("blocks"), F.xxhash64(F.lit(seed + 3), "id", round_)).alias("block"))


def mix_sources(documents: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
                seed: int = 29) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mix the sources of doc_id, text and source to their target weights.

    Returns (taken, pieces, slots). `taken` has a row per document: doc_id, source, size,
    source_size, target and `taken`, the words the mix takes of it with repeats. `pieces` lists
    the words [from, to) of a document in each block of its source's stream, and `slots` the
    block that fills each slot of each output shard.

    A null source is a source of its own; null and empty texts have size 0 and take nothing;
    equal rows are laid out one after the other; an empty table gives no rows. Other
    columns are not read. A very long text lies over as many blocks as its words need; ties of the
    hashed order go by doc_id and size. All draws are hashes, so reruns agree.
    """
    sized = stash(documents.select("source", "doc_id", word_count(F.col("text")).alias("size")), "mixing")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stash(source_targets(sizes), "mixing-targets")
    all_words = targets.agg(F.sum("target")).first()[0] or 0.0
    slots = draw_slots(targets, all_words, block, shard_slots, seed)
    laid = stash(pack_blocks(sized, targets, seed + 5), "mixing-laid")
    end = F.col("offset") + F.col("size")
    pieces = (laid.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("offset") / block), F.floor((end - 1) / block))))
        .select("id", "block", "doc_id", "offset", "size",
                (F.greatest(F.col("offset"), F.col("block") * block) - F.col("offset")).alias("from"),
                (F.least(end, (F.col("block") + 1) * block) - F.col("offset")).alias("to")))
    times = slots.groupBy("id", "block").agg(F.count(F.lit(1)).alias("times"))
    got = (pieces.join(times, ["id", "block"]).groupBy("id", "offset", "size", "doc_id")
           .agg(F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken")))
    keys = ["id", "offset", "size"]
    full = laid.where("size > 0").join(got.select(*keys, "taken"), keys, "left").select("id", "doc_id", "size", "taken")
    none = laid.where("size = 0").select("id", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    taken = full.unionByName(none).join(targets, "id").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return taken, pieces, slots
