"""Near-duplicate classes by consistent weighted sampling of TF-IDF shingles."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import hold, importable, small_batches, stash
from sentilake.llm.shingles import (BAND_ROWS, BANDS, BUCKET_BITS, FINE_BANDS, FINE_ROWS, band_keys, bucket_counts,
                                    idf_weights, shingles, weighted_jaccard, weighted_samples)

SIMILARITY = 0.8
SMALL_BUCKET = 8
MEDIUM_BUCKET = 64
TEXTS_PER_STEP = 32
SALT_ROWS = 1024
PLACE_BITS = 24
SLICE_BITS = 6


def _parts(batch: pa.RecordBatch, n: int = TEXTS_PER_STEP) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, n):
        yield batch.slice(at, n)


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]


def document_frequencies(documents: DataFrame) -> np.ndarray:
    """In how many documents each of 2**18 hash buckets of shingles stands, over all documents.

    A task counts all its documents before it emits, so what is shuffled and gathered is
    bounded by the number of buckets.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near-duplicates", lambda: None)
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for part in _parts(batch):
                total += bucket_counts(*shingles(_texts(part, "text")))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    rows = (documents.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket")
            .agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def signatures(documents: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, node (the text's 128-bit hash), band keys and the packed shingles of every row.

    A text without shingles has no keys. Within a task, only the first row of equal texts
    carries keys and shingles.
    """
    sent = documents.sparkSession.sparkContext.broadcast(idf)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("near-duplicates", lambda: None)
        weights, seen = sent.value, set()
        for batch in batches:
            for part in _parts(batch):
                texts = _texts(part, "text")
                nodes = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
                new = [k for k, node in enumerate(nodes) if node not in seen and (seen.add(node) or True)]
                keys: list = [None] * len(texts)
                packed: list = [None] * len(texts)
                if new:
                    values, begins = shingles([texts[k] for k in new])
                    found = band_keys(weighted_samples(values, begins, weights, BANDS * BAND_ROWS), BANDS, BAND_ROWS)
                    for j, k in enumerate(new):
                        if begins[j + 1] > begins[j]:
                            keys[k] = found[j]
                            packed[k] = values[begins[j]:begins[j + 1]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(packed, pa.binary())], names=["doc_id", "node", "keys", "shingles"])

    return documents.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {kind}, node binary, keys array<bigint>, shingles binary")


def fine_keys(packed: DataFrame, idf: np.ndarray) -> DataFrame:
    """Keys of longer bands (node, key), for nodes whose short bands are crowded."""
    sent = packed.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                rows = [np.frombuffer(x, np.uint32) for x in part.column("shingles").to_pylist()]
                begins = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
                samples = weighted_samples(np.concatenate(rows), begins, sent.value, FINE_BANDS * FINE_ROWS)
                keys = band_keys(samples, FINE_BANDS, FINE_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(list(keys), pa.list_(pa.int64()))], names=["node", "keys"])

    return (packed.select("node", "shingles").mapInArrow(sign, "node binary, keys array<bigint>")
            .select("node", F.explode("keys").alias("key")))


def bucket_members(keyed: DataFrame) -> DataFrame:
    """(key, node, n): the members of every bucket of two or more nodes."""
    members = keyed.distinct()
    sizes = stash(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-sizes")
    return stash(members.join(sizes, "key").select("key", "node", "n"), "near-buckets")


def candidate_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs (a, b) to compare: all of a small bucket; in a larger one, each node with the bucket's hub.

    The hub is the node that shares buckets with most others, so it is the text that the
    others were made from rather than one of them. Pairs grow with the members of a bucket,
    not with their square.
    """
    large = buckets.where(F.col("n") > SMALL_BUCKET)
    degree = stash(buckets.groupBy("node").agg(F.sum("n").alias("degree")), "near-degrees")
    hubs = stash(large.join(degree, "node").groupBy("key").agg(
        F.max(F.struct("degree", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub")), "near-hubs")
    star = large.join(hubs, "key").where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    small = buckets.where(F.col("n") <= SMALL_BUCKET).withColumn("root", F.col("node"))
    return star.unionByName(pairs_across(small)).distinct()


def pairs_across(members: DataFrame) -> DataFrame:
    """Pairs of nodes of one bucket with different roots, for buckets of bounded size (key, node, root)."""
    nodes = F.col("nodes")
    return (members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "root"))).alias("nodes"))
            .select(F.explode(F.flatten(F.transform(nodes, lambda x, i: F.transform(
                F.filter(F.slice(nodes, i + 2, F.size(nodes)), lambda y: y["root"] != x["root"]),
                lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))).alias("p"))
            .select("p.a", "p.b"))


def left_pairs(buckets: DataFrame, roots: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs that a hub left apart: in buckets of medium size, all untested ones across components."""
    medium = buckets.where((F.col("n") > SMALL_BUCKET) & (F.col("n") <= MEDIUM_BUCKET))
    known = medium.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    return pairs_across(known).distinct().join(tested, ["a", "b"], "left_anti")


def open_nodes(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of the larger buckets that still hold nodes of several components."""
    large = buckets.where(F.col("n") > MEDIUM_BUCKET)
    known = stash(large.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "near-large")
    several = known.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    return known.join(several.select("key"), "key", "left_semi").select("node", "root").distinct()


def _prefix(packed: bytes, weights: np.ndarray, similarity: float) -> tuple[np.ndarray, float, np.ndarray]:
    """Shingles by which a text can meet another, its weight, and the weight from each of them on.

    Two texts of enough similarity share at least that part of either's weight. With shingles in one
    order for all, their first common one has at least as much weight from there on in both, so
    only such places are returned. The order is that of the documents that hold a shingle's bucket, rare
    before frequent, which every task knows without a shuffle.
    """
    values, times = np.unique(np.frombuffer(packed, np.uint32), return_counts=True)
    of_bucket = weights[values & np.uint32((1 << BUCKET_BITS) - 1)].astype(np.float64)
    order = np.lexsort((values, -of_bucket))
    rest = np.cumsum((times * of_bucket)[order][::-1])[::-1]
    take = rest >= similarity * float(rest[0]) * (1 - 1e-9)
    return values[order][take], float(rest[0]), rest[take]


def _spans(places: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct places in order, with the least and the greatest group of each."""
    order = np.argsort(places, kind="stable")
    places = places[order]
    first = np.flatnonzero(np.diff(places, prepend=-1))
    if not len(first):
        return places, least, most
    return places[first], np.minimum.reduceat(least[order], first), np.maximum.reduceat(most[order], first)


def shared_places(nodes: DataFrame, idf: np.ndarray, similarity: float) -> np.ndarray:
    """Which of 2**24 hash places of prefix shingles hold nodes (node, group, shingles) of two groups or more, a bit each.

    A shingle of another place meets nobody. Tasks send each of their places once, by slices; the bits that come back
    are 2 MB for a table of any size.
    """
    sent = nodes.sparkSession.sparkContext.broadcast(idf)
    width = 1 << (PLACE_BITS - SLICE_BITS)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            places, groups = [found[0]], []
            for packed, group in zip(batch.column("shingles").to_pylist(), batch.column("group").to_pylist()):
                places.append((_prefix(packed, sent.value, similarity)[0] >> np.uint32(32 - PLACE_BITS)).astype(np.int64))
                groups.append(np.full(len(places[-1]), group, np.int64))
            found = _spans(np.concatenate(places), np.concatenate([found[1], *groups]), np.concatenate([found[2], *groups]))
        at = np.searchsorted(found[0], np.arange((1 << SLICE_BITS) + 1) * width)
        for k in np.flatnonzero(np.diff(at)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x[at[k]:at[k + 1]]], pa.list_(pa.int64())) for x in found)],
                                             names=["slice", "places", "least", "most"])

    def merge(rows: pa.Table) -> pa.Table:
        places, least, most = _spans(*(rows.column(name).combine_chunks().flatten().to_numpy() for name in ("places", "least", "most")))
        several = np.zeros(width, np.bool_)
        several[places[least != most] % width] = True
        return pa.table({"slice": rows.column("slice")[:1], "bits": pa.array([np.packbits(several).tobytes()], pa.binary())})

    rows = (nodes.select("group", "shingles").mapInArrow(spans, "slice int, places array<bigint>, least array<bigint>, most array<bigint>")
            .groupBy("slice").applyInArrow(merge, "slice int, bits binary").toArrow())
    out = np.zeros((1 << SLICE_BITS, width // 8), np.uint8)
    for k, bits in zip(rows.column("slice").to_pylist(), rows.column("bits").to_pylist()):
        out[k] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def prefix_entries(nodes: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The shingles by which a node (node, group, shingles) can meet one of another group: (token, node, group, weight, rest).

    Those that stand in one group only are left out before they become rows, as far as the bits of `shared_places` tell.
    """
    sent = nodes.sparkSession.sparkContext.broadcast((idf, shared_places(nodes, idf, similarity)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bits = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                values, total, rest = _prefix(row["shingles"], weights, similarity)
                place = values >> np.uint32(32 - PLACE_BITS)
                several = (bits[place >> np.uint32(3)] >> (7 - (place & np.uint32(7))).astype(np.uint8) & 1).astype(np.bool_)
                k = int(several.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[several].view(np.int32)), pa.array([row["node"]] * k, pa.binary()),
                     pa.array([row["group"]] * k, pa.int64()), pa.array([total] * k, pa.float64()), pa.array(rest[several])],
                    names=["token", "node", "group", "weight", "rest"])

    return nodes.select("node", "group", "shingles").mapInArrow(
        cut, "token int, node binary, group bigint, weight double, rest double")


def prefix_pairs(nodes: DataFrame, packed: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """All pairs (a, b) of nodes (node, root) with different roots that can be similar enough.

    No pair is left out, whatever the size of a group. Shingles of a single root meet nobody and are left before the join. Of
    a shingle's nodes, those outside its most frequent root meet all others, dealt over salts.
    """
    groups = stash(nodes.select("root").distinct().withColumn("group", F.monotonically_increasing_id()), "near-groups")
    held = stash(nodes.join(groups, "root").join(packed, "node").select("node", "group", "shingles"), "near-held")
    entries = stash(prefix_entries(held, idf, similarity), "near-entries")
    sizes = entries.groupBy("token", "group").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.max(F.struct("n", "group"))["group"].alias("top"))
    sizes = stash(sizes.where("groups > 1").select("token", "top", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")), "near-postings")
    dealt = entries.join(sizes, "token")
    others = dealt.where(F.col("group") != F.col("top")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("x")
    every = dealt.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).alias("y")
    x, y = (lambda name: F.col("x." + name)), (lambda name: F.col("y." + name))
    enough = F.least(x("rest"), y("rest")) >= (x("weight") + y("weight")) * (similarity / (1 + similarity) * (1 - 1e-9))
    return others.join(every, (x("token") == y("token")) & (x("salt") == y("salt")) & (x("group") != y("group")) & enough).select(
        F.least(x("node"), y("node")).alias("a"), F.greatest(x("node"), y("node")).alias("b")).distinct()


def verified_links(pairs: DataFrame, packed: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The pairs (a, b, similarity) whose weighted Jaccard similarity is high enough."""
    sent = pairs.sparkSession.sparkContext.broadcast(idf)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [weighted_jaccard(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), sent.value)
                   for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(got, pa.float64())], names=["a", "b", "similarity"])

    both = (pairs.join(packed.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
            .join(packed.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
            .select("a", "b", "left", "right"))
    return both.mapInArrow(measure, "a binary, b binary, similarity double").where(F.col("similarity") >= similarity)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's connected component.

    Every round takes the least label of a node and its neighbours, then the label's own
    label; it ends when no label changes. Labels are written each round, so lineage stays short.
    """
    edges = stash(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-edges")
    labels = stash(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "near-labels")
    while True:
        seen = edges.join(labels, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "root")
        least = seen.unionByName(labels).groupBy("node").agg(F.min("root").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = stash(least.join(jump, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "near-labels")
        changed = new.join(labels.withColumnRenamed("root", "old"), "node").where("root <> old").limit(1).count()
        if not changed:
            return new
        labels = new


def near_duplicate_classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Near-duplicate classes of doc_id and text: one row per document row.

    Shingles of five words (lower-case runs of letters and digits) weigh their count in the text
    times a damped inverse document frequency, counted over all documents in hash buckets. 30
    consistent weighted samples in 10 bands of 3 give candidates; nodes in crowded buckets are
    banded again by 16 bands of 10. A bucket of up to 64 nodes is compared as a whole, first by
    its hub and then across the components that this leaves; a larger one by its hub and by its
    nodes' longer bands. If that leaves several components in a larger one, all pairs across them are
    found by an exact prefix filter. Candidates are verified by their weighted Jaccard
    similarity, and links are closed to connected components.

    Equal texts are one node from the start, so a group of copies of any size costs one
    signature a task. Returns doc_id, `text_id` (least doc_id of the equal texts), `class_id`
    (least doc_id of the component), `n_links` (verified links of the text to other texts),
    `copies` (rows with this text), `node`, the text's hash, and `root`, the least of its class. Null texts count as empty. Texts
    without a word are alike only if equal. Ids of null are passed over in text_id and
    class_id, which are null if no member has one. Repeated rows are each returned; an empty
    table gives no rows; other columns are not read.
    """
    spark = importable(documents.sparkSession)
    with small_batches(spark):
        idf = idf_weights(document_frequencies(documents), documents.count())
        signed = stash(signatures(documents, idf), "near-signatures")
        buckets = bucket_members(signed.where("keys is not null").select("node", F.explode("keys").alias("key")))
        shared = buckets.select("node").distinct()
        packed = stash(signed.where("shingles is not null").select("node", "shingles").join(shared, "node", "left_semi")
                       .groupBy("node").agg(F.first("shingles").alias("shingles")), "near-shingles")
        crowded = buckets.where(F.col("n") > SMALL_BUCKET).select("node").distinct()
        fine = bucket_members(fine_keys(packed.join(crowded, "node", "left_semi"), idf))
        pairs = stash(candidate_pairs(buckets).unionByName(candidate_pairs(fine)).distinct(), "near-pairs")
        links = stash(verified_links(pairs, packed, idf, similarity), "near-links")
        rest = left_pairs(buckets.unionByName(fine), components(links), pairs)
        links = stash(links.unionByName(verified_links(rest, packed, idf, similarity)), "near-links")
        roots = components(links)
        unsettled = open_nodes(buckets.unionByName(fine), roots)
        rest = prefix_pairs(unsettled, packed, idf, similarity).join(pairs, ["a", "b"], "left_anti")
        links = stash(links.unionByName(verified_links(rest, packed, idf, similarity)), "near-links")
        roots = components(links)
    degrees = (links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
               .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    texts = stash(signed.groupBy("node").agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("copies")), "near-texts")
    linked = texts.join(roots, "node").join(degrees, "node")
    ids = linked.groupBy("root").agg(F.min("text_id").alias("class_id"))
    classes = stash(linked.join(ids, "root").select("node", "root", "class_id", "n_links"), "near-classes")
    by_text = stash(texts.join(classes, "node", "left").select(
        "node", "text_id", F.when(F.col("n_links").isNull(), F.col("text_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "copies"), "near-by-text")
    return signed.select("doc_id", "node").join(by_text, "node").select(
        "doc_id", "text_id", "class_id", "n_links", "copies", "node", "root")


def one_of_each_class(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near duplicates, all columns kept: the row of the class's least doc_id stays.

    Where no member of a class has an id, its least text stays. Of rows with one id and one text,
    one stays.
    """
    classes = near_duplicate_classes(documents, similarity)
    chosen = stash(classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(
        F.min("node").alias("_node"), F.first("class_id").alias("_id")), "near-chosen")
    columns = documents.columns
    keyed = documents.withColumn("_node", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    kept = keyed.join(chosen, (keyed["_node"] == chosen["_node"]) & keyed["doc_id"].eqNullSafe(chosen["_id"]), "left_semi")
    return kept.dropDuplicates(["_node", "doc_id"]).select(*columns)
