"""How far the sources of a language differ in their terms, with every distinct chunk tokenized once."""
from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentilake.llm.common import importable, stash

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MIN_DOCUMENTS = 30
TOP_TERMS = 50
BLOCK_PAIRS = 3_000_000
BLOCK_CHUNKS = 1_000_000
MIN_BUCKETS = 8
PACKED_ROWS = 16
BLOCK_CELLS = 100_000
FILTER_BITS = 24


@dataclass(frozen=True)
class Counts:
    """Keys, each with `fan` entries in a row: the group (a language and a source), occurrences and documents."""
    keys: dict[str, pa.Array]
    fan: np.ndarray
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray
    groups: list[tuple[str, str]]

    def pack(self, bucket: np.ndarray) -> pa.Table:
        """One row for each bucket of keys that occurs, with the bucket's keys and entries as lists."""
        order = np.argsort(bucket, kind="stable")
        opens = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        rows, entries = len(opens), ranges((np.cumsum(self.fan) - self.fan)[order], self.fan[order])

        def lists(values: pa.Array, at: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)

        at_keys = np.append(opens, len(order))
        at_entries = np.concatenate(([0], np.cumsum(self.fan[order])))[at_keys]
        at_groups = np.arange(rows + 1) * len(self.groups)
        return pa.table({
            "bucket": pa.array(bucket[order][opens]),
            **{name: lists(values.take(pa.array(order)), at_keys) for name, values in self.keys.items()},
            "fan": lists(pa.array(self.fan[order], pa.int32()), at_keys),
            **{name: lists(pa.array(values[entries]), at_entries) for name, values in
               (("grp", self.group.astype(np.int32)), ("n", self.n), ("docs", self.docs))},
            **{name: lists(pa.array([g[i] for g in self.groups] * rows, pa.string()), at_groups) for i, name in enumerate(("langs", "sources"))}})

    @staticmethod
    def unpack(packed: pa.Table, *keys: str) -> Counts:
        packed = packed.combine_chunks()

        def flat(name: str) -> pa.Array:
            return pa.concat_arrays([c.flatten() for c in packed.column(name).chunks]) if packed.num_rows else pa.array([], packed.schema.field(name).type.value_type)

        def number(name: str) -> np.ndarray:
            return flat(name).to_numpy(zero_copy_only=False).astype(np.int64)

        def sizes(name: str) -> np.ndarray:
            return np.asarray(pc.list_value_length(packed.column(name)).to_numpy(), np.int64)

        known: defaultdict[tuple[str, str], int] = defaultdict(count().__next__)
        codes = np.fromiter(map(known.__getitem__, zip(flat("langs").to_pylist(), flat("sources").to_pylist())), np.int64)
        own = sizes("langs")
        group = codes[np.repeat(np.cumsum(own) - own, sizes("grp")) + number("grp")] if len(codes) else codes
        return Counts({k: flat(k) for k in keys}, number("fan"), group, number("n"), number("docs"), list(known))


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each size, one after the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def by_key(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, an order that puts equal keys together, and where each key begins in it."""
    order = np.argsort(key, kind="stable")
    opens = np.flatnonzero(np.diff(key[order], prepend=-1))
    return key[order][opens], order, opens


def hashes(texts: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, texts), np.int64)


class ChunkBlock:
    """Chunks of some documents as numbers, counted per document."""

    def __init__(self):
        self.chunks: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.groups: defaultdict[tuple[str, str], int] = defaultdict(count().__next__)
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.owners: list[int] = []
        self.pairs = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        found = Counter(text.split())  # bytes are parted at the six ASCII spaces alone
        self.codes.append(np.fromiter(map(self.chunks.__getitem__, found), np.int32, len(found)))
        self.times.append(np.fromiter(found.values(), np.int32, len(found)))
        self.owners.append(self.groups[lang, source])
        self.pairs += len(found)

    def full(self) -> bool:
        return self.pairs >= BLOCK_PAIRS or len(self.chunks) >= BLOCK_CHUNKS or len(self.codes) >= BLOCK_PAIRS

    def packed(self, buckets: int) -> pa.Table:
        """Occurrences and documents per chunk, language and source, in one row for each bucket of chunks."""
        width = len(self.groups)
        owner = np.repeat(np.array(self.owners, np.int64), np.fromiter(map(len, self.codes), np.int64))
        cells, order, opens = by_key(np.concatenate(self.codes).astype(np.int64) * width + owner)
        n = np.add.reduceat(np.concatenate(self.times)[order].astype(np.int64), opens) if len(opens) else cells
        names = pa.array(list(self.chunks), pa.binary()).cast(pa.string())
        counts = Counts({"chunk": names}, np.bincount(cells // width, minlength=len(names)), cells % width, n,
                        np.diff(opens, append=len(order)), list(self.groups))
        return counts.pack(hashes(self.chunks) % buckets)


def _count_chunks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    block = ChunkBlock()
    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            block.add(*row)
            if block.full():
                yield from block.packed(buckets).to_batches(max_chunksize=PACKED_ROWS)
                block = ChunkBlock()
    if block.codes:
        yield from block.packed(buckets).to_batches(max_chunksize=PACKED_ROWS)


def _join_terms(packed: pa.Table, buckets: int) -> pa.Table:
    """Sum the counts of a bucket's chunks, tokenize each chunk once and join its terms back; packed by the hash of the term."""
    counts = Counts.unpack(packed, "chunk")
    coded, width = counts.keys["chunk"].dictionary_encode(), max(len(counts.groups), 1)
    chunk = np.repeat(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts.fan)
    cells, order, opens = by_key(chunk * width + counts.group)
    n, docs = (np.add.reduceat(x[order], opens) if len(opens) else x for x in (counts.n, counts.docs))

    of_chunk = [TERM.findall(text.translate(LOWER)) for text in coded.dictionary.to_pylist()]
    terms = pa.array(list(chain.from_iterable(of_chunk)), pa.string()).dictionary_encode()
    distinct = max(len(terms.dictionary), 1)
    pairs, times = np.unique(np.repeat(np.arange(len(of_chunk)) * distinct, np.fromiter(map(len, of_chunk), np.int64))
                             + terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
    of_pair, term = pairs // distinct, pairs % distinct
    fan = np.bincount(cells // width, minlength=len(of_chunk))
    entry = ranges((np.cumsum(fan) - fan)[of_pair], fan[of_pair])
    joined = Counts({"chunk": coded.dictionary.take(pa.array(of_pair)), "term": terms.dictionary.take(pa.array(term))}, fan[of_pair],
                    (cells % width)[entry], n[entry] * np.repeat(times, fan[of_pair]), docs[entry], counts.groups)
    return joined.pack((hashes(t.encode() for t in terms.dictionary.to_pylist()) % buckets)[term])


def _possible_terms(packed: pa.Table, min_documents: int) -> pa.Table:
    """Counts of the terms whose documents may reach the limit, and the chunks of those whose bounds do not decide.

    Documents of a term are at least those of its commonest chunk in each source, at most the sum over chunks.
    """
    counts = Counts.unpack(packed, "chunk", "term")
    names, width = counts.keys["term"].dictionary_encode(), max(len(counts.groups), 1)
    pair = np.repeat(np.arange(len(counts.fan)), counts.fan)
    term = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[pair]
    lang_names = sorted({lang for lang, _ in counts.groups})
    lang_of = np.array([lang_names.index(lang) for lang, _ in counts.groups], np.int64)
    langs = max(len(lang_names), 1)

    cells, order, opens = by_key(term * width + counts.group)
    n, most, least = ((f.reduceat(x[order], opens) if len(opens) else x) for f, x in
                      ((np.add, counts.n), (np.add, counts.docs), (np.maximum, counts.docs)))
    in_lang = cells // width * langs + lang_of[cells % width] if len(cells) else cells
    both, lang_order, lang_opens = by_key(in_lang)
    at_least, at_most = (np.add.reduceat(x[lang_order], lang_opens) if len(lang_opens) else x for x in (least, most))
    where = np.searchsorted(both, in_lang)
    kept = np.flatnonzero(at_most[where] >= min_documents) if len(both) else where
    sources = pa.array([source for _, source in counts.groups], pa.string())
    lang_names = pa.array(lang_names, pa.string())
    out = pa.table({"lang": lang_names.take(pa.array(in_lang[kept] % langs)), "source": sources.take(pa.array(cells[kept] % width)),
                    "term": names.dictionary.take(pa.array(cells[kept] // width)), "n": n[kept], "at_least": at_least[where[kept]],
                    "at_most": at_most[where[kept]], "chunks": pa.nulls(len(kept), pa.list_(pa.string()))})

    undecided = (at_least < min_documents) & (at_most >= min_documents)
    of_entry = np.searchsorted(both, term * langs + lang_of[counts.group]) if len(both) else term
    wanted = np.flatnonzero(undecided[of_entry]) if len(both) else of_entry
    held = np.unique(of_entry[wanted] * max(len(counts.fan), 1) + pair[wanted])
    owner, chunk = held // max(len(counts.fan), 1), held % max(len(counts.fan), 1)
    listed = np.flatnonzero(np.diff(owner, prepend=-1))
    key = both[owner[listed]]
    none = pa.nulls(len(listed), pa.int64())
    rows = pa.table({"lang": lang_names.take(pa.array(key % langs)), "source": pa.nulls(len(listed), pa.string()),
                     "term": names.dictionary.take(pa.array(key // langs)), "n": none, "at_least": none, "at_most": none,
                     "chunks": pa.ListArray.from_arrays(pa.array(np.append(listed, len(held)).astype(np.int32)),
                                                        counts.keys["chunk"].take(pa.array(chunk)))})
    return pa.concat_tables([out, rows])


def possible_terms(docs: DataFrame, min_documents: int) -> DataFrame:
    """lang, source, term, n, at_least, at_most of terms that may be kept, and, in rows without a source, the chunks of undecided ones.

    Counts travel as lists, a row for each block of documents and bucket of chunks, then for each
    bucket of chunks and bucket of terms. There are twice as many buckets as input partitions, so a bucket
    holds about as much on any amount of data, and a chunk adds one entry per block, language and source.
    """
    importable(docs.sparkSession)
    buckets = max(MIN_BUCKETS, 2 * docs.rdd.getNumPartitions())
    counts = "fan array<int>, grp array<int>, n array<bigint>, docs array<bigint>, langs array<string>, sources array<string>"
    chunks = docs.select("lang", "source", "text").mapInArrow(
        lambda batches: _count_chunks(batches, buckets), f"bucket bigint, chunk array<string>, {counts}")
    terms = chunks.groupBy("bucket").applyInArrow(
        lambda packed: _join_terms(packed, buckets), f"bucket bigint, chunk array<string>, term array<string>, {counts}")
    return terms.groupBy("bucket").applyInArrow(
        lambda packed: _possible_terms(packed, min_documents),
        "lang string, source string, term string, n bigint, at_least bigint, at_most bigint, chunks array<string>")


def hash_filter(chunks: DataFrame) -> np.ndarray:
    """One bit for each value of the low `FILTER_BITS` bits of a chunk's crc32: 2 MB however many chunks there are."""
    low = (F.crc32(F.col("chunk").cast("binary")).bitwiseAND((1 << FILTER_BITS) - 1) + 1).alias("_low")
    parts = chunks.select(low).groupBy(F.bitmap_bucket_number("_low").alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_low")).alias("bits")).collect()
    bits = np.zeros(1 << FILTER_BITS, bool)
    for part in parts:
        known = np.unpackbits(np.frombuffer(bytes(part["bits"]), np.uint8), bitorder="little")
        bits[(part["at"] - 1) * len(known):part["at"] * len(known)] = known
    return np.packbits(bits)


def chunks_in_documents(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """lang, _doc, chunk: once per document each chunk that may be among `chunks`; the filter lets few others through."""
    packed = hash_filter(chunks)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = np.unpackbits(packed).tobytes(), (1 << FILTER_BITS) - 1
        seen: dict[bytes, bool] = {}
        for batch in batches:
            rows, found = [], []
            if len(seen) > BLOCK_CHUNKS:
                seen = {}
            for at, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
                words = set(text.split())
                for w in words.difference(seen):
                    seen[w] = bool(bits[crc32(w) & mask])
                some = [w for w in words if seen[w]]
                found += some
                rows += [at] * len(some)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at),
                                              pa.array(found, pa.binary()).cast(pa.string())], names=["lang", "_doc", "chunk"])

    return docs.select("lang", F.monotonically_increasing_id().alias("_doc"), "text").mapInArrow(
        pick, "lang string, _doc bigint, chunk string")


def term_statistics(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """(kept, counts): the terms in at least `min_documents` documents of their language, and their counts.

    `kept` has lang, term, n, at_least and at_most; `counts` has lang, source, term, n for kept terms.

    Chunks between white space are counted per document; each distinct chunk is tokenized once and its
    terms are joined back to the chunk's counts, which gives exact occurrences. Where the bounds of a
    term's documents lie on either side of the limit, the documents that hold its chunks are joined with its
    terms and distinct documents are counted; at_least and at_most are then both that count. So
    only rare chunks of undecided terms are ever shuffled with their documents.
    """
    filled = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    possible = stash(possible_terms(filled, min_documents), "possible-terms")
    chunks = possible.where("source IS NULL").select("lang", F.explode("chunks").alias("chunk"), "term")
    exact = (chunks_in_documents(filled, chunks).join(chunks, ["lang", "chunk"])
             .groupBy("lang", "term", "_doc").agg(F.count(F.lit(1)).alias("_n"))
             .groupBy("lang", "term").agg(F.count(F.lit(1)).alias("_docs")))
    counts = possible.where("source IS NOT NULL")
    kept = stash(counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.max("at_least").alias("at_least"), F.max("at_most").alias("at_most"))
                 .join(exact, ["lang", "term"], "left").select(
        "lang", "term", "n", F.coalesce("_docs", "at_least").alias("at_least"), F.coalesce("_docs", "at_most").alias("at_most"))
        .where(F.col("at_least") >= min_documents), "kept")
    return kept, stash(counts.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"), "kept-counts")


def _with_share(rows: DataFrame, name: str, n: str = "n") -> DataFrame:
    """1 + floor(10^9 (n + 5) / (total + 5 kept)) in decimals, so nothing overflows or is rounded; 1 where nothing is kept."""
    return rows.withColumn(name, F.expr(
        f"CASE WHEN kept > 0 THEN 1 + (1000000000BD * CAST({n} + 5 AS DECIMAL(19, 0))) div CAST(total + 5 * kept AS DECIMAL(19, 0)) ELSE 1L END"))


def _block_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Sum of the absolute differences over the block's terms, for every two sources of the language."""
    head = rows[rows["term"].isna()]
    sources, plain = head["source"].to_numpy(object), head["p"].to_numpy(np.int64)
    place = {s: k for k, s in enumerate(sources)}
    cells = rows[rows["term"].notna()]
    term, distinct = pd.factorize(cells["term"])
    table = np.tile(plain, (len(distinct), 1))
    table[term, cells["source"].map(place).to_numpy(np.int64)] = cells["p"].to_numpy(np.int64)
    out = []
    for k, source in enumerate(sources):
        value = np.abs(table - table[:, k:k + 1]).sum(axis=0)
        others = np.arange(len(sources)) != k
        out.append(pd.DataFrame({"lang": head["lang"].iloc[0], "source": source, "item": sources[others], "value": value[others]}))
    return pd.concat(out)


def audit_sources(documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Compare the sources of every language: lang, source, part, item, value, rank.

    Part `pair` has, for each other source of the language, the summed absolute difference of the smoothed
    shares of all kept terms; part `term` the terms that the source holds beyond the language's share, the
    first `top_terms` of them. Ranks go by value, greatest first, then by item. Shares are
    in billionths, one added, with 5 occurrences added to each term; sums are whole numbers.

    Kept terms are dealt to blocks of about a hundred thousand cells (terms times sources), and a block's
    sums of all pairs of sources are added up, so no pair of sources is emitted once per term.

    Null text, lang and source count as empty texts. Empty and very long texts and chunks are read whole;
    repeated rows count again; ties of value go by the item's UTF-8 bytes; a source without
    a kept term takes part with a count of 0; an empty table gives no rows; other columns are not read.
    """
    kept, counts = term_statistics(documents, min_documents)
    groups = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stash(groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0), "groups")
    counts = counts.join(groups, ["lang", "source"])
    largest = groups.groupBy("lang").agg((F.count(F.lit(1)) * F.max("kept")).alias("cells")).agg(F.max("cells")).first()[0] or 0
    blocks = 1 + largest // BLOCK_CELLS

    head = _with_share(groups.withColumn("n", F.lit(0).cast("long")), "p").select(
        "lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"), "source", F.lit(None).cast("string").alias("term"), "p")
    cells = _with_share(counts, "p").select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("_block"), "source", "term", "p")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (head.unionByName(cells).groupBy("lang", "_block")
             .applyInPandas(_block_pairs, "lang string, source string, item string, value bigint")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")))

    beyond = _with_share(counts.join(kept.select("lang", "term", F.col("n").alias("_all")), ["lang", "term"]), "p")
    beyond = _with_share(beyond.withColumn("total", F.col("lang_total")), "q", "_all").where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = beyond.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
