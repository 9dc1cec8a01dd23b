"""Token files: ids as Parquet lists with metadata columns that can be read alone."""
from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentilake.llm.common import hold, importable, small_batches, stash

END_ID = 2
MAX_CACHED = 250_000
BYTES_PER_STEP = 4 << 20
WORDS_PER_CALL = 512
SPACE = "\u0120"  # how byte-level vocabularies write a space
ROW_GROUP_BYTES = 64 << 20
PAGE_BYTES = 256 << 10
# A space with white space after it belongs to a run that only the tokenizer may cut.
UNCUT = re.compile(r" (?:\s|\Z)")
# The tokenizer parts letters from punctuation, so a word and the marks that end it are looked up apart: \x01 stands for no space.
WORD_END = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])([!-/:-@\[-`{-~]+)( |\z)"
GLUE = "\x01"


class SegmentEncoder:
    """Encodes texts by the words they repeat.

    The tokenizer never joins a word with what follows its next single space, so texts are
    cut there, and before the marks that end a word; all pieces are numbered, and each distinct one is looked up or encoded once; texts
    with runs of white space are encoded whole. The results are those of the library on the whole
    text, which a test checks on arbitrary strings. Pieces that stand once are not kept; beyond `MAX_CACHED`
    pieces, only those of the texts at hand stay.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text in a document
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, np.bool_)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _bytes(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of words with a space before them, many words a call.

        Every word's space, and nothing else, starts a token, so those tokens part the words.
        """
        lines = [" " + " ".join(words[at:at + WORDS_PER_CALL]) for at in range(0, len(words), WORDS_PER_CALL)]
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, "<u4") for e in found]) if found else np.zeros(0, "<u4")
        data, starts = ids.tobytes(), (4 * np.flatnonzero(self.opens[ids])).tolist()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]

    def _words(self, words: list[str], counts: list[int]) -> list[bytes]:
        """Ids of words with a space before them. Only words that stand more than once in the texts at hand are kept."""
        if len(self.later) > MAX_CACHED:
            kept = self.later
            self.later = {word: kept[word] for word in words if word in kept}
        found = list(map(self.later.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(new, self._spaced([words[k] for k in new]), strict=True):
            found[k] = ids
            if counts[k] > 1:
                self.later[words[k]] = ids
        return found

    def encode_joined(self, texts: list[str], tail: bytes = b"") -> tuple[pa.Buffer, np.ndarray]:
        """Ids of all texts in one buffer, `tail` after each, and where each text's begin in it (in ids), with the end.

        All words are numbered in one call; each distinct one is looked up once, and ids are then taken by number.
        """
        whole = [k for k, text in enumerate(texts) if GLUE in text or UNCUT.search(text)]
        rest = list(texts)
        for k in whole:
            rest[k] = ""
        cut = pc.replace_substring_regex(pa.array(rest, pa.large_string()), pattern=WORD_END, replacement=rf"\1 {GLUE}\2\3")
        lists = pc.split_pattern(cut, " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        heads = starts[:-1]
        head_words, head_at = np.unique(at[heads], return_inverse=True)
        counts = np.bincount(at, minlength=len(words)) - np.bincount(at[heads], minlength=len(words))
        glued = pc.starts_with(coded.dictionary, GLUE).to_numpy(zero_copy_only=False)
        spaced, ends = np.flatnonzero((counts > 0) & ~glued), np.flatnonzero(glued)
        unit_of = np.zeros(len(words), np.int64)
        unit_of[spaced] = np.arange(len(spaced))
        unit_of[ends] = len(spaced) + len(head_words) + np.arange(len(ends))
        names = [*(words[k] for k in head_words.tolist()), *(words[k][1:] for k in ends.tolist())]
        if len(self.first) > MAX_CACHED:
            self.first = {}
        new = [name for name in names if name not in self.first]
        self.first.update(zip(new, self._bytes(new)))
        units = [*self._words([words[k] for k in spaced.tolist()], counts[spaced].tolist()), *[self.first[name] for name in names],
                 *self._bytes([texts[k] for k in whole]), tail]
        at = unit_of[at]
        at[heads] = len(spaced) + head_at
        at[heads[whole]] = len(spaced) + len(names) + np.arange(len(whole))
        order = np.insert(at, starts[1:], len(units) - 1)
        ids = pa.array(units, pa.large_binary()).take(pa.array(order))
        _, offsets, data = ids.buffers()
        begins = np.frombuffer(offsets, np.int64, len(order) + 1)[starts + np.arange(len(starts))] // 4
        return data, begins

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers, without an end id."""
        data, begins = self.encode_joined(texts)
        ids = data.to_pybytes() if data is not None else b""
        return [ids[4 * a:4 * b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> SegmentEncoder:
    return SegmentEncoder(path)


def _tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Places from and to which rows are encoded at once: about `BYTES_PER_STEP` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + BYTES_PER_STEP, side="right")))
        yield at, to
        at = to


def _encode_partition(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    hold("tokens", encoder.cache_clear)
    enc, tail = encoder(_tokenizer_path(tokenizer)), np.asarray([end_id], "<u4").tobytes()
    part, start = TaskContext.get().partitionId(), 0
    for whole in batches:
        for at, to in _steps(whole.column(1)):
            batch = whole.slice(at, to - at)
            data, begins = enc.encode_joined([t or "" for t in batch.column(1).to_pylist()], tail)
            values = pa.Array.from_buffers(pa.int32(), int(begins[-1]), [None, data])
            lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(start + begins[:-1]),
                 pa.array(np.diff(begins)), lists], names=["doc_id", "part", "first", "n_tokens", "ids"])
            start += int(begins[-1])


def write_token_files(documents: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json",
                      end_id: int = END_ID) -> None:
    """Encode doc_id and text in ascending doc_id order into a folder of token files.

    `path`/tokens holds one row per document: doc_id, the number of its file, its first
    token's place in that file, its number of tokens and the ids. Ids are dictionary-coded
    lists; the metadata columns are delta-coded, so they are tiny and can be read alone; page
    indexes (which Spark's writer keeps) let a reader skip to a doc_id or a place. `path`/index
    has one row per file with the tokens before it.

    Documents are dealt by ranges of doc_id, and equal ids by their place in the input, so one
    id with many rows is spread. Null texts count as empty and are the end id alone; a null
    id comes first; repeated rows are written again; an empty table makes empty files. Other
    columns are not read. `tokenizer` names a file of the public tokenizers.
    """
    spark = importable(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    ordered = (documents.select("doc_id", "text", F.monotonically_increasing_id().alias("_place"))
               .repartitionByRange("doc_id", "_place").sortWithinPartitions("doc_id", "_place").select("doc_id", "text"))
    coded = ordered.mapInArrow(
        lambda batches: _encode_partition(batches, tokenizer, end_id),
        f"doc_id {kind}, part int, first bigint, n_tokens bigint, ids array<int>")
    with small_batches(spark):
        (coded.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
         .option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "true")
         .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#first", "false")
         .option("parquet.enable.dictionary#n_tokens", "false").parquet(f"{path}/tokens"))
    files = (spark.read.parquet(f"{path}/tokens").groupBy("part")
             .agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs")))
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files.select("part", before.alias("base"), "n_tokens", "n_docs").coalesce(1).write.parquet(f"{path}/index")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids, in the files' order.

    Without `ids`, only the metadata pages are read.
    """
    index = spark.read.parquet(f"{path}/index").select("part", "base")
    return (spark.read.parquet(f"{path}/tokens").join(index, "part")
            .select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hold("checksums", lambda: None)  # the words of the encoder are needed no longer
    for batch in batches:
        lists = batch.column("ids")
        ids, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        sums = [zlib.crc32(np.ascontiguousarray(ids[a:b])) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets).astype(np.int64)),
             pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digest(tokens: DataFrame) -> DataFrame:
    """What the files hold of each document: doc_id, start, n_tokens and the crc32 of its ids. It is worked out at once."""
    spark = importable(tokens.sparkSession)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    with small_batches(spark):
        return stash(tokens.select("doc_id", "start", "ids").mapInArrow(
            _checksums, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"), "token-digest")
