"""Bag-of-words and word-vector features in long, sparse form."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentilake.functions.text import clean_vector, tokenize
from sentilake.operators.joins import class_map, fits_broadcast, lookup
from sentilake.session import materialize

MAX_FEATURES = 5_000

# --- fixed value: bytes of tokens in a block of reviews ---
BLOCK_BYTES = 32 << 20


def _text_tokens(text_col: str, kind: str) -> Column:
    return tokenize(F.coalesce(F.col(text_col), F.lit("")), kind)


def term_totals(df: DataFrame, text_col: str = "review_text", kind: str = "words2") -> DataFrame:
    """(term, n, docs): occurrences and number of documents, in one pass and one shuffle.

    The document count comes from each text's distinct terms, so no distinct aggregate
    over (document, term) pairs is needed, and a frequent term is summed before it moves.
    """
    tokens = df.select(_text_tokens(text_col, kind).alias("_t"))
    # The tokens (0) and the distinct ones (1) are exploded as they are: no function is called for each token.
    parts = tokens.select(F.posexplode(F.array("_t", F.array_distinct("_t"))).alias("d", "_part"))
    rows = parts.select("d", F.explode("_part").alias("term"))
    return rows.groupBy("term").agg(F.sum(1 - F.col("d")).alias("n"), F.sum("d").alias("docs"))


def bow_vocabulary(df: DataFrame, text_col: str = "review_text", max_features: int = MAX_FEATURES,
                   min_df: int = 1, max_df: float = 1.0, kind: str = "words2") -> DataFrame:
    """(term, n, docs, idx): the most frequent terms, numbered alphabetically.

    Terms in fewer than `min_df` documents or in more than the share `max_df` are left out.
    """
    totals = term_totals(df, text_col, kind)
    if max_df < 1.0:
        total = df.agg(F.count(F.lit(1)).alias("c")).scalar()
        totals = totals.where(F.col("docs") <= total * F.lit(max_df))
    if min_df > 1:
        totals = totals.where(F.col("docs") >= min_df)
    top = totals.orderBy(F.desc("n"), "term").limit(max_features)
    # At most `max_features` rows are numbered.
    return top.withColumn("idx", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("term")) - 1)


def fit_vocabulary(df: DataFrame, text_col: str = "review_text", **limits) -> DataFrame:
    """`bow_vocabulary`, written once: counting, statistics and models all read it."""
    return materialize(bow_vocabulary(df, text_col, **limits))


def bow_counts(df: DataFrame, vocabulary: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
               kind: str = "words2", bounded: bool | None = None) -> DataFrame:
    """(row_id, term, idx, n) for the vocabulary's terms.

    The vocabulary's size is checked, so pass one from `fit_vocabulary`.
    """
    tokens = df.select(row_id, F.explode(_text_tokens(text_col, kind)).alias("term"))
    return (lookup(tokens, vocabulary.select("term", "idx"), ["term"], "inner", spread_by=row_id, bounded=bounded)
            .groupBy(row_id, "term", "idx").agg(F.count(F.lit(1)).alias("n")))


def bow_wide(df: DataFrame, vocabulary: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
             kind: str = "words2") -> DataFrame:
    """One column per term of the vocabulary, zeros included. Counted inside each row: no shuffle."""
    terms = [r["term"] for r in vocabulary.orderBy("idx").select("term").collect()]
    counted = bow_vectors(df.select(row_id, text_col), vocabulary, text_col, kind, "_counts")
    dense = counted.select(row_id, vector_to_array("_counts").alias("_n"))
    return dense.select(row_id, *[F.get("_n", F.lit(k)).cast("bigint").alias(t) for k, t in enumerate(terms)])


def bow_stats(df: DataFrame, vocabulary: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
              kind: str = "words2") -> DataFrame:
    """One row: documents, vocabulary, non_zeros, density %, all_zero_rows, empty_texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.agg(F.count(F.lit(1)).alias("documents"),
                  F.count_if(~text.rlike(r"[^\t\n\x0B\f\r \x1C-\x1F\x85\p{Z}]")).alias("empty_texts"))
    per_row = bow_counts(df, vocabulary, text_col, row_id, kind).groupBy(row_id).agg(
        F.count(F.lit(1)).alias("k"))
    cells = per_row.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("non_zeros"),
                        F.count(F.lit(1)).alias("filled"))
    size = vocabulary.agg(F.count(F.lit(1)).alias("v")).scalar()
    both = docs.select("*", cells.select(F.struct("non_zeros", "filled").alias("c")).scalar().alias("c"),
                       size.alias("vocabulary"))
    return both.select(
        "documents", "vocabulary", F.col("c.non_zeros").alias("non_zeros"),
        (F.col("c.non_zeros") * 100 / (F.col("documents") * F.col("vocabulary"))).alias("density"),
        (F.col("documents") - F.col("c.filled")).alias("all_zero_rows"), "empty_texts")


def bow_vectors(df: DataFrame, vocabulary: DataFrame, text_col: str = "review_text", kind: str = "words2",
                name: str = "features") -> DataFrame:
    """Add a SparseVector of term counts, without a shuffle of the reviews.

    Only the vocabulary (a top-k) comes to the driver, as the vectorizer model's word list.
    """
    terms = [r["term"] for r in vocabulary.orderBy("idx").select("term").collect()]
    model = CountVectorizerModel.from_vocabulary(terms, "_tokens", name)
    return model.transform(df.withColumn("_tokens", _text_tokens(text_col, kind))).drop("_tokens")


def document_vectors(df: DataFrame, vectors: DataFrame, dim: int, text_col: str = "review_text",
                     row_id: str = "row_id", lowercase: bool = True, bounded: bool | None = None) -> DataFrame:
    """(row_id, vec): mean of the known tokens' vectors, counted per occurrence; zeros if none.

    Sums are taken per review before the shuffle, so one row per review moves. A table too large for a
    broadcast is dealt to blocks of reviews, to each block what it needs.
    """
    text = F.coalesce(F.col(text_col), F.lit("nan"))
    tokens = tokenize(F.lower(text) if lowercase else text, "whitespace")
    if fits_broadcast(vectors) if bounded is None else bounded:
        rows = df.select(row_id, F.explode_outer(tokens).alias("token"))
        found = lookup(rows, vectors.select("token", F.col("vec").cast("array<double>").alias("vec")), ["token"], "left", bounded=True)
        sums = found.groupBy(row_id).agg(F.count("vec").alias("_k"), *[
            F.sum(F.get("vec", F.lit(i))).alias(f"_s{i}") for i in range(dim)])
    else:
        sums = _block_sums(df.select(F.col(row_id), (F.lower(text) if lowercase else text).alias("_x")), vectors, dim, row_id)
    means = [F.when(F.col("_k") > 0, F.col(f"_s{i}") / F.col("_k")).otherwise(0.0) for i in range(dim)]
    return sums.select(row_id, F.array(*means).alias("vec"))


def _block_sums(rows: DataFrame, vectors: DataFrame, dim: int, row_id: str) -> DataFrame:
    """(row_id, _k, _s0, ...): number and sums of the known tokens' vectors, for a table of any size.

    A block of rows gets each vector it needs once, however often its tokens occur, and adds up there. Joining
    token by token would send a vector, or a row of partial sums, for each token.
    """
    size = rows.agg(F.sum(F.octet_length("_x").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    placed = rows.select(F.col(row_id), "_x", F.pmod(F.xxhash64(row_id), F.lit(blocks)).cast("int").alias("_block"))
    tokens = tokenize(F.col("_x"), "whitespace")
    # Texts are dealt as they are; as lists of tokens they would take more than twice the room.
    parts = max(blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = placed.repartition(parts, "_block").select(F.col(row_id), tokens.alias("_t"), "_block")
    padded = vectors.select("token", F.col("vec").isNotNull().cast("int").alias("has"), F.array(*[F.get("vec", F.lit(i)) for i in range(dim)]).alias("vec"))
    needed = placed.select(F.col("_block").alias("_for"), F.explode(F.array_distinct(tokens)).alias("token")).distinct().join(padded.hint("merge"), "token")
    kind = held.schema[row_id].dataType.simpleString()
    out = ", ".join([f"`{row_id}` {kind}", "_k bigint", *(f"_s{i} double" for i in range(dim))])

    def add(texts: pa.Table, known: pa.Table) -> pa.Table:
        lists = texts.column("_t").combine_chunks()
        length = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        # A token may have several vectors: their sums and numbers, of all and of each component that is not null.
        token = known.column("token").combine_chunks().dictionary_encode()
        place, flat = token.indices.to_numpy(zero_copy_only=False), known.column("vec").combine_chunks().flatten()
        present = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, dim)
        values = np.where(present, flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim), 0.0)
        by_token = lambda x: np.bincount(place, x, len(token.dictionary))
        has, whole = by_token(known.column("has").to_numpy()), [by_token(values[:, i]) for i in range(dim)]
        partial = {i: by_token(present[:, i]) for i in np.flatnonzero(~present.all(axis=0))}
        at = pc.index_in(lists.flatten(), value_set=token.dictionary).fill_null(-1).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(length)), length)
        hits = np.flatnonzero(at >= 0)
        row, at, n = row[hits], at[hits], len(length)
        sums = [pa.array(np.bincount(row, x[at], n), mask=np.bincount(row, partial[i][at], n) == 0 if i in partial else None) for i, x in enumerate(whole)]
        return pa.table([texts.column(row_id), pa.array(np.bincount(row, has[at], n).astype(np.int64)), *sums], names=[row_id, "_k", *(f"_s{i}" for i in range(dim))])

    part = held.groupBy("_block").cogroup(needed.groupBy("_for")).applyInArrow(add, out)
    return part.groupBy(row_id).agg(F.sum("_k").alias("_k"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(dim)])


def clean_vectors(df: DataFrame, vec: str = "vec") -> DataFrame:
    return df.withColumn(vec, clean_vector(F.col(vec)))


def drop_constant_features(counts: DataFrame, documents: Column, row_id: str = "row_id") -> DataFrame:
    """(term) with more than one value over all documents; absent terms count as 0."""
    spread = counts.groupBy("term").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    low = F.when(F.col("k") < documents, F.least(F.col("lo"), F.lit(0))).otherwise(F.col("lo"))
    return spread.where(F.col("hi") != low).select("term")


def label_codes(df: DataFrame, label: str) -> DataFrame:
    """(label, code): alphabetical codes from 0."""
    return (df.select(label).where(F.col(label).isNotNull()).distinct()
            .withColumn("code", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(label)) - 1))


def encode_labels(df: DataFrame, label: str, name: str = "label_encoded") -> DataFrame:
    """Add the alphabetical code of the label."""
    return df.withColumn(name, class_map(label_codes(df, label), label, "code")[F.col(label)])


def decode_labels(df: DataFrame, code: str, classes: list[str], name: str) -> DataFrame:
    """Add the class name of a code; unknown codes are null."""
    names = F.array(*[F.lit(c) for c in classes])
    return df.withColumn(name, F.when(F.col(code) >= 0, F.get(names, F.col(code).cast("int"))))
