"""Joins between token streams and lookup tables that survive hot tokens.

A frequent word may carry a large share of all token rows, so a shuffle keyed by
token alone would send that share to one task. A lookup table is broadcast only
after its row count has been checked (or is bounded by construction); beyond the
limit the join is salted, which spreads every token over `salts` tasks.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
SALTS = 32
MAX_CLASSES = 1_000


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Count at most `max_rows` + 1 rows of a lookup table."""
    return table.limit(max_rows + 1).count() <= max_rows


def salted_lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
                  spread_by: str = "row_id", salts: int = SALTS) -> DataFrame:
    """Shuffle join in which one hot key is shared by `salts` tasks.

    The table is repeated once per salt, so it should be the small side; the large
    side stays as it is. Only inner, left and left_semi keep their meaning here.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join type for a salted lookup: {how}")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
           spread_by: str = "row_id", bounded: bool | None = None,
           salts: int = SALTS) -> DataFrame:
    """Join rows with a lookup table that is unique per key.

    `bounded=True` states that the table is small by construction (a literal list, a
    top-k); `False` that it grows with the data; `None` counts it first.
    """
    small = fits_broadcast(table) if bounded is None else bounded
    if small:
        return rows.join(F.broadcast(table), list(on), how)
    # A table counted as too large is never broadcast: Spark's estimate of its salted copies leaves out the copying.
    return salted_lookup(rows, table if bounded is not None else table.hint("merge"), on, how, spread_by, salts)


def class_map(stats: DataFrame, key: str, *values: str) -> Column:
    """A per-class table as one map value, for use as a scalar subquery.

    Replaces a join keyed by class, where one class may hold most rows. The number
    of classes is checked while the subquery runs.
    """
    entry = F.struct(F.col(key), F.struct(*values) if len(values) > 1 else F.col(values[0]))
    entries = F.collect_list(entry)
    checked = F.when(F.count(F.lit(1)) > MAX_CLASSES,
                     F.raise_error(F.lit("too many classes for a class lookup")).cast("void"))
    return stats.where(F.col(key).isNotNull()).agg(
        F.coalesce(checked, F.map_from_entries(entries)).alias("m")).scalar()
