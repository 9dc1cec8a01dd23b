"""Matching tables by position."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from sentilake.operators.ranking import with_position


def align_by_position(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Join tables on their rows' positions; the result is as long as the shortest table.

    Each table comes with a unique order column. Positions are computed per value
    range, and the positional match is an equi-join, so no task sees a whole table. The
    columns of each table are prefixed with its name.
    """
    out: DataFrame | None = None
    for name, (df, order_col) in tables.items():
        placed = with_position(df, order_col)
        placed = placed.select("position", *[placed[c].alias(f"{name}_{c}") for c in df.columns])
        out = placed if out is None else out.join(placed, "position")
    if out is None:
        raise ValueError("no tables given")
    return out
