"""Edit distance with adjacent transpositions, decided exactly up to two edits."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentilake.functions.text import let


def _common_prefix(a: Column, b: Column) -> Column:
    """Number of equal leading characters (both strings non-empty)."""
    last = F.least(F.length(a), F.length(b))
    return F.aggregate(
        F.sequence(F.lit(1), last), F.lit(0),
        lambda n, i: F.when((n == i - 1) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))), i)
        .otherwise(n))


def _core(a: Column, skip: Column, tail: Column) -> Column:
    return F.substring(a, skip + 1, F.length(a) - skip - tail)


def _swap_head(s: Column, t: Column) -> Column:
    return ((F.substring(s, 1, 1) == F.substring(t, 2, 1))
            & (F.substring(s, 2, 1) == F.substring(t, 1, 1)))


def _rest(s: Column, start: int, drop_end: int) -> Column:
    """Characters from 1-based `start`, without the last `drop_end`."""
    return F.substring(s, F.lit(start), F.greatest(F.length(s) - (start - 1) - drop_end, F.lit(0)))


def _swap_then_edit(s: Column, t: Column) -> Column:
    """One swap at the head, then exactly one more edit at the tail of the core."""
    ls, lt = F.length(s), F.length(t)
    head = _swap_head(s, t) & (ls >= 2) & (lt >= 2)
    replace_last = (ls == lt) & (ls >= 3) & (_rest(s, 3, 1) == _rest(t, 3, 1))
    longer_s = (ls == lt + 1) & (_rest(s, 3, 1) == _rest(t, 3, 0))
    longer_t = (lt == ls + 1) & (_rest(s, 3, 0) == _rest(t, 3, 1))
    return head & (replace_last | longer_s | longer_t)


def _two_swaps(s: Column, t: Column) -> Column:
    n = F.length(s)
    tail_swap = ((F.substring(s, -1, 1) == F.substring(t, -2, 1))
                 & (F.substring(s, -2, 1) == F.substring(t, -1, 1)))
    return (n == F.length(t)) & (n >= 4) & _swap_head(s, t) & tail_swap & (_rest(s, 3, 2) == _rest(t, 3, 2))


def _left_over(a: Column, b: Column) -> Column:
    """How many characters of `a` do not occur in `b` at all."""
    return F.length(F.call_function("translate", a, b, F.lit("")))


def edits_within_two(a: Column, b: Column) -> Column:
    """Edit distance 0, 1 or 2, counting a swap of neighbours as one edit; null if larger.

    No substring is edited twice, so `ca` to `abc` needs three edits. After the
    common prefix and suffix are cut off, two edits must touch both ends of what
    remains, which leaves a handful of shapes that plain substring tests decide.
    The built-in `levenshtein` settles every pair without a swap.
    """
    def decide(lev: Column) -> Column:
        def on_core(c: Column) -> Column:
            s, t = c["s"], c["t"]
            one_swap = (F.length(s) == 2) & (F.length(t) == 2) & _swap_head(s, t)
            rs, rt = F.reverse(s), F.reverse(t)
            two = (lev == 2) | _swap_then_edit(s, t) | _swap_then_edit(rs, rt) | _two_swaps(s, t)
            return F.when(one_swap, F.lit(1)).when(two, F.lit(2))

        def cut(p: Column) -> Column:
            tails = F.struct(F.substring(a, p + 1, F.length(a)).alias("s"),
                             F.substring(b, p + 1, F.length(b)).alias("t"))
            return let(tails, lambda x: F.when(
                (F.length(x["s"]) > 0) & (F.length(x["t"]) > 0),
                let(_common_prefix(F.reverse(x["s"]), F.reverse(x["t"])),
                    lambda q: let(F.struct(_core(x["s"], F.lit(0), q).alias("s"),
                                           _core(x["t"], F.lit(0), q).alias("t")), on_core)))
                .otherwise(F.when(lev <= 2, lev)))

        # A swap saves one edit, so beyond 4 nothing is left to gain. Swaps bring in no new
        # letters: one swap or two need the same letters, a swap and an edit nearly so.
        gap = F.abs(F.length(a) - F.length(b))
        strange_a, strange_b = _left_over(a, b), _left_over(b, a)
        same = (gap == 0) & (strange_a == 0) & (strange_b == 0)
        near = (gap <= 1) & (strange_a <= 1) & (strange_b <= 1)
        return (F.when(lev <= 1, lev).when((lev == 2) & ~same, F.lit(2))
                .when((lev > 4) | ((lev == 4) & ~same) | ((lev == 3) & ~near), F.lit(None).cast("int"))
                .otherwise(let(_common_prefix(a, b), cut)))

    return let(F.levenshtein(a, b), decide)
