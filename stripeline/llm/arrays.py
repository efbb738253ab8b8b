"""Array expressions that stay linear: Spark's own functions, bound once where they are used more often."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Running sums are made in blocks of so many; long texts are cut into pieces of so many characters.
BLOCK, PIECE = 256, 4096


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x computed once however often f uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def running(sizes: Column) -> Column:
    """The sums of an array of longs up to each item, in blocks: each block's own sums, then what lies before it."""
    none = F.array().cast("array<long>")
    inside = lambda block: F.aggregate(block, none, lambda own, n: F.concat(own, F.array(F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit(0).cast("long")) + n)))
    cut = lambda xs: F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int")), lambda b: inside(F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))

    def joined_up(blocks: Column) -> Column:
        def after(totals: Column) -> Column:
            before = lambda k: F.aggregate(F.slice(totals, F.lit(1), k), F.lit(0).cast("long"), lambda sum_, n: sum_ + n)
            return F.flatten(F.transform(blocks, lambda own, k: bound(before(k), lambda more: F.transform(own, lambda v: v + more))))

        return bound(F.transform(blocks, lambda own: F.element_at(own, -1)), after)

    return bound(sizes, lambda xs: F.when(F.size(xs) > 0, bound(cut(xs), joined_up)).otherwise(none))


def pieces(text: Column) -> Column:
    """text in pieces of PIECE characters, for cuts()."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))


def cut(parts: Column, start: Column, size: Column) -> Column:
    """What stands from start on in the text that parts, from pieces(), are of: a place far behind costs no more than one in front."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((start + size) / PIECE).cast("int")
    own = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.when(size > 0, F.substring(own, (start % PIECE + 1).cast("int"), size.cast("int"))).otherwise("")
