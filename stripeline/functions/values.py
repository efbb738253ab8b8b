"""Value semantics of declared types, as expressions that leave other columns' row-group skipping alone."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from ..sources.types import Declared


def fitted(text: Column, size: int, what: str, name: str) -> Column:
    """text, or an error if it is longer than size without trailing blanks; blanks beyond size go."""
    message = F.lit(f"value too long for type {what}({size}) in column {name}")
    return F.when(F.length(text) <= size, text).when(F.length(F.rtrim(text)) > size, F.raise_error(message).cast("string")).otherwise(F.substring(text, 1, size))


def char_padded(text: Column, size: int, name: str = "") -> Column:
    return F.rpad(fitted(text, size, "character", name), size, " ")


def char_equal(raw: Column, value: str) -> Column:
    """raw equals value apart from trailing blanks; the bounds can be pushed to a scan."""
    value = value.rstrip(" ")
    return (raw >= value) & (raw < value + "!") & (F.rtrim(raw) == value)


def compacted(items: Column) -> Column:
    """Without null items; a null list stays null, an empty one empty."""
    return F.array_compact(items)


def converted(raw: Column, declared: Declared, drop_null_items: bool, name: str) -> Column:
    """A file's column as the declared type. Casts only widen (but for double as float4), so they can't overflow. Length rules don't hold inside arrays."""
    if declared.array:
        items = compacted(raw) if drop_null_items else raw
        return items.cast(f"array<{declared.spark}>")
    if declared.family == "char" and declared.size:
        return char_padded(raw, declared.size, name)
    if declared.family == "varchar" and declared.size:
        return fitted(raw, declared.size, "character varying", name)
    return raw.cast(declared.spark)
