"""Strict reading of single fields: a value and, where it cannot be read, the reason.

All are plain expressions. A reason is a string column, null where all is well; the first reason of a row, in reading order,
rejects the whole row (``first_of``), so callers list reasons in the order in which fields are read.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT_HEX = r"\A([0-9A-Fa-f]{2})*\z"
HASH_BYTES = 32


@dataclass(frozen=True)
class Checked:
    """An expression for a value and one for the reason why there is none."""

    value: Column
    error: Column


def none() -> Column:
    return F.lit(None).cast("string")


def once(c: Column) -> Column:
    """``c``, computed once per row: the optimizer copies a column's expression into each of its uses, filters included,
    unless it is not deterministic. Filters that can go to the scan belong before it."""
    return F.when(F.spark_partition_id() >= 0, c)


def first_of(*errors: Column) -> Column:
    """The first reason that is not null."""
    return F.coalesce(*errors) if errors else none()


def missing(c: Column, field: str) -> Column:
    """A reason where the field is null."""
    return F.when(c.isNull(), F.lit(f"missing {field}"))


def required(c: Column, field: str) -> Checked:
    return Checked(c, missing(c, field))


def hex_bytes(c: Column, field: str, size: int | None = None) -> Checked:
    """Strict hex text as bytes: either case, even length, no prefix, no blanks; empty text is empty bytes.

    ``size``: the only length allowed. Null text is missing.
    """
    raw = F.unhex(F.when(c.rlike(STRICT_HEX), c))
    error = first_of(missing(c, field), F.when(~c.rlike(STRICT_HEX), F.lit(f"invalid hex in {field}")))
    if size is not None:
        error = first_of(error, wrong_size(raw, field, size))
    return Checked(raw, error)


def hash_bytes(c: Column, field: str) -> Checked:
    return hex_bytes(c, field, HASH_BYTES)


def wrong_size(raw: Column, field: str, size: int = HASH_BYTES) -> Column:
    """A reason where bytes are not of the size; null bytes count as none."""
    length = F.coalesce(F.octet_length(raw), F.lit(0))
    return F.when(length != size, F.concat(F.lit(f"{field} must contain {size} bytes, got "), length.cast("string")))


def optional(c: Column, read: Checked) -> Checked:
    """A field that may be absent: read it only where it is there."""
    return Checked(F.when(c.isNotNull(), read.value), F.when(c.isNotNull(), read.error))


def each(items: Column, read, name: str) -> Checked:
    """Every element of an array, read in order; the first failure names its index."""

    def one(x: Column, i: Column) -> Column:
        got = read(x)
        return F.struct(got.value.alias("value"), F.concat(F.lit(f"{name} "), i.cast("string"), F.lit(": "), got.error).alias("error"))

    both = F.transform(items, one)
    first = F.try_element_at(F.filter(both["error"], lambda e: e.isNotNull()), F.lit(1))
    return Checked(both["value"], first)


def lower_hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))
