"""The canonical JSON of an event: one line, keys in alphabetical order at every level, nulls written, bytes as lower hex.

The member that is set of a "one of" group is written under its name in Pascal case, a message without fields as {}, numbers
of 64 bits as bare integers. The expression follows the schema; the engine's variant type sorts the keys.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.checks import lower_hex
from tidemark.sources import schema

EMPTY = "cast(map() as map<string,string>)"


def _pascal(name: str) -> str:
    return "".join(p.capitalize() for p in name.split("_"))


def _plain(c: Column, kind: T.DataType) -> Column:
    """A field as the variant writer takes it: bytes become hex, structs and arrays are rewritten inside."""
    if isinstance(kind, T.BinaryType):
        return lower_hex(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _plain(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), _fields(c, kind))
    return c


def _arms(c: Column, kind: T.StructType, names: list[str]) -> Column:
    """The one set member of a group, under its name."""
    chain = None
    for n in names:
        member = F.expr(EMPTY) if isinstance(kind[n].dataType, T.BooleanType) else _fields(c[n], kind[n].dataType)
        arm = F.to_variant_object(F.create_map(F.lit(_pascal(n)), member))
        chain = F.when(c[n].isNotNull(), arm) if chain is None else chain.when(c[n].isNotNull(), arm)
    return chain


def _fields(c: Column, kind: T.StructType) -> Column:
    names = kind.fieldNames()
    if names == ["v0"]:
        return F.struct(_arms(c, kind, names).alias("declaration"))
    if names == ["deposit", "withdrawal_bundle"] or set(names) == set(schema.KINDS):
        return F.struct(_arms(c, kind, names).alias("event"))
    if "submitted" in names:
        return F.struct(lower_hex(c["m6id"]).alias("m6id"), _arms(c, kind, ["submitted", "failed", "succeeded"]).alias("state"))
    return F.struct(*[_plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields])


def full_json(event: Column) -> Column:
    """Canonical JSON of an event column of type ``schema.EVENT``; null for a null event."""
    kind = schema.event_type()
    inner = F.to_variant_object(F.create_map(F.lit("Enforcer"), _fields(event["enforcer"], kind["enforcer"].dataType)))
    body = F.struct(F.when(event["enforcer"].isNotNull(), inner).alias("monitor_event"), event["timestamp"].alias("timestamp"))
    return F.when(event.isNotNull(), F.to_json(F.to_variant_object(body)))
