"""Hex text as columns: the lenient reading of the feed's tables and the strict one of the event contract."""

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\p{Z}\x{FEFF}]"


def hex_text(c: Column) -> Column:
    """Hex text without regard to letter case, white space around it and one 0x before it; null stays null."""
    return F.regexp_replace(F.lower(c), rf"\A{BLANK}*(?:0x)?|{BLANK}+\z", "")


def block_hash(c: Column) -> Column:
    """The 64 lower-case hex digits of a valid block hash; null for any other text and for null."""
    found = F.regexp_extract(F.lower(c), rf"\A{BLANK}*(?:0x)?([0-9a-f]{{64}}){BLANK}*\z", 1)
    return F.when(found != "", found)


def link_hash(c: Column) -> Column:
    """A reference to a block: its hex text as written (valid or not), null where it refers to nothing."""
    text = hex_text(c)
    return F.when(~text.rlike(r"\A0*\z"), text)


def hash_key(text: Column) -> Column:
    """Hex text (of ``block_hash`` or ``link_hash``) as a short key: the 32 bytes of a valid hash, more than 32 bytes for any other text."""
    return F.when(text.rlike(r"\A[0-9a-f]{64}\z"), F.unhex(text)).otherwise(F.encode(F.concat(F.lit(" " * 33), text), "utf-8"))


def plain_text(c: Column) -> Column:
    """Text without the white space around it."""
    return F.regexp_replace(c, rf"\A{BLANK}+|{BLANK}+\z", "")
