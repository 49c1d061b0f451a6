from pyspark.sql import functions as F

from tidemark.functions.checks import hex_bytes
from tidemark.functions.hexes import block_hash, hex_text, link_hash, plain_text

H = "ab" * 32


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


def test_block_hash(spark):
    for text in (H, H.upper(), f"0x{H}", f"0X{H.upper()}", f" {H}\n", f"　\xa00x{H}\t"):
        assert one(spark, text, block_hash) == H
    for text in (None, "", "0x", H[1:], H + "0a", "zz" + H[2:], H[:30] + " " + H[30:], f"0x0x{H}", "é" * 64):
        assert one(spark, text, block_hash) is None


def test_link_hash(spark):
    for text in (None, "", "  ", "0", "00" * 32, f" 0x{'00' * 32} "):
        assert one(spark, text, link_hash) is None
    assert one(spark, f"0X{H.upper()}", link_hash) == H
    assert one(spark, "not hex", link_hash) == "not hex"


def test_text(spark):
    assert one(spark, " 0xAbC ", hex_text) == "abc"
    assert one(spark, None, hex_text) is None
    assert one(spark, "　 a  b\n", plain_text) == "a  b"


def test_strict_hex(spark):
    read = lambda c: hex_bytes(c, "f")
    for text, value in (("", b""), ("aBcD", b"\xab\xcd")):
        assert bytes(one(spark, text, lambda c: read(c).value)) == value
        assert one(spark, text, lambda c: read(c).error) is None
    for text in ("abc", "0xab", "ab\n", " ab", "zz"):
        assert one(spark, text, lambda c: read(c).error) == "invalid hex in f"
        assert one(spark, text, lambda c: read(c).value) is None
    assert one(spark, None, lambda c: read(c).error) == "missing f"
    for size in (31, 33):
        assert one(spark, "ab" * size, lambda c: hex_bytes(c, "f", 32).error) == f"f must contain 32 bytes, got {size}"
