import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import filled, rows, table
from tidemark.operators import contract, operations

SCHEMA = "slot bigint, hash string, kind string, arrival_seq bigint"
ON, OFF = "block_connected", "block_disconnected"


def test_reorganizations(spark):
    data = [(1, "cdc", ON, 1), (1, "cdc", OFF, 2), (1, "cdc", ON, 3), (1, "ccd", ON, 4), (1, "ccd", ON, 5), (1, "ccd", OFF, 6), (2, "ccd", ON, 7), (None, None, ON, 8)]
    df = table(spark, SCHEMA, data)
    assert rows(contract.canonical_blocks(df), "slot", "hash") == [(1, "cdc"), (2, "ccd"), (None, None)]
    assert rows(contract.canonical_blocks(df.unionByName(df)), "slot", "hash") == [(1, "cdc"), (2, "ccd"), (None, None)]
    first = rows(contract.dedupe_idempotent(df), "slot", "hash", "kind", "arrival_seq")
    assert (1, "cdc", ON, 1) in first and (1, "cdc", ON, 3) not in first and len(first) == 6


def test_latest_keeps_absence(spark):
    df = table(spark, "slot bigint, value string, seq bigint", [(1, "a", 1), (1, None, 2), (2, None, 1), (2, "b", 2)])
    assert rows(contract.latest_snapshot(df, ["slot"], "seq")) == [(1, None, 2), (2, "b", 2)]


def test_distinct_blocks_and_tips(spark):
    df = table(spark, "d bigint, hash string", [(1, "a"), (1, "a"), (1, "b"), (2, None)])
    assert rows(contract.distinct_blocks(df, ["d"])) == [(1, 2), (2, 0)]
    df = table(spark, "a string, b string, c string", [("x", "x", "x"), ("y", "x", "x"), ("x", "y", "x"), ("x", "x", "y"), (None, "x", "x")])
    assert [r[0] for r in df.select(contract.tips_agree(F.col("a"), F.col("b"), F.col("c"))).collect()] == [True, False, False, False, False]


def test_running_count(spark):
    rng = random.Random(1)
    data = [(i, rng.random() < 0.4) for i in rng.sample(range(5000), 300)]
    got = contract.running_invalid(table(spark, "seq bigint, bad boolean", data), "seq", F.col("bad"), per_chunk=100)
    total, expected = 0, []
    for seq, bad in sorted(data):
        total += bad
        expected.append((seq, total))
    assert sorted((r["seq"], r["invalid_total"]) for r in got.collect()) == expected


def test_fan_out(spark):
    df = table(spark, "hash string", [("a",), ("b",)])
    assert rows(contract.fan_out(df, [9, 98])) == [("a", 9), ("a", 98), ("b", 9), ("b", 98)]
    for bad in ([9, 9], [256], [-1]):
        with pytest.raises(ValueError):
            contract.fan_out(df, bad)


def test_ancestors(spark):
    links = table(spark, "hash string, previous_hash string", [("c", "b"), ("b", "a"), ("a", None), ("x", "gone")])
    assert rows(contract.ancestors(links, ["c"], 1), "hash", "distance") == [("b", 1), ("c", 0)]
    assert rows(contract.ancestors(links, ["c", "x", "unknown"], 9), "start", "hash", "distance") == [("c", "a", 2), ("c", "b", 1), ("c", "c", 0), ("x", "x", 0)]
    assert rows(contract.ancestors(links, ["unknown"], 9)) == []


def one(spark, value, expr, kind="string"):
    return filled(spark, f"x {kind}", [(value,)]).select(expr(F.col("x"))).first()[0]


def test_history(spark):
    ready = '{"headers":5,"chainstates":[{"blocks":5,"validated":true}]}'
    two = '{"chainstates":[{"blocks":3,"validated":true},{"blocks":10,"validated":false}]}'
    cases = {ready: True, two: False, '{"chainstates":[{"blocks":5,"validated":false}]}': False, '{"chainstates":[]}': False, "no json": False, "{}": False, None: False}
    for text, expected in cases.items():
        assert one(spark, text, operations.history_ready) is expected
    assert tuple(one(spark, two, operations.history_summary)) == (False, 2, 3, 10, 7)
    assert tuple(one(spark, ready, operations.history_summary)) == (True, 1, 5, 5, 0)
    assert tuple(one(spark, None, operations.history_summary)) == (False, 0, None, None, 0)


def test_log_lines(spark):
    hit = lambda text: one(spark, text, lambda c: operations.log_matches(c, "block connected", F.lit(9), F.lit("ab12")))
    for text in ("block connected sidechain=9 hash=ab12", 'block connected "sidechain=9" hash=ab12', "sidechain=9, block connected ab12", "x block connected y sidechain=9"[:-1] + "9 ab12"):
        assert hit(text)
    for text in ("block connected sidechain=98 hash=ab12", "block connected sidechain=19 ab12", "block lost sidechain=9 ab12", "block connected sidechain=9 ab13", "block connected xsidechain=9 ab12", None):
        assert not hit(text)


def test_slots_and_numbers(spark):
    for text, slots in {"9,98": [9, 98], "0": [0], "255": [255], "256": None, "": None, "9,": None, "9, 98": None, "-1": None, "9" * 30: None, None: None}.items():
        assert one(spark, text, operations.slots_of) == slots, text
    for text, number in {"7": 7, "0": None, "": None, "-7": None, "7.0": None, "9" * 30: None, None: None}.items():
        assert one(spark, text, operations.positive) == number


def test_keys(spark):
    for line, key in {" A_1 = x": "A_1", "A=": "A", "a=1": None, "A B=1": None, "A": None, "1A=1": None, "A=B=C": "A", None: None}.items():
        assert one(spark, line, operations.setting_keys) == key
    own, locked = table(spark, "k string", [("A",), ("B",), ("A",), (None,)]), table(spark, "k string", [("A",), ("C",), (None,)])
    assert rows(operations.key_overlap(own, locked, "k")) == [("A",)]


def test_small_predicates(spark):
    assert one(spark, b"abc", lambda c: operations.payload_matches(c, 3, "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD"), "binary")
    assert not one(spark, b"abcd", lambda c: operations.payload_matches(c, 3, "00"), "binary")
    assert not one(spark, None, lambda c: operations.payload_matches(c, 3, "00"), "binary")
    named = lambda v: one(spark, v, lambda c: operations.any_named(c, "name", "x"), "array<struct<name:string>>")
    assert named([{"name": "y"}, {"name": "x"}]) and not named([{"name": None}]) and not named([]) and not named(None)
    most = 2**64 - 1
    assert one(spark, most, lambda c: operations.saturating_add(c, F.lit(1)), "decimal(20,0)") == most
    assert one(spark, 4, lambda c: operations.saturating_add(c, F.lit(1)), "decimal(20,0)") == 5
    ready = lambda b: one(spark, b, lambda c: operations.node_ready(F.lit("main"), c, F.lit(9), F.lit(False), F.lit("h"), 5, "main", "h"), "bigint")
    assert ready(5) and not ready(4) and not ready(None)


def test_undelivered_and_agreement(spark):
    expected = table(spark, "slot bigint, source string", [(9, "a"), (9, "b"), (98, "a"), (None, "a")])
    seen = table(spark, "slot bigint, source string", [(9, "a"), (9, "a"), (None, "a")])
    assert rows(operations.undelivered(expected, seen, ["slot", "source"])) == [(9, "b"), (98, "a")]
    assert rows(operations.undelivered(expected.limit(0), seen, ["slot", "source"])) == []
    ours = table(spark, "height bigint, hash string", [(1, "a"), (2, "b"), (None, "c")])
    assert rows(operations.tip_agreement(ours, table(spark, "height bigint, hash string", [(1, "a"), (1, "a"), (2, "x"), (None, "c")]))) == [(1, "a")]
    assert rows(operations.with_prefix(ours, "hash", "a", "height")) == [(1,)]


def test_what_a_node_tells(spark):
    text = '{"chain":"main","blocks":5,"x":[1],"initialblockdownload":false}'
    assert one(spark, text, operations.chain_brief) == '{"chain":"main","blocks":5,"headers":null,"verificationprogress":null,"initialblockdownload":false}'
    for other in ("[]", "no json", "", None):
        assert one(spark, other, operations.chain_brief) is None
    assert one(spark, '[{"addr":"a","id":1},{}]', operations.peer_briefs).count('"addr"') == 2 and one(spark, "[]", operations.peer_briefs) == "[]"
    on = lambda v: one(spark, v, lambda c: operations.subscriptions_on(c, "a.b"))
    assert on('{"subscriptions_list":[{"subject":"a.b","msgs":1},{"subject":"a.bc"},{"subject":null}]}') == '[{"account":null,"subject":"a.b","msgs":1}]'
    assert on("{}") is None and on(None) is None


def test_wait_until():
    answers = iter([False, ValueError("not yet"), True])

    def check():
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert operations.wait_until(check, 5, 0.01)
    assert not operations.wait_until(lambda: False, 0.05, 0.02)
    with pytest.raises(ZeroDivisionError):
        operations.wait_until(lambda: 1 / 0, 0.05, 0.02)


def test_saturating_total(spark):
    got = contract.running_invalid(table(spark, "seq bigint, bad boolean", [(i, True) for i in range(4)]), "seq", F.col("bad"), carried=2**64 - 3)
    assert sorted(int(r["invalid_total"]) for r in got.collect()) == [2**64 - 2] + [2**64 - 1] * 3
