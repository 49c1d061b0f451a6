import random

from tests.helpers import rows, table
from tidemark.operators.references import orphans, per_period

REFS = "a string, b bigint, id bigint, tab string, time bigint, chunk string, reason string"
TARGETS = "a string, b bigint, since bigint, until bigint, at string"


def found(spark, refs, targets, match="simple", keys=("a", "b")):
    r = table(spark, REFS, [(*x, "t", *y, "c", "r") for x, y in ((v[:3], v[3:]) for v in refs)])
    t = table(spark, TARGETS, [(*v, "x") for v in targets])
    return rows(orphans(r, t, list(keys), ["tab", "id"], match, 50), "id", "reason")


def brute(refs, targets, match="simple"):
    out = []
    for a, b, i, time in refs:
        mask = [k is not None for k in (a, b)]
        if not any(mask) or (match == "simple" and not all(mask)):
            continue
        if match == "full" and not all(mask):
            out.append((i, "partial"))
            continue
        time = -(2**62) if time is None else time
        same = [t for t in targets if all(not m or (x is not None and x == y) for m, x, y in zip(mask, t[:2], (a, b)))]
        begun = [t for t in same if t[2] is not None and t[2] <= time]
        if not any(t[3] is None or t[3] > time for t in begun):
            out.append((i, "deleted" if begun else "late" if same else "missing"))
    return sorted(out, key=repr)


def test_reasons(spark):
    targets = [("x", 1, 10, 20), ("x", 1, 30, None), ("x", 1, 5, 8), ("y", 1, 10, 20), ("z", 1, None, None)]
    refs = [("x", 1, i, t) for i, t in enumerate((4, 5, 8, 10, 19, 20, 29, 30, 99, None))] + [("y", 1, 50, 20), ("y", 1, 51, 10), ("q", 1, 52, 5), ("z", 1, 53, 5)]
    assert found(spark, refs, targets) == brute(refs, targets)


def test_match_semantics(spark):
    targets = [("x", 1, 0, None), ("y", None, 0, None), (None, 7, 0, None)]
    refs = [("x", None, 1, 5), ("y", None, 2, 5), ("q", None, 3, 5), (None, 1, 4, 5), (None, 9, 5, 5), (None, None, 6, 5), ("x", 1, 7, 5), ("x", 2, 8, 5)]
    for match in ("simple", "partial", "full"):
        assert found(spark, refs, targets, match) == brute(refs, targets, match), match


def test_random(spark):
    rng = random.Random(4)
    pick = lambda: (rng.choice(["p", "q", "", None]), rng.choice([1, 2, None]))
    targets = [(*pick(), rng.choice([None, rng.randrange(300)]), rng.choice([None, rng.randrange(300)])) for _ in range(60)]
    refs = [(*pick(), i, rng.choice([None, *range(0, 300, 7)])) for i in range(300)]
    for match in ("simple", "partial", "full"):
        assert found(spark, refs, targets, match) == brute(refs, targets, match), match


def test_hot_reference_and_repeated_rows(spark):
    targets = [("hot", 1, i, i + 1) for i in range(0, 1000, 2)] * 2
    refs = [("hot", 1, i, i) for i in range(1000)]
    assert found(spark, refs, targets) == [(i, "deleted") for i in sorted(range(1, 1000, 2), key=repr)]


def test_empty(spark):
    assert found(spark, [], []) == []
    assert found(spark, [], [("x", 1, 0, None)]) == []
    assert found(spark, [("x", 1, 1, 5)], []) == [(1, "missing")]


def test_report(spark):
    df = table(spark, "ref_table string, period string, reason string", [("t", "d", "late")] * 2 + [("t", None, "late")])
    assert rows(per_period(df)) == [("t", "d", "late", 2), ("t", None, "late", 1)]
