import random

from tests.helpers import rows, table
from tidemark.operators.changes import apply_changes, batch_shares

SCHEMA = "k1 string, k2 bigint, t bigint, seq bigint, gone boolean, v string, __batch int"


def applied(spark, data, base=None, **kw):
    base = None if base is None else table(spark, "k1 string, k2 bigint, v string", base)
    return rows(apply_changes(table(spark, SCHEMA, [(*r, 0) for r in data]), ["k1", "k2"], ["t", "seq"], "gone", ["v"], base, **kw))


def brute(data, base=()):
    state = {(a, b): v for a, b, v in base}
    for a, b, t, seq, gone, v in sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[3])):
        if gone:
            state.pop((a, b), None)
        else:
            state[a, b] = v
    return sorted(((a, b, v) for (a, b), v in state.items()), key=repr)


def test_out_of_order_and_repeated(spark):
    data = [("a", 1, 30, 1, True, None), ("a", 1, 10, 2, False, "x"), ("a", 1, 40, 3, False, "y"), ("a", 1, 40, 3, False, "y"), ("b", 1, 5, 4, False, "z"), ("b", 1, 6, 5, True, None)]
    assert applied(spark, data) == [("a", 1, "y")] == brute(data)


def test_base_rows_stay_unless_touched(spark):
    base = [("a", 1, "old"), ("b", 2, "old"), (None, None, "null key")]
    data = [("a", 1, 1, 1, True, None), ("c", 3, 1, 2, False, "new")]
    assert applied(spark, data, base) == brute(data, base)


def test_random_with_nulls(spark):
    rng = random.Random(2)
    data = [(rng.choice(["a", "b", "", None]), rng.choice([1, 2, None]), rng.choice([None, *range(40)]), i, rng.random() < 0.3, str(i)) for i in range(400)]
    for newest in (500, 100, 3):
        assert applied(spark, data, newest=newest, growth=2) == brute(data)


def test_hot_key_and_null_flag(spark):
    data = [("hot", 1, i, i, False, str(i)) for i in range(2000)] + [("n", 1, 1, 1, None, "v" * 100_000)]
    assert applied(spark, data) == brute(data)


def test_empty(spark):
    assert applied(spark, []) == []
    assert applied(spark, [], [("a", 1, "x")]) == [("a", 1, "x")]


def test_batches_grow_with_the_feed():
    assert batch_shares(0) == batch_shares(20_000) == []
    assert batch_shares(80_000) == [0.75] and len(batch_shares(10**6)) == 3 and len(batch_shares(10**9)) == 8


def test_hot_key_over_many_batches(spark):
    data = [("hot", 1, i, i, i % 3 == 0, str(i)) for i in range(3000)] + [(str(i), 1, i, i, False, "v") for i in range(300)]
    assert applied(spark, data, newest=50) == brute(data)
