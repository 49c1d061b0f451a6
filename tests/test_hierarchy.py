import random

from pyspark.sql import functions as F

from tests.helpers import rows, table
from tidemark.operators.hierarchy import descendants, hierarchy, links

SCHEMA = "key string, parent string, root string, depth string"  # clashing names beside those that are asked for


def tree(spark, pairs, **kw):
    df = table(spark, SCHEMA, [(k, p, "x", None) for k, p in pairs])
    return hierarchy(links(df, F.col("key"), F.col("parent")), **kw)


def brute(pairs):
    parent = {}
    for k, p in pairs:
        if k is not None:
            parent[k] = min(filter(None, (parent.get(k), p)), default=None)
    out = {}
    for k in parent:
        path, x = [k], k
        while parent[x] in parent and parent[x] not in path:
            x = parent[x]
            path.append(x)
        out[k] = (None, -1, None) if parent[x] in parent else (x, len(path) - 1, path[::-1])
    return out


def found(spark, pairs):
    return {r["key"]: (r["root"], r["depth"], r["path"]) for r in tree(spark, pairs, with_path=True).collect()}


def test_shapes(spark):
    chain = [(f"c{i:03}", f"c{i - 1:03}" if i else None) for i in range(37)]
    star = [(f"s{i}", "hub") for i in range(50)] + [("hub", "nowhere")]
    cycle = [("a", "b"), ("b", "c"), ("c", "a"), ("tail", "a"), ("tail2", "tail"), ("self", "self")]
    pairs = chain + star + cycle + chain[:5] + [(None, "a"), (None, None)]
    assert found(spark, pairs) == brute(pairs)


def test_random(spark):
    rng = random.Random(5)
    pairs = [(str(i), str(rng.randrange(200)) if rng.random() < 0.95 else None) for i in range(150)]
    assert found(spark, pairs) == brute(pairs)


def test_only_cycles_and_only_roots(spark):
    assert rows(tree(spark, [("a", "b"), ("b", "a")]), "key", "root", "depth") == [("a", None, -1), ("b", None, -1)]
    assert rows(tree(spark, [("a", None), ("b", "")]), "key", "root", "depth") == [("a", "a", 0), ("b", "b", 0)]


def test_empty(spark):
    assert rows(tree(spark, [])) == []
    assert rows(tree(spark, [], with_path=True)) == []
    assert rows(descendants(tree(spark, [(None, "a")], with_path=True))) == []


def test_disagreeing_rows_and_long_keys(spark):
    long = "k" * 100_000
    got = {r["key"]: (r["root"], r["depth"]) for r in tree(spark, [("x", "b"), ("x", "a"), ("a", None), ("b", None), (long, "x")]).collect()}
    assert got["x"] == ("a", 1) and got[long] == ("a", 2)


def test_descendants(spark):
    pairs = [("r", None), ("a", "r"), ("b", "a"), ("c", "a"), ("z", "z")]
    got = rows(descendants(tree(spark, pairs, with_path=True)))
    assert got == [("a", "b", 1), ("a", "c", 1), ("r", "a", 1), ("r", "b", 2), ("r", "c", 2)]
