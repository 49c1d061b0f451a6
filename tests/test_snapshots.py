import random

from pyspark.sql import functions as F

from tests.helpers import rows, table
from tidemark.operators import snapshots

RUNS = "sid bigint, dep bigint, at bigint, stated bigint, n string, next_at string"
ITEMS = "sid bigint, key string, loaded bigint, fast bigint, slow string, s string"


def both(spark, runs, items):
    r = table(spark, RUNS, [(*x, "n", "a") for x in runs])
    latest = snapshots.latest_rows(table(spark, ITEMS, [(*x, "s") for x in items]), "sid", ["key"], "loaded", ["fast", "slow"])
    whole = snapshots.complete_snapshots(r, latest, "sid", "dep", "at", "stated", F.floor(F.col("at") / 10))
    return latest, whole


def diffs(spark, runs, items):
    latest, whole = both(spark, runs, items)
    wide = latest.withColumn("image", snapshots.digest(F.col("fast"), F.col("slow"))).drop("fast", "slow")
    return rows(snapshots.differences(wide, whole, "sid", ["key"], ["image"]))


def versions(spark, runs, items):
    latest, whole = both(spark, runs, items)
    sats = snapshots.satellites(latest, whole, "sid", "dep", ["key"], {"fast": ["fast"], "slow": ["slow"]})
    return rows(snapshots.versions(sats, "dep", ["key"]), "dep", "key", "valid_from", "valid_to")


def brute(runs, items):
    low = lambda v: (v is not None, v or type(v)()) if v is not None else (False, 0)
    latest = {}
    for sid, key, loaded, fast, slow in items:
        rank = (low(loaded), low(fast), (slow is not None, slow or ""))
        if (sid, key) not in latest or rank > latest[sid, key][0]:
            latest[sid, key] = (rank, (fast, slow))
    held = {}
    for (sid, key), (_, v) in latest.items():
        held.setdefault(sid, {})[key] = v
    series = {}
    for sid, dep, at, stated in runs:
        if len(held.get(sid, {})) >= (stated or 0):
            series.setdefault(dep, []).append((at, sid))
    changed, found = [], []
    for dep, snaps in series.items():
        snaps.sort()
        for (_, a), (_, b) in zip(snaps, snaps[1:]):
            x, y = held.get(a, {}), held.get(b, {})
            for k in x.keys() | y.keys():
                if k not in x or k not in y or x[k] != y[k]:
                    changed.append((b, k, "added" if k not in x else "removed" if k not in y else "changed"))
        live = {}
        for at, sid in snaps:
            now = held.get(sid, {})
            for k in [k for k in live if k not in now or now[k] != live[k][1]]:
                found.append((dep, k, live.pop(k)[0], at))
            for k in now.keys() - live.keys():
                live[k] = (at, now[k])
        found += [(dep, k, at, None) for k, (at, _) in live.items()]
    return sorted(changed, key=repr), sorted(found, key=repr)


def test_random(spark):
    rng = random.Random(6)
    runs = [(i, rng.choice([1, 2, None]), i * 3, rng.choice([0, 1, 2, 3, None])) for i in range(60)]
    items = [(rng.randrange(65), rng.choice(["a", "b", "c", "", None]), rng.choice([None, 1, 2]), rng.choice([None, 1, 2]), rng.choice([None, "", "x"])) for _ in range(250)]
    items += items[:40]
    changed, found = brute(runs, items)
    assert diffs(spark, runs, items) == changed
    assert versions(spark, runs, items) == found


def test_appended_in_parts(spark):
    rng = random.Random(8)
    runs = [(i, rng.choice([1, 2, None]), i * 3, rng.choice([0, 1, 2])) for i in range(50)]
    items = [(rng.randrange(50), rng.choice(["a", "b", None]), 1, rng.choice([None, 1]), rng.choice([None, "x"])) for _ in range(150)]
    latest, whole = both(spark, runs, items)
    groups = {"fast": ["fast"], "slow": ["slow"]}
    stored = None
    for last in (4, 50):
        ends = F.when((F.col("n") < last) & F.col("next_at").isNotNull(), F.col("next_at"))
        more = snapshots.satellites(latest, whole.where(F.col("n") <= last).withColumn("next_at", ends), "sid", "dep", ["key"], groups, stored)
        stored = more if stored is None else stored.unionByName(more)
    assert rows(stored) == rows(snapshots.satellites(latest, whole, "sid", "dep", ["key"], groups))
    assert rows(snapshots.versions(stored, "dep", ["key"]), "dep", "key", "valid_from", "valid_to") == brute(runs, items)[1]


def test_incomplete_is_passed_over(spark):
    runs = [(1, 1, 10, 1), (2, 1, 20, 2), (3, 1, 30, 1), (4, 1, 40, 0)]
    items = [(1, "a", 1, 5, "x"), (2, "a", 1, 6, "x"), (3, "a", 1, 5, "x")]
    assert diffs(spark, runs, items) == [(4, "a", "removed")]
    assert versions(spark, runs, items) == [(1, "a", 10, 40)]


def test_one_key_through_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "ORDINALS_PER_CHUNK", 4)
    runs = [(i, 1, i, 1) for i in range(50)]
    items = [(i, "hot", 1, i // 17, "x") for i in range(50)]
    assert versions(spark, runs, items) == [(1, "hot", 0, 17), (1, "hot", 17, 34), (1, "hot", 34, None)]


def test_empty(spark):
    assert diffs(spark, [], []) == versions(spark, [], []) == []
    assert diffs(spark, [(1, 1, 1, 0)], []) == []
    assert versions(spark, [(1, 1, 1, 0), (2, 1, 2, 5)], [(1, "a" * 60_000, 1, 1, "y" * 60_000)]) == [(1, "a" * 60_000, 1, None)]
