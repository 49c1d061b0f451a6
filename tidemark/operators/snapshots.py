"""Periodic full snapshots: complete ones in order, what changed between them, and the history of attributes.

All rows of all snapshots are worked on at once; nothing loops over snapshots, nor over kinds of items: a kind is a part of the
snapshot's and the series' key (a struct). Values are compared by a 128-bit digest of
their normalized form, so wide rows are read once and only keys and digests are shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import chunked
from tidemark.sources.scratch import Scratch

ORDINALS_PER_CHUNK = 1024


def digest(*cols: Column) -> Column:
    """A 128-bit digest of the values, nulls and their places included."""
    text = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "true"})
    return F.unhex(F.md5(text))


def latest_rows(rows: DataFrame, snapshot: str, keys: list[str], version: str, values: list[str]) -> DataFrame:
    """Of several rows for one snapshot and key the one with the greatest ``version`` (null: least; ties: greatest values)."""
    pick = F.max_by(F.struct(*values), F.struct(version, *values)).alias("__v")
    latest = rows.groupBy(snapshot, *keys).agg(pick).select(snapshot, *keys, *[F.col(f"__v.{v}").alias(v) for v in values])
    return Scratch(rows.sparkSession, "snapshots").table(latest, "latest")


def complete_snapshots(runs: DataFrame, latest: DataFrame, snapshot: str, series: str, at: str, stated: str, chunk: Column) -> DataFrame:
    """Complete snapshots in order: (snapshot, series, at, n, next_snapshot, next_at).

    A snapshot is complete if it holds at least ``stated`` keys (null: it states nothing, and is complete). ``n`` counts the
    complete ones of a series from 1 by ``at`` (null: first; ties: by ``snapshot``). Rows of a snapshot that no run names are no part of this.
    """
    held = latest.groupBy(F.col(snapshot).alias("__s")).agg(F.count(F.lit(1)).alias("__held"))
    whole = runs.select(snapshot, series, at, stated).join(held, F.col(snapshot) == F.col("__s"), "left").where(F.coalesce("__held", F.lit(0)) >= F.coalesce(stated, F.lit(0)))
    whole = whole.select(snapshot, F.struct(series).alias("__own"), at, F.coalesce(chunk, F.lit(-(2**40))).cast("long").alias("__chunk"))
    whole = chunked.around(whole, ["__own"], "__chunk", [at, snapshot], F.struct(snapshot, at), after="__next", number="n")
    whole = whole.select(snapshot, "__own.*", at, "n", F.col(f"__next.{snapshot}").alias("next_snapshot"), F.col(f"__next.{at}").alias("next_at"))
    return Scratch(runs.sparkSession, "snapshots").table(whole, "complete")  # one row per snapshot; short plans from here on


def differences(latest: DataFrame, runs: DataFrame, snapshot: str, keys: list[str], values: list[str]) -> DataFrame:
    """(snapshot, keys, change) of every item added, removed or changed from the preceding complete snapshot.

    Every row stands once under its own snapshot and once, as what was held before, under the next. EXCEPT ALL both ways, of all pairs of
    consecutive snapshots at once, removes identical rows; a full join of the two residues by snapshot and key labels what is left. Both sides
    are spread by snapshot and key once, which serves both differences and the join. Null keys and values equal
    each other. The first snapshot of a series yields nothing. ``runs``: of ``complete_snapshots``.
    """
    order = runs.select(F.col(snapshot).alias("__s"), "n", "next_snapshot")
    rows = latest.join(order, F.col(snapshot) == F.col("__s")).select("__s", "n", "next_snapshot", F.struct(*keys).alias("k"), *values)
    now = rows.where("n > 1").select(F.col("__s").alias("s"), "k", *values).repartition("s", "k")
    then = rows.where("next_snapshot is not null").select(F.col("next_snapshot").alias("s"), "k", *values).repartition("s", "k")
    new, old = now.exceptAll(then).select("s", "k"), then.exceptAll(now).select(F.col("s").alias("s_old"), F.col("k").alias("k_old"))
    both = new.join(old, (F.col("s") == F.col("s_old")) & (F.col("k") == F.col("k_old")), "full")
    change = F.when(F.col("s_old").isNull(), "added").when(F.col("s").isNull(), "removed").otherwise("changed")
    return both.select(F.coalesce("s", "s_old").alias(snapshot), F.coalesce("k", "k_old").alias("k"), change.alias("change")).select(snapshot, "k.*", "change")


def satellites(
    latest: DataFrame, runs: DataFrame, snapshot: str, series: str, keys: list[str], groups: dict[str, list[str]], stored: DataFrame | None = None,
) -> DataFrame:
    """Insert-only satellite rows (satellite, series, keys, n, at, hash_diff).

    ``groups`` splits the attributes by how fast they change; each group is one satellite. A row is appended to a satellite
    only if its hash-diff differs from that of the key in the preceding snapshot, or the key wasn't there. A key that is absent
    from the snapshot after gets a tombstone in every satellite (null hash_diff).

    ``stored``: the satellite rows of an earlier call, none by default; what comes out then are the rows to append, so that both together are those
    of one call over everything. The earlier snapshots must be the first of each series in ``runs``. Only ``latest`` rows of the snapshots
    after them are looked at, and of the stored rows each key's last.
    """
    order = runs.select(F.col(snapshot).alias("__s"), F.struct(series).alias("__series"), "n", F.col("at"), "next_at")
    names = list(groups)
    digests = [f"d_{g}" for g in names]
    rows = latest.join(order, F.col(snapshot) == F.col("__s")).select(
        F.struct("__series.*", *keys).alias("__own"), "__series", "n", "at", "next_at",
        *[digest(*[F.col(c) for c in cols]).alias(f"d_{g}") for g, cols in groups.items()],
    )
    before = F.lit(0).cast("long")
    if stored is not None:
        rows, before = _resumed(rows, order, stored, series, keys, names), F.col("__told")
    rows = rows.select("__own", "n", "at", "next_at", before.alias("__told"), F.floor(F.col("n") / ORDINALS_PER_CHUNK).alias("__chunk"), *digests)
    rows = chunked.around(rows, ["__own"], "__chunk", ["n"], F.struct("n", *digests), "before", "after")
    fresh = F.col("before").isNull() | (F.col("before.n") < F.col("n") - 1)
    gone = F.col("next_at").isNotNull() & (F.col("after").isNull() | (F.col("after.n") > F.col("n") + 1))
    new = F.col("n") > F.col("__told")
    grow = [F.when(new & (fresh | (F.col(f"before.d_{g}") != F.col(f"d_{g}"))), F.struct(F.lit(g).alias("satellite"), F.col("n"), F.col("at"), F.col(f"d_{g}").alias("hash_diff"))) for g in names]
    end = [F.when(gone, F.struct(F.lit(g).alias("satellite"), (F.col("n") + 1).alias("n"), F.col("next_at").alias("at"), F.lit(None).cast("binary").alias("hash_diff"))) for g in names]
    grown = rows.select("__own.*", F.inline(F.array_compact(F.array(*grow, *end))))
    return Scratch(latest.sparkSession, "satellites").table(grown, "rows")


def _resumed(rows: DataFrame, order: DataFrame, stored: DataFrame, series: str, keys: list[str], names: list[str]) -> DataFrame:
    """``rows`` of the snapshots that are not told yet, and each living key once more as of the last one told (``__told``)."""
    own = F.struct(F.col(series), *keys)
    told = stored.groupBy(F.struct(series).alias("__series")).agg(F.max("n").alias("__last"))
    # snapshots after the last row changed nothing, so it does no harm that they are looked at again
    marks = stored.groupBy(own.alias("__own"), F.struct(series).alias("__series"), "satellite").agg(F.max_by("hash_diff", "n").alias("d"))
    lives = marks.groupBy("__own", "__series").agg(*[F.max(F.when(F.col("satellite") == g, F.col("d"))).alias(f"d_{g}") for g in names]).where(F.col(f"d_{names[0]}").isNotNull())
    here = order.select(F.col("__series").alias("__series2"), "n", "at", "next_at")
    last = told.join(here, (F.col("__series") == F.col("__series2")) & (F.col("__last") == F.col("n"))).select(F.col("__series").alias("__series3"), "n", "at", "next_at")
    carried = lives.join(last, F.col("__series") == F.col("__series3")).select("__own", "n", "at", "next_at", F.col("n").alias("__told"), *[f"d_{g}" for g in names])
    fresh = rows.join(told.select(F.col("__series").alias("__series2"), "__last"), F.col("__series") == F.col("__series2"), "left")
    fresh = fresh.where("__last is null or n > __last").select("__own", "n", "at", "next_at", F.coalesce("__last", F.lit(0)).alias("__told"), *[f"d_{g}" for g in names])
    return fresh.unionByName(carried)


def versions(sats: DataFrame, series: str, keys: list[str]) -> DataFrame:
    """The lead-based view over satellites: (series, keys, n, valid_from, valid_to), one row per version.

    A version begins wherever some satellite has a row; it ends where the next row of any satellite of the key begins
    (null: never so far).
    """
    own = F.struct(series, *keys).alias("__own")
    points = sats.groupBy(own, "n", "at").agg(F.max(F.col("hash_diff").isNotNull()).alias("lives"))
    points = points.withColumn("__chunk", F.floor(F.col("n") / ORDINALS_PER_CHUNK))
    points = chunked.around(points, ["__own"], "__chunk", ["n"], F.struct("at"), after="__next")
    return points.where("lives").select("__own.*", "n", F.col("at").alias("valid_from"), F.col("__next.at").alias("valid_to"))
