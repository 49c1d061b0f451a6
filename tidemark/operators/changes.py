"""A feed of inserts, updates and deletes applied in the right order, newest change first.

The changes are stored in batches along their order and processed backwards. From each batch the changes of keys that are already
resolved leave by anti-join; only what is left is aggregated, to the newest change of each key: its final image, or a
tombstone if that change deletes. At the end the base rows of keys that no change touched are appended. The
result does not depend on the order of delivery, and copies change nothing.

Every batch holds GROWTH times as many changes as all newer ones together, or nearly so: the number of batches follows the
logarithm of the feed, and the resolved keys, which each anti-join reads again, add up to less than twice those of the result.
"""

from math import ceil, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import Scratch

GROWTH = 4
NEWEST = 20_000


def batch_shares(rows: int, newest: int = NEWEST, growth: int = GROWTH) -> list[float]:
    """Which shares of the changes, counted from the oldest, the cuts between the batches leave behind; rising."""
    steps = max(0, ceil(log(max(rows, 1) / newest, growth))) if rows > newest else 0
    return [1 - growth**-i for i in range(1, steps + 1)]


def apply_changes(
    changes: DataFrame, keys: list[str], order: list[str], deletes: str, images: list[str], base: DataFrame | None = None,
    newest: int = NEWEST, growth: int = GROWTH,
) -> DataFrame:
    """The table after all changes: ``keys`` and ``images``.

    ``order``: columns that order the changes, the first a bigint (null: before all others); of equal changes the one
    with the greatest images is taken. ``deletes``: boolean column, null counts as false. Null keys equal each other. ``base``: rows
    (keys, images) before the first change, none by default. ``newest``: about how many changes the newest batch holds; ``growth``:
    by which factor the batches grow going back.

    Hot keys: the anti-join has the changes on its left, which the adaptive skew join splits, and the newest change of a key is
    a pre-aggregated maximum behind it. Nothing but counts and quantiles of the order comes to the driver.
    """
    box = Scratch(changes.sparkSession, "changes")
    o = [f"__o{i}" for i in range(len(order))]
    rows = changes.select(
        F.struct(*keys).alias("__k"), *images, F.coalesce(F.col(deletes), F.lit(False)).alias("__gone"),
        F.coalesce(F.col(order[0]).cast("long"), F.lit(-(2**62))).alias(o[0]), *[F.col(c).alias(n) for c, n in zip(order[1:], o[1:])],
    )
    whole = rows.select(o[0]).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(o[0], [1 - growth**-i for i in range(1, 33)], 10_000).alias("c")).first()
    cuts = sorted(set((whole["c"] or [])[: len(batch_shares(whole["n"], newest, growth))]))
    number = F.lit(0)
    for c in cuts:
        number = number + (F.col(o[0]) > c).cast("int")
    stored, stored_at = box.stored(rows.withColumn("__batch", number), "batches", ["__batch"])
    resolved: DataFrame | None = None
    for b in range(len(cuts), -1, -1):
        batch = stored.where(F.col("__batch") == b)
        if resolved is not None:
            done = resolved.select(F.struct(*[F.col(f"__image.{k}").alias(k) for k in keys]).alias("__done"))
            batch = batch.join(done, F.col("__k") == F.col("__done"), "left_anti")
        # the fields of the key are grouped, not the struct that was joined on, so that changes are combined before they travel
        fresh = batch.select("__k.*", *images, "__gone", *o).groupBy(*keys).agg(F.max_by(F.struct("__gone", *images), F.struct(*o, "__gone", *images)).alias("__newest"))
        fresh = fresh.select(F.struct(*keys, "__newest.__gone", *[F.col(f"__newest.{c}").alias(f"__i_{c}") for c in images]).alias("__image"))
        fresh = box.table(fresh, f"resolved{b}")
        resolved = fresh if resolved is None else resolved.unionByName(fresh)
    box.drop(stored_at)
    out = resolved.where("not __image.__gone").select(*[F.col(f"__image.{k}").alias(k) for k in keys], *[F.col(f"__image.__i_{c}").alias(c) for c in images])
    if base is not None:
        done = resolved.select(F.struct(*[F.col(f"__image.{k}").alias(k) for k in keys]).alias("__done"))
        untouched = base.select(F.struct(*keys).alias("__k"), *images).join(done, F.col("__k") == F.col("__done"), "left_anti")
        out = out.unionByName(untouched.select("__k.*", *images))
    return out
