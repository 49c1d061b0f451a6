"""What the event contract leaves to consumers: one copy per key, the state after reorganizations, the latest snapshots.

Every "first" or "last per key" is a pre-aggregated minimum or maximum, so a key that holds a third of all rows reaches a task
as one row per task of the scan. Keys with nulls are keys like others.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import chunked
from tidemark.operators.operations import saturating_add
from tidemark.sources.scratch import Scratch


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key with the least ``order`` (unique), all columns."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*keys, "__row.*")


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key with the greatest ``order`` (unique), all columns; nulls in other columns are kept as they are."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*keys, "__row.*")


def dedupe_idempotent(events: DataFrame, order: str = "arrival_seq", keys: tuple[str, ...] = ("kind", "slot", "hash")) -> DataFrame:
    """One row per idempotency key: the first to arrive.

    The key cannot tell a repeated delivery from a block that was connected again; state is therefore built by
    ``canonical_blocks`` from all deliveries, never from this.
    """
    return first_per_key(events, list(keys), order)


def canonical_blocks(events: DataFrame, order: str = "arrival_seq", keys: tuple[str, ...] = ("slot", "hash")) -> DataFrame:
    """Blocks whose last message says connected; copies change nothing. ``events`` has kind, keys and ``order``."""
    return last_per_key(events, list(keys), order).where("kind = 'block_connected'")


def latest_snapshot(events: DataFrame, keys: list[str], order: str = "arrival_seq") -> DataFrame:
    """The state that was told last for each key; an absent value told last is the state, too."""
    return last_per_key(events, keys, order)


def distinct_blocks(events: DataFrame, by: list[str], block: str = "hash") -> DataFrame:
    """Blocks counted once, although each is told once per slot."""
    return events.select(*by, block).distinct().groupBy(*by).agg(F.count(block).alias("blocks"))


def tips_agree(before: Column, at: Column, after: Column) -> Column:
    """Whether the tip stood still while a snapshot was taken; a tip that is not known does not agree."""
    return F.coalesce((before == at) & (at == after), F.lit(False))


def running_invalid(events: DataFrame, order: str, invalid: Column, per_chunk: int = 100_000, carried: int | None = None) -> DataFrame:
    """``events`` with ``invalid_total``: how many were invalid up to each, in ``order`` (a bigint, no nulls).

    ``carried``: what an unsigned 64-bit counter stood at before; the total is a decimal then and stays at the counter's greatest number.
    """
    rows = events.withColumn("__chunk", F.floor(F.col(order) / per_chunk))
    out = chunked.running_sum(rows, "__chunk", [order], invalid.cast("long"), "invalid_total").drop("__chunk")
    return out if carried is None else out.withColumn("invalid_total", saturating_add(F.lit(str(carried)).cast("decimal(20,0)"), F.col("invalid_total")).cast("decimal(20,0)"))


def fan_out(blocks: DataFrame, slots: list[int]) -> DataFrame:
    """Each block once per monitored slot. ``slots``: distinct numbers from 0 to 255."""
    if len(set(slots)) < len(slots) or not all(0 <= s <= 255 for s in slots):
        raise ValueError("slots must be distinct numbers from 0 to 255")
    return blocks.select(*blocks.columns, F.explode(F.array(*[F.lit(s).cast("long") for s in slots])).alias("slot"))


def ancestors(links: DataFrame, start: DataFrame | list[str], most: int) -> DataFrame:
    """(start, hash, distance): each start block and up to ``most`` ancestors, newest first by distance; none if it is unknown.

    ``links``: (hash, previous_hash), one row per hash; written once, then joined with the walk's front in each step. ``start``: hashes, or a
    table whose first column holds them. The front keeps one row per start, and nothing comes to the driver.
    """
    spark = links.sparkSession
    box = Scratch(spark, "ancestors")
    known = box.table(links.select(F.col("hash").alias("__h"), F.col("previous_hash").alias("__p")), "links")
    first = spark.createDataFrame([(s,) for s in dict.fromkeys(start)], "start string") if isinstance(start, list) else start.toDF("start").distinct()
    front, out = first.select("start", F.col("start").alias("hash")), None
    for step in range(most + 1):
        found = front.join(known, F.col("hash") == F.col("__h")).select("start", "hash", F.lit(step).cast("long").alias("distance"), "__p")
        found = box.table(found, f"step{step}")
        out = found if out is None else out.unionByName(found)
        front = found.where("__p is not null").select("start", F.col("__p").alias("hash"))
    return out.drop("__p")
