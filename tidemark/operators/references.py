"""References to records that do not exist, per table and period.

References are grouped by their null mask and anti-joined on their non-null columns, under the declared match semantics for partly null
keys. The mask is a part of the join key, and a target stands once for each mask that references may have (all of its columns, or
every subset of them where partly null keys refer as well), so one scan of either side and one anti-join serve all masks.

Where targets have a time of validity, a reference holds if some target of its key is valid at its time. An equi-join with that
condition would pair each reference of a hot key with every version of its target. So time is cut into chunks: what is
valid when a chunk begins is one row per key and chunk, carried by a running maximum over pre-aggregated ends, and the anti-join's
key is (mask, key, chunk). A reference then meets only the targets that begin in its chunk and that one row. The references are on the
left of the join, where the adaptive skew join splits a hot key.
"""

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import Scratch

FOREVER = 2**62


def _masks(keys: list[str], match: str) -> list[str]:
    """The null masks (one digit per column, 1 for a value) whose references are looked up."""
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics {match}")
    every = ["".join(m) for m in product("10", repeat=len(keys))]
    return [m for m in every if "1" in m] if match == "partial" else every[:1]


def orphans(refs: DataFrame, targets: DataFrame, keys: list[str], id_cols: list[str], match: str = "simple", chunk_width: int = 86_400_000_000) -> DataFrame:
    """``id_cols`` and ``reason`` of every reference that does not hold.

    ``refs``: keys, id_cols, ``time`` (bigint); ``targets``: keys, ``since``, ``until`` (bigint, null ``until``: for ever).
    A reference holds if some target of its key has since <= time < until. The reason is ``missing`` if there is no target at all,
    ``deleted`` if one has since <= time, else ``late``. A null time is before all others; a null ``since`` never begins.

    ``match``: what a partly null key means. ``simple``: it refers to nothing and holds; ``partial``: its non-null
    columns must match; ``full``: it never holds (reason ``partial``). A wholly null key refers to nothing in all three.
    """
    wanted, whole, box = _masks(keys, match), "1" * len(keys), Scratch(refs.sparkSession, "references")
    mask = F.concat(*[F.when(F.col(k).isNotNull(), "1").otherwise("0") for k in keys])
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    asked = refs.select(F.struct(mask.alias("mask"), *named).alias("k"), F.coalesce(F.col("time"), F.lit(-FOREVER)).alias("at"), F.struct(*id_cols).alias("ref"))
    asked = box.table(asked.where(F.col("k.mask").isin(*wanted) if match != "full" else F.col("k.mask").contains("1")), "references")  # read once, used twice
    looked_up = asked.where(F.col("k.mask").isin(*wanted)).withColumn("chunk", F.floor(F.col("at") / chunk_width))

    def key_of(m: str) -> Column:
        there = F.lit(True)
        for k, bit in zip(keys, m):
            there = there & F.col(k).isNotNull() if bit == "1" else there
        own = F.struct(F.lit(m).alias("mask"), *[F.when(F.lit(bit == "1"), F.col(k)).alias(f"k{i}") for i, (k, bit) in enumerate(zip(keys, m))])
        return F.when(there, own)

    told = targets.select(F.explode(F.array_compact(F.array(*[key_of(m) for m in wanted]))).alias("k"), F.coalesce("since", F.lit(FOREVER)).alias("since"), F.coalesce("until", F.lit(FOREVER)).alias("until"))
    told = box.table(told.groupBy("k", "since").agg(F.max("until").alias("until")), "targets")  # copies of a target are one
    told = told.withColumn("chunk", F.floor(F.col("since") / chunk_width))
    lost = looked_up.join(_valid_in_chunks(looked_up, told, chunk_width), _same("v"), "left_anti")
    begun = told.groupBy(F.col("k").alias("b_k")).agg(F.min("since").alias("begins"))
    reason = F.when(F.col("begins").isNull(), "missing").when(F.col("begins") <= F.col("at"), "deleted").otherwise("late")
    out = lost.join(begun, F.col("k") == F.col("b_k"), "left").select("ref.*", reason.alias("reason"))
    if match == "full":
        part = asked.where(F.col("k.mask") != whole)
        out = out.unionByName(part.select("ref.*", F.lit("partial").alias("reason")))
    return out


def _same(v: str) -> Column:
    """Key and chunk are equal, and the time lies in the validity."""
    return (F.col("k") == F.col(f"{v}_k")) & (F.col("chunk") == F.col(f"{v}_chunk")) & (F.col(f"{v}_since") <= F.col("at")) & (F.col("at") < F.col(f"{v}_until"))


def _valid_in_chunks(refs: DataFrame, told: DataFrame, chunk_width: int) -> DataFrame:
    """(v_k, v_chunk, v_since, v_until): targets by the chunk they begin in, and what is still valid where a later chunk with references begins."""
    ends = told.groupBy("k", "chunk").agg(F.max("until").alias("until"))
    spots = refs.select("k", "chunk").distinct().withColumn("until", F.lit(None).cast("long")).unionByName(ends)
    spots = spots.groupBy("k", "chunk").agg(F.max("until").alias("until"))
    before = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (F.col("chunk") * chunk_width).cast("long")
    carried = spots.withColumn("until", F.max("until").over(before)).where(F.col("until") > starts).select("k", "chunk", F.lit(-FOREVER).alias("since"), "until")
    every = told.select("k", "chunk", "since", "until").unionByName(carried)
    return every.withColumnsRenamed({c: f"v_{c}" for c in every.columns})


def per_period(orphan_rows: DataFrame, table: str = "ref_table", period: str = "period") -> DataFrame:
    """Count of orphan references per table, period and reason."""
    return orphan_rows.groupBy(table, period, "reason").agg(F.count(F.lit(1)).alias("orphans"))
