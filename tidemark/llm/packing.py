"""Items of varying length packed into containers of fixed capacity.

Hierarchical residual packing. An item longer than the capacity is cut; its full pieces are containers by themselves and
only the rest is packed. Then rounds of best-fit: every task packs its items, largest first, each into the fullest bin
that still takes it. Nearly full bins are final. An underfull bin goes to the next round as one item of the size it holds,
together with bins of other tasks, so the rounds form a tree of merges. A task never gets more than ``rows_per_task`` items,
however many there are; a target's rounds end when one task has packed all that was left, or a round saved next to nothing of this target's bins.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import Scratch

ROWS_PER_TASK = 50_000
TARGETS_AT_ONCE = 1_000
NEARLY_FULL = 0.995
LEAST_SAVED = 0.002
MEMBERS = "array<struct<item:bigint,part:int,first:bigint,size:bigint>>"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins, each a list of positions in ``sizes``: best-fit decreasing. No size may be over the capacity.

    Bit r of a mask tells whether some bin has r left, so the fullest bin that fits is found by two operations on an integer.
    """
    by_left: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, []
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = by_left[left].pop()
            if not by_left[left]:
                mask ^= 1 << left
            bins[b].append(at)
        else:
            left, b = capacity, len(bins)
            bins.append([at])
        left -= size
        by_left[left].append(b)
        mask |= 1 << left
    return bins


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task of one round: (target, capacity, fill, members) in and out, with ``final`` for nearly full bins."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    table = table.combine_chunks()
    targets, capacities, fills = (table.column(i).to_numpy() for i in range(3))
    members = table.column(3).combine_chunks()
    if isinstance(members, pa.ChunkedArray):
        members = members.chunk(0)
    for target in np.unique(targets):
        rows = np.flatnonzero(targets == target)
        capacity = int(capacities[rows[0]])
        bins = best_fit(fills[rows], capacity)
        order = rows[np.fromiter((i for b in bins for i in b), np.int64, len(rows))]
        taken = members.take(pa.array(order))
        lengths = np.diff(taken.offsets.to_numpy())
        of_bin = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        count = np.bincount(of_bin, weights=lengths, minlength=len(bins)).astype(np.int64)
        fill = np.bincount(of_bin, weights=fills[order], minlength=len(bins)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), taken.flatten())
        size = len(bins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, target, targets.dtype)), pa.array(np.full(size, capacity, np.int64)), pa.array(fill), lists, pa.array(fill >= NEARLY_FULL * capacity)],
            ["target", "capacity", "fill", "members", "final"],
        )


def pack(items: DataFrame, targets: DataFrame, item: str, size: str, target: str, capacity: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(target, container, item, part, first, size): where each piece of each item lies, for every target.

    ``item``: a unique bigint; ``size``: a bigint, null counts as 0; items of size 0 take no room but have a container as well.
    ``targets``: a short list; those with a capacity that is null or below 1 are passed over. TARGETS_AT_ONCE of them are packed together.
    An item is cut only if its size exceeds the capacity: into pieces of the capacity and one rest; ``first`` is the offset of a
    piece in its item. A container is named after its first piece, "item-part". Empty tables give no containers.
    """
    spark = items.sparkSession
    box = Scratch(spark, "pack")
    named = F.col(target).alias("target")
    few = targets.where(F.col(capacity) >= 1).select(named, F.col(capacity).cast("long").alias("capacity"))
    wanted = few.distinct().collect()
    kind = few.schema["target"].dataType.simpleString()
    sized = box.table(items.select(F.col(item).cast("long").alias("item"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size")), "sizes")
    count = sized.count()
    packed = [_pack_targets(box, sized, count, wanted[i : i + TARGETS_AT_ONCE], kind, rows_per_task) for i in range(0, max(1, len(wanted)), TARGETS_AT_ONCE)]
    return reduce(DataFrame.unionByName, packed)


def _pack_targets(box: Scratch, sized: DataFrame, items: int, wanted: list, kind: str, rows_per_task: int) -> DataFrame:
    """The result of ``pack`` for some of the targets."""
    spark = sized.sparkSession
    each = F.array(*[F.struct(F.lit(t["target"]).cast(kind).alias("target"), F.lit(t["capacity"]).cast("long").alias("capacity")) for t in wanted])
    every = sized.select("item", "size", F.inline(each.cast(f"array<struct<target:{kind},capacity:bigint>>")))
    whole = F.when(F.col("size") > F.col("capacity"), F.floor((F.col("size") - 1) / F.col("capacity"))).otherwise(0).cast("int")
    every = every.withColumn("whole", whole)
    full = every.where("whole > 0").select("target", "item", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("part"), (F.col("part") * F.col("capacity")).alias("first"), F.col("capacity").alias("size"))
    rest = F.col("size") - F.col("whole") * F.col("capacity")
    open_bins = every.select(
        "target", "capacity", rest.alias("fill"),
        F.array(F.struct("item", F.col("whole").alias("part"), (F.col("whole") * F.col("capacity")).alias("first"), rest.alias("size"))).cast(MEMBERS).alias("members"),
    )
    schema = f"target {kind}, capacity bigint, fill bigint, members {MEMBERS}, final boolean"
    left = {t["target"]: items for t in wanted} if items else {}
    done: list[DataFrame] = []
    while left:
        tasks = -(-sum(left.values()) // rows_per_task)
        path = box.path("round")
        open_bins.repartition(tasks).mapInArrow(_pack, schema).write.partitionBy("final").parquet(path)
        made = spark.read.schema(schema).parquet(path)
        told = {r["target"]: r for r in made.groupBy("target").agg(F.count(F.lit(1)).alias("bins"), F.count_if(~F.col("final")).alias("open")).collect()}  # one row a target
        going = [t for t, n in left.items() if tasks > 1 and told[t]["open"] and n - told[t]["bins"] >= LEAST_SAVED * n]
        goes_on = F.col("target").isin(going) & ~F.col("final")
        done.append(made.where(~goes_on))
        open_bins, left = made.where(goes_on).drop("final"), {t: told[t]["open"] for t in going}
    cols = ["target", "item", "part", "first", "size"]
    out = full.select(*cols, F.concat_ws("-", "item", "part").alias("container"))
    for d in done:
        first = F.col("members")[0]
        inner = d.select("target", F.concat_ws("-", first["item"], first["part"]).alias("container"), F.inline("members"))
        out = out.unionByName(inner.select(*cols, "container"))
    return out.select("target", "container", "item", "part", "first", "size")


def fill(packed: DataFrame, targets: DataFrame, target: str, capacity: str) -> DataFrame:
    """(target, containers, least_containers, size) of a result of ``pack``: containers used, the number below which no packing can go, and the sum of sizes."""
    told = packed.groupBy("target").agg(F.count_distinct("container").alias("containers"), F.sum("size").alias("size"))
    few = targets.where(F.col(capacity) >= 1).select(F.col(target).alias("__t"), F.col(capacity).cast("long").alias("__c")).distinct()
    joined = told.join(few, F.col("target") == F.col("__t"))
    return joined.select("target", "containers", F.ceil(F.col("size") / F.col("__c")).alias("least_containers"), "size")
