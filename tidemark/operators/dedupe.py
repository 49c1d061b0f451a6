"""Messages delivered at least once: find every delivery that is not the kept copy of its message.

0. Store. The deliveries are stored once, narrow, by period (a run of time buckets), without a shuffle.
1. Screen. Only 8-byte digests of (group, message) and of the group travel, with the number of the delivery's time
   bucket. They are spread by message digest, so that every shard sees all deliveries of its messages, and a hot bucket
   or source is spread over all shards. Copies within a batch of a scan become one row before they travel. A shard keeps one
   growing Bloom filter per time bucket, one per span of buckets and one over all of them. An identifier that the overall
   filter does not hold is definitely new. One that it holds is looked up in the spans and, of those that may hold it, in the
   buckets; group digest and range of the buckets that may hold a copy are what the screen gives out.
2. Verify. Only groups with a possible repeat are read again from storage, only in the periods that matched and only rows in the matching buckets. There
   the comparison is exact, on the columns themselves; a false positive costs a look, never a result. Rows of all other groups
   are left out before any shuffle: the candidates of as many periods as fit under a checked size are broadcast at a
   time. A period whose candidates alone exceed it is joined by a shuffle.

Filters grow by the number of identifiers they hold, so the rate of false positives stays the same at every size.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import chunked
from tidemark.sources.scratch import Scratch

FIRST_CAPACITY, BITS_PER_ITEM, HASHES = 2048, 12, 6
SPAN = 32
PERIODS = 16
MOST_BROADCAST = 500_000
ROWS_PER_SHARD = 5_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A second digest of 8-byte digests."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class BloomFilter:
    """A Bloom filter of 8-byte digests that grows: a full part gets a successor of twice its size."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.capacity, self.free = FIRST_CAPACITY, 0

    @staticmethod
    def _places(x: np.ndarray, bits: int) -> np.ndarray:
        """HASHES bit positions of each digest."""
        step = _mix(x) | np.uint64(1)
        return ((x[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) >> np.uint64(11)) % np.uint64(bits)

    def has(self, x: np.ndarray) -> np.ndarray:
        """Which digests may be in the filter; False is certain."""
        out = np.zeros(len(x), bool)
        for part in self.parts:
            at = self._places(x, len(part) * 8)
            out |= ((part[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
        return out

    def add(self, x: np.ndarray) -> None:
        while len(x):
            if not self.free:
                self.capacity *= 2 if self.parts else 1
                self.parts.append(np.zeros(self.capacity * BITS_PER_ITEM // 8, np.uint8))
                self.free = self.capacity
            now, x = x[: self.free], x[self.free :]
            self.free -= len(now)
            part = self.parts[-1]
            at = self._places(now, len(part) * 8).ravel()
            np.bitwise_or.at(part, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Before the shuffle, one row per (message, bucket) and batch, and whether the batch had more of them."""
    for batch in batches:
        message, grp, bucket = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        order = np.lexsort((bucket, message))
        m, b = message[order], bucket[order]
        head = np.ones(len(order), bool)
        head[1:] = (m[1:] != m[:-1]) | (b[1:] != b[:-1])
        starts = np.flatnonzero(head)
        more = np.diff(np.append(starts, len(order))) > 1
        at = order[starts]
        yield pa.RecordBatch.from_arrays([pa.array(message[at]), pa.array(grp[at]), pa.array(bucket[at]), pa.array(more)], ["message", "grp", "bucket", "more"])


class BucketFilters:
    """One filter per time bucket, under one per span of SPAN buckets, under one over all."""

    def __init__(self) -> None:
        self.overall = BloomFilter()
        self.spans: dict[int, BloomFilter] = {}
        self.buckets: dict[int, dict[int, BloomFilter]] = {}

    def widen(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, known: np.ndarray) -> None:
        """Widen the ranges lo to hi of the ``known`` positions of x by the buckets that may hold them."""
        for span, over in self.spans.items():
            near = known[over.has(x[known])]
            for b, f in self.buckets[span].items() if len(near) else ():
                match = near[f.has(x[near])]
                lo[match], hi[match] = np.minimum(lo[match], b), np.maximum(hi[match], b)

    def add(self, x: np.ndarray, buckets: np.ndarray, fresh: np.ndarray) -> None:
        """Add identifiers with their buckets; ``fresh``: those that are definitely new."""
        self.overall.add(fresh)
        for b in np.unique(buckets).tolist():
            span, mine = b // SPAN, np.unique(x[buckets == b])
            self.spans.setdefault(span, BloomFilter()).add(mine)
            self.buckets.setdefault(span, {}).setdefault(b, BloomFilter()).add(mine)


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(message, grp, bucket, more) of one shard -> (grp, lo, hi) of possible repeats."""
    filters = BucketFilters()
    for batch in batches:
        message, grp, bucket = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        more = batch.column(3).to_numpy(zero_copy_only=False)
        ident = message.view(np.uint64)
        order = np.lexsort((bucket, ident))
        message_s, bucket_s = ident[order], bucket[order]
        head = np.ones(len(order), bool)
        head[1:] = message_s[1:] != message_s[:-1]
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], len(order))
        unique, lo, hi = message_s[starts], bucket_s[starts].copy(), bucket_s[ends - 1].copy()
        again = filters.overall.has(unique)
        repeat = again | (ends - starts > 1) | (np.maximum.reduceat(more[order], starts) if len(order) else again)
        filters.widen(unique, lo, hi, np.flatnonzero(again))
        filters.add(message_s, bucket_s, unique[~again])
        at = order[starts[repeat]]
        yield pa.RecordBatch.from_arrays([pa.array(grp[at]), pa.array(lo[repeat]), pa.array(hi[repeat])], ["grp", "lo", "hi"])


def possible_repeats(deliveries: DataFrame, shards: int) -> DataFrame:
    """(grp, lo, hi) of every group of which some message may have come more than once.

    ``deliveries`` has (message, grp, bucket), all bigint: digest of the message, digest of its group, time bucket.
    """
    combined = deliveries.select("message", "grp", "bucket").mapInArrow(_combine, "message bigint, grp bigint, bucket bigint, more boolean")
    found = combined.repartition(shards, F.col("message")).mapInArrow(_screen, "grp bigint, lo bigint, hi bigint")
    return found.groupBy("grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _matching(stored: DataFrame, repeats: DataFrame, periods: list[int], most: int) -> list[DataFrame]:
    """The stored rows of groups in ``repeats`` (grp, lo, hi, first, last: the period of lo and of hi), in their ranges, in passes over consecutive periods."""
    spread = repeats.select("grp", "lo", "hi", F.explode(F.sequence("first", "last")).alias("__period"))
    counts = {r["__period"]: r["n"] for r in spread.groupBy("__period").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most PERIODS rows
    passes: list[list[int]] = []
    room = 0
    for p in periods:
        n = counts.get(p, 0)
        if not n:
            continue
        if passes and n <= room:
            passes[-1].append(p)
            room -= n
        else:
            passes.append([p])
            room = most - n
    out = []
    for some in passes:
        mine = spread.where(F.col("__period").isin(some)).select("grp", "lo", "hi").distinct()
        if sum(counts[p] for p in some) <= most:
            mine = F.broadcast(mine)
        rows = stored.where(F.col("period").isin(some))
        out.append(rows.join(mine, "grp").where("bucket between lo and hi").select("k", "s", "t", "seq"))
    return out


def surplus_deliveries(
    df: DataFrame, group: list[str], state: list[str], time: Column, order: str, bucket_width: int, chunk_width: int | None = None, most: int = MOST_BROADCAST,
) -> DataFrame:
    """``order`` of every delivery that is not the kept copy of its message.

    Deliveries of one ``group`` are taken by ``time`` (a bigint); two are copies of one message if their ``state`` is
    equal and no delivery of the group with another state lies between them. The kept copy has the least ``order``
    (unique). Nulls in ``group`` and ``state`` equal each other; a null time counts as the earliest of all. Deliveries of
    one group, one time and different states are taken in the order of their states. An empty table gives none.
    ``bucket_width``: width of a time bucket, in units of ``time``; ``chunk_width``: that of a chunk in which a group's deliveries
    meet in one task, a bucket's by default. ``most``: how many candidate groups may be broadcast at once (each is three bigints).

    A group of copies may hold a third of all rows: equal (group, state, time) are pre-aggregated before any shuffle,
    and runs are found within (group, chunk) and joined across the chunks' edges by summaries. Groups and states are
    structs, which are never null and whose null fields equal each other.
    """
    box = Scratch(df.sparkSession, "repeats")
    rows = df.select(
        F.struct(*group).alias("k"), F.struct(*state, F.lit(0).alias("__none")).alias("s"),
        F.coalesce(time, F.lit(-(2**53))).alias("t"), F.col(order).alias("seq"),
    )
    rows = rows.withColumn("grp", F.xxhash64("k")).withColumn("message", F.xxhash64("grp", "s")).withColumn("bucket", F.floor(F.col("t") / bucket_width).cast("long"))
    span = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    first = (span["lo"] or 0) // bucket_width
    wide = max(1, -(-((span["hi"] or 0) // bucket_width - first + 1) // PERIODS))  # buckets in a period

    def period(bucket: str) -> Column:
        return F.greatest(F.floor((F.col(bucket) - first) / wide), F.lit(-1)).cast("int")  # -1: null times

    stored, stored_at = box.stored(rows.withColumn("period", period("bucket")), "storage", ["period"])
    repeats, repeats_at = box.stored(possible_repeats(stored, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-span["n"] // ROWS_PER_SHARD))), "repeats")
    repeats = repeats.withColumns({"first": period("lo"), "last": period("hi")})
    near = _matching(stored, repeats, list(range(-1, PERIODS + 1)), most)
    near = reduce(DataFrame.unionByName, near) if near else stored.limit(0).select("k", "s", "t", "seq")
    near = box.table(near, "near")
    box.drop(stored_at, repeats_at)
    points = near.withColumn("chunk", F.floor(F.col("t") / (chunk_width or bucket_width)).cast("long"))
    points = points.groupBy("k", "chunk", "s", "t").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    points = chunked.around(points, ["k"], "chunk", ["t", "s"], F.col("s"), before="before")
    begins = F.col("before").isNull() | (F.col("before") != F.col("s"))
    points = chunked.running_max(points, ["k"], "chunk", ["t", "s"], F.when(begins, F.struct("t", "s")), "run")
    points = box.table(points.select("k", "s", "t", "run", "first", "n"), "points")
    runs = points.groupBy("k", "run").agg(F.min("first").alias("kept"), F.sum("n").alias("copies")).where("copies > 1")
    marked = points.join(runs, ["k", "run"])
    alone = marked.where("n = 1 and first <> kept").select(F.col("first").alias("seq"))
    many = near.join(marked.where("n > 1").select("k", "s", "t", "kept"), ["k", "s", "t"]).where("seq <> kept").select("seq")
    return alone.unionByName(many).withColumnRenamed("seq", order)
