"""Window functions over keys that may hold a third of all rows.

A plain window gathers every row of a key in one task. Here each key is cut into chunks along its order (a day, a
range of ordinals): rows meet only within (key, chunk), and what has to cross a chunk's edge travels in one summary
row per (key, chunk), made by a pre-aggregated group-by. Only those summaries are windowed by key. The chunk column
must not fall as the order rises. Keys and chunk must not be null; a struct of nullable columns is a key that never is.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _attach(df: DataFrame, edges: DataFrame, names: list[str]) -> DataFrame:
    """Give each row the edge columns of its (key, chunk); rows stay where the window put them, only edges move."""
    right = edges.withColumnsRenamed({n: f"__{n}" for n in names})
    on = reduce(and_, [df[n] == right[f"__{n}"] for n in names])
    return df.join(right, on, "left").drop(*[f"__{n}" for n in names])


def running_max(df: DataFrame, keys: list[str], chunk: str, order: list[Column | str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the greatest ``value`` of the key up to and with this row in ``order``; nulls are passed over."""
    names = [*keys, chunk]
    over = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    edges = df.groupBy(*names).agg(F.max(value).alias("__edge")).withColumn("__edge", F.max("__edge").over(over))
    inside = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = df.withColumn("__v", value).withColumn("__near", F.max("__v").over(inside))
    return _attach(near, edges, names).withColumn(out, F.greatest("__near", "__edge")).drop("__v", "__near", "__edge")


def around(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: Column, before: str | None = None, after: str | None = None, number: str | None = None) -> DataFrame:
    """Add, in one pass, what is asked for by name: ``value`` of the preceding and of the following row of the key in ``order`` (null at
    its ends; ``value`` itself must not be null), and the row's number within the key from 1."""
    names = [*keys, chunk]
    rank, over = F.struct(*order), Window.partitionBy(*keys).orderBy(chunk)
    inside = Window.partitionBy(*names).orderBy(*order)
    asked = {
        "before": (before, F.max_by(value, rank), lambda c: F.lag(c).over(over), F.lag("__v").over(inside)),
        "after": (after, F.min_by(value, rank), lambda c: F.lead(c).over(over), F.lead("__v").over(inside)),
        "number": (number, F.count(F.lit(1)), lambda c: F.sum(c).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.row_number().over(inside)),
    }
    asked = {k: v for k, v in asked.items() if v[0]}
    edges = df.groupBy(*names).agg(*[v[1].alias(f"__e_{k}") for k, v in asked.items()])
    edges = edges.select(*names, *[v[2](f"__e_{k}").alias(f"__e_{k}") for k, v in asked.items()])
    near = df.withColumn("__v", value).withColumns({f"__n_{k}": v[3] for k, v in asked.items()})
    joined = _attach(near, edges, names)
    out = {v[0]: F.coalesce(f"__n_{k}", f"__e_{k}") if k != "number" else F.col("__n_number") + F.coalesce("__e_number", F.lit(0)) for k, v in asked.items()}
    return joined.withColumns(out).drop("__v", *[f"__{x}_{k}" for k in asked for x in "ne"])


def running_sum(df: DataFrame, chunk: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the whole table up to and with this row in ``order``. No task gets more than a chunk."""
    over = Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    edges = df.groupBy(chunk).agg(F.sum(value).alias("__edge")).withColumn("__edge", F.sum("__edge").over(over))
    inside = Window.partitionBy(chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = df.withColumn("__near", F.sum(value).over(inside))
    return _attach(near, edges, [chunk]).withColumn(out, F.col("__near") + F.coalesce("__edge", F.lit(0))).drop("__near", "__edge")
