"""Parent-child rows as full hierarchies: root, depth, path and all descendants of every node, cycles told apart.

Level-wise frontier joins from the roots, with levels that double. Nodes with a settled root and depth form the
settled part: after round k it holds every node less than 2**k levels below its root. A pending node points to its
ancestor 2**k levels up. One join of the pending nodes to all others settles those whose ancestor is settled (the
next frontier, 2**k levels thick) and lets the rest point twice as far. The first round that settles nothing proves
that no node is any deeper: what is left never reaches a root, so it lies on a cycle or below one. Depth d thus needs
about log2(d) + 2 joins, not d.

Nodes carry 8-byte numbers through the rounds. Each round writes one table in the shared folder. Many children of one
parent are many rows of one key on the left of a left join, which the adaptive skew join splits.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.sources.scratch import Scratch


def links(df: DataFrame, key: Column, parent: Column, label: Column | None = None) -> DataFrame:
    """One row (key, parent, label) per distinct non-null key.

    Rows of one key that disagree give the least non-null parent; the label is the least one, the key by default.
    """
    rows = df.select(key.alias("key"), parent.alias("parent"), (key if label is None else label).alias("label"))
    return rows.where("key is not null").groupBy("key").agg(F.min("parent").alias("parent"), F.min("label").alias("label"))


def _settle(edges: DataFrame, box: Scratch, with_path: bool) -> tuple[list[DataFrame], DataFrame | None]:
    """Settled parts (id, root, depth[, path]) and what never settles (id), of edges (id, up[, label])."""
    spark = edges.sparkSession
    path = ["path"] if with_path else []
    start = edges.select(
        "id", "up", F.when(F.col("up").isNull(), F.col("id")).alias("root"), F.when(F.col("up").isNull(), 0).cast("long").alias("depth"),
        *([F.array("label").alias("path")] if with_path else []), F.col("up").isNull().alias("done"),
    )
    parts: list[DataFrame] = []
    stride = 1
    while True:
        watch = Observation()
        counted = start.observe(watch, F.count_if("done").alias("settled"), F.count_if(~F.col("done")).alias("pending"))
        where = box.path("round")
        counted.write.partitionBy("done").parquet(where)
        schema = start.drop("done").schema
        settled, pending = watch.get["settled"], watch.get["pending"]
        if settled:
            parts.append(spark.read.schema(schema).parquet(f"{where}/done=true").select("id", "root", "depth", *path))
        if stride > 1:
            box.drop(f"{last}/done=false")  # noqa: F821 - set by the round before
        last = where
        if not pending:
            return parts, None
        rest = spark.read.schema(schema).parquet(f"{where}/done=false")
        if not settled:
            return parts, rest.select("id")
        known = parts[0]
        for p in parts[1:]:
            known = known.unionByName(p)
        target = known.withColumn("up", F.lit(None).cast("long")).unionByName(rest.select("id", "root", "depth", *path, "up"))
        target = target.withColumnsRenamed({c: f"t_{c}" for c in target.columns})
        hit = F.col("t_root").isNotNull()
        start = rest.join(target, F.col("up") == F.col("t_id"), "left").select(
            "id", F.when(~hit, F.col("t_up")).alias("up"), F.col("t_root").alias("root"), (F.col("t_depth") + stride).alias("depth"),
            *([F.concat("t_path", "path").alias("path")] if with_path else []), hit.alias("done"),
        )
        stride *= 2


def _union(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty.limit(0) if not parts else parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hierarchy(nodes: DataFrame, with_path: bool = False) -> DataFrame:
    """(key, root, depth[, path]) for each node of ``links``.

    A node is a root (depth 0) if its parent is null or no node. One that never reaches a root has null root and path and
    depth -1. ``path`` holds the labels from the root to the node, both included. An empty table gives an empty result.
    """
    spark = nodes.sparkSession
    box = Scratch(spark, "hierarchy")
    numbered = box.table(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    up = numbered.select(F.col("key").alias("p_key"), F.col("id").alias("up"))
    edges = box.table(numbered.join(up, F.col("parent") == F.col("p_key"), "left").select("id", "up", "label"), "edges")
    parts, never = _settle(edges.select("id", "up"), box, False)
    if with_path:  # a second pass over what is known to end, so that no path runs around a cycle
        ended = _union(parts, edges.selectExpr("id", "id as root", "0L as depth")).select("id")
        parts, _ = _settle(box.table(edges.join(ended, "id", "left_semi"), "ended"), box, True)
    empty = edges.selectExpr("id", "id as root", "0L as depth", *(["array(label) as path"] if with_path else []))
    all_ids = _union(parts, empty)
    if never is not None:
        lost = never.selectExpr("id", "cast(null as long) as root", "-1L as depth")
        all_ids = all_ids.unionByName(lost, allowMissingColumns=True)
    names = numbered.select("id", "key", "label")
    roots = numbered.select(F.col("id").alias("root"), F.col("key").alias("root_key"), F.col("label").alias("root_label"))
    return all_ids.join(names, "id").join(roots, "root", "left").select("key", "label", F.col("root_key").alias("root"), "root_label", "depth", *(["path"] if with_path else []))


def descendants(paths: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance), one row per node and each of its ancestors, of ``hierarchy(..., with_path=True)``.

    Built from the paths, so its work is that of its result: no join and no pairs within a group.
    """
    up = paths.where("depth > 0").select(F.col("label").alias("descendant"), "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth").cast("int"))).alias("at", "ancestor"))
    return up.select("ancestor", "descendant", (F.col("depth") - F.col("at")).alias("distance"))
