"""The startup snapshot: chain info, tip, proposals, active sidechains, then one CTIP per monitored slot."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = ("chain_info", "chain_tip", "sidechain_proposals", "active_sidechains", "ctip")


def snapshot_events(parts: dict[str, DataFrame], slots: list[int]) -> DataFrame:
    """(seq, event) in the order of ORDER, ctips in the order of ``slots``: 4 + len(slots) rows.

    ``parts``: by kind, the answers as normalized (event, error); those of ctip with ``slot``. All or nothing: a reason
    against any part ends the query with it. Slots without an answer have no row, and answers of other slots are left out.
    """
    if set(parts) != set(ORDER):
        raise ValueError(f"a snapshot has the parts {', '.join(ORDER)}")
    out = None
    for n, kind in enumerate(ORDER):
        rows = parts[kind]
        seq = F.lit(n).cast("long")
        if kind == "ctip":
            place = F.array_position(F.array(*[F.lit(s).cast("long") for s in slots]), F.col("slot").cast("long"))
            rows, seq = rows.where(place > 0), place + n - 1
        good = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit(f"{kind}: "), F.col("error"))).cast(rows.schema["event"].dataType)).otherwise(F.col("event"))
        rows = rows.select(seq.alias("seq"), good.alias("event"))
        out = rows if out is None else out.unionByName(rows)
    return out


def tip_hash(tip: DataFrame) -> DataFrame:
    """The hash of the tip's block."""
    return tip.select(F.col("event.enforcer.chain_tip.header.hash").alias("tip_hash"))
