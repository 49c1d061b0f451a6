"""Single answers of the validator, told as JSON, as normalized events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import normalize
from tidemark.sources import schema

RAW = {
    "chain_info": (schema.RAW_CHAIN_INFO, normalize.chain_info), "chain_tip": (schema.RAW_CHAIN_TIP, normalize.chain_tip),
    "sidechain_proposals": (schema.RAW_PROPOSALS, normalize.sidechain_proposals), "active_sidechains": (schema.RAW_ACTIVE, normalize.active_sidechains),
}


def requests(slots: list[int]) -> list[str]:
    """The requests of a startup snapshot: one of each kind, and one for the CTIP of each slot."""
    return [*RAW, *[f"ctip/{s}" for s in slots]]


def fetch(spark: SparkSession, options: dict[str, str], wanted: list[str]) -> DataFrame:
    """(request, answer) of the source ``answers``, each request once."""
    reader = spark.read.format("answers").option("requests", ",".join(wanted))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def snapshot_parts(answers: DataFrame, mode: str = "permissive") -> dict[str, DataFrame]:
    """By kind, (slot, event, error) of told answers (request, answer): what ``snapshot.snapshot_events`` takes.

    An answer that is no JSON of its kind reads as one without fields; a CTIP answered by null is no CTIP. An array that is missing is empty.
    """
    now = F.unix_millis(F.current_timestamp())
    rows = answers.withColumn("slot", F.when(F.col("request").startswith("ctip/"), F.substring_index("request", "/", -1)).try_cast("bigint"))
    out = {}
    for kind, (raw, read) in RAW.items():
        told = F.from_json("answer", raw)
        told = F.coalesce(told, F.from_json(F.lit("[]" if raw.startswith("array") else "{}"), raw))
        out[kind] = normalize.normalized(rows.where(F.col("request") == kind).withColumn("raw", told), now, {kind: read(F.col("raw"))}, mode)
    ctips = rows.where(F.col("slot").isNotNull()).withColumn("raw", F.from_json("answer", schema.RAW_CTIP))
    out["ctip"] = normalize.normalized(ctips, now, {"ctip": normalize.ctip(F.col("slot"), F.col("raw"))}, mode)
    return {k: df.select("slot", "event", "error") for k, df in out.items()}
