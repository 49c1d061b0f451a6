"""The tables of a monitored feed as raw messages of the validator."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import normalize
from tidemark.sources import schema


def _withdrawal(w: Column) -> Column:
    done = F.when(w["state"] == "succeeded", F.struct(w["sequence_number"].alias("sequence_number"), F.lit("").alias("transaction")))
    state = F.struct(F.when(w["state"] == "failed", True).alias("failed"), done.alias("succeeded"), F.when(w["state"] == "submitted", True).alias("submitted"))
    return F.when(w.isNotNull(), F.struct(w["m6id"].alias("m6id"), state.alias("event")))


def subscription_message(feed: DataFrame) -> DataFrame:
    """``feed`` with ``slot`` and ``raw``, the message of type RAW_SUBSCRIPTION (null for ctip rows)."""
    on, off = F.col("block_connected"), F.col("block_disconnected")
    head = on["header"]
    header = F.struct(head["hash"].alias("block_hash"), head["previous_hash"].alias("prev_block_hash"), head["height"].alias("height"), head["chain_work"].alias("work"), head["header_time"].alias("timestamp"))
    events = F.transform(on["events"], lambda e: F.struct(e["deposit"].alias("deposit"), _withdrawal(e["withdrawal"]).alias("withdrawal_bundle")))
    connect = F.struct(F.when(head.isNotNull(), header).alias("header_info"), F.struct(on["bmm_commitment"].alias("bmm_commitment"), events.alias("events")).alias("block_info"))
    message = F.struct(F.when(on.isNotNull(), connect).alias("connect_block"), F.when(off.isNotNull(), F.struct(off["block_hash"].alias("block_hash"))).alias("disconnect_block"))
    slot = F.coalesce(on["sidechain_number"], off["sidechain_number"], F.col("ctip.sidechain_number"))
    return feed.withColumns({"slot": slot, "raw": F.when(F.col("kind") != "ctip", message.cast(schema.RAW_SUBSCRIPTION))})


def feed_events(feed: DataFrame, mode: str = "permissive") -> DataFrame:
    """``feed`` with its normalized ``event`` and the ``error`` of what cannot be normalized."""
    rows = subscription_message(feed)
    block = normalize.subscription_event(F.col("slot"), F.col("raw"))
    is_ctip = F.col("kind") == "ctip"
    kinds = {k: normalize.Checked(F.when(~is_ctip, c.value), F.when(~is_ctip, c.error)) for k, c in block.items()}
    tip = normalize.ctip(F.col("slot"), F.col("ctip.ctip").cast(schema.RAW_CTIP))
    kinds["ctip"] = normalize.Checked(F.when(is_ctip, tip.value), F.when(is_ctip, tip.error))
    return normalize.normalized(rows, F.col("event_ms"), kinds, mode)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")
