"""Questions an operator asks of nodes, logs and configurations, as predicates and small queries."""

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHAINSTATES = "struct<headers:bigint,chainstates:array<struct<blocks:bigint,validated:boolean>>>"


def history_ready(text: Column) -> Column:
    """Whether exactly one chain state is told and it is validated; what is no JSON of that form is not ready."""
    states = F.from_json(text, CHAINSTATES)["chainstates"]
    return F.coalesce((F.size(states) == 1) & F.try_element_at(states, F.lit(1))["validated"], F.lit(False))


def history_summary(text: Column) -> Column:
    """Struct of readiness, number of states, blocks of the first and the last, and how many remain (0 unless there are two)."""
    states = F.from_json(text, CHAINSTATES)["chainstates"]
    count = F.coalesce(F.size(states), F.lit(0))
    count = F.when(count < 0, 0).otherwise(count)
    first, last = F.try_element_at(states, F.lit(1))["blocks"], F.try_element_at(states, F.lit(-1))["blocks"]
    return F.struct(
        history_ready(text).alias("history_ready"), count.alias("chainstate_count"), first.alias("historical_blocks"), last.alias("active_blocks"),
        F.when(count > 1, last - first).otherwise(0).alias("remaining_blocks"),
    )


def with_prefix(df: DataFrame, name: str, prefix: str, *columns: str) -> DataFrame:
    """``columns`` of the rows whose ``name`` begins with ``prefix``; the filter reaches the scan."""
    return df.where(F.col(name).startswith(prefix)).select(*columns)


CHAIN = "struct<chain:string,blocks:bigint,headers:bigint,verificationprogress:double,initialblockdownload:boolean>"
PEERS = "array<struct<addr:string,inbound:boolean,startingheight:bigint,synced_headers:bigint,synced_blocks:bigint>>"
SUBSCRIPTIONS = "struct<subscriptions_list:array<struct<account:string,subject:string,msgs:bigint>>>"


def _json(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def chain_brief(text: Column) -> Column:
    """What is told of a chain, without the rest, as JSON; null for what is no JSON object."""
    told = F.from_json(text, CHAIN)
    return F.when(told.isNotNull() & text.rlike(r"\A\s*\{"), _json(told))


def peer_briefs(text: Column) -> Column:
    """The same of each peer, in their order; null for what is no JSON array."""
    return _json(F.from_json(text, PEERS))


def subscriptions_on(text: Column, subject: str) -> Column:
    """The subscriptions on exactly this subject, as JSON; null where no list is told."""
    return _json(F.filter(F.from_json(text, SUBSCRIPTIONS)["subscriptions_list"], lambda s: s["subject"] == subject))


def wait_until(check: Callable[[], bool], seconds: float, pause: float = 1.0) -> bool:
    """Ask again and again until the answer is yes (true) or the time is over (false). An answer that fails counts as no, but the last failure is
    raised if none came before the end. At least one question is asked."""
    end = time.monotonic() + seconds
    while True:
        error: Exception | None = None
        try:
            if check():
                return True
        except Exception as e:  # noqa: BLE001 - what is waited for may not be there yet
            error = e
        if time.monotonic() + pause > end:
            if error is not None:
                raise error
            return False
        time.sleep(pause)


def any_named(items: Column, field: str, wanted: str) -> Column:
    """Whether some element of an array of structs has the value; false for a null array."""
    return F.coalesce(F.exists(items, lambda x: F.coalesce(x[field] == wanted, F.lit(False))), F.lit(False))


def node_ready(chain: Column, blocks: Column, headers: Column, syncing: Column, pinned: Column, least: int, wanted_chain: str, wanted_hash: str) -> Column:
    """Right chain, far enough, not in its first download, and with the pinned block; what is null is not ready."""
    return F.coalesce((chain == wanted_chain) & (blocks >= least) & (headers >= least) & ~syncing & (pinned == wanted_hash), F.lit(False))


def tip_agreement(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Rows of ``ours`` whose (height, hash) ``theirs`` has as well. Both have height and hash; null agrees with nothing."""
    return ours.join(theirs.select("height", "hash").distinct(), ["height", "hash"], "left_semi")


def log_matches(line: Column, message: Column | str, slot: Column, block: Column) -> Column:
    """Whether a log line tells the message of the block for exactly this slot (9 is not 98)."""
    message = F.lit(message) if isinstance(message, str) else message
    exact = F.regexp_like(line, F.concat(F.lit('(^|[\\s"])sidechain='), slot.cast("string"), F.lit("([^0-9]|$)")))
    return F.coalesce(line.contains(message) & exact & line.contains(block), F.lit(False))


def undelivered(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that were not seen: none means that all were delivered everywhere."""
    right = seen.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return expected.join(right, on, "left_anti")


def slots_of(text: Column) -> Column:
    """Slot numbers of a comma-separated list; null if the list is empty or any entry is no number from 0 to 255."""
    parts = F.split(text, ",")
    numbers = F.transform(parts, lambda p: F.when(p.rlike(r"\A[0-9]{1,9}\z"), p).try_cast("int"))
    good = F.forall(numbers, lambda n: F.coalesce(n.between(0, 255), F.lit(False)))
    return F.when(good & (F.size(parts) > 0), numbers)


def positive(text: Column) -> Column:
    """The number a text of digits stands for, if it is above 0."""
    number = F.when(text.rlike(r"\A[0-9]+\z"), text).try_cast("long")
    return F.when(number > 0, number)


def setting_keys(line: Column) -> Column:
    """The name set by a line NAME=value; null if it isn't written in capitals, digits and underscores."""
    name = F.regexp_replace(F.split(line, "=", 2)[0], r"\A\s+|\s+\z", "")
    return F.when(line.contains("=") & name.rlike(r"\A[A-Z][A-Z0-9_]*\z"), name)


def key_overlap(own: DataFrame, locked: DataFrame, key: str) -> DataFrame:
    """Keys that both have, once each; none is what is wanted."""
    return own.select(key).distinct().join(locked.select(key), key, "left_semi")


def payload_matches(payload: Column, size: int, digest: str | Column) -> Column:
    """Size first, then SHA-256."""
    wanted = F.lit(digest.lower()) if isinstance(digest, str) else F.lower(digest)
    return F.coalesce((F.octet_length(payload) == size) & (F.sha2(payload, 256) == wanted), F.lit(False))


def saturating_add(number: Column, more: Column, most: int = 2**64 - 1) -> Column:
    """Sum of decimals, at most ``most``."""
    return F.least((number + more).cast("decimal(38,0)"), F.lit(str(most)).cast("decimal(38,0)"))
