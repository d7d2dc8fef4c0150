"""Which pending units a service still takes: sums over all units before each decide, not a loop over them.

Units are range-sorted by account and order, so that an account of any size lies on many tasks. Every sum before a row is what the ranges before its
own hold, plus what stands before it in its range; what an account's first row has before it is taken off. So one sort and one number a range
decide for all accounts at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.lineage import kept

#: Bytes and texts of one request.
REQUEST_BYTES, REQUEST_TEXTS = 128 * 1024, 20


def with_sums_before(rows: DataFrame, order: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """rows with ``<amount>_before`` for each amount, the sum of it (null: 0) over all rows that come before in order; rows that tie stand in no fixed order."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = kept(rows.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sums = placed.groupBy(part.alias("_part")).agg(*[F.sum(F.coalesce(F.col(a), F.lit(0))).alias(f"_{a}") for a in amounts])
    # a row for each range of the sort
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", *[F.coalesce(F.sum(f"_{a}").over(over), F.lit(0)).alias(f"_{a}_start") for a in amounts])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    found = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    before = {f"{a}_before": F.col(f"_{a}_start") + F.coalesce(F.sum(F.coalesce(F.col(a), F.lit(0))).over(inside), F.lit(0)) for a in amounts}
    return found.withColumns(before).drop("_at", "_part", *[f"_{a}_start" for a in amounts])


def admitted(
    units: DataFrame, quotas: DataFrame, account: str, order: Sequence[str], chars: str = "chars", size: str = "bytes", most_bytes: int = REQUEST_BYTES, most_texts: int = REQUEST_TEXTS
) -> DataFrame:
    """units (account, order, chars, bytes) with ``state`` and, if they are sent, ``request``.

    quotas (account, used, limit). A unit is SENT if it and all before it in its account's order fit what the account still allows, else
    BLOCKED_QUOTA; a null limit allows all, an unknown account nothing (NO_ACCOUNT). A unit that alone is larger than a request is TOO_LARGE and
    counts for nothing. A request is units that begin in the same half of most_bytes and the same most_texts, so it holds at most both;
    a unit of more than half goes alone. Requests are numbered by where they begin; null accounts are one account."""
    fits = F.coalesce(F.col(size), F.lit(0)) <= most_bytes
    counted = units.withColumns({"_chars": F.when(fits, F.coalesce(F.col(chars), F.lit(0))).otherwise(0).cast("long"), "_bytes": F.when(fits, F.coalesce(F.col(size), F.lit(0))).otherwise(0).cast("long"), "_one": F.when(fits, 1).otherwise(0).cast("long")})
    amounts = ["_chars", "_bytes", "_one"]
    sums = with_sums_before(counted, [account, *order], amounts)
    first = sums.groupBy(F.col(account).alias("_account")).agg(*[F.min(f"{a}_before").alias(f"{a}_first") for a in amounts])
    known = quotas.select(F.col(account).alias("_account"), F.lit(True).alias("_known"), F.col("used").alias("_used"), F.col("limit").alias("_limit"))
    about = first.join(known, first["_account"].eqNullSafe(known["_account"]), "left").drop(known["_account"])
    held = sums.join(about, sums[account].eqNullSafe(about["_account"])).drop("_account")
    own = {a: F.col(f"{a}_before") - F.col(f"{a}_first") for a in amounts}
    half = most_bytes // 2
    state = (
        F.when(~fits, "TOO_LARGE")
        .when(F.col("_known").isNull(), "NO_ACCOUNT")
        .when(F.col("_limit").isNull() | (F.coalesce("_used", F.lit(0)) + own["_chars"] + F.col("_chars") <= F.col("_limit")), "SENT")
        .otherwise("BLOCKED_QUOTA")
    )
    alone = F.when(F.col("_bytes") > half, own["_one"] + 1).otherwise(0)
    request = F.struct(F.floor(own["_bytes"] / half).cast("long").alias("cell"), F.floor(own["_one"] / most_texts).cast("long").alias("row"), alone.cast("long").alias("alone"))
    found = held.withColumn("state", state).withColumn("request", F.when(F.col("state") == "SENT", request))
    return found.select(*units.columns, "state", "request")


def requests(sent: DataFrame, account: str, chars: str = "chars", size: str = "bytes") -> DataFrame:
    """What each request of admitted() holds."""
    return sent.filter("state = 'SENT'").groupBy(account, "request").agg(F.count("*").alias("texts"), F.sum(chars).alias("chars"), F.sum(size).alias("bytes"))


def account_states(sent: DataFrame, account: str, chars: str = "chars") -> DataFrame:
    """Per account what is sent and what isn't, and its state: BLOCKED_QUOTA if anything is left for want of quota."""
    of = lambda state, what: F.sum(F.when(F.col("state") == state, what).otherwise(0))
    sums = sent.groupBy(account).agg(of("SENT", F.lit(1)).alias("sent"), of("SENT", F.col(chars)).alias("sent_chars"), of("BLOCKED_QUOTA", F.lit(1)).alias("blocked"), of("BLOCKED_QUOTA", F.col(chars)).alias("blocked_chars"), of("TOO_LARGE", F.lit(1)).alias("too_large"))
    return sums.withColumn("state", F.when(F.col("blocked") > 0, "BLOCKED_QUOTA").otherwise("COMPLETE"))
