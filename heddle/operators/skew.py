"""Joins and attachments that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of a hot key on a small session.
FAN = 24


def slots_of_a_key() -> int:
    """Slots over which a key is spread: as many as the session has shuffle partitions, so that a hot key can use them all."""
    spark = SparkSession.getActiveSession()
    return max(FAN, int(spark.conf.get("spark.sql.shuffle.partitions"))) if spark else FAN


def salt(*cols: Column | str, fan: int | None = None) -> Column:
    """A slot in 0..fan-1 that depends on the row, not on chance, so a retried task gives the same."""
    return F.pmod(F.xxhash64(*cols), F.lit(fan or slots_of_a_key())).cast("int")


def attach_by_key(rows: DataFrame, facts: DataFrame, keys: Sequence[str], spread_on: Sequence[str], fan: int | None = None, how: str = "inner") -> DataFrame:
    """Join ``facts`` to ``rows`` without sending a hot key to one task.

    Each key's fact is copied only to the slots in which its rows lie, found by a
    pre-aggregated distinct of (key, slot): a rare key is copied once, a hot one ``fan`` times.
    Keys that are null match nothing.
    """
    slotted = rows.withColumn("__h_slot", salt(*spread_on, fan=fan))
    slots = slotted.select(*keys, "__h_slot").distinct()
    copies = facts.join(slots, list(keys))
    return slotted.join(copies, [*keys, "__h_slot"], how).drop("__h_slot")


def min_by_key(rows: DataFrame, keys: Sequence[str], value: str, out: str, spread_on: Sequence[str], fan: int | None = None) -> DataFrame:
    """Attach to each row the least ``value`` of its key, in two steps for hot keys."""
    slotted = rows.withColumn("__h_slot", salt(*spread_on, fan=fan))
    part = slotted.groupBy(*keys, "__h_slot").agg(F.min(value).alias("__h_m"))
    whole = part.groupBy(*keys).agg(F.min("__h_m").alias(out), F.collect_set("__h_slot").alias("__h_slots"))
    copies = whole.select(*keys, out, F.explode("__h_slots").alias("__h_slot"))
    return slotted.join(copies, [*keys, "__h_slot"]).drop("__h_slot")


def pairs_within(rows: DataFrame, group: str, member: str, a: str, b: str) -> DataFrame:
    """(a, b): each pair of different members of one group once, the smaller first; for results that are pairs by definition.

    The left side of a group is spread over slots and the right side copied only to the slots
    that have some, so the pairs of one large group are made by many tasks.
    """
    r = rows.select(group, member)
    return attach_by_key(r.withColumnRenamed(member, a), r.withColumnRenamed(member, b), [group], [a]).where(F.col(a) < F.col(b)).select(a, b)
