"""Ordered outputs: sorted by range partitions, with the position of each row where it is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def numbered(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """The rows in order with their position from 1.

    The range partitions of the sort are numbered each by itself and shifted by the rows before
    them; only one row a partition is broadcast. ``order`` must be total for positions to be stable.
    """
    at = F.monotonically_increasing_id()
    s = cut(rows.orderBy(*order).withColumn("__h_at", at))
    s = s.withColumn("__h_part", F.shiftright("__h_at", 33)).withColumn("__h_in", F.col("__h_at").bitwiseAND((1 << 33) - 1))
    sizes = s.groupBy("__h_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.__h_part") < F.col("a.__h_part"), "left").groupBy(F.col("a.__h_part").alias("__h_part")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("__h_before"))
    out = s.join(F.broadcast(before), "__h_part").withColumn(name, (F.col("__h_before") + F.col("__h_in") + 1).cast("bigint"))
    return out.drop("__h_at", "__h_part", "__h_in", "__h_before")


def reason(coverage: Column, supplier: Column, basis: Column, scope: Column, partner: Column, shared: Column, items: Column, reverse: Column, partner_lines: Column, least_lines: int) -> Column:
    """The finding in plain words: share, what it is about, how it was matched, which side is broader, thin evidence."""
    percent = F.bround(F.least(F.greatest(coverage, F.lit(0.0)), F.lit(1.0)) * 100).cast("int").cast("string")
    what = F.when(basis == "spend", "spend").otherwise("lines")
    about = F.when(shared != "", F.concat(F.lit(", mostly "), shared)).otherwise("")
    side = F.when(reverse >= coverage + 0.15, F.concat(F.lit(" "), partner, F.lit(" sells less than that besides and may be given up."))).when(coverage >= reverse + 0.15, F.concat(F.lit(" "), partner, F.lit(" sells more than that and may take it over."))).otherwise("")
    thin = F.when(partner_lines < least_lines, F.concat(F.lit(" Only "), partner_lines.cast("string"), F.lit(" lines of its own say so."))).otherwise("")
    return F.concat(percent, F.lit("% of the "), what, F.lit(" with "), supplier, F.lit(" in "), scope, F.lit(" could go to "), partner, about, F.lit(" ("), items.cast("string"), F.lit(" equal items)."), side, thin)
