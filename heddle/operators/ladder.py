"""Prioritised multi-key lookup: the first rung that yields anything wins, no row is multiplied or lost.

The right side is folded once per key (and per key and line), so a header rung never multiplies a
row by the lines of its document: the lookup is an N:1 attachment of a folded block, safe for hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .skew import attach_by_key


def unanimous(c: str) -> Column:
    """The value if exactly one distinct non-blank one occurs in the group, else empty."""
    v = F.nullif(F.col(c), F.lit(""))
    return F.when(F.min(v) == F.max(v), F.max(v)).otherwise("").alias(c)


def fold(rows: DataFrame, keys: list[str], values: list[str], *more: Column) -> DataFrame:
    """One block per key: unanimous values, the number of rows and whatever else is asked for."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("match_count"), *[unanimous(c) for c in values], *more)


def climb(left: DataFrame, row_id: str, rungs: list[tuple[str, Column, Column | None]], blocks: DataFrame) -> DataFrame:
    """Attach to each row the block of its best rung: strategy and the block's columns, null where no rung holds.

    ``rungs`` are (name, key, line or null for a header rung), best first; blank keys and lines skip the rung.
    ``blocks`` has rung_kind ('line' or 'header'), key, line and the folded columns; key and line unique per kind.
    """
    steps = F.array_compact(
        F.array(
            *[
                F.when((key != "") & (line != "" if line is not None else F.lit(True)), F.struct(F.lit(i).alias("prio"), F.lit(name).alias("strategy"), F.lit("header" if line is None else "line").alias("rung_kind"), key.alias("key"), (line if line is not None else F.lit("")).alias("line")))
                for i, (name, key, line) in enumerate(rungs)
            ]
        )
    )
    # Read three times, and its keys are long expressions that would else be repeated in every filter.
    tries = cut(left.select(row_id, F.inline(steps)))
    found = attach_by_key(tries, blocks.select("rung_kind", "key", "line"), ["rung_kind", "key", "line"], [row_id, "prio"])
    best = found.groupBy(row_id).agg(F.min(F.struct("prio", "strategy", "rung_kind", "key", "line")).alias("b")).select(row_id, "b.strategy", "b.rung_kind", "b.key", "b.line")
    block = attach_by_key(best, blocks, ["rung_kind", "key", "line"], [row_id])
    return left.join(block, row_id, "left")
