"""Supplier consolidation: which other supplier could serve the largest share of each supplier's spend, per scope.

Lines are folded to (scope, supplier, item) once; nothing after that sees a line. Overlap is an
equi-join of the folded portfolio with itself on scope and item, so no pair of suppliers is formed
that shares nothing. Every scope and every named item takes part, however many suppliers hold it; the
reference's memory guards (FANOUT, SCOPE_CAP) are parameters that are off unless a caller sets them.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.skew import salt
from ..session import cut, parts, table

LEVELS = ["category_l1", "category_l2", "category_l3", "category_l4", "business_area", "division"]
# Thresholds of the analysis.
HIGH, MEDIUM, REPORT, RETAIN = 0.60, 0.30, 0.10, 0.02
MIN_SPEND, MIN_LINES, FANOUT, SCOPE_CAP, RETAINED, SHOWN, SATURATION = 10_000, 3, 2_000, 5_000, 50, 5, 25
# Least suppliers of a task, most blocks of a scope, partners of a task, pairs or lines of pairs held at a time.
BLOCK, BLOCKS, SPAN, CHUNK = 2_500, 4, 200_000, 1_000_000
SCOPE = ["scope_level", "scope_value"]
KEY = [*SCOPE, "supplier"]
TOTALS = ["total_weight", "total_spend", "total_lines", "named_weight"]


def purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with supplier, item (the group label in one spelling) and the scope columns."""
    a = table(spark, sf_dir, "agent1_unified_lines").select("row_id", *LEVELS, "supplier_name", "country", "currency")
    g = table(spark, sf_dir, "agent2_purchase_groups").select("row_id", F.col("supplier_id").alias("supplier"), F.trim(F.lower("ai_purchase_group_l5")).alias("label"), F.col("spend_eur").cast("decimal(18,4)").alias("spend"))
    return g.join(a, "row_id").withColumn("named", F.coalesce(~F.col("label").isin("", "other"), F.lit(False))).withColumn("item", F.when(F.col("named"), F.col("label")).otherwise(""))


def scope_unpivot(lines: DataFrame, levels: list[str]) -> DataFrame:
    """One row per line and scope level that is filled in; levels that are absent are skipped, none at all is an error."""
    have = [x for x in levels if x in lines.columns]
    if not have:
        raise ValueError("no scope level among the columns")
    long = lines.select("*", F.inline(F.array(*[F.struct(F.lit(x).alias("scope_level"), T.collapse(x).alias("scope_value")) for x in have])))
    return long.where((F.col("scope_value") != "") & F.col("supplier").isNotNull() & (F.col("supplier") != ""))


def weight_basis(scoped: DataFrame) -> DataFrame:
    """Spend if at least half of a scope's lines have some, else lines."""
    return scoped.groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("spend") > 0).alias("with_spend")).withColumn("basis", F.when(2 * F.col("with_spend") >= F.col("lines"), "spend").otherwise("lines"))


def portfolio(scoped: DataFrame) -> DataFrame:
    """(scope, supplier, item) with spend, lines and weight; a supplier whose weight isn't positive is weighed by lines."""
    folded = scoped.groupBy(*KEY, "item", "named").agg(F.sum("spend").alias("spend"), F.count(F.lit(1)).alias("lines"))
    basis = weight_basis(scoped).select(*SCOPE, "basis")
    w = folded.join(basis, SCOPE).withColumn("weight", F.when(F.col("basis") == "spend", F.col("spend")).otherwise(F.col("lines").cast("decimal(18,4)")))
    total = F.sum("weight").over(Window.partitionBy(*KEY))
    return w.withColumn("weight", F.when(F.coalesce(total, F.lit(0)) <= 0, F.col("lines").cast("decimal(18,4)")).otherwise(F.coalesce("weight", F.lit(0).cast("decimal(18,4)"))))


def _totals() -> list[Column]:
    return [F.sum("weight").alias("total_weight"), F.sum("spend").alias("total_spend"), F.sum("lines").alias("total_lines"), F.coalesce(F.sum(F.when(F.col("named"), F.col("weight"))), F.lit(0).cast("decimal(28,4)")).alias("named_weight")]


def totals(p: DataFrame) -> DataFrame:
    return p.groupBy(*KEY).agg(*_totals())


def holders(p: DataFrame) -> DataFrame:
    return p.where("named").groupBy(*SCOPE, "item").agg(F.count(F.lit(1)).alias("holders"))


def scope_sizes(p: DataFrame) -> DataFrame:
    return p.groupBy(*SCOPE).agg(F.countDistinct("supplier").alias("suppliers"))


def matchable(p: DataFrame, scope_cap: int | None = None, fanout: int | None = None) -> DataFrame:
    """Named items of every scope; the caps leave out scopes of more suppliers, and items of more holders, if given."""
    m = p.where("named")
    if scope_cap is not None:
        m = m.join(scope_sizes(p).where(F.col("suppliers") <= scope_cap).select(*SCOPE), SCOPE, "left_semi")
    if fanout is not None:
        m = m.join(holders(p).where(F.col("holders") > fanout).select(*SCOPE, "item"), [*SCOPE, "item"], "left_anti")
    return m


def reach(p: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """How far each partner reaches into each supplier's portfolio: best score per item, summed; edges add similar items."""
    p = cut(p)
    m = matchable(p)
    left = m.select(*KEY, "item", "weight", "spend")
    right = m.select(*SCOPE, F.col("supplier").alias("partner"), "item", F.col("lines").alias("p_lines"))
    exact = left.join(right, [*SCOPE, "item"]).where("supplier <> partner").select(*KEY, "partner", "item", "weight", "spend", "p_lines", F.lit(1.0).alias("score"), F.col("item").alias("engaged"))
    if edges is not None:
        similar = left.join(edges.select("item", F.col("neighbour"), F.col("score")), "item").join(right.withColumnRenamed("item", "neighbour"), [*SCOPE, "neighbour"]).where("supplier <> partner")
        exact = exact.unionByName(similar.select(*KEY, "partner", "item", "weight", "spend", "p_lines", "score", F.col("neighbour").alias("engaged")))
        best = exact.groupBy(*KEY, "partner", "item").agg(F.max("score").alias("score"), F.first("weight").alias("weight"), F.first("spend").alias("spend"))
        engaged = exact.select(*KEY, "partner", "engaged", "p_lines").distinct().groupBy(*KEY, "partner").agg(F.sum("p_lines").alias("partner_lines"))
        summed = _summed(best).join(engaged, [*KEY, "partner"])
    else:
        summed = _summed(exact, F.sum("p_lines").alias("partner_lines"))
    full = summed.join(totals(p), KEY)
    return full.where("total_weight > 0").withColumn("coverage", F.col("matched_weight") / F.col("total_weight").cast("double")).where(F.col("coverage") >= RETAIN)


def _summed(best: DataFrame, *more: Column) -> DataFrame:
    hit = F.col("score") >= 1
    return best.groupBy(*KEY, "partner").agg(
        F.sum(F.col("weight") * F.col("score").cast("decimal(6,4)")).cast("double").alias("matched_weight"),
        F.sum(F.col("spend") * F.col("score").cast("decimal(6,4)")).cast("double").alias("addressable_spend"),
        F.count_if(hit).alias("exact_items"),
        F.count_if(~hit).alias("similar_items"),
        F.coalesce(F.sum(F.when(hit, F.col("weight"))).cast("double"), F.lit(0.0)).alias("exact_weight"),
        *more,
    )


def reach_both_ways(p: DataFrame, floor: float = RETAIN, most: int | None = None, scope_cap: int | None = None, fanout: int | None = None, block: int | None = None, span: int | None = None) -> DataFrame:
    """reach over equal items with its reverse; with ``most``, the first ``most`` partners of each supplier in each span, with their rank there.

    Suppliers of a scope are numbered by name. A task takes ``block`` of them against ``span`` partners and has all
    lines of both, so a pair is summed in one place and no pair is shuffled before the floor and the rank are applied.
    Weights and spend are summed as whole ten-thousandths, which is exact. A scope has at most ``BLOCKS`` blocks unless
    ``block`` is given, so its lines are copied a fixed number of times.
    """
    named = F.col("named")
    if scope_cap is not None or fanout is not None:
        p = cut(p)
        named = F.coalesce("kept", F.lit(False))
        p = p.join(matchable(p, scope_cap, fanout).select(*KEY, "item", F.lit(True).alias("kept")), [*KEY, "item"], "left")
    e4 = lambda c: F.coalesce((F.col(c) * 10_000).cast("bigint"), F.lit(0))
    held = F.collect_list(F.when(named, F.struct(F.xxhash64("item").alias("item"), e4("weight").alias("w"), e4("spend").alias("s"), F.col("lines").cast("bigint").alias("n"))))
    t = p.groupBy(*KEY).agg(*_totals(), held.alias("h"))
    scope = Window.partitionBy(*SCOPE)
    t = cut(t.withColumn("z", F.xxhash64(*SCOPE)).withColumn("r", F.row_number().over(scope.orderBy("supplier")) - 1).withColumn("size", F.count(F.lit(1)).over(scope)))
    span = span or SPAN
    one_span = (t.agg(F.max("size")).first()[0] or 0) <= span
    per = F.lit(block) if block else F.greatest(F.lit(BLOCK), F.ceil(F.col("size") / BLOCKS))
    group = lambda c, by: F.floor(F.col(c) / by).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / by).cast("int")))
    lines = ["item", "w", "s", "n"]
    m = t.where(F.size("h") > 0).select("z", "r", "size", *KEY, *TOTALS, F.col("total_weight").cast("double").alias("tw"), *[F.col(f"h.{c}").alias(c) for c in lines])
    near = m.where("total_weight > 0").select("z", "r", *KEY, *TOTALS, "tw", *lines, F.lit(True).alias("own"), group("r", per).alias("b"), every(F.lit(span)).alias("f"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in m.select(*SCOPE, *TOTALS).schema.fields]
    far = m.select("z", "r", "supplier", *blank, "tw", *lines, F.lit(False).alias("own"), every(per).alias("b"), group("r", F.lit(span)).alias("f"))
    task = near.unionByName(far).repartition(parts(p.sparkSession), "z", "b", "f")
    facts = [*KEY, *TOTALS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _strip(pa.Table.from_batches(batches), facts, floor, most)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in m.select(*facts).schema.fields)
    x = task.groupBy("z", "b", "f").applyInArrow(run, f"{kinds}, partner string, w bigint, s bigint, items bigint, partner_lines bigint, coverage double, reverse_coverage double, s2 bigint, rank int")
    back = F.col("reverse_coverage") >= RETAIN
    if most and not one_span:
        order = [F.desc("coverage"), F.desc("partner_lines"), F.desc("s"), F.col("partner")]
        x = x.withColumn("rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).where(F.col("rank") <= most)
    return x.select(
        *KEY, "partner", (F.col("w") / 10_000).alias("matched_weight"), (F.col("s") / 10_000).alias("addressable_spend"), F.col("items").alias("exact_items"), "partner_lines", *TOTALS, "coverage",
        F.when(back, F.col("reverse_coverage")).otherwise(0.0).alias("reverse_coverage"), F.when(back, F.col("s2") / 10_000).otherwise(0.0).alias("partner_spend"), "rank",
    )


def _ragged(c: pa.ChunkedArray) -> np.ndarray:
    """The values of all lists of a column, one after another."""
    return c.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1 and so on, counts[i] of each."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _strip(rows: pa.Table, facts: list[str], floor: float, most: int | None, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The pairs of one block of suppliers (``own``) with the partners given, at the floor and, with ``most``, first by rank.

    One supplier at a time is summed over the holders of its items, in an array of all partners; what else is
    wanted of a pair is looked up for the pairs that are left.
    """
    one = rows.filter(rows["own"])
    two = rows.filter(pc.invert(rows["own"])).sort_by("r")
    if not len(one) or not len(two):
        return
    them, size = two["r"].to_numpy(), len(two)
    b_count = pc.list_value_length(two["item"]).to_numpy()
    b_item, b_at = _ragged(two["item"]), np.repeat(np.arange(size), b_count)
    order = np.argsort(b_item, kind="stable")
    items, first = np.unique(b_item[order], return_index=True)
    ends = np.append(first[1:], len(order))
    at = b_at[order]
    bw, bs, bn = (_ragged(two[c])[order] for c in ("w", "s", "n"))
    key = np.repeat(np.arange(len(items)), ends - first) * size + at
    a_count = pc.list_value_length(one["item"]).to_numpy()
    a_end = np.cumsum(a_count)
    a_item, aw, as_ = (_ragged(one[c]) for c in ("item", "w", "s"))
    place = np.minimum(np.searchsorted(items, a_item), len(items) - 1)
    known = items[place] == a_item
    lo, hi = np.where(known, first[place], 0), np.where(known, ends[place], 0)
    ids = one["r"].to_numpy()
    total, total2 = one["tw"].to_numpy(), two["tw"].to_numpy()
    me = np.minimum(np.searchsorted(them, ids), size - 1)
    me = np.where(them[me] == ids, me, -1)
    acc, more = np.zeros(size, np.int64), [np.zeros(size, np.int64) for _ in range(5)]
    left: list[tuple] = []
    waiting = 0
    held = pa.table({c: one[c] for c in facts}).combine_chunks()
    partner = two["supplier"].combine_chunks()

    def summed(lists: list[tuple[int, int]], out: np.ndarray, beside: np.ndarray | None = None, each: np.ndarray | None = None) -> np.ndarray:
        """For each partner the sum over the lists that it is in, of what stands beside its lines or of one value for each list."""
        for k, (x, y) in enumerate(lists):
            out[at[x:y]] += beside[x:y] if each is None else each[k]
        return out

    def ready() -> Iterator[pa.RecordBatch]:
        a, j = np.repeat([x[0] for x in left], [len(x[1]) for x in left]), np.concatenate([x[1] for x in left])
        if not most:
            yield from pairs(a, j, *(np.concatenate(v) for v in zip(*(x[2:] for x in left))))
            return
        n = a_count[a]
        i, pair = _runs(a_end[a] - n, n), np.repeat(np.arange(len(a)), n)
        want = place[i] * size + j[pair]
        hit = np.minimum(np.searchsorted(key, want), len(key) - 1)
        ok = known[i] & (key[hit] == want)
        starts = np.cumsum(n) - n
        yield from pairs(a, j, *(np.add.reduceat(np.where(ok, v, 0), starts) for v in (aw[i], as_[i], 1, bn[hit], bw[hit], bs[hit])))

    def pairs(a: np.ndarray, j: np.ndarray, w: np.ndarray, s: np.ndarray, count: np.ndarray, lines: np.ndarray, w2: np.ndarray, s2: np.ndarray) -> Iterator[pa.RecordBatch]:
        cover = (w / 10_000) / total[a]
        with np.errstate(divide="ignore", invalid="ignore"):
            back = np.where(total2[j] > 0, (w2 / 10_000) / total2[j], 0.0)
        rank = np.zeros(len(a), np.int32)
        if most:
            o = np.lexsort((j, -s, -lines, -cover, a))
            a, j, w, s, count, lines, cover, back, s2 = (v[o] for v in (a, j, w, s, count, lines, cover, back, s2))
            rank = (np.arange(len(a)) - np.searchsorted(a, a, "left") + 1).astype(np.int32)
        t = held.take(pa.array(a))
        for name, v in (("partner", partner.take(pa.array(j))), ("w", w), ("s", s), ("items", count), ("partner_lines", lines), ("coverage", cover), ("reverse_coverage", back), ("s2", s2), ("rank", rank)):
            t = t.append_column(name, v if isinstance(v, pa.Array) else pa.array(v))
        yield from t.combine_chunks().to_batches(max_chunksize=100_000)

    firsts: dict[int, np.ndarray] = {}

    def first_of(x: int, y: int) -> np.ndarray:
        """The partners that a supplier with this list alone can need: its holders with the most lines, by name among equals."""
        if x not in firsts:
            firsts[x] = at[x:y][np.lexsort((at[x:y], -bn[x:y]))[: most + 1]]
        return firsts[x]

    for k in range(len(one)):
        span = slice(a_end[k] - a_count[k], a_end[k])
        lists = list(zip(lo[span].tolist(), hi[span].tolist()))
        touched = sum(y - x for x, y in lists)
        if not touched:
            continue
        if most and sum(y > x for x, y in lists) == 1:
            e = int(np.argmax(known[span]))
            if (aw[span][e] / 10_000) / total[k] >= floor:
                c = first_of(*lists[e])
                c = c[c != me[k]][:most]
                if len(c):
                    left.append((k, c))
                    waiting += len(c) * len(lists)
            if waiting > chunk:
                yield from ready()
                left, waiting = [], 0
            continue
        summed(lists, acc, each=aw[span])
        if me[k] >= 0:
            acc[me[k]] = 0
        least = floor * total[k] * 10_000
        least = int(least * (1 - 1e-12)) - 1
        if touched * 8 < size:
            some = np.concatenate([at[x:y] for x, y in lists])
            c = np.unique(some[acc[some] > least])
        else:
            some, c = slice(None), np.flatnonzero(acc > least)
        c = c[(acc[c] / 10_000) / total[k] >= floor]
        if most and len(c) > most:
            v, need, sure = acc[c], most, []
            for more_of in ({"beside": bn}, {"each": as_[span]}, None):
                edge = np.partition(v, len(v) - need)[len(v) - need]
                sure.append(c[v > edge])
                need -= len(sure[-1])
                c = c[v == edge]
                if len(c) == need or more_of is None:
                    break
                v = summed(lists, more[0], **more_of)[c]
                more[0][some] = 0
            c = np.concatenate([*sure, c[:need]])
        if len(c) and most:
            left.append((k, c))
            waiting += len(c) * int(a_count[k])
        elif len(c):
            ones = np.ones(len(lists), np.int64)
            for out, of in zip(more, ({"each": as_[span]}, {"each": ones}, {"beside": bn}, {"beside": bw}, {"beside": bs})):
                summed(lists, out, **of)
            left.append((k, c, acc[c], *(out[c] for out in more)))
            waiting += len(c)
            for out in more:
                out[some] = 0
        if waiting > chunk:
            yield from ready()
            left, waiting = [], 0
        acc[some] = 0
    if left:
        yield from ready()


def reach_similar(p: DataFrame, edges: DataFrame, floor: float = RETAIN, block: int | None = None, span: int | None = None) -> DataFrame:
    """reach with similar items as counts and coverage (to 4 places), summed as in reach_both_ways: a pair in one task, no pair shuffled.

    Each supplier carries the edges of its items. An item counts at the score of the best of itself and its
    neighbours that the partner holds; weights times scores are summed as whole hundred-millionths.
    """
    e4 = lambda c: F.coalesce((F.col(c) * 10_000).cast("bigint"), F.lit(0))
    near = F.struct(F.xxhash64("item").alias("item"), F.xxhash64("neighbour").alias("to"), F.round(F.col("score") * 10_000).cast("bigint").alias("score"))
    near = edges.groupBy("item").agg(F.collect_list(near).alias("near"))
    held = F.collect_list(F.when(F.col("named"), F.struct(F.xxhash64("item").alias("item"), e4("weight").alias("w"), F.col("lines").cast("bigint").alias("n"))))
    t = p.join(near, "item", "left").groupBy(*KEY).agg(F.sum("weight").cast("double").alias("tw"), held.alias("h"), F.flatten(F.collect_list(F.when(F.col("named"), F.col("near")))).alias("e"))
    scope = Window.partitionBy(*SCOPE)
    t = cut(t.withColumn("z", F.xxhash64(*SCOPE)).withColumn("r", F.row_number().over(scope.orderBy("supplier")) - 1).withColumn("size", F.count(F.lit(1)).over(scope)).where(F.size("h") > 0))
    span = span or SPAN
    per = F.lit(block) if block else F.greatest(F.lit(BLOCK), F.ceil(F.col("size") / BLOCKS))
    group = lambda c, by: F.floor(F.col(c) / by).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / by).cast("int")))
    m = t.select("z", "r", "size", *KEY, "tw", *[F.col(f"h.{c}").alias(c) for c in ("item", "w", "n")], *[F.col(f"e.{c}").alias(f"e_{c}") for c in ("item", "to", "score")])
    own = m.where("tw > 0").withColumn("own", F.lit(True)).withColumn("b", group("r", per)).withColumn("f", every(F.lit(span)))
    blank = {c: F.lit(None).cast(m.schema[c].dataType) for c in (*SCOPE, "tw", "w", "e_item", "e_to", "e_score")}
    far = m.withColumns(blank).withColumn("own", F.lit(False)).withColumn("b", every(per)).withColumn("f", group("r", F.lit(span)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _similar_strip(pa.Table.from_batches(batches), floor)

    kinds = ", ".join(f"{c} string" for c in (*KEY, "partner"))
    task = own.unionByName(far).drop("size").repartition(4 * parts(p.sparkSession), "z", "b", "f")
    return task.groupBy("z", "b", "f").applyInArrow(run, f"{kinds}, exact_items bigint, similar_items bigint, partner_lines bigint, coverage double")


def _rounded(x: np.ndarray) -> np.ndarray:
    """Positive numbers to 4 places as Spark's round has them: half up, of the number as it is written."""
    y = x * 1e4
    whole = np.floor(y)
    half = np.abs(y - whole - 0.5) < 1e-6
    out = (whole + (y - whole > 0.5)) / 1e4
    if half.any():
        some, back = np.unique(x[half], return_inverse=True)
        out[half] = np.array([float(Decimal(repr(float(v))).quantize(Decimal("0.0001"), ROUND_HALF_UP)) for v in some])[back]
    return out


def _similar_strip(rows: pa.Table, floor: float, chunk: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The pairs of one block of suppliers (``own``) with the partners given, at the floor; one supplier at a time, in arrays of all partners."""
    one = rows.filter(rows["own"])
    two = rows.filter(pc.invert(rows["own"])).sort_by("r")
    if not len(one) or not len(two):
        return
    them, size = two["r"].to_numpy(), len(two)
    b_item, b_at = _ragged(two["item"]), np.repeat(np.arange(size), pc.list_value_length(two["item"]).to_numpy())
    order = np.argsort(b_item, kind="stable")
    items, first = np.unique(b_item[order], return_index=True)
    ends = np.append(first[1:], len(order))
    at, bn = b_at[order], _ragged(two["n"])[order]

    def holders_of(hashes: np.ndarray) -> tuple[list[int], list[int]]:
        place = np.minimum(np.searchsorted(items, hashes), len(items) - 1)
        known = items[place] == hashes
        return np.where(known, first[place], 0).tolist(), np.where(known, ends[place], 0).tolist()

    a_count, e_count = (pc.list_value_length(one[c]).to_numpy() for c in ("item", "e_item"))
    a_end, e_end = np.cumsum(a_count).tolist(), np.cumsum(e_count).tolist()
    a_item, aw, e_item, e_to, e_score = (_ragged(one[c]) for c in ("item", "w", "e_item", "e_to", "e_score"))
    # Wider numbers where a supplier's weight in hundred-millionths would not fit whole ones.
    kind = np.int64 if np.abs(aw).sum(dtype=np.float64) < 9e14 else np.longdouble
    aw = aw.astype(kind)
    lo, hi = holders_of(a_item)
    e_lo, e_hi = holders_of(e_to)
    total = one["tw"].to_numpy()
    me = np.minimum(np.searchsorted(them, one["r"].to_numpy()), size - 1)
    me = np.where(them[me] == one["r"].to_numpy(), me, -1).tolist()
    acc, exact, alike, lines, best = np.zeros(size, kind), *(np.zeros(size, np.int64) for _ in range(3)), np.zeros(size, bool)
    facts = pa.table({c: one[c] for c in KEY}).combine_chunks()
    partner = two["supplier"].combine_chunks()
    left: list[tuple] = []
    waiting = 0

    def ready() -> Iterator[pa.RecordBatch]:
        j = np.concatenate([x[1] for x in left])
        t = facts.take(pa.array(np.repeat([x[0] for x in left], [len(x[1]) for x in left])))
        t = t.append_column("partner", partner.take(pa.array(j)))
        for name, v in zip(("exact_items", "similar_items", "partner_lines", "coverage"), zip(*(x[2:] for x in left))):
            t = t.append_column(name, pa.array(np.concatenate(v)))
        yield from t.combine_chunks().to_batches(max_chunksize=100_000)

    for k in range(len(one)):
        mine = range(a_end[k] - a_count[k], a_end[k])
        near: dict[int, list[tuple[int, int, int]]] = {}
        for e in range(e_end[k] - e_count[k], e_end[k]):
            if e_hi[e] > e_lo[e]:
                near.setdefault(int(e_item[e]), []).append((int(e_score[e]), e_lo[e], e_hi[e]))
        engaged = {(lo[q], hi[q]) for q in mine if hi[q] > lo[q]} | {(x, y) for of in near.values() for _, x, y in of}
        if not engaged:
            continue
        for x, y in engaged:
            lines[at[x:y]] += bn[x:y]
        for q in mine:
            of = near.get(int(a_item[q]))
            if not of:
                some = at[lo[q] : hi[q]]
                acc[some] += aw[q] * 10_000
                exact[some] += 1
                continue
            of = sorted([(10_000, lo[q], hi[q]), *of], key=lambda x: -x[0])
            for score, x, y in of:
                some = at[x:y]
                some = some[~best[some]]
                best[some] = True
                acc[some] += aw[q] * score
                (exact if score >= 10_000 else alike)[some] += 1
            for _, x, y in of:
                best[at[x:y]] = False
        if me[k] >= 0:
            acc[me[k]] = 0
        least = float(floor * total[k]) * 1e8 * (1 - 1e-12) - 1
        if sum(y - x for x, y in engaged) * 8 < size:
            some = np.concatenate([at[x:y] for x, y in engaged])
            c = np.unique(some[acc[some] > least])
        else:
            some, c = slice(None), np.flatnonzero(acc > least)
        cover = (acc[c] / 1e8).astype(np.float64) / total[k]
        c, cover = c[cover >= floor], cover[cover >= floor]
        if len(c):
            left.append((k, c, exact[c], alike[c], lines[c], _rounded(cover)))
            waiting += len(c)
        for v in (acc, exact, alike, lines):
            v[some] = 0
        if waiting > chunk:
            yield from ready()
            left, waiting = [], 0
    if left:
        yield from ready()


def sufficiency(lines: Column) -> Column:
    return F.least(F.lit(1.0), F.log1p(F.greatest(lines, F.lit(0)).cast("double")) / F.log1p(F.lit(float(SATURATION))))


def band(coverage: Column) -> Column:
    return F.when(coverage >= HIGH, "High").when(coverage >= MEDIUM, "Medium").otherwise("Low")


def overlaps(p: DataFrame, edges: DataFrame | None = None, most: int = RETAINED) -> DataFrame:
    """Reach with its reverse, confidence and bands, at the report floor and the ``most`` first partners of each supplier."""
    if edges is None:
        o = reach_both_ways(p, REPORT, most).withColumn("exact_weight", F.col("matched_weight")).withColumn("similar_items", F.lit(0).cast("bigint"))
    else:
        r = reach(p, edges)
        back = r.select(*SCOPE, F.col("supplier").alias("partner"), F.col("partner").alias("supplier"), F.col("coverage").alias("reverse_coverage"), F.col("addressable_spend").alias("partner_spend"))
        o = r.where(F.col("coverage") >= REPORT).join(back, [*KEY, "partner"], "left").fillna(0.0, ["reverse_coverage", "partner_spend"])
        w = Window.partitionBy(*KEY).orderBy(F.desc("coverage"), F.desc("partner_lines"), F.desc("addressable_spend"), "partner")
        o = o.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    named = F.col("named_weight").cast("double") / F.col("total_weight").cast("double")
    direct = F.when(F.col("matched_weight") > 0, F.col("exact_weight") / F.col("matched_weight")).otherwise(0.0)
    conf = (0.45 + 0.55 * sufficiency(F.col("total_lines"))) * (0.55 + 0.45 * named) * (0.80 + 0.20 * direct) * (0.55 + 0.45 * sufficiency(F.col("partner_lines")))
    o = o.withColumn("mutual", F.least("coverage", "reverse_coverage")).withColumn("confidence", T.format_percent(F.round(conf, 9))).withColumn("similarity_band", band(F.col("coverage")))
    poor = (F.col("total_spend") > 0) & (F.col("addressable_spend") < MIN_SPEND)
    demoted = F.when(poor | (F.col("total_lines") < MIN_LINES) | (F.col("partner_lines") < MIN_LINES) | (F.col("confidence") < 50), "Medium").otherwise("High")
    first = F.when(F.col("similarity_band") == "High", demoted).otherwise(F.col("similarity_band"))
    return o.withColumn("consolidation_band", F.when((first == "Medium") & (F.col("total_lines") < 2), "Low").otherwise(first))


def item_neighbours(items: DataFrame, floor: float = 0.75, top: int = 8) -> DataFrame:
    """(item) to its nearest other items (item, neighbour, score): blocked on shared words of four letters or more.

    A word in more items than the larger of 50 and a twentieth of all is a stop word, as in the reference: items that
    share no other word are no neighbours. At most ``top`` neighbours per item, best first, then by name.
    """
    it = items.where(F.col("item") != "").select("item").distinct()
    w = it.select("item", F.explode(F.array_distinct(F.filter(T.tokens("item"), lambda t: F.length(t) >= 4))).alias("w"))
    ceiling = it.agg(F.greatest(F.lit(50), F.floor(F.count(F.lit(1)) / 20)).alias("ceiling"))
    df = w.groupBy("w").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(ceiling)).where("df <= ceiling").select("w")
    kept = w.join(df, "w").groupBy("item").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    # What the measure needs of an item is made once an item, not once a pair.
    x = cut(kept.select("item", "ws", T.lookup_key("item").alias("key")).select("*", F.array_distinct(T.tokens("key")).alias("ts"), F.length("key").alias("len")))
    n = parts(items.sparkSession)
    left = x.select("*", F.explode("ws").alias("w"), salt("item", fan=n).alias("slot"))
    right = x.select(*[F.col(c).alias(f"o_{c}") for c in x.columns], F.explode("ws").alias("w")).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    longest, least = F.greatest("len", "o_len"), floor - 1e-4
    alike = lambda a, c: F.least(a, c) >= least * F.greatest(a, c)
    b = left.repartition(n, "w", "slot").join(right.repartition(n, "w", "slot"), ["w", "slot"])
    # Each pair once, at the first word it shares; the measure is symmetric.
    b = b.where((F.col("item") < F.col("o_item")) & (F.col("key") != "") & (F.col("o_key") != "") & (alike(F.col("len"), F.col("o_len")) | alike(F.size("ts"), F.size("o_ts"))))
    b = b.where(F.array_intersect("ws", "o_ws")[0] == F.col("w"))
    far = F.call_function("levenshtein", "key", "o_key", (F.ceil((1 - least) * longest) + 1).cast("int"))
    shared = F.size(F.array_intersect("ts", "o_ts"))
    same = F.coalesce(shared / F.nullif(F.size("ts") + F.size("o_ts") - shared, F.lit(0)), F.lit(0.0))
    score = F.when(F.col("key") == F.col("o_key"), 1.0).otherwise(F.greatest(same, F.when(far >= 0, 1 - far / longest).otherwise(0.0)))
    s = b.select("item", F.col("o_item").alias("neighbour"), F.round(score, 4).alias("score")).where(F.col("score") >= floor)
    s = s.select(F.inline(F.array(F.struct("item", "neighbour", "score"), F.struct(F.col("neighbour").alias("item"), F.col("item").alias("neighbour"), "score"))))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "neighbour"))).where(F.col("rank") <= top).drop("rank")


def supplier_pairs(o: DataFrame) -> DataFrame:
    """Each unordered pair once per scope, with both directions."""
    swap = F.col("supplier") > F.col("partner")
    n = o.select(
        *SCOPE, F.least("supplier", "partner").alias("supplier_a"), F.greatest("supplier", "partner").alias("supplier_b"),
        F.when(swap, F.col("reverse_coverage")).otherwise(F.col("coverage")).alias("coverage_ab"),
        F.when(swap, F.col("coverage")).otherwise(F.col("reverse_coverage")).alias("coverage_ba"), swap.alias("swap"),
    )
    w = Window.partitionBy(*SCOPE, "supplier_a", "supplier_b").orderBy("swap")
    return n.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k", "swap").withColumn("strongest", F.greatest("coverage_ab", "coverage_ba"))


def mode_per_key(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent non-blank value of each key, the first by alphabet on a tie."""
    c = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(*keys).agg(F.max_by(value, F.struct("n", F.lit(0))).alias("_any"), F.max("n").alias("_n")).drop("_any").join(c, keys).where("n = _n").groupBy(*keys).agg(F.min(value).alias(value), F.first("n").alias("n"))
