"""Consolidation queries over the purchase tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .plans import consolidate as C


def _p(s: SparkSession, d: str) -> DataFrame:
    return C.portfolio(C.scope_unpivot(C.purchase_lines(s, d), C.LEVELS))


def scope_portfolio(s, d):
    return _p(s, d).select(*C.KEY, "item", F.col("spend").cast("double").alias("spend"), "lines", F.col("weight").cast("double").alias("weight"))


def scope_weight_basis(s, d):
    return C.weight_basis(C.scope_unpivot(C.purchase_lines(s, d), C.LEVELS))


def named_share(s, d):
    t = C.totals(_p(s, d)).where("total_weight > 0")
    return t.select(*C.KEY, F.round(F.col("named_weight").cast("double") / F.col("total_weight").cast("double"), 6).alias("named_share"))


def top_items(s, d):
    p = _p(s, d).where("named")
    w = Window.partitionBy(*C.KEY).orderBy(F.desc("weight"), "item")
    return p.withColumn("rank", F.row_number().over(w)).where("rank <= 8").select(*C.KEY, "item", "rank", F.col("weight").cast("double").alias("weight"))


def crowded_item_guard(s, d):
    return C.holders(_p(s, d)).withColumn("crowded", F.col("holders") > C.FANOUT)


def scope_guard(s, d):
    return C.scope_sizes(_p(s, d)).withColumn("compared", F.col("suppliers").between(2, C.SCOPE_CAP))


def portfolio_overlap(s, d):
    r = C.reach_both_ways(_p(s, d))
    return r.select(*C.KEY, "partner", F.round("coverage", 6).alias("coverage"), F.round("addressable_spend", 2).alias("addressable_spend"), "exact_items", "partner_lines")


def overlap_reverse(s, d):
    return C.overlaps(_p(s, d)).select(*C.KEY, "partner", F.round("coverage", 6).alias("coverage"), F.round("reverse_coverage", 6).alias("reverse_coverage"), F.round("mutual", 6).alias("mutual"))


def overlap_bands(s, d):
    return C.overlaps(_p(s, d)).select(*C.KEY, "partner", "rank", "confidence", "similarity_band", "consolidation_band")


def best_partner(s, d):
    """The headline: best partner of each supplier in each scope, and the next five as text."""
    o = C.overlaps(_p(s, d), most=1 + C.SHOWN)
    alt = F.concat_ws("; ", F.transform(F.array_sort(F.filter(F.collect_list(F.struct("rank", "partner")), lambda x: x["rank"] > 1)), lambda x: x["partner"]))
    one = lambda c: F.max(F.when(F.col("rank") == 1, F.col(c)))
    return o.groupBy(*C.KEY).agg(one("partner").alias("partner"), F.round(one("coverage"), 6).alias("coverage"), one("confidence").alias("confidence"), one("consolidation_band").alias("band"), alt.alias("alternatives"))


def supplier_pairs(s, d):
    return C.supplier_pairs(C.overlaps(_p(s, d))).select(*C.SCOPE, "supplier_a", "supplier_b", F.round("coverage_ab", 6).alias("coverage_ab"), F.round("coverage_ba", 6).alias("coverage_ba"), F.round("strongest", 6).alias("strongest"))


def scope_rollup(s, d):
    """Spend and lines by category levels with subtotals, as grouping sets."""
    x = C.purchase_lines(s, d)
    return x.rollup("category_l1", "category_l2").agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("lines"), F.sum("spend").cast("double").alias("spend"))


def supplier_rollup(s, d):
    x = C.purchase_lines(s, d)
    m = C.mode_per_key(x, ["supplier"], "supplier_name").select("supplier", F.col("supplier_name").alias("display_name"))
    return x.groupBy("supplier").agg(F.count(F.lit(1)).alias("lines"), F.sum("spend").cast("double").alias("spend"), F.countDistinct("item").alias("items"), F.countDistinct("country").alias("countries")).join(m, "supplier", "left")


def supplier_display_mode(s, d):
    return C.mode_per_key(C.purchase_lines(s, d), ["supplier"], "country").select("supplier", "country", "n")


def best_overlap_similar(s, d):
    """Overlap that counts similar items as well as equal ones."""
    p = _p(s, d)
    e = C.item_neighbours(p.where("named").select("item"))
    return C.reach_similar(p, e)


QUERIES = {
    f.__name__: f
    for f in (scope_portfolio, scope_weight_basis, named_share, top_items, crowded_item_guard, scope_guard, portfolio_overlap, overlap_reverse, overlap_bands, best_partner, supplier_pairs, scope_rollup, supplier_rollup, supplier_display_mode, best_overlap_similar)
}

_LINES = """lines AS (SELECT g.row_id, g.supplier_id AS supplier, trim(lower(g.ai_purchase_group_l5)) AS label, g.spend_eur::DECIMAL(18,4) AS spend, a.supplier_name, a.country,
  a.category_l1, a.category_l2, a.category_l3, a.category_l4, a.business_area, a.division FROM agent2_purchase_groups g JOIN agent1_unified_lines a ON g.row_id = a.row_id),
l AS (SELECT *, coalesce(label NOT IN ('', 'other'), false) AS named, CASE WHEN coalesce(label NOT IN ('', 'other'), false) THEN label ELSE '' END AS item FROM lines)"""
_SCOPED = _LINES + ", s AS (" + " UNION ALL ".join(f"SELECT supplier, item, named, spend, '{x}' AS scope_level, trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g')) AS scope_value FROM l" for x in C.LEVELS) + "), sc AS (SELECT * FROM s WHERE scope_value <> '' AND supplier IS NOT NULL AND supplier <> '')"
_BASIS = _SCOPED + ", b AS (SELECT scope_level, scope_value, count(*) AS lines, count(*) FILTER (spend > 0) AS with_spend, CASE WHEN 2 * count(*) FILTER (spend > 0) >= count(*) THEN 'spend' ELSE 'lines' END AS basis FROM sc GROUP BY 1, 2)"
_PORT = _BASIS + """, f AS (SELECT scope_level, scope_value, supplier, item, named, sum(spend)::DECIMAL(28,4) AS spend, count(*) AS lines FROM sc GROUP BY ALL),
w0 AS (SELECT f.*, CASE WHEN basis = 'spend' THEN f.spend ELSE f.lines::DECIMAL(28,4) END AS w FROM f JOIN b USING (scope_level, scope_value)),
w1 AS (SELECT *, sum(w) OVER (PARTITION BY scope_level, scope_value, supplier) AS t FROM w0),
p AS (SELECT scope_level, scope_value, supplier, item, named, spend, lines, CASE WHEN coalesce(t, 0) <= 0 THEN lines::DECIMAL(28,4) ELSE coalesce(w, 0) END AS weight FROM w1),
tot AS (SELECT scope_level, scope_value, supplier, sum(weight) AS total_weight, sum(spend) AS total_spend, sum(lines) AS total_lines, coalesce(sum(weight) FILTER (named), 0) AS named_weight FROM p GROUP BY ALL)"""
_REACH = _PORT + f""", sz AS (SELECT scope_level, scope_value, count(DISTINCT supplier) AS suppliers FROM p GROUP BY ALL),
h AS (SELECT scope_level, scope_value, item, count(*) AS holders FROM p WHERE named GROUP BY ALL),
m AS (SELECT p.* FROM p JOIN sz USING (scope_level, scope_value) JOIN h USING (scope_level, scope_value, item) WHERE named AND suppliers BETWEEN 2 AND {C.SCOPE_CAP} AND holders <= {C.FANOUT}),
r0 AS (SELECT x.scope_level, x.scope_value, x.supplier, y.supplier AS partner, sum(x.weight)::DOUBLE AS matched_weight, sum(x.spend)::DOUBLE AS addressable_spend, count(*) AS exact_items, sum(y.lines)::BIGINT AS partner_lines
  FROM m x JOIN m y ON x.scope_level = y.scope_level AND x.scope_value = y.scope_value AND x.item = y.item AND x.supplier <> y.supplier GROUP BY ALL),
r AS (SELECT r0.*, total_weight, total_spend, total_lines, named_weight, matched_weight / total_weight::DOUBLE AS coverage FROM r0 JOIN tot USING (scope_level, scope_value, supplier) WHERE total_weight > 0 AND matched_weight / total_weight::DOUBLE >= {C.RETAIN})"""
_SUF = f"least(1.0, ln(1 + {{0}}::DOUBLE) / ln(1 + {C.SATURATION}::DOUBLE))"
_OVER = _REACH + f""", o0 AS (SELECT r.*, coalesce(q.coverage, 0) AS reverse_coverage, row_number() OVER (PARTITION BY r.scope_level, r.scope_value, r.supplier ORDER BY r.coverage DESC, r.partner_lines DESC, r.addressable_spend DESC, r.partner) AS rank
  FROM r LEFT JOIN r q ON r.scope_level = q.scope_level AND r.scope_value = q.scope_value AND r.supplier = q.partner AND r.partner = q.supplier WHERE r.coverage >= {C.REPORT}),
o1 AS (SELECT *, least(coverage, reverse_coverage) AS mutual, round_even(least(1.0, greatest(0.0, round((0.45 + 0.55 * {_SUF.format('total_lines')}) * (0.55 + 0.45 * named_weight::DOUBLE / total_weight::DOUBLE) * 1.0 * (0.55 + 0.45 * {_SUF.format('partner_lines')}), 9))) * 100, 0)::INT AS confidence,
  CASE WHEN coverage >= {C.HIGH} THEN 'High' WHEN coverage >= {C.MEDIUM} THEN 'Medium' ELSE 'Low' END AS similarity_band FROM o0 WHERE rank <= {C.RETAINED}),
o2 AS (SELECT *, CASE WHEN similarity_band = 'High' THEN CASE WHEN (coalesce(total_spend > 0, false) AND addressable_spend < {C.MIN_SPEND}) OR total_lines < {C.MIN_LINES} OR partner_lines < {C.MIN_LINES} OR confidence < 50 THEN 'Medium' ELSE 'High' END ELSE similarity_band END AS first FROM o1),
o AS (SELECT *, CASE WHEN first = 'Medium' AND total_lines < 2 THEN 'Low' ELSE first END AS consolidation_band FROM o2)"""
_K = "scope_level, scope_value, supplier"

SQL = {
    "scope_portfolio": f"WITH {_PORT} SELECT {_K}, item, spend::DOUBLE AS spend, lines, weight::DOUBLE AS weight FROM p",
    "scope_weight_basis": f"WITH {_BASIS} SELECT * FROM b",
    "named_share": f"WITH {_PORT} SELECT {_K}, round(named_weight::DOUBLE / total_weight::DOUBLE, 6) AS named_share FROM tot WHERE total_weight > 0",
    "top_items": f"WITH {_PORT} SELECT {_K}, item, rank::INT AS rank, weight::DOUBLE AS weight FROM (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY weight DESC, item) AS rank FROM p WHERE named) WHERE rank <= 8",
    "crowded_item_guard": f"WITH {_PORT} SELECT scope_level, scope_value, item, count(*) AS holders, count(*) > {C.FANOUT} AS crowded FROM p WHERE named GROUP BY 1, 2, 3",
    "scope_guard": f"WITH {_PORT} SELECT scope_level, scope_value, count(DISTINCT supplier) AS suppliers, count(DISTINCT supplier) BETWEEN 2 AND {C.SCOPE_CAP} AS compared FROM p GROUP BY 1, 2",
    "portfolio_overlap": f"WITH {_REACH} SELECT {_K}, partner, round(coverage, 6) AS coverage, round(addressable_spend, 2) AS addressable_spend, exact_items, partner_lines FROM r",
    "overlap_reverse": f"WITH {_OVER} SELECT {_K}, partner, round(coverage, 6) AS coverage, round(reverse_coverage, 6) AS reverse_coverage, round(mutual, 6) AS mutual FROM o",
    "overlap_bands": f"WITH {_OVER} SELECT {_K}, partner, rank::INT AS rank, confidence, similarity_band, consolidation_band FROM o",
    "best_partner": f"WITH {_OVER} SELECT {_K}, max(partner) FILTER (rank = 1) AS partner, round(max(coverage) FILTER (rank = 1), 6) AS coverage, max(confidence) FILTER (rank = 1) AS confidence, max(consolidation_band) FILTER (rank = 1) AS band, coalesce(string_agg(partner, '; ' ORDER BY rank) FILTER (rank > 1), '') AS alternatives FROM o WHERE rank <= 6 GROUP BY {_K}",
    "supplier_pairs": f"""WITH {_OVER}, n AS (SELECT scope_level, scope_value, least(supplier, partner) AS supplier_a, greatest(supplier, partner) AS supplier_b, CASE WHEN supplier > partner THEN reverse_coverage ELSE coverage END AS ab, CASE WHEN supplier > partner THEN coverage ELSE reverse_coverage END AS ba, supplier > partner AS swap FROM o),
k AS (SELECT *, row_number() OVER (PARTITION BY scope_level, scope_value, supplier_a, supplier_b ORDER BY swap) AS k FROM n)
SELECT scope_level, scope_value, supplier_a, supplier_b, round(ab, 6) AS coverage_ab, round(ba, 6) AS coverage_ba, round(greatest(ab, ba), 6) AS strongest FROM k WHERE k = 1""",
    "scope_rollup": f"WITH {_LINES} SELECT category_l1, category_l2, grouping(category_l1, category_l2)::INT AS level, count(*) AS lines, sum(spend)::DOUBLE AS spend FROM l GROUP BY ROLLUP (category_l1, category_l2)",
    "supplier_rollup": f"""WITH {_LINES}, c AS (SELECT supplier, supplier_name, count(*) AS n FROM l WHERE supplier_name <> '' GROUP BY 1, 2), mx AS (SELECT supplier, supplier_name, row_number() OVER (PARTITION BY supplier ORDER BY n DESC, supplier_name) AS k FROM c)
SELECT t.*, mx.supplier_name AS display_name FROM (SELECT supplier, count(*) AS lines, sum(spend)::DOUBLE AS spend, count(DISTINCT item) AS items, count(DISTINCT country) AS countries FROM l WHERE supplier IS NOT NULL GROUP BY 1
UNION ALL SELECT supplier, count(*), sum(spend)::DOUBLE, count(DISTINCT item), count(DISTINCT country) FROM l WHERE supplier IS NULL GROUP BY 1) t LEFT JOIN mx ON mx.supplier = t.supplier AND mx.k = 1""",
    "supplier_display_mode": f"WITH {_LINES}, c AS (SELECT supplier, country, count(*) AS n FROM l WHERE country <> '' GROUP BY 1, 2) SELECT supplier, country, n FROM (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY n DESC, country) AS k FROM c) WHERE k = 1 AND supplier IS NOT NULL",
}
