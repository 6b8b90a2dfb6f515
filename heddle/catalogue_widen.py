"""Widening queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import sql as Q
from .plans import widen as W
from .session import table

_F = W.INVOICE_FIELDS


def ladder_join(s, d):
    """Every transaction with level, strategy, count and the unanimous invoice fields."""
    w = W.widen_invoices(table(s, d, "max_transactions"), table(s, d, "invoice_lines"), "row_no", "invoice_line_no")
    return w.select("row_no", "inv_match_level", "inv_match_strategy", "inv_match_count", *[f"inv_{c}" for c in _F], "inv_document_lines", "inv_document_total", "inv_matched_total", "inv_article_names")


def match_levels(s, d):
    return ladder_join(s, d).groupBy("inv_match_level", "inv_match_strategy").agg(F.count(F.lit(1)).alias("rows"))


def document_summary(s, d):
    return W.document_summary(W.invoice_index(table(s, d, "invoice_lines"), "invoice_line_no"))


def key_population(s, d):
    return W.key_population(table(s, d, "max_transactions"), "row_no", table(s, d, "invoice_lines"), "invoice_line_no")


def po_ladder(s, d):
    """Orders as transactions against line items as two order systems."""
    o = table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    li = table(s, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("order_key"), F.col("l_linenumber").cast("string").alias("line_key"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_suppkey").cast("string").alias("vendor"))
    systems = {"beta": li.where("flag = 'R'"), "alpha": li.where("flag <> 'R'")}
    line = F.when(F.col("o_custkey") % 5 == 0, "").otherwise((F.col("o_custkey") % 7 + 1).cast("string"))
    hint = F.when(F.col("o_custkey") % 3 == 0, "x.beta").otherwise("")
    w = W.widen_orders(o, "o_orderkey", F.col("o_orderkey").cast("string"), line, hint, systems, ["flag", "status", "vendor"])
    return w.select("o_orderkey", "po_match_level", *[F.coalesce(F.col(f"po_{c}").cast("string"), F.lit("")).alias(f"po_{c}") for c in ("system", "strategy", "match_count", "lines_on_order", "flag", "status", "vendor")])


QUERIES = {f.__name__: f for f in (ladder_join, match_levels, document_summary, key_population, po_ladder)}

_KEY = "coalesce(nullif(invoice_key, ''), invoice_id)"
_U = lambda c: f"CASE WHEN {Q.blank(c)} THEN '' ELSE {Q.compact(c)} END"
_UN = lambda c: f"coalesce(CASE WHEN min(nullif({c}, '')) = max(nullif({c}, '')) THEN max(nullif({c}, '')) END, '') AS {c}"
_INDEX = f"""i0 AS (SELECT *, {Q.line('row_number')} AS r, {Q.amount('row_total_excl_vat')} AS total FROM invoice_lines WHERE NOT ({Q.blank(_KEY)} AND {Q.blank('xml_file_name')})),
i1 AS (SELECT *, row_number() OVER (PARTITION BY {Q.compact(_KEY)}, r, {Q.lookup("coalesce(article_name, '')")} ORDER BY invoice_line_no) AS k FROM i0),
i AS (SELECT DISTINCT * FROM (SELECT *, regexp_full_match(r, '\\d+') AS is_line, unnest([CASE WHEN NOT {Q.blank('invoice_key')} THEN {Q.compact('invoice_key')} END, CASE WHEN NOT {Q.blank('invoice_id')} THEN {Q.compact('invoice_id')} END, {Q.document('xml_file_name')}]) AS key FROM i1 WHERE k = 1) WHERE key <> ''),
ds AS (SELECT key, count(*) FILTER (is_line) AS doc_lines, coalesce(sum(round(coalesce(total, 0) * 100)::BIGINT) FILTER (is_line), 0) / 100 AS doc_total FROM i GROUP BY 1)"""
_TX = f"""t AS (SELECT row_no, {_U('invoice_number')} AS inv, {_U('document_number')} AS doc, coalesce(nullif({Q.document('documentidentifier')}, ''), {Q.document('invoicelink')}) AS did, {Q.line('document_line_number')} AS ln FROM max_transactions)"""
_BLOCK = lambda kind, line, where: f"""SELECT '{kind}' AS kind, key, line, count(*) AS match_count, {', '.join(_UN(c) for c in _F)}, sum(round(coalesce(total, 0) * 100)::BIGINT) AS cents, coalesce(array_to_string(list_sort(list_distinct(list(nullif(article_name, '')) FILTER (nullif(article_name, '') IS NOT NULL)))[1:12], '; '), '') AS names
  FROM (SELECT *, {line} AS line, max(is_line) OVER (PARTITION BY key, {line}) AS has FROM i WHERE {where}) WHERE is_line OR NOT has GROUP BY key, line"""  # noqa: E731
_LADDER = f"""WITH {_INDEX}, {_TX}, bl AS ({_BLOCK('line', 'r', "r <> ''")} UNION ALL {_BLOCK('header', "''", 'true')}),
tries AS ({' UNION ALL '.join(f"SELECT row_no, {n} AS prio, '{name}' AS strategy, '{kind}' AS kind, {k} AS key, {ln} AS line FROM t WHERE {k} <> '' AND {w}" for n, (name, kind, k, ln, w) in enumerate([(f'{a} + line', 'line', k, 'ln', "ln <> ''") for a, k in (('invoice-number', 'inv'), ('document-number', 'doc'), ('document-id', 'did'))] + [(a, 'header', k, "''", 'true') for a, k in (('invoice-number', 'inv'), ('document-number', 'doc'), ('document-id', 'did'))]))}),
hit AS (SELECT tries.*, row_number() OVER (PARTITION BY row_no ORDER BY prio) AS n FROM tries JOIN bl USING (kind, key, line)),
best AS (SELECT * FROM hit WHERE n = 1),
w AS (SELECT t.row_no, coalesce(best.kind, 'none') AS inv_match_level, coalesce(strategy, '') AS inv_match_strategy, coalesce(match_count, 0) AS inv_match_count, {', '.join(f"coalesce(bl.{c}, '') AS inv_{c}" for c in _F)}, coalesce(doc_lines, 0) AS inv_document_lines, doc_total AS inv_document_total, CASE WHEN cents <> 0 THEN cents / 100 END AS inv_matched_total, coalesce(names, '') AS inv_article_names
  FROM t LEFT JOIN best USING (row_no) LEFT JOIN bl ON bl.kind = best.kind AND bl.key = best.key AND bl.line = best.line LEFT JOIN ds ON ds.key = best.key)"""
_POB = lambda sysname, cond: f"""{sysname}l AS (SELECT l_orderkey AS key, l_linenumber::VARCHAR AS line, count(*) AS n, coalesce(CASE WHEN min(l_returnflag) = max(l_returnflag) THEN max(l_returnflag) END, '') AS flag, coalesce(CASE WHEN min(l_linestatus) = max(l_linestatus) THEN max(l_linestatus) END, '') AS status, coalesce(CASE WHEN min(l_suppkey) = max(l_suppkey) THEN max(l_suppkey)::VARCHAR END, '') AS vendor FROM lineitem WHERE {cond} GROUP BY 1, 2),
{sysname}h AS (SELECT l_orderkey AS key, count(*) AS n, coalesce(CASE WHEN min(l_returnflag) = max(l_returnflag) THEN max(l_returnflag) END, '') AS flag, coalesce(CASE WHEN min(l_linestatus) = max(l_linestatus) THEN max(l_linestatus) END, '') AS status, coalesce(CASE WHEN min(l_suppkey) = max(l_suppkey) THEN max(l_suppkey)::VARCHAR END, '') AS vendor FROM lineitem WHERE {cond} GROUP BY 1)"""  # noqa: E731
_POG = lambda sysname: f"""SELECT x.id, '{sysname}' AS system, CASE WHEN l.n IS NOT NULL THEN 'po-number + line' WHEN h.n = 1 THEN 'po-number, single-line order' ELSE 'po-number' END AS strategy, coalesce(l.n, h.n) AS match_count, h.n AS lines_on_order, coalesce(l.flag, h.flag) AS flag, coalesce(l.status, h.status) AS status, coalesce(l.vendor, h.vendor) AS vendor,
  CASE WHEN l.n IS NOT NULL THEN 0 WHEN h.n = 1 THEN 1 ELSE 2 END - CASE WHEN contains(x.hint, '{sysname}') THEN 1 ELSE 0 END AS rank FROM x JOIN {sysname}h h ON h.key = x.id LEFT JOIN {sysname}l l ON l.key = x.id AND l.line = x.line AND x.line <> ''"""  # noqa: E731

SQL = {
    "ladder_join": _LADDER + " SELECT * FROM w",
    "match_levels": _LADDER + " SELECT inv_match_level, inv_match_strategy, count(*) AS rows FROM w GROUP BY 1, 2",
    "document_summary": f"WITH {_INDEX} SELECT * FROM ds",
    "key_population": f"""WITH {_INDEX}, {_TX}, k AS (SELECT 'invoice_number' AS key_field, inv AS key FROM t UNION ALL SELECT 'document_number', doc FROM t UNION ALL SELECT 'document_id', did FROM t),
g AS (SELECT key_field, key, count(*) AS n FROM k WHERE key <> '' GROUP BY 1, 2), h AS (SELECT DISTINCT key, 1 AS hit FROM i)
SELECT key_field, sum(n)::BIGINT AS populated, count(*) AS distinct_keys, count(hit) AS available, coalesce(sum(n) FILTER (hit = 1), 0)::BIGINT AS rows_hit FROM g LEFT JOIN h USING (key) GROUP BY 1""",
    "po_ladder": f"""WITH x AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 5 = 0 THEN '' ELSE (o_custkey % 7 + 1)::VARCHAR END AS line, CASE WHEN o_custkey % 3 = 0 THEN 'x.beta' ELSE '' END AS hint FROM orders),
{_POB('alpha', "l_returnflag <> 'R'")}, {_POB('beta', "l_returnflag = 'R'")}, g AS ({_POG('alpha')} UNION ALL {_POG('beta')}), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank, system) AS k FROM g)
SELECT x.id AS o_orderkey, CASE WHEN match_count IS NULL THEN 'none' WHEN match_count = 1 THEN 'line' ELSE 'header' END AS po_match_level, coalesce(system, '') AS po_system, coalesce(strategy, '') AS po_strategy, coalesce(match_count::VARCHAR, '') AS po_match_count, coalesce(lines_on_order::VARCHAR, '') AS po_lines_on_order, coalesce(flag, '') AS po_flag, coalesce(status, '') AS po_status, coalesce(vendor, '') AS po_vendor
FROM x LEFT JOIN b ON b.id = x.id AND b.k = 1""",
}
