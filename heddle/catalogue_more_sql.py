"""SQL of queries whose text is long: the independent side of extraction, TF-IDF, supplier keys and as-of attachment."""

from __future__ import annotations

from .functions import extract as X
from .functions import sql as Q
from .functions import text as T
from .plans import enrich as E
from .vocabulary import default

_E = "enriched_purchase_description"
EMAIL = "\\b[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_-]+\\.[\\p{L}\\p{N}_.-]+\\b"


def _scrub(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{EMAIL}', ' ', 'g'), '(?i)\\bhttps?://\\S+|\\bwww\\.\\S+', ' ', 'g')"


def _sorted(x: str, most: int) -> str:
    return f"array_to_string(list_sort(list_distinct({x}))[1:{most}], '; ')"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[./-]+|[./-]+$', '', 'g')"


_doc, _desc, _src = _scrub("text"), _scrub("description"), _scrub("source_text")
_valid = lambda m, d: f"{m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31"
_int = lambda x, sep, i: f"split_part({x}, '{sep}', {i})::INT"
_iso = "list_transform(list_filter(regexp_extract_all({0}, '\\b\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}\\b'), lambda x: " + _valid(_int("x", "-", 2), _int("x", "-", 3)) + "), lambda x: printf('%04d-%02d-%02d', " + ", ".join(_int("x", "-", i) for i in (1, 2, 3)) + "))"
_eu = "list_transform(list_filter(regexp_extract_all({0}, '\\b\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}\\b'), lambda x: " + _valid(_int("x", ".", 2), _int("x", ".", 1)) + "), lambda x: printf('%04d-%02d-%02d', " + ", ".join(_int("x", ".", i) for i in (3, 2, 1)) + "))"
_short = "list_transform(list_filter(regexp_extract_all({0}, '\\b(\\d{{1,2}}\\.\\d{{1,2}}\\.)(?:\\D|$)', 1), lambda x: " + _valid(_int("x", ".", 2), _int("x", ".", 1)) + "), lambda x: printf('--%02d-%02d', " + ", ".join(_int("x", ".", i) for i in (2, 1)) + "))"
_units = "|".join(sorted(X.UNIT_CANON, key=len, reverse=True))
_qty = f"regexp_extract({_src}, '(?i)(?:^|[^\\p{{L}}\\p{{Nd}}_])(\\d+(?:[.,]\\d+)?)\\s?({_units})(?:$|[^\\p{{L}}\\p{{Nd}}_])', "
_canon = f"(CASE lower({_qty}2)) {' '.join(f'''WHEN '{k}' THEN '{v}' ''' for k, v in X.UNIT_CANON.items())} ELSE lower({_qty}2)) END)"
_amt = Q.amount(f"{_qty}1)")
_fmt = f"(CASE WHEN {_amt} IS NULL THEN '' WHEN abs({_amt} - round({_amt})) < 1e-9 THEN printf('%.0f', round({_amt})) ELSE regexp_replace(printf('%.4f', {_amt}), '\\.?0+$', '') END)"
_measured = f"regexp_replace(regexp_replace(regexp_replace({_desc}, '{X.MEASURE}', ' ', 'g'), '{X.DIMENSION}', ' ', 'g'), '(?i)\\b(?:dn|pn|iso|din|en|sfs)\\s?\\d+\\b', ' ', 'g')"
_ordinal = "(?i)^\\d{1,2}(?:st|nd|rd|th)(?:-\\d{1,2}(?:st|nd|rd|th))+$"



def _supplier_key(n: str) -> str:
    plain = Q.collapse(f"regexp_replace({Q.lookup(n)}, '[^\\p{{L}}\\p{{N}} ]', ' ', 'g')")
    t = plain
    for p in T.LEGAL_PHRASES:
        t = f"regexp_replace({t}, '(^|[^\\p{{L}}\\p{{N}}]){p}($|[^\\p{{L}}\\p{{N}}])', '\\1 \\2', 'g')"
    return f"coalesce(nullif(array_to_string(list_filter({Q.tokens(t)}, lambda w: w NOT IN ({_quoted(T.LEGAL_FORMS)})), ' '), ''), {plain})"


def _jaccard(a: str, b: str) -> str:
    return f"coalesce(len(list_intersect(list_distinct({a}), list_distinct({b}))) / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0.0)"


def _pick(c: str, m: dict, d: float) -> str:
    return f"(CASE {c} {' '.join(f'''WHEN '{k}' THEN {v}''' for k, v in m.items())} ELSE {d} END)::DOUBLE"


_inf = f"list_filter({Q.tokens(Q.lookup(f'''coalesce({_E}, '')'''))}, lambda t: length(t) > 2 AND t NOT IN ({_quoted(default().generic)}))"
_W = E.WEIGHTS

SQL: dict[str, str] = {
    "extract_emails": f"SELECT doc_id, {_sorted(f'''list_transform(regexp_extract_all(text, '{EMAIL}'), lambda e: lower(e))''', 1000000)} AS value FROM documents",
    "extract_domains": f"SELECT doc_id, {_sorted(f'''list_transform(regexp_extract_all(text, '{EMAIL}'), lambda e: regexp_extract(lower(e), '[^@]*$'))''', 1000000)} AS value FROM documents",
    "extract_dates": f"SELECT doc_id, CASE WHEN t IS NOT NULL THEN {_sorted('list_concat(list_concat(' + _iso.format('t') + ', ' + _eu.format('t') + '), ' + _short.format('t') + ')', 6)} END AS value FROM (SELECT doc_id, {_doc} AS t FROM documents)",
    "extract_quantity": f"SELECT result_id, CASE WHEN source_text IS NULL THEN '' ELSE {_fmt} || ' ' || {_canon} END AS value FROM translation_results",
    "extract_dimensions": f"SELECT item_row, {_sorted(f'''list_transform(regexp_extract_all({_desc}, '{X.DIMENSION}'), lambda x: replace(x, ' ', ''))''', 5)} AS value FROM reference_items",
    "extract_model_codes": f"SELECT item_row, {_sorted(f'''list_filter(list_transform(list_filter(regexp_extract_all({_measured}, '[A-Za-z0-9][A-Za-z0-9./-]{{3,}}{chr(92)}b'), lambda x: regexp_matches(x, '{chr(92)}d') AND regexp_matches(x, '[A-Za-z]')), lambda x: {_strip('x')}), lambda x: length(x) >= 4 AND NOT regexp_matches(x, '{_ordinal}') AND regexp_matches(x, '{chr(92)}d') AND regexp_matches(x, '[A-Za-z]'))''', 6)} AS value FROM reference_items",
    "keywords": f"SELECT result_id, {_sorted(f'''list_filter({Q.tokens(Q.lookup('english_text'))}, lambda t: length(t) > 2 AND t NOT IN ({_quoted(default().stop)}) AND NOT regexp_full_match(t, '{chr(92)}d+'))''', 12)} AS value FROM translation_results",
    "supplier_key": f"SELECT supplier_row, {_supplier_key('display_name')} AS value FROM supplier_names",
    "vendor_alias_chain": f"SELECT supplier_row AS node, c AS component FROM (SELECT supplier_row, min(supplier_row) OVER (PARTITION BY identifier) AS c, count(*) OVER (PARTITION BY identifier) AS n FROM supplier_names WHERE NOT {Q.blank('identifier')}) WHERE n > 1",
    "supplier_blocks_dup": f"""WITH k AS (SELECT DISTINCT {_supplier_key("coalesce(display_name, '')")} AS k FROM supplier_names), c AS (SELECT k, coalesce(nullif(array_to_string(list_filter({Q.tokens('k')}, lambda w: w NOT IN ({_quoted(T.GEOGRAPHIC)})), ' '), ''), k) AS core FROM k WHERE k <> ''),
p AS (SELECT a.k, b.k AS other, CASE WHEN a.core = b.core THEN 1.0 ELSE greatest({_jaccard(Q.tokens('a.core'), Q.tokens('b.core'))}, 1 - levenshtein(a.core, b.core)::DOUBLE / greatest(length(a.core), length(b.core), 1)) END AS s FROM c a JOIN c b ON left(a.core, 4) = left(b.core, 4) AND a.k < b.k)
SELECT k, other, round(s, 4)::DOUBLE AS score FROM p WHERE round(s, 4) >= 0.92""",
    "enrichment_confidence": f"""WITH x AS (SELECT line_id, {_E} AS d, CASE WHEN coalesce({_E}, '') = '' THEN 'none' ELSE 'description' END AS basis, coalesce(translation_coverage, 0.0) AS cov, coalesce(evidence_field_count, 0) AS f, len(list_filter(regexp_split_to_array(coalesce(matched_source_systems, ''), '[;,]\\s*'), lambda x: x <> '')) + 1 AS y, match_tier,
round_even(least(1.0, 0.7 * len({_inf}) / 4.0 + 0.3 * coalesce(len(list_distinct({_inf}))::DOUBLE / nullif(len({_inf}), 0), 0.0)), 3) AS spec FROM agent1_unified_lines),
r AS (SELECT *, {_pick('basis', E.BASIS, 0.0)} * {_W['basis']}::DOUBLE + round_even(least(1.0, cov), 3) * {_W['translation']}::DOUBLE + round_even(least(1.0, f / 4.0), 3) * {_W['evidence']}::DOUBLE + round_even(least(1.0, greatest(0, y - 1) / 2.0), 3) * {_W['corroboration']}::DOUBLE + spec * {_W['specificity']}::DOUBLE + {_pick('match_tier', E.TIERS, 0.5)} * {_W['match']}::DOUBLE AS raw FROM x),
z AS (SELECT line_id, CASE WHEN coalesce(d, '') = '' THEN 0 ELSE round_even(round(least(1.0, greatest(0.0, raw)) * 100, 9), 0)::INT END AS score FROM r)
SELECT line_id, score, CASE WHEN score >= 75 THEN 'High' WHEN score >= 50 THEN 'Medium' ELSE 'Low' END AS band FROM z""",
    "char_tfidf_topk": f"""WITH rq AS (SELECT {Q.lookup(_E)} AS k, line_id FROM agent1_unified_lines WHERE {_E} <> '' AND line_id % 20 = 0), q AS (SELECT k AS text, min(line_id) AS id FROM rq GROUP BY 1), i AS (SELECT item_row AS id, coalesce(nullif(english_description, ''), description) AS text FROM reference_items),
g AS (SELECT s, id, substr(w, o, n) AS term FROM (SELECT s, id, ' ' || unnest({Q.tokens(Q.lookup('text'))}) || ' ' AS w FROM (SELECT 'q' AS s, id, text FROM q UNION ALL SELECT 'i', id, text FROM i)), (SELECT unnest([3, 4, 5]) AS n), LATERAL (SELECT unnest(range(1, length(w) - n + 2)) AS o)),
tf AS (SELECT s, id, term, 1 + ln(count(*)) AS tf FROM g GROUP BY 1, 2, 3), nn AS (SELECT count(DISTINCT id) AS n FROM i), sp AS (SELECT term, ln((1 + any_value(n)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf, nn WHERE s = 'i' GROUP BY 1),
w AS (SELECT s, id, term, tf * idf AS w FROM tf JOIN sp USING (term)), u AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY s, id)) AS u FROM w),
d AS (SELECT a.id AS q, b.id AS i, round(sum(a.u * b.u), 6) AS score FROM u a JOIN u b ON a.term = b.term AND a.s = 'q' AND b.s = 'i' GROUP BY 1, 2 HAVING round(sum(a.u * b.u), 6) > 0)
SELECT rq.line_id AS q, i, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, i) AS rank FROM d) z JOIN q ON q.id = z.q JOIN rq ON rq.k = q.text WHERE rank <= 5""",
    "word_tfidf_sim": f"""WITH l AS (SELECT DISTINCT {Q.lookup('ai_purchase_group_l5')} AS label FROM agent2_purchase_groups), t AS (SELECT label, {Q.tokens('label')} AS w FROM l WHERE label <> ''),
g AS (SELECT label, unnest(w) AS term FROM t UNION ALL SELECT label, w[i] || ' ' || w[i + 1] FROM (SELECT label, w, unnest(range(1, len(w))) AS i FROM t)),
tf AS (SELECT label, term, 1 + ln(count(*)) AS tf FROM g GROUP BY 1, 2), sp AS (SELECT term, ln((1 + (SELECT count(*) FROM t)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf GROUP BY 1), u AS (SELECT label, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY label)) AS u FROM tf JOIN sp USING (term)),
d AS (SELECT a.label, b.label AS other, round(sum(a.u * b.u), 6) AS score FROM u a JOIN u b USING (term) WHERE a.label <> b.label GROUP BY 1, 2)
SELECT label, other, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, other) AS rank FROM d) WHERE rank <= 5""",
    "events_asof": "SELECT event_id, user_id, coalesce(v, -1) AS last_id FROM (SELECT *, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS v FROM events WHERE event_type IN ('purchase', 'view')) WHERE event_type = 'purchase'",
}
