"""Groups on lines, registries, residues, suppliers of lines, ordered outputs and text reading, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import catalogue_analytics as A
from . import catalogue_consolidate as CC
from . import catalogue_more_sql as S
from .functions import extract as X
from .functions import reading as R
from .functions import sql as Q
from .functions import text as T
from .plans import attach as G
from .plans import consolidate as C
from .plans import group as GR
from .plans import match as M
from .plans import ordered as O
from .session import cut, table
from .vocabulary import default

QUERIES: dict = {}
SQL: dict[str, str] = {}
_E = "enriched_purchase_description"
_quoted = S._quoted


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- groups, registry, residues -------------------------------------------------------------------

_SIGN = A._SIGN.replace("text", f"coalesce(a.{_E}, '')")
_BUCKET = f"coalesce(nullif({Q.collapse('a.category_l2')}, ''), 'Uncategorised')"
_REG = f"""gl AS (SELECT {_BUCKET} AS bucket, {_SIGN} AS signature, g.ai_purchase_group_l5 AS label, g.agent2_run_id AS run, g.group_row AS ord, g.ai_purchase_group_cohesion AS cohesion, g.ai_purchase_group_confidence AS upstream FROM agent2_purchase_groups g JOIN agent1_unified_lines a ON a.row_id = g.row_id),
gn AS (SELECT * FROM gl WHERE trim(label) <> '' AND signature <> ''), runs AS (SELECT min(run) AS first FROM gl),
reg AS (SELECT bucket, signature, arg_min(label, (run, ord)) AS label, min(run) AS first_seen_run, min(run) > (SELECT first FROM runs) AS is_new FROM gn GROUP BY 1, 2),
rid AS (SELECT *, 'G-' || upper(left({Q.hash16('bucket', Q.lookup('label'))}, 10)) AS group_id FROM reg)"""


def _grouped(s, d):
    """The grouped lines with bucket and signature of their description."""
    a = table(s, d, "agent1_unified_lines").select("row_id", T.category_path("category_l2").alias("bucket"), T.signature(F.coalesce(_E, F.lit(""))).alias("signature"))
    g = table(s, d, "agent2_purchase_groups").select("row_id", F.col("ai_purchase_group_l5").alias("label"), F.col("agent2_run_id").alias("run"), F.col("group_row").alias("ord"), F.col("ai_purchase_group_cohesion").alias("cohesion"), F.col("ai_purchase_group_confidence").alias("upstream"))
    return g.join(a, "row_id")


def _registries(s, d):
    g = cut(_grouped(s, d))
    first = g.agg(F.min("run").alias("first"))  # one row
    old = g.join(F.broadcast(first), F.col("run") == F.col("first"), "left_semi")
    return g, G.merge_registry(G.registry(old), G.registry(g.join(F.broadcast(first), F.col("run") == F.col("first"), "left_anti")))


@query(f"WITH {_REG} SELECT * FROM rid")
def registry_merge(s, d):
    """The registry of the first run with what the second adds; what is known keeps its first label and id."""
    return _registries(s, d)[1]


_FIRST = f"WITH {_REG}, {A._ENTRIES}, first_run AS (SELECT DISTINCT bucket, signature FROM gn WHERE run = (SELECT first FROM runs)) SELECT bucket, signature FROM e"


@query(_FIRST + " SEMI JOIN first_run USING (bucket, signature)")
def registry_semi(s, d):
    """The wordings of the lines that the registry of the first run knows."""
    return GR.known(A._entries(s, d), _registries(s, d)[1].where("NOT is_new")).select("bucket", "signature")


@query(_FIRST + " ANTI JOIN first_run USING (bucket, signature)")
def registry_anti(s, d):
    """The wordings of the lines that the registry of the first run doesn't know."""
    return GR.unknown(A._entries(s, d), _registries(s, d)[1].where("NOT is_new")).select("bucket", "signature")


@query(f"""WITH {_REG}, q AS (SELECT bucket, signature, count(*) AS members, round(avg(cohesion), 6) AS cohesion FROM gn GROUP BY 1, 2),
x AS (SELECT a.line_id, rid.label, rid.group_id, q.cohesion, rid.label IS NULL OR coalesce(q.cohesion, 0) < {GR.MIN_COHESION} AS is_other FROM agent1_unified_lines a LEFT JOIN rid ON rid.bucket = {_BUCKET} AND rid.signature = {_SIGN} LEFT JOIN q ON q.bucket = rid.bucket AND q.signature = rid.signature WHERE a.row_type = 'LINE')
SELECT line_id, CASE WHEN is_other THEN 'Other' ELSE label END AS label, CASE WHEN is_other THEN '' ELSE group_id END AS group_id, is_other FROM x""")
def line_groups(s, d):
    """Every line with the group its wording is registered under, Other where there is none or it doesn't hold together."""
    return _line_groups(s, d).select("line_id", "label", "group_id", "is_other")


def _line_groups(s, d):
    g, reg = _registries(s, d)
    q = g.where((F.trim("label") != "") & (F.col("signature") != "")).groupBy("bucket", "signature").agg(F.count(F.lit(1)).alias("members"), F.round(F.avg("cohesion"), 6).alias("cohesion"), F.avg("upstream").alias("upstream"))
    lines = table(s, d, "agent1_unified_lines").where("row_type = 'LINE'").select("line_id", T.category_path("category_l2").alias("bucket"), T.signature(F.coalesce(_E, F.lit(""))).alias("signature"))
    return G.attach_groups(lines, reg.join(q, ["bucket", "signature"]), "line_id")


@query()
def line_sources(s, d):
    """The lines as they came with the appended columns of their group behind."""
    src = table(s, d, "agent1_unified_lines").select("line_id", "source_file", "source_row_number", _E, "row_type")
    return G.appended(src, _line_groups(s, d), "line_id", ["label", "group_id", "confidence", "is_other"])


_a = "ai_purchase_group_"


@query(f"SELECT category_l1 AS bucket, count(DISTINCT {_a}id) AS groups, count(*) AS lines, count(*) FILTER ({_a}band = 'High') AS high, count(*) FILTER ({_a}band = 'Medium') AS medium, count(*) FILTER ({_a}band = 'Low') AS low, round(sum({_a}confidence) / count({_a}confidence), 4) AS mean_confidence FROM agent2_purchase_groups GROUP BY 1")
def bucket_summary(s, d):
    """Groups, lines, bands and mean confidence per bucket."""
    g = table(s, d, "agent2_purchase_groups")
    band = lambda b: F.count_if(F.col(_a + "band") == b).alias(b.lower())
    return g.groupBy(F.col("category_l1").alias("bucket")).agg(F.countDistinct(_a + "id").alias("groups"), F.count(F.lit(1)).alias("lines"), band("High"), band("Medium"), band("Low"), F.round(F.sum(_a + "confidence") / F.count(_a + "confidence"), 4).alias("mean_confidence"))


@query(f"SELECT count(*) AS rows, count(DISTINCT row_id) AS lines, count(DISTINCT {_a}id) AS groups, count(*) FILTER ({_a}is_new = 'Yes') AS of_new_groups, count(*) FILTER (trim({_a}l5) = '' OR {_a}l5 IS NULL) AS unlabelled, sum(spend_eur::DECIMAL(18,4))::DOUBLE AS spend, count(DISTINCT agent2_run_id) AS runs FROM agent2_purchase_groups")
def run_statistics(s, d):
    """The figures of a run's manifest, in one aggregation."""
    g = table(s, d, "agent2_purchase_groups")
    return g.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("row_id").alias("lines"), F.countDistinct(_a + "id").alias("groups"), F.count_if(F.col(_a + "is_new") == "Yes").alias("of_new_groups"),
        F.count_if(F.coalesce(F.trim(_a + "l5"), F.lit("")) == "").alias("unlabelled"), F.sum(F.col("spend_eur").cast("decimal(18,4)")).cast("double").alias("spend"), F.countDistinct("agent2_run_id").alias("runs"),
    )


_WORDS = f"list_filter({Q.tokens(Q.lookup('l'))}, lambda w: w NOT IN ({_quoted(T.STOPWORDS)}))"


@query(f"SELECT l AS label, len(list_filter({_WORDS}, lambda w: w NOT IN ({_quoted(G.GENERIC)}))) = 0 AS weak FROM (SELECT DISTINCT {_a}l5 AS l FROM agent2_purchase_groups WHERE {_a}l5 IS NOT NULL)")
def weak_labels(s, d):
    """Labels that say nothing: no word but generic ones."""
    return table(s, d, "agent2_purchase_groups").select(F.col(_a + "l5").alias("label")).where("label IS NOT NULL").distinct().withColumn("weak", G.weak_label(F.col("label")))


@query(f"SELECT line_id FROM agent1_unified_lines WHERE coalesce(language_confidence, 0) < 0.6 AND len({Q.tokens(f'coalesce({_E}, {chr(39) * 2})')}) >= 2")
def residue_lines(s, d):
    """Lines whose language is too unsure: what a reader would get."""
    return G.residue(table(s, d, "agent1_unified_lines"), "language_confidence", _E, 0.6).select("line_id")


@query(f"SELECT group_row, round(abs({_a}cohesion - 0.45), 6) AS distance FROM agent2_purchase_groups WHERE {_a}cohesion BETWEEN 0.45 - 0.05 AND 0.45 + 0.05 ORDER BY distance, group_row LIMIT 200")
def adjudication_band(s, d):
    """The 200 grouped lines nearest to the cohesion that decides on Other."""
    return G.adjudicate(table(s, d, "agent2_purchase_groups"), _a + "cohesion", "group_row", 0.45, 0.05).select("group_row", "distance")


_NOISE = ["misc", "other", "various", "n/a", "test"]


@query(f"SELECT line_id, (k IS NULL OR k = '' OR k IN ({_quoted(_NOISE)}) OR NOT regexp_matches(k, '\\p{{L}}')) AS noise, NOT (k IS NULL OR k = '' OR k IN ({_quoted(_NOISE)}) OR NOT regexp_matches(k, '\\p{{L}}')) AND len(list_filter({Q.tokens('t')}, lambda w: NOT {Q.code('w')} AND lower(w) NOT IN ({_quoted(T.STOPWORDS)}) AND length(w) >= 3)) > 0 AS meaningful FROM (SELECT line_id, coalesce({_E}, '') AS t, {Q.lookup(f'coalesce({_E}, {chr(39) * 2})')} AS k FROM agent1_unified_lines)")
def noise_flags(s, d):
    """Whether a description is noise, and whether it says anything."""
    c = F.coalesce(_E, F.lit(""))
    return table(s, d, "agent1_unified_lines").select("line_id", T.is_noise(c, _NOISE).alias("noise"), G.meaningful(c, _NOISE, T.STOPWORDS).alias("meaningful"))


@query("""SELECT line_id, '{"basis":"' || CASE WHEN coalesce(enriched_purchase_description, '') = '' THEN 'none' ELSE 'description' END || '","evidence":' || coalesce(evidence_field_count, 0) || ',"tier":"' || coalesce(match_tier, 'none') || '"}' AS factors FROM agent1_unified_lines""")
def confidence_factors(s, d):
    """The factors behind a confidence as JSON with its keys in order."""
    f = R.factors(tier=F.coalesce("match_tier", F.lit("none")), evidence=F.coalesce("evidence_field_count", F.lit(0)), basis=F.when(F.coalesce(_E, F.lit("")) == "", "none").otherwise("description"))
    return table(s, d, "agent1_unified_lines").select("line_id", f.alias("factors"))


# --- suppliers ------------------------------------------------------------------------------------

_WIN = f"""w AS (SELECT number, supplier FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY n DESC, supplier) AS k FROM (SELECT erp_supplier_number AS number, {S._supplier_key('erp_supplier_name')} AS supplier, count(*) AS n FROM max_transactions WHERE NOT {Q.blank('erp_supplier_number')} AND NOT {Q.blank('erp_supplier_name')} GROUP BY 1, 2)) WHERE k = 1 AND supplier <> '')"""
_OVERRIDES = [("visikiru rormontage", "visikiru"), ("druskoheji", "druskoheji group")]


@query(f"""WITH {_WIN}, o AS (SELECT * FROM (VALUES {', '.join(repr(x) for x in _OVERRIDES)}) v(name, canonical)), x AS (SELECT row_no, coalesce(w.supplier, nullif({S._supplier_key("coalesce(erp_supplier_name, '')")}, '')) AS name, w.supplier AS by_number FROM max_transactions t LEFT JOIN w ON w.number = t.erp_supplier_number)
SELECT row_no, coalesce(o.canonical, x.name, '') AS supplier, CASE WHEN o.canonical IS NOT NULL THEN 'override' WHEN by_number IS NOT NULL THEN 'number' WHEN x.name IS NOT NULL THEN 'name' ELSE 'none' END AS via FROM x LEFT JOIN o ON o.name = x.name""")
def line_supplier(s, d):
    """Every transaction with its supplier, through vendor number and overrides."""
    t = table(s, d, "max_transactions")
    named = t.where(~T.is_blank("erp_supplier_number") & ~T.is_blank("erp_supplier_name"))
    c = named.groupBy(F.col("erp_supplier_number").alias("number"), T.supplier_key("erp_supplier_name").alias("supplier")).agg(F.count(F.lit(1)).alias("n"))
    win = M.top_k(c, ["number"], [F.desc("n"), F.col("supplier")], 1).where("supplier <> ''").select("number", "supplier")
    return G.supplier_of_lines(t, "row_no", "erp_supplier_name", "erp_supplier_number", s.createDataFrame(_OVERRIDES, "name string, canonical string"), win)


@query(f"""WITH p AS ({S.SQL['supplier_blocks_dup']}), sp AS (SELECT {S._supplier_key("coalesce(display_name, '')")} AS k, coalesce(sum(spend::DECIMAL(18,4)), 0) AS spend FROM supplier_names GROUP BY 1),
d AS (SELECT CASE WHEN a.spend >= b.spend THEN p.other ELSE p.k END AS duplicate, CASE WHEN a.spend >= b.spend THEN p.k ELSE p.other END AS survivor, greatest(a.spend, b.spend) AS spend FROM p JOIN sp a ON a.k = p.k JOIN sp b ON b.k = p.other)
SELECT duplicate, survivor FROM (SELECT *, row_number() OVER (PARTITION BY duplicate ORDER BY spend DESC, survivor) AS r FROM d) WHERE r = 1""")
def duplicate_vendors(s, d):
    """Likely duplicates among the suppliers with the one that stays, which is of the larger spend."""
    spend = table(s, d, "supplier_names").select(T.supplier_key(F.coalesce("display_name", F.lit(""))).alias("k"), F.col("spend").cast("decimal(18,4)").alias("spend"))
    return G.survivors(A.supplier_blocks_dup(s, d), spend)


# --- ordered outputs ------------------------------------------------------------------------------

_LEVEL = lambda: F.array_position(F.array(*[F.lit(x) for x in C.LEVELS]), F.col("scope_level"))
_BAND = lambda c: F.when(F.col(c) == "High", 0).when(F.col(c) == "Medium", 1).otherwise(2)
_O = CC._OVER + ", hd AS (SELECT * FROM o WHERE rank = 1)"
_SHARED = """, e AS (SELECT hd.scope_level, hd.scope_value, hd.supplier, x.item, row_number() OVER (PARTITION BY hd.scope_level, hd.scope_value, hd.supplier ORDER BY x.weight DESC, x.item) AS k
  FROM hd JOIN p x ON x.scope_level = hd.scope_level AND x.scope_value = hd.scope_value AND x.supplier = hd.supplier AND x.named JOIN p y ON y.scope_level = hd.scope_level AND y.scope_value = hd.scope_value AND y.supplier = hd.partner AND y.item = x.item AND y.named),
l3 AS (SELECT scope_level, scope_value, supplier, string_agg(item, ', ' ORDER BY k) AS shared FROM e WHERE k <= 3 GROUP BY 1, 2, 3)"""
_PCT = "round_even(least(1.0, greatest(0.0, coverage)) * 100, 0)::INT"
_POS = f"(list_position([{_quoted(C.LEVELS)}], scope_level))"
_RANK = "CASE consolidation_band WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END"


@query(f"""WITH {_O}{_SHARED}, ff AS (SELECT hd.*, coalesce(l3.shared, '') AS shared, b.basis, round(coverage, 6) AS c6, round(addressable_spend, 2) AS a2 FROM hd LEFT JOIN l3 USING (scope_level, scope_value, supplier) JOIN b USING (scope_level, scope_value))
SELECT row_number() OVER (ORDER BY {_POS}, {_RANK}, c6 DESC, a2 DESC, supplier, scope_value) AS position, scope_level, scope_value, supplier, partner, consolidation_band AS band,
{_PCT} || '% of the ' || CASE basis WHEN 'spend' THEN 'spend' ELSE 'lines' END || ' with ' || supplier || ' in ' || scope_value || ' could go to ' || partner || CASE WHEN shared <> '' THEN ', mostly ' || shared ELSE '' END || ' (' || exact_items || ' equal items).' ||
CASE WHEN reverse_coverage >= coverage + 0.15 THEN ' ' || partner || ' sells less than that besides and may be given up.' WHEN coverage >= reverse_coverage + 0.15 THEN ' ' || partner || ' sells more than that and may take it over.' ELSE '' END ||
CASE WHEN partner_lines < {C.MIN_LINES} THEN ' Only ' || partner_lines || ' lines of its own say so.' ELSE '' END AS reason FROM ff""")
def headline(s, d):
    """The best partner of every supplier and scope with its reason, in the order of the report: scope, band, coverage, spend, name."""
    p = cut(CC._p(s, d))
    o = cut(C.overlaps(p, most=1).where("rank = 1"))
    named = p.where("named").select(*C.KEY, "item", "weight")
    mine = o.select(*C.KEY, "partner").join(named, C.KEY)
    both = mine.join(named.select(*C.SCOPE, F.col("supplier").alias("partner"), "item"), [*C.SCOPE, "partner", "item"])
    top = both.withColumn("k", F.row_number().over(Window.partitionBy(*C.KEY).orderBy(F.desc("weight"), "item"))).where("k <= 3")
    shared = top.groupBy(*C.KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "item"))), lambda x: x["item"]), ", ").alias("shared"))
    basis = C.weight_basis(C.scope_unpivot(C.purchase_lines(s, d), C.LEVELS)).select(*C.SCOPE, "basis")
    f = o.join(shared, C.KEY, "left").join(basis, C.SCOPE).withColumn("shared", F.coalesce("shared", F.lit("")))
    f = f.withColumn("reason", O.reason(F.col("coverage"), F.col("supplier"), F.col("basis"), F.col("scope_value"), F.col("partner"), F.col("shared"), F.col("exact_items"), F.col("reverse_coverage"), F.col("partner_lines"), C.MIN_LINES))
    n = O.numbered(f, [_LEVEL(), _BAND("consolidation_band"), F.desc(F.round("coverage", 6)), F.desc(F.round("addressable_spend", 2)), F.col("supplier"), F.col("scope_value")])
    return n.select("position", *C.KEY, "partner", F.col("consolidation_band").alias("band"), "reason")


@query(f"SELECT row_number() OVER (ORDER BY strongest DESC, scope_level, scope_value, supplier_a, supplier_b) AS position, * FROM ({CC.SQL['supplier_pairs']})")
def pairs_ordered(s, d):
    """The supplier pairs, strongest first."""
    return O.numbered(CC.supplier_pairs(s, d), [F.desc("strongest"), F.col("scope_level"), F.col("scope_value"), F.col("supplier_a"), F.col("supplier_b")])


@query(f"SELECT row_number() OVER (ORDER BY spend DESC, rows DESC, label) AS position, * FROM ({A.SQL['group_directory']})")
def directory_ordered(s, d):
    """The group directory, largest spend first."""
    return O.numbered(A.group_directory(s, d), [F.desc("spend"), F.desc("rows"), F.col("label")])


@query(f"SELECT row_number() OVER (ORDER BY score DESC, description) AS position, * FROM ({A.SQL['candidate_score']})")
def candidate_list(s, d):
    """The catalogue candidates, best first."""
    return O.numbered(A.candidate_score(s, d), [F.desc("score"), F.col("description")])


# --- reading of text --------------------------------------------------------------------------------


@query(f"SELECT result_id, CASE WHEN len(w) = 0 THEN 'Unclassified' WHEN s > m THEN 'Service' WHEN m > s THEN 'Material' ELSE '' END AS value FROM (SELECT result_id, w, len(list_intersect(w, [{_quoted(default().service_markers)}])) AS s, len(list_intersect(w, [{_quoted(default().material_markers)}])) AS m FROM (SELECT result_id, {Q.tokens(Q.lookup(f'coalesce(source_text, {chr(39) * 2})'))} AS w FROM translation_results))")
def text_item_or_service(s, d):
    return table(s, d, "translation_results").select("result_id", R.item_or_service(F.col("source_text"), default().service_markers, default().material_markers).alias("value"))


_HITS = " + ".join(f"(len(list_intersect(w, [{_quoted(X.MARKERS[k])}])) > 0)::INT" for k in X.MARKERS)


@query(f"SELECT result_id, round(least(1.0, 0.7 * coalesce(coverage, 0) + least(0.25, 0.05 * ({_HITS})) + CASE WHEN coalesce(language, '') <> '' THEN 0.05 ELSE 0 END), 4) AS value FROM (SELECT *, {Q.tokens(Q.lookup(f'coalesce(source_text, {chr(39) * 2})'))} AS w FROM translation_results)")
def interpretation_confidence(s, d):
    t = table(s, d, "translation_results").withColumn("__t", F.coalesce("source_text", F.lit("")))
    signals = sum((X.mentions("__t", k) == "Yes").cast("int") for k in X.MARKERS)
    return t.select("result_id", R.interpretation_confidence(F.col("coverage"), signals, F.coalesce("language", F.lit("")) != "").alias("value"))


_SRC = ("document_line_desc", "po_line_desc", "materialgroupname")
_GOT = "list_filter([" + ", ".join(f"CASE WHEN NOT {Q.blank(c)} THEN {Q.norm(c)} END" for c in _SRC) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT row_no, array_to_string(list_filter(a, lambda x, i: list_position(k, {Q.lookup('x')}) = i), ' | ') AS value FROM (SELECT row_no, a, list_transform(a, lambda x: {Q.lookup('x')}) AS k FROM (SELECT row_no, {_GOT} AS a FROM max_transactions))")
def text_gather(s, d):
    """What a transaction says of itself, each thing once."""
    return table(s, d, "max_transactions").select("row_no", F.array_join(R.gather(*[F.col(c) for c in _SRC]), " | ").alias("value"))


@query("SELECT result_id, array_to_string(list_sort(list_distinct(list_filter(" + Q.tokens("source_text") + "[2:], lambda w: regexp_matches(w, '^\\p{Lu}\\p{Ll}+$')))), '; ') AS value FROM translation_results")
def proper_nouns(s, d):
    return table(s, d, "translation_results").select("result_id", F.array_join(R.proper_nouns("source_text"), "; ").alias("value"))


@query()
def text_prose(s, d):
    return table(s, d, "translation_results").select("result_id", R.prose("source_text").alias("value"))


@query()
def extract_money(s, d):
    return table(s, d, "documents").select("doc_id", X.money("text").alias("value"))


_CUT = Q.collapse("split_part(description, ' | ', 1)")


@query(f"""SELECT item_row, coalesce(nullif(trim(item_id), ''), 'ROW' || item_row) AS id, CASE WHEN length(t) <= 40 THEN t ELSE trim(CASE WHEN substr(t, 41, 1) IN ('', ' ') THEN left(t, 40) ELSE regexp_replace(left(t, 40), ' [^ ]*$', '') END) END AS reference FROM (SELECT item_row, item_id, {_CUT} AS t FROM reference_items) WHERE t <> ''""")
def reference_library(s, d):
    """The catalogue as a library of references: the text before the first bar cut at a word, and an id where none is given."""
    t = table(s, d, "reference_items")
    return t.select("item_row", F.coalesce(F.nullif(F.trim("item_id"), F.lit("")), F.concat(F.lit("ROW"), F.col("item_row"))).alias("id"), R.reference_text("description", 40).alias("reference")).where("reference <> ''")


@query("SELECT supplier, round_even((max(unit_price) - min(unit_price)) / min(unit_price) * 100, 1) AS value FROM reference_items WHERE unit_price > 0 AND supplier <> '' GROUP BY 1")
def price_spread(s, d):
    """Percent between the dearest and the cheapest listing of each seller."""
    r = table(s, d, "reference_items").where("unit_price > 0 AND supplier <> ''").groupBy("supplier").agg(F.max("unit_price").alias("hi"), F.min("unit_price").alias("lo"))
    return r.select("supplier", T.price_difference(F.col("hi"), F.col("lo")).alias("value"))



# --- similarity of labels ---------------------------------------------------------------------------


def _labels(s, d):
    return table(s, d, "agent2_purchase_groups").select(F.col("category_l1").alias("bucket"), T.lookup_key(_a + "l5").alias("label")).where("label <> ''").distinct()


_GRAM = """bl AS (SELECT DISTINCT category_l1 AS bucket, {0} AS label FROM agent2_purchase_groups), t AS (SELECT label, {1} AS w FROM (SELECT DISTINCT label FROM bl WHERE label <> '')),
gw AS (SELECT 'w' AS v, label, unnest(w) AS term FROM t UNION ALL SELECT 'w', label, w[i] || ' ' || w[i + 1] FROM (SELECT label, w, unnest(range(1, len(w))) AS i FROM t)),
gc AS (SELECT 'c' AS v, label, substr(x, o, n) AS term FROM (SELECT label, ' ' || unnest(w) || ' ' AS x FROM t), (SELECT unnest([3, 4, 5]) AS n), LATERAL (SELECT unnest(range(1, length(x) - n + 2)) AS o)),
tf AS (SELECT v, label, term, 1 + ln(count(*)) AS tf FROM (SELECT * FROM gw UNION ALL SELECT * FROM gc) GROUP BY 1, 2, 3), sp AS (SELECT v, term, ln((1 + (SELECT count(*) FROM t)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf GROUP BY 1, 2),
u AS (SELECT v, label, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY v, label)) AS u FROM tf JOIN sp USING (v, term)),
dd AS (SELECT x.bucket, a.label, b.label AS other, a.v, sum(a.u * b.u) AS s FROM u a JOIN u b ON a.v = b.v AND a.term = b.term JOIN bl x ON x.label = a.label JOIN bl y ON y.label = b.label AND y.bucket IS NOT DISTINCT FROM x.bucket WHERE a.label <> b.label GROUP BY 1, 2, 3, 4),
bb AS (SELECT bucket, label, other, round(least(1.0, greatest(0.0, sum(s * CASE v WHEN 'w' THEN 0.4 ELSE 0.3 END::DOUBLE) / 0.7::DOUBLE)), 5) AS score FROM dd GROUP BY 1, 2, 3)""".format(Q.lookup(_a + "l5"), Q.tokens("label"))


@query(f"WITH {_GRAM} SELECT bucket, label, other, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY bucket, label ORDER BY score DESC, other) AS rank FROM bb) WHERE rank <= 5")
def label_blend(s, d):
    """The five labels of its bucket nearest to each label, by words and character n-grams blended .40 and .30 over the views there are."""
    w = T.tokens(F.col("label"))
    pairs = F.concat(w, F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>")))
    return M.blended(_labels(s, d), "bucket", "label", [(pairs, 0.40), (M.char_grams(F.col("label")), 0.30)], 5)


@query("""WITH p AS (SELECT a.vec_id AS query, b.vec_id AS item, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query, item, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank FROM p WHERE score >= 0.3) WHERE rank <= 8""")
def semantic_neighbours(s, d):
    """The up to eight vectors of similarity .30 or more (the floor is a parameter) for every vector whose id is divisible by 20."""
    v = table(s, d, "embeddings")
    return M.nearest(v, v.where("vec_id % 20 = 0"), "vec_id", "embedding", 0.30, 8)


@query()
def item_neighbours(s, d):
    """The up to eight items most like each item by their words, over all items."""
    return C.item_neighbours(CC._p(s, d).where("named").select("item").distinct())


@query("""WITH p AS (SELECT a.vec_id AS query, b.vec_id AS item, a.label = b.label AS same, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
s AS (SELECT query, item, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank FROM p) WHERE rank <= 5),
l AS (SELECT query, item FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY item) AS rank FROM p WHERE same) WHERE rank <= 5)
SELECT coalesce(s.query, l.query) AS query, coalesce(s.item, l.item) AS item, coalesce(s.score, 0.0) AS semantic, CASE WHEN l.query IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS lexical FROM s FULL JOIN l ON s.query = l.query AND s.item = l.item""")
def retrieval_union(s, d):
    """Candidates of two retrievals united: the nearest vectors, and the first of equal label."""
    v = table(s, d, "embeddings")
    near = M.nearest(v, v.where("vec_id % 20 = 0"), "vec_id", "embedding", -1.0, 5).select("query", "item", "score")
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), "label")
    few = M.first_of_each(v, "label", "vec_id", 6).select("label", F.col("vec_id").alias("item"))
    equal = M.top_k(q.join(few, "label").where("query <> item").select("query", "item", F.lit(1.0).alias("score")), ["query"], [F.col("item")], 5)
    return M.united(near, equal.select("query", "item", "score"))
