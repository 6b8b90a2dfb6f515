"""The scalar functions as DuckDB SQL text: the independent side of every comparison."""

from __future__ import annotations


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


def norm(x: str) -> str:
    t = collapse(f"regexp_replace(regexp_replace(coalesce({x}, ''), '_x00[0-9A-Fa-f]{{2}}_', ' ', 'g'), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', ' ', 'g')")
    return f"regexp_replace({t}, '^(-?\\d{{1,15}})\\.0+$', '\\1')"


def fold(x: str) -> str:
    return f"strip_accents(replace(replace(replace(translate({x}, 'łŁøØđĐħĦŧŦı', 'lLoOdDhHtTi'), 'æ', 'ae'), 'Æ', 'AE'), 'ß', 'ss'))"


def lookup(x: str) -> str:
    return collapse(f"lower({fold(x)})")


def compact(x: str) -> str:
    return f"regexp_replace(upper({norm(x)}), '[^A-Z0-9]', '', 'g')"


def blank(x: str) -> str:
    return f"(lower({norm(x)}) IN ('', 'n/a', 'na', 'n.a.', 'none', 'null', 'nil', '-', '--', '0', 'unknown', 'not defined', 'not applicable', 'tbd', '#n/a', 'nan'))"


def amount(x: str) -> str:
    raw = norm(x)
    t = f"regexp_replace(regexp_replace({raw}, '^[()]+|[()]+$', '', 'g'), '[^0-9,.\\-]', '', 'g')"
    plain = f"""CASE WHEN contains({t}, ',') AND contains({t}, '.') THEN
        CASE WHEN instr(reverse({t}), ',') < instr(reverse({t}), '.') THEN replace(replace({t}, '.', ''), ',', '.') ELSE replace({t}, ',', '') END
      WHEN contains({t}, ',') THEN CASE WHEN instr(reverse({t}), ',') = 4 AND length({t}) > 4 THEN regexp_replace({t}, '^(.*),([^,]*)$', '\\1\\2') ELSE replace({t}, ',', '.') END
      ELSE {t} END"""
    return f"(CASE WHEN regexp_full_match({plain}, '-?(\\d+\\.?\\d*|\\.\\d+)') THEN try_cast({plain} AS DOUBLE) * (CASE WHEN regexp_full_match({raw}, '\\(.*\\)') THEN -1 ELSE 1 END) END)"


def line(x: str) -> str:
    t = f"replace({norm(x)}, ',', '.')"
    num = f"(CASE WHEN regexp_full_match({t}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)') THEN try_cast({t} AS DOUBLE) END)"
    return f"(CASE WHEN {blank(x)} THEN '' WHEN {num} IS NOT NULL AND abs({num} - floor({num})) < 1e-9 THEN (floor({num})::BIGINT)::VARCHAR WHEN {num} IS NOT NULL THEN {num}::VARCHAR ELSE {compact(x)} END)"


def document(x: str) -> str:
    t = norm(x)
    base = f"regexp_extract({t}, '([^/\\\\]*)$', 1)"
    solid = f"regexp_replace({t}, '[^A-Za-z0-9]', '', 'g')"
    return f"(CASE WHEN {blank(x)} THEN '' ELSE lower(coalesce(nullif(regexp_extract({t}, '(?i)[?&]docid=([A-Za-z0-9]+)', 1), ''), nullif(regexp_extract({base}, '^([A-Za-z0-9]{{16,64}})(?:[_.\\-]|$)', 1), ''), CASE WHEN length({solid}) >= 16 THEN {solid} END, '')) END)"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '([\\p{{L}}\\p{{N}}]+)', 1)"


def code(t: str) -> str:
    return f"(regexp_matches({t}, '\\p{{N}}') OR length({t}) <= 2 OR (length({t}) >= 4 AND regexp_matches({t}, '\\p{{Lu}}') AND NOT regexp_matches({t}, '\\p{{Ll}}')))"


def welded(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '(\\d)(\\p{{L}}{{4,}})', '\\1 \\2', 'g'), '(\\p{{L}})(\\d{{4,}})', '\\1 \\2', 'g')"


def soften(x: str) -> str:
    letters, upper = f"length(regexp_replace({x}, '\\P{{L}}', '', 'g'))", f"length(regexp_replace({x}, '\\P{{Lu}}', '', 'g'))"
    return f"(CASE WHEN {letters} >= 2 AND {upper} > 0.85 * {letters} THEN lower({x}) ELSE {x} END)"


def date(x: str) -> str:
    t = norm(x)
    iso, eu = f"regexp_extract({t}, '^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1)", [f"regexp_extract({t}, '^(\\d{{1,2}})[./](\\d{{1,2}})[./](\\d{{4}})', {g})" for g in (0, 1, 2, 3)]
    return f"(CASE WHEN {iso} <> '' THEN {iso} WHEN {eu[3]} <> '' THEN {eu[3]} || '-' || lpad({eu[2]}, 2, '0') || '-' || lpad({eu[1]}, 2, '0') ELSE {t} END)"


def lemma(w: str) -> str:
    return f"(CASE WHEN length({w}) <= 3 THEN {w} WHEN {w} LIKE '%ies' THEN left({w}, length({w}) - 3) || 'y' WHEN regexp_matches({w}, '(sses|shes|ches|xes|zes)$') THEN left({w}, length({w}) - 2) WHEN regexp_matches({w}, '(ss|us|is|os|ys)$') THEN {w} WHEN {w} LIKE '%s' THEN left({w}, length({w}) - 1) ELSE {w} END)"


def hash16(*x: str) -> str:
    return "left(sha256(" + " || chr(31) || ".join(f"coalesce({c}::VARCHAR, '')" for c in x) + "), 16)"
