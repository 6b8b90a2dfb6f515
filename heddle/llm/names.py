"""Variant spellings of names typed by people (problem 2), as a noisy channel.

A spelling is read as kind (company or person), leading name, and the rest: the trade of a
company or the given name of a person; the legal form is taken off. Distinct forms are counted.
Within one leading name the frequent forms come first as candidate canonical forms, and every
other form goes to the candidate of the greatest posterior: its frequency times the likelihood
of the typo, abbreviation, short form or omission that would have made the one from the other.
A leading name is split by the first letter of the trade, which every abbreviation keeps; a
rare trade or leading name that is one typing error from a more frequent one visits the forms
of that one too. Forms that omit the trade see sums over the candidates of each legal form only.
A vendor number in common links forms as well, however many carry it. It is judged by the names
under it: one whose records fall into several unrelated names, none with most of them, is a
collective account and links nothing, as are numbers given as such. Only forms are ever compared.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.skew import attach_by_key, min_by_key, pairs_within
from ..session import cut, parts, table

# Legal forms and marks of sole traders, folded and without dots.
LEGAL = {
    "oy", "ab", "oyab", "aboy", "oyj", "abp", "ky", "ay", "osakeyhtio", "kommandiittiyhtio", "gmbh", "mbh", "ag", "kg", "ohg", "ug", "aktiengesellschaft",
    "co", "cokg", "sp", "spj", "spzoo", "zoo", "oo", "sa", "spolka", "akcyjna", "jawna", "llp", "ltd", "limited", "plc", "llc", "inc", "aktiebolag", "aktieb", "hb", "kb",
    "handelsbolag", "handelsb", "as", "asa", "aksjeselskap", "allmennaksjeselskap", "und", "and", "tmi", "sole", "trader", "toiminimi",
}
# Forms that say the same.
SAME_LEGAL = {"aktiebolag": "ab", "aktieb": "ab", "handelsbolag": "hb", "handelsb": "hb", "limited": "ltd", "spolka": "sp", "osakeyhtio": "oy", "kommandiittiyhtio": "ky", "cokg": "kg", "oyab": "oy", "abp": "oyj", "aktiengesellschaft": "ag"}
SOLE = {"tmi", "sole", "trader", "toiminimi"}
#: Unrelated names under one number beyond which it is a collective account's, if none of them has most of its records.
CLASSES = 4
#: Likelihoods of the channel: one typing error, an abbreviation, a missing trade, an initial, a short form.
TYPO, SHORT, OMIT, INITIAL, NICK = 0.02, 0.03, 0.02, 0.02, 0.1

_PLAIN = str.maketrans({"ł": "l", "ø": "o", "æ": "a", "œ": "o", "đ": "d", "ð": "d", "þ": "t", "ı": "i"})


def fold(text: str) -> str:
    """Lower case without accents, in which ae, oe and ue stand for a, o and u."""
    t = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c)).replace("ß", "ss").translate(_PLAIN)
    return t.replace("ae", "a").replace("oe", "o").replace("ue", "u")


def tokens(name: str) -> tuple[list[str], list[str]]:
    """(content tokens in order, legal tokens); dots and hyphens inside a token are taken out."""
    content, legal = [], []
    for raw in re.split(r"[\s,/()&;|+]+|(?<=\w{3})-(?=\w{3})|(?<=\w{4})\.(?=\w{4})", fold(name)):
        t = re.sub(r"[\W_]+", "", raw)
        if not t:
            continue
        if t in LEGAL or (len(t) == 1 and legal and legal[-1] == "sp" and t in "jzo"):
            if t not in {"co", "und", "and"}:
                legal.append(t)
        else:
            content.append(t)
    return content, legal


@lru_cache(200_000)
def edits(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between two words (optimal string alignment)."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 3:
        return 9
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        two, one = one, row
    return one[-1]


@lru_cache(200_000)
def shortens(a: str, b: str) -> bool:
    """Whether ``a`` abbreviates ``b``: same first letter, clearly shorter, its letters in order in ``b``."""
    if not a or not b or a[0] != b[0] or len(a) > len(b) - 2:
        return False
    it = iter(b)
    return all(c in it for c in a)


def channel(variant: str, canonical: str) -> float:
    """Likelihood that ``canonical`` was written as ``variant``; 0 if no error of the channel makes it so."""
    if variant == canonical:
        return 1.0
    if not variant or not canonical:
        return 0.0
    d = edits(variant, canonical)
    if d <= (1 if len(canonical) < 9 else 2) and min(len(variant), len(canonical)) >= 4:
        return TYPO**d
    for a, b in ((variant, canonical), (canonical, variant)):
        if shortens(a, b):
            return SHORT
        # an abbreviation in which one letter was mistyped as well
        if len(a) >= 6 and len(a) < len(b) - 1 and any(shortens(a[:i] + a[i + 1 :], b) for i in range(1, len(a))):
            return SHORT * TYPO
    return 0.0


def _read(given: dict[str, list[str]]):
    """Reads each record's spellings: (kind, tokens, given names, initial, legal)."""
    near: dict[str, list[str]] = {}

    def names_of(t: str) -> list[str]:
        if t in given:
            return given[t]
        if len(t) < 5:
            return []
        if t not in near:
            near[t] = sorted({g for k, v in given.items() if len(k) >= 5 and abs(len(k) - len(t)) <= 1 and edits(t, k) == 1 for g in v})
        return near[t]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row, shown, raws, number in zip(b["supplier_row"], b["display_name"], b["raw_names"], b["identifier"]):
                seen = [x for x in [shown, *(list(raws) if raws is not None else [])] if isinstance(x, str)]
                read = [tokens(x) for x in seen]
                content, legal = max(read, key=lambda r: (sum(map(len, r[0])), len(r[1])), default=([], []))
                if not content:
                    continue
                legal_all = sorted({SAME_LEGAL.get(x, x) for r in read for x in r[1]})
                kind, first, initial, rest = "c", [], "", content
                long = [t for t in content if len(t) > 1]
                sole = not set(legal_all) - SOLE
                named = [t for t in long if names_of(t)] if sole and len(long) == 2 else []
                if named:
                    g = named[0] if len(named) == 1 or named[0] in given else named[1]
                    kind, first, rest = "p", names_of(g), [t for t in long if t is not g] or [g]
                elif len(long) == 1 and len(content) >= 2 and sole:
                    kind, initial, rest = "p", next(t for t in content if len(t) == 1), long
                out.append((row, kind, rest, first, initial, " ".join(x for x in legal_all if x not in SOLE), number if isinstance(number, str) and number.strip() else None))
            yield pd.DataFrame(out, columns=["supplier_row", "kind", "tokens", "given", "initial", "legal", "identifier"])

    return run


def deletions(c: str) -> F.Column:
    """The word and the word without one letter: words one error apart share one of these.

    A key is shared by the words that one more letter makes of it, so by a bounded number of distinct words.
    """
    w = F.col(c)
    return F.array_distinct(F.concat(F.array(w), F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))


def _one_error(a: str, b: str) -> F.Column:
    """One insertion, deletion, replacement or swap of neighbours apart, by built-in functions."""
    swap = (F.length(a) == F.length(b)) & (F.levenshtein(a, b) == 2) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (F.levenshtein(a, b) <= 1) | swap


def _likelihood(f: dict, c: dict) -> float:
    """Likelihood that the form ``c`` was written as ``f``, given their leading name."""
    if f["kind"] == "p":
        a, b = set(f["given"]), set(c["given"])
        if a and b:
            return (1.0 if a == b else NICK) if a & b else 0.0
        if f["initial"] and b:
            return INITIAL if any(x.startswith(f["initial"]) for x in b) else 0.0
        return 0.5 if not b and f["initial"] == c["initial"] else 0.0
    return channel(f["trade"], c["trade"])


def _best(canon: list[dict], f: dict, whole: bool) -> tuple[dict | None, float]:
    """The candidate of the greatest posterior; with ``whole`` only if it has more than half of it."""
    top, total, found = (0.0, 0), 0.0, None
    for c in canon:
        x = c["w"] * _likelihood(f, c)
        total += x
        if x > 0 and (x, -c["form_id"]) > top:
            top, found = (x, -c["form_id"]), c
    return (found, top[0]) if found and (not whole or top[0] / total > 0.5) else (None, 0.0)


def _attach(own: list[dict], guests: list[dict]) -> Iterator[tuple[int, int, float, bool]]:
    """Within one group: its own forms, and visitors whose leading name or trade may be a typing error of it."""
    own = sorted(own, key=lambda f: (-f["n"], f["form_id"]))
    canon: list[dict] = []
    vague = lambda f: f["kind"] == "p" and not f["given"]
    for f in [x for x in own if not vague(x)] + [x for x in own if vague(x)]:
        c, _ = _best(canon, f, vague(f))
        if c is None:
            canon.append({**f, "w": float(f["n"])})
            yield f["form_id"], f["form_id"], 1.0, False
        else:
            c["w"] += f["n"]
            if f["kind"] == "p" and f["given"]:
                c["given"] = sorted(set(c["given"]) & set(f["given"])) or c["given"]
            yield f["form_id"], c["form_id"], 1.0, False
    for f in guests:
        c, score = _best(canon, f, True)
        if c is not None and not (vague(f) and len(canon) > 1):
            yield f["form_id"], c["form_id"], score * TYPO, True


def _attach_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of rows sorted by (kind, host, letter); only the distinct forms of one group are held at a time."""
    key, own, guests, out = None, [], [], []

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_())], ["form_id", "to_id", "score", "visitor"])

    for b in batches:
        for f in b.to_pylist():
            if (f["kind"], f["host"], f["letter"]) != key:
                out += _attach(own, guests)
                key, own, guests = (f["kind"], f["host"], f["letter"]), [], []
            (guests if f["visitor"] else own).append(f)
        if len(out) > 10_000:
            yield emit(out)
            out = []
    yield emit(out + list(_attach(own, guests)))


def _omitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forms without a trade, by posterior over the companies of their leading name, which come as sums per legal form.

    A form whose own leading name has no company to take it stands for itself, and later ones without a trade join it.
    """
    out: list[tuple[int, int, float, bool]] = []
    for b in batches:
        for g in b.to_pylist():
            hosts = [{"id": h["id"], "legal": h["legal"], "top": h["top"], "sum": h["sum"], "count": h["count"], "same": False} for h in g["hosts"] or []]
            for f in sorted(g["forms"], key=lambda f: (f["visitor"], -f["n"], f["form_id"])):
                known = sum(h["count"] for h in hosts)
                scored, total = [], 0.0
                for h in hosts:
                    like = 1.0 if h["same"] else OMIT * (3.0 if f["legal"] and f["legal"] == h["legal"] else 1.0 if not f["legal"] or not h["legal"] else 0.5)
                    scored.append((h["top"] * like, -h["id"], h))
                    total += h["sum"] * like
                top = max(scored, key=lambda x: x[:2], default=None)
                if top and top[0] / total > 0.5:
                    if f["visitor"]:
                        if known == 1:
                            out.append((f["form_id"], top[2]["id"], top[0] * TYPO, True))
                        continue
                    top[2]["top"] += f["n"]
                    top[2]["sum"] += f["n"]
                    out.append((f["form_id"], top[2]["id"], 1.0, False))
                elif not f["visitor"]:
                    hosts.append({"id": f["form_id"], "legal": f["legal"], "top": float(f["n"]), "sum": float(f["n"]), "count": 1, "same": True})
                    out.append((f["form_id"], f["form_id"], 1.0, False))
    cols = list(zip(*out)) if out else [(), (), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_())], ["form_id", "to_id", "score", "visitor"])


def entities(suppliers: DataFrame, given_names: DataFrame, collective: DataFrame | None = None) -> DataFrame:
    """(supplier_row, display_name, raw_names, identifier) to (supplier_row, entity): the least record of the same entity.

    Records without any letters or digits in their names are left out; null names, null arrays and
    repeated rows are fine; other columns are dropped. ``given_names`` is a small fixed table
    (given_name, short_form), read on the driver up to 10,000 rows and refused beyond. A vendor number
    names one entity, however many spellings stand under it, unless ``collective`` (identifier) lists it or
    its records fall into more than CLASSES unrelated names of which none has more than half of them.
    """
    rows = given_names.limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("given_names is meant to be a small table of short forms")
    given: dict[str, list[str]] = {}
    for r in rows:
        if r["given_name"]:
            g = fold(r["given_name"])
            for k in {g} | ({fold(r["short_form"])} if r["short_form"] else set()):
                given.setdefault(k, [])
                if g not in given[k]:
                    given[k].append(g)
    read = suppliers.select("supplier_row", "display_name", "raw_names", "identifier").mapInPandas(
        _read(given), "supplier_row bigint, kind string, tokens array<string>, given array<string>, initial string, legal string, identifier string"
    )
    read = cut(read)

    # Which token leads: the one that stands first more often than its frequency lets expect.
    each = read.where("kind = 'c'").select("supplier_row", F.posexplode("tokens").alias("at", "token"))
    stats = each.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum((F.col("at") == 0).cast("int")).alias("lead"))
    keyed = stats.where(F.length("token") >= 5).select("token", "df", "lead", F.explode(deletions("token")).alias("key"))
    near = (
        keyed.alias("x").join(keyed.alias("y"), "key").where("x.token <> y.token AND (y.df >= 5 * x.df OR (x.df <= 2 AND (y.df > x.df OR (y.df = x.df AND y.token < x.token))))")
        .select(F.col("x.token").alias("token"), F.col("y.token").alias("other"), F.col("y.df").alias("odf"), F.col("y.lead").alias("olead")).distinct()
    )
    near = cut(near.where((F.abs(F.length("token") - F.length("other")) <= 1) & (F.levenshtein("token", "other") <= 2)))
    # A rare token close to one that is frequent behind others leads no more than that one.
    tamed = near.where("odf >= 5").groupBy("token").agg(F.max_by(F.struct("odf", "olead"), "odf").alias("o"))
    scores = stats.join(tamed, "token", "left").select("token", ((F.col("lead") + F.coalesce("o.olead", F.lit(0)) + 0.5) / (F.col("df") + F.coalesce("o.odf", F.lit(0)) + 1)).alias("score"))
    scored = attach_by_key(each, scores, ["token"], ["supplier_row", "at"])
    lead = scored.groupBy("supplier_row").agg(F.max_by("at", F.struct("score", F.length("token"), -F.col("at"))).alias("lead_at"))
    firm = read.where("kind = 'c'").join(lead, "supplier_row").select(
        "supplier_row", "kind", F.get("tokens", F.col("lead_at")).alias("stem"), F.array_join(F.filter("tokens", lambda _, i: i != F.col("lead_at")), "").alias("trade"), "given", "initial", "legal", "identifier"
    )
    people = read.where("kind = 'p'").select("supplier_row", "kind", F.get("tokens", F.lit(0)).alias("stem"), F.lit("").alias("trade"), F.array_sort("given").alias("given"), "initial", "legal", "identifier")
    people = people.withColumn("legal", F.lit(""))
    spelled = firm.unionByName(people)
    form_cols = ["kind", "stem", "trade", "given", "initial", "legal"]
    forms = cut(spelled.groupBy(*form_cols).agg(F.min("supplier_row").alias("form_id"), F.count(F.lit(1)).alias("n")))

    # Leading names, and trades of one leading name, that are one error from a more frequent one.
    rarer = "y.df >= 5 * x.df OR (x.df <= 2 AND (y.df > x.df OR (y.df = x.df AND y.{0} < x.{0})))"
    stems = forms.groupBy("kind", "stem").agg(F.sum("n").alias("df"))
    keys = stems.where(F.length("stem") >= 5).select("kind", "stem", "df", F.explode(deletions("stem")).alias("key"))
    visits = keys.alias("x").join(keys.alias("y"), ["kind", "key"]).where(f"x.stem <> y.stem AND ({rarer.format('stem')})").select("kind", F.col("x.stem").alias("stem"), F.col("y.stem").alias("host")).distinct()
    trades = forms.where("trade <> ''").groupBy("stem", "trade").agg(F.sum("n").alias("df"))
    begun = trades.where(F.length("trade") >= 4).select("stem", "trade", "df", F.explode(deletions("trade")).alias("key"))
    moves = begun.alias("x").join(begun.alias("y"), ["stem", "key"]).where(f"left(x.trade, 1) <> left(y.trade, 1) AND ({rarer.format('trade')})").select("stem", F.col("x.trade").alias("trade"), F.left(F.col("y.trade"), F.lit(1)).alias("letter")).distinct()
    slim = forms.select("form_id", "n", *form_cols).withColumn("letter", F.left("trade", F.lit(1)))
    members = slim.withColumn("host", F.col("stem")).withColumn("visitor", F.lit(False))
    guests = slim.join(visits, ["kind", "stem"]).withColumn("visitor", F.lit(True)).where(_one_error("stem", "host"))
    movers = slim.drop("letter").join(moves, ["stem", "trade"]).withColumn("host", F.col("stem")).withColumn("visitor", F.lit(True))
    hosted = cut(members.unionByName(guests).unionByName(movers))
    whole = "kind = 'p' OR trade <> ''"
    grouped = hosted.where(whole).repartition(parts(suppliers.sparkSession), "kind", "host", "letter").sortWithinPartitions("kind", "host", "letter")
    schema = "form_id bigint, to_id bigint, score double, visitor boolean"
    linked = cut(grouped.mapInArrow(_attach_all, schema))
    # Companies by leading name and legal form, for the forms that name no trade; these differ in nothing but the legal form.
    firms = slim.where("kind = 'c'")
    target = firms.select(F.col("form_id").alias("to_id"), F.col("stem").alias("host"), "legal")
    # One whose trade is mistyped in its first letter is no company beside the one it moved to.
    moved = linked.where("visitor").join(firms.select("form_id", "stem"), "form_id").join(target, "to_id").where("stem = host").groupBy("form_id").agg(F.max_by("to_id", F.struct("score", -F.col("to_id"))).alias("m"))
    companies = linked.where("NOT visitor").join(firms.select("form_id", "n"), "form_id").join(moved.withColumnRenamed("form_id", "to_id"), "to_id", "left")
    companies = companies.groupBy(F.coalesce("m", "to_id").alias("to_id")).agg(F.sum("n").cast("double").alias("w")).join(target, "to_id")
    sums = companies.groupBy("host", "legal").agg(F.max_by("to_id", F.struct("w", -F.col("to_id"))).alias("id"), F.max("w").alias("top"), F.sum("w").alias("sum"), F.count(F.lit(1)).alias("count"))
    vague = hosted.where(f"NOT ({whole})").groupBy("host").agg(F.collect_list(F.struct("form_id", "n", "legal", "visitor")).alias("forms"))
    hosts = sums.join(vague.select("host"), "host", "left_semi").groupBy("host").agg(F.collect_list(F.struct("id", "legal", "top", "sum", "count")).alias("hosts"))
    linked = cut(linked.unionByName(vague.join(hosts, "host", "left").select("forms", "hosts").mapInArrow(_omitted, schema)))
    chosen = linked.where("visitor").groupBy("form_id").agg(F.max_by("to_id", F.struct("score", -F.col("to_id"))).alias("to_id"))
    edges = linked.where("NOT visitor").select("form_id", "to_id").unionByName(chosen)

    record_form = attach_by_key(spelled, forms.select(*form_cols, "form_id"), form_cols, ["supplier_row"]).select("supplier_row", "identifier", "form_id")
    carried = record_form.where("identifier IS NOT NULL").groupBy("identifier", "form_id").agg(F.count(F.lit(1)).alias("n"))
    if collective is not None:
        carried = carried.join(collective.select("identifier").distinct(), "identifier", "left_anti")
    numbers = carried.select("identifier", "form_id")
    many = cut(numbers.groupBy("identifier").agg(F.count(F.lit(1)).alias("k")).where(f"k > {CLASSES}").select("identifier"))
    if not many.isEmpty():
        kind = components(edges, "form_id", "to_id").withColumnRenamed("node", "form_id")
        classes = carried.join(many, "identifier", "left_semi").join(kind, "form_id", "left").groupBy("identifier", F.coalesce("component", "form_id").alias("c")).agg(F.sum("n").alias("n"))
        held = classes.groupBy("identifier").agg(F.max("n").alias("most"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("names"))
        numbers = numbers.join(held.where(f"names > {CLASSES} AND 2 * most <= all").select("identifier"), "identifier", "left_anti")
    numbered = min_by_key(numbers, ["identifier"], "form_id", "to_id", ["form_id"]).where("form_id <> to_id")
    comp = components(edges.unionByName(numbered.select("form_id", "to_id")), "form_id", "to_id")
    classed = attach_by_key(record_form, comp.withColumnRenamed("node", "form_id"), ["form_id"], ["supplier_row"], how="left")
    return classed.select("supplier_row", F.coalesce("component", "form_id").alias("entity"))


def supplier_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with its entity and the number of other records it is linked with."""
    e = cut(_entities(spark, sf_dir))
    return attach_by_key(e, e.groupBy("entity").agg((F.count(F.lit(1)) - 1).alias("links")), ["entity"], ["supplier_row"])


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(table(spark, sf_dir, "supplier_names"), table(spark, sf_dir, "given_name_forms"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_within(cut(_entities(spark, sf_dir)), "entity", "supplier_row", "supplier_row_a", "supplier_row_b")
