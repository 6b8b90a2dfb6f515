"""Catalogue matching and mining: retrieval by character n-grams, constraint scoring, candidate profiles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import text as T
from ..operators.skew import salt
from ..session import cut, parts

# Thresholds, penalties and weights.
HIGH, ACCEPT, MINIMUM, REPORT, TYPE_PENALTY, SPEC_PENALTY, SEMANTIC, LEXICAL = 0.80, 0.65, 0.50, 0.40, 0.55, 0.70, 0.60, 0.40
TOP_K, RETRIEVAL_MULTIPLIER = 5, 4
# Least tasks that share the queries, and the items; most queries, and items, of a task.
BLOCKS, SPANS, BLOCK, SPAN = 3, 4, 50_000, 50_000
MIN_TIMES, MIN_SPEND, TOLERANCE = 3, 1_000, 0.25
EMPTY_HEADS = ["work", "service", "services", "item", "items", "set", "unit", "part", "parts", "supply", "supplies", "kit"]


def char_grams(c: Column, least: int = 3, most: int = 5) -> Column:
    """Character n-grams of each word with a blank on both sides."""
    words = F.transform(T.tokens(T.lookup_key(c)), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    sizes = F.array(*[F.lit(n) for n in range(least, most + 1)])
    per = lambda w: F.flatten(F.transform(sizes, lambda n: F.when(F.length(w) >= n, F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, n))).otherwise(F.array().cast("array<string>"))))
    return F.flatten(F.transform(words, per))


def tfidf(docs: DataFrame, key: str, terms: Column, space: DataFrame | None = None) -> DataFrame:
    """(key, term, w): tf 1+ln, idf ln((1+n)/(1+df))+1 over ``space`` (or the rows themselves), unit length."""
    tf = docs.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg((1 + F.log(F.count(F.lit(1)).cast("double"))).alias("tf"))
    if space is None:
        n = docs.select(F.countDistinct(key).alias("n"))
        space = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(space, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def idf(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    n = docs.select(F.countDistinct(key).alias("n"))
    df = docs.select(key, F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def sparse_topk(queries: DataFrame, items: DataFrame, space: DataFrame, weights: list[float], k: int, digits: int, same: bool = False, blocks: int | None = None, spans: int | None = None) -> DataFrame:
    """(g, q, i, score): the k items of largest tf-idf cosine for each query of a group, ties by item; terms shared only.

    The three tables have id and an array of terms for each view (t0, t1…), the first two a group g as well; ``space`` has the
    documents that idf counts, and the cosines of the views are added by ``weights``, at most 1. With ``same`` an id isn't
    its own neighbour. A task has a share of the queries and of the items and sums one query at a time in an array of its
    items, so no pair and no term of a pair is a row; each task returns a few more than k, ranked together after rounding.
    """
    blocks, spans = blocks or max(BLOCKS, -(-queries.count() // BLOCK)), spans or max(SPANS, -(-items.count() // SPAN))
    n = space.count()
    hashed = lambda v: F.transform(f"t{v}", lambda x: F.xxhash64(F.lit(v), x)).alias("terms")
    long = lambda df, *cols: df.select(*cols, F.inline(F.array(*[F.struct(F.lit(v).alias("view"), hashed(v)) for v in range(len(weights))])))
    df = long(space, "id").select(F.explode(F.array_distinct("terms")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    df = df.groupBy(F.pmod("t", F.lit(64)).alias("c")).agg(F.collect_list(F.struct("t", "n")).alias("x")).select(F.col("x.t").alias("terms"), F.col("x.n").alias("df"))
    every = lambda most: F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    slot = lambda most: F.pmod(F.xxhash64("id"), F.lit(most)).cast("int")
    none = F.lit(None).cast("array<bigint>").alias("df")
    q = long(queries, "g", "id").select("g", F.lit(0).alias("kind"), slot(blocks).alias("b"), every(spans).alias("f"), "view", "id", "terms", none)
    i = long(items, "g", "id").select("g", F.lit(1).alias("kind"), every(blocks).alias("b"), slot(spans).alias("f"), "view", "id", "terms", none)
    groups = items.select("g").distinct().withColumn("b", every(blocks)).withColumn("f", every(spans))
    known = groups.crossJoin(df).select("g", F.lit(2).alias("kind"), "b", "f", F.lit(0).alias("view"), F.lit(None).cast(items.schema["id"].dataType).alias("id"), "terms", "df")
    task = q.unionByName(i).unionByName(known).repartition(parts(queries.sparkSession), "g", "b", "f")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _nearest_of_task(pd.concat(batches, ignore_index=True), n, weights, k + 8, digits, same)

    kind = {f.name: f.dataType.simpleString() for f in items.schema.fields}
    return task.groupBy("g", "b", "f").applyInPandas(run, f"g {kind['g']}, q {queries.schema['id'].dataType.simpleString()}, i {kind['id']}, score double")


def _vectors(rows: pd.DataFrame, terms: np.ndarray, idf: np.ndarray, weights: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids in order, and (document, term, w) by document: unit vectors by view, scaled so that products add up by weight."""
    at, ids = pd.factorize(rows["id"], sort=True)
    doc = np.repeat(at * len(weights) + rows["view"].to_numpy(), [len(x) for x in rows["terms"]])
    flat = np.concatenate([*rows["terms"], np.empty(0, np.int64)])
    t = np.minimum(np.searchsorted(terms, flat), len(terms) - 1)
    ok = terms[t] == flat
    cell, count = np.unique(doc[ok] * len(terms) + t[ok], return_counts=True)
    doc, t = cell // len(terms), cell % len(terms)
    w = (1 + np.log(count)) * idf[t]
    norm = np.sqrt(np.bincount(doc, w * w, len(ids) * len(weights)))
    scale = np.sqrt(np.array(weights))
    return np.asarray(ids), doc // len(weights), t, w / norm[doc] * scale[doc % len(weights)]


def _nearest_of_task(rows: pd.DataFrame, n: int, weights: list[float], most: int, digits: int, same: bool) -> Iterator[pd.DataFrame]:
    q, i, known = (rows[rows["kind"] == k] for k in range(3))
    if not len(q) or not len(i) or not len(known):
        return
    terms, df = np.concatenate(list(known["terms"])), np.concatenate(list(known["df"]))
    order = np.argsort(terms)
    terms, df = terms[order], df[order]
    idf = np.log((1 + n) / (1 + df)) + 1
    items, at, t, iw = _vectors(i, terms, idf, weights)
    order = np.argsort(t, kind="stable")
    at, iw = at[order], iw[order]
    begin = np.searchsorted(t[order], np.arange(len(terms) + 1))
    ids, doc, qt, qw = _vectors(q, terms, idf, weights)
    ends = np.searchsorted(doc, np.arange(len(ids) + 1))
    lo, hi = begin[qt].tolist(), begin[qt + 1].tolist()
    values = qw.tolist()
    place = {x: j for j, x in enumerate(items)} if same else {}
    acc, group, out, waiting = np.zeros(len(items)), rows["g"].iloc[0], [], 0

    def ready() -> pd.DataFrame:
        return pd.DataFrame({"g": group, "q": np.concatenate([x[0] for x in out]), "i": np.concatenate([x[1] for x in out]), "score": np.concatenate([x[2] for x in out])})

    for d in range(len(ids)):
        for e in range(ends[d], ends[d + 1]):
            x, y = lo[e], hi[e]
            if x < y:
                acc[at[x:y]] += iw[x:y] * values[e]
        if ids[d] in place:
            acc[place[ids[d]]] = 0
        c = np.flatnonzero(acc)
        v = np.minimum(acc[c], 1.0)
        if len(c) > most:
            least = v[np.argpartition(-v, most - 1)[most - 1]] - 10.0**-digits
            c, v = c[v >= least], v[v >= least]
            first = np.lexsort((c, -np.round(v, digits)))[:most]
            c, v = c[first], v[first]
        out.append((np.full(len(c), ids[d]), items[c], v))
        waiting += len(c)
        acc[:] = 0
        if waiting > 200_000:
            yield ready()
            out, waiting = [], 0
    if out:
        yield ready()


def lexical_topk(queries: DataFrame, items: DataFrame, k: int = 5, floor: float = 0.0) -> DataFrame:
    """(q, i, score, rank): the k items with the largest cosine of (q, terms) and (i, terms), ties by item; idf is that of the items."""
    one = lambda df, key: df.select(F.lit(0).alias("g"), F.col(key).alias("id"), F.col("terms").alias("t0"))
    i = one(items, "i")
    near = sparse_topk(one(queries, "q"), i, i, [1.0], k, 6).select("q", "i", F.round("score", 6).alias("score"))
    return top_k(near.where(F.col("score") > floor), ["q"], [F.desc("score"), F.col("i")], k)


def shortlist(q: DataFrame, i: DataFrame, k: int = TOP_K * RETRIEVAL_MULTIPLIER) -> DataFrame:
    """(q, i, score): the k items lexically nearest to each query text, and every item that shares a code, with its lexical score."""
    text, item = char_grams(F.col("text")), char_grams(F.col("item"))
    near = lexical_topk(q.select("q", text.alias("terms")), i.select("i", item.alias("terms")), k).select("q", "i", "score")
    of = lambda df, key, c: df.select(key, F.explode(X.item_codes(c)).alias("code"))
    coded = of(q, "q", "text").join(of(i, "i", "item"), "code").select("q", "i").distinct().join(near, ["q", "i"], "left_anti")
    # Vectors as rows of terms only for the texts and items that share a code.
    coded, space = cut(coded), idf(i, "i", item)
    qv, iv = tfidf(q.join(coded.select("q").distinct(), "q", "left_semi"), "q", text, space), tfidf(i.join(coded.select("i").distinct(), "i", "left_semi"), "i", item, space)
    dot = coded.join(qv, "q").join(iv.withColumnRenamed("w", "iw"), ["i", "term"]).groupBy("q", "i").agg(F.round(F.sum(F.col("w") * F.col("iw")), 6).alias("score"))
    return near.unionByName(coded.join(dot, ["q", "i"], "left").select("q", "i", F.coalesce("score", F.lit(0.0)).alias("score")))


def top_k(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def first_of_each(rows: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The first k rows of each key, found per slot before the keys meet, so that a hot key is no one task's."""
    part = Window.partitionBy(key, "__h_slot").orderBy(order)
    few = rows.withColumn("__h_slot", salt(order)).withColumn("__h_k", F.row_number().over(part)).where(F.col("__h_k") <= k).drop("__h_slot", "__h_k")
    return few.withColumn("__h_k", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("__h_k") <= k).drop("__h_k")


def united(semantic: DataFrame, lexical: DataFrame) -> DataFrame:
    """Candidates (query, item, score) of two retrievals in one table, 0 for the view that didn't find them."""
    a, b = semantic.withColumnRenamed("score", "semantic"), lexical.withColumnRenamed("score", "lexical")
    return a.join(b, ["query", "item"], "full").select("query", "item", F.coalesce("semantic", F.lit(0.0)).alias("semantic"), F.coalesce("lexical", F.lit(0.0)).alias("lexical"))


def blended(members: DataFrame, group: str, key: str, views: list[tuple[Column, float]], k: int) -> DataFrame:
    """(group, key, other, score, rank): the k other members of its group nearest to each, by cosines of the views' terms blended by weight.

    Idf counts each distinct key once. Terms meet inside the group only, and no pair is a row.
    """
    total = sum(w for _, w in views)
    cols = [F.col(key).alias("id"), *[c.alias(f"t{v}") for v, (c, _) in enumerate(views)]]
    placed = members.select(F.coalesce(group, F.lit("\x00")).alias("g"), *cols)
    near = sparse_topk(placed, placed, members.select(key).distinct().select(*cols), [w / total for _, w in views], k, 5, same=True)
    out = near.select(F.nullif("g", F.lit("\x00")).alias(group), F.col("q").alias(key), F.col("i").alias("other"), F.round(F.greatest(F.lit(0.0), "score"), 5).alias("score"))
    return top_k(out, [group, key], [F.desc("score"), F.col("other")], k)


def content_words(c: Column) -> Column:
    """Content words in order: no codes, no stopwords, by lemma."""
    return T.lemmas(c)


def head(c: Column) -> Column:
    """The last content word, stepping over words that say nothing by themselves; null if there is none."""
    words = F.filter(content_words(c), lambda w: ~w.isin(EMPTY_HEADS))
    return F.coalesce(F.try_element_at(words, F.lit(-1)), F.try_element_at(content_words(c), F.lit(-1)))


def type_compatible(a: Column, b: Column, service: list[str]) -> Column:
    """Whether two descriptions can mean one type of thing.

    Two services with equal heads must share a subject besides (the documented intent); else a missing head,
    equal heads, or a head that occurs in the other's content will do; else six in ten of the smaller content.
    """
    ca, cb, ha, hb = content_words(a), content_words(b), head(a), head(b)
    both = F.arrays_overlap(ca, F.lit(service)) & F.arrays_overlap(cb, F.lit(service))
    sa, sb = F.array_except(ca, F.lit(service)), F.array_except(cb, F.lit(service))
    subject = (F.size(sa) == 0) | (F.size(sb) == 0) | F.arrays_overlap(sa, sb)
    overlap = F.size(F.array_intersect(ca, cb)) / F.greatest(F.least(F.size(ca), F.size(cb)), F.lit(1))
    return F.when(both, subject).otherwise(ha.isNull() | hb.isNull() | (ha == hb) | F.array_contains(cb, ha) | F.array_contains(ca, hb) | (overlap >= 0.6))


def match_score(semantic: Column, lexical: Column, code: Column, compatible: Column, agreement: Column) -> Column:
    """Blend of the views that are positive, lifted by a shared code, cut by type and specification, four decimals."""
    ws, wl = F.when(semantic > 0, SEMANTIC).otherwise(0.0), F.when(lexical > 0, LEXICAL).otherwise(0.0)
    base = F.when(ws + wl > 0, (semantic * ws + lexical * wl) / (ws + wl)).otherwise(0.0)
    s = F.when(code, F.greatest(base, F.lit(0.92))).otherwise(base)
    s = F.when(~compatible, s * TYPE_PENALTY).otherwise(s)
    s = F.when(agreement == F.lit(False), s * SPEC_PENALTY).when(agreement == F.lit(True), F.least(F.lit(1.0), s + 0.05)).otherwise(s)
    return F.round(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)), 4)


def match_band(score: Column) -> Column:
    return F.when(score >= HIGH, "High").when(score >= ACCEPT, "Medium").when(score >= MINIMUM, "Low").otherwise("None")


def match_confidence(score: Column, semantic: Column, lexical: Column, code: Column, compatible: Column, agreement: Column) -> Column:
    c = F.when(code, F.least(F.lit(1.0), score + 0.08)).otherwise(score)
    c = F.when(~compatible, c * 0.6).otherwise(c)
    c = F.when(agreement == F.lit(True), F.least(F.lit(1.0), c + 0.06)).when(agreement == F.lit(False), c * 0.65).otherwise(c)
    c = F.when((semantic >= 0.7) & (lexical >= 0.5), F.least(F.lit(1.0), c + 0.05)).otherwise(c)
    return F.bround(F.round(F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)) * 100, 9)).cast("int")


def profiles(lines: DataFrame, key: str) -> DataFrame:
    """Buying profile per description: times, spend, suppliers, periods, price stability (1 less deviation over mean, null below two prices)."""
    mean, dev = F.avg("price"), F.stddev_pop("price")
    return lines.groupBy(key).agg(
        F.count(F.lit(1)).alias("times"), F.sum(F.col("spend").cast("decimal(18,4)")).cast("double").alias("spend"), F.countDistinct("supplier").alias("suppliers"), F.countDistinct("period").alias("periods"),
        F.when((F.count("price") >= 2) & (mean > 0), F.round(F.greatest(F.lit(0.0), 1 - dev / mean), 3)).alias("stability"), F.bool_or("standard").alias("already_standard"),
    )


def candidate_score(times: Column, spend: Column, stability: Column, periods: Column, standard: Column) -> tuple[Column, Column]:
    """(score 0 to 100, Yes, Review or No) of a profile as a catalogue candidate."""
    freq = F.least(F.lit(1.0), F.log1p(times.cast("double")) / math.log(21))
    money = F.when(spend >= MIN_SPEND, F.least(F.lit(1.0), F.log1p(spend) / math.log1p(MIN_SPEND * 50))).otherwise(0.0)
    raw = freq * 0.35 + money * 0.25 + F.coalesce(stability, F.lit(0.5)) * 0.25 + F.least(F.lit(1.0), periods / 4.0) * 0.15
    s = F.bround(F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)) * 100, 9)).cast("int")
    s = F.when(times < MIN_TIMES, 0).when(standard, F.least(s, F.lit(40))).otherwise(s)
    return s, F.when(times < MIN_TIMES, "No").when(s >= 60, "Yes").when(s >= 40, "Review").otherwise("No")


def calibration(rows: DataFrame, score: str) -> DataFrame:
    """How many rows reach each threshold from 0.20 to 1.00 by 0.05."""
    steps = F.transform(F.sequence(F.lit(4), F.lit(20)), lambda i: i / 20)
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    hist = rows.groupBy(F.least(F.floor(F.col(score) * 20 + 1e-9), F.lit(20)).alias("b")).agg(F.count(F.lit(1)).alias("c")).groupBy().agg(F.collect_list(F.struct("b", "c")).alias("h"))
    reach = lambda t: F.aggregate(F.filter("h", lambda x: x["b"] >= F.round(t * 20)), F.lit(0).cast("bigint"), lambda a, x: a + x["c"])
    return hist.crossJoin(n).select("n", "h", F.explode(steps).alias("threshold")).select("threshold", reach(F.col("threshold")).alias("matched"), "n")


def nearest_rank(rows: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """The value at index round(share × (n − 1)), half to even, of the sorted values; exact.

    Values are counted first; positions are cumulative counts over the distinct values, range-partitioned
    sums of slots standing before each, so that no task sorts all rows.
    """
    v = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    lohi = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("c").alias("n"))
    slot = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 255)).otherwise(0)
    s = v.crossJoin(F.broadcast(lohi)).withColumn("slot", slot)
    before = s.groupBy("slot").agg(F.sum("c").alias("sc")).withColumn("start", F.sum("sc").over(Window.orderBy("slot")) - F.col("sc"))  # at most 256 rows
    p = s.join(F.broadcast(before.select("slot", "start")), "slot").withColumn("end", F.col("start") + F.sum("c").over(Window.partitionBy("slot").orderBy("v")))
    want = F.explode(F.array(*[F.lit(x) for x in shares])).alias("share")
    return p.select("*", want).withColumn("at", F.bround(F.col("share") * (F.col("n") - 1))).where((F.col("at") < F.col("end")) & (F.col("at") >= F.col("end") - F.col("c"))).select("share", F.col("v").alias("value"))


def nearest(vectors: DataFrame, queries: DataFrame, key: str, vec: str, floor: float, k: int, block: int = 2_048) -> DataFrame:
    """(query, item, score, rank): the k vectors of largest cosine for each query, itself left out, exact.

    Queries are read in blocks of a fixed number; each block goes to the workers and meets all vectors in one
    pass, in which every batch keeps its k best per query; the final rank is over those. Null vectors are left out.
    """
    import numpy as np
    import pandas as pd

    spark, out = vectors.sparkSession, None
    rows = vectors.where(F.col(vec).isNotNull()).select(F.col(key).cast("bigint").alias("item"), F.col(vec).alias("v"))
    some: list = []

    def scan(block_rows: list) -> DataFrame:
        ids = np.array([r[0] for r in block_rows])
        m = np.array([r[1] for r in block_rows], np.float64)
        sent = spark.sparkContext.broadcast((ids, m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)))

        def run(batches):
            qi, qm = sent.value
            for b in batches:
                x = np.stack(b["v"]).astype(np.float64)
                s = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)) @ qm.T
                own = b["item"].to_numpy()
                s[own[:, None] == qi[None, :]] = -2
                top = np.argsort(-s, axis=0, kind="stable")[: k + 8]
                i, j = top.T.ravel(), np.repeat(np.arange(len(qi)), len(top))
                keep = s[i, j] >= floor
                yield pd.DataFrame({"query": qi[j][keep], "item": own[i][keep], "score": s[i, j][keep]})

        return rows.mapInPandas(run, "query bigint, item bigint, score double")

    for r in queries.where(F.col(vec).isNotNull()).select(F.col(key).cast("bigint"), vec).toLocalIterator():
        some.append(r)
        if len(some) == block:
            out, some = scan(some) if out is None else out.unionByName(scan(some)), []
    if some:
        out = scan(some) if out is None else out.unionByName(scan(some))
    if out is None:
        return spark.createDataFrame([], "query bigint, item bigint, score double, rank int")
    return top_k(out.withColumn("score", F.round("score", 6)), ["query"], [F.desc("score"), F.col("item")], k)
