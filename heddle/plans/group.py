"""Purchase groups: entries of one wording, average-linkage clusters per bucket, labels, registry, confidence."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut, parts

# Distance of the cut, cohesion below which a group is Other, words of a label, groups wanted.
DISTANCE, MIN_COHESION, LABEL_WORDS, MIN_GROUPS, MAX_GROUPS = 0.35, 0.45, 5, 10, 50
# Parts of a similarity of 1 (divisible by all numbers to 22), neighbours listed at a time, bytes of sums held.
UNIT, AHEAD, ROOM = 232_792_560, 32, 150_000_000


def entries(lines: DataFrame) -> DataFrame:
    """(bucket, text, spend, confidence, ord) lines to one row per bucket and signature; the shortest text stands for it."""
    e = lines.withColumn("signature", T.signature("text")).where(F.col("signature") != "")
    return e.groupBy("bucket", "signature").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("spend").cast("decimal(18,4)")).alias("spend"), F.sum("confidence").alias("confidence_total"), F.min_by("text", F.struct(F.length("text"), F.col("ord"))).alias("text")
    )


def _grams(text: str) -> set[str]:
    words = text.split("|")
    return set(words)


class _Kept:
    """Sums of the similarities of some clusters to every point, as many as fit ``ROOM``; the smallest cluster goes first."""

    def __init__(self, n: int):
        self.most, self.sums, self.by_size = ROOM // (8 * max(n, 1)), {}, []

    def put(self, cluster: int, born: int, size: int, sums: np.ndarray) -> None:
        self.sums[cluster] = (born, sums)
        heapq.heappush(self.by_size, (size, cluster, born))
        while len(self.sums) > self.most:
            _, c, b = heapq.heappop(self.by_size)
            if c in self.sums and self.sums[c][0] == b:
                del self.sums[c]

    def pop(self, cluster: int) -> np.ndarray | None:
        return self.sums.pop(cluster, (0, None))[1]


def _merges(n: int, row: Callable[..., np.ndarray], cut: float, ahead: int = AHEAD) -> list[tuple[float, int, int]]:
    """The merges of average linkage from singletons, in order, down to mean similarity ``cut``: (mean, cluster, cluster that goes into it).

    The pair of the largest mean above the cut merges; among equals the first in index order, a cluster standing at its
    first member. ``row`` gives the similarities of a point to all, or to those before a place, in whole parts of ``UNIT``, so sums are exact and so are ties.
    No matrix is held. A cluster never changes, a merge makes a new one, which lists the best ``ahead`` of the clusters
    before it, and lists again when those are used up. Clusters whose means don't exceed the cut never will, since
    the mean of a union is at most the larger of the two. So the largest pair heads the list of its younger cluster.
    """
    gone = 2 * n + 1
    born = np.zeros(n, np.int64)  # 0: a single point; gone: merged into another
    size = np.ones(n)
    at = np.arange(n)
    members = [[i] for i in range(n)]
    lists: list[tuple[np.ndarray, np.ndarray, bool] | None] = [None] * n
    heap: list[tuple[float, int, int, int, int]] = []
    kept, merges = _Kept(n), []

    def sums(c: int) -> np.ndarray:
        s = kept.pop(c)
        if s is None:
            s = row(members[c][0]).astype(np.float64)
            for i in members[c][1:]:
                s += row(i)
        return s

    def enlist(c: int, s: np.ndarray) -> None:
        """The best of the clusters before ``c``, best first, from its sums by point."""
        t = born[c]
        if t:
            s = np.bincount(at, weights=s, minlength=n)
            s[c] = 0
            near = np.flatnonzero(s > least * size[c] * size)
            near = near[born[near] < t]
        else:
            near = np.flatnonzero(s[:c] > least)
            near = near[born[near] == 0]
        mean = s[near] / (size[c] * size[near] * UNIT)
        if len(near) > ahead:
            some = mean >= np.partition(mean, len(mean) - ahead)[len(mean) - ahead]
            best, mean = near[some], mean[some]
        else:
            best = near
        some = mean > cut
        best, mean = best[some], mean[some]
        order = np.lexsort((np.maximum(best, c), np.minimum(best, c), -mean))[:ahead]
        lists[c] = (best[order].astype(np.int32), mean[order], len(near) > len(order))
        head(c)

    def head(c: int) -> None:
        near, mean, more = lists[c]
        there = born[near] <= born[c]
        k = int(there.argmax()) if len(near) else 0
        if len(near) and there[k]:
            lists[c] = (near[k:], mean[k:], more)
            o = int(near[k])
            heapq.heappush(heap, (-float(mean[k]), min(c, o), max(c, o), c, int(born[c])))
        elif len(near) and more:
            s = sums(c)
            if len(members[c]) > 1:
                kept.put(c, int(born[c]), len(members[c]), s)
            enlist(c, s)
        else:
            lists[c] = None

    least = cut * UNIT * (1 - 1e-9)
    for i in range(n):
        enlist(i, row(i, i))
    while heap:
        mean, i, j, c, t = heapq.heappop(heap)
        if born[c] != t:
            continue
        if born[i + j - c] > t:
            head(c)
            continue
        merges.append((-mean, i, j))
        s = sums(i) + sums(j)
        at[members[j]] = i
        members[i] += members[j]
        members[j] = lists[j] = None
        size[i] += size[j]
        born[i], born[j] = len(merges), gone
        kept.put(i, len(merges), len(members[i]), s)
        enlist(i, s)
    return merges


def _labels(n: int, merges: list[tuple[float, int, int]]) -> list[int]:
    """The cluster of each point after the merges, numbered by its first member."""
    into = {j: i for _, i, j in merges}
    label = list(range(n))
    for k in range(n):
        if k in into:
            label[k] = label[into[k]]  # a cluster goes into one before it
    return label


def _linkage(sim: np.ndarray, cut: float) -> tuple[list[int], list[tuple[float, int, int]]]:
    """Average linkage of a matrix of similarities: cluster of each point, and the merges in order, down to similarity ``cut``."""
    merges = _merges(len(sim), lambda i, before=None: np.rint(sim[i, :before] * UNIT), cut)
    return _labels(len(sim), merges), merges


def similarity_matrix(signatures: list[str]) -> np.ndarray:
    """Jaccard of the lemmas of every two signatures."""
    row = _jaccard([sorted(_grams(s)) for s in signatures])
    return np.array([row(i) / UNIT for i in range(len(signatures))])


def _places(words: list[list[str]]) -> dict[str, np.ndarray]:
    rows: dict[str, list[int]] = {}
    for i, ws in enumerate(words):
        for w in ws:
            rows.setdefault(w, []).append(i)
    return {w: np.array(r, np.int32) for w, r in rows.items()}


def _jaccard(words: list[list[str]]) -> Callable[..., np.ndarray]:
    """The Jaccard of one list of words with all (or those before a place), in whole parts of ``UNIT``.

    A place in the table of all values is summed from the places of the words; a word of many lists has a row of its own.
    """
    n = np.array([len(ws) for ws in words], np.int64)
    longest = int(n.max()) if len(n) else 0
    step = longest + 1
    kind = np.min_scalar_type(step * step)
    n = n.astype(kind)
    at, dense = _places(words), {}
    for w in [w for w, places in at.items() if 32 * len(places) > len(words)]:
        dense[w] = np.zeros(len(words), kind)
        dense[w][at.pop(w)] = step
    tables: dict[int, np.ndarray] = {}

    def row(i: int, before: int | None = None) -> np.ndarray:
        if (m := len(words[i])) not in tables:
            both = np.arange(m + 1)[:, None]
            tables[m] = np.rint(UNIT * both / np.maximum(m + np.arange(step)[None, :] - both, 1)).ravel()
        code = n[:before].copy()
        for w in words[i]:
            if w in dense:
                code += dense[w][:before]
            else:
                places = at[w] if before is None else at[w][: np.searchsorted(at[w], before)]
                code[places] += kind.type(step)
        return tables[m].take(code)

    return row


def _parted(signatures: list[str], least: float) -> list[np.ndarray]:
    """The connected components of the signatures whose similarity exceeds ``least``, members in order; found by shared lemmas."""
    words = [sorted(_grams(s)) for s in signatures]
    at = _places(words)
    n = np.array([len(ws) for ws in words])
    new = np.ones(len(words), bool)
    out = []
    for first in range(len(words)):
        if not new[first]:
            continue
        new[first] = False
        part, todo = [first], [first]
        while todo:
            i = todo.pop()
            for w in words[i]:
                at[w] = at[w][new[at[w]]]
            met = np.concatenate([at[w] for w in words[i]])
            if not len(met):
                continue
            near, both = np.unique(met, return_counts=True)
            near = near[both / (n[i] + n[near] - both) > least]
            new[near] = False
            part += near.tolist()
            todo += near.tolist()
        out.append(np.sort(part))
    return out


def cluster_bucket(signatures: list[str], distance: float = DISTANCE, adaptive: bool = True) -> list[int]:
    """The cluster of each signature (numbered by its first member); with ``adaptive`` the cut is bisected for 10 to 50 groups."""
    return _clustered(signatures, distance, adaptive)[0]


def _clustered(signatures: list[str], distance: float, adaptive: bool) -> tuple[list[int], list[float]]:
    """The cluster of each signature and the cohesion of that cluster: the mean similarity of its pairs, 0.5 for a single member.

    The merges are made once, down to the loosest cut; every other cut is a prefix of them. Clusters of different
    components at that cut have a mean similarity below it and never merge, so each component is merged by
    itself, and the cut is chosen over the merges of all of them.
    """
    order = sorted(range(len(signatures)), key=lambda i: signatures[i])
    names = [signatures[i] for i in order]
    loosest = 1 - (0.70 if adaptive else distance) - 1e-12
    merges = []
    for part in _parted(names, loosest - 1e-6):
        if len(part) > 1:
            row = _jaccard([sorted(_grams(names[k])) for k in part])
            merges += [(v, int(part[i]), int(part[j])) for v, i, j in _merges(len(part), row, loosest)]

    def groups_at(d: float) -> int:
        return len(order) - sum(v > 1 - d for v, _, _ in merges)

    d = distance
    if adaptive and len(order) >= 2 * MIN_GROUPS:
        lo, hi = 0.10, 0.70
        groups = groups_at(d)
        for _ in range(10):
            if MIN_GROUPS <= groups <= MAX_GROUPS:
                break
            lo, hi = (lo, d) if groups < MIN_GROUPS else (d, hi)
            d = (lo + hi) / 2
            groups = groups_at(d)
    merges = [m for m in merges if m[0] > 1 - d]
    size, within = [1] * len(order), [0.0] * len(order)
    for v, i, j in merges:
        within[i] += within[j] + v * size[i] * size[j]
        size[i] += size[j]
    label = _labels(len(order), merges)
    out, cohesion = [0] * len(order), [0.5] * len(order)
    for place, i in enumerate(order):
        out[i] = c = label[place]
        if size[c] > 1:
            cohesion[i] = within[c] / (size[c] * (size[c] - 1) / 2)
    return out, cohesion


def clusters(e: DataFrame, distance: float = DISTANCE, adaptive: bool = True) -> DataFrame:
    """entries with ``cluster``, its ``members`` and ``cohesion``; a bucket is a group of distinct wordings, not of lines, and is clustered whole.

    A bucket is one task, whose memory grows with its wordings and not with their pairs, and whose time with their
    square. Buckets are spread over the partitions by range, so that few of them meet in one.
    """
    e = cut(e)  # read twice, for the ranges too
    cols = [f"{f.name} {f.dataType.simpleString()}" for f in e.schema.fields]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sig = pdf["signature"].tolist()
        names = sorted(sig)
        of, cohesion = _clustered(sig, distance, adaptive)
        members = np.bincount(of)
        return pdf.assign(cluster=[names[c] for c in of], members=members[of], cohesion=cohesion)

    c = e.repartitionByRange(parts(e.sparkSession), "bucket").groupBy("bucket").applyInPandas(run, ", ".join([*cols, "cluster string", "members bigint", "cohesion double"]))
    return c.withColumn("cohesion", F.round("cohesion", 6))


def consensus_label(members: DataFrame, keys: list[str], text: str, weight: str, share: float = 0.5, most: int = LABEL_WORDS) -> DataFrame:
    """The label of each group: lemmas in more than half of the weight, at least two, in their mean order."""
    pos = members.select(*keys, F.col(weight).alias("w"), F.posexplode(T.lemmas(text)).alias("at", "lemma"))
    freq = pos.groupBy(*keys, "lemma").agg(F.sum("w").alias("f"), F.sum(F.col("at") * F.col("w")).alias("p"))
    total = members.groupBy(*keys).agg(F.sum(weight).alias("total"))
    w = Window.partitionBy(*keys)
    r = freq.join(total, keys).withColumn("rank", F.row_number().over(w.orderBy(F.desc("f"), "lemma"))).withColumn("agreed", F.sum((F.col("f") > share * F.col("total")).cast("int")).over(w))
    r = r.where(F.col("rank") <= F.greatest(F.col("agreed"), F.lit(2))).withColumn("o", F.row_number().over(w.orderBy(F.col("p") / F.col("f"), F.desc("f"), "lemma"))).where(F.col("o") <= most)
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "lemma"))), lambda s: s["lemma"]), " ")
    return r.groupBy(*keys).agg(T.sentence_case(words).alias("label"))


def group_id(bucket: Column, label: Column) -> Column:
    """Stable id: the first ten hexadecimal digits of the hash of bucket and label, in upper case."""
    return F.concat(F.lit("G-"), F.upper(F.substring(T.stable_hash(bucket, T.lookup_key(label)), 1, 10)))


def group_confidence(coh: Column, distinct: Column, upstream: Column, specific: Column, other: Column) -> Column:
    """.40 cohesion, .20 support, .25 upstream confidence, .15 a specific label; 0 for Other."""
    support = F.least(F.lit(1.0), F.log1p(distinct.cast("double")) / math.log(9))
    raw = F.least(F.greatest(coh, F.lit(0.0)), F.lit(1.0)) * 0.40 + support * 0.20 + F.coalesce(upstream / 100.0, F.lit(0.5)) * 0.25 + specific.cast("double") * 0.15
    return F.when(other, 0).otherwise(F.bround(F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)) * 100, 9)).cast("int"))


def known(e: DataFrame, registry: DataFrame) -> DataFrame:
    return e.join(registry.select("bucket", "signature"), ["bucket", "signature"], "left_semi")


def unknown(e: DataFrame, registry: DataFrame) -> DataFrame:
    return e.join(registry.select("bucket", "signature"), ["bucket", "signature"], "left_anti")
