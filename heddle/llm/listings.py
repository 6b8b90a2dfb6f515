"""Product listings describing the same item (problem 6), by title combination voting.

A title becomes tokens: sizes, ratings and quantities in base units, and words. Equal token sets
are folded and vote together with their number. Of each title the k-combinations of its words
are generated (k up to 3, or as many as keep within ``COMBINATIONS``; all words take part), each
joined with all that is measured of the title, since a combination without one of these can't
tell two products apart. A combination's score grows with the number of titles that hold it, with
more than one seller listing it, and with its length, and falls with the average position of its
words; a word counts by how much it is a name, that is, stands alike in titles and their
translations. Each title is assigned its best combination, which forms the clusters. Verification
parts a cluster by what was measured; clusters whose combinations have the same name and measures
are merged, and one that lacks a measure goes to the only product that has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import comb

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from ..operators.skew import attach_by_key, min_by_key, pairs_within
from ..session import cut, parts, table
from .attributes import read_title
from .garbled import mend

#: Combinations a title may have before k is lowered; with k = 1 there are as many as words.
COMBINATIONS = 200
#: A word's part in the length of a combination is ten to the power of this times its likeness to a name, so kinds of article, which many brands share, don't outvote a name by being frequent.
STEEP = 4


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for row, text, other, lang, seller in zip(b["item_row"], b["description"], b["english_description"], b["language"], b["supplier"]):
            one, two = ((mend(t)[1] if not t.isascii() else t) if isinstance(t, str) else "" for t in (text, other))
            attrs, words = read_title(one)
            more, said = read_title(two)
            have = {a.split(":")[0] for a in attrs}
            attrs += [a for a in more if a.split(":")[0] not in have]
            words = list(dict.fromkeys(words))
            both = isinstance(lang, str) and lang.lower()[:2] in ("fi", "sv", "de", "pl", "no") and bool(said) and one != two
            said = list(dict.fromkeys(said))
            plain = " ".join(sorted(set(re.findall(r"[^\W_]+", (one if re.search(r"[^\W_]", one) else two).lower()))))
            if plain:
                out.append((row, sorted(attrs), words if words else said, said if both else [], both, plain, seller if isinstance(seller, str) and seller.strip() else None))
        yield pd.DataFrame(out, columns=["item_row", "attrs", "words", "said", "both", "plain", "seller"])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word combinations of each folded title, with the length, the average place (in sixths) and the name of each."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.float32(), pa.int32(), pa.string())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows) if rows else ((),) * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["title", "n", "seller", "combo", "len", "at", "name"])

    for b in batches:
        out: list[tuple] = []
        for r in b.to_pylist():
            ws = sorted(r["ws"], key=lambda w: w["at"])
            n, k = len(ws), 1
            while k < min(3, n) and sum(comb(n, j) for j in range(1, k + 2)) <= COMBINATIONS:
                k += 1
            for j in range(1, k + 1):
                for c in combinations(ws, j):
                    top = max(c, key=lambda w: (w["value"], w["w"]))
                    said = " ".join([*sorted(w["w"] for w in c), r["measured"]])
                    out.append((r["title"], r["n"], r["seller"], said, sum(10 ** (STEEP * w["value"]) for w in c), sum(w["at"] for w in c) * 6 // j, top["w"]))
                    if len(out) >= 50_000:
                        yield batch(out)
                        out = []
        yield batch(out)


def products(items: DataFrame) -> DataFrame:
    """(item_row, description, english_description, language, supplier) to (item_row, product): the least row of the same product.

    A listing without a measured attribute or without a word belongs with those of the same words
    and numbers only, so literally equal titles are always of one product; one without any letter or
    digit is left out, as are null and empty titles without a translation; extra columns are dropped.
    """
    t = cut(items.select("item_row", "description", "english_description", "language", "supplier").mapInPandas(_read, "item_row bigint, attrs array<string>, words array<string>, said array<string>, both boolean, plain string, seller string"))

    # How often a word stands alike in the title and in its translation.
    sides = t.where("both").select(F.explode(F.transform(F.array_union("words", "said"), lambda w: F.struct(w.alias("w"), F.array_contains("words", w).cast("int").alias("a"), F.array_contains("said", w).cast("int").alias("b")))).alias("x")).select("x.*")
    shares = sides.groupBy("w").agg(((2 * F.sum(F.col("a") * F.col("b")) + 0.5) / (F.sum("a") + F.sum("b") + 1)).alias("alike"))
    voting = t.where((F.size("attrs") > 0) & (F.size("words") > 0))
    titles = cut(voting.groupBy("attrs", "words").agg(F.min("item_row").alias("title"), F.count(F.lit(1)).alias("n"), F.when(F.min("seller") < F.max("seller"), -1).otherwise(F.when(F.min("seller").isNotNull(), F.hash(F.min("seller"))).bitwiseAND(0x7FFFFFFF)).alias("seller")))
    each = titles.select("title", "n", F.posexplode("words").alias("at", "w"))
    counts = each.groupBy("w").agg(F.sum("n").alias("df")).join(shares, "w", "left").select("w", "df", F.coalesce("alike", F.lit(0.5)).alias("alike"))
    value = F.col("alike") + F.when(F.length("w") >= 5, 1.0).otherwise(0.0) + 0.005 * F.least(F.length("w"), F.lit(10)) - 0.002 * F.log("df")
    weighed = attach_by_key(each, counts, ["w"], ["title", "at"]).withColumn("value", value)
    rows = weighed.groupBy("title").agg(F.collect_list(F.struct("at", "w", "value")).alias("ws")).join(titles.select("title", "n", "seller", F.array_join("attrs", ";").alias("measured")), "title")
    rows = rows.repartition(parts(items.sparkSession), "title")
    combos = rows.select("title", "n", "seller", "measured", "ws").mapInArrow(_combine, "title bigint, n bigint, seller int, combo string, len float, at int, name string")
    # The key serves the vote only; clusters are told apart by name and measures themselves.
    combos = cut(combos.withColumn("key", F.xxhash64("combo")).drop("combo"))
    several = F.coalesce((F.min("seller") < F.max("seller")) | (F.min("seller") < 0), F.lit(False))
    tally = combos.groupBy("key").agg(F.sum("n").alias("freq"), (F.sum(F.col("at") * F.col("n")) / F.sum("n") / 6).alias("avg_at"), several.alias("several"))
    score = F.col("len") * F.log2(1 + F.col("freq")) * F.when(F.col("several"), 1.2).otherwise(1.0) / (10 + F.col("avg_at"))
    best = attach_by_key(combos, tally, ["key"], ["title"]).groupBy("title").agg(F.max_by("name", F.struct(score, "name", "key")).alias("name"))
    voted = cut(titles.join(best, "title").select("title", "attrs", "words", "n", "name"))

    full = voted.groupBy("name", "attrs").agg(F.min("title").alias("product"), F.sum("n").alias("n"))
    # The only product that has one measure more than a cluster.
    larger = full.where("n >= 2").select("name", "product", F.explode(F.transform("attrs", lambda a: F.array_except("attrs", F.array(a)))).alias("attrs"))
    wider = larger.groupBy("name", "attrs").agg(F.min("product").alias("host"), F.count(F.lit(1)).alias("hosts")).where("hosts = 1")
    # One that lacks two measures may go to one that lacks one, so the merges are followed to their end.
    merged = full.join(wider, ["name", "attrs"]).select("product", "host")
    ends = components(merged, "product", "host").select(F.col("node").alias("product"), "component")
    settled = full.join(ends, "product", "left").select("name", "attrs", F.coalesce("component", "product").alias("product"))
    of_title = attach_by_key(voted, settled, ["name", "attrs"], ["title"]).select("attrs", "words", "product")
    grouped = attach_by_key(voting.select("item_row", "attrs", "words"), of_title, ["attrs", "words"], ["item_row"]).select("item_row", "product")
    rest = min_by_key(t.where((F.size("attrs") == 0) | (F.size("words") == 0)).select("item_row", "plain"), ["plain"], "item_row", "product", ["item_row"]).select("item_row", "product")
    return grouped.unionByName(rest)


def listing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing with its product and the number of other listings it is linked with."""
    e = cut(products(table(spark, sf_dir, "reference_items")))
    return attach_by_key(e, e.groupBy("product").agg((F.count(F.lit(1)) - 1).alias("links")), ["product"], ["item_row"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = cut(products(table(spark, sf_dir, "reference_items")))
    return pairs_within(e, "product", "item_row", "item_row_a", "item_row_b")
