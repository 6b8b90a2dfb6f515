"""Groups attached back to lines, the registry of groups across runs, residues for review, and suppliers of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.skew import attach_by_key
from .group import MIN_COHESION, group_confidence, group_id

OTHER = "Other"
# Words that make a label say nothing by themselves.
GENERIC = ["service", "services", "material", "materials", "equipment", "supply", "supplies", "work", "works", "product", "products", "goods", "item", "items", "other", "various", "general", "misc"]


def weak_label(label: Column) -> Column:
    """Whether a label has no word but generic ones (P10)."""
    words = F.filter(T.tokens(T.lookup_key(F.coalesce(label, F.lit("")))), lambda w: ~w.isin(T.STOPWORDS))
    return F.forall(words, lambda w: w.isin(GENERIC))


def meaningful(c: Column, noise: list[str], stop: list[str]) -> Column:
    """Whether a fragment says anything: no noise, and a word of three letters or more that is neither code nor stopword."""
    words = F.filter(T.tokens(c), lambda w: ~T.is_code_token(w) & ~F.lower(w).isin(stop))
    return ~T.is_noise(c, noise) & F.exists(words, lambda w: F.length(w) >= 3)


def registry(rows: DataFrame) -> DataFrame:
    """(bucket, signature, label, run, ord) to one row per bucket and signature with its first label, id and run.

    The first by run and ``ord`` counts; blank labels and signatures register nothing.
    """
    named = rows.where((F.trim("label") != "") & (F.col("signature") != "") & F.col("bucket").isNotNull())
    first = named.groupBy("bucket", "signature").agg(F.min(F.struct("run", "ord", "label")).alias("f")).select("bucket", "signature", F.col("f.label").alias("label"), F.col("f.run").alias("first_seen_run"))
    return first.withColumn("group_id", group_id(F.col("bucket"), F.col("label")))


def merge_registry(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old registry with the signatures it doesn't know; a known one keeps its first label, id and run.

    A new signature whose label stands in its bucket already gets the same id, since the id is made of both.
    """
    fresh = new.join(old.select("bucket", "signature"), ["bucket", "signature"], "left_anti")
    return old.withColumn("is_new", F.lit(False)).unionByName(fresh.withColumn("is_new", F.lit(True)))


def attach_groups(lines: DataFrame, groups: DataFrame, row_id: str) -> DataFrame:
    """Each line (bucket, signature) with label, group_id and cohesion of its group, and its confidence; Other where there is none.

    ``groups`` has bucket, signature, label, group_id, cohesion, members and upstream. A cohesion below the least is Other
    with confidence 0. Rows in equal rows out; a signature of a third of all lines is spread over slots.
    """
    got = attach_by_key(lines, groups, ["bucket", "signature"], [row_id], how="left")
    none = F.col("label").isNull() | (F.coalesce("cohesion", F.lit(0.0)) < MIN_COHESION)
    conf = group_confidence(F.coalesce("cohesion", F.lit(0.0)), F.coalesce("members", F.lit(1)), F.col("upstream"), ~weak_label(F.col("label")), none)
    return got.withColumns({"confidence": conf, "label": F.when(none, OTHER).otherwise(F.col("label")), "group_id": F.when(none, "").otherwise(F.col("group_id")), "is_other": none})


def appended(source: DataFrame, values: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """A source as it came, with the appended columns behind its own, by row id; a name that clashes gets the prefix ``ai_``."""
    have = set(source.columns)
    named = {c: c if c not in have else f"ai_{c}" for c in columns}
    return source.join(values.select(row_id, *[F.col(c).alias(n) for c, n in named.items()]), row_id, "left").select(*source.columns, *named.values())


def residue(rows: DataFrame, confidence: str, text: str, floor: float) -> DataFrame:
    """Rows of too little confidence that have two words or more: what goes to a reader (P09). A null confidence counts as 0."""
    return rows.where((F.coalesce(confidence, F.lit(0.0)) < floor) & (F.size(T.tokens(F.coalesce(text, F.lit("")))) >= 2))


def adjudicate(rows: DataFrame, score: str, row_id: str, threshold: float, width: float, most: int = 200) -> DataFrame:
    """The ``most`` rows nearest to a threshold within a band around it, nearest first, ties by id (P11); the top-k is the feature."""
    away = F.round(F.abs(F.col(score) - threshold), 6)
    return rows.where(F.col(score).between(threshold - width, threshold + width)).withColumn("distance", away).orderBy("distance", row_id).limit(most)


def supplier_of_lines(lines: DataFrame, row_id: str, name: str, number: str, overrides: DataFrame, winners: DataFrame) -> DataFrame:
    """Each line with its supplier: the name's key, then the key that its vendor number goes by, then an override of either.

    ``overrides`` (name, canonical) and ``winners`` (number, supplier) have one row a key. Blank names and numbers match nothing.
    """
    own = lines.select(row_id, T.supplier_key(F.coalesce(name, F.lit(""))).alias("own"), F.coalesce(number, F.lit("")).alias("number"))
    numbered = attach_by_key(own, winners.where("number <> ''").select("number", F.col("supplier").alias("by_number")), ["number"], [row_id], how="left")
    key = numbered.withColumn("name", F.coalesce("by_number", F.nullif(F.col("own"), F.lit(""))))
    chained = attach_by_key(key, overrides.select("name", "canonical"), ["name"], [row_id], how="left")
    via = F.when(F.col("canonical").isNotNull(), "override").when(F.col("by_number").isNotNull(), "number").when(F.col("name").isNotNull(), "name").otherwise("none")
    return chained.select(row_id, F.coalesce("canonical", "name", F.lit("")).alias("supplier"), via.alias("via"))


def survivors(pairs: DataFrame, spend: DataFrame) -> DataFrame:
    """(k, other) likely duplicates and (k, spend) to duplicate and survivor: the larger spend stays, of equal ones the first key.

    A supplier that several would absorb goes to the one of largest spend (J16).
    """
    s = spend.groupBy("k").agg(F.coalesce(F.sum("spend"), F.lit(0)).alias("spend"))
    p = pairs.join(s.withColumnRenamed("spend", "sk"), "k").join(s.select(F.col("k").alias("other"), F.col("spend").alias("so")), "other")
    left = F.col("sk") >= F.col("so")  # k is before other
    d = p.select(F.when(left, F.col("other")).otherwise(F.col("k")).alias("duplicate"), F.when(left, F.col("k")).otherwise(F.col("other")).alias("survivor"), F.greatest("sk", "so").alias("spend"))
    return d.groupBy("duplicate").agg(F.min(F.struct((-F.col("spend")).alias("s"), F.col("survivor"))).alias("m")).select("duplicate", "m.survivor")
