"""Reading of free text for the widened table: what the text is about, how sure that is, and its sources put together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import extract as X
from . import text as T


def item_or_service(c: Column, service: list[str], material: list[str]) -> Column:
    """Service or Material by which markers are more; empty on a tie, Unclassified without words."""
    words = T.tokens(T.lookup_key(F.coalesce(c, F.lit(""))))
    s, m = F.size(F.array_intersect(words, F.lit(service))), F.size(F.array_intersect(words, F.lit(material)))
    return F.when(F.size(words) == 0, "Unclassified").when(s > m, "Service").when(m > s, "Material").otherwise("")


def interpretation_confidence(resolved: Column, signals: Column, language_known: Column) -> Column:
    """.7 of the share resolved, .05 a signal up to .25, .05 for a known language; four decimals."""
    raw = 0.7 * F.coalesce(resolved, F.lit(0.0)) + F.least(F.lit(0.25), 0.05 * signals) + F.when(language_known, 0.05).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), raw), 4)


def gather(*sources: Column) -> Column:
    """The sources in order, those that are blank or say what one before said left out."""
    told = F.array(*[F.when(~T.is_blank(s), T.normalise_text(s)) for s in sources])
    keys = F.transform(F.array_compact(told), T.lookup_key)
    return F.filter(F.array_compact(told), lambda x, i: F.array_position(keys, T.lookup_key(x)) == i + 1)


def prose(c: Column | str) -> Column:
    """The text without links, addresses, dimensions, references and part numbers."""
    t = X.scrub(c)
    for pattern in (X.DIMENSION, rf"\b{X.GROUP}(?:-{X.GROUP}){{1,5}}\b", r"\b(?=[A-Za-z./-]*\d)(?=[\d./-]*[A-Za-z])" + X.CODE[2:]):
        t = F.regexp_replace(t, pattern, " ")
    return T.collapse(t)


def proper_nouns(c: Column | str) -> Column:
    """Capitalised words other than the first, sorted."""
    words = T.tokens(c if isinstance(c, Column) else F.col(c))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w, i: (i > 0) & w.rlike(r"^\p{Lu}\p{Ll}+$"))))


def factors(**values: Column) -> Column:
    """The factors of a score as one JSON object with its keys in order."""
    return F.to_json(F.struct(*[values[k].alias(k) for k in sorted(values)]))


def reference_text(c: Column | str, most: int = 200) -> Column:
    """The description up to the first bar, cut at a word where it is longer than ``most`` (S13); a definition of the field, not a read limit."""
    t = T.collapse(F.substring_index(c, " | ", 1))
    head = F.substring(t, 1, most)
    whole = F.substring(t, most + 1, 1).isin("", " ")
    return F.when(F.length(t) <= most, t).otherwise(F.trim(F.when(whole, head).otherwise(F.regexp_replace(head, r" [^ ]*$", ""))))


def exact_cover(word: str, parts: dict[str, str], pieces: int = 3, least: int = 3) -> list[str] | None:
    """The word as up to ``pieces`` known parts without a letter left over, longest head first with backtracking; null if there is none."""
    if not word:
        return []
    if not pieces:
        return None
    for end in range(len(word), least - 1, -1):
        if word[:end] in parts and (rest := exact_cover(word[end:], parts, pieces - 1, least)) is not None:
            return [parts[word[:end]], *rest]
    return None
