"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from . import copies, garbled, language, leaks, listings, names, spans, terms, tokens


def queries() -> dict:
    return {
        "p1_found": garbled.p1_found,
        "p1_restored": garbled.p1_restored,
        "p2_found": names.p2_found,
        "p2_entities": names.supplier_entities,
        "p3_found": copies.p3_found,
        "p3_contents": copies.p3_contents,
        "p4_found": terms.p4_found,
        "p4_terms": terms.p4_terms,
        "p4_ngrams": terms.p4_ngrams,
        "p6_found": listings.p6_found,
        "p6_products": listings.listing_products,
        "p7_found": language.p7_found,
        "p7_labels": language.p7_labels,
        "p8_ids": tokens.p8_ids,
        "p9_found": leaks.p9_found,
        "p10_found": spans.p10_found,
        "p10_share": spans.p10_share,
        "p10_removed": spans.p10_removed,
    }


def oracle_sql() -> dict[str, str]:
    return copies.SQL | terms.SQL | leaks.SQL | spans.SQL
