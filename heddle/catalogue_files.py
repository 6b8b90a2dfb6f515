"""Round trips through the sources and sinks in the shared folder, with the SQL of what must come back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .session import shared_folder, table
from .sources import sinks, tables

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _folder(s) -> str:
    return f"{shared_folder(s).removeprefix('file:')}/files-{uuid.uuid4().hex}"


def source_csv(s, d):
    """The transactions written as semicolon files and found, sniffed, read, numbered and renamed again."""
    root = _folder(s)
    cols = ["row_no", "document_number", "po_number", "erp_supplier_name", "spend_in_eur"]
    table(s, d, "max_transactions").select(*cols).write.csv(root, header=True, sep=";", quote='"', escape='"', emptyValue="")
    out = None
    for p in tables.discover(root, s):
        one = tables.read_table(s, p)
        one = one.select("row_no", *[F.col(c).alias(f) for f, c in tables.resolve(one.columns).items() if f in ("document_number", "po_number", "supplier_name", "spend")])
        out = one if out is None else out.unionByName(one)
    return out


def sink_jsonl(s, d):
    """The lines as JSON lines with their evidence nested, read back flat."""
    root = _folder(s)
    src = table(s, d, "agent1_unified_lines").select("line_id", "match_tier", "match_score", "evidence_sources")
    sinks.write_jsonl(src, root, {"evidence": ["match_tier", "match_score", "evidence_sources"]})
    return s.read.schema("line_id bigint, evidence struct<match_tier:string,match_score:double,evidence_sources:string>").json(root).select("line_id", "evidence.*")


def sink_stage(s, d):
    """A stage written and taken up by the next one, its columns checked."""
    root = _folder(s)
    sinks.write_stage(table(s, d, "agent2_purchase_groups").select("group_row", "row_id", "spend_eur"), root, "groups")
    return sinks.read_stage(s, root, "groups", ["group_row", "spend_eur"])


def sink_snapshot(s, d):
    """The supplier registry saved twice; the second snapshot is what loads."""
    root = _folder(s)
    t = table(s, d, "supplier_names").select("supplier_key", "display_name")
    sinks.save_snapshot(t.limit(0), root)
    sinks.save_snapshot(t, root)
    return sinks.load_snapshot(s, root, "supplier_key string, display_name string")


QUERIES = {f.__name__: f for f in (source_csv, sink_jsonl, sink_stage, sink_snapshot)}
_t = lambda c: f"coalesce({c}::VARCHAR, '')"
SQL = {
    "source_csv": f"SELECT {_t('row_no')} AS row_no, {_t('document_number')} AS document_number, {_t('po_number')} AS po_number, {_t('erp_supplier_name')} AS supplier_name, {_t('spend_in_eur')} AS spend FROM max_transactions",
    "sink_jsonl": "SELECT line_id, match_tier, match_score, evidence_sources FROM agent1_unified_lines",
    "sink_stage": "SELECT group_row, row_id, spend_eur FROM agent2_purchase_groups",
    "sink_snapshot": "SELECT supplier_key, display_name FROM supplier_names",
}
