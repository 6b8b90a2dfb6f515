"""Every registered query of the core, with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalogue_analytics as analytics
from . import catalogue_consolidate as consolidate
from . import catalogue_files as files
from . import catalogue_groups as groups
from . import catalogue_more_sql as more
from . import catalogue_text as text
from . import catalogue_widen as widen
from .operators import references


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p5_found": references.p5_found, "p5_report": references.p5_report, **consolidate.QUERIES, **widen.QUERIES, **text.QUERIES, **analytics.QUERIES, **groups.QUERIES, **files.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**references.SQL, **consolidate.SQL, **widen.SQL, **text.SQL, **analytics.SQL, **more.SQL, **groups.SQL, **files.SQL}
