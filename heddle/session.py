"""Session defaults and the few things every operator needs from the session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "heddle", master: str | None = None, **conf: str) -> SparkSession:
    """A local session with the settings the engine is tested with; on a cluster pass none and submit as usual."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": os.environ.get("HEDDLE_SHUFFLE", "8"),
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster
    without it is refused, since a machine-local folder would be lost with its executor.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a local session without one gets a folder that goes with it."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="heddle-checkpoint-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
        sc.setCheckpointDir(shared)
    return sc._jsc.sc().getCheckpointDir().get()


def parts(spark: SparkSession) -> int:
    """Number of shuffle partitions, for a repartition before Python: one by number isn't coalesced by size, which says nothing of its cost."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that Python stages find it wherever they run."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_heddle_shipped", False):
        return
    root = Path(__file__).parent
    # Spark serves the file from the driver; executors fetch it, none reads this folder.
    path = Path(tempfile.mkdtemp(prefix="heddle-")) / "heddle.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*")):
            if p.suffix in {".py", ".json"}:
                z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._heddle_shipped = True
