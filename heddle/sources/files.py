"""Files through the file system that Spark itself uses, so that a local path and a shared one read and write alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first bytes of a file."""
    fs, p = _fs(spark, path)
    f = fs.open(p)
    try:
        return bytes(f.readNBytes(size))
    finally:
        f.close()


def walk(spark: SparkSession, root: str) -> list[str]:
    """Every file under a folder, or the file itself, sorted; paths come back as they were asked for, with a scheme only if they had one."""
    fs, p = _fs(spark, root)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        u = it.next().getPath()
        found.append(u.toString() if "://" in root else u.toUri().getPath())
    return sorted(found)


def put(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written whole and then renamed into its place."""
    fs, p = _fs(spark, path)
    _, t = _fs(spark, path + ".part")
    f = fs.create(t, True)
    f.write(bytearray(text.encode("utf-8")))
    f.close()
    fs.delete(p, False)
    fs.rename(t, p)


def get(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if there is none."""
    fs, p = _fs(spark, path)
    return head(spark, path, 1 << 20).decode("utf-8") if fs.exists(p) else None
