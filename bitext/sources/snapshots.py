"""Versioned table snapshots with a "latest" pointer and retention.

Each version is a Parquet directory ``<dir>/v=<N>``.  The pointer ``<dir>/LATEST``
is a small text file that one atomic rename replaces, so a reader finds the old or
the new version, never none.  File operations go through the Hadoop file layer of
the session, so the folder may be on any shared storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KEEP_LAST = 1  # fixed value: versions that stay


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def list_versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v="):
            out.append(int(name[2:]))
    return sorted(out)


def _files(spark: SparkSession, path: str):
    """The FileContext of a path: its rename can replace the target in one step."""
    jvm = spark._jvm
    uri = _path(spark, path).toUri()
    conf = spark._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf) if uri.getScheme() else (
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf))


def _point_to(spark: SparkSession, root: str, version: int) -> None:
    fs, tmp = _fs(spark, f"{root}/LATEST.{uuid.uuid4().hex[:12]}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(str(version).encode()))
    finally:
        out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    names = spark.sparkContext._gateway.new_array(options, 1)
    names[0] = options.OVERWRITE
    _files(spark, root).rename(tmp, _path(spark, f"{root}/LATEST"), names)  # raises if it fails


def write_snapshot(df: DataFrame, root: str, version: int, keep_last: int = KEEP_LAST) -> None:
    """Write version N, move the pointer to it, drop every version <= N - keep_last."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    _point_to(spark, root, version)
    fs, _ = _fs(spark, root)
    for v in list_versions(spark, root):
        if v <= version - keep_last:
            fs.delete(_path(spark, f"{root}/v={v}"), True)


def latest_version(spark: SparkSession, root: str) -> int | None:
    fs, p = _fs(spark, f"{root}/LATEST")
    if not fs.exists(p):
        return None
    lines = spark.read.text(f"{root}/LATEST").collect()  # one short line
    return int(lines[0]["value"])


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Read the latest version (or a chosen one)."""
    v = latest_version(spark, root) if version is None else version
    if v is None:
        raise FileNotFoundError(f"no snapshot under {root}")
    return spark.read.parquet(f"{root}/v={v}")
