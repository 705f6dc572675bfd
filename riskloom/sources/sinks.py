"""Result sinks: the wide CSV table (S4) and nested records.

Writers are plain ``DataFrameWriter`` calls; the caller chooses path, format
and partitioning.  Nothing is collected to the driver.

:func:`publish_scored` writes and counts in one job, and replaces a table in one step: every version is a
folder of its own, and creating the empty file ``_published-<number>-<id>`` makes it the current one.  A write
that is killed leaves the version before it current.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.timecols import OFFSET, iso_time


# CSV timestamps with full microseconds.  The default CSV sink keeps Spark's
# default text (milliseconds, e.g. 2025-10-06T00:15:00.000+01:00), like the
# original scorer's output; pass these options when times carry microseconds
# and the file must read back exactly.
CSV_MICROS_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                      "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_scored(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                 partition_by: list[str] | None = None, options: dict | None = None) -> None:
    if fmt == "csv" and OFFSET in df.columns:
        df = df.withColumn("timestamp", iso_time(df)).drop(OFFSET)     # every time with its own offset
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if options:
        w = w.options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_scored_csv(spark, path: str, schema, options: dict | None = None) -> DataFrame:
    """Read a scored CSV written by :func:`write_scored` back with its declared schema."""
    return spark.read.option("header", True).options(**(options or {})).schema(schema).csv(path)


def write_nested(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Nested result records (``rules_triggered`` array of structs) as JSON lines or Parquet."""
    if fmt not in ("json", "parquet"):
        raise ValueError("nested records need a nested format: json or parquet")
    df.write.mode(mode).format(fmt).save(path)


def _folder(spark, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def published_versions(spark, path: str) -> list[tuple[int, str]]:
    """Number and folder name of the table's published versions, oldest first."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    found = [m for n in names if (m := re.fullmatch(r"_published-(\d+)-([0-9a-f]{32})", n))]
    return sorted((int(m[1]), f"data-{m[2]}") for m in found)


def publish_scored(df: DataFrame, path: str, fmt: str = "csv", partition_by: list[str] | None = None,
                   options: dict | None = None, keep_versions: int = 2) -> dict[str, int]:
    """Write ``df`` as the table's new version and return its summary counts ``total, flagged, ok``.

    The counts are observed on the write itself, so the plan runs once.  Older versions than the
    last ``keep_versions`` are deleted; readers of the one before are not disturbed.  Of two writers at the
    same time the later published one stands, and both versions are whole.
    """
    spark = df.sparkSession
    seen = Observation(f"scored-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("total"),
                         F.count_if(F.col("status") == F.lit(C.STATUS_FLAG)).alias("flagged"))
    version = uuid.uuid4().hex
    write_scored(counted, f"{path.rstrip('/')}/data-{version}", fmt, "errorifexists", partition_by, options)
    total, flagged = (int(seen.get[k]) for k in ("total", "flagged"))
    files, where = _folder(spark, path)
    older = published_versions(spark, path)
    number = older[-1][0] + 1 if older else 1
    marker = spark._jvm.org.apache.hadoop.fs.Path(where, f"_published-{number:08d}-{version}")
    files.create(marker, False).close()
    for n, name in older[:max(0, len(older) + 1 - keep_versions)]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(where, f"_published-{n:08d}-{name[len('data-'):]}"), False)
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(where, name), True)
    return {"total": total, "flagged": flagged, "ok": total - flagged}


def read_published(spark, path: str, schema, fmt: str = "csv", options: dict | None = None) -> DataFrame:
    """The table's current version."""
    versions = published_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no published version in {path}")
    current = f"{path.rstrip('/')}/{versions[-1][1]}"
    if fmt == "csv":
        return read_scored_csv(spark, current, schema, options)
    return spark.read.format(fmt).options(**(options or {})).schema(schema).load(current)
