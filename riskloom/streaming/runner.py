"""Running the stream scorer over files: sources, end of input, results.

A file-source stream over the events table is scored batch by batch with
:class:`~riskloom.streaming.batches.BatchScorer`.  Its tables, the results and the
checkpoint live under the session's reliable checkpoint directory (the
cluster's shared folder), never in a machine-local folder.

Finite runs: when the data is used up, the rows that are still pending are final; no marker row is needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_EXEC, ExecConfig, RuleConfig
from ..session import ensure_checkpoint_dir
from ..sources.tables import transactions_from_event_frame
from .batches import BatchScorer


def scratch_dir(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _covering_delay(spark: SparkSession, sf_dir: str) -> int:
    """Seconds as long as the time span of the events (one row to the driver)."""
    ts = F.col("ts").cast("timestamp").cast("long")
    lo, hi = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").agg(F.min(ts), F.max(ts)).first()
    return (hi or 0) - (lo or 0) + 1


def score_events_stream(spark: SparkSession, sf_dir: str, rules: RuleConfig, base: str | None = None,
                        max_files_per_trigger: int | None = None, delay_seconds: float | None = None,
                        dialect: str = C.DIALECT_HISTORY, exec_cfg: ExecConfig = DEFAULT_EXEC):
    """Run an ``availableNow`` stream over ``events`` to its end; returns (query, path of the scored rows).

    Over several batches the default delay covers the input's whole time span, because files
    may come in any order; a caller who knows their order can give a shorter one.
    """
    base = base or scratch_dir(spark, "stream-score")
    if delay_seconds is None:
        delay_seconds = _covering_delay(spark, sf_dir) if max_files_per_trigger else 0
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    events_glob = f"{sf_dir.rstrip('/')}/{{events.parquet}}"  # a file source needs a dir or a glob
    reader = spark.readStream.schema(spark.read.parquet(events_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    tx = transactions_from_event_frame(reader.parquet(events_glob), spark, sf_dir)
    scorer = BatchScorer(base, rules, dialect, delay_seconds, exec_cfg)
    query = scorer.start(tx)
    query.awaitTermination()
    scorer.flush(spark)
    return query, f"{base}/out"


def score_events_stream_table(spark: SparkSession, sf_dir: str, rules: RuleConfig,
                              dialect: str = C.DIALECT_HISTORY) -> DataFrame:
    _, out = score_events_stream(spark, sf_dir, rules, dialect=dialect)
    return spark.read.parquet(out).drop("batch")
