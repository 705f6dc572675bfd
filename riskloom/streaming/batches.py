"""Online scoring by micro-batches over carry-over tables (T1), both dialects, without loss.

Each micro-batch is scored by the batch operators (:func:`~riskloom.operators.scoring.score`), so a user with
a third of all rows is split as in batch.  What one batch leaves for the next lies in
Parquet tables under ``base``, a folder of their own for every version:

* ``pending``: rows that have arrived and are not final yet;
* ``recent``: final rows that a later row's velocity window can still reach (user, device, time, seq);
* ``seen``: the first sighting of every (user, device) pair, one delta a version, merged now and then.

A row is final when the frontier has passed it: the latest time seen so far less ``delay_seconds`` (the
window dialect waits for the end of the row's second).  Final rows are scored together
with the recent rows and the older first sightings of their users.  These are true earlier rows, so
the batch operators find the counts and sightings that they would find in the whole
history, ties included.

Versions: a version is written whole, then marked by a one-row ``commit`` table.  A batch that
failed half-way is run again from the version before it and overwrites its tables; a
batch that is committed already is left alone.  So every row is written once.

Rows behind the frontier on arrival cannot be placed any more: they go to the table
``late`` and are counted, none is dropped.  Rows without a time come last in the history
dialect and are each other's peers in the window dialect; they stay pending until
:meth:`BatchScorer.flush`, which ends the input.  NULL and NaN amounts stay what they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_EXEC, ExecConfig, RuleConfig
from ..functions.timecols import LONG_MAX, LONG_MIN, MICROS_PER_SECOND, OFFSET
from ..operators.context import with_time_keys
from ..operators.joins import join_nullsafe
from ..operators.scoring import score
from ..schema import CANONICAL_COLUMNS, SCORED_HISTORY_COLUMNS, SCORED_WINDOW_COLUMNS

MERGE_EVERY = 16
STATE = ["user_id", "device_id", "timestamp", "seq"]


@dataclass(frozen=True)
class BatchScorer:
    """Scores micro-batches of canonical transactions (with ``seq``); all its tables lie under ``base``."""

    base: str
    rules: RuleConfig
    dialect: str = C.DIALECT_HISTORY
    delay_seconds: float = 0
    exec_cfg: ExecConfig = DEFAULT_EXEC
    blacklist: Callable[[SparkSession], DataFrame] | None = None    # opened anew for every batch

    # ---- versions: batch b writes version 2 (b + 1), a flush the odd one after it

    def _path(self, name: str, version: int) -> str:
        return f"{self.base.rstrip('/')}/{name}/batch={version}"

    def _folders(self, spark: SparkSession, name: str) -> list[int]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.base.rstrip('/')}/{name}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"batch=(\d+)", n))
                      and fs.exists(done(path, f"{n}/_SUCCESS")))

    def _drop(self, spark: SparkSession, name: str, version: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(self._path(name, version))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _write(self, rows: DataFrame, name: str, version: int) -> DataFrame:
        rows.write.mode("overwrite").parquet(self._path(name, version))
        return rows.sparkSession.read.parquet(self._path(name, version))

    def _keep(self, frame: DataFrame) -> DataFrame:
        return with_time_keys(frame, self.dialect)

    def _seen(self, spark: SparkSession, versions: list[int], like: DataFrame) -> DataFrame:
        """First sightings by (user, device): the least of (time, seq) over the deltas."""
        if not versions:
            return like.limit(0)
        paths = [self._path("seen", v) for v in versions]
        rows = spark.read.option("basePath", f"{self.base.rstrip('/')}/seen").parquet(*paths).drop("batch")
        return _first_of_pairs(self._keep(rows))

    # ---- one version

    def step(self, rows: DataFrame, batch_id: int) -> None:
        """Score a micro-batch; for ``writeStream.foreachBatch``."""
        self._advance(rows.sparkSession, rows.select(*_own(CANONICAL_COLUMNS, rows)), 2 * (int(batch_id) + 1), False)

    def flush(self, spark: SparkSession) -> None:
        """End of input: every pending row is final."""
        done = self._folders(spark, "commit")
        if done:
            self._advance(spark, None, done[-1] | 1, True)

    def _advance(self, spark: SparkSession, arrived: DataFrame | None, version: int, last: bool) -> None:
        done = self._folders(spark, "commit")
        if version in done:
            return
        before = max((v for v in done if v < version), default=None)
        old = spark.read.parquet(self._path("commit", before)).first() if before is not None else None
        frontier = old["frontier"] if old else LONG_MIN
        pending = spark.read.parquet(self._path("pending", before)) if old else None

        n_in = n_late = 0
        if arrived is not None:
            # written first: the source is read once, and a retry replaces it
            rows = self._write(arrived, "arrived", version)
            keyed = self._keep(rows)
            behind = F.coalesce(F.col("_us") <= F.lit(frontier), F.lit(False))
            n_in, n_late, latest = keyed.agg(F.count(F.lit(1)), F.count_if(behind), F.max("_us")).first()
            if n_late:
                self._write(keyed.where(behind).select(*_own(CANONICAL_COLUMNS, keyed)), "late", version)
            on_time = keyed.where(~behind).select(*_own(CANONICAL_COLUMNS, keyed))
            pending = on_time if pending is None else pending.unionByName(on_time)
            if latest is not None:
                frontier = max(frontier, int(latest) - int(self.delay_seconds * MICROS_PER_SECOND))
        if self.dialect == C.DIALECT_WINDOW and not last and frontier > LONG_MIN:
            frontier = (frontier + 1) // MICROS_PER_SECOND * MICROS_PER_SECOND - 1     # the end of a whole second
        if last:
            frontier = LONG_MAX
        final = F.lit(True) if last else F.coalesce(F.col("_us") <= F.lit(frontier), F.lit(False))
        pending = self._keep(pending)
        self._write(pending.where(~final).select(*_own(CANONICAL_COLUMNS, pending)), "pending", version)
        ready = pending.where(final).select(*_own(CANONICAL_COLUMNS, pending))

        # what the users of the final rows left before: recent rows, and first sightings older than those
        deltas = [v for v in self._folders(spark, "seen") if v <= (before or 0)]
        whole = [v for v in deltas if v in self._folders(spark, "seen_whole")]
        if whole:
            deltas = [v for v in deltas if v >= whole[-1]]
        seen = self._seen(spark, deltas, ready.select(*_own(STATE, ready)))
        recent = spark.read.parquet(self._path("recent", before)) if old else ready.select(*_own(STATE, ready)).limit(0)
        reach = old["reach"] if old else None
        older = seen
        if reach is not None:        # sightings that `recent` does not hold
            older = self._keep(seen).where(F.coalesce(F.col("_us") < F.lit(reach), F.lit(False))).select(*_own(STATE, seen))
        users = ready.select("user_id").distinct()
        context = join_nullsafe(recent.unionByName(older), users, ["user_id"], "left_semi")
        work = self._write(ready.withColumn("_final", F.lit(True)).unionByName(
            context.withColumn("_final", F.lit(False)), allowMissingColumns=True), "work", version)
        columns = SCORED_WINDOW_COLUMNS if self.dialect == C.DIALECT_WINDOW else SCORED_HISTORY_COLUMNS
        scored = score(work, self.rules, self.dialect, self.exec_cfg, rows_upper_bound=work.count(),
                       blacklist=self.blacklist(spark) if self.blacklist else None)
        n_out = self._write(scored.where("_final").select(*_own(columns, work)), "out", version).count()

        # a later row's time is above the frontier, so its window reaches back no further than this
        window = (self.rules.window_seconds + 1) * MICROS_PER_SECOND
        reach = frontier - window if frontier > LONG_MIN + window else LONG_MIN
        final_rows = work.where("_final").select(*_own(STATE, work))
        held = self._keep(recent.unionByName(final_rows))
        self._write(held.where(F.coalesce(F.col("_us") >= F.lit(reach), F.lit(True))).select(*_own(STATE, held)), "recent", version)
        fresh = _first_of_pairs(self._keep(final_rows))
        if len(deltas) >= MERGE_EVERY:
            merged = _first_of_pairs(self._keep(seen.unionByName(fresh)))
            self._write(merged, "seen", version)
            self._write(merged.limit(0), "seen_whole", version)      # later versions begin here
        else:
            known = seen.select("user_id", "device_id")
            self._write(join_nullsafe(fresh, known, ["user_id", "device_id"], "left_anti"), "seen", version)
        facts = [(version, frontier, reach, n_in, n_late, n_out)]
        self._commit(spark.createDataFrame(facts, "version long, frontier long, reach long, n_in long, n_late long, "
                                                  "n_out long").coalesce(1), version)
        for name in ("pending", "recent"):
            for v in self._folders(spark, name):
                if before is not None and v < before:
                    self._drop(spark, name, v)
        for name in ("arrived", "work"):
            self._drop(spark, name, version)

    def _commit(self, facts: DataFrame, version: int) -> None:
        self._write(facts, "commit", version)

    # ---- results

    def _committed(self, spark: SparkSession, name: str) -> DataFrame | None:
        done = set(self._folders(spark, "commit"))
        paths = [self._path(name, v) for v in self._folders(spark, name) if v in done]
        if not paths:
            return None
        return spark.read.option("basePath", f"{self.base.rstrip('/')}/{name}").parquet(*paths).drop("batch")

    def scores(self, spark: SparkSession) -> DataFrame | None:
        """The scored rows of all committed versions."""
        return self._committed(spark, "out")

    def late_rows(self, spark: SparkSession) -> DataFrame | None:
        return self._committed(spark, "late")

    def progress(self, spark: SparkSession) -> DataFrame | None:
        """One row a version: ``version, frontier, reach, n_in, n_late, n_out``."""
        return self._committed(spark, "commit")

    def start(self, stream_tx: DataFrame, available_now: bool = True):
        """Start the query on a stream of transactions; its checkpoint lies under ``base`` too."""
        writer = stream_tx.writeStream.foreachBatch(self.step).option(
            "checkpointLocation", f"{self.base.rstrip('/')}/checkpoint")
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def _first_of_pairs(keyed: DataFrame) -> DataFrame:
    """The first row of every (user, device) pair by (time, seq), NULL times last."""
    own = _own(["timestamp", "seq"], keyed)
    first = F.min(F.struct("_usnl", "seq", *[c for c in own if c != "seq"])).alias("first")
    return keyed.groupBy("user_id", "device_id").agg(first).select(
        "user_id", "device_id", *[F.col(f"first.{c}").alias(c) for c in own])


def _own(columns: list[str], frame: DataFrame) -> list[str]:
    """``columns``, and the times' offsets where the frame has them."""
    return [*columns, OFFSET] if OFFSET in frame.columns else list(columns)
