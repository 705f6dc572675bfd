"""Scoring a date-partitioned transaction table slice by slice.

A slice is a run of whole days.  Scoring one reads the partitions ``[from - window, to]`` and a
*snapshot*: the first sighting of every (user, device) pair before the slice.  These are true earlier rows, so the
batch operators find the counts and sightings that they would find in the whole table: slices
scored one after the other equal one run over everything.

Tables under ``base``, a folder of their own for every version: ``scores`` (the slice's rows), ``seen`` (the
snapshot after the slice: the least (time, seq) of a pair, old and new) and a one-row ``commit``,
written last.  A slice that failed half-way is run again and overwrites its tables.  :meth:`SliceScorer.rewind`
takes back the slices from a day on, for a backfill; what it took back is scored again.

Days are days of the dialect's own order key (the wall clock, or the instant), so days and times
never disagree.  Rows without a time lie in a partition of their own and are scored by :meth:`SliceScorer.finish`:
last in the history dialect, each other's peers in the window dialect.  A row that comes for a day
already scored needs a rewind to that day.  A snapshot is rewritten with every slice: one row a pair.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_EXEC, ExecConfig, RuleConfig
from ..functions.timecols import MICROS_PER_SECOND, OFFSET
from ..schema import CANONICAL_COLUMNS, SCORED_HISTORY_COLUMNS, SCORED_WINDOW_COLUMNS
from .context import with_time_keys
from .joins import join_nullsafe
from .scoring import score

DAY = "day"
EPOCH = date(1970, 1, 1)
DAY_MICROS = 86_400 * MICROS_PER_SECOND
STATE = ["user_id", "device_id", "timestamp", "seq"]


def write_by_day(tx: DataFrame, path: str, dialect: str) -> None:
    """Canonical transactions (with ``seq``) as Parquet partitioned by day.

    Dealt by ranges of (day, seq): a task writes few days, and a day with a third of all rows many tasks.
    """
    columns = [*CANONICAL_COLUMNS, OFFSET] if OFFSET in tx.columns else CANONICAL_COLUMNS
    days = F.expr(f"cast((_us - pmod(_us, {DAY_MICROS})) div {DAY_MICROS} as int)")
    dated = with_time_keys(tx, dialect).withColumn(DAY, F.date_add(F.lit(EPOCH), days))
    dated = dated.select(*columns, DAY)
    (dated.repartitionByRange(DAY, "seq").write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/rows"))
    # columns and types stand apart, so that a table without rows can be read too
    dated.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")


def first_sightings(rows: DataFrame, dialect: str) -> DataFrame:
    """The first row of every (user, device) pair by (time, seq), NULL times last."""
    keyed = with_time_keys(rows, dialect)
    rest = [c for c in rows.columns if c not in ("user_id", "device_id", "seq")]
    first = F.min(F.struct("_usnl", "seq", *rest)).alias("first")
    return keyed.groupBy("user_id", "device_id").agg(first).select(
        *[c if c in ("user_id", "device_id") else F.col(f"first.{c}").alias(c) for c in rows.columns])


@dataclass(frozen=True)
class SliceScorer:
    """Scores the table at ``table`` (see :func:`write_by_day`) in slices; its own tables lie under ``base``."""

    table: str
    base: str
    rules: RuleConfig
    dialect: str = C.DIALECT_HISTORY
    exec_cfg: ExecConfig = DEFAULT_EXEC

    # ---- versions

    def _path(self, name: str, version: int) -> str:
        return f"{self.base.rstrip('/')}/{name}/slice={version}"

    def _files(self, spark: SparkSession, name: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.base.rstrip('/')}/{name}")
        return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark: SparkSession) -> list[int]:
        """Committed versions, oldest first."""
        path, fs = self._files(spark, "commit")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        done = spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"slice=(\d+)", n))
                      and fs.exists(done(path, f"{n}/_SUCCESS")))

    def progress(self, spark: SparkSession) -> DataFrame | None:
        """One row a committed slice: ``version, first_day, last_day, n_rows`` (no days: the rows without a time)."""
        paths = [self._path("commit", v) for v in self.versions(spark)]
        return spark.read.parquet(*paths) if paths else None

    def _last(self, spark: SparkSession):
        done = self.versions(spark)
        return spark.read.parquet(self._path("commit", done[-1])).first() if done else None

    # ---- input

    def _rows(self, spark: SparkSession) -> DataFrame:
        schema = spark.read.parquet(f"{self.table}/schema").schema
        return spark.read.schema(schema).parquet(f"{self.table}/rows")

    def read_days(self, spark: SparkSession, first: date | None, last: date | None) -> DataFrame:
        """The partitions of days in ``[first, last]``; only their files are listed in the plan."""
        rows = self._rows(spark)
        if first is None:
            return rows.where(F.col(DAY).isNull()).drop(DAY)
        return rows.where(F.col(DAY).between(F.lit(first), F.lit(last))).drop(DAY)

    def days(self, spark: SparkSession) -> list[date]:
        """Days that the table has, from the partition names' values: one row a day to the driver."""
        rows = self._rows(spark).select(DAY).where(F.col(DAY).isNotNull()).distinct().sort(DAY)
        return [r[0] for r in rows.collect()]

    def context(self, spark: SparkSession, first: date, snapshot: DataFrame | None) -> DataFrame:
        """Rows before ``first`` that the slice's rows can need: the last window, and sightings older than it."""
        reach = timedelta(minutes=max(self.rules.velocity_window_minutes, 0)) + timedelta(seconds=1)
        start = (first - EPOCH).days * DAY_MICROS - reach // timedelta(microseconds=1)
        # a window before `first` begins ceil(reach / day) days earlier
        earliest = first - timedelta(days=-(-reach // timedelta(days=1)))
        recent = self.read_days(spark, earliest, first - timedelta(days=1))
        columns = [*STATE, OFFSET] if OFFSET in recent.columns else STATE
        recent = with_time_keys(recent, self.dialect).where(F.col("_us") >= F.lit(start)).select(*columns)
        if snapshot is None:
            return recent
        older = with_time_keys(snapshot, self.dialect).where(F.col("_us") < F.lit(start)).select(*columns)
        return recent.unionByName(older)

    # ---- slices

    def score_days(self, spark: SparkSession, first: date, last: date) -> int:
        """Score the days ``[first, last]``; returns the number of rows.

        Slices come in order: one must begin after the last committed slice, and no day of the table may be left between.
        """
        if first > last:
            raise ValueError(f"slice ends before it begins: {first} > {last}")
        old = self._last(spark)
        if old and (old["last_day"] is None or first <= old["last_day"]):
            raise ValueError(f"days up to {old['last_day'] or 'the end'} are scored already; rewind first")
        left = [d for d in self.days(spark) if d < first and (old is None or d > old["last_day"])]
        if left:
            raise ValueError(f"days not scored yet before {first}: from {left[0]}")
        return self._run(spark, old, first, last)

    def finish(self, spark: SparkSession) -> int:
        """Score the rows without a time, after all days."""
        old = self._last(spark)
        if old and old["last_day"] is None:
            raise ValueError("the table is finished already; rewind first")
        left = [d for d in self.days(spark) if old is None or d > old["last_day"]]
        if left:
            raise ValueError(f"days not scored yet: from {left[0]}")
        return self._run(spark, old, None, None)

    def _run(self, spark: SparkSession, old, first: date | None, last: date | None) -> int:
        version = old["version"] + 1 if old else 0
        fresh = self.read_days(spark, first, last)
        own = [*CANONICAL_COLUMNS, OFFSET] if OFFSET in fresh.columns else list(CANONICAL_COLUMNS)
        columns = [*STATE, OFFSET] if OFFSET in fresh.columns else STATE
        fresh = fresh.select(*own)
        snapshot = spark.read.parquet(self._path("seen", old["version"])) if old else None
        if first is None:       # rows without a time: no window reaches them, the snapshot says all
            before = snapshot if snapshot is not None else fresh.select(*columns).limit(0)
        else:
            before = self.context(spark, first, snapshot)
        users = fresh.select("user_id").distinct()
        before = join_nullsafe(before, users, ["user_id"], "left_semi")
        work = fresh.withColumn("_final", F.lit(True)).unionByName(
            before.withColumn("_final", F.lit(False)), allowMissingColumns=True)
        work.write.mode("overwrite").parquet(self._path("work", version))      # read by the count and by every branch
        work = spark.read.parquet(self._path("work", version))
        scored = score(work, self.rules, self.dialect, self.exec_cfg, rows_upper_bound=work.count())
        out = SCORED_WINDOW_COLUMNS if self.dialect == C.DIALECT_WINDOW else SCORED_HISTORY_COLUMNS
        out = [*out, OFFSET] if OFFSET in work.columns else out
        scored.where("_final").select(*out).write.mode("overwrite").parquet(self._path("scores", version))

        seen = first_sightings(work.where("_final").select(*columns), self.dialect)
        if snapshot is not None:
            seen = first_sightings(snapshot.unionByName(seen), self.dialect)
        seen.write.mode("overwrite").parquet(self._path("seen", version))
        n_rows = spark.read.parquet(self._path("scores", version)).count()
        fact = spark.createDataFrame([(version, first, last, n_rows)],
                                     "version int, first_day date, last_day date, n_rows long")
        path, fs = self._files(spark, f"work/slice={version}")
        fs.delete(path, True)
        fact.coalesce(1).write.mode("overwrite").parquet(self._path("commit", version))
        return n_rows

    def rewind(self, spark: SparkSession, day: date) -> list[int]:
        """Take back every slice that holds ``day`` or a later day, the newest first; returns their versions."""
        gone = []
        for version in reversed(self.versions(spark)):
            end = spark.read.parquet(self._path("commit", version)).first()["last_day"]
            if end is not None and end < day:
                break
            path, fs = self._files(spark, f"commit/slice={version}")
            fs.delete(path, True)
            gone.append(version)
        return gone

    def scores(self, spark: SparkSession) -> DataFrame | None:
        """The scored rows of all committed slices."""
        paths = [self._path("scores", v) for v in self.versions(spark)]
        return spark.read.parquet(*paths) if paths else None
