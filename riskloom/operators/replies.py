"""Durable calls of a caller's function: one reply a prompt, kept in the shared checkpoint folder.

An explainer or summariser is slow and may cost money, so a prompt that has been answered is not
asked again: not for equal prompts, not when a task is repeated after a lost executor, and not by a
later run that names the same table.

* The table is a folder of Parquet files ``prompt_key, reply``; the key is the prompt's SHA-256.  Its
  first two hex digits choose one of 256 ``bucket`` folders.
* Distinct prompts without a reply (an anti join) are dealt by bucket.  A task asks ``flush_every`` at a
  time over ``concurrency`` threads and writes their replies as one file (written under a hidden name,
  then renamed) before it goes on.  A repeated task first reads what its buckets hold.
* A call that raises or returns None leaves no reply: its rows get the fallback text, and the next
  run asks again.

What remains is the gap between an answer and its file: a task lost there asks at most
``flush_every`` prompts a second time.  A speculative copy of a task does the same; set
``spark.speculation`` off where calls are dear.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

REPLY_SCHEMA = "prompt_key string, reply string"


@dataclass(frozen=True)
class ReplyTable:
    """Where replies are kept; ``path`` must be reachable by every executor."""

    path: str
    concurrency: int = 8
    flush_every: int = 64

    @classmethod
    def fresh(cls, spark: SparkSession, **kw) -> "ReplyTable":
        return cls(f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-replies-{uuid.uuid4().hex}", **kw)

    def read(self, spark: SparkSession) -> DataFrame:
        """``prompt_key, reply``: one row a prompt that has been answered."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(hadoop):
            return spark.createDataFrame([], REPLY_SCHEMA)
        found = spark.read.schema(REPLY_SCHEMA).option("recursiveFileLookup", True).parquet(self.path)
        return found.groupBy("prompt_key").agg(F.min("reply").alias("reply"))


def _asking(table: ReplyTable, call: Callable[[dict], str]):
    path, flush_every, concurrency = table.path, max(1, table.flush_every), max(1, table.concurrency)

    def run(batches):
        import uuid
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        if path.startswith("file:"):
            files, root = pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
        else:
            files, root = pafs.FileSystem.from_uri(path)
        answered: dict[str, set] = {}

        def held(bucket: str) -> set:
            if bucket not in answered:
                found = files.get_file_info(pafs.FileSelector(f"{root}/{bucket}", allow_not_found=True))
                answered[bucket] = {k for f in found if f.path.endswith(".parquet") and not f.base_name.startswith("_")
                                    for k in pq.read_table(f.path, columns=["prompt_key"], filesystem=files)
                                    .column(0).to_pylist()}
            return answered[bucket]

        def ask(record: dict):
            try:
                reply = call(record)
            except Exception:  # the function is an external boundary; no reply is kept
                return None
            return None if reply is None else str(reply).strip()

        def write(bucket: str, rows: list):
            files.create_dir(f"{root}/{bucket}", recursive=True)
            name = f"{uuid.uuid4().hex}.parquet"
            hidden = f"{root}/{bucket}/_{name}"
            pq.write_table(pa.table({"prompt_key": pa.array([k for k, _ in rows], pa.string()),
                                     "reply": pa.array([r for _, r in rows], pa.string())}), hidden, filesystem=files)
            files.move(hidden, f"{root}/{bucket}/{name}")

        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in batches:
                asked = 0
                for bucket, rows in pdf.groupby("bucket"):
                    todo = [r for r in rows.drop(columns="bucket").to_dict("records")
                            if r["prompt_key"] not in held(bucket)]
                    for at in range(0, len(todo), flush_every):
                        chunk = todo[at:at + flush_every]
                        keys = [r.pop("prompt_key") for r in chunk]
                        got = [(k, r) for k, r in zip(keys, pool.map(ask, chunk)) if r is not None]
                        asked += len(chunk)
                        if got:
                            write(bucket, got)
                yield pd.DataFrame({"asked": [asked]})

    return run


def prompt_key(prompt):
    return F.sha2(F.coalesce(prompt, F.lit("")), 256)


def answer(rows: DataFrame, call: Callable[[dict], str], fallback: str, table: ReplyTable | None = None,
           prompt_col: str = "prompt", reply_col: str = "reply", key_col: str | None = None) -> DataFrame:
    """``rows`` with ``reply_col``: the reply to the row's prompt, or ``fallback`` where the call failed.

    ``call`` gets one row as a dict for each distinct prompt (of equal prompts the row whose ``key_col``,
    or whole row, is least).  Runs the calls before it returns.  ``rows`` is read twice, so an expensive
    plan should be written first.
    """
    spark = rows.sparkSession
    table = table or ReplyTable.fresh(spark)
    keyed = rows.withColumn("__prompt_key", prompt_key(F.col(prompt_col)))
    names = rows.columns
    one = F.min_by(F.struct(*names), key_col) if key_col else F.min(F.struct(*names))
    distinct = keyed.groupBy("__prompt_key").agg(one.alias("r")).select(
        F.col("__prompt_key").alias("prompt_key"), F.substring("__prompt_key", 1, 2).alias("bucket"), "r.*")
    open_ = distinct.join(table.read(spark), "prompt_key", "left_anti")
    # partial counts a batch, added up by Spark; the replies are in the table
    open_.repartition("bucket").mapInPandas(_asking(table, call), "asked long").agg(F.sum("asked")).first()
    got = table.read(spark).select(F.col("prompt_key").alias("__prompt_key"), F.col("reply").alias("__reply"))
    return (keyed.join(got, "__prompt_key", "left")
            .withColumn(reply_col, F.coalesce("__reply", F.lit(fallback))).drop("__prompt_key", "__reply"))
