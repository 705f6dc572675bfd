"""Stream scorer == batch history dialect; out-of-order input, late data, restart."""

import os
import random
from datetime import timedelta


from helpers import NTZ_SCHEMA, T0
from riskloom.config import RuleConfig
from riskloom.operators.scoring import scored_table
from riskloom.streaming import stream_scores

CFG = RuleConfig(velocity_window_minutes=30, high_amount_threshold=100.0)


def _rows(n=240, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = T0 + timedelta(seconds=rnd.randrange(0, 6 * 3600), microseconds=rnd.choice([0, 7, 500_000]))
        rows.append((f"S{i:04d}", rnd.choice(["U1", "U2", "U3", "U4"]), float(rnd.randrange(1, 300)), "GBP",
                     "GB", rnd.choice(["GB", "US", None]), rnd.choice([5411, 4829]),
                     rnd.choice(["A", "B", "C", None]), ts, i))
    rows.append(("S-tie", "U1", 1.0, "GBP", "GB", "GB", 5411, "Z", rows[0][8], n))  # exact time tie
    return rows


def _write_files(spark, rows, src, n_files):
    # arrival order != event order: shuffle, then cut into files that arrive one per micro-batch
    rnd = random.Random(3)
    rows = rows[:]
    rnd.shuffle(rows)
    chunk = -(-len(rows) // n_files)
    for k in range(n_files):
        part = rows[k * chunk:(k + 1) * chunk]
        spark.createDataFrame(part, NTZ_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{src}/f{k:03d}")


def _end_marker(spark, src):
    spark.createDataFrame([("END", "__end__", 0.0, "GBP", "GB", "GB", 5411, "X", T0 + timedelta(days=3650), -1)],
                          NTZ_SCHEMA).write.mode("overwrite").parquet(f"{src}/zz_end")


def _run(spark, src, out, ckpt, max_files=1, delay="7 hours"):
    stream = (spark.readStream.schema(NTZ_SCHEMA).option("maxFilesPerTrigger", max_files)
              .option("recursiveFileLookup", "true").parquet(src))
    q = (stream_scores(stream, CFG, delay).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _key(r):
    return tuple(repr(v) for v in r)


def test_stream_equals_batch_with_out_of_order_files(spark, tmpdir_path):
    rows = _rows()
    src, out, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "out", "ckpt"))
    _write_files(spark, rows, src, n_files=5)
    _end_marker(spark, src)
    _run(spark, src, out, ckpt)
    got = spark.read.parquet(out)
    batch = scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, "history")
    assert got.columns == batch.columns
    assert sorted(map(_key, got.collect())) == sorted(map(_key, batch.collect()))


def test_stream_restart_and_late_rows(spark, tmpdir_path):
    rows = sorted(_rows(120, seed=5), key=lambda r: (r[8], r[9]))
    src, out, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "out", "ckpt"))
    first, second = rows[:60], rows[60:]
    spark.createDataFrame(first, NTZ_SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    q1 = _run(spark, src, out, ckpt, delay="0 seconds")
    assert q1.lastProgress is not None
    # restart from the same checkpoint: the rest of the data plus one row far behind the watermark
    late = ("LATE", "U1", 1.0, "GBP", "GB", "GB", 5411, "A", T0 - timedelta(days=1), 999)
    spark.createDataFrame(second, NTZ_SCHEMA).coalesce(1).write.parquet(f"{src}/b")
    spark.createDataFrame([late], NTZ_SCHEMA).coalesce(1).write.parquet(f"{src}/c")
    _end_marker(spark, src)
    q2 = _run(spark, src, out, ckpt, delay="0 seconds")
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q2.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1
    got = spark.read.parquet(out)
    batch = scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, "history")
    assert sorted(map(_key, got.collect())) == sorted(map(_key, batch.collect()))


def test_stream_device_ttl_forgets_old_devices(spark, tmpdir_path):
    """Opt-in TTL: a device unseen for longer than the TTL counts as new again."""
    rows = [("A", "U1", 1.0, "GBP", "GB", "GB", 5411, "d1", T0, 0),
            ("B", "U1", 1.0, "GBP", "GB", "GB", 5411, "d2", T0 + timedelta(minutes=10), 1),
            ("C", "U1", 1.0, "GBP", "GB", "GB", 5411, "d1", T0 + timedelta(hours=5), 2),
            ("D", "U1", 1.0, "GBP", "GB", "GB", 5411, "d2", T0 + timedelta(hours=5, minutes=1), 3)]
    src, out, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "out", "ckpt"))
    spark.createDataFrame(rows, NTZ_SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    _end_marker(spark, src)
    stream = spark.readStream.schema(NTZ_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    q = (stream_scores(stream, CFG, "0 seconds", device_ttl_minutes=60).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.txn_id: r.r_new_device for r in spark.read.parquet(out).collect()}
    # without TTL: A first device (0), B new (20), C and D known (0); with a 60-minute TTL C and D are new again
    assert got == {"A": 0, "B": 20, "C": 20, "D": 20}


def test_window_dialect_stream_equals_batch(spark, tmpdir_path):
    """Same-second peers (split across files) are held until their second has passed."""
    from riskloom.streaming import stream_window_scores
    rows = _rows(200, seed=21)
    # extra same-second peers and a device tie at one instant, split over different files
    t = rows[5][8]
    rows += [("P1", rows[5][1], 5.0, "GBP", "GB", "GB", 5411, "Z", t + timedelta(microseconds=300), 901),
             ("P2", rows[5][1], 5.0, "GBP", "GB", "GB", 5411, "Z", t, 902)]
    src, out, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "out", "ckpt"))
    _write_files(spark, rows, src, n_files=4)
    _end_marker(spark, src)
    stream = (spark.readStream.schema(NTZ_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    q = (stream_window_scores(stream, CFG, "7 hours").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    batch = scored_table(spark.createDataFrame(rows, NTZ_SCHEMA), CFG, "window")
    assert got.columns == batch.columns
    assert sorted(map(_key, got.collect())) == sorted(map(_key, batch.collect()))


def test_stream_with_session_zone_timestamps_across_dst(spark, tmpdir_path):
    """TIMESTAMP (session-zone) input across the autumn clock change: stream == batch."""
    from datetime import datetime
    from pyspark.sql import types as T
    ltz = T.StructType([f if f.name != "timestamp" else T.StructField("timestamp", T.TimestampType())
                        for f in NTZ_SCHEMA.fields])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        base = datetime(2025, 10, 25, 23, 30)
        rows = [(f"D{i}", "U1", 1.0, "GBP", "GB", "GB", 5411, f"d{i % 3}", base + timedelta(minutes=17 * i), i)
                for i in range(20)]
        src, out, ckpt = (os.path.join(tmpdir_path, d) for d in ("src", "out", "ckpt"))
        spark.createDataFrame(rows, ltz).coalesce(1).write.parquet(f"{src}/a")
        spark.createDataFrame([("END", "__end__", 0.0, "GBP", "GB", "GB", 5411, "X", datetime(2100, 1, 1), -1)],
                              ltz).write.parquet(f"{src}/zz_end")
        cfg = RuleConfig(velocity_window_minutes=90)
        stream = spark.readStream.schema(ltz).option("recursiveFileLookup", "true").parquet(src)
        q = (stream_scores(stream, cfg, "0 seconds").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        got = sorted(map(_key, spark.read.parquet(out).collect()))
        want = sorted(map(_key, scored_table(spark.createDataFrame(rows, ltz), cfg, "history").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want


def test_several_batches_lose_no_row_and_keep_the_mcc(spark, tmpdir_path):
    """One file a trigger over four files: rows in equal rows out; a NULL MCC does not wipe the others."""
    from riskloom.config import EVENTS_RULES
    from riskloom.streaming.runner import score_events_stream
    from tests.conftest import SF0001

    for name in ("nation", "customer"):
        spark.read.parquet(f"{SF0001}/{name}.parquet").write.parquet(f"{tmpdir_path}/{name}.parquet")
    events = spark.read.parquet(f"{SF0001}/events.parquet").orderBy("ts").limit(200)
    events.repartitionByRange(4, "ts").write.parquet(f"{tmpdir_path}/events.parquet")
    q, out = score_events_stream(spark, tmpdir_path, EVENTS_RULES, max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 200
    assert got.where("merchant_mcc IS NULL").count() == 0
