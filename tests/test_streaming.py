"""Streaming jobs: restart from the checkpoint, and the watermark."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from estatelens.operators import logs as lg
from estatelens.streaming import jobs


def _scratch():
    return tempfile.mkdtemp(prefix="estatelens-stream-")


def test_archive_stream_resumes_without_duplicates(spark):
    base = _scratch()
    in_dir, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    os.makedirs(in_dir)
    lines = spark.createDataFrame(
        [("DB1", dt.datetime(2024, 1, 3, 10), "alert one"), ("DB1", dt.datetime(2024, 2, 1, 9), "alert two")],
        "db_name string, ts timestamp_ntz, line string")
    first = lines.select(jobs.format_log_line(F.col("db_name"), F.col("ts"), F.col("line")).alias("value"))
    first.coalesce(1).write.mode("append").text(in_dir)
    jobs.stream_archive_logs(spark, in_dir, out, ckpt).awaitTermination()
    assert lg.read_log_archive(spark, out).count() == 2

    # a new file arrives; the re-run (same checkpoint) archives only it
    more = spark.createDataFrame([("DB2", dt.datetime(2024, 2, 2, 1), "alert three")],
                                 "db_name string, ts timestamp_ntz, line string")
    more.select(jobs.format_log_line(F.col("db_name"), F.col("ts"), F.col("line")).alias("value")) \
        .coalesce(1).write.mode("append").text(in_dir)
    jobs.stream_archive_logs(spark, in_dir, out, ckpt).awaitTermination()
    got = sorted((r.db_name, r.month, r.line) for r in lg.read_log_archive(spark, out).collect())
    assert got == [("DB1", "2024-01", "alert one"), ("DB1", "2024-02", "alert two"), ("DB2", "2024-02", "alert three")]


def test_redo_rate_drops_late_rows_after_watermark(spark):
    base = _scratch()
    in_dir, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    schema = jobs.ARCHIVED_LOG_SCHEMA

    def batch(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(in_dir)

    t = dt.datetime(2024, 1, 1)
    batch([("DB1", 1, t + dt.timedelta(hours=h), 10, 512, "NO", "YES") for h in range(0, 12)])
    jobs.stream_redo_rate(spark, in_dir, out, ckpt).awaitTermination()
    # a row 10 hours behind the newest event is later than the 1 hour watermark
    batch([("DB1", 99, t + dt.timedelta(hours=1, minutes=30), 1000, 512, "NO", "YES"),
           ("DB1", 100, t + dt.timedelta(hours=20), 10, 512, "NO", "YES")])
    jobs.stream_redo_rate(spark, in_dir, out, ckpt).awaitTermination()
    res = spark.read.parquet(out)
    # every emitted window is final: the late row never entered one
    assert res.agg(F.max("redo_bytes")).first()[0] == 6 * 10 * 512
    starts = [r.window_start for r in res.select("window_start").distinct().collect()]
    assert len(starts) == len(set(starts))


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    from estatelens.streaming import jobs
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("D1\t2024-01-05 10:00:00.000000\tgood\nno tabs at all\nD1\tnot a time\tbad\n")
    for _ in range(2):                                  # a second run adds nothing
        jobs.stream_archive_logs(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.schema("value string, db_name string, month string").text(str(tmp_path / "out")).collect()
    assert sorted(tuple(r) for r in got) == [("D1\tnot a time\tbad", "malformed", "unknown"), ("good", "D1", "2024-01"), ("no tabs at all", "malformed", "unknown")]
