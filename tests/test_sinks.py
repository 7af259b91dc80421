"""Writers: re-running replaces only the partitions written; appends append."""

import datetime as dt
import tempfile

from estatelens.sources import sinks


def test_write_inventory_rerun_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="estatelens-inv-") + "/inv"
    t = spark.createDataFrame([("DB1", "a"), ("DB1", "b"), ("DB2", "c"), ("DB1", "a")], "db_name string, line string")
    v = spark.createDataFrame([("DB1", "v1")], "db_name string, line string")
    sinks.write_inventory(t, "tables", path)
    sinks.write_inventory(v, "views", path)
    sinks.write_inventory(t, "tables", path)          # a retried or repeated run
    got = sorted((r.kind, r.db_name, r.line) for r in sinks.read_inventory(spark, path).collect())
    assert got == [("tables", "DB1", "a"), ("tables", "DB1", "b"), ("tables", "DB2", "c"), ("views", "DB1", "v1")]


def test_write_inventory_replaces_changed_database_only(spark):
    path = tempfile.mkdtemp(prefix="estatelens-inv-") + "/inv"
    sinks.write_inventory(spark.createDataFrame([("DB1", "old"), ("DB2", "keep")], "db_name string, line string"),
                          "tables", path)
    sinks.write_inventory(spark.createDataFrame([("DB1", "new")], "db_name string, line string"), "tables", path)
    got = sorted((r.db_name, r.line) for r in sinks.read_inventory(spark, path).collect())
    assert got == [("DB1", "new"), ("DB2", "keep")]


def test_append_metrics_appends(spark):
    path = tempfile.mkdtemp(prefix="estatelens-met-") + "/m"
    r = spark.createDataFrame([("DB1", dt.datetime(2024, 1, 2, 3), 1.0)], "db_name string, reading_ts timestamp_ntz, v double")
    sinks.append_metrics(r, path)
    sinks.append_metrics(r, path)
    assert spark.read.parquet(path).count() == 2


def test_files_keep_their_order(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from estatelens.operators import logs
    from estatelens.sources import sinks
    lines = spark.range(400).selectExpr("concat('D', id % 3) AS db_name", "concat('line ', lpad(CAST((id * 7919) % 400 AS STRING), 4, '0')) AS line",
                                        "CAST('2024-01-01' AS TIMESTAMP_NTZ) + make_dt_interval(CAST((id * 37) % 60 AS INT)) AS ts").repartition(5)
    sinks.write_inventory(lines, "k", str(tmp_path / "inv"))
    files = glob.glob(f"{tmp_path}/inv/**/*.parquet", recursive=True)
    assert files
    for f in files:
        got = pq.ParquetFile(f).read()["line"].to_pylist()
        assert got == sorted(got)
    stamped = lines.selectExpr("db_name", "ts", "concat(date_format(ts, 'yyyy-MM-dd'), ' ', line) AS line")
    logs.archive_logs_by_month(stamped, str(tmp_path / "log"))
    for f in glob.glob(f"{tmp_path}/log/**/*.txt", recursive=True):
        with open(f) as h:
            days = [x[:10] for x in h.read().splitlines()]
        assert days == sorted(days)


def test_text_like_database_names_stay_text(spark, tmp_path):
    from estatelens.sources import catalog
    catalog.write_catalog(spark.createDataFrame([("001", "a", "1"), ("2", "b", "2")], "db_name string, name string, value string"), str(tmp_path / "p"))
    got = catalog.scan_catalog(spark, str(tmp_path / "p"), "parameters", databases=["001"])
    assert [(r.db_name, r.name) for r in got.collect()] == [("001", "a")]


def test_scratch_folder_needs_a_shared_one_on_a_cluster():
    import pytest

    from estatelens import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf({"spark.master": "spark://host:7077"}), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_unknown_retention_format_is_an_error(spark):
    import pytest

    from estatelens.operators import partitions
    parts = spark.createDataFrame([("D", "O", "T", "P_2020_0101")], "db_name string, table_owner string, table_name string, partition_name string")
    policy = spark.createDataFrame([("O", "T", "P_", 31, "yyyy-MM-dd")], partitions.POLICY_SCHEMA)
    with pytest.raises(Exception, match="unknown date format"):
        partitions.expired_partitions(parts, policy, "2024-01-01 00:00:00").collect()
