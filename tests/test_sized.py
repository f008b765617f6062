"""Tasks of the passes over many rows: their number follows the rows."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.plans.warehouse import forget, warehouse
from marquee.queries import REGISTERED, STAR_QUESTIONS, WAREHOUSE_QUESTIONS
from marquee.sources import shop

PARTITIONS = "spark.sql.shuffle.partitions"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ROWS = 100


@pytest.fixture
def small_tasks(monkeypatch, set_conf):
    monkeypatch.setattr(session, "ROWS_A_TASK", ROWS, raising=False)
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")


def answers(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_sized_sessions_keep_the_settings(spark, set_conf):
    set_conf("spark.sql.session.timeZone", "Asia/Tokyo")
    set_conf(ADVISORY, "8KB")
    assert session.sized(spark, session.ROWS_A_TASK) is spark
    before = spark.conf.getAll
    beside = session.sized(spark, 50 * session.ROWS_A_TASK + 1)
    assert beside.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert (beside.conf.get(PARTITIONS), beside.conf.get(ADVISORY)) == ("51", str(8 << 10))
    set_conf(PARTITIONS, "70")
    set_conf(ADVISORY, "1g")
    beside = session.sized(spark, 50 * session.ROWS_A_TASK + 1)
    assert (beside.conf.get(PARTITIONS), beside.conf.get(ADVISORY)) == ("70", str(session.TASK_BYTES))
    set_conf("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "2")
    assert session.sized(spark, 50 * session.ROWS_A_TASK).conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "50"
    assert set(before) <= set(spark.conf.getAll)


def test_sized_sessions_leave_settings_of_the_application():
    """A second ``getOrCreate`` keeps names there that cannot be set any more."""
    code = (
        "from pyspark.sql import SparkSession; from marquee.session import sized, local_session; local_session(2); "
        "late = SparkSession.builder.config(map={'spark.driver.memory': '1g', 'spark.sql.warehouse.dir': '/tmp/elsewhere'}).getOrCreate(); "
        "late.conf.set('own.key', 'kept'); beside = sized(late, 9_000_000); "
        "assert beside is not late and beside.conf.get('own.key') == 'kept' and beside.range(3).count() == 3"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", code], env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr


def test_sizes_of_settings():
    assert [session.byte_size(x) for x in ("8192", "8k", "64MB", "1 g", "-1", "10b")] == [8192, 8192, 64 << 20, 1 << 30, -1, 10]


def test_viewing_runs_in_tasks_of_so_many_rows(spark, smoke_dir, monkeypatch, set_conf):
    """a task took the lines of one of few partitions, however many lines there were."""
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    whole = answers(shop.viewing(spark, smoke_dir))
    monkeypatch.setattr(session, "ROWS_A_TASK", ROWS, raising=False)
    viewed = shop.viewing(spark, smoke_dir)
    rows = sum(shop.table(spark, smoke_dir, name).count() for name in ("lineitem", "orders"))
    assert viewed.rdd.getNumPartitions() >= rows / ROWS
    assert answers(viewed) == whole


def test_hot_keys_are_split_in_sized_sessions(spark, smoke_dir, small_tasks, set_conf, tmp_path):
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        set_conf(name, "-1")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    set_conf(ADVISORY, "8KB")
    for name in ("nation", "customer", "part", "orders"):
        shutil.copy(f"{smoke_dir}/{name}.parquet", tmp_path)
    lines = shop.table(spark, smoke_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    hot = lines.unionByName(lines.withColumns({"l_orderkey": F.lit(7).cast("long"), "l_partkey": F.lit(3).cast("long")}))
    hot.unionByName(lines).unionByName(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    viewed = shop.viewing(spark, str(tmp_path))
    assert viewed.sparkSession is not spark
    assert sum(row.views for row in viewed.collect()) == 4 * lines.count()
    assert "skew=true" in viewed._jdf.queryExecution().executedPlan().toString()


def test_feeds_run_in_tasks_of_so_many_rows(spark, smoke_dir, smoke, small_tasks):
    """what is made of the viewing follows its rows, too; answers belong to the caller's session."""
    source = warehouse(spark, smoke_dir, "small tasks")
    try:
        feed = source.viewing.groupBy("week", "market", "p_name", "p_type").count()
        assert feed.rdd.getNumPartitions() >= source.viewing.count() / ROWS
        ask = STAR_QUESTIONS["p08_market_profile"]
        profile = ask(source.star, REGISTERED)
        assert profile.sparkSession is spark
        assert answers(profile) == answers(ask(smoke.star, REGISTERED))
        ask = WAREHOUSE_QUESTIONS["r02_chart_files"]
        landed = ask(source, REGISTERED)
        assert landed.sparkSession is spark
        assert answers(landed) == answers(ask(smoke, REGISTERED))
        assert source.trailers.sparkSession is spark and source.shows.sparkSession is spark
    finally:
        forget(spark, smoke_dir, "small tasks").close()
