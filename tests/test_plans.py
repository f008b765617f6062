"""What the physical plans must and must not hold."""

import os
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from marquee.queries import all_queries
from marquee.sources import shop
from oracle import all_oracles

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "PythonUDF")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_check():
    assert set(all_queries()) == set(all_oracles())


def test_no_python_and_no_cross_join_in_any_plan(spark, smoke_dir):
    for name, query in all_queries().items():
        plan = plan_of(query(spark, smoke_dir))
        assert not any(node in plan for node in PYTHON_NODES), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_top_titles_limits_groups_before_the_shuffle(spark, smoke_dir):
    plan = plan_of(all_queries()["k01_top_titles"](spark, smoke_dir))
    partial, final = plan.index("10, Partial"), plan.index("10, Final")
    assert "hashpartitioning(period_label" in plan[final:partial]


def test_charts_limit_groups_before_the_shuffle(smoke):
    for chart in (shop.global_chart(smoke.viewing), shop.country_chart(smoke.viewing)):
        assert "row_number(), 10, Partial" in plan_of(chart)


def test_limits_are_taken_with_the_sort(spark, smoke_dir):
    for name in ("k05_weekly_trend", "k06_stickiness_top", "k07_global_alignment", "k08_movers_up"):
        assert "TakeOrderedAndProject" in plan_of(all_queries()[name](spark, smoke_dir)), name


def test_movers_read_two_weeks(spark, smoke_dir):
    for name in ("k08_movers_up", "k08_movers_down"):
        plan = plan_of(all_queries()[name](spark, smoke_dir))
        pruned = re.findall(r"PartitionFilters: \[isnotnull\(year", plan)
        assert len(pruned) >= 2
        assert "Window" not in plan


def test_top_titles_join_names_above_the_limit(spark, smoke_dir):
    plan = plan_of(all_queries()["k01_top_titles"](spark, smoke_dir))
    below = plan[plan.index("10, Final") :].split("Exchange hashpartitioning(period_label")[1]
    assert "Join" not in below


def test_lines_are_read_once_and_narrow(spark, smoke_dir):
    plan = plan_of(shop.viewing(spark, smoke_dir))
    assert plan.count("l_quantity:double") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_hot_keys_are_split(spark, smoke_dir):
    """A third of all lines on one order and part: same result, split joins."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    lines = shop.table(spark, smoke_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    hot = lines.unionByName(
        lines.withColumns({"l_orderkey": F.lit(7).cast("long"), "l_partkey": F.lit(3).cast("long")})
    ).unionByName(lines).unionByName(lines)
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        original = shop.table
        shop.table = lambda s, d, name: hot if name == "lineitem" else original(s, d, name)
        viewed = shop.viewing(spark, smoke_dir)
        assert viewed.agg(F.sum("views")).first()[0] == hot.count()
        viewed.collect()
        plan = plan_of(viewed)
    finally:
        shop.table = original
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_sql(spark, smoke_dir, name):
    duck = duckdb.connect()
    for table in ("nation", "customer", "part", "orders", "lineitem", "events"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{smoke_dir}/{table}.parquet'")
    df = all_queries()[name](spark, smoke_dir)
    theirs = duck.sql(all_oracles()[name])
    assert sorted(df.columns) == sorted(theirs.columns)
    columns = sorted(df.columns)
    order = [theirs.columns.index(column) for column in columns]
    ours = sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
    assert ours == sorted((tuple(row[i] for i in order) for row in theirs.fetchall()), key=repr)


def test_a_cluster_needs_a_shared_folder(monkeypatch, spark):
    from marquee.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_entry_module_runs_from_elsewhere(tmp_path):
    code = (
        "import re, __spark_entry__ as e; core = {q for q in e.queries() if not re.match('op[0-9]+_|pipeline$', q)}; "
        "assert set(e.oracle_sql()) <= set(e.queries()) and core <= set(e.oracle_sql()) and len(core) > 50"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": root},
        capture_output=True, text=True, timeout=120,
    )
    assert done.returncode == 0, done.stderr
