"""Every query beside its SQL at the smallest scale, and the shape of plans."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as app
from check import canonical
from tributary.checks import bindings, entries, oracle, streams
from tributary.operators import tweets

SF = "/root/testdata/sf0.001"
QUERIES = {query.__name__: query for query in entries.QUERIES + streams.QUERIES}
ORACLE = oracle.statements()
MAIL = {"mail_parts", "mail_drops", "mail_comments", "attachments"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in bindings.TABLES:
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name not in MAIL:
        assert "MapInPandas" not in plan and "Python" not in plan
    assert canonical(result.toPandas()) == canonical(duck.sql(ORACLE[name]).df())


def test_entry(spark):
    assert app.entry(spark).columns == ["id", "part", "rivers", "channels"]


def test_entries_without_the_optional_part(tmp_path):
    """The package without its optional folder, the pipeline's file left in place."""
    copy = tmp_path / "copy"
    hidden = shutil.ignore_patterns("llm", ".git", "__pycache__")
    shutil.copytree(Path(app.__file__).parent, copy, ignore=hidden)
    (copy / "corpus_pipeline.py").touch()
    (copy / "corpus_pipeline.py").write_text("import tributary.llm\n")
    code = "import __spark_entry__ as a; print(len(a.queries()), len(a.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]


def test_top_rows_are_cut_before_the_shuffle(spark):
    plan = QUERIES["cache_trim"](spark, SF)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("WindowGroupLimit") == 2


def test_track_match_shuffles_hits_only(spark):
    matched = tweets.track_match(
        bindings.view(spark, SF, "fx_drops"), entries.predicates(spark, SF)
    )
    plan = matched._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("BroadcastHashJoin", 1)
    text_side = below.split("BroadcastExchange", 1)[0]
    assert above.count("Exchange hashpartitioning") == 1
    assert "droplet_raw" in text_side and "Exchange" not in text_side
