"""The driver's contract, with or without the optional operators."""

import os

import pytest

import __spark_entry__ as entry


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.oracle_sql()) >= 45
    if entry.llm:
        assert "pipeline" in entry.queries() and all(any(n.startswith(f"op{k}_") for n in entry.queries()) for k in range(1, 11))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_flagship(spark):
    rows = entry.entry(spark).take(3)
    assert rows and all(r["lp"].endswith("\n") for r in rows)


def test_points_need_one_exchange(spark):
    from pointstream.model import RAW
    from pointstream.operators import rejoin

    plan = rejoin.points(spark.createDataFrame([], RAW))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_filters_reach_the_scan(spark):
    from pointstream.operators import resume
    from pointstream.plans import relational

    events = relational.read(spark, "/root/testdata/sf0.001", "events").withColumnRenamed("event_type", "database")
    plan = resume.wanted(events, ["click"]).select("database")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or" in plan or "PushedFilters: [" in plan and "EqualTo(event_type,click)" in plan.replace(" ", "")
    assert "ReadSchema: struct<event_type:string>" in plan
