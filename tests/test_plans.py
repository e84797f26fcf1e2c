"""Plan-shape guards for every registered query: no cartesian product or
nested-loop join, no Python evaluation in the plan, and no window without
partition keys (a global window puts every row into one task)."""

import re

import pytest

import __spark_entry__ as se
from tests.conftest import SF001
from trendspark.plans import catalogue

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df):
    df.write.format("noop").mode("overwrite").save()  # final (AQE) plan
    return df._jdf.queryExecution().executedPlan().toString()


def global_windows(plan: str):
    out = []
    for m in re.finditer(r"windowspecdefinition\(([^,]*)", plan):
        first = m.group(1)
        if " ASC" in first or " DESC" in first or first.startswith("specifiedwindowframe"):
            out.append(first)
    return out


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_plan_shape(spark, name):
    plan = plan_text(se.queries()[name](spark, SF001))
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"
    assert not global_windows(plan), f"{name}: global window"


def test_guard_detects_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(5).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert global_windows(plan_text(df))
