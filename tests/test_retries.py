"""Jobs survive failed task attempts with unchanged results.

Runs in a child process with master ``local[4,4]`` (a task may fail up to
three times), where a test-only filter makes the first attempt of every
other scan task fail.  Retried tasks recompute their partition from lineage;
salting is a hash of the row, so the results must equal a clean run.
"""

import json
import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF01

SCRIPT = textwrap.dedent(
    f"""
    import json, sys
    sys.path.insert(0, {ROOT!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from blotter.session import build_session
    from blotter.operators import join_with_strategy, require_not_null
    from blotter.plans.income_descent import clean_income, victims_by_descent, zip_status_counts
    from blotter.plans.standins import geo_lookup, income_raw, order_incidents, table
    from blotter.plans.station_distance import firearm_incidents, station_points
    from blotter.operators import distance_by_group

    spark = build_session(master="local[4,4]", app="retries", shuffle_partitions=4)
    sf = {SF01!r}

    @F.udf("boolean")
    def flaky(_):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return True

    def rows(df):
        return sorted(map(repr, map(tuple, df.collect())))

    def q3(inject):
        facts = require_not_null(order_incidents(spark, sf).repartition(4, "o_orderkey"), ["status", "priority"])
        if inject:
            facts = facts.filter(flaky("status"))
        counts = zip_status_counts(facts, geo_lookup(spark, sf), clean_income(income_raw(spark, sf)))
        return rows(victims_by_descent(counts, 3, ascending=True))

    def salted(inject):
        facts = firearm_incidents(spark, sf).repartition(4, "LAT")
        if inject:
            facts = facts.filter(flaky("AREA"))
        return rows(join_with_strategy(facts, station_points(spark, sf), "AREA", "inner", "merge", salt=5)
                    .groupBy("s_name").count())

    def q4(inject):
        facts = firearm_incidents(spark, sf).repartition(4, "LAT")
        if inject:
            facts = facts.filter(flaky("AREA"))
        return rows(distance_by_group(facts, station_points(spark, sf), "AREA", "s_name"))

    out = {{name: fn(False) == fn(True) for name, fn in [("q3", q3), ("salted", salted), ("q4", q4)]}}
    print("RESULT " + json.dumps(out))
    """
)


def test_results_survive_task_retries():
    proc = subprocess.run(
        [sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600,
        env={**os.environ, "PYTHONPATH": ROOT},
    )
    lines = [line for line in proc.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    assert json.loads(lines[-1][len("RESULT "):]) == {"q3": True, "salted": True, "q4": True}
    assert "injected task failure" in proc.stderr  # failures really happened
