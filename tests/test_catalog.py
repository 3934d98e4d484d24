"""Registered queries against their check SQL, on the smallest tables."""

from __future__ import annotations

import inspect
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import check
from skyledger.catalog import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
# The other streams are checked in test_streams, and all of them by check.py.
NAMES = [n for n in queries.queries() if not n.startswith("stream_")] + [
    "stream_trips_incremental", "stream_trips_windowed", "stream_trips_joined", "stream_trips_restarted", "stream_top_carriers_wide",
]

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")


def test_every_query_has_check_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(oracle.oracle_sql()) <= set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert check.compare(spark, SF_DIR, name).startswith("same")


@needs_tables
def test_entry(spark):
    if inspect.signature(entry.entry).parameters:
        assert entry.entry(spark).count() > 0


@needs_tables
def test_results_do_not_depend_on_the_session(spark):
    """Other zone, non-ANSI mode, no broadcast, one shuffle partition."""
    settings = {
        "spark.sql.session.timeZone": "America/New_York",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for name in ["clean_on_time", "tsv_clean_on_time", "trips", "trips_text", "trips_millis", "zip_ingest"]:
            assert check.compare(spark, SF_DIR, name).startswith("same"), name
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_entry_without_the_training_text_operators(tmp_path):
    """A copy of the tree without them still has every other query, and runs one."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    (copy / "skyledger" / "llm" / "__pycache__").mkdir(parents=True)  # what a deletion may leave behind
    program = (
        "import __spark_entry__ as e; from pyspark.sql import SparkSession; "
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
        f"print(len(e.queries()), len(e.oracle_sql()), os.path.isdir('{SF_DIR}') and e.queries()['weekday_delay'](s, '{SF_DIR}').count())"
    )
    done = subprocess.run([sys.executable, "-c", f"import os; {program}"], cwd=copy, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(copy)}, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    n = str(len(queries.queries()))
    assert done.stdout.split()[-3:-1] == [n, n]
