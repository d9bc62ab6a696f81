import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

NAMES = [
    "flagship_threshold_choice", "src4_data_dictionary", "src2_snapshot_fingerprint", "prj9_guarded_features", "con15_quality_report", "spl1_stratified_split",
    "jn2_as_of_join", "agg3_exact_quantiles", "enc6_ordered_target_statistic", "evl7_roc_auc", "evl12_capacity_policy",
    "cal1_quantile_reliability", "imb5_smotenc", "drf1_psi", "xpl2_global_importance", "inf1_guarded_scoring", "str2_volume_monitor",
]


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, sf, name):
    got = entry.queries()[name](spark, sf).toArrow()
    assert compare(got, duck.sql(entry.oracle_sql()[name]).to_arrow_table()) == []


def test_every_oracle_compiles(duck):
    for name, sql in entry.oracle_sql().items():
        try:
            duck.execute(f"EXPLAIN {sql}")
        except duckdb.Error as e:
            pytest.fail(f"{name}: {e}")


def test_registry_loads_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    root = Path(entry.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_registry():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) > 150


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 76 and sum(r["selected"] for r in rows) == 1
