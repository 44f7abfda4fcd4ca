"""Queries against their SQL on the smallest tables.

A selection runs by default; set QUOTELAKE_ALL_QUERIES=1 for all of them.
"""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from quotelake.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SELECTION = (
    "coerce_types",
    "clean_prices",
    "quantiles_by_ticker",
    "indicators_full",
    "incremental_indicators",
    "upsert_partitions",
    "slice_replace",
    "merge_dimension",
    "surrogate_keys_stable",
    "fact_technical",
    "predicted_rejects",
    "star_prices",
    "portfolio_summary",
    "returns_correlation_events",
    "monthly_volume_pivot",
    "entitled_sections",
    "changed_snapshots",
    "flatten_nested",
    "raw_append",
    "log_scan",
    "monthly_volume_dotted",
    "statement_transpose",
    "returns_correlation",
    "manifest_of_texts",
    "manifest_hash_of_texts",
    "manifest_check_of_texts",
    "kmeans_of_separate_groups",
    "half_written_upsert",
    "late_files_taken_once",
    "indicators_from_state",
    "manifest_follows_changes",
    "gold_load_counts",
)
NAMES = list(entry.queries()) if os.environ.get("QUOTELAKE_ALL_QUERIES") else SELECTION

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for c in sorted(df.columns):
        col = df[c]
        if pd.api.types.is_numeric_dtype(col) and not pd.api.types.is_bool_dtype(col):
            out[c] = col.astype("float64")
        elif pd.api.types.is_datetime64_any_dtype(col):
            out[c] = col.dt.strftime("%Y-%m-%d %H:%M:%S").fillna("")
        else:
            text = col.map(lambda v: "" if v is None or v != v or v is pd.NaT else str(v))
            dates = text.str.fullmatch(r"\d{4}-\d\d-\d\d")
            out[c] = text.where(~dates, text + " 00:00:00")
    done = pd.DataFrame(out)
    return done.sort_values(list(done.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert len(got) > 0
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        want = duck.execute(sql).df()
        pd.testing.assert_frame_equal(normal(got), normal(want), check_exact=False, rtol=0, atol=1e-9)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    # File hashes, custody and cluster labels have no SQL twin.
    assert set(QUERIES) - set(ORACLES) == {
        "manifest_files",
        "manifest_build",
        "manifest_verify",
        "custody_append",
        "kmeans_tickers",
    }


def test_stands_alone_without_the_optional_part(tmp_path):
    """A copy without the training-data operators and their pipeline still offers every other query."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "quotelake", tmp_path / "quotelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"],
        cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True,
    )
    assert said.stdout.split() == sorted(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).columns[:2] == ["ticker", "date"]
