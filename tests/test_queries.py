"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries
from clickwatch.plans.catalog import QUERIES
from clickwatch.plans.oracle import ORACLE

NO_SQL = {"forest_nodes", "anomaly_scores", "forest_evaluation", "fitted_alerts"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(queries()[name](spark, sf_dir), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["sliding_features", "stream_sliding_features", "roc_auc"])
def test_tables_of_many_files_with_a_busy_key(spark, sf_dir, tmp_path, name):
    """The table as a folder of files, a third of its rows from one user."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    busy = F.when(F.col("event_id") % 3 == 0, 10).otherwise(F.col("user_id")).cast("bigint")
    events.withColumn("user_id", busy).repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    df = queries()[name](spark, str(tmp_path))
    assert difference(df, duck(str(tmp_path)), oracle_sql()[name]) is None


def test_only_fitted_forest_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["window_start", "window_end", "geo", "platform"]


def test_stored_model_flags_about_its_share(spark, sf_dir):
    found = queries()["fitted_alerts"](spark, sf_dir).collect()
    assert found and all(r.anomaly_score >= r.threshold for r in found)
    assert len(found) < 0.1 * queries()["sliding_features"](spark, sf_dir).count()


def test_forest_evaluation_is_consistent(spark, sf_dir):
    rows = queries()["forest_evaluation"](spark, sf_dir).collect()
    assert [r.rule for r in rows] == ["quantile", "contamination"]
    for row in rows:
        total = row.tp + row.fp + row.fn + row.tn
        assert row.tp + row.fn == max(1, round(0.02 * total))
        assert 0 <= row.roc_auc <= 1 and 0 < row.threshold < 1
        assert row.precision == pytest.approx(row.tp / max(1, row.tp + row.fp))
