"""Every query with SQL, compared row by row on the smallest tables."""
import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
# Many forests; these are compared by checks/compare.py.
SLOW = {"cross_validate", "save_model", "fit_forest_bow", "forest_small_leaf", "forest_standardized", "tune_forest"}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name not in SLOW}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name, entry.queries()[name], ORACLE[name])
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("name", ["lexicon_scores_joined", "bow_counts", "lemmatize", "roc_auc_ovr", "stratified_split"])
def test_result_does_not_depend_on_partitions(spark, con, name):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        ok, note = compare(spark, con, SF, name, entry.queries()[name], ORACLE[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert ok, note
