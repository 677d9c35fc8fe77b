"""Every query with a SQL twin gives the same result on the smallest data set."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == []


# Queries without a SQL twin, and how many rows they give per document.
FITTED = {
    "score_documents": 1, "permutation_attribution": 5, "local_surrogate": 5, "cross_validate": 0, "native_importance": 0,
    "feature_selection": 0, "grid_search": 0, "train_lr": 0,
}


@pytest.mark.parametrize("name", FITTED)
def test_fitted_queries_run_over_the_whole_table(spark, sf, name):
    rows = entry.queries()[name](spark, sf).collect()
    documents = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert rows and all(v is not None for r in rows for v in r)
    assert not FITTED[name] or len(rows) == FITTED[name] * documents


def test_entry(spark):
    assert entry.entry(spark).count() == 15
