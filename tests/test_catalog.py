"""Every query with SQL gives the rows the SQL gives; the others at least run."""

import math

import pytest

from cloakwork.plans import catalog

catalog.load_all()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return [norm(x) for x in v] if isinstance(v, (list, tuple)) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    got = rows(df.columns, df.collect())
    cur = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows(columns, cur.fetchall())


STUDIES = sorted(set(catalog.QUERIES) - set(catalog.ORACLES))
# studies fit many models; the fast ones are enough here, bench and check runs cover the rest
SLOW = {"cv_regression", "forest_sweep", "cv_compare", "grid_search_forest", "grid_search_logistic", "utility_compare", "balancing_study", "feature_reduction_study"}


@pytest.mark.parametrize("name", [n for n in STUDIES if n not in SLOW])
def test_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0
