"""Every registered query against its SQL."""

import functools

import pytest

from checks import compare, queries
from checks.oracle import ORACLE
from checks.queries import QUERIES

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_SMALL)


@pytest.fixture(scope="module", autouse=True)
def fits_once():
    """Many queries start from the same fits."""
    names = ("stored_features", "fitted_logreg", "fitted_kmeans", "fitted_mlp")
    plain = {name: getattr(queries, name) for name in names}
    for name, function in plain.items():
        setattr(queries, name, functools.cache(function))
    yield
    for name, function in plain.items():
        setattr(queries, name, function)


def test_every_statement_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(spark, con, SF_SMALL, name) == []
