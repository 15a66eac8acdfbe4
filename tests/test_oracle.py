"""Every registered query against DuckDB on the same files."""

from __future__ import annotations

import pytest

from plumbline.gallery import ORACLES, QUERIES
from tests.oracle import connect, duck_rows, spark_rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert rows, "no rows"
    if name in ORACLES:
        want_names, want = duck_rows(duck, ORACLES[name])
        assert names == want_names
        assert len(rows) == len(want)
        for got, expected in zip(rows, want):
            assert got == pytest.approx(expected, abs=1e-9) if all(
                isinstance(v, (int, float)) for v in got
            ) else got == expected


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
