"""Minimal keys against trying every set of columns."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from plumbline.operators.keys import minimal_keys, suggested_keys


def brute(rows, names, most):
    keys = []
    for width in range(1, most + 1):
        for s in combinations(range(len(names)), width):
            values = [tuple(r[i] for i in s) for r in rows]
            whole = all(v is not None for row in values for v in row)
            if whole and len(set(values)) == len(rows) and not any(set(k) <= set(s) for k in keys):
                keys.append(s)
    return [tuple(names[i] for i in k) for k in keys]


@pytest.mark.parametrize("seed", range(4))
def test_against_every_set(spark, seed):
    rng, names = random.Random(seed), ["a", "b", "c", "d", "e"]
    rows = [
        (rng.randrange(12), str(rng.randrange(9)), float(rng.randrange(8)), rng.randrange(3), rng.choice([i, None]) if seed == 1 else i)
        for i in range(60 if seed < 3 else 9)
    ]
    df = spark.createDataFrame(rows, "a long, b string, c double, d int, e long")
    if seed == 2:
        df, rows, names = df.drop("e"), [r[:4] for r in rows], names[:4]
    assert minimal_keys(df) == brute(rows, names, 3)


def test_no_rows_nested_columns_and_rule_text(spark):
    df = spark.sql('SELECT id AS `a "b`, array(id) AS l FROM range(5)')
    assert suggested_keys(df).first().dqdl_rule == 'IsPrimaryKey "a ""b"'
    assert minimal_keys(df.limit(0)) == []
