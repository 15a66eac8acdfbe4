"""Minimal keys where slices and repeated rows of smaller sets decide, against trying every set of columns."""

from __future__ import annotations

import random

import pytest

from plumbline.operators import keys as K
from tests.test_keys import brute


def made(spark, seed, n):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(n // 4), "x" * 70 + str(rng.randrange(n // 6)), rng.randrange(6 * n) / 4, rng.randrange(7), "ab"[rng.random() < 0.9], rng.randrange(40))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "a long, b string, c double, d int, e string, f long"), rows


@pytest.mark.parametrize("seed, share", [(0, 0.25), (1, 0.25), (2, 0.0), (3, 1.0)])
def test_against_every_set(spark, monkeypatch, seed, share):
    monkeypatch.setattr(K, "SLICED_FROM", 0, raising=False)
    monkeypatch.setattr(K, "SLICES", 5, raising=False)
    monkeypatch.setattr(K, "BASE_SHARE", share, raising=False)
    df, rows = made(spark, seed, 300)
    assert K.minimal_keys(df) == brute(rows, df.columns, 3)


def test_equal_numbers_of_different_bytes(spark, monkeypatch):
    """NaN equals NaN and -0.0 equals 0.0, also where a base's repeated values are looked up."""
    monkeypatch.setattr(K, "SLICED_FROM", 0, raising=False)
    monkeypatch.setattr(K, "SLICES", 2, raising=False)
    x = [float("nan"), float("nan"), -0.0, 0.0, *map(float, range(1, 37))]
    y, z = [0, 1, 0, 0, *[0] * 36], [0, 0, 0, 1, *[0] * 36]
    df = spark.createDataFrame([*zip(x, y, z)], "x double, y int, z int")
    assert K.minimal_keys(df) == [("x", "y", "z")]


def test_few_rows_are_counted_under_many_sets(spark, monkeypatch):
    """Every set is decided, but most on a slice or on repeated rows: before, each near key cost all rows."""
    monkeypatch.setattr(K, "SLICED_FROM", 0)
    monkeypatch.setattr(K, "SLICES", 16)
    shares, counted = K._shares, []

    def spy(df, sets):
        counted.append((df.count(), len(sets)))
        return shares(df, sets)

    monkeypatch.setattr(K, "_shares", spy)
    df, rows = made(spark, 4, 4000)
    assert K.minimal_keys(df) == brute(rows, df.columns, 3)
    decided = sum(n for _, n in counted)
    assert decided >= 15
    assert sum(r * n for r, n in counted) < decided * len(rows) / 4
