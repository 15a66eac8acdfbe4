"""Shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.plans.checks import Check
from plumbline.plans.evaluate import evaluate

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        assert name not in self.queries, name
        self.queries[name] = query
        if sql is not None:
            self.oracles[name] = sql

    def query(self, name: str, sql: str | None = None):
        def register(function: Query) -> Query:
            self.add(name, function, sql)
            return function

        return register

    def check(self, name: str, source, build: Callable[[Check], Check], sql: str) -> None:
        """Checks of one table as rows ``(rule_no, metric, result)``."""
        load = source if callable(source) else (lambda spark, d: table(spark, d, source))
        self.add(
            name,
            lambda spark, d: judged(evaluate(load(spark, d), build(Check(name)))),
            sql,
        )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged(results: DataFrame) -> DataFrame:
    return results.select("rule_no", F.round("metric", 6).alias("metric"), "result")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, which many of them lack."""
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left")


LABELLED = "documents LEFT JOIN labels USING (doc_id)"


def expected(source: str, *rules: tuple[str, str]) -> str:
    """SQL for rows ``(rule_no, metric, result)`` from pairs of metric and demand."""
    return "\nUNION ALL\n".join(
        f"SELECT {i} AS rule_no, round(m, 6) AS metric, "
        f"CASE WHEN m {demand} THEN 'PASS' ELSE 'FAIL' END AS result "
        f"FROM (SELECT CAST({metric} AS DOUBLE) AS m FROM {source})"
        for i, (metric, demand) in enumerate(rules)
    )


def share_of(predicate: str) -> str:
    return f"count(*) FILTER (WHERE {predicate})::DOUBLE / count(*)"
