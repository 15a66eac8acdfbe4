"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR: folder of the tables (default sf0.1); BENCH_CPUS: local cores (default 8).
Every query is run once to warm up and then timed as the better of two runs; results are
fetched in full.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.gallery import QUERIES  # noqa: E402
from plumbline.operators import pairs as X  # noqa: E402
from plumbline.operators.profile import counted_values, profile  # noqa: E402
from plumbline.operators.suggest import (  # noqa: E402
    recommend,
    suggest,
    suggested_values,
    value_sets,
)
from plumbline.plans.evaluate import evaluate  # noqa: E402
from plumbline.scratch import drop_scratch  # noqa: E402

THIRTY = [
    "HasSize >= 1000",
    *[
        f'{kind} "{c}" {demand}'
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        for kind, demand in (
            ("HasMin", ">= 0"),
            ("HasMax", "<= 200000"),
            ("HasMean", ">= 0"),
            ("IsNonNegative", ""),
            ("IsComplete", ""),
        )
    ],
    'IsContainedIn "l_returnflag" in ["A","N","R"]',
    'IsContainedIn "l_linestatus" in ["O","F"]',
    'HasStandardDeviation "l_quantity" < 20',
    'HasCorrelation "l_quantity" "l_extendedprice" > 0',
    'Satisfies "l_tax < l_discount" >= 0.3',
    'HasPattern "l_returnflag" matches "^[ANR]$"',
    'HasMaxLength "l_returnflag" = 1',
    'IsLessThanOrEqualTo "l_discount" "l_quantity"',
    'IsComplete "l_shipdate"',
]


def queries(spark: SparkSession, d: str):
    def table(name):
        return spark.read.parquet(f"{d}/{name}.parquet")

    lines, orders, documents = table("lineitem"), table("orders"), table("documents")
    drifted = orders.withColumn(
        "o_orderstatus", F.expr("CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END")
    )

    def loop():
        profiled = profile(orders)
        counts = counted_values(orders, profiled)
        found = suggest(profiled, counts)
        suggestions = found.withColumn("table_name", F.lit("orders"))
        sets = value_sets(found, suggested_values(profiled, counts))
        return evaluate(orders, recommend(suggestions), references=sets).collect()

    def one_by_one():
        return [evaluate(lines, [rule]).collect() for rule in THIRTY]

    monthly = orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    text_rules = [
        'ContainsEmail "text" >= 0',
        'ContainsURL "text" >= 0',
        'ContainsSocialSecurityNumber "text" >= 0',
        'ContainsCreditCardNumber "text" >= 0',
        'HasMaxLength "text" > 0',
    ]
    return {
        "flagship": lambda: QUERIES["r02_evaluate"](spark, d).collect(),
        "profile_lineitem": lambda: profile(lines).collect(),
        "profile_documents": lambda: profile(documents).collect(),
        "thirty_rules_fused": lambda: evaluate(lines, THIRTY).collect(),
        "thirty_rules_one_by_one": one_by_one,
        "uniqueness_two_columns": lambda: evaluate(
            lines, ['HasUniqueness "l_orderkey" "l_linenumber" >= 0.9']
        ).collect(),
        "mutual_information": lambda: evaluate(
            lines, ['HasMutualInformation "l_returnflag" "l_shipdate" >= 0']
        ).collect(),
        "referential_integrity": lambda: X.referential_integrity(
            lines, ["l_orderkey"], orders, ["o_orderkey"]
        ).collect(),
        "dataset_match": lambda: X.dataset_match(drifted, orders, ["o_orderkey"]).collect(),
        "evaluate_by_month": lambda: evaluate(
            monthly,
            ["HasSize >= 1", 'IsComplete "o_totalprice"', 'IsUnique "o_orderkey"'],
            by=["month"],
        ).collect(),
        "text_patterns": lambda: evaluate(documents, text_rules).collect(),
        "suggest_recommend_evaluate": loop,
        "latest_by_key": lambda: QUERIES["s11_latest_by_key"](spark, d).collect(),
        "batch_status": lambda: QUERIES["b03_batch_status"](spark, d).collect(),
    }


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, run in queries(spark, d).items():
        if only and name not in only:
            continue
        run()
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
        drop_scratch(spark)
    sf = re.search(r"sf([0-9.]+)", d)
    print(
        json.dumps(
            {
                "metric": "data_quality_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf[1]) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
