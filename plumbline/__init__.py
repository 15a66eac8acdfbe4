"""Data quality on Spark DataFrames: profile, suggest, recommend, evaluate."""

from plumbline.plans.checks import Check
from plumbline.plans.evaluate import evaluate, evaluate_batch, evaluate_many
from plumbline.plans.rules import explode_rules
from plumbline.operators.profile import counted_values, heavy_hitters, histograms, profile, value_counts
from plumbline.operators.suggest import recommend, suggest, suggested_values, value_sets
from plumbline.plans.jobs import BatchJobs
from plumbline.plans.runs import DataQuality
from plumbline.scratch import drop_scratch
from plumbline.streaming.accumulated import evaluate_so_far
from plumbline.streaming.arriving import evaluate_arriving

__all__ = [
    "BatchJobs",
    "Check",
    "DataQuality",
    "counted_values",
    "drop_scratch",
    "evaluate",
    "evaluate_arriving",
    "evaluate_batch",
    "evaluate_many",
    "evaluate_so_far",
    "explode_rules",
    "heavy_hitters",
    "histograms",
    "profile",
    "recommend",
    "suggest",
    "suggested_values",
    "value_counts",
    "value_sets",
]
