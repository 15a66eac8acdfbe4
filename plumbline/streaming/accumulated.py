"""Rules over everything that has arrived so far, each file read once.

A batch leaves partial states of its plain metrics and sketches (a row per file and metric) and the group
sizes of its key sets; the rules are judged on the merged states of all batches up to it. So a key that
two files share is not unique, and a total goes over all files, though no old file is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from plumbline.functions.columns import ref
from plumbline.operators import states as S
from plumbline.operators.keyed import BATCH, KeyedState
from plumbline.operators.metric import FRAME, GROUPS
from plumbline.plans.catalogue import Context, compile_rule
from plumbline.plans.evaluate import judge, named_metrics, to_rules

# Batches after which the sizes of all earlier ones are summed up.
COMPACT_EVERY = 50


def evaluate_so_far(
    batch: DataFrame,
    rules,
    state_path: str,
    batch_id: int,
    *,
    name: str = "rules",
    by: Sequence[str] = (),
    parts: Sequence[str] = (),
    references: Mapping[str, DataFrame] | None = None,
    as_of: datetime | None = None,
    compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Takes in a batch and judges the rules over all batches up to it, a row per rule.

    Batches are numbered upwards; one that is given again takes its own place. The rules must stay
    the same over the batches: a rule that is new has its metric over the batches since. ``parts``:
    columns that tell the files of a batch apart in the kept states. Rules that need the rows of
    all batches (over two data sets, histograms, mutual information, an age from now on) are an ``ERROR``.
    """
    spark = batch.sparkSession
    context = Context(batch, references or {}, as_of)
    constraints = [compile_rule(r, context) for r in to_rules(spark, rules, name)]
    alias = named_metrics(constraints)
    grouped = [m for m in alias if m.family == GROUPS]
    plain = S.mergeable([m for m in alias if m.family not in (GROUPS, FRAME)])
    failed = {m: "is not kept over batches" for m in alias if m not in grouped and m not in plain}
    frames = []
    if plain:
        own = f"{state_path}/partials/{BATCH}={batch_id}"
        S.partial_states(batch, plain, [*by, *parts]).hint("rebalance").write.mode("overwrite").parquet(own)
        kept = spark.read.parquet(f"{state_path}/partials").where(F.col(BATCH) <= batch_id)
        frames.append((S.metrics_of(kept, plain, [alias[m] for m in plain], by), plain))
    if grouped:
        state = KeyedState(spark, f"{state_path}/keys", by)
        state.add(batch, grouped, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            state.compact(batch_id)
        frames.append((state.metrics(grouped, [alias[m] for m in grouped], batch_id), grouped))
    return judge(batch.select(*map(ref, by)), constraints, frames, alias, failed, by)
