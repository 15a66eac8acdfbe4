"""Rules evaluated on newly arrived files, results appended once per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plumbline.plans.evaluate import evaluate, to_rules
from plumbline.streaming.accumulated import evaluate_so_far

FILE = "source_file"


def evaluate_arriving(
    spark: SparkSession,
    path: str,
    schema: StructType,
    rules,
    results_path: str,
    checkpoint_path: str,
    *,
    name: str = "rules",
    per_file: bool = False,
    max_files: int | None = None,
    state_path: str | None = None,
    **kwargs,
) -> StreamingQuery:
    """Judges all files not seen before, then stops; run it again for the next arrivals.

    A micro-batch owns the ``batch_id`` partition of the results and overwrites it, so
    one that is retried after a failure leaves its results once. ``per_file`` judges
    every file on its own. With ``state_path``, which belongs to one checkpoint, the rules
    are judged over all files that have arrived up to a micro-batch (``evaluate_so_far``).
    """
    if per_file and state_path is not None:
        raise ValueError("a file on its own needs no state of others")
    compiled = to_rules(spark, rules, name)
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.parquet(path)
    if per_file or state_path is not None:
        files = files.withColumn(FILE, F.col("_metadata.file_path"))

    def judge(batch: DataFrame, batch_id: int) -> None:
        if state_path is not None:
            results = evaluate_so_far(batch, compiled, state_path, batch_id, parts=[FILE], **kwargs)
        else:
            by = [FILE] if per_file else []
            results = evaluate(batch, compiled, by=by, **kwargs)
        (
            results.withColumn("batch_id", F.lit(batch_id))
            .hint("rebalance")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(results_path)
        )

    return (
        files.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
