"""The four batch jobs: profile, suggest, recommend, evaluate the tables an event names.

An event is ``{"BatchId", "NameList", "process_parms": {"Base", "Partition", "ExecName"}}``;
the last dot-separated part of the batch id is the file date that ``Dyymmdd`` in the
partition stands for. Tables are independent Spark jobs submitted side by side; one that
fails is recorded as ERROR and leaves the others alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from plumbline.plans import batch as B
from plumbline.plans.evaluate import NO_RESULTS, with_defaults
from plumbline.plans.runs import DataQuality, NotFound
from plumbline.plans.score import flat_results
from plumbline.sources.readers import partition_name
from plumbline.sources.records import latest_by_key
from plumbline.sources.sinks import write_results

EVENT_SCHEMA = (
    "BatchId string, NameList array<string>, "
    "process_parms struct<Base:string,Partition:string,ExecName:string>"
)
BATCH_SCHEMA = (
    "BatchId string, ObjectId string, "
    "ProcessParms struct<Base:string,Partition:string,ExecName:string>"
)
# Steps in their order.
STEPS = ("Step-Profile", "Step-Suggest", "Step-Recommend", "Step-Evaluate")

Outcome = tuple[str, str, str | None]  # status, message, run id


class BatchJobs:
    def __init__(
        self,
        dq: DataQuality,
        event: Mapping,
        overrides: Mapping[str, Mapping] | None = None,
        parallel: int = 8,
    ) -> None:
        """``overrides``: per table its own ``DataSource`` or ``RulesetNames``."""
        self.dq = dq
        self.event = event
        self.batch_id = event["BatchId"]
        self.overrides = overrides or {}
        self.parallel = parallel

    # --- the batch and its steps -------------------------------------------------

    def open(self) -> None:
        """Records the batch and its tables, or the new parameters of a known batch."""
        spark, parms = self.dq.spark, self.event["process_parms"]
        row = (
            self.batch_id,
            list(self.event["NameList"]),
            tuple(parms.get(k) for k in ("Base", "Partition", "ExecName")),
        )
        events = spark.createDataFrame([row], EVENT_SCHEMA)
        if self.dq.has("batches"):
            known = latest_by_key(self.dq.table("batches"), ["BatchId", "ObjectId"])
        else:
            known = spark.createDataFrame([], BATCH_SCHEMA)
        self.dq.append(B.open_batch(events, known.select("BatchId", "ObjectId", "ProcessParms")), "batches")

    def items(self) -> list[dict]:
        """The tables of the batch with their sources and rulesets; a row per table."""
        newest = latest_by_key(self.dq.table("batches"), ["BatchId", "ObjectId"])
        header, tables = B.read_batch(newest, self.batch_id)
        parms = header.first().ProcessParms
        partition = partition_name(parms.Partition, self.batch_id)
        names = sorted(r.ObjectId for r in tables.select("ObjectId").collect())
        return [
            with_defaults({"ObjectId": n, **self.overrides.get(n, {})}, parms.Base, partition)
            for n in names
        ]

    def steps(self) -> DataFrame:
        """Newest record of every step of the batch."""
        steps = self.dq.table("steps").where(F.col("batch_id") == self.batch_id)
        return latest_by_key(steps, ["batch_id", "object_id", "step"], ["time"])

    def status(self, strict_reference: bool = False) -> DataFrame:
        return B.batch_status(B.item_status(self.steps()), strict_reference)

    def record_status(self, strict_reference: bool = False) -> DataFrame:
        """Records the status of every table and of the batch as they are now; gives the recorded rows."""
        rows = B.status_records(B.item_status(self.steps()), strict_reference)
        self.dq.append(rows, "statuses")
        return self.recorded_status()

    def recorded_status(self) -> DataFrame:
        """What was recorded last of every table and of the batch."""
        rows = self.dq.table("statuses").where(F.col("batch_id") == self.batch_id)
        return latest_by_key(rows, ["batch_id", "object_id"])

    def _run_of(self, step: str) -> dict[str, str]:
        """Run id per table of an earlier step; a row per table."""
        done = self.steps().where((F.col("step") == step) & (F.col("status") == "COMPLETED"))
        return {r.object_id: r.run_id for r in done.select("object_id", "run_id").collect()}

    def _each(self, step: str, work: Callable[[dict], Outcome]) -> list[dict]:
        def guarded(item: dict) -> dict:
            table = item["table_name"]
            try:
                status, message, run_id = work(item)
            except (PySparkException, LookupError, ValueError) as error:
                status, message, run_id = "ERROR", f"{table}\n{error}", None
            return {
                "batch_id": self.batch_id,
                "object_id": table,
                "step": step,
                "step_no": STEPS.index(step) + 1,
                "status": status,
                "status_msg": message,
                "run_id": run_id,
                "time": datetime.now(timezone.utc),
            }

        with ThreadPoolExecutor(max_workers=self.parallel) as pool:
            return list(pool.map(guarded, self.items()))

    def _log(self, rows: Iterable[Mapping]) -> DataFrame:
        steps = B.step_log(self.dq.spark, list(rows))
        self.dq.append(steps, "steps")
        return steps

    # --- the jobs ----------------------------------------------------------------

    def profile(self) -> DataFrame:
        def work(item: dict) -> Outcome:
            run = self.dq.start_data_quality_profile_run(item["DataSource"])
            return "COMPLETED", run["RunId"], run["RunId"]

        return self._log(self._each("Step-Profile", work))

    def suggest(self, counted: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
        """Suggests from the profiles of the profile job where it ran, else profiles anew.

        ``counted``: per table the columns whose values may be constrained.
        """
        counted = counted or {}
        profiles = self._run_of("Step-Profile") if self.dq.has("steps") else {}

        def work(item: dict) -> Outcome:
            run = self.dq.start_data_quality_rule_recommendation_run(
                item["DataSource"],
                profiles.get(item["table_name"]),
                counted.get(item["table_name"], ()),
            )
            return "COMPLETED", run["RunId"], run["RunId"]

        return self._log(self._each("Step-Suggest", work))

    def recommend(self, database: str = "default") -> DataFrame:
        suggested = self._run_of("Step-Suggest")

        def work(item: dict) -> Outcome:
            table = item["table_name"]
            if table not in suggested:
                raise NotFound("no suggestions in this batch")
            ruleset = self.dq.recommend_ruleset(table, suggested[table], database)
            return "COMPLETED", ruleset["Name"], suggested[table]

        return self._log(self._each("Step-Recommend", work))

    def evaluate(self, results_path: str) -> DataFrame:
        """Evaluates every table, then writes the flat results of all of them in one go."""

        def work(item: dict) -> Outcome:
            run_id = self.dq.start_data_quality_ruleset_evaluation_run(
                item["DataSource"], item["RulesetNames"]
            )["RunId"]
            ids = self.dq.get_run(run_id)["ResultIds"]
            if not ids:
                return "WARNING", NO_RESULTS, run_id
            records = self.dq.table("results").where(F.col("ResultId").isin(ids))
            scores = sorted(tuple(r) for r in records.select("ResultId", "Score").collect())
            return "COMPLETED", "\n".join(f"Ruleset: {i}, Score: {s}" for i, s in scores), run_id

        rows = self._each("Step-Evaluate", work)
        done = {r["run_id"]: r["object_id"] for r in rows if r["status"] == "COMPLETED"}
        if done:
            table_of = F.create_map(*[F.lit(x) for pair in done.items() for x in pair])
            run_id = F.col("RulesetEvaluationRunId")
            records = self.dq.table("results").where(run_id.isin(list(done)))
            exec_name = self.event["process_parms"].get("ExecName") or ""
            write_results(flat_results(records, table_of[run_id], exec_name), results_path, self.batch_id)
        return self._log(rows)
