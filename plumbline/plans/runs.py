"""Runs kept in a store: rulesets in, profiles, suggestions and results out.

The store is a folder of append-only Parquet tables. Data stays in DataFrames; only single
records (a run, a ruleset) are read back to the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.operators.profile import counted_values, profile, value_counts
from plumbline.operators.suggest import recommend, suggest, suggested_values, value_sets
from plumbline.plans.evaluate import evaluate
from plumbline.plans.rules import explode_rules, rules_of
from plumbline.plans.score import result_records, tally
from plumbline.sources.keyed_store import KeyedStore
from plumbline.sources.readers import read_source
from plumbline.sources.records import (
    EXPIRY_DAYS,
    append_record,
    compact_records,
    first_written,
    latest_by_key,
    read_records,
    series_view,
)

RUN_SCHEMA = (
    "RunId string, Kind string, Status string, StatusMsg string, DataSource string, "
    "RulesetNames array<string>, ResultIds array<string>, StartedOn timestamp, "
    "CompletedOn timestamp, DqJobName string, DqRunId string"
)
# Tables of a store.
TABLES = (
    "runs", "rulesets", "profiles", "suggestions", "values", "results", "batches", "steps", "statuses",
)
# Tables read by key, and their keys.
KEYED = {"runs": "RunId", "rulesets": "Name", "results": "ResultId"}
RULESET_SCHEMA = (
    "Name string, Description string, Ruleset string, Tags map<string,string>, "
    "DataSource map<string,string>, "
    "TargetTable struct<CatalogId:string,DatabaseName:string,TableName:string>"
)


# Fixed formats: how run ids begin, and the message of a run without data.
RUN_PREFIX = {"profile": "dqprofile", "suggestion": "dqrecrun", "evaluation": "dqrun"}
EMPTY = "Empty Dataframe"


class NotFound(LookupError):
    """No record under that key."""


def _now() -> datetime:
    return datetime.now(timezone.utc)


class DataQuality:
    """Profiles, suggests, recommends and evaluates, recording every run.

    A data source is ``{"Path": ...}``, ``{"Table": {"DatabaseName", "TableName"}}`` or
    ``{"SQL": ...}``.
    """

    def __init__(
        self,
        spark: SparkSession,
        store: str,
        job_name: str = "interactive",
        job_run_id: str = "ad-hoc",
    ) -> None:
        self.spark = spark
        self.store = store.rstrip("/")
        self.job_name = job_name
        self.job_run_id = job_run_id

    # --- records -----------------------------------------------------------------

    def _keyed(self, table: str, store: str | None = None) -> KeyedStore:
        return KeyedStore(self.spark, f"{store or self.store}/{table}", [KEYED[table]])

    def _versions(self, table: str) -> DataFrame | None:
        return self._keyed(table).read() if table in KEYED else read_records(self.spark, f"{self.store}/{table}")

    def append(self, rows: DataFrame, table: str) -> None:
        """Adds rows to a table of the store."""
        if table in KEYED:
            self._keyed(table).append(rows)
        else:
            append_record(rows, f"{self.store}/{table}")

    def has(self, table: str) -> bool:
        return self._versions(table) is not None

    def table(self, table: str) -> DataFrame:
        """All versions of all rows recorded in a table of the store."""
        versions = self._versions(table)
        if versions is None:
            raise NotFound(f"nothing recorded in {table!r}")
        return versions

    def compact(self, days: int = EXPIRY_DAYS) -> None:
        """The tables read by key, compacted where they are; readers and writers go on meanwhile."""
        for table in KEYED:
            self._keyed(table).compact(days=days)

    def compact_to(self, store: str, days: int = EXPIRY_DAYS) -> DataQuality:
        """The living records of all tables in a new store, a folder per day or key; work goes on there."""
        for table in TABLES:
            target = f"{store.rstrip('/')}/{table}"
            if table in KEYED:
                self._keyed(table).copy_to(target, days=days)
            else:
                compact_records(self.spark, f"{self.store}/{table}", target, days=days)
        return DataQuality(self.spark, store, self.job_name, self.job_run_id)

    def _get(self, table: str, key: str, value: str) -> dict:
        found = self._keyed(table).get(value)
        rows = [] if found is None else found.collect()
        if not rows:
            raise NotFound(f"no {key} {value!r} in {table!r}")
        return rows[0].asDict(recursive=True)

    def _put_run(self, run: dict) -> None:
        fields = [f.strip().split()[0] for f in RUN_SCHEMA.split(", ")]
        row = tuple(run.get(f) for f in fields)
        self.append(self.spark.createDataFrame([row], RUN_SCHEMA), "runs")

    def _start(self, kind: str, **fields) -> dict:
        started = _now()
        stamp = started.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        run = {
            # Two runs may start in the same microsecond on different drivers.
            "RunId": f"{RUN_PREFIX[kind]}-{stamp}-{self.job_name}-{uuid.uuid4().hex[:8]}",
            "Kind": kind,
            "Status": "RUNNING",
            "StartedOn": started,
            "DqJobName": self.job_name,
            "DqRunId": self.job_run_id,
            **fields,
        }
        self._put_run(run)
        return run

    def _finish(self, run: dict, status: str, message: str | None = None, **fields) -> dict:
        self._put_run(
            {**run, "Status": status, "StatusMsg": message, "CompletedOn": _now(), **fields}
        )
        return {"RunId": run["RunId"]}

    @contextmanager
    def _recorded(self, run: dict):
        """Records the run as FAILED, with the message, if its work raises."""
        try:
            yield
        except Exception as error:
            self._finish(run, "FAILED", f"{type(error).__name__}: {error}")
            raise

    def get_run(self, RunId: str) -> dict:
        run = self._get("runs", "RunId", RunId)
        run["DataSource"] = json.loads(run["DataSource"])
        return run

    # --- rulesets ----------------------------------------------------------------

    def update_data_quality_ruleset(
        self,
        Name: str,
        Ruleset: str | Iterable[str],
        Description: str | None = None,
        Tags: Mapping[str, str] | None = None,
        DataSource: Mapping[str, str] | None = None,
        TargetTable: Mapping[str, str] | None = None,
        **_ignored,
    ) -> dict:
        text = Ruleset if isinstance(Ruleset, str) else ", \n".join(map(str.strip, Ruleset))
        target = TargetTable and tuple(
            TargetTable.get(k) for k in ("CatalogId", "DatabaseName", "TableName")
        )
        row = (Name, Description, text, dict(Tags or {}), dict(DataSource or {}), target)
        self.append(self.spark.createDataFrame([row], RULESET_SCHEMA), "rulesets")
        return {"Name": Name}

    create_data_quality_ruleset = update_data_quality_ruleset

    def rulesets(self, names: Iterable[str] | None = None) -> DataFrame:
        """Newest version of the rulesets, as a table."""
        versions = self.table("rulesets")
        if names is not None:
            versions = versions.where(F.col("Name").isin(list(names)))
        return latest_by_key(versions, ["Name"])

    def get_data_quality_ruleset(self, Name: str) -> dict:
        ruleset = self._get("rulesets", "Name", Name)
        versions = self.table("rulesets").where(F.col("Name") == Name)
        written = first_written(versions, ["Name"]).first()
        ruleset.pop("written_at")
        return {**ruleset, "CreatedOn": written.CreatedOn, "LastModifiedOn": written.LastModifiedOn}

    # --- profile, suggest, recommend ---------------------------------------------

    def start_data_quality_profile_run(self, DataSource: Mapping) -> dict:
        run = self._start("profile", DataSource=json.dumps(DataSource))
        with self._recorded(run):
            df = read_source(self.spark, DataSource)
            if df is None:
                return self._finish(run, "NODATA", EMPTY)
            rows = profile(df).withColumn("RunId", F.lit(run["RunId"]))
            self.append(rows, "profiles")
            return self._finish(run, "SUCCEEDED")

    def get_data_quality_profile(self, RunId: str) -> dict:
        """The run with its column profiles as a DataFrame, one row per column."""
        run = self.get_run(RunId)
        if run["Status"] == "SUCCEEDED":
            rows = self.table("profiles").where(F.col("RunId") == RunId)
            run["ColumnProfiles"] = rows.drop("RunId", "written_at").orderBy("column_name")
        return run

    def start_data_quality_rule_recommendation_run(
        self, DataSource: Mapping, ProfileRunId: str | None = None, counted: Iterable[str] | None = ()
    ) -> dict:
        """Suggests from the profile of an earlier run if given, else from a new one.

        ``counted``: columns whose values may be constrained, or None for those of few values; what a
        rule's text does not list is kept as rows.
        """
        counted = None if counted is None else list(counted)
        run = self._start("suggestion", DataSource=json.dumps(DataSource))
        with self._recorded(run):
            df = None
            if ProfileRunId is None or counted is None or counted:
                df = read_source(self.spark, DataSource)
            if ProfileRunId is not None:
                profiled = self.get_data_quality_profile(ProfileRunId).get("ColumnProfiles")
            else:
                profiled = None if df is None else profile(df)
            if profiled is None:
                return self._finish(run, "NODATA", EMPTY)
            counts = None
            if df is not None and counted is None:
                counts = counted_values(df, profiled)
            elif df is not None and counted:
                counts = value_counts(df, counted)
            own = F.lit(run["RunId"])
            if counts is not None:
                self.append(suggested_values(profiled, counts).withColumn("RunId", own), "values")
            self.append(suggest(profiled, counts).withColumn("RunId", own), "suggestions")
            return self._finish(run, "SUCCEEDED")

    def get_data_quality_rule_recommendation_run(self, RunId: str) -> dict:
        """The run with its suggestions as a DataFrame, one row per suggestion."""
        run = self.get_run(RunId)
        if run["Status"] == "SUCCEEDED":
            rows = self.table("suggestions").where(F.col("RunId") == RunId)
            rows = rows.drop("RunId", "written_at")
            run["ConstraintSuggestions"] = rows.orderBy("column_name", "suggesting_rule")
        return run

    def value_sets(self, RunId: str) -> dict[str, DataFrame]:
        """The values that the suggestions of a run refer to, by the names they use."""
        if not self.has("values"):
            return {}
        suggestions = self.table("suggestions").where(F.col("RunId") == RunId)
        return value_sets(suggestions, self.table("values").where(F.col("RunId") == RunId))

    get_data_quality_suggestions = get_data_quality_rule_recommendation_run

    def recommend_ruleset(self, table_name: str, RunId: str, database: str = "default") -> dict:
        """Stores the suggestions of a run as ruleset ``<table>_generated``."""
        run = self.get_data_quality_rule_recommendation_run(RunId)
        suggestions = run["ConstraintSuggestions"].withColumn("table_name", F.lit(table_name))
        source = {k: v if isinstance(v, str) else json.dumps(v) for k, v in run["DataSource"].items()}
        rulesets = recommend(suggestions, RunId, source, database)
        self.append(rulesets, "rulesets")
        return {"Name": f"{table_name}_generated"}

    # --- evaluate ----------------------------------------------------------------

    def start_data_quality_ruleset_evaluation_run(
        self,
        DataSource: Mapping,
        RulesetNames: Iterable[str],
        references: Mapping[str, DataFrame] | None = None,
        as_of: datetime | None = None,
    ) -> dict:
        """Evaluates all rulesets in shared passes; one result record per ruleset."""
        names = list(RulesetNames)
        run = self._start(
            "evaluation", DataSource=json.dumps(DataSource), RulesetNames=names
        )
        with self._recorded(run):
            df = read_source(self.spark, DataSource)
            if df is None:
                return self._finish(run, "NODATA", EMPTY)
            rulesets = self.rulesets(names)
            rules = rules_of(explode_rules(rulesets))
            tags = rulesets.select(F.col("Tags")["SuggestionRunId"].alias("run")).distinct().collect()
            sets = [self.value_sets(t.run) for t in tags if t.run]
            known = {name: df for own in sets for name, df in own.items()} | dict(references or {})
            source = {k: v if isinstance(v, str) else json.dumps(v) for k, v in DataSource.items()}
            results = evaluate(df, rules, references=known, as_of=as_of)
            # One row per rule: judged once, then kept as local rows for the record.
            judged = self.spark.createDataFrame(results.collect(), results.schema)
            records = result_records(judged, run["RunId"], source, run["StartedOn"], _now())
            self.append(records, "results")
            ids = [r.ResultId for r in records.select("ResultId").orderBy("ResultId").collect()]
            return self._finish(run, "SUCCEEDED", ResultIds=ids)

    def get_data_quality_ruleset_evaluation_run(self, RunId: str) -> dict:
        return self.get_run(RunId)

    def get_data_quality_result(self, ResultId: str) -> dict:
        return self._get("results", "ResultId", ResultId)

    def metric_trends(self, **options) -> DataFrame:
        """How the metric of every rule moved from run to run: a row per data source, rule and run."""
        rules = self.table("results").select(
            F.col("DataSource").cast("string").alias("data_source"),
            "RulesetName",
            F.to_timestamp("StartedOn").alias("run_ts"),
            F.explode("RuleResults").alias("r"),
        )
        points = rules.select(
            "*", F.col("r.Description").alias("rule_text"), F.col("r.EvaluatedMetrics.Value").alias("metric")
        )
        return series_view(points, "metric", ("data_source", "RulesetName", "rule_text"), **options)

    def tallies(self, RunId: str) -> DataFrame:
        """Tally per ruleset of a run's results."""
        rules = self.table("results").where(F.col("RulesetEvaluationRunId") == RunId)
        rows = rules.select("RulesetName", F.explode("RuleResults").alias("r"))
        flat = rows.select(F.col("RulesetName").alias("ruleset_name"), F.col("r.Result").alias("result"))
        return tally(flat)
