"""Run records, stored rulesets, batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline import BatchJobs, DataQuality
from plumbline.plans import batch as B
from plumbline.plans.runs import NotFound


@pytest.fixture
def tables(spark, tmp_path):
    base = str(tmp_path / "lake")
    good = spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    good.write.parquet(f"{base}/good/D240131")
    good.where("k < 0").write.parquet(f"{base}/bad/D240131")
    return base


def test_profile_suggest_recommend_evaluate(spark, tables, tmp_path):
    dq = DataQuality(spark, str(tmp_path / "store"), job_name="job")
    source = {"Path": f"{tables}/good/D240131"}
    profile_run = dq.start_data_quality_profile_run(DataSource=source)
    profiled = dq.get_data_quality_profile(**profile_run)
    assert profiled["Status"] == "SUCCEEDED" and profiled["CompletedOn"] >= profiled["StartedOn"]
    assert [r.column_name for r in profiled["ColumnProfiles"].collect()] == ["k", "v"]

    run = dq.start_data_quality_rule_recommendation_run(
        source, ProfileRunId=profile_run["RunId"], counted=["v"]
    )
    suggestions = dq.get_data_quality_suggestions(**run)["ConstraintSuggestions"]
    assert suggestions.count() == 4
    ruleset = dq.recommend_ruleset("good", run["RunId"])
    stored = dq.get_data_quality_ruleset(**ruleset)
    assert stored["Tags"] == {"SuggestionRunId": run["RunId"]}
    assert stored["TargetTable"]["TableName"] == "good"

    dq.create_data_quality_ruleset(Name="own", Ruleset=["HasSize > 1000", 'IsUnique "k"', "HasColour = 1"])
    evaluation = dq.start_data_quality_ruleset_evaluation_run(
        DataSource=source, RulesetNames=["good_generated", "own"]
    )
    done = dq.get_data_quality_ruleset_evaluation_run(**evaluation)
    assert done["Status"] == "SUCCEEDED" and len(done["ResultIds"]) == 2
    scores = {}
    for result_id in done["ResultIds"]:
        result = dq.get_data_quality_result(ResultId=result_id)
        scores[result["RulesetName"]] = (result["Score"], result["Tally"])
        assert result["RulesetEvaluationRunId"] == evaluation["RunId"]
    assert scores["good_generated"] == (1.0, {"RULES": 4, "PASS": 4, "FAIL": 0})
    assert scores["own"] == (0.5, {"RULES": 3, "PASS": 1, "FAIL": 1, "SKIP": 1})
    assert {r.ruleset_name for r in dq.tallies(evaluation["RunId"]).collect()} == {"good_generated", "own"}


def test_no_data_is_a_status(spark, tmp_path):
    dq = DataQuality(spark, str(tmp_path / "store"))
    nowhere = {"Path": str(tmp_path / "nowhere")}
    dq.create_data_quality_ruleset(Name="r", Ruleset="HasSize > 0")
    for start, kwargs in (
        (dq.start_data_quality_profile_run, {}),
        (dq.start_data_quality_rule_recommendation_run, {}),
        (dq.start_data_quality_ruleset_evaluation_run, {"RulesetNames": ["r"]}),
    ):
        run = dq.get_run(**start(DataSource=nowhere, **kwargs))
        assert (run["Status"], run["StatusMsg"]) == ("NODATA", "Empty Dataframe")
    with pytest.raises(NotFound):
        dq.get_data_quality_result(ResultId="none")


def test_update_keeps_creation_time(spark, tmp_path):
    dq = DataQuality(spark, str(tmp_path / "store"))
    dq.create_data_quality_ruleset(Name="r", Ruleset="HasSize > 0")
    first = dq.get_data_quality_ruleset("r")
    dq.update_data_quality_ruleset(Name="r", Ruleset="HasSize > 1", Description="later")
    second = dq.get_data_quality_ruleset("r")
    assert second["Ruleset"] == "HasSize > 1"
    assert second["CreatedOn"] == first["CreatedOn"] < second["LastModifiedOn"]


def event(base, names):
    parms = {"Base": base, "Partition": "Dyymmdd", "ExecName": "exec-1"}
    return {"BatchId": "FEED.EVAL.D240131", "NameList": names, "process_parms": parms}


def test_batch_of_tables(spark, tables, tmp_path):
    dq = DataQuality(spark, str(tmp_path / "store"))
    for name in ("good", "gone", "bad"):
        dq.create_data_quality_ruleset(Name=f"{name}_generated", Ruleset='HasSize > 100, IsUnique "k"')
    overrides = {"broken": {"DataSource": {"SQL": "SELECT x"}}}
    jobs = BatchJobs(dq, event(tables, ["good", "gone", "bad", "broken"]), overrides, parallel=4)
    jobs.open()
    results = str(tmp_path / "results")
    steps = jobs.evaluate(results)
    status = {r.object_id: r.status for r in steps.collect()}
    assert status == {"good": "COMPLETED", "gone": "WARNING", "bad": "COMPLETED", "broken": "ERROR"}
    written = spark.read.parquet(results)
    found = {(r.table_name, r.partition, r.Name, r.Result, r.sfn_exec_name) for r in written.collect()}
    assert found == {
        ("good", "D240131.EVAL", "Rule_0", "PASS", "exec-1"),
        ("good", "D240131.EVAL", "Rule_1", "PASS", "exec-1"),
        ("bad", "D240131.EVAL", "Rule_0", "FAIL", "exec-1"),
        ("bad", "D240131.EVAL", "Rule_1", "FAIL", "exec-1"),
    }
    assert set(written.columns) == {
        "Name", "Result", "dqdl_rule", "EvaluationMessage", "result_id", "table_name", "sfn_exec_name", "partition",
    }
    assert jobs.status().first().status == "FAILED"
    assert jobs.status(strict_reference=True).first().status == "SUCCEEDED"


def test_all_four_jobs(spark, tables, tmp_path):
    dq = DataQuality(spark, str(tmp_path / "store"))
    jobs = BatchJobs(dq, event(tables, ["good", "gone"]))
    jobs.open()
    jobs.open()
    assert [i["table_name"] for i in jobs.items()] == ["gone", "good"]
    jobs.profile()
    jobs.suggest()
    recommended = {r.object_id: r.status for r in jobs.recommend().collect()}
    assert recommended == {"good": "COMPLETED", "gone": "ERROR"}
    jobs.evaluate(str(tmp_path / "results"))
    last = {(r.object_id, r.step): r.status for r in jobs.steps().collect()}
    assert last[("good", "Step-Evaluate")] == "COMPLETED"
    jobs.record_status()
    recorded = {r.object_id: (r.status, r.file_counts) for r in jobs.recorded_status().collect()}
    batch = recorded.pop(jobs.batch_id)
    assert recorded == {"good": ("COMPLETED", None), "gone": ("ERROR", None)} or recorded["gone"][0] == "WARNING"
    assert batch[0] in ("FAILED", "PARTIAL") and batch[1]["BATCH"] == 2 and batch[1]["COMPLETED"] == 1
    assert {r.Result for r in spark.read.parquet(str(tmp_path / "results")).collect()} == {"PASS"}
    runs = dq.table("runs").where("Kind = 'suggestion' AND Status <> 'RUNNING'")
    assert {r.Status for r in runs.collect()} == {"SUCCEEDED", "NODATA"}


STEP = "batch_id string, object_id string, step_no int, status string"


@pytest.mark.parametrize(
    ("statuses", "want"),
    [
        (["COMPLETED", "COMPLETED"], "SUCCEEDED"),
        (["COMPLETED", "PENDING"], "RUNNING"),
        (["RUNNING", "INGESTED"], "PARTIAL"),
        (["INGESTED", "INVALID"], "FAILED"),
        (["WARNING", "COMPLETED"], "PARTIAL"),
        (["ERROR", "RUNNING"], "FAILED"),
    ],
)
def test_batch_status(spark, statuses, want):
    steps = spark.createDataFrame([("b", str(i), 1, s) for i, s in enumerate(statuses)], STEP)
    (row,) = B.batch_status(B.item_status(steps)).collect()
    assert row.status == want
    assert sum(row.file_counts.values()) == row["items"] == len(statuses)


def test_last_open_step_decides(spark):
    steps = [("b", "i", 1, "FAILED"), ("b", "i", 2, "RUNNING"), ("b", "i", 3, "COMPLETED")]
    assert B.item_status(spark.createDataFrame(steps, STEP)).first().status == "RUNNING"


def test_open_batch(spark):
    schema = "BatchId string, NameList array<string>, process_parms struct<ExecName:string>"
    events = spark.createDataFrame([("b1", ["t", "u"], ("new",)), ("b2", ["t"], ("new",))], schema)
    known = spark.createDataFrame([("b1", "b1", ("old",))], "BatchId string, ObjectId string, ProcessParms struct<ExecName:string>")
    rows = {(r.BatchId, r.ObjectId, r.ProcessParms and r.ProcessParms.ExecName) for r in B.open_batch(events, known).collect()}
    assert rows == {("b1", "b1", "new"), ("b2", "b2", "new"), ("b2", "t", None)}
    header, items = B.read_batch(B.open_batch(events, known.where("false")), "b1")
    assert (header.count(), items.count()) == (1, 2)
