"""Rule text: splitting, parts, and what cannot be run."""

from __future__ import annotations

import pytest

from plumbline import Check, evaluate, explode_rules
from plumbline.functions.assertions import Assertion, assertion
from plumbline.plans.rules import parse_rules, rulesets_frame


def rules(spark, text):
    return parse_rules(spark, {"r": text})


def test_splits_on_rules_only(spark):
    text = (
        "HasSize between 1 and 3.5, \n"
        'IsContainedIn "c d" in ["a, B x","q""z",", HasSize (x)"] with threshold >= 0.9, '
        'IsContainedIn "x" in [1,2, 3],HasPattern "a" matches "^[a,b] HasMin, Foo$", '
        'HasDataType "p" = "Integral", DataFreshness "ts" <= 10 days, Foo, HasMin "b" != 0'
    )
    found = rules(spark, text)
    assert [r.rule_type for r in found] == [
        "HasSize",
        "IsContainedIn",
        "IsContainedIn",
        "HasPattern",
        "HasDataType",
        "DataFreshness",
        "Foo",
        "HasMin",
    ]
    assert [r.rule_no for r in found] == list(range(8))
    size, listed, numbers, pattern, kind, age, _, unequal = found
    assert (size.op, size.lo, size.hi) == ("between", 1.0, 3.5)
    assert listed.columns == ("c d",)
    assert listed.in_list == ("a, B x", 'q"z', ", HasSize (x)")
    assert (listed.threshold_op, listed.threshold_lo) == (">=", 0.9)
    assert numbers.in_list == ("1", "2", "3")
    assert pattern.in_list == ("^[a,b] HasMin, Foo$",)
    assert (kind.op, kind.in_list) == ("=", ("Integral",))
    assert (age.op, age.lo, age.unit) == ("<=", 10.0, "days")
    assert unequal.op == "!="


def test_unquoted_list_of_names_stays_whole(spark):
    found = rules(spark, 'IsContainedIn "x" in [A, B, C], HasSize > 1')
    assert [r.rule_type for r in found] == ["IsContainedIn", "HasSize"]
    assert found[0].in_list == ("A", "B", "C")


def test_threshold_is_the_one_outside_of_quotes(spark):
    text = 'IsContainedIn "x" in ["a with threshold > 1","b"] with threshold >= 0.5'
    (rule,) = rules(spark, text)
    assert rule.in_list == ("a with threshold > 1", "b")
    assert (rule.threshold_op, rule.threshold_lo) == (">=", 0.5)
    (rule,) = rules(spark, 'IsContainedIn "x" in ["a with threshold > 1"]')
    assert (rule.in_list, rule.threshold_op) == (("a with threshold > 1",), None)


def test_value_with_line_break_is_kept(spark):
    (rule,) = rules(spark, 'IsContainedIn "x" in ["a\nb","c"]')
    assert rule.in_list == ("a\nb", "c")


def test_long_ruleset(spark):
    values = ",".join(f'"v{i}, X (y)"' for i in range(120))
    text = ", \n".join(f'IsContainedIn "c{i}" in [{values}]' for i in range(60))
    found = rules(spark, text)
    assert len(found) == 60
    assert all(len(r.in_list) == 120 for r in found)


def test_list_and_text_of_rules_are_the_same(spark):
    listed = ["HasSize >= 3", 'IsComplete "c" ']
    both = rulesets_frame(spark, {"r": listed, "t": ", \n".join(listed)})
    rows = explode_rules(both).collect()
    assert {(r.ruleset_name, r.rule_no, r.rule_text) for r in rows} == {
        (n, i, t) for n in "rt" for i, t in enumerate(["HasSize >= 3", 'IsComplete "c"'])
    }


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (">= 3", Assertion(">=", 3.0)),
        ("= -1.5e2", Assertion("=", -150.0)),
        ("between 0.5 and 2", Assertion("between", 0.5, 2.0)),
        ("in [1, 2]", Assertion("in", None, None, (1.0, 2.0))),
        (7, Assertion("=", 7.0)),
        (None, Assertion("=", 1.0)),
    ],
)
def test_assertions(text, want):
    assert assertion(text) == want
    assert assertion(want.text) == want


def test_assertion_rejects_what_it_cannot_mean():
    for text in ("!= 3", "about 3", "between 1 or 2"):
        with pytest.raises(ValueError):
            assertion(text)


def statuses(spark, df, texts, **kwargs):
    rows = evaluate(df, texts, **kwargs).collect()
    return {r.rule_no: (r.result, r.message) for r in rows}


def test_rules_that_cannot_run_are_reported(spark):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    texts = [
        'HasMin "n" != 0',
        'IsComplete "gone"',
        'HasMin "t" > 0',
        "HasColour = 1",
        'Satisfies "n > nothing"',
        'HasApproxQuantile "n" "half" > 0',
        'ReferentialIntegrity "n" "other.id"',
        'CustomSql "SELECT x FROM {primary}"',
        "IsComplete",
        'HasDataType "t" = "no such type"',
        'DataFreshness "n" <= 10 days',
        'HasSize >= many',
        'HasMinLength "n" > 0',
        'IsContainedIn "t"',
    ]
    found = statuses(spark, df, texts)
    assert [found[i][0] for i in range(len(texts))] == [
        "SKIP" if i == 3 else "ERROR" for i in range(len(texts))
    ]
    assert all(message for _, message in found.values())
    assert found[3][1] == "Rule Type 'HasColour' is not implemented."


def test_other_names_mean_the_same(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "n int, t string")
    pairs = [
        ("RowCount = 3", "HasSize = 3"),
        ('Completeness "t" > 0.5', 'HasCompleteness "t" > 0.5'),
        ('Mean "n" = 2', 'HasMean "n" = 2'),
        ('Uniqueness "t" < 1', 'HasUniqueness "t" < 1'),
        ('DistinctValuesCount "t" = 1', 'HasNumberOfDistinctValues "t" = 1'),
        ('ColumnDataType "t" = "String"', 'HasDataType "t" = "String"'),
    ]
    rows = evaluate(df, [t for pair in pairs for t in pair]).collect()
    by_no = {r.rule_no: (r.metric, r.result) for r in rows}
    for i in range(len(pairs)):
        assert by_no[2 * i] == by_no[2 * i + 1]
        assert by_no[2 * i][1] == "PASS"


def test_builder_and_text_agree(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (None, None)], "n int, t string")
    check = (
        Check("r")
        .hasSize(lambda x: x >= 3)
        .hasMin("n", "= 1")
        .isContainedIn("t", ["a b", "c"])
        .hasCompleteness("n", "between 0.5 and 0.7")
        .hasPattern("t", "^[a-c]", ">= 0.6")
        .columnLength("t", ">", 1, assertion=">= 0.3")
    )
    texts = [
        "HasSize >= 3",
        'HasMin "n" = 1',
        'IsContainedIn "t" in ["a b","c"]',
        'HasCompleteness "n" between 0.5 and 0.7',
        'HasPattern "t" matches "^[a-c]" with threshold >= 0.6',
        'ColumnLength "t" > 1 with threshold >= 0.3',
    ]
    built = {r.rule_no: (r.metric, r.result) for r in evaluate(df, check).collect()}
    parsed = {r.rule_no: (r.metric, r.result) for r in evaluate(df, texts).collect()}
    assert built == parsed
    assert all(result == "PASS" for _, result in built.values())
