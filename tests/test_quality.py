"""Rules: the published regex quirk, null handling, actions."""

import pytest
from pyspark.sql import functions as F

from twinreach.operators import quality as ql


@pytest.fixture()
def emails(spark):
    rows = [("1", "a@b.com", "M"), ("2", "a@bXcom", "F"), ("3", "a@x.|||", "Other"),
            ("4", None, "U"), ("5", "plain", None)]
    return spark.createDataFrame(rows, "user_id string, email string, gender string")


def _flags(df, rules):
    return {r.user_id: (r.email_not_null, r.email_format_valid, r.gender_valid)
            for r in ql.expectation_flags(df, dict((n, c) for n, c, _ in rules), keep=["user_id"]).collect()}


def test_as_published_regex_quirk(emails):
    f = _flags(emails, ql.RULES_AS_PUBLISHED)
    assert f["1"][1] == 1 and f["2"][1] == 1 and f["3"][1] == 1
    assert f["4"] == (0, 0, 0)          # null email fails both, gender U fails
    assert f["5"][2] == 0               # null gender counts as failed


def test_corrected_regex(emails):
    f = _flags(emails, ql.RULES_CORRECTED)
    assert f["1"][1] == 1 and f["2"][1] == 0 and f["3"][1] == 0


def test_report_and_load_by_tag(spark, emails):
    rules = ql.load_rules(ql.rules_frame(spark), "audience_team")
    assert list(rules) == ["email_not_null", "email_format_valid", "gender_valid"]
    assert ql.load_rules(ql.rules_frame(spark), "other_team") == {}
    rep = {r.rule: (r.passed, r.failed) for r in ql.expectation_report(emails, rules).collect()}
    assert rep["email_not_null"] == (4, 1)
    assert rep["gender_valid"] == (3, 2)


def test_actions(spark, emails):
    rules = ql.load_rules(ql.rules_frame(spark), "audience_team")
    kept, obs = ql.apply_expectations(emails, rules, "warn")
    assert kept.count() == 5
    assert obs.get["email_not_null"] == 1
    dropped, _ = ql.apply_expectations(emails, rules, "drop")
    assert sorted(r.user_id for r in dropped.collect()) == ["1", "2", "3"]
    failing, _ = ql.apply_expectations(emails, rules, "fail")
    with pytest.raises(Exception):
        failing.collect()
    ok, _ = ql.apply_expectations(emails.where(F.col("user_id") == "1"), rules, "fail")
    assert ok.count() == 1
