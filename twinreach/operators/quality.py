"""Table-driven data-quality rules ("expectations").

A rule is a name and a SQL boolean expression; rules live in a small table
with a tag, are loaded by tag, and are evaluated inside the plan with
``F.expr``.  A rule whose expression is null for a row counts as failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The rules as the reference stores them (name, constraint, tag).
# The constraint is the text held in the rules table, i.e. after the SQL
# literal that created it was parsed once.  Parsing it again as an expression
# turns "\." into ".", so the format rule's dot matches any character, and
# "[A-Z|a-z]" admits "|" as well.  Kept as published.
RULES_AS_PUBLISHED = (
    ("email_not_null", "email IS NOT NULL", "audience_team"),
    ("email_format_valid", r'email RLIKE "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}$"', "audience_team"),
    ("gender_valid", 'gender IN ("M", "F", "Other")', "audience_team"),
)

# The same rules with the format rule matching a literal dot and letters only.
RULES_CORRECTED = (
    ("email_not_null", "email IS NOT NULL", "audience_team"),
    ("email_format_valid", r"email RLIKE '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'", "audience_team"),
    ("gender_valid", "gender IN ('M', 'F', 'Other')", "audience_team"),
)


def rules_frame(spark: SparkSession, rules=RULES_AS_PUBLISHED) -> DataFrame:
    """The rules table: ``name string, constraint string, tag string``."""
    return spark.createDataFrame(list(rules), "name string, constraint string, tag string")


def load_rules(rules_df: DataFrame, tag: str) -> dict[str, str]:
    """``{name: constraint}`` of the rules carrying ``tag``.

    Rules are configuration, a handful of rows, so they are collected; the
    data they check never leaves the executors.
    """
    rows = rules_df.where(F.col("tag") == tag).select("name", "constraint").collect()
    return {r["name"]: r["constraint"] for r in rows}


def rule_passes(constraint: str) -> Column:
    """True when the row satisfies the rule; a null result counts as false."""
    return F.coalesce(F.expr(constraint), F.lit(False))


def expectation_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule: ``rule, constraint, passed, failed``.

    All rules are counted in one aggregation over one scan of ``df``.
    """
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~rule_passes(rules[n])).alias(f"_f{i}") for i, n in enumerate(names)],
    )
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(rules[n]).alias("constraint"),
                 F.col(f"_f{i}").alias("failed"))
        for i, n in enumerate(names)
    ])).alias("r")
    return (counts.select(F.col("_rows"), per_rule)
                  .select("r.rule", "r.constraint",
                          (F.col("_rows") - F.col("r.failed")).cast("long").alias("passed"),
                          F.col("r.failed").cast("long").alias("failed")))


def expectation_flags(df: DataFrame, rules: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Per row, one int flag per rule (1 = passed) and the count of failures."""
    base = [F.col(c) for c in (keep if keep is not None else df.columns)]
    flags = [rule_passes(c).cast("int").alias(n) for n, c in rules.items()]
    failed = sum((1 - rule_passes(c).cast("int") for c in rules.values()), F.lit(0))
    return df.select(*base, *flags, failed.cast("int").alias("failed_rules"))


def apply_expectations(df: DataFrame, rules: dict[str, str], action: str = "warn",
                       name: str = "expectations"):
    """Apply rules the way a pipeline table does.

    ``warn``: keep every row; failure counts are recorded on an
    ``Observation`` (read after the first action).  ``drop``: keep rows that
    pass all rules.  ``fail``: raise on the first failing row, on the
    executor that meets it.  Returns ``(df, observation or None)``.
    """
    if action == "warn":
        obs = Observation(name)
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(~rule_passes(c)).alias(n) for n, c in rules.items()])
        return observed, obs
    all_ok = F.lit(True)
    for c in rules.values():
        all_ok = all_ok & rule_passes(c)
    if action == "drop":
        return df.where(all_ok), None
    if action == "fail":
        check = F.assert_true(all_ok, F.lit(f"{name}: a row failed a rule"))
        return df.where(F.coalesce(check.cast("boolean"), F.lit(True))), None
    raise ValueError(f"unknown action {action!r}")
