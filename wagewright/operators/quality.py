"""Quality checks compiled into as few passes as they need, and anomaly reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, NumberFormatException, ParseException, SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.functions.numeric import mean, money, ratio, rounded, std, zero
from wagewright.functions.text import is_blank
from wagewright.operators.history import over_history
from wagewright.operators.ordering import lower_quarter, upper_quarter
from wagewright.operators.selection import at_positions

RESULT = ["check_name", "total", "violations", "passed", "low", "high"]


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    field: str = ""
    threshold: float = 100.0
    low: float = 0.0
    high: float = 0.0
    rule: Column | str | None = None


def complete(field: str, threshold: float = 100.0) -> Check:
    return Check(f"completeness_{field}", "completeness", field, threshold=threshold)


def unique(field: str) -> Check:
    return Check(f"uniqueness_{field}", "uniqueness", field)


def within(field: str, low: float, high: float) -> Check:
    return Check(f"range_{field}", "range", field, low=low, high=high)


def consistent(name: str, rule: Column | str) -> Check:
    """A predicate every row must meet; NULL counts as a violation."""
    return Check(name, "consistency", rule=rule)


def _met(check: Check) -> Column:
    rule = F.expr(check.rule) if isinstance(check.rule, str) else check.rule
    return F.coalesce(rule, F.lit(False))


def _one_pass(check: Check) -> tuple[Column, Column, Column]:
    """(violations, low, high) of a check as aggregates over the rows."""
    none = F.lit(None).cast("double")
    if check.kind == "completeness":
        return F.count_if(is_blank(check.field)), none, none
    if check.kind == "range":
        x = zero(check.field).cast("double")
        return F.count_if(~x.between(check.low, check.high)), F.min(x), F.max(x)
    return F.count_if(~_met(check)), none, none


def _duplicates(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Duplicated values of several fields in one pass; blank and zero values are skipped.

    Each row gives a (check, value) pair per field. Grouped by both, so a frequent
    value is combined before it is shuffled; a check without values still gives a row.
    """
    kinds = dict(df.dtypes)
    pairs, names = [], []
    for i, c in enumerate(checks):
        field = F.col(c.field)
        used = ~is_blank(c.field) if kinds[c.field] == "string" else field.isNotNull() & (field != 0)
        pairs.append(F.struct(F.lit(i).alias("_check"), F.when(used, field.cast("string")).alias("_value")))
        names.append(F.when(F.col("_check") == i, F.lit(c.name)))
    counts = df.select(F.inline(F.array(*pairs))).groupBy("_check", "_value").agg(F.count("_value").alias("_n"))
    every = df.sparkSession.range(len(checks)).select(F.col("id").cast("int").alias("_check"), F.lit(None).cast("string").alias("_value"), F.lit(0).cast("bigint").alias("_n"))
    sums = counts.unionByName(every).groupBy("_check").agg(F.sum("_n").alias("total"), F.count_if(F.col("_n") > 1).alias("violations"))
    none = F.lit(None).cast("double")
    # One row per check: in the order given, as the row checks are.
    return sums.coalesce(1).sortWithinPartitions("_check").select(
        F.coalesce(*names).alias("check_name"), "total", "violations",
        (F.col("violations") == 0).cast("int").alias("passed"), none.alias("low"), none.alias("high"),
    )


def _refused(df: DataFrame, check: Check) -> str | None:
    """Why a check can't be planned over these columns; no job runs."""
    try:
        if check.kind == "uniqueness":
            df.select(check.field).schema
        else:
            df.agg(*[c.alias(f"_{i}") for i, c in enumerate(_one_pass(check))]).schema
    except (AnalysisException, ParseException) as e:
        return e.getCondition() or str(e)
    return None


def _failed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(n, None, None, 0, None, None) for n in names], "check_name string, total bigint, violations bigint, passed int, low double, high double"
    )


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One result row per check: all row checks share one pass, all uniqueness checks another.

    A check that names no column of the input or can't be parsed is a failed
    row without counts, and the others go on. An error that a value raises
    (a bad cast, say) only shows when the plan runs: see ``run_suite``.
    """
    try:
        return _results(df, checks, [])
    except (AnalysisException, ParseException, KeyError):  # only then is it asked which checks can't be planned
        refused = [_refused(df, c) for c in checks]
        return _results(df, [c for c, why in zip(checks, refused) if not why], [c.name for c, why in zip(checks, refused) if why])


def _results(df: DataFrame, checks: list[Check], bad: list[str]) -> DataFrame:
    single = [c for c in checks if c.kind != "uniqueness"]
    distinct = [c for c in checks if c.kind == "uniqueness"]
    parts = [_duplicates(df, distinct)] if distinct else []
    if bad or not checks:
        parts.append(_failed(df, bad))
    if single:
        aggs = []
        for i, c in enumerate(single):
            wrong, low, high = _one_pass(c)
            aggs += [wrong.alias(f"v{i}"), low.alias(f"lo{i}"), high.alias(f"hi{i}")] if c.kind == "range" else [wrong.alias(f"v{i}")]
        row = df.agg(F.count("*").alias("total"), *aggs)
        none = F.lit(None).cast("double")
        entries = [
            F.struct(
                F.lit(c.name).alias("check_name"), F.lit(c.kind).alias("kind"), F.lit(float(c.threshold)).alias("threshold"),
                F.col(f"v{i}").alias("violations"),
                (F.col(f"lo{i}") if c.kind == "range" else none).alias("low"),
                (F.col(f"hi{i}") if c.kind == "range" else none).alias("high"),
            )
            for i, c in enumerate(single)
        ]
        flat = row.select("total", F.inline(F.array(*entries)))
        filled = F.coalesce(F.try_divide((F.col("total") - F.col("violations")) * 100.0, F.col("total")), F.lit(0.0))
        ok = F.when(F.col("kind") == "completeness", filled >= F.col("threshold")).otherwise(F.col("violations") == 0)
        parts.insert(0, flat.withColumn("passed", ok.cast("int")).select(*RESULT))
    return reduce(DataFrame.unionByName, parts)


#: Errors that a value or a rule causes; a lost executor or a missing file isn't among them.
RULE_ERRORS = (ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, NumberFormatException, SparkRuntimeException)


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``run_checks`` carried out now, with errors raised by values isolated as well.

    The driver holds one row per check. If the shared pass raises, each check
    runs by itself and those that raise again are failed rows without counts.
    """
    def rows(some: list[Check]) -> list:
        return [tuple(r) for r in run_checks(df, some).select(*RESULT).collect()]

    try:
        found = rows(checks)
    except RULE_ERRORS:
        found = []
        for c in checks:
            try:
                found += rows([c])
            except RULE_ERRORS:
                found.append((c.name, None, None, 0, None, None))
    return df.sparkSession.createDataFrame(found, _failed(df, []).schema)


def examples(df: DataFrame, check: Check, order: str, n: int = 3) -> DataFrame:
    """The first n rows (or duplicated values) that break a check."""
    if check.kind == "uniqueness":
        counts = df.filter(~is_blank(check.field)).groupBy(check.field).agg(F.count("*").alias("times")).filter("times > 1")
        found = counts.orderBy(F.col("times").desc(), check.field).limit(n)
        return found.select(F.lit(check.name).alias("check_name"), F.col(check.field).cast("string").alias("example"), "times")
    bad = {
        "completeness": is_blank(check.field) if check.field else None,
        "range": ~zero(check.field).cast("double").between(check.low, check.high) if check.field else None,
        "consistency": ~_met(check) if check.rule is not None else None,
    }[check.kind]
    rows = df.filter(bad).orderBy(order).limit(n)
    return rows.select(F.lit(check.name).alias("check_name"), F.col(order).cast("string").alias("example"), F.lit(1).alias("times"))


def score(results: DataFrame, dataset: str) -> DataFrame:
    """Suite totals: PASS from 80 % of checks passed, WARN from 60 %."""
    points = rounded(ratio("passed", "total_checks", 100), 1)
    return (
        results.agg(F.count("*").alias("total_checks"), F.sum("passed").alias("passed"))
        .withColumn("dataset", F.lit(dataset))
        .withColumn("failed", F.col("total_checks") - F.col("passed"))
        .withColumn("score", points)
        .withColumn("status", F.when(F.col("score") >= 80, "PASS").when(F.col("score") >= 60, "WARN").otherwise("FAIL"))
    )


def z_scores(df: DataFrame, field: str) -> DataFrame:
    """Add |z| with the population deviation; a zero deviation counts as 1."""
    x = zero(field).cast("decimal(18,2)")
    stats = df.select(x.alias("_x")).agg(
        F.struct(mean(F.col("_x")).alias("mu"), F.coalesce(F.nullif(std("_x"), F.lit(0.0)), F.lit(1.0)).alias("sd")).alias("s")
    ).scalar()
    return df.withColumn("z", F.abs((x.cast("double") - stats["mu"]) / stats["sd"]))


def iqr_fences(df: DataFrame, field: str) -> DataFrame:
    """Nearest-rank quartiles and the 1.5 IQR fences, one row."""
    amounts = df.select(zero(field).cast("decimal(18,2)").alias("_x"))
    q = at_positions(amounts, "_x", {"q1": lower_quarter(), "q3": upper_quarter()})
    span = (F.col("q3") - F.col("q1")) * F.lit("1.5").cast("decimal(2,1)")
    return q.select("q1", "q3", (F.col("q1") - span).alias("lower"), (F.col("q3") + span).alias("upper"))


def iqr_outliers(df: DataFrame, field: str) -> DataFrame:
    fences = iqr_fences(df, field).select(F.struct("lower", "upper").alias("f")).scalar()
    x = zero(field).cast("decimal(18,2)")
    return df.filter(~x.between(fences["lower"], fences["upper"]))


def anomaly_profile(df: DataFrame, field: str, threshold: float = 3.0) -> DataFrame:
    x = zero(field).cast("decimal(18,2)")
    fences = iqr_fences(df, field).select(F.struct("lower", "upper").alias("f")).scalar()
    rows = z_scores(df.select(field), field).withColumn("_x", x).withColumn("_f", fences)
    stats = rows.agg(
        F.count("*").alias("total_records"), mean(money("_x")).alias("_mu"), std("_x").alias("_sd"),
        F.count_if(F.col("z") > threshold).alias("z_outliers"),
        F.count_if(~F.col("_x").between(F.col("_f.lower"), F.col("_f.upper"))).alias("iqr_outliers"),
    )
    return stats.select(
        "total_records", rounded("_mu").alias("mean"), rounded("_sd").alias("std_dev"),
        rounded(ratio("_sd", "_mu", 100)).alias("cv_pct"), "z_outliers", "iqr_outliers",
        rounded(F.col("_mu") - 2 * F.col("_sd")).alias("normal_low"), rounded(F.col("_mu") + 2 * F.col("_sd")).alias("normal_high"),
    )


def low_attendance(df: DataFrame, floor_pct: float = 50.0) -> DataFrame:
    """Rows below half attendance; missing working days count as 26."""
    share = ratio(zero("days_present"), F.coalesce(F.nullif("working_days", F.lit(0)), F.lit(26)), 100)
    return df.withColumn("_share", share).filter(F.col("_share") < floor_pct).withColumns({
        "attendance_pct": rounded("_share", 1), "flag": F.lit("LOW_ATTENDANCE"),
    })


def spikes(df: DataFrame, entity: str, order: str, tie: str, amount: str, threshold_pct: float = 30.0) -> DataFrame:
    """Jumps against the previous record of the same entity, where that was positive."""
    rows = over_history(df, [entity], order, tie, {"prev": lambda w: F.lag(amount).over(w)}, back=1)
    change = F.try_divide(F.abs(F.col(amount) - F.col("prev")).cast("double"), F.col("prev").cast("double")) * 100
    return rows.filter(F.col("prev") > 0).withColumn("_change", change).filter(F.col("_change") > threshold_pct).withColumns({
        "change_pct": rounded("_change", 1), "flag": F.lit("SALARY_SPIKE"),
    })
