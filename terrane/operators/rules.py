"""Row rules as SQL text: passing rows, quarantined rows with the failed names, metrics."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.columns import FAILED_RULES, QUARANTINED_AT, holds
from terrane.session import lenient_sql


@dataclass(frozen=True)
class Rule:
    name: str
    expr: str


# Functions whose value differs between two runs of the same plan.
_UNSTABLE = re.compile(
    r"\b(now|current_timestamp|localtimestamp|current_time|current_date|curdate|today|"
    r"unix_timestamp|rand|random|randn|uuid|shuffle)\b",
    re.IGNORECASE,
)


def repeatable(df: DataFrame, rules: Iterable[Rule]) -> bool:
    """Whether judging the rows twice must give the same outcome."""
    steady = df._jdf.queryExecution().analyzed().deterministic()
    return steady and not any(_UNSTABLE.search(rule.expr) for rule in rules)


def _all_hold(rules: Iterable[Rule]) -> Column:
    return reduce(and_, (F.expr(f"({rule.expr})") for rule in rules), F.lit(True))


def _failed_names(rules: Iterable[Rule]) -> Column:
    tags = [F.when(~holds(F.expr(f"({r.expr})")), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*tags)) if tags else F.array().cast("array<string>")


def tag_failures(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add the names of the rules a row fails; a NULL outcome is a failure."""
    with lenient_sql(df.sparkSession):
        return df.withColumn(FAILED_RULES, _failed_names(list(rules)))


def valid_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows for which every rule is TRUE. A bare conjunction, so scans can push it down."""
    with lenient_sql(df.sparkSession):
        return df.filter(_all_hold(list(rules)))


def quarantined_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Exactly the rows ``valid_rows`` leaves out, tagged and time-stamped."""
    rules = list(rules)
    with lenient_sql(df.sparkSession):
        rejected = df.filter(~holds(_all_hold(rules)))
    return stamp(tag_failures(rejected, rules))


def stamp(df: DataFrame) -> DataFrame:
    return df.withColumn(QUARANTINED_AT, F.current_timestamp())


def passed() -> Column:
    """On tagged rows: nothing failed."""
    return F.size(FAILED_RULES) == 0


def quality_metrics(tagged: DataFrame) -> DataFrame:
    """Clean and quarantined counts and percentages in one aggregate over tagged rows."""
    counts = tagged.agg(
        F.count_if(passed()).alias("clean_count"),
        F.count_if(~passed()).alias("quarantine_count"),
        F.count(F.lit(1)).alias("total_evaluated"),
    )
    total = F.col("total_evaluated")

    def share(part: str, of_nothing: float) -> Column:
        percent = F.round(F.col(part) / total * 100.0, 2)
        return F.when(total > 0, percent).otherwise(of_nothing)

    return counts.withColumns(
        {
            "pass_rate_pct": share("clean_count", 100.0),
            "quarantine_ratio_pct": share("quarantine_count", 0.0),
        }
    )


def quality_report(clean: int, quarantined: int) -> dict[str, float]:
    """The same five numbers from counts observed during the writes."""
    total = clean + quarantined
    return {
        "clean_count": clean,
        "quarantine_count": quarantined,
        "total_evaluated": total,
        "pass_rate_pct": round(clean / total * 100.0, 2) if total else 100.0,
        "quarantine_ratio_pct": round(quarantined / total * 100.0, 2) if total else 0.0,
    }


def rule_failures(tagged: DataFrame) -> DataFrame:
    """How many rows failed each rule (rules nobody failed do not appear)."""
    names = tagged.select(F.explode(FAILED_RULES).alias("rule"))
    return names.groupBy("rule").agg(F.count(F.lit(1)).alias("failed_rows"))
