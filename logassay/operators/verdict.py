"""Rules over one-row fact frames, and the PASS/FAIL table they produce."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, FAIL = "PASS", "FAIL"


@dataclass(frozen=True)
class Rule:
    """``holds`` is a SQL predicate over the columns of a one-row fact frame."""

    check_id: str
    description: str
    holds: str
    evidence: Sequence[str] = ()


def evidence_text(columns: Sequence[str]) -> Column:
    """'a=1, b=2' from fact columns; a null is written as 'null'."""
    parts: list[Column] = []
    for i, name in enumerate(columns):
        parts.append(F.lit(f"{', ' if i else ''}{name}="))
        parts.append(F.coalesce(F.col(name).cast("string"), F.lit("null")))
    return F.concat(*parts) if parts else F.lit("")


def judge(facts: DataFrame, subject: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule about the subject. A rule whose truth is unknown (null) fails."""
    rows = [
        F.struct(
            F.lit(f"{subject}.{r.check_id}").alias("check_id"),
            F.lit(r.description).alias("description"),
            F.when(F.coalesce(F.expr(r.holds), F.lit(False)), PASS).otherwise(FAIL).alias("verdict"),
            evidence_text(r.evidence).alias("evidence"),
        )
        for r in rules
    ]
    return facts.select(F.inline(F.array(*rows)))


def combine(verdicts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, verdicts)


def summarize(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("verdict") == PASS).alias("passed"),
        F.count_if(F.col("verdict") == FAIL).alias("failed"),
    )


def exit_code(verdicts: DataFrame) -> int:
    """0 when nothing failed, else 1 (runs the job)."""
    return 0 if verdicts.where(F.col("verdict") == FAIL).isEmpty() else 1


def merge_facts(*one_row: DataFrame) -> DataFrame:
    """Puts one-row frames side by side without a join: union by name, then max.

    A column in two frames is refused, as the larger value would hide the other.
    """
    names = [c for df in one_row for c in df.columns]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise ValueError(f"facts given twice: {', '.join(twice)}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
