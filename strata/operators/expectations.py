"""Row constraints: WARN counts, DROP filters, FAIL stops the job.

A constraint that is NULL for a row is violated. Nothing here adds a pass over the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .processed import ColumnRule

ACTIONS = ("WARN", "DROP", "FAIL")


@dataclass(frozen=True)
class Expectation:
    name: str
    expression: str
    on_violation: str = "WARN"

    def __post_init__(self) -> None:
        if self.on_violation.upper() not in ACTIONS:
            raise ValueError(f"{self.name}: on_violation must be one of {ACTIONS}, not {self.on_violation!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.expression).cast("boolean"), F.lit(False))

    def does(self, action: str) -> bool:
        return self.on_violation.upper() == action


def expectations_of(rules: Iterable[ColumnRule]) -> list[Expectation]:
    """Constraints declared on columns. A column that is not nullable must not be NULL,
    and fails the job unless its entry says otherwise."""
    found = []
    for rule in rules:
        if rule.constraint_expression:
            found.append(
                Expectation(
                    rule.constraint_name or f"{rule.target_col}_check",
                    rule.constraint_expression,
                    rule.constraint_on_violation or "WARN",
                )
            )
        if not rule.is_nullable:
            action = "FAIL" if rule.constraint_expression else rule.constraint_on_violation or "FAIL"
            found.append(Expectation(f"{rule.target_col}_not_null", f"`{rule.target_col}` is not null", action))
    return found


def enforce(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Applies FAIL, then DROP. Both are filters: a check in a column could be pruned away.

    A later filter must not reach below a FAIL check, where it would skip the rows or files that
    fail; metrics stand between them, which no filter is moved through.
    """
    failing = [rule for rule in expectations if rule.does("FAIL")]
    for rule in failing:
        stop = F.raise_error(F.lit(f"expectation {rule.name} violated: {rule.expression}")).cast("boolean")
        df = df.where(F.when(rule.holds(), True).otherwise(stop))
    if failing:
        df = df.observe(f"checked {uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    dropping = [rule.holds() for rule in expectations if rule.does("DROP")]
    for holds in dropping:
        df = df.where(holds)
    return df


def _failures(expectations: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(~rule.holds()).alias(rule.name) for rule in expectations]


def observe(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[DataFrame, Observation | None]:
    """The enforced frame, and violation counts that fill in when it is written or read.

    Counts are taken before rows are dropped. A FAIL rule ends the job, so it has no count.
    """
    counted = [rule for rule in expectations if not rule.does("FAIL")]
    if not counted:
        return enforce(df, expectations), None
    observation = Observation()
    watched = df.observe(observation, F.count(F.lit(1)).alias("rows"), *_failures(counted))
    return enforce(watched, expectations), observation


def watch(df: DataFrame, expectations: Sequence[Expectation], name: str) -> DataFrame:
    """The frame with counts of violations as metrics of that name, for streams."""
    counted = [rule for rule in expectations if not rule.does("FAIL")]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *_failures(counted)) if counted else df


def violation_counts(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per constraint: (constraint_name, passed, failed). One pass over `df`."""
    totals = df.agg(F.count(F.lit(1)).alias("__rows"), *_failures(expectations))
    rows = F.array(
        *(
            F.struct(
                F.lit(rule.name).alias("constraint_name"),
                (F.col("__rows") - F.col(f"`{rule.name}`")).alias("passed"),
                F.col(f"`{rule.name}`").alias("failed"),
            )
            for rule in expectations
        )
    )
    return totals.select(F.inline(rows))
