"""Named data-quality rules: warn, drop, report, quarantine, split, check lists.

A rule is a SQL predicate that a good row satisfies. NULL counts as a violation everywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def _passes(rule: str | Column) -> Column:
    cond = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(cond, F.lit(False))


def violation_counters(rules: Rules) -> list[Column]:
    return [F.count_if(~_passes(rule)).alias(name) for name, rule in rules.items()]


def expect(
    df: DataFrame, rules: Rules, name: str | None = None
) -> tuple[DataFrame, Observation | None]:
    """Keep every row and count violations while the rows flow by.

    The counts ride along with whatever action consumes the result (no second pass); read
    them from ``observation.get`` afterwards. On a stream ``name`` is required and the counts of
    every batch are in ``query.recentProgress[i].observedMetrics[name]``; no observation is given.
    """
    if df.isStreaming:
        if not name:
            raise ValueError("name the expectations of a stream")
        return df.observe(name, F.count(F.lit(1)).alias("rows_seen"), *violation_counters(rules)), None
    # a name may be used by one running observation only, so batches get a fresh one
    observation = Observation()
    counters = [F.count(F.lit(1)).alias("rows_seen"), *violation_counters(rules)]
    return df.observe(observation, *counters), observation


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep only rows that satisfy every rule."""
    for rule in rules.values():
        df = df.filter(_passes(rule))
    return df


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: (rule, total_rows, violations). One aggregation pass for all rules."""
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), *violation_counters(rules))
    rows = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules]
    )
    return counts.select("total_rows", F.inline(rows)).select("rule", "total_rows", "violations")


def reason_of(reasons: Sequence[tuple[str, str]], default: str | None = "unknown") -> Column:
    """First matching (name, bad-row predicate) wins."""
    chain = None
    for name, bad in reasons:
        test = F.expr(bad)
        chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
    if chain is None:
        return F.lit(default)
    return chain if default is None else chain.otherwise(F.lit(default))


def quarantine(
    df: DataFrame, reasons: Sequence[tuple[str, str]], column: str = "quarantine_reason"
) -> DataFrame:
    """Rows for which any bad-row predicate is true, labelled with the first that is.

    A predicate that evaluates to NULL does not capture the row; use :func:`split` for an
    exact complement of the good rows. Works on streams.
    """
    caught = reduce(lambda a, b: a | b, [F.expr(bad) for _, bad in reasons])
    return df.filter(caught).withColumn(column, reason_of(reasons))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(good, bad): every input row lands in exactly one of the two.

    Bad rows carry ``failed_rule``, the first rule they break.
    """
    good = reduce(lambda a, b: a & b, [_passes(rule) for rule in rules.values()])
    failed = F.coalesce(*[F.when(~_passes(rule), F.lit(n)) for n, rule in rules.items()])
    return df.filter(good), df.filter(~good).withColumn("failed_rule", failed)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for all columns from a single aggregation."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols]
    )
    return counts.select(F.inline(rows))


def check(
    df: DataFrame,
    name: str,
    condition: Column,
    order: int = 0,
    passed: str = "PASS",
    failed: str = "FAIL",
) -> DataFrame:
    """One-row check: aggregate ``condition`` over ``df`` and turn it into a verdict."""
    verdict = F.when(condition, F.lit(passed)).otherwise(F.lit(failed))
    return df.agg(verdict.alias("result")).select(
        F.lit(order).alias("sort_order"), F.lit(name).alias("check_name"), "result"
    )


def checks_from(
    df: DataFrame, checks: Sequence[tuple[int, str, Column, str, str]]
) -> DataFrame:
    """Several checks ``(order, name, aggregate condition, passed, failed)`` in one pass over ``df``."""
    verdicts = [
        F.when(cond, F.lit(ok)).otherwise(F.lit(bad)).alias(f"v{i}")
        for i, (_, _, cond, ok, bad) in enumerate(checks)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(order).alias("sort_order"),
                F.lit(name).alias("check_name"),
                F.col(f"v{i}").alias("result"),
            )
            for i, (order, name, _, _, _) in enumerate(checks)
        ]
    )
    return df.agg(*verdicts).select(F.inline(rows))


def scorecard(parts: Sequence[DataFrame], keep_order: bool = False) -> DataFrame:
    """Stack checks and list them by ``sort_order``, which stays hidden unless asked for."""
    rows = reduce(DataFrame.unionByName, parts).orderBy("sort_order")
    return rows if keep_order else rows.select("check_name", "result")
