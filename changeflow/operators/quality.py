"""Named row rules that warn, drop, or block a whole batch, and how often each one failed.

A rule is failed by a row for which its predicate is false or NULL. All rules are counted
on the same rows, those before any drop, so the counts do not depend on the rule order.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.sources.paths import make_dir

WARN = "warn"
DROP = "drop"
FAIL = "fail"
TOTAL = "total_rows"
FAILED_RULES = "failed_rules"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"rule {self.name}: unknown action {self.action}")
        if self.name.lower() == TOTAL:
            raise ValueError(f"no rule may be named {TOTAL}")


def expect(name: str, predicate: str) -> Rule:
    """Count the rows that fail, keep them."""
    return Rule(name, predicate, WARN)


def expect_or_drop(name: str, predicate: str) -> Rule:
    """Count the rows that fail, drop them."""
    return Rule(name, predicate, DROP)


def expect_or_fail(name: str, predicate: str) -> Rule:
    """Count the rows that fail; a batch that has any is refused as a whole."""
    return Rule(name, predicate, FAIL)


class BatchRefused(RuntimeError):
    """A batch has rows that fail rules of action ``fail``; none of it was let through."""

    def __init__(self, batch: str, failures: Mapping[str, int]):
        self.batch = batch
        self.failures = dict(failures)
        told = ", ".join(f"{rule} ({n} rows)" for rule, n in self.failures.items())
        super().__init__(f"batch {batch} is refused: {told}")


def blocking_failures(counts: Mapping[str, int], rules: Iterable[Rule]) -> dict[str, int]:
    """How many rows failed each rule that blocks, where any did."""
    return {rule.name: counts[rule.name] for rule in rules if rule.action == FAIL and counts.get(rule.name)}


def refused_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The rows that fail a blocking rule, with the names of those they fail, in order."""
    if FAILED_RULES in df.columns:
        raise ValueError(f"rows have a column {FAILED_RULES} of their own")
    told = [F.when(~_passed(rule), F.lit(rule.name)) for rule in rules if rule.action == FAIL]
    if not told:
        return df.withColumn(FAILED_RULES, F.array().cast("array<string>")).limit(0)
    return df.withColumn(FAILED_RULES, F.array_compact(F.array(*told))).filter(F.size(FAILED_RULES) > 0)


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Drop the rows that fail a drop rule.

    The predicates stay bare, because a filter drops NULL results anyway and the parquet
    scan can only use bare ones.
    """
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(F.expr(rule.predicate))
    return df


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _passed(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def rule_counts(rules: Iterable[Rule]) -> list[Column]:
    """One aggregate for the rows and one per rule for its failures: a single pass."""
    failures = [F.count_if(~_passed(rule)).alias(rule.name) for rule in rules]
    return [F.count(F.lit(1)).alias(TOTAL), *failures]


def _long_form(counts: DataFrame, rules: Iterable[Rule], labels: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """Turn rows of counts as of :func:`rule_counts` into one row per rule."""
    rows = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.action).alias("action"),
                F.col(_quoted(rule.name)).alias("failed_rows"),
            )
            for rule in rules
        ]
    )
    failed = F.col("r.failed_rows")
    return counts.select(*labels, TOTAL, F.explode(rows).alias("r")).select(
        *labels,
        "r.rule",
        "r.action",
        TOTAL,
        (F.col(TOTAL) - failed).alias("passed_rows"),
        failed,
        F.when(F.col(TOTAL) > 0, failed * 100.0 / F.col(TOTAL)).alias("failed_pct"),
    )


def quality_report(df: DataFrame, rules: Iterable[Rule], dataset: str) -> DataFrame:
    """One row per rule: rows seen, passed, failed and the failed share in percent."""
    rules = tuple(rules)
    counts = df.agg(*rule_counts(rules)).withColumn("dataset", F.lit(dataset))
    return _long_form(counts, rules)


def observe_rules(df: DataFrame, rules: Iterable[Rule], into: Observation | str) -> DataFrame:
    """Count while the rows flow by, with no extra pass.

    ``into`` is an ``Observation`` for one batch action, or the name under which a streaming
    query reports the counts in its progress.
    """
    return df.observe(into, *rule_counts(rules))


def quality_history(
    spark: SparkSession, path: str, rules: Iterable[Rule], dataset: str, by_batch: bool = False
) -> DataFrame:
    """The report over the per-batch counts a streaming flow left in ``path``.

    Over all batches, or with one set of rows per batch, labelled by query and batch number.
    A rule that was added later has no counts, and so no failures, in older batches.
    """
    rules = tuple(rules)
    fields = [TOTAL, *(rule.name for rule in rules)]
    make_dir(spark, path)  # before the first batch there is none
    stored = spark.read.schema(T.StructType([T.StructField(name, T.LongType()) for name in fields])).json(path)
    if by_batch:
        batch = F.regexp_replace("_metadata.file_name", "\\.json$", "").alias("batch")
        counts = stored.select(batch, *[F.coalesce(_quoted(name), F.lit(0)).alias(name) for name in fields])
        return _long_form(counts.withColumn("dataset", F.lit(dataset)), rules, ("dataset", "batch"))
    sums = stored.agg(*[F.coalesce(F.sum(_quoted(name)), F.lit(0)).alias(name) for name in fields])
    return _long_form(sums.withColumn("dataset", F.lit(dataset)), rules)


def as_counts(observed: Mapping[str, int]) -> dict[str, int]:
    return {name: int(value) for name, value in observed.items()}
