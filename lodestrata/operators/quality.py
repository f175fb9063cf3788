"""Data checks and reconciliation."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import move_if_absent

# The rule types, by the number of datasets they take.
SINGLE_DATASET = ("row_count", "failed_rows", "duplicate_count")
TWO_DATASETS = ("same_row_count",)

_RESULT = ["rule", "dataset", "metric", "value", "passed"]


def rule_group(kind: str) -> str:
    if kind in SINGLE_DATASET:
        return "SINGLE"
    if kind in TWO_DATASETS:
        return "MULTIPLE"
    raise ValueError(f"invalid rule type {kind}; there are {SINGLE_DATASET} for one dataset and {TWO_DATASETS} for two")


def failed_rows(df: DataFrame, bad: str) -> DataFrame:
    """Rows that match the predicate of what must not occur."""
    return df.filter(F.expr(bad))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key values occur more than once, as a one-row table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("value"))


def _scanned(df: DataFrame, dataset: str, rules: Sequence[Mapping]) -> DataFrame:
    """All row counts and failed-row counts of one dataset, in one pass over it."""
    counts = [
        (F.count(F.lit(1)) if r["type"] == "row_count" else F.count_if(F.expr(r["bad"]))).alias(f"_{i}")
        for i, r in enumerate(rules)
    ]
    rows = F.stack(
        F.lit(len(rules)), *[part for i, r in enumerate(rules) for part in (F.lit(r["name"]), F.lit(r["type"]), F.col(f"_{i}"))]
    ).alias("rule", "metric", "value")
    shown = df.agg(*counts).select(rows)
    passed = F.when(F.col("metric") == "row_count", F.col("value") > 0).otherwise(F.col("value") == 0)
    return shown.withColumns({"dataset": F.lit(dataset), "passed": passed}).select(*_RESULT)


def _same_count(rule: Mapping, left: DataFrame, right: DataFrame) -> DataFrame:
    """The difference of two row counts; each side is counted in its own tasks first."""
    signed = left.agg(F.count(F.lit(1)).alias("n")).unionByName(right.agg((-F.count(F.lit(1))).alias("n")))
    name = ",".join(rule["datasets"])
    return signed.agg(F.sum("n").alias("value")).select(
        F.lit(rule["name"]).alias("rule"),
        F.lit(name).alias("dataset"),
        F.lit(rule["type"]).alias("metric"),
        "value",
        (F.col("value") == 0).alias("passed"),
    )


def run_checks(datasets: Mapping[str, DataFrame], rules: Sequence[Mapping]) -> DataFrame:
    """Run rules such as ``{"name", "type", "dataset", ...}`` and give one result row each.

    ``failed_rows`` has a predicate ``bad``, ``duplicate_count`` has ``keys``, and
    ``same_row_count`` names two ``datasets``. Row counts must be above zero, all else zero.
    """
    for rule in rules:
        rule_group(rule["type"])
    results = []
    for name, df in datasets.items():
        own = [r for r in rules if r.get("dataset") == name]
        scans = [r for r in own if r["type"] in ("row_count", "failed_rows")]
        if scans:
            results.append(_scanned(df, name, scans))
        for rule in own:
            if rule["type"] == "duplicate_count":
                value = duplicate_count(df, rule["keys"])
                columns = [F.lit(rule["name"]).alias("rule"), F.lit(name).alias("dataset"), F.lit(rule["type"]).alias("metric")]
                results.append(value.select(*columns, "value", (F.col("value") == 0).alias("passed")))
    results += [_same_count(r, *[datasets[d] for d in r["datasets"]]) for r in rules if r["type"] == "same_row_count"]
    return reduce(DataFrame.unionByName, results)


def store_results(results: DataFrame, path: str, run_stamp: str) -> None:
    """Append results to the metrics repository, under the stamp of their run."""
    results.withColumn("run_stamp", F.lit(run_stamp)).write.mode("append").partitionBy("run_stamp").parquet(path)


def control_totals(triggers: DataFrame) -> DataFrame:
    """Sums of the declared record counts and checksums, which trigger files hold as text.

    ``unreadable`` counts the declarations without a readable count, or with an unreadable checksum.
    """
    count, checksum = F.col("record_count").try_cast("bigint"), F.col("record_checksum").try_cast("decimal(38,2)")
    return triggers.agg(
        F.count_if(count.isNull() | (checksum.isNull() & F.col("record_checksum").isNotNull())).alias("unreadable"),
        F.sum(F.col("record_count").try_cast("bigint")).alias("declared_rows"),
        F.sum(F.col("record_checksum").try_cast("decimal(38,2)")).cast("decimal(38,2)").alias("declared_checksum"),
    )


def reconcile(triggers: DataFrame, loaded: DataFrame, run_column: str, run_id: str, checksum: str | None = None) -> DataFrame:
    """Declared totals against the rows, and the sum of one column, loaded by this run.

    A declaration that cannot be read keeps the gate shut.
    """
    run = loaded.filter(F.col(run_column) == run_id)
    summed = F.sum(checksum) if checksum else F.sum(F.lit(None).cast("decimal(38,2)"))
    actual = run.agg(F.count(F.lit(1)).alias("loaded_rows"), summed.cast("decimal(38,2)").alias("loaded_checksum"))
    sides = control_totals(triggers).unionByName(actual, allowMissingColumns=True)
    totals = sides.agg(*[F.max(c).alias(c) for c in sides.columns])
    same = (F.col("declared_rows") == F.col("loaded_rows")) & (F.col("unreadable") == 0)
    if checksum:
        same = same & (F.col("declared_checksum") == F.col("loaded_checksum"))
    return totals.withColumn("reconciled", F.coalesce(same, F.lit(False)))


def promote(staged: DataFrame, verdict: DataFrame, path: str, run_id: str) -> bool:
    """Add staged rows to the main table only when their reconciliation holds.

    A run has a folder of its own, which appears when it is complete. A run that is there already, from
    before a retry or from another writer, stays as it is, so no row is added twice.
    """
    if not verdict.first()["reconciled"]:
        return False
    hidden = f"{path}/_promoting/{run_id}-{uuid.uuid4().hex}"
    staged.write.parquet(hidden)
    move_if_absent(staged.sparkSession, hidden, f"{path}/run={run_id}")
    return True


def with_previous(repository: DataFrame) -> DataFrame:
    """Stored results with the value that each metric had in the run before, null in its first run."""
    return repository.withColumn("previous", F.lag("value").over(Window.partitionBy("rule", "dataset", "metric").orderBy("run_stamp")))
