"""Activity, contribution and balance reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import decimal
from ..operators.columns import constant
from ..operators.joins import lookup
from ..operators.reshape import conditional_sums, null_safe_total, stack_pairs, sums_by_value

# Labels and source columns of the contribution kinds.
CONTRIBUTIONS = [
    ("401 EE contribution", "cntrb_401k_ee"),
    ("415 Contribution", "cntrb_415"),
    ("401K Catchup", "cntrb_401k_ctchup"),
    ("Roth Contribution", "cntrb_roth"),
    ("agency Match", "agency_match"),
    ("Agency Automatic 1%, 2 year vested", "agency_auto_2yr"),
    ("Employee Tax-Exempt", "part_tax_exempt"),
    ("Employee Tax-Defered", "part_tax_defer"),
    ("Part Tax Defferred Rollover", "roll_in_tax_excempt"),
    ("Roth Deferred", "part_roth"),
    ("Participant Roth Rollover", "roll_in_roth"),
]
# Group names of contribution sources, by report column.
SOURCE_GROUPS = {"employee": "EMPLOYEE", "automatic": "AUTOMATIC", "matching": "MATCH"}
SUMMARY_GROUPS = {"Employee": "employee", "Automatic": "automatic", "Match": "match"}


def activity_header(activity: DataFrame) -> DataFrame:
    """One row per subject and plan with the report's constant columns."""
    return (
        activity.filter(F.col("title").isNotNull())
        .select(
            constant(9999, "bigint").alias("tsp_report_number"),
            constant(9999, "bigint").alias("payroll_office_number"),
            constant(None, "string").alias("requestor"),
            constant(None, "string").alias("participant_name"),
            "part_ssn",
            constant(None, "date").alias("dob"),
            F.col("plan_num").alias("plan"),
            constant(None, "string").alias("department_code"),
            constant(None, "string").alias("personal_office_indicator"),
            constant(None, "string").alias("employment_code"),
            constant(None, "date").alias("employment_code_effective_date"),
            constant(None, "date").alias("service_computation_date"),
            constant(None, "date").alias("input_start_date"),
            constant(None, "date").alias("input_end_date"),
            constant(None, "string").alias("auto_enrollment_code"),
            constant(None, "date").alias("auto_enrollment_date"),
        )
        .distinct()
    )


def activity_detail(activity: DataFrame, funds: DataFrame, source_groups: DataFrame) -> DataFrame:
    """Amounts per subject, date, activity and fund, split by source group, with a row total.

    Both lookups are on parts of ``fund_id``: its first two characters and its third.
    """
    titled = activity.filter(F.col("title").isNotNull())
    named = lookup(titled, funds, [(F.substring("fund_id", 1, 2), "fund_pos_12")], {"fund_short_name": "fund"})
    grouped = lookup(named, source_groups, [(F.substring("fund_id", 3, 1), "fund_pos_3")], {"group_name": "_group"})
    keys = {
        "part_ssn": F.col("part_ssn"),
        "post_date": F.col("trade_date"),
        "activity": F.col("title"),
        "ae": F.col("std_usage_code_2"),
        "rv": F.col("reversal_code"),
        "fund": F.col("fund"),
    }
    sums = conditional_sums(F.col("_group"), F.col("val_2"), SOURCE_GROUPS, 38, 2)
    totals = grouped.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*sums)
    row_total = null_safe_total(*[F.col(c) for c in SOURCE_GROUPS])
    return totals.select(
        "part_ssn",
        "post_date",
        constant(None, "date").alias("pay_date"),
        "activity",
        "ae",
        "rv",
        "fund",
        *[F.col(c).cast("decimal(10,2)").alias(c) for c in SOURCE_GROUPS],
        row_total.cast("decimal(10,2)").alias("row_total"),
    )


def contributions_report(wide: DataFrame, mapping: DataFrame) -> DataFrame:
    """Contribution columns to rows, each amount placed by the kinds its activity maps to.

    Only which kinds are marked matters, and the result is distinct, so the mapping shrinks to
    at most eight rows for each known label. That bound is what makes its broadcast safe; a
    shuffle on the few labels would put much of the data into one task. The amounts take part
    in the sort so that the rows of one person, year and activity can spread over tasks. One
    exchange by ranges of all columns serves the distinct and the sort.
    """
    long = stack_pairs(wide, ["part_ssn", "plan_year"], CONTRIBUTIONS, "activity", "value")
    kinds = {"Employee": "employee_contribution", "Automatic": "agency_automatic", "Matching": "matching_dollar_contribution"}
    marks = (
        mapping.filter(F.col("Activity").isin(*[label for label, _ in CONTRIBUTIONS]))
        .select(
            F.col("Activity").alias("_activity"),
            *[(F.col(kind).isNotNull() & (F.col(kind) != "")).alias(f"_{kind}") for kind in kinds],
        )
        .distinct()
    )
    columns = ["part_ssn", "plan_year", "activity", *kinds.values()]
    placed = long.join(F.broadcast(marks), long.activity == marks["_activity"])
    return (
        placed.select(
            F.col("part_ssn").cast("bigint").alias("part_ssn"),
            F.col("plan_year").cast("bigint").alias("plan_year"),
            F.col("activity").cast("string").alias("activity"),
            *[F.when(F.col(f"_{kind}"), F.col("value")).cast("decimal(10,2)").alias(out) for kind, out in kinds.items()],
        )
        .repartitionByRange(*columns)
        .distinct()
        .orderBy(*columns)
    )


def summary_report(balances: DataFrame, fund_descriptions: DataFrame) -> DataFrame:
    """Balance (units times price) per person and fund, by source group of either account kind.

    The report is the distinct union of a pivot by civilian group and one by uniformed group.
    Rows of both pivots with the same person and fund come from the same group here, so one
    aggregation gives both, and rows that agree are dropped within it. Balances are shuffled before
    they are summed: where a person's lie scattered, a task that sums first holds a group for nearly
    every row. A key with many rows costs one task their reading, but only one group.
    """
    keys = ["participant_id", "global_participant_id", "ssn", "fundid"]
    kinds = ("civilian_group", "uniformed_group")
    amount = decimal("fund_balance_units", 22, 7) * decimal("price", 14, 2)
    aggregates = [c for kind in kinds for c in sums_by_value(F.col(kind), SUMMARY_GROUPS, F.col("_amount"), f"{kind}_")]
    present = [F.count(kind).alias(f"{kind}_rows") for kind in kinds]
    rows = balances.select(*keys, *kinds, amount.alias("_amount"))
    sums = rows.repartition(*keys).groupBy(*keys).agg(*aggregates, *present)

    def pivoted(kind: str) -> Column:
        cells = [decimal(f"{kind}_{out}", 38, 9).alias(out) for out in SUMMARY_GROUPS.values()]
        return F.when(F.col(f"{kind}_rows") > 0, F.struct(*cells))

    both = F.array_distinct(F.array_compact(F.array(*[pivoted(kind) for kind in kinds])))
    rows = sums.select(*keys, F.explode(both).alias("_sums")).select(*keys, "_sums.*")
    described = lookup(rows, fund_descriptions, [(F.col("fundid"), "fund_id")], {"fund_description": "fund_description"})
    return described.drop("fundid")
