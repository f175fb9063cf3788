"""Pivots, unpivots and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import blank_to_null, decimal
from ..operators import columns, reshape
from ..operators.joins import left_join_many
from ..plans import reports
from . import table, workload


@workload(
    """
    SELECT user_id, max(CASE WHEN event_type IN ('signup') THEN props END) AS signup,
           max(CASE WHEN event_type IN ('click', 'view') THEN props END) AS touch,
           max(CASE WHEN event_type IN ('purchase') THEN props END) AS purchase
    FROM events GROUP BY user_id
    """
)
def attribute_pivot(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    wanted = {"signup": ["signup"], "touch": ["click", "view"], "purchase": ["purchase"]}
    return reshape.attributes_to_columns(events, ["user_id"], "event_type", "props", wanted)


@workload(
    """
    SELECT s_suppkey, label, value FROM (
      SELECT s_suppkey, 's_name' AS label, s_name AS value FROM supplier
      UNION ALL SELECT s_suppkey, 's_region', CASE WHEN s_nationkey < 5 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END FROM supplier
      UNION ALL SELECT s_suppkey, 's_standing', CASE WHEN s_acctbal < 0 THEN NULL ELSE 'good' END FROM supplier)
    """
)
def unpivot_nulls(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        "s_name",
        blank_to_null(F.when(F.col("s_nationkey") < 5, "").otherwise(F.col("s_nationkey").cast("string"))).alias("s_region"),
        blank_to_null(F.when(F.col("s_acctbal") < 0, "").otherwise("good")).alias("s_standing"),
    )
    return reshape.unpivot_with_nulls(suppliers, ["s_suppkey"], ["s_name", "s_region", "s_standing"], "label", "value")


@workload(
    """
    SELECT l_suppkey,
           CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS accepted,
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS pending,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DECIMAL(38,2)) AS returned
    FROM lineitem GROUP BY l_suppkey
    """
)
def pivot_sum(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", decimal("l_quantity", 18, 2).alias("quantity"))
    names = {"A": "accepted", "N": "pending", "R": "returned"}
    sums = reshape.pivot_sum(lines, ["l_suppkey"], "l_returnflag", names, "quantity")
    return sums.select("l_suppkey", *[decimal(c, 38, 2).alias(c) for c in names.values()])


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the shape of account activity; shipped-but-pending lines have no title."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("part_ssn"),
        F.col("l_linenumber").alias("plan_num"),
        F.when((flag == "A") | (status == "F"), F.concat(flag, status)).alias("title"),
        F.to_date("l_shipdate").alias("trade_date"),
        status.alias("std_usage_code_2"),
        F.when(flag == "R", flag).alias("reversal_code"),
        F.concat(F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0"), flag).alias("fund_id"),
        decimal("l_quantity", 18, 2).alias("val_2"),
    )


_ACTIVITY_SQL = """
  activity AS (
    SELECT l_suppkey AS part_ssn, l_linenumber AS plan_num,
           CASE WHEN l_returnflag = 'A' OR l_linestatus = 'F' THEN l_returnflag || l_linestatus END AS title,
           CAST(l_shipdate AS DATE) AS trade_date, l_linestatus AS std_usage_code_2,
           CASE WHEN l_returnflag = 'R' THEN 'R' END AS reversal_code,
           lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') || l_returnflag AS fund_id,
           CAST(l_quantity AS DECIMAL(18,2)) AS val_2
    FROM lineitem)
"""


@workload(
    f"""
    WITH {_ACTIVITY_SQL}
    SELECT DISTINCT CAST(9999 AS BIGINT) AS tsp_report_number, CAST(9999 AS BIGINT) AS payroll_office_number,
           CAST(NULL AS VARCHAR) AS requestor, CAST(NULL AS VARCHAR) AS participant_name, part_ssn,
           CAST(NULL AS DATE) AS dob, plan_num AS plan, CAST(NULL AS VARCHAR) AS department_code,
           CAST(NULL AS VARCHAR) AS personal_office_indicator, CAST(NULL AS VARCHAR) AS employment_code,
           CAST(NULL AS DATE) AS employment_code_effective_date, CAST(NULL AS DATE) AS service_computation_date,
           CAST(NULL AS DATE) AS input_start_date, CAST(NULL AS DATE) AS input_end_date,
           CAST(NULL AS VARCHAR) AS auto_enrollment_code, CAST(NULL AS DATE) AS auto_enrollment_date
    FROM activity WHERE title IS NOT NULL
    """
)
def activity_header(spark, sf_dir):
    return reports.activity_header(_activity(spark, sf_dir))


@workload(
    f"""
    WITH {_ACTIVITY_SQL},
    funds AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS fund_pos_12, n_name AS fund_short_name FROM nation),
    source_groups AS (SELECT substring('ANRST', CAST(r_regionkey AS INTEGER) + 1, 1) AS fund_pos_3,
                             CASE r_regionkey WHEN 0 THEN 'Employee' WHEN 1 THEN 'automatic' ELSE 'MATCH' END AS group_name
                      FROM region)
    SELECT part_ssn, trade_date AS post_date, CAST(NULL AS DATE) AS pay_date, title AS activity,
           std_usage_code_2 AS ae, reversal_code AS rv, fund_short_name AS fund,
           CAST(sum(CASE WHEN upper(group_name) = 'EMPLOYEE' THEN val_2 END) AS DECIMAL(10,2)) AS employee,
           CAST(sum(CASE WHEN upper(group_name) = 'AUTOMATIC' THEN val_2 END) AS DECIMAL(10,2)) AS automatic,
           CAST(sum(CASE WHEN upper(group_name) = 'MATCH' THEN val_2 END) AS DECIMAL(10,2)) AS matching,
           CAST(coalesce(sum(CASE WHEN upper(group_name) = 'EMPLOYEE' THEN val_2 END), 0)
              + coalesce(sum(CASE WHEN upper(group_name) = 'AUTOMATIC' THEN val_2 END), 0)
              + coalesce(sum(CASE WHEN upper(group_name) = 'MATCH' THEN val_2 END), 0) AS DECIMAL(10,2)) AS row_total
    FROM activity LEFT JOIN funds ON substring(fund_id, 1, 2) = fund_pos_12
                  LEFT JOIN source_groups ON substring(fund_id, 3, 1) = fund_pos_3
    WHERE title IS NOT NULL
    GROUP BY part_ssn, trade_date, title, std_usage_code_2, reversal_code, fund_short_name
    """
)
def activity_detail(spark, sf_dir):
    funds = table(spark, sf_dir, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("fund_pos_12"), F.col("n_name").alias("fund_short_name")
    )
    region = F.col("r_regionkey")
    source_groups = table(spark, sf_dir, "region").select(
        F.expr("substring('ANRST', r_regionkey + 1, 1)").alias("fund_pos_3"),
        F.when(region == 0, "Employee").when(region == 1, "automatic").otherwise("MATCH").alias("group_name"),
    )
    return reports.activity_detail(_activity(spark, sf_dir), funds, source_groups)


_AMOUNTS = [
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_quantity + l_tax",
    "l_quantity + l_discount",
    "l_extendedprice + l_tax",
    "l_extendedprice + l_discount",
    "l_quantity - l_discount",
    "l_extendedprice - l_tax",
    "l_discount + l_tax",
]
_MAPPING = [
    (label, "Y" if i % 3 == 0 else "", "Y" if i % 3 == 1 else None, "Y" if i % 4 == 2 else "")
    for i, (label, _) in enumerate(reports.CONTRIBUTIONS)
]
_D = "CAST({} AS DECIMAL(18,2))"


def _amount_sql(expression: str) -> str:
    for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"):
        expression = expression.replace(name, _D.format(name))
    return expression


def _literal(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


_WIDE_SQL = ", ".join(f"{_amount_sql(a)} AS {c}" for a, (_, c) in zip(_AMOUNTS, reports.CONTRIBUTIONS))
_LONG_SQL = " UNION ALL ".join(
    f"SELECT part_ssn, plan_year, '{label}' AS activity, CAST({c} AS DECIMAL(20,2)) AS value FROM wide"
    for label, c in reports.CONTRIBUTIONS
)


@workload(
    f"""
    WITH wide AS (SELECT l_suppkey AS part_ssn, year(l_shipdate) AS plan_year, {_WIDE_SQL} FROM lineitem),
    unpivoted AS ({_LONG_SQL}),
    mapping(m_activity, m_employee, m_automatic, m_matching) AS (VALUES {", ".join("(" + ", ".join(map(_literal, m)) + ")" for m in _MAPPING)})
    SELECT DISTINCT CAST(part_ssn AS BIGINT) AS part_ssn, CAST(plan_year AS BIGINT) AS plan_year, activity,
           CAST(CASE WHEN m_employee <> '' THEN value END AS DECIMAL(10,2)) AS employee_contribution,
           CAST(CASE WHEN m_automatic <> '' THEN value END AS DECIMAL(10,2)) AS agency_automatic,
           CAST(CASE WHEN m_matching <> '' THEN value END AS DECIMAL(10,2)) AS matching_dollar_contribution
    FROM unpivoted JOIN mapping ON activity = m_activity
    """
)
def contributions_report(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("part_ssn"),
        F.year("l_shipdate").alias("plan_year"),
        *[decimal(F.expr(_amount_sql(a)), 18, 2).alias(c) for a, (_, c) in zip(_AMOUNTS, reports.CONTRIBUTIONS)],
    )
    mapping = spark.createDataFrame(_MAPPING, "Activity string, Employee string, Automatic string, Matching string")
    return reports.contributions_report(wide, mapping)


@workload(
    """
    WITH balances AS (
      SELECT CAST(o_custkey AS VARCHAR) AS participant_id, 'g' || CAST(o_custkey AS VARCHAR) AS global_participant_id, c_name AS ssn,
             CAST(l_linenumber * 5 AS VARCHAR) AS fund_id, CAST(l_quantity AS DECIMAL(22,7)) AS units, CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
             CASE l_returnflag WHEN 'A' THEN 'Employee' WHEN 'N' THEN 'Automatic' END AS civilian_group,
             CASE l_linestatus WHEN 'F' THEN 'Match' ELSE 'Employee' END AS uniformed_group
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    branches AS (
      SELECT participant_id, global_participant_id, ssn, fund_id, civilian_group AS grp, units * price AS amount, 'c' AS side
      FROM balances WHERE civilian_group IS NOT NULL
      UNION ALL
      SELECT participant_id, global_participant_id, ssn, fund_id, uniformed_group, units * price, 'u' FROM balances WHERE uniformed_group IS NOT NULL),
    pivoted AS (
      SELECT DISTINCT participant_id, global_participant_id, ssn, fund_id, employee, automatic, match FROM (
        SELECT participant_id, global_participant_id, ssn, fund_id, side,
               CAST(sum(amount) FILTER (WHERE grp = 'Employee') AS DECIMAL(38,9)) AS employee,
               CAST(sum(amount) FILTER (WHERE grp = 'Automatic') AS DECIMAL(38,9)) AS automatic,
               CAST(sum(amount) FILTER (WHERE grp = 'Match') AS DECIMAL(38,9)) AS match
        FROM branches GROUP BY ALL))
    SELECT participant_id, global_participant_id, ssn, employee, automatic, match, n_name AS fund_description
    FROM pivoted LEFT JOIN nation ON fund_id = CAST(n_nationkey AS VARCHAR)
    """
)
def summary_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    flag = F.col("l_returnflag")
    balances = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customers, orders.o_custkey == customers.c_custkey)
        .select(
            F.col("o_custkey").cast("string").alias("participant_id"),
            F.concat(F.lit("g"), F.col("o_custkey").cast("string")).alias("global_participant_id"),
            F.col("c_name").alias("ssn"),
            (F.col("l_linenumber") * 5).cast("string").alias("fundid"),
            F.col("l_quantity").alias("fund_balance_units"),
            F.col("l_extendedprice").alias("price"),
            F.when(flag == "A", "Employee").when(flag == "N", "Automatic").alias("civilian_group"),
            F.when(F.col("l_linestatus") == "F", "Match").otherwise("Employee").alias("uniformed_group"),
        )
    )
    descriptions = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("fund_id"), F.col("n_name").alias("fund_description")
    )
    return reports.summary_report(balances, descriptions)


@workload(
    """
    SELECT c_custkey AS custkey, c_name, o_orderkey, o_orderpriority
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
    """
)
def left_join_many_orders(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    orders = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderpriority")
    )
    return left_join_many(customers, orders, ["custkey"])


@workload(
    """
    SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, p_brand AS label, p_type AS kind,
           CAST(p_size AS BIGINT) AS size_code, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part
    """
)
def retype_by_position(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return columns.retype_by_position(parts, "id:int, name:varchar(55), label:str, kind:text, size_code:bigint, price:decimal(12,2)")


@workload("SELECT s_suppkey AS key_url, s_name AS s_host_ip, s_nationkey AS nation_host_ip FROM supplier")
def rename_and_drop(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("keyHost"),
        F.col("s_name").alias("s_host"),
        F.col("s_nationkey").alias("nation.host"),
        F.col("s_acctbal").alias("std_acctbal"),
    )
    kept = columns.dots_to_underscores(columns.drop_prefixed(suppliers, "STD"))
    return columns.rename_by_substring(kept, {"host": "host_ip", "Host": "_url"})


@workload(
    """
    SELECT c_custkey, c_name, '20261201_000000' AS partition_load_dt_tmstmp, TIMESTAMP '2026-12-01 00:00:00' AS audit_created_tmstmp,
           TIMESTAMP '2026-12-01 00:00:00' AS audit_updated_tmstmp, 'loader' AS audit_created_by, 'loader' AS audit_updated_by,
           'customer' AS audit_data_source FROM customer
    """
)
def audit_stamp(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    at = F.lit("2026-12-01 00:00:00").cast("timestamp_ntz")
    return columns.add_audit(columns.stamp_load(customers, "20261201_000000"), at, "loader", "customer")
