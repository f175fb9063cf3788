"""Participant tables over messages that Spark builds from orders and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import LOAD_COLUMN
from ..operators.nested import relationalize
from ..plans import participants as marts
from ..plans.loads import load_flattened
from ..session import scratch_path
from ..sources.readers import latest_partition_value
from . import table, workload


def _as_of() -> Column:
    return F.to_date(F.lit("2026-12-01"))


def _person_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One person message per order, about its customer; sections are missing for some states."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS message_id",
        """
        named_struct(
          'header', named_struct(
            'platformInternalId', cast(o_custkey AS string), 'globalPersonIdentifier', concat('h', o_custkey),
            'nationalTaxId', concat('t', o_custkey),
            'subtopic', CASE WHEN o_orderpriority = '2-HIGH' THEN 'Other' ELSE 'PersonWorker' END,
            'sourceSystemExtractionTimestamp', CASE WHEN o_orderpriority = '3-MEDIUM' THEN ''
              ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00.000-06:00') END),
          'person', named_struct('firstName', concat('F', o_custkey), 'lastName', concat('L', o_orderkey),
            'middleName', cast(NULL AS string), 'maritalStatus', o_orderstatus, 'gender', left(o_orderpriority, 1),
            'birthDate', date_format(o_orderdate, 'yyyy-MM-01')),
          'worker', named_struct(
            'currentEmploymentStatus', named_struct('employmentStatusCode', o_orderstatus,
              'employmentStatusFullDescription', o_orderpriority, 'employmentStatusEffectiveDate', date_format(o_orderdate, 'yyyy-MM-dd')),
            'retirementDate', '', 'hireDate', date_format(o_orderdate, 'yyyyMMdd'), 'isTerminated', 'N', 'terminationDate', cast(NULL AS string)),
          'benefitsWorkerAttributes', CASE WHEN o_orderstatus <> 'O' THEN array(
            named_struct(
              'benefitsCurrentOrganizationCodes', array(
                named_struct('organizationId', 8337, 'value', o_orderpriority), named_struct('organizationId', 8357, 'value', o_orderstatus),
                named_struct('organizationId', 9999, 'value', 'zz')),
              'benefitsCurrentEmploymentStatuses', array(
                named_struct('categoryId', 21, 'value', o_orderstatus, 'beginDate', date_format(o_orderdate, 'yyyy-MM-dd')),
                named_struct('categoryId', 8597, 'value', 'E', 'beginDate', date_format(o_orderdate, 'yyyyMMdd')),
                named_struct('categoryId', 8397, 'value', left(o_orderpriority, 1), 'beginDate', cast(NULL AS string)))),
            named_struct(
              'benefitsCurrentOrganizationCodes', array(named_struct('organizationId', 8347, 'value', concat('0', o_orderpriority))),
              'benefitsCurrentEmploymentStatuses', cast(NULL AS array<struct<categoryId: int, value: string, beginDate: string>>))) END,
          'personAttributes', CASE
            WHEN o_orderstatus = 'F' THEN cast(array() AS array<struct<additionalAttributes: array<struct<fieldName: string, fieldValue: string>>>>)
            ELSE array(named_struct('additionalAttributes', array(
              named_struct('fieldName', 'C-PAYROLL-OFF-NUM', 'fieldValue', concat('p', o_custkey)),
              named_struct('fieldName', CASE WHEN o_orderstatus = 'P' THEN 'U-PAYROLL-OFF-NUM' ELSE 'C-TSP-SCD-DATE' END,
                           'fieldValue', date_format(o_orderdate, 'yyyy-MM-dd'))))) END,
          'preferences', array(named_struct('communicationPreferences', array(named_struct('benefitCommunicationPreference', o_orderpriority)))),
          'personBenefitAccountRelationships', CASE WHEN o_orderstatus = 'P'
            THEN array(named_struct('originatingPersonInternalId', concat('a', o_custkey)), named_struct('originatingPersonInternalId', concat('b', o_custkey))) END
        ) AS message
        """,
    )


_MESSAGES_SQL = """
  messages AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS message_id, CAST(o_custkey AS VARCHAR) AS participant_id,
           'h' || CAST(o_custkey AS VARCHAR) AS header_global_id, 't' || CAST(o_custkey AS VARCHAR) AS ssn,
           CASE WHEN o_orderpriority = '2-HIGH' THEN 'Other' ELSE 'PersonWorker' END AS subtopic,
           CASE WHEN o_orderpriority <> '3-MEDIUM' THEN date_trunc('day', o_orderdate) + INTERVAL 16 HOUR END AS extracted,
           'F' || CAST(o_custkey AS VARCHAR) AS participant_firstname, 'L' || CAST(o_orderkey AS VARCHAR) AS participant_lastname,
           o_orderstatus, o_orderpriority, o_orderdate, left(o_orderpriority, 1) AS gender, strftime(o_orderdate, '%Y-%m-01') AS birth_date,
           strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y%m%d') AS day8,
           CAST(round((12 * (2026 - year(o_orderdate)) + (12 - month(o_orderdate))) / 12.0, 0) AS BIGINT) AS age,
           CASE WHEN o_orderstatus <> 'O' THEN greatest(o_orderpriority, '0' || o_orderpriority) END AS department_code,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS employer_agency_code,
           CASE o_orderstatus WHEN 'P' THEN greatest('p' || CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'))
                              WHEN 'O' THEN 'p' || CAST(o_custkey AS VARCHAR) END AS payroll_office_number
    FROM orders),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY participant_id ORDER BY extracted DESC NULLS LAST, message_id DESC) AS rn FROM messages) WHERE rn = 1)
"""


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event message per event: sign-ups create, clicks and views update, the rest do neither."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS message_id",
        """
        named_struct(
          'header', named_struct(
            'action', CASE event_type WHEN 'signup' THEN 'Create' WHEN 'purchase' THEN 'Review' ELSE 'Update' END,
            'messageTimestamp', concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), 'Z')),
          'body', named_struct(
            'create', named_struct('globalPersonIdentifier', concat('g', user_id),
              'idMapping', CASE WHEN event_type IN ('signup', 'purchase') THEN array(
                named_struct('platformInternalId', cast(user_id AS string)), named_struct('platformInternalId', concat('x', user_id))) END),
            'update', named_struct('after', named_struct('globalPersonIdentifier', concat('g', user_id),
              'modificationHistory', CASE WHEN event_type IN ('click', 'view', 'error') THEN array(
                named_struct('sourceSystemInternalId', cast(user_id AS string))) END)))
        ) AS message
        """,
    )


_EVENTS_SQL = """
  created AS (SELECT * FROM (SELECT CAST(user_id AS VARCHAR) AS person_id, event_type, date_trunc('millisecond', ts) AS event_at,
      row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('millisecond', ts) DESC, CAST(event_id AS VARCHAR) DESC) AS rn
      FROM events WHERE event_type IN ('signup', 'purchase')) WHERE rn = 1),
  updated AS (SELECT * FROM (SELECT CAST(user_id AS VARCHAR) AS person_id, event_type, date_trunc('millisecond', ts) AS event_at,
      row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('millisecond', ts) DESC, CAST(event_id AS VARCHAR) DESC) AS rn
      FROM events WHERE event_type IN ('click', 'view', 'error')) WHERE rn = 1)
"""


def _plain_timestamps(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time, the form the SQL side has."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.to_timestamp_ntz(F.convert_timezone(None, F.lit("UTC"), F.col(c).cast("timestamp_ntz"))) for c in zoned})


def _flattened(messages: DataFrame) -> marts.Flattened:
    return marts.Flattened(relationalize(messages, keys=["message_id"]))


_HEADER_SQL = f"""
    WITH {_MESSAGES_SQL}
    SELECT participant_id, header_global_id AS global_participant_id, DATE '2026-12-01' AS record_start_date,
           DATE '9999-09-09' AS record_end_date, CAST(1 AS BIGINT) AS current_indicator,
           sha256(participant_id || header_global_id || ssn) AS hash_key, DATE '2026-12-01' AS create_date,
           DATE '2026-12-01' AS update_date, 'glue' AS update_userid, CAST(NULL AS VARCHAR) AS participant_name, ssn, birth_date, age,
           max(department_code) AS department_code, max(employer_agency_code) AS employer_agency_code,
           max(payroll_office_number) AS payroll_office_number, CAST(NULL AS VARCHAR) AS employment_status,
           max(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END) AS auto_enrollment_code,
           max(CASE WHEN o_orderstatus <> 'O' THEN day END) AS auto_enrollment_date
    FROM messages GROUP BY participant_id, header_global_id, ssn, birth_date, age
"""


@workload(_HEADER_SQL)
def participant_header(spark, sf_dir):
    people = marts.people_from_tables(_flattened(_person_messages(spark, sf_dir)))
    return marts.participant_header(people, _as_of())


@workload(_HEADER_SQL)
def participant_header_nested(spark, sf_dir):
    return marts.participant_header(marts.people_from_messages(_person_messages(spark, sf_dir)), _as_of())


@workload(_HEADER_SQL)
def participant_header_from_loads(spark, sf_dir):
    """Two loads of flattened tables land beside each other; the header is built from the later one."""
    path = f"{scratch_path(spark, 'loads')}/people"
    messages = _person_messages(spark, sf_dir)
    at = F.lit("2026-12-01 00:00:00").cast("timestamp_ntz")
    names: list[str] = []
    for stamp, rows in (
        ("20261130_000000", messages.filter(F.col("message.person.maritalStatus") == "F")),
        ("20261201_000000", messages),
    ):
        names = load_flattened(rows, path, stamp, at, "loader", "orders", keys=["message_id"])
    landed = marts.Flattened({name: spark.read.parquet(f"{path}_{name}") for name in names})
    flat = landed.last_load(latest_partition_value(landed.top(), LOAD_COLUMN))
    return marts.participant_header(marts.people_from_tables(flat), _as_of())


_HISTORY_SQL = f"""
    WITH {_MESSAGES_SQL}, {_EVENTS_SQL},
    acted AS (
      SELECT l.*, event_at FROM latest l JOIN created ON person_id = participant_id WHERE event_type = 'signup' AND subtopic = 'PersonWorker'
      UNION ALL
      SELECT l.*, event_at FROM latest l JOIN updated ON person_id = participant_id WHERE subtopic = 'PersonWorker')
    SELECT participant_id, 'g' || participant_id AS global_participant_id, sha256('g' || participant_id || participant_id || ssn) AS hash_key, age,
           max(participant_firstname) AS participant_firstname, max(participant_lastname) AS participant_lastname,
           CAST(NULL AS VARCHAR) AS participant_middlename, max(o_orderstatus) AS maritalStatus, max(gender) AS gender,
           max(birth_date) AS birth_date, max(o_orderstatus) AS employment_status, max(o_orderpriority) AS employment_status_description,
           max(day) AS employment_status_effective_date, '' AS retirementDate, max(day8) AS hireDate, 'N' AS isTerminated,
           CAST(NULL AS VARCHAR) AS terminationDate, ssn, max(department_code) AS department_code, max(employer_agency_code) AS employer_agency_code,
           max(payroll_office_number) AS payroll_office_number, max(CASE WHEN o_orderstatus = 'O' THEN day END) AS civilian_scd_date,
           CAST(NULL AS VARCHAR) AS uniformed_scd_date, CAST(NULL AS VARCHAR) AS personnel_office_indicator,
           max(CASE WHEN o_orderstatus <> 'O' THEN '8397' END) AS retirement_code_civil, CAST(NULL AS VARCHAR) AS retirement_code_uniformed,
           max(CASE WHEN o_orderstatus <> 'O' THEN gender END) AS retirement_catcode_civil, CAST(NULL AS VARCHAR) AS retirement_catcode_uniformed,
           max(CASE WHEN o_orderstatus <> 'O' THEN 'E' END) AS auto_enrollment_code, max(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END) AS employment_code,
           max(CASE WHEN o_orderstatus <> 'O' THEN day8 END) AS auto_enrollment_date, max(CASE WHEN o_orderstatus <> 'O' THEN day END) AS employment_cd_date,
           max(o_orderpriority) AS communication_preference, max(extracted) AS sourcesystemextractiontimestamp, max(event_at) AS messageTimestamp,
           max(CASE WHEN o_orderstatus = 'P' THEN 'b' || participant_id END) AS originatingpersoninternalid,
           DATE '2026-12-01' AS record_start_date, DATE '9999-09-09' AS record_end_date, CAST(1 AS BIGINT) AS current_indicator,
           DATE '2026-12-01' AS create_date, DATE '2026-12-01' AS update_date, 'glue' AS update_userid
    FROM acted GROUP BY participant_id, ssn, age
"""


@workload(_HISTORY_SQL)
def participant_history(spark, sf_dir):
    flat, events = _flattened(_person_messages(spark, sf_dir)), _flattened(_event_messages(spark, sf_dir))
    people = marts.latest_people_from_tables(flat, [flat.name(marts.PREFERENCES)])
    acted = marts.acted_events_from_tables(events, (marts.CREATED, marts.UPDATED))
    return _plain_timestamps(marts.history_of(people, acted, _as_of()))


@workload(_HISTORY_SQL)
def participant_history_nested(spark, sf_dir):
    messages = _person_messages(spark, sf_dir).withColumn("_key", F.col("message_id").cast("string"))
    events = _event_messages(spark, sf_dir)
    people = marts.people_from_messages(marts.latest_messages(messages, ["_key"]))
    created, updated = (marts.latest_events_from_messages(events, "message_id", kind) for kind in (marts.CREATED, marts.UPDATED))
    return _plain_timestamps(marts.participant_history(people, created, updated, _as_of()))


def _balance_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One balance message per line item, about the customer of its order."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "struct(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS message_id",
        """
        named_struct(
          'header', named_struct('platformInternalId', cast(o_custkey AS string),
            'subtopic', CASE WHEN l_linestatus = 'F' THEN 'DCUnitsRORContributions' ELSE 'Other' END),
          'definedContributionBenefits', named_struct('definedContributionPlans', array(
            named_struct('planAccountFundTable', CASE WHEN l_returnflag <> 'N' THEN array(
              named_struct('fundId', cast(l_linenumber * 5 AS string), 'subFundId', l_returnflag, 'accountId', cast(l_linenumber + 1 AS string),
                           'planAccountFundBalanceUnits', l_quantity),
              named_struct('fundId', cast(l_linenumber * 5 + 4 AS string), 'subFundId', l_returnflag, 'accountId', cast(l_linenumber + 2 AS string),
                           'planAccountFundBalanceUnits', l_quantity)) END)))
        ) AS message
        """,
    )


_BALANCES_SQL = f"""
    WITH {_MESSAGES_SQL}, {_EVENTS_SQL},
    lines AS (SELECT CAST(o_custkey AS VARCHAR) AS person, l_linenumber, l_returnflag, CAST(l_quantity AS DECIMAL(22,7)) AS units
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'),
    positions AS (
      SELECT person, CAST(l_linenumber * 5 AS VARCHAR) AS fundid, l_returnflag AS subfundid, CAST(l_linenumber + 1 AS VARCHAR) AS accountid, units
      FROM lines WHERE l_returnflag <> 'N'
      UNION ALL SELECT person, CAST(l_linenumber * 5 + 4 AS VARCHAR), l_returnflag, CAST(l_linenumber + 2 AS VARCHAR), units FROM lines WHERE l_returnflag <> 'N'
      UNION ALL SELECT person, NULL, NULL, NULL, NULL FROM lines WHERE l_returnflag = 'N'),
    origins AS (SELECT message_id, unnest(CASE WHEN o_orderstatus = 'P' THEN ['a' || participant_id, 'b' || participant_id] ELSE [NULL] END) AS origin FROM latest),
    prices AS (SELECT CAST(n_nationkey AS VARCHAR) AS fund_id, CAST(n_nationkey * 1.5 AS DECIMAL(12,6)) AS price FROM nation),
    kinds AS (SELECT CAST(r_regionkey AS VARCHAR) AS civ, CAST(r_regionkey + 3 AS VARCHAR) AS uni, r_name FROM region)
    SELECT DISTINCT participant_id, CASE WHEN person_id IS NOT NULL THEN 'g' || participant_id END AS global_participant_id,
           DATE '2026-12-01' AS record_start_date, DATE '9999-09-09' AS record_end_date, CAST(1 AS BIGINT) AS current_indicator,
           DATE '2026-12-01' AS create_date, DATE '2026-12-01' AS update_date, 'glue' AS update_userid, CAST(NULL AS VARCHAR) AS participant_name,
           ssn, fundid, subfundid, accountid, CAST(NULL AS VARCHAR) AS fund_desc, units AS fund_balance_units, price,
           CASE WHEN o_orderstatus IN ('O', 'P') THEN c.r_name END AS civilian_group,
           CASE WHEN o_orderstatus = 'P' THEN u.r_name END AS uniformed_group,
           extracted AS sourcesystemextractiontimestamp, event_at AS messageTimestamp, origin AS originatingpersoninternalid
    FROM latest LEFT JOIN positions ON person = participant_id AND subtopic = 'PersonWorker'
         LEFT JOIN created ON person_id = participant_id LEFT JOIN origins USING (message_id)
         LEFT JOIN prices ON fund_id = fundid LEFT JOIN kinds c ON c.civ = accountid LEFT JOIN kinds u ON u.uni = accountid
"""


def _balance_lookups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    prices = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS fund_id", "n_nationkey * 1.5 AS price")
    groups = table(spark, sf_dir, "region").selectExpr(
        "r_regionkey AS accountid_civilian", "r_regionkey + 3 AS accountid_uniform", "r_name AS `group`"
    )
    return prices, groups


@workload(_BALANCES_SQL)
def participant_balances(spark, sf_dir):
    people_tables, events = _flattened(_person_messages(spark, sf_dir)), _flattened(_event_messages(spark, sf_dir))
    balance_tables = marts.Flattened(relationalize(_balance_messages(spark, sf_dir), keys=["message_id"]))
    people = marts.balance_people_from_tables(people_tables, [people_tables.name(marts.PREFERENCES)])
    created = marts.acted_events_from_tables(events, [marts.CREATED], only=False)
    result = marts.participant_balances(
        people, marts.balances_from_tables(balance_tables), created, *_balance_lookups(spark, sf_dir), _as_of()
    )
    return _plain_timestamps(result)


@workload(_BALANCES_SQL)
def participant_balances_nested(spark, sf_dir):
    messages = _person_messages(spark, sf_dir).withColumn("_key", F.col("message_id").cast("string"))
    people = marts.balance_people_from_messages(messages, ["_key"])
    created = marts.latest_events_from_messages(_event_messages(spark, sf_dir), "message_id", marts.CREATED)
    balances = marts.balances_from_messages(_balance_messages(spark, sf_dir))
    result = marts.participant_balances(people, balances, created, *_balance_lookups(spark, sf_dir), _as_of())
    return _plain_timestamps(result)
