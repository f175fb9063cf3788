import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.columns import LOAD_COLUMN
from lodestrata.operators.latest import latest_value_rows
from lodestrata.operators.nested import relationalize
from lodestrata.plans import participants as marts
from lodestrata.plans import reports
from tests.helpers import rows

PERSON = """struct<
  header: struct<platformInternalId: string, globalPersonIdentifier: string, nationalTaxId: string, subtopic: string, sourceSystemExtractionTimestamp: string>,
  person: struct<firstName: string, lastName: string, middleName: string, maritalStatus: string, gender: string, birthDate: string>,
  worker: struct<currentEmploymentStatus: struct<employmentStatusCode: string, employmentStatusFullDescription: string, employmentStatusEffectiveDate: string>,
                 retirementDate: string, hireDate: string, isTerminated: string, terminationDate: string>,
  benefitsWorkerAttributes: array<struct<
    benefitsCurrentOrganizationCodes: array<struct<organizationId: int, value: string>>,
    benefitsCurrentEmploymentStatuses: array<struct<categoryId: int, beginDate: string, value: string>>>>,
  personAttributes: array<struct<additionalAttributes: array<struct<fieldName: string, fieldValue: string>>>>,
  preferences: array<struct<communicationPreferences: array<struct<benefitCommunicationPreference: string>>>>,
  personBenefitAccountRelationships: array<struct<originatingPersonInternalId: string>>,
  definedContributionBenefits: struct<definedContributionPlans: array<struct<
    planAccountFundTable: array<struct<fundId: string, subFundId: string, accountId: string, planAccountFundBalanceUnits: double>>>>>>"""
EVENT = """struct<header: struct<action: string, messageTimestamp: string>,
  body: struct<create: struct<globalPersonIdentifier: string, idMapping: array<struct<platformInternalId: string>>>,
               update: struct<after: struct<globalPersonIdentifier: string, modificationHistory: array<struct<sourceSystemInternalId: string>>>>>>"""


def message(person, at, subtopic="PersonWorker", **sections):
    header = {"platformInternalId": person, "globalPersonIdentifier": f"g{person}", "nationalTaxId": "t", "subtopic": subtopic}
    return {"header": {**header, "sourceSystemExtractionTimestamp": at}, "person": {"birthDate": "1981-01-01"}, **sections}


def codes(*pairs):
    return [{"benefitsCurrentOrganizationCodes": [{"organizationId": i, "value": v} for i, v in pairs]}]


def named(**fields):
    return [{"additionalAttributes": [{"fieldName": n.replace("_", "-"), "fieldValue": v} for n, v in fields.items()]}]


@pytest.fixture
def people(spark):
    """Two loads whose message ids, and so their links, are the same."""
    funds = [{"planAccountFundTable": [{"fundId": "7", "accountId": "1", "planAccountFundBalanceUnits": 2.5}]}]
    data = [
        ("m1", "20260101_000000", message("p", "2026-01-01T00:00:00.000-06:00", benefitsWorkerAttributes=codes((8337, "old")))),
        ("m1", "20260102_000000", message("p", "2026-01-02T00:00:00.000-06:00", benefitsWorkerAttributes=codes((8337, "a"), (8347, "b"), (8357, "c")),
                                          personAttributes=named(C_PAYROLL_OFF_NUM="9"), personBenefitAccountRelationships=[{"originatingPersonInternalId": "o"}])),
        ("m2", "20260102_000000", message("q", "", benefitsWorkerAttributes=[], personAttributes=None)),
        ("m3", "20260102_000000", message("p", "2025-12-31T00:00:00.000-06:00", "DCUnitsRORContributions",
                                          definedContributionBenefits={"definedContributionPlans": funds})),
    ]
    return spark.createDataFrame(data, f"message_id string, {LOAD_COLUMN} string, message {PERSON}")


@pytest.fixture
def events(spark):
    def event(action, at, **body):
        return {"header": {"action": action, "messageTimestamp": at}, "body": body}

    def created(*ids):
        return {"globalPersonIdentifier": "G", "idMapping": [{"platformInternalId": i} for i in ids]}

    data = [
        ("e1", "20260101_000000", event("Create", "2026-01-01T00:00:00.000-06:00", create=created("p", "q"))),
        ("e2", "20260102_000000", event("Review", "2026-01-02T00:00:00.000-06:00", create=created("q"))),
        ("e3", "20260102_000000", event("Update", "2026-01-03T00:00:00.000-06:00", update={"after": {
            "globalPersonIdentifier": "G", "modificationHistory": [{"sourceSystemInternalId": "p"}]}})),
    ]
    return spark.createDataFrame(data, f"message_id string, {LOAD_COLUMN} string, message {EVENT}")


def flattened(df):
    return marts.Flattened(relationalize(df, keys=["message_id"], carry=[LOAD_COLUMN]))


def as_of():
    return F.to_date(F.lit("2026-12-01"))


def test_linked_tables_and_messages_agree(people):
    linked, nested = marts.people_from_tables(flattened(people)), marts.people_from_messages(people)
    assert rows(linked.select(*sorted(linked.columns))) == rows(nested.select(*sorted(linked.columns)))
    by_load = {(r.participant_id, r[LOAD_COLUMN]): r.department_code for r in nested.filter("subtopic = 'PersonWorker'").collect()}
    assert by_load == {("p", "20260101_000000"): "old", ("p", "20260102_000000"): "b", ("q", "20260102_000000"): None}


def test_header(people):
    got = marts.participant_header(marts.people_from_messages(people), as_of())
    assert len(got.columns) == 19
    first = got.filter("participant_id = 'p'").first()
    assert (first.department_code, first.employer_agency_code, first.payroll_office_number, first.age) == ("old", "c", "9", 46)


def history(people, events, from_tables, **options):
    if from_tables:
        flat, acted = flattened(people).last_load(), flattened(events)
        top = marts.latest_top(flat, [flat.name(marts.WORK)])
        latest = marts.people_from_tables(flat, top)
        created, updated = (marts.latest_events_from_tables(acted, k) for k in (marts.CREATED, marts.UPDATED))
    else:
        latest = marts.people_from_messages(marts.latest_messages(latest_value_rows(people, LOAD_COLUMN), ["message_id"]))
        created, updated = (marts.latest_events_from_messages(events, "message_id", k) for k in (marts.CREATED, marts.UPDATED))
    return marts.participant_history(latest, created, updated, as_of(), **options)


@pytest.mark.parametrize("from_tables", [True, False])
def test_history_takes_latest_events_of_the_right_action(people, events, from_tables):
    got = history(people, events, from_tables)
    only = got.collect()
    assert [(r.participant_id, r.global_participant_id, r.department_code, r.originatingpersoninternalid) for r in only] == [("p", "G", "b", "o")]
    shifted = history(people, events, from_tables, source_zone="America/Chicago").first()
    assert shifted.messageTimestamp - only[0].messageTimestamp == dt.timedelta(hours=6)


@pytest.mark.parametrize("from_tables", [True, False])
def test_balances(spark, people, events, from_tables):
    prices = spark.createDataFrame([(7, 1.25)], "fund_id int, price double")
    groups = spark.createDataFrame([(1, 5, "Employee"), (4, 1, "Match")], "accountid_civilian int, accountid_uniform int, `group` string")
    described = spark.createDataFrame([("7", "Seven")], "fund_id string, fund_description string")
    if from_tables:
        flat = flattened(people)
        who, held = marts.balance_people_from_tables(flat, [flat.name(marts.WORK)]), marts.balances_from_tables(flat)
    else:
        who, held = marts.balance_people_from_messages(people, ["message_id"]), marts.balances_from_messages(people)
    known = marts.latest_events_from_messages(events, "message_id", marts.CREATED)
    got = marts.participant_balances(who, held, known, prices, groups, as_of(), fund_descriptions=described)
    shown = rows(got.select("participant_id", "fundid", "fund_desc", "civilian_group", "uniformed_group", "originatingpersoninternalid"))
    assert shown == [("p", "7", "Seven", "Employee", None, "o"), ("q", None, None, None, None, None)]
    report = reports.summary_report(got, described).collect()
    assert [(r.participant_id, str(r.employee), r.fund_description) for r in report] == [("p", "3.125000000", "Seven")]


def test_children_of_other_messages_are_left_out_before_the_shuffle(spark):
    children = spark.range(20_000).select(F.col("id").cast("string").alias("id"))
    owners = spark.createDataFrame([("7",), ("19999",), ("no child",), (None,)], "link string")
    kept = {r.id for r in marts._linked(children, F.col("id"), marts._link_marks(owners, F.col("link"))).collect()}
    assert {"7", "19999"} <= kept and len(kept) < 10
