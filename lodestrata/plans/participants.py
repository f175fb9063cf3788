"""Participant header, history and balance tables from person, event and balance messages.

Every input can come in two forms: the linked tables that ``relationalize`` (or an earlier load)
produced, or the nested messages themselves. The nested form reads attributes inside each row
and needs none of the shuffles that rejoining the linked tables costs; both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import age_in_years, decimal, hash_key, open_end_date, parse_offset_timestamp
from ..operators.columns import LOAD_COLUMN, constant
from ..operators.joins import among_marks, distinct_rows, key_marks, left_join_many, lookup
from ..operators.latest import latest_per_key
from ..operators.nested import find_table
from ..operators.reshape import attribute_columns
from ..session import scratch_path

# Codes that select attribute rows, by output column.
ORGANIZATION_VALUES = {
    "department_code": ["8337", "8347"],
    "employer_agency_code": ["8357", "8367"],
    "personnel_office_indicator": ["8377", "8387"],
}
EMPLOYMENT_VALUES = {
    "retirement_catcode_civil": ["8397"],
    "retirement_catcode_uniformed": ["8407"],
    "auto_enrollment_code": ["8597", "8607"],
    "employment_code": ["21", "22"],
}
EMPLOYMENT_DATES = {"auto_enrollment_date": ["8597", "8607"], "employment_cd_date": ["21", "22"]}
EMPLOYMENT_CODES = {"retirement_code_civil": ["8397"], "retirement_code_uniformed": ["8407"]}
PERSON_VALUES = {
    "payroll_office_number": ["C-PAYROLL-OFF-NUM", "U-PAYROLL-OFF-NUM"],
    "civilian_scd_date": ["C-TSP-SCD-DATE"],
    "uniformed_scd_date": ["U-TSP-SCD-DATE"],
}
CIVILIAN_MARK, UNIFORMED_MARK = "C-PAYROLL-OFF-NUM", "U-PAYROLL-OFF-NUM"
PERSON_SUBTOPIC, BALANCE_SUBTOPIC = "PersonWorker", "DCUnitsRORContributions"
UPDATE_USER = "glue"

# Message fields, by output column.
HEADER_FIELDS = {
    "participant_id": "header.platformInternalId",
    "header_global_id": "header.globalPersonIdentifier",
    "ssn": "header.nationalTaxId",
    "subtopic": "header.subtopic",
    "extracted_at": "header.sourceSystemExtractionTimestamp",
}
PERSON_FIELDS = {
    "participant_firstname": "person.firstName",
    "participant_lastname": "person.lastName",
    "participant_middlename": "person.middleName",
    "maritalStatus": "person.maritalStatus",
    "gender": "person.gender",
    "birth_date": "person.birthDate",
    "employment_status": "worker.currentEmploymentStatus.employmentStatusCode",
    "employment_status_description": "worker.currentEmploymentStatus.employmentStatusFullDescription",
    "employment_status_effective_date": "worker.currentEmploymentStatus.employmentStatusEffectiveDate",
    "retirementDate": "worker.retirementDate",
    "hireDate": "worker.hireDate",
    "isTerminated": "worker.isTerminated",
    "terminationDate": "worker.terminationDate",
}
WORK, CODES, STATUSES = "benefitsWorkerAttributes", "benefitsCurrentOrganizationCodes", "benefitsCurrentEmploymentStatuses"
ATTRIBUTES, NAMED = "personAttributes", "additionalAttributes"
PREFERENCES, COMMUNICATION = "preferences", "communicationPreferences"
ACCOUNTS, ORIGINATING = "personBenefitAccountRelationships", "originatingPersonInternalId"
PLANS, FUNDS = "definedContributionBenefits.definedContributionPlans", "planAccountFundTable"
FUND_FIELDS = {
    "fundid": "fundId",
    "subfundid": "subFundId",
    "accountid": "accountId",
    "fund_balance_units": "planAccountFundBalanceUnits",
}
HISTORY_MAXIMA = [
    *PERSON_FIELDS,
    "ssn",
    "department_code",
    "employer_agency_code",
    *PERSON_VALUES,
    "personnel_office_indicator",
    *EMPLOYMENT_CODES,
    *EMPLOYMENT_VALUES,
    *EMPLOYMENT_DATES,
    "communication_preference",
    "sourcesystemextractiontimestamp",
    "messageTimestamp",
    "originatingpersoninternalid",
]


@dataclass(frozen=True)
class EventKind:
    """Where an event of one action keeps the person it is about."""

    action: str
    mapping: str
    person: str
    global_id: str


# Paths of created and updated people in event messages.
CREATED = EventKind("Create", "body.create.idMapping", "platformInternalId", "body.create.globalPersonIdentifier")
UPDATED = EventKind(
    "Update", "body.update.after.modificationHistory", "sourceSystemInternalId", "body.update.after.globalPersonIdentifier"
)


@dataclass(frozen=True)
class Flattened:
    """Linked tables of one message type, addressed by the path inside the message."""

    tables: dict[str, DataFrame]
    message: str = "message"
    root: str = "root"

    def name(self, path: str) -> str:
        return f"{self.message}_{path.replace('.', '_')}"

    def top(self) -> DataFrame:
        return find_table(self.tables, self.root)

    def child(self, path: str) -> DataFrame:
        return find_table(self.tables, f"{self.root}_{self.name(path)}")

    def load(self) -> list[str]:
        """The load column, when tables of several loads lie together."""
        return [LOAD_COLUMN] if LOAD_COLUMN in self.top().columns else []

    def last_load(self, stamp: str | None = None) -> Flattened:
        """Only the root's latest load, in every table, so that no table scans older partitions.

        Pass the stamp when it is known, for example from ``latest_partition_value``; otherwise
        the root is asked for its greatest. With one load left, tables are linked by id alone.
        """
        newest = F.lit(stamp) if stamp else self.top().agg(F.max(LOAD_COLUMN)).scalar()
        only = {name: df.filter(F.col(LOAD_COLUMN) == newest).drop(LOAD_COLUMN) for name, df in self.tables.items()}
        return replace(self, tables=only)


# --- people, from linked tables -------------------------------------------------------------


def _values(flat: Flattened, outer: str, inner: str, aggregates: Sequence[Column]) -> DataFrame:
    """Attribute rows of an array inside an array, collapsed to one row per outer link.

    Each level is aggregated before it is joined, so rows never multiply.
    """
    load, path = flat.load(), f"{outer}.val.{inner}"
    rows = flat.child(path).groupBy("id", *load).agg(*aggregates).withColumnRenamed("id", "_inner")
    outs = [c for c in rows.columns if c not in ("_inner", *load)]
    outers = flat.child(outer).select("id", *load, F.col(flat.name(path)).alias("_inner"))
    return outers.join(rows, ["_inner", *load]).groupBy("id", *load).agg(*[F.max(c).alias(c) for c in outs])


def _attach(rows: DataFrame, link: str, side: DataFrame, load: Sequence[str]) -> DataFrame:
    """Left join on a link that is null where a message lacks the array.

    Rows without a link are spread by a hash of their header instead of meeting in one task;
    ``_linked`` keeps them from matching anything.
    """
    spread = F.xxhash64("participant_id", "extracted_at", "ssn").cast("string")
    linked = rows.withColumns({"_id": F.coalesce(F.col(link), spread), "_linked": F.col(link).isNotNull()})
    keyed = side.withColumnRenamed("id", "_id").withColumn("_linked", F.lit(True))
    return linked.join(keyed, ["_id", "_linked", *load], "left").drop("_id", "_linked")


def _top_fields(flat: Flattened, top: DataFrame, fields: dict[str, str]) -> list[Column]:
    return [top[flat.name(path)].alias(out) for out, path in fields.items()]


def _employment_columns(category: Column, value: Column, begin: Column) -> list[Column]:
    return [
        *attribute_columns(category, value, EMPLOYMENT_VALUES),
        *attribute_columns(category, begin, EMPLOYMENT_DATES),
        *attribute_columns(category, category, EMPLOYMENT_CODES),
    ]


def latest_top(flat: Flattened, tie_break: Sequence[str]) -> DataFrame:
    """The latest message of each person among the root rows."""
    at = parse_offset_timestamp(flat.name(HEADER_FIELDS["extracted_at"]))
    return latest_per_key(flat.top(), [flat.name(HEADER_FIELDS["participant_id"])], at, [F.col(c) for c in tie_break])


def people_from_tables(flat: Flattened, top: DataFrame | None = None) -> DataFrame:
    """One row per message with its attributes as columns; ``top`` narrows the root rows."""
    top = flat.top() if top is None else top
    load = flat.load()
    codes, statuses = flat.name(f"{WORK}.val.{CODES}.val"), flat.name(f"{WORK}.val.{STATUSES}.val")
    named, wishes = flat.name(f"{ATTRIBUTES}.val.{NAMED}.val"), flat.name(f"{PREFERENCES}.val.{COMMUNICATION}.val")
    organization = F.col(f"{codes}_organizationId").cast("string")
    category = F.col(f"{statuses}_categoryId").cast("string")
    sides = {
        WORK: _values(flat, WORK, CODES, attribute_columns(organization, F.col(f"{codes}_value"), ORGANIZATION_VALUES)).join(
            _values(flat, WORK, STATUSES, _employment_columns(category, F.col(f"{statuses}_value"), F.col(f"{statuses}_beginDate"))),
            ["id", *load],
            "full",
        ),
        ATTRIBUTES: _values(
            flat, ATTRIBUTES, NAMED, attribute_columns(F.col(f"{named}_fieldName"), F.col(f"{named}_fieldValue"), PERSON_VALUES)
        ),
        PREFERENCES: _values(
            flat, PREFERENCES, COMMUNICATION, [F.max(f"{wishes}_benefitCommunicationPreference").alias("communication_preference")]
        ),
        ACCOUNTS: flat.child(ACCOUNTS)
        .groupBy("id", *load)
        .agg(F.max(flat.name(f"{ACCOUNTS}.val.{ORIGINATING}")).alias("originatingpersoninternalid")),
    }
    rows = top.select(
        *load, *[flat.name(path) for path in sides], *_top_fields(flat, top, HEADER_FIELDS), *_top_fields(flat, top, PERSON_FIELDS)
    )
    for path, side in sides.items():
        rows = _attach(rows, flat.name(path), side, load)
    return rows.drop(*[flat.name(path) for path in sides])


def _inner_values(flat: Flattened) -> dict[tuple[str, str], dict[str, Column]]:
    """For each array inside an array, (outer, inner), what one of its rows adds to the columns of a person; null where it adds nothing."""
    codes, statuses = flat.name(f"{WORK}.val.{CODES}.val"), flat.name(f"{WORK}.val.{STATUSES}.val")
    named, wishes = flat.name(f"{ATTRIBUTES}.val.{NAMED}.val"), flat.name(f"{PREFERENCES}.val.{COMMUNICATION}.val")

    def chosen(category: Column, value: Column, wanted: dict[str, list[str]]) -> dict[str, Column]:
        return {out: F.when(category.isin(*among), value.cast("string")) for out, among in wanted.items()}

    organization, category, field = F.col(f"{codes}_organizationId").cast("string"), F.col(f"{statuses}_categoryId").cast("string"), F.col(f"{named}_fieldName")
    return {
        (WORK, CODES): chosen(organization, F.col(f"{codes}_value"), ORGANIZATION_VALUES),
        (WORK, STATUSES): chosen(category, F.col(f"{statuses}_value"), EMPLOYMENT_VALUES)
        | chosen(category, F.col(f"{statuses}_beginDate"), EMPLOYMENT_DATES)
        | chosen(category, category, EMPLOYMENT_CODES),
        (ATTRIBUTES, NAMED): chosen(field, F.col(f"{named}_fieldValue"), PERSON_VALUES)
        | {"civilian": (field == CIVILIAN_MARK).cast("string"), "uniformed": (field == UNIFORMED_MARK).cast("string")},
        (PREFERENCES, COMMUNICATION): {"communication_preference": F.col(f"{wishes}_benefitCommunicationPreference").cast("string")},
    }


def _padded(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The rows with all the columns, null where they have none."""
    return rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])


def _link_marks(owners: DataFrame, link: Column) -> DataFrame:
    """Marks of the owners' links, written once so that no plan that uses them makes them again."""
    marks = key_marks(owners.where(link.isNotNull()).select(F.xxhash64(link.cast("string")).alias("_hash")), "_hash")
    path = scratch_path(owners.sparkSession, "links")
    marks.write.parquet(path)
    return owners.sparkSession.read.schema(marks.schema).parquet(path)


def _linked(rows: DataFrame, link: Column, marks: DataFrame) -> DataFrame:
    """Rows whose link can be one of the marked ones; few others stay, and the grouping that follows drops them."""
    return among_marks(rows.withColumn("_hash", F.xxhash64(link.cast("string"))), marks, "_hash").drop("_hash")


def latest_people_from_tables(flat: Flattened, tie_break: Sequence[str]) -> DataFrame:
    """One row per person, of the latest message, with its attributes, marks and originating persons.

    Linked tables are not joined but gathered: both sides of a link are put below each other and
    grouped by it, so every table is shuffled once. A link belongs to one array of one message, so groups are as
    small as arrays, and rows without a link are grouped by their person. Children of older messages meet no person and go;
    nearly all are left out before they are sorted and shuffled, by filters of fixed size over the links of the latest messages.
    """
    load, values = flat.load(), _inner_values(flat)
    top = latest_top(flat, tie_break)
    paths = (WORK, ATTRIBUTES, PREFERENCES, ACCOUNTS)
    of_latest = top.select(F.explode(F.array(*[top[flat.name(p)].cast("string") for p in paths])).alias("latest_link"))
    latest = _link_marks(of_latest, F.col("latest_link"))
    outers = {p: _linked(flat.child(p), F.col("id"), latest) for p in paths}
    attributes = {out: "string" for columns in values.values() for out in columns}
    keys = {"link": "string", **{c: "string" for c in load}, "part": "string"}

    inner: list[DataFrame] = []
    for (outer, name), columns in values.items():
        part, path = F.lit(f"{outer}.{name}").alias("part"), f"{outer}.val.{name}"
        child = _linked(flat.child(path), F.col("id"), _link_marks(outers[outer], F.col(flat.name(path))))
        child = child.select(F.col("id").alias("link"), *load, part, *[c.alias(out) for out, c in columns.items()])
        owner = outers[outer].select(F.col(flat.name(path)).alias("link"), *load, part, F.col("id").alias("outer")).where("link IS NOT NULL")
        inner += [_padded(child, keys | {"outer": "string"} | attributes), _padded(owner, keys | {"outer": "string"} | attributes)]
    met = reduce(DataFrame.unionByName, inner).groupBy(*keys).agg(F.max("outer").alias("outer"), *[F.max(c).alias(c) for c in attributes])
    arrays = met.where("outer IS NOT NULL").select(F.col("outer").alias("link"), *load, F.substring_index("part", ".", 1).alias("part"), *attributes)

    fields = {**HEADER_FIELDS, **PERSON_FIELDS}
    person = F.struct(*_top_fields(flat, top, fields)).alias("person")
    links = F.array(*[F.struct(F.lit(p).alias("part"), top[flat.name(p)].cast("string").alias("link")) for p in paths], F.struct(F.lit("").alias("part"), F.lit(None).cast("string").alias("link")))
    rooted = top.select(*load, person, F.explode(links).alias("l")).where("l.link IS NOT NULL OR l.part = ''").select(
        F.coalesce("l.link", "person.participant_id").alias("link"),
        *load,
        "l.part",
        F.col("person.participant_id").alias("participant_id"),
        F.lit(True).alias("known"),
        *[F.when(F.col("l.part") == "", F.col(f"person.{c}")).cast("string").alias(c) for c in fields if c != "participant_id"],
    )
    origin = F.struct(F.col(flat.name(f"{ACCOUNTS}.val.{ORIGINATING}")).cast("string").alias("origin")).alias("origin")
    accounts = outers[ACCOUNTS].select(F.col("id").alias("link"), *load, F.lit(ACCOUNTS).alias("part"), origin)
    wide = {**keys, "known": "boolean", **{c: "string" for c in fields}, **attributes, "origin": "struct<origin: string>"}
    sides = [_padded(x, wide) for x in (arrays, rooted, accounts)]
    both = reduce(DataFrame.unionByName, sides).groupBy(*keys).agg(
        F.max("known").alias("known"), F.collect_set("origin").alias("origins"), *[F.max(c).alias(c) for c in (*fields, *attributes)]
    )
    whole = both.where("known").groupBy("participant_id").agg(
        *[F.max(c).alias(c) for c in load], F.max("origins").alias("origins"), *[F.max(c).alias(c) for c in (*fields, *attributes) if c != "participant_id"]
    )
    kinds = dict(top.select(*_top_fields(flat, top, fields)).dtypes)
    return whole.select(
        *load,
        *[F.col(c).cast(kinds[c]).alias(c) for c in fields],
        *[c for c in attributes if c not in ("civilian", "uniformed")],
        *[F.col(c).cast("boolean").alias(c) for c in ("civilian", "uniformed")],
        F.array_max(F.col("origins.origin")).alias("originatingpersoninternalid"),
        "origins",
    )


# --- people, from nested messages -----------------------------------------------------------


def _inner_arrays(outer: Column, inner: str) -> Column:
    """The elements of an array inside an array, as one array per row."""
    return F.flatten(F.filter(F.transform(outer, lambda o: o[inner]), lambda a: a.isNotNull()))


def _greatest(rows: Column, name: str, value: str, wanted: dict[str, list[str]]) -> list[Column]:
    def among(codes: list[str]) -> Column:
        return F.transform(F.filter(rows, lambda r: r[name].cast("string").isin(*codes)), lambda r: r[value].cast("string"))

    return [F.array_max(among(codes)).alias(out) for out, codes in wanted.items()]


def latest_messages(messages: DataFrame, tie_break: Sequence[str], message: str = "message") -> DataFrame:
    """The latest message of each person."""
    at = parse_offset_timestamp(f"{message}.{HEADER_FIELDS['extracted_at']}")
    person = messages.withColumn("_person", F.col(f"{message}.{HEADER_FIELDS['participant_id']}"))
    return latest_per_key(person, ["_person"], at, [F.col(c) for c in tie_break]).drop("_person")


def people_from_messages(messages: DataFrame, message: str = "message") -> DataFrame:
    """As :func:`people_from_tables`, read inside each message without any shuffle."""
    body = F.col(message)
    arrays = messages.select(
        *[c for c in [LOAD_COLUMN] if c in messages.columns],
        *[F.col(f"{message}.{path}").alias(out) for out, path in {**HEADER_FIELDS, **PERSON_FIELDS}.items()],
        _inner_arrays(body[WORK], CODES).alias("_codes"),
        _inner_arrays(body[WORK], STATUSES).alias("_statuses"),
        _inner_arrays(body[ATTRIBUTES], NAMED).alias("_named"),
        _inner_arrays(body[PREFERENCES], COMMUNICATION).alias("_wishes"),
        body[ACCOUNTS].alias("_accounts"),
    )
    return arrays.select(
        *[c for c in arrays.columns if not c.startswith("_")],
        *_greatest(F.col("_codes"), "organizationId", "value", ORGANIZATION_VALUES),
        *_greatest(F.col("_statuses"), "categoryId", "value", EMPLOYMENT_VALUES),
        *_greatest(F.col("_statuses"), "categoryId", "beginDate", EMPLOYMENT_DATES),
        *_greatest(F.col("_statuses"), "categoryId", "categoryId", EMPLOYMENT_CODES),
        *_greatest(F.col("_named"), "fieldName", "fieldValue", PERSON_VALUES),
        F.array_max(F.col("_wishes")["benefitCommunicationPreference"]).alias("communication_preference"),
        F.array_max(F.col("_accounts")[ORIGINATING]).alias("originatingpersoninternalid"),
    )


# --- events ---------------------------------------------------------------------------------


def _latest_events(rows: DataFrame) -> DataFrame:
    at = parse_offset_timestamp("event_at")
    latest = latest_per_key(rows, ["person_id"], at, [F.col("id"), F.col("index")])
    return latest.select("person_id", "action", "global_participant_id", "event_at")


def latest_events_from_tables(flat: Flattened, kind: EventKind) -> DataFrame:
    """The latest event about each person, whatever its action."""
    load = flat.load()
    top = flat.top()
    events = top.select(
        F.col(flat.name(kind.mapping)).alias("id"),
        *load,
        *_top_fields(
            flat, top, {"action": "header.action", "global_participant_id": kind.global_id, "event_at": "header.messageTimestamp"}
        ),
    )
    people = flat.child(kind.mapping).select(
        "id", "index", *load, F.col(flat.name(f"{kind.mapping}.val.{kind.person}")).alias("person_id")
    )
    return _latest_events(people.join(events, ["id", *load], "left"))


def acted_events_from_tables(flat: Flattened, kinds: Sequence[EventKind], only: bool = True) -> DataFrame:
    """The latest event of each kind about each person; with ``only``, of those whose action is that of the kind.

    Events and the people they name are gathered by their link, and the latest is the greatest of an
    aggregate, so each is shuffled once and rows of one person are combined in every task before.
    """
    load, sides = flat.load(), []
    columns = {"link": "string", **{c: "string" for c in load}, "kind": "string"}
    event = {"action": "string", "global_participant_id": "string", "event_at": "string"}
    wide = {**columns, "event": "struct<action: string, global_participant_id: string, event_at: string>", "named": "struct<index: int, person_id: string>"}
    for kind in kinds:
        top = flat.top()
        paths = dict(zip(event, ("header.action", kind.global_id, "header.messageTimestamp")))
        fields = F.struct(*[c.cast("string").alias(n) for n, c in zip(paths, _top_fields(flat, top, paths))]).alias("event")
        mark = F.lit(kind.action).alias("kind")
        owners = top.select(F.col(flat.name(kind.mapping)).alias("link"), *load, mark, fields).where("link IS NOT NULL")
        named = F.struct("index", F.col(flat.name(f"{kind.mapping}.val.{kind.person}")).cast("string").alias("person_id")).alias("named")
        people = flat.child(kind.mapping).select(F.col("id").alias("link"), *load, mark, named)
        sides += [_padded(owners, wide), _padded(people, wide)]
    met = reduce(DataFrame.unionByName, sides).groupBy(*columns).agg(F.max("event").alias("event"), F.collect_list("named").alias("named"))
    rows = met.select("link", "kind", "event", F.explode("named").alias("named")).select(
        F.col("named.person_id").alias("person_id"), "kind", F.struct(parse_offset_timestamp("event.event_at").alias("at"), "link", "named.index", "event").alias("latest")
    )
    newest = rows.groupBy("person_id").agg(*[F.max(F.when(F.col("kind") == k.action, F.col("latest"))).alias(k.action) for k in kinds])
    each = F.array(*[F.struct(F.lit(k.action).alias("kind"), F.col(k.action).alias("latest")) for k in kinds])
    found = newest.select("person_id", F.explode(each).alias("e")).where("e.latest IS NOT NULL")
    acted = found.select("person_id", *[F.col(f"e.latest.event.{c}").alias(c) for c in event], F.col("e.kind").alias("_kind"))
    return (acted.where(F.col("action") == F.col("_kind")) if only else acted).drop("_kind")


def latest_events_from_messages(messages: DataFrame, key: str, kind: EventKind, message: str = "message") -> DataFrame:
    """As :func:`latest_events_from_tables`; ``key`` identifies a message."""
    rows = messages.select(
        F.col(key).cast("string").alias("id"),
        F.col(f"{message}.header.action").alias("action"),
        F.col(f"{message}.{kind.global_id}").alias("global_participant_id"),
        F.col(f"{message}.header.messageTimestamp").alias("event_at"),
        F.posexplode(F.col(f"{message}.{kind.mapping}")).alias("index", "_mapped"),
    )
    return _latest_events(rows.withColumn("person_id", F.col(f"_mapped.{kind.person}")))


# --- marts ----------------------------------------------------------------------------------


def _validity(as_of: Column, user_id: str) -> dict[str, Column]:
    return {
        "record_start_date": as_of,
        "record_end_date": open_end_date(),
        "current_indicator": constant(1, "bigint"),
        "create_date": as_of,
        "update_date": as_of,
        "update_userid": F.lit(user_id),
    }


def participant_header(people: DataFrame, as_of: Column, user_id: str = UPDATE_USER) -> DataFrame:
    """One row per person and header values, the greatest value of each attribute."""
    validity = _validity(as_of, user_id)
    person = ["participant_id", "global_participant_id", "ssn", "birth_date"]
    rows = people.withColumnRenamed("header_global_id", "global_participant_id")
    collapsed = rows.groupBy(*person).agg(
        *[F.max(c).alias(c) for c in ("department_code", "employer_agency_code", "payroll_office_number")],
        F.max("employment_code").alias("auto_enrollment_code"),
        F.max("employment_cd_date").alias("auto_enrollment_date"),
    )
    return collapsed.select(
        "participant_id",
        "global_participant_id",
        *[validity[c].alias(c) for c in ("record_start_date", "record_end_date", "current_indicator")],
        hash_key("participant_id", "global_participant_id", "ssn").alias("hash_key"),
        *[validity[c].alias(c) for c in ("create_date", "update_date", "update_userid")],
        constant(None, "string").alias("participant_name"),
        "ssn",
        "birth_date",
        age_in_years(F.col("birth_date").try_cast("date"), as_of).alias("age"),
        "department_code",
        "employer_agency_code",
        "payroll_office_number",
        constant(None, "string").alias("employment_status"),
        "auto_enrollment_code",
        "auto_enrollment_date",
    )


def participant_history(
    people: DataFrame,
    created: DataFrame,
    updated: DataFrame,
    as_of: Column,
    user_id: str = UPDATE_USER,
    source_zone: str | None = None,
) -> DataFrame:
    """Current history rows of people whose latest event created or updated them.

    ``people`` holds the latest message per person, ``created`` and ``updated`` the latest event
    per person; a person whose latest event has another action is left out.
    """
    acted = created.filter(F.col("action") == CREATED.action).unionByName(updated.filter(F.col("action") == UPDATED.action))
    return history_of(people, acted, as_of, user_id, source_zone)


def history_of(people: DataFrame, acted: DataFrame, as_of: Column, user_id: str = UPDATE_USER, source_zone: str | None = None) -> DataFrame:
    """As :func:`participant_history`, from the events that created or updated people."""
    wanted = people.filter(F.col("participant_id").isNotNull() & (F.col("subtopic") == PERSON_SUBTOPIC))
    keys = {
        "participant_id": F.col("participant_id"),
        "global_participant_id": F.col("global_participant_id"),
        "hash_key": hash_key("global_participant_id", "participant_id", "ssn"),
        "age": age_in_years(F.col("birth_date").try_cast("date"), as_of),
    }
    rows = wanted.join(acted.withColumnRenamed("person_id", "participant_id"), "participant_id").withColumns(
        {
            "sourcesystemextractiontimestamp": parse_offset_timestamp("extracted_at", source_zone),
            "messageTimestamp": parse_offset_timestamp("event_at", source_zone),
        }
    )
    collapsed = rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*[F.max(c).alias(c) for c in HISTORY_MAXIMA])
    return collapsed.withColumns(_validity(as_of, user_id))


def balance_people_from_tables(flat: Flattened, tie_break: Sequence[str]) -> DataFrame:
    """Latest message per person, marks of its account kinds, and a row for each of its originating persons."""
    people = latest_people_from_tables(flat, tie_break)
    origin = F.explode_outer(F.col("origins.origin")).alias("originatingpersoninternalid")
    return people.select(*flat.load(), *HEADER_FIELDS, "civilian", "uniformed", origin)


def balance_people_from_messages(messages: DataFrame, tie_break: Sequence[str], message: str = "message") -> DataFrame:
    latest = latest_messages(messages, tie_break, message)
    names = _inner_arrays(F.col(message)[ATTRIBUTES], NAMED)["fieldName"]
    return latest.select(
        *[c for c in [LOAD_COLUMN] if c in messages.columns],
        *[F.col(f"{message}.{path}").alias(out) for out, path in HEADER_FIELDS.items()],
        F.array_contains(names, CIVILIAN_MARK).alias("civilian"),
        F.array_contains(names, UNIFORMED_MARK).alias("uniformed"),
        F.explode_outer(F.array_distinct(F.col(message)[ACCOUNTS][ORIGINATING])).alias("originatingpersoninternalid"),
    )


def balances_from_tables(flat: Flattened) -> DataFrame:
    """One row per fund position of each balance message."""
    load, funds = flat.load(), f"{PLANS}.val.{FUNDS}"
    top = flat.top().filter(F.col(flat.name(HEADER_FIELDS["subtopic"])) == BALANCE_SUBTOPIC)
    rows = top.select(
        F.col(flat.name(HEADER_FIELDS["participant_id"])).alias("participant_id"), *load, F.col(flat.name(PLANS)).alias("_plans")
    )
    plans = flat.child(PLANS).select(F.col("id").alias("_plans"), *load, F.col(flat.name(funds)).alias("_funds"))
    positions = flat.child(funds).select(
        F.col("id").alias("_funds"), *load, *[F.col(f"{flat.name(funds)}_val_{f}").alias(out) for out, f in FUND_FIELDS.items()]
    )
    joined = rows.join(plans, ["_plans", *load], "left").join(positions, ["_funds", *load], "left")
    return joined.select("participant_id", *load, *FUND_FIELDS)


def balances_from_messages(messages: DataFrame, message: str = "message") -> DataFrame:
    load = [c for c in [LOAD_COLUMN] if c in messages.columns]
    plans = messages.filter(F.col(f"{message}.{HEADER_FIELDS['subtopic']}") == BALANCE_SUBTOPIC).select(
        F.col(f"{message}.{HEADER_FIELDS['participant_id']}").alias("participant_id"),
        *load,
        F.explode_outer(F.col(f"{message}.{PLANS}")).alias("_plan"),
    )
    funds = plans.select("participant_id", *load, F.explode_outer(F.col(f"_plan.{FUNDS}")).alias("_fund"))
    return funds.select("participant_id", *load, *[F.col(f"_fund.{f}").alias(out) for out, f in FUND_FIELDS.items()])


def participant_balances(
    people: DataFrame,
    balances: DataFrame,
    events: DataFrame,
    prices: DataFrame,
    account_groups: DataFrame,
    as_of: Column,
    civilian_account: str = "accountid_civilian",
    uniformed_account: str = "accountid_uniform",
    group: str = "group",
    fund_descriptions: DataFrame | None = None,
    user_id: str = UPDATE_USER,
) -> DataFrame:
    """Fund positions of every person with prices and account groups.

    ``account_groups`` is looked up twice, once for each account kind. A person whose latest
    message is not a person message, or who has no balances, keeps one row without positions.
    """
    load = [c for c in [LOAD_COLUMN] if c in people.columns and c in balances.columns]
    known = events.select(F.col("person_id").alias("participant_id"), "global_participant_id", "event_at")
    keyed = people.join(known, ["participant_id"], "left").withColumn(
        "_person", F.when(F.col("subtopic") == PERSON_SUBTOPIC, F.col("participant_id"))
    )
    rows = left_join_many(keyed, balances.withColumnRenamed("participant_id", "_person"), ["_person", *load])
    rows = lookup(rows, prices, [(F.col("fundid"), "fund_id")], {"price": "_price"})
    rows = lookup(rows, account_groups, [(F.col("accountid"), civilian_account)], {group: "_civilian_group"})
    rows = lookup(rows, account_groups, [(F.col("accountid"), uniformed_account)], {group: "_uniformed_group"})
    described = []
    if fund_descriptions is not None:
        rows = lookup(rows, fund_descriptions, [(F.col("fundid"), "fund_id")], {"fund_description": "_fund_desc"})
        described = [F.col("_fund_desc").alias("fund_desc")]
    varying = rows.select(
        "participant_id",
        "global_participant_id",
        "ssn",
        "fundid",
        "subfundid",
        "accountid",
        *described,
        decimal("fund_balance_units", 22, 7).alias("fund_balance_units"),
        decimal("_price", 12, 6).alias("price"),
        F.when(F.col("civilian"), F.col("_civilian_group")).cast("string").alias("civilian_group"),
        F.when(F.col("uniformed"), F.col("_uniformed_group")).cast("string").alias("uniformed_group"),
        parse_offset_timestamp("extracted_at").alias("sourcesystemextractiontimestamp"),
        parse_offset_timestamp("event_at").alias("messageTimestamp"),
        "originatingpersoninternalid",
    )
    person, fund = ["participant_id", "global_participant_id"], ["ssn", "fundid", "subfundid", "accountid"]
    rest = [c for c in varying.columns if c not in (*person, *fund, "fund_desc")]
    return distinct_rows(varying).select(
        *person,
        *[c.alias(n) for n, c in _validity(as_of, user_id).items()],
        constant(None, "string").alias("participant_name"),
        *fund,
        F.col("fund_desc") if described else constant(None, "string").alias("fund_desc"),
        *rest,
    )
