"""Queries on conforming, change detection, versions and joins in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions.fingerprint import fingerprint
from annalist.operators import asof, conform, facts, hierarchy, incremental, keys, versions
from annalist.plans import inputs, oracle
from annalist.plans.inputs import (
    EVENTS, EVENTS_SPEC, IDENTITY, ORDERS, ORDERS_SPEC, PEOPLE, PEOPLE_SPEC, RAW_TEXT,
    RAW_TEXT_SPEC,
)
from annalist.plans.registry import query
from annalist.sources.scratch import materialize

TWO = ORDERS_SPEC.with_(tracked=("status", "priority_or_null"))
SHIFT = ORDERS_SPEC.with_(tracked=("even_status", "odd_status"))
AS_OF = "1998-06-30"

ORDERS_SNAP = oracle.snapshot("snap", ORDERS, ORDERS_SPEC)
EVENTS_SNAP = oracle.snapshot("snap", EVENTS, EVENTS_SPEC)
PEOPLE_SNAP = oracle.snapshot("people", PEOPLE, PEOPLE_SPEC)


def orders_snapshot(spark, sf_dir) -> DataFrame:
    return conform.conform_snapshot(ORDERS.frame(spark, sf_dir), ORDERS_SPEC)


def events_snapshot(spark, sf_dir) -> DataFrame:
    return conform.conform_snapshot(EVENTS.frame(spark, sf_dir), EVENTS_SPEC)


def people_snapshot(spark, sf_dir) -> DataFrame:
    return conform.conform_snapshot(PEOPLE.frame(spark, sf_dir), PEOPLE_SPEC)


def people_versions(spark, sf_dir) -> DataFrame:
    return versions.build_versions(people_snapshot(spark, sf_dir), PEOPLE_SPEC)


# Conforming.

_PARSED = (
    "parsed AS (SELECT entity, TRY_CAST(day AS DATE) AS day, CASE WHEN"
    " regexp_full_match(flag, '[0-9]+') THEN CAST(flag AS INT) END AS flag, row_id FROM raw_text)"
)
_RAW = oracle.with_(f"raw_text AS ({RAW_TEXT.sql()})", _PARSED)


@query(
    _RAW + "SELECT entity, day, flag, row_id FROM (SELECT *, row_number() OVER (PARTITION BY entity,"
    " day ORDER BY row_id) AS rn FROM parsed WHERE entity IS NOT NULL AND day IS NOT NULL)"
    " WHERE rn = 1"
)
def snapshot_conform(spark, sf_dir):
    return conform.conform_snapshot(
        RAW_TEXT.frame(spark, sf_dir), RAW_TEXT_SPEC, dates=["day"], ints=["flag"]
    )


@query(
    _RAW + "SELECT entity, day, flag, row_id, CASE WHEN entity IS NULL THEN 'missing key' ELSE"
    " 'missing date' END AS quarantine_reason FROM parsed WHERE entity IS NULL OR day IS NULL"
)
def quarantined_rows(spark, sf_dir):
    typed = conform.conform_types(RAW_TEXT.frame(spark, sf_dir), dates=["day"], ints=["flag"])
    return conform.quarantine(typed, RAW_TEXT_SPEC)


@query(
    oracle.with_(f"raw AS ({ORDERS.sql()})")
    + "SELECT custkey, day, orderkey, status, priority FROM (SELECT *, row_number() OVER"
    " (PARTITION BY custkey ORDER BY day, orderkey) AS rn FROM raw) WHERE rn = 1"
)
def first_seen_base(spark, sf_dir):
    columns = ["custkey", "day", "orderkey", "status", "priority"]
    return conform.first_seen(ORDERS.frame(spark, sf_dir), ORDERS_SPEC, columns)


@query(
    oracle.with_(f"raw AS ({ORDERS.sql()})")
    + "SELECT custkey, min(day) AS first_snapshot_date FROM raw GROUP BY custkey"
)
def first_date_per_key(spark, sf_dir):
    return conform.first_date_per_key(ORDERS.frame(spark, sf_dir), ORDERS_SPEC)


@query(
    oracle.with_(f"raw AS ({EVENTS.sql()})")
    + "SELECT 'history' AS part, user_id, day, event_id FROM raw WHERE day < (SELECT max(day) FROM"
    " raw) UNION ALL SELECT 'latest', user_id, day, event_id FROM raw WHERE day ="
    " (SELECT max(day) FROM raw)"
)
def history_latest_split(spark, sf_dir):
    columns = ["user_id", "day", "event_id"]
    history, latest = conform.history_and_latest(EVENTS.frame(spark, sf_dir).select(*columns), "day")
    return history.select(F.lit("history").alias("part"), *columns).unionByName(
        latest.select(F.lit("latest").alias("part"), *columns)
    )


# Change detection.


@query(
    oracle.with_(f"raw AS ({ORDERS.sql()})")
    + "SELECT orderkey, sha256(concat_ws('|', status, priority_or_null)) AS tracked_hash FROM raw"
)
def row_fingerprint(spark, sf_dir):
    digest = fingerprint([F.col(c) for c in TWO.tracked])
    return ORDERS.frame(spark, sf_dir).select("orderkey", digest.alias("tracked_hash"))


_PAIRS = ", ".join(f"prev_{c}, {c}" for c in PEOPLE_SPEC.tracked)


@query(
    oracle.with_(PEOPLE_SNAP, oracle.events("ev", "people", PEOPLE_SPEC))
    + f"SELECT employee_id, event_date, {_PAIRS}, tracked_hash FROM ev"
)
def change_events_wide(spark, sf_dir):
    return versions.change_events(people_snapshot(spark, sf_dir), PEOPLE_SPEC)


def _log_sql() -> str:
    w = "OVER (PARTITION BY employee_id ORDER BY snapshot_date)"
    lags = ", ".join(f"lag({c}) {w} AS p_{c}" for c in PEOPLE_SPEC.tracked)
    parts = [
        f"SELECT employee_id, snapshot_date AS event_date, '{c}_changed' AS event_type,"
        f" '{c}' AS attribute_name, CAST(p_{c} AS VARCHAR) AS previous_value,"
        f" CAST({c} AS VARCHAR) AS new_value FROM l WHERE pos > 1 AND {c} IS DISTINCT FROM p_{c}"
        for c in PEOPLE_SPEC.tracked
    ]
    return oracle.with_(
        PEOPLE_SNAP, f"l AS (SELECT *, row_number() {w} AS pos, {lags} FROM people)"
    ) + " UNION ALL ".join(parts)


@query(_log_sql())
def change_log_long(spark, sf_dir):
    return versions.change_log(people_snapshot(spark, sf_dir), PEOPLE_SPEC)


# Versions.


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", ORDERS_SPEC))
    + f"SELECT {oracle.version_columns(ORDERS_SPEC)} FROM dim"
)
def scd2_full(spark, sf_dir):
    return versions.build_versions(orders_snapshot(spark, sf_dir), ORDERS_SPEC)


@query(
    oracle.with_(EVENTS_SNAP, oracle.versions("dim", "snap", EVENTS_SPEC))
    + f"SELECT {oracle.version_columns(EVENTS_SPEC)} FROM dim"
)
def scd2_events(spark, sf_dir):
    return versions.build_versions(events_snapshot(spark, sf_dir), EVENTS_SPEC)


@query(
    oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC))
    + f"SELECT {oracle.version_columns(PEOPLE_SPEC)} FROM dim"
)
def scd2_workforce(spark, sf_dir):
    return people_versions(spark, sf_dir)


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", SHIFT.with_(null_safe=True)))
    + f"SELECT {oracle.version_columns(SHIFT, digest_column=False)} FROM dim"
)
def scd2_full_nullsafe(spark, sf_dir):
    spec = SHIFT.with_(null_safe=True)
    return versions.build_versions(orders_snapshot(spark, sf_dir), spec).drop("hash_diff")


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", SHIFT))
    + f"SELECT {oracle.version_columns(SHIFT)} FROM dim"
)
def scd2_null_shift(spark, sf_dir):
    return versions.build_versions(orders_snapshot(spark, sf_dir), SHIFT)


POSITIONAL = SHIFT.with_(missing="")


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", POSITIONAL))
    + f"SELECT {oracle.version_columns(POSITIONAL)} FROM dim"
)
def scd2_positional(spark, sf_dir):
    return versions.build_versions(orders_snapshot(spark, sf_dir), POSITIONAL)


@query(
    oracle.with_(EVENTS_SNAP, oracle.versions("dim", "snap", EVENTS_SPEC))
    + f"SELECT {oracle.version_columns(EVENTS_SPEC, last_seen=True)} FROM dim"
)
def scd2_last_seen(spark, sf_dir):
    return versions.build_versions(events_snapshot(spark, sf_dir), EVENTS_SPEC, with_last_seen=True)


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", ORDERS_SPEC))
    + f"SELECT {oracle.version_columns(ORDERS_SPEC)} FROM dim WHERE is_current"
)
def scd2_current(spark, sf_dir):
    return versions.current_versions(scd2_full(spark, sf_dir))


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", ORDERS_SPEC))
    + f"SELECT {oracle.version_columns(ORDERS_SPEC)} FROM dim WHERE DATE '{AS_OF}' BETWEEN"
    " effective_start_date AND effective_end_date"
)
def scd2_as_of_day(spark, sf_dir):
    return asof.as_of_day(scd2_full(spark, sf_dir), AS_OF)


@query(
    oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC))
    + "SELECT row_number() OVER (ORDER BY employee_id, effective_start_date) AS employee_sk,"
    " employee_id, effective_start_date, hash_diff FROM dim"
)
def surrogate_keys(spark, sf_dir):
    dim = versions.keyed_versions(people_snapshot(spark, sf_dir), PEOPLE_SPEC, "employee_sk")
    return dim.select("employee_sk", "employee_id", "effective_start_date", "hash_diff")


@query(
    oracle.with_(f"raw AS ({ORDERS.sql()})")
    + "SELECT row_number() OVER (ORDER BY status, priority, orderkey) AS order_sk, status, priority,"
    " orderkey FROM raw"
)
def dense_keys_by_status(spark, sf_dir):
    rows = ORDERS.frame(spark, sf_dir).select("status", "priority", "orderkey")
    return keys.dense_keys(rows, ["status", "priority", "orderkey"], "order_sk")


@query(
    oracle.with_(EVENTS_SNAP, oracle.versions("dim", "snap", EVENTS_SPEC))
    + "SELECT user_id, CAST(unnest(generate_series(effective_start_date, least(effective_end_date,"
    " (SELECT max(day) FROM snap)), INTERVAL 1 DAY)) AS DATE) AS day, event_type FROM dim"
)
def history_expansion(spark, sf_dir):
    snap = events_snapshot(spark, sf_dir)
    dim = versions.build_versions(snap, EVENTS_SPEC)
    latest = EVENTS.frame(spark, sf_dir).agg(F.max("day")).scalar()
    return versions.expand_days(dim, EVENTS_SPEC, latest)


@query(
    oracle.with_(EVENTS_SNAP, oracle.versions("dim", "snap", EVENTS_SPEC))
    + "SELECT user_id, effective_start_date, CASE WHEN is_current AND last_seen_date < m THEN"
    " last_seen_date ELSE effective_end_date END AS effective_end_date, is_current AND NOT"
    " (last_seen_date < m) AS is_current, event_type, last_seen_date FROM dim,"
    " (SELECT max(day) AS m FROM snap)"
)
def close_absent_entities(spark, sf_dir):
    dim = scd2_last_seen(spark, sf_dir).drop("hash_diff")
    latest = EVENTS.frame(spark, sf_dir).agg(F.max("day")).scalar()
    return versions.close_absent(dim, latest)


# Incremental maintenance: every variant must equal the full build.


def _grown(spark, sf_dir, spec, cuts, late=None):
    """Build up to the first cut, then apply the days between cuts batch by batch.

    With ``late`` the rows it selects are held back and arrive with the last batch.
    """
    raw = ORDERS.frame(spark, sf_dir)
    held = raw.filter(late) if late else raw.filter("false")
    rest = raw.filter(f"NOT ({late})") if late else raw
    first = conform.one_row_per_day(rest.filter(F.col("day") <= cuts[0]), spec)
    dim = versions.build_versions(first, spec, with_last_seen=True)
    bounds = [*cuts, "9999-12-31"]
    for after, until in zip(bounds, bounds[1:]):
        batch = rest.filter((F.col("day") > after) & (F.col("day") <= until))
        history = rest.filter(F.col("day") <= until)
        if until == bounds[-1]:
            batch, history = batch.unionByName(held), raw
        # The dimension is a stored table between batches.
        dim = incremental.apply_batch(materialize(dim, "dimension"), batch, spec, history)
    return dim


_GROWN = (
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", TWO))
    + f"SELECT {oracle.version_columns(TWO, last_seen=True)} FROM dim"
)


@query(_GROWN)
def scd2_incremental_latest_day(spark, sf_dir):
    raw = ORDERS.frame(spark, sf_dir)
    history, latest = conform.history_and_latest(raw, "day")
    dim = versions.build_versions(conform.one_row_per_day(history, TWO), TWO, with_last_seen=True)
    return incremental.apply_batch(materialize(dim, "dimension"), latest, TWO, raw)


@query(_GROWN)
def scd2_incremental(spark, sf_dir):
    return _grown(spark, sf_dir, TWO, ["1998-01-01", "2000-01-01"])


@query(_GROWN)
def scd2_incremental_late(spark, sf_dir):
    return _grown(spark, sf_dir, TWO, ["1998-01-01"], late="orderkey % 13 = 5")


@query(
    oracle.with_(ORDERS_SNAP, oracle.versions("dim", "snap", SHIFT))
    + f"SELECT {oracle.version_columns(SHIFT, last_seen=True)} FROM dim"
)
def scd2_incremental_null_shift(spark, sf_dir):
    return _grown(spark, sf_dir, SHIFT, ["1998-01-01", "2000-01-01"])


# Facts.

_FACT = (
    f"{oracle.date_key('snapshot_date')} AS date_key, snapshot_date, employee_id, status, org_unit,"
    " team, work_mode, fte_flag, salary_band, CASE WHEN status = 'active' THEN 1 ELSE 0 END AS"
    " active_headcount_flag"
)
FACT_SQL = f"fact AS (SELECT {_FACT} FROM people)"


def people_fact(spark, sf_dir) -> DataFrame:
    attributes = ["status", "org_unit", "team", "work_mode", "fte_flag", "salary_band"]
    return facts.daily_fact(
        people_snapshot(spark, sf_dir), PEOPLE_SPEC, attributes, "status", "active"
    )


@query(oracle.with_(PEOPLE_SNAP, FACT_SQL) + "SELECT * FROM fact")
def fact_daily(spark, sf_dir):
    return people_fact(spark, sf_dir)


EDGES_SQL = (
    f"edges AS (SELECT {oracle.date_key('snapshot_date')} AS date_key, snapshot_date, employee_id,"
    " manager_id AS manager_employee_id, org_unit, team FROM people)"
)


def people_edges(spark, sf_dir) -> DataFrame:
    return facts.reporting_fact(
        people_snapshot(spark, sf_dir),
        PEOPLE_SPEC,
        "manager_id",
        "manager_employee_id",
        ["org_unit", "team"],
    )


@query(oracle.with_(PEOPLE_SNAP, EDGES_SQL) + "SELECT * FROM edges")
def fact_reporting(spark, sf_dir):
    return people_edges(spark, sf_dir)


@query(
    oracle.with_(PEOPLE_SNAP, oracle.events("ev", "people", PEOPLE_SPEC))
    + f"SELECT {oracle.date_key('event_date')} AS date_key, event_date, employee_id, {_PAIRS} FROM ev"
)
def fact_change(spark, sf_dir):
    return facts.change_fact(change_events_wide(spark, sf_dir), PEOPLE_SPEC)


_KEYED = (
    "keyed AS (SELECT row_number() OVER (ORDER BY employee_id, effective_start_date) AS employee_sk,"
    " * FROM dim)"
)


@query(
    oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC), _KEYED, FACT_SQL)
    + "SELECT f.*, k.employee_sk FROM fact f LEFT JOIN keyed k ON f.employee_id = k.employee_id AND"
    " f.snapshot_date BETWEEN k.effective_start_date AND k.effective_end_date"
)
def fact_sk_lookup(spark, sf_dir):
    dim = versions.keyed_versions(people_snapshot(spark, sf_dir), PEOPLE_SPEC, "employee_sk")
    return facts.with_version_key(people_fact(spark, sf_dir), dim, PEOPLE_SPEC, "employee_sk")


# Raw events (not one row a day) against the versions of their user.
@query(
    oracle.with_(EVENTS_SNAP, oracle.versions("dim", "snap", EVENTS_SPEC))
    + "SELECT r.event_id, r.user_id, r.day, d.effective_start_date, d.hash_diff FROM snap_raw r"
    " LEFT JOIN dim d ON r.user_id = d.user_id AND r.day BETWEEN d.effective_start_date AND"
    " d.effective_end_date"
)
def events_as_of_version(spark, sf_dir):
    facts_ = EVENTS.frame(spark, sf_dir).select("event_id", "user_id", "day")
    return asof.as_of_versions(
        facts_, scd2_events(spark, sf_dir), "user_id", "day", "user_id",
        ["effective_start_date", "hash_diff"],
    )


@query(
    oracle.with_(f"raw AS ({ORDERS.sql()})", "b AS (SELECT min(day) lo, max(day) hi FROM raw)",
                 "days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE)"
                 " AS date FROM b)")
    + f"SELECT {oracle.date_key('date')} AS date_key, date, CAST(year(date) AS INT) AS year,"
    " CAST(quarter(date) AS INT) AS quarter, CAST(month(date) AS INT) AS month,"
    " CAST(day(date) AS INT) AS day_of_month, CAST(isodow(date) AS INT) AS day_of_week,"
    " CAST(weekofyear(date) AS INT) AS iso_week, isodow(date) >= 6 AS is_weekend,"
    " CAST(date_trunc('month', date) AS DATE) AS month_start, last_day(date) AS month_end FROM days"
)
def date_dim(spark, sf_dir):
    return facts.date_dimension(ORDERS.frame(spark, sf_dir), "day", "day")


# Managers.


@query(
    oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC), EDGES_SQL)
    + "SELECT e.*, d.effective_start_date AS manager_effective_start_date, d.status AS"
    " manager_status, d.salary_band AS manager_salary_band FROM edges e LEFT JOIN dim d ON"
    " e.manager_employee_id = d.employee_id AND e.snapshot_date BETWEEN d.effective_start_date AND"
    " d.effective_end_date"
)
def manager_as_of(spark, sf_dir):
    edges = materialize(people_edges(spark, sf_dir), "reporting")
    return asof.manager_versions(
        edges, people_versions(spark, sf_dir), "manager_employee_id",
        "snapshot_date", "employee_id", ["effective_start_date", "status", "salary_band"],
    )


@query(
    oracle.with_(PEOPLE_SNAP, EDGES_SQL)
    + "SELECT snapshot_date, manager_employee_id, count(*) AS direct_reports FROM edges"
    " WHERE manager_employee_id IS NOT NULL GROUP BY ALL"
)
def span_of_control(spark, sf_dir):
    return hierarchy.span_of_control(
        people_edges(spark, sf_dir), "manager_employee_id", ["snapshot_date"]
    )


@query(
    oracle.with_(PEOPLE_SNAP, EDGES_SQL)
    + "SELECT DISTINCT snapshot_date, manager_employee_id FROM edges e WHERE manager_employee_id IS"
    " NOT NULL AND NOT EXISTS (SELECT 1 FROM edges x WHERE x.snapshot_date = e.snapshot_date AND"
    " x.employee_id = e.manager_employee_id)"
)
def orphan_managers(spark, sf_dir):
    return asof.orphan_managers(
        people_edges(spark, sf_dir), "employee_id", "manager_employee_id", "snapshot_date"
    )


# The walk keeps the list of visited managers; an employee's chain ends in a cycle when the
# next manager is already on it, and at a root when there is no next manager.
_WALK = """
walk AS (
  SELECT employee_id, 0 AS level, employee_id AS ancestor, [employee_id] AS seen FROM edges
  WHERE manager_id IS NOT NULL
  UNION ALL
  SELECT w.employee_id, w.level + 1, e.manager_id, list_append(w.seen, e.manager_id)
  FROM walk w JOIN edges e ON e.employee_id = w.ancestor
  WHERE e.manager_id IS NOT NULL AND NOT list_contains(w.seen, e.manager_id)),
ends AS (
  SELECT w.employee_id, CASE WHEN e.manager_id IS NULL THEN 'root' ELSE 'cycle' END AS ends_in
  FROM (SELECT employee_id, arg_max(ancestor, level) AS ancestor FROM walk GROUP BY employee_id) w
  LEFT JOIN edges e ON e.employee_id = w.ancestor)"""
_CHAIN = (
    "SELECT w.employee_id, w.level, w.ancestor, ends.ends_in FROM walk w JOIN ends USING"
    " (employee_id) WHERE w.level > 0"
)


@query(oracle.with_(f"edges AS ({inputs.CYCLIC_EDGES_SQL})", _WALK) + _CHAIN)
def reporting_chain(spark, sf_dir):
    return hierarchy.reporting_chain(
        inputs.cyclic_edges(spark, sf_dir), "employee_id", "manager_id"
    )


_EDGES_AS_OF = (
    f"edges AS (SELECT employee_id, manager_id FROM dim WHERE DATE '{AS_OF}' BETWEEN"
    " effective_start_date AND effective_end_date)"
)


def _edges_as_of(spark, sf_dir) -> DataFrame:
    return asof.as_of_day(people_versions(spark, sf_dir), AS_OF).select("employee_id", "manager_id")


@query(
    oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC), _EDGES_AS_OF, _WALK)
    + _CHAIN
)
def reporting_chain_as_of(spark, sf_dir):
    return hierarchy.reporting_chain(_edges_as_of(spark, sf_dir), "employee_id", "manager_id")


@query(
    oracle.with_(PEOPLE_SNAP, oracle.versions("dim", "people", PEOPLE_SPEC), _EDGES_AS_OF, _WALK)
    + "SELECT ancestor AS manager_id, count(*) FILTER (WHERE level = 1) AS direct_reports,"
    " count(*) AS all_reports FROM walk WHERE level > 0 GROUP BY ancestor"
)
def all_reports(spark, sf_dir):
    return hierarchy.all_reports(_edges_as_of(spark, sf_dir), "employee_id", "manager_id")


@query(
    oracle.with_(f"edges AS ({inputs.CYCLIC_EDGES_SQL})", _WALK,
                 "lasts AS (SELECT employee_id, arg_max(ancestor, level) AS last FROM walk GROUP BY 1)",
                 # On a cycle the way leads back to where it began.
                 "loops AS (SELECT w.employee_id AS node, min(w.ancestor) AS cycle FROM walk w JOIN lasts"
                 " USING (employee_id) JOIN edges e ON e.employee_id = last AND e.manager_id ="
                 " w.employee_id GROUP BY 1)")
    + "SELECT node, cycle FROM loops"
)
def reporting_cycles(spark, sf_dir):
    """The members of reporting cycles and the smallest member of each."""
    return hierarchy.cycles(inputs.cyclic_edges(spark, sf_dir), "employee_id", "manager_id")


# Star joins.

_IDENTITY_SQL = f"ident AS ({IDENTITY.sql()})"


@query(
    oracle.with_(PEOPLE_SNAP, _IDENTITY_SQL)
    + "SELECT p.employee_id, p.snapshot_date, p.status, p.org_unit, i.full_name, i.work_email,"
    " i.tax_id FROM people p LEFT JOIN ident i USING (employee_id)"
)
def wide_extract(spark, sf_dir):
    return asof.wide_extract(
        people_snapshot(spark, sf_dir), IDENTITY.frame(spark, sf_dir), "employee_id",
        ["full_name", "work_email", "tax_id"],
        ["employee_id", "snapshot_date", "status", "org_unit"], one_row_per_day=True,
    )


_NAMED_WOMEN = "gender = 'F' AND full_name IS NOT NULL"


@query(
    oracle.with_(PEOPLE_SNAP, FACT_SQL, _IDENTITY_SQL)
    + f"SELECT f.* FROM fact f WHERE f.employee_id IN (SELECT employee_id FROM ident WHERE"
    f" {_NAMED_WOMEN})"
)
def rows_of_selected(spark, sf_dir):
    chosen = IDENTITY.frame(spark, sf_dir).filter(_NAMED_WOMEN)
    return asof.rows_of_selected(people_fact(spark, sf_dir), chosen, "employee_id")


@query(
    oracle.with_(_IDENTITY_SQL)
    + "SELECT employee_id, full_name FROM ident WHERE contains(lower(full_name), 'machinery')"
)
def search_by_name(spark, sf_dir):
    ident = IDENTITY.frame(spark, sf_dir).select("employee_id", "full_name")
    return asof.search_by_name(ident, "full_name", "Machinery")


@query(
    oracle.with_(PEOPLE_SNAP, FACT_SQL)
    + "SELECT * FROM fact WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND"
    " org_unit = 'org_3'"
)
def between_dates(spark, sf_dir):
    fact = asof.between_dates(
        people_fact(spark, sf_dir), "snapshot_date", "1997-01-01", "1997-12-31"
    )
    return fact.filter(F.col("org_unit") == "org_3")
