"""Queries on headcount, mix, movement, profiles and status spells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import hr
from annalist.functions import masking
from annalist.operators import asof, lifecycle, measures, versions
from annalist.plans import oracle
from annalist.plans.history import (
    FACT_SQL, PEOPLE_SNAP, people_fact, people_snapshot, people_versions,
)
from annalist.plans.inputs import IDENTITY, PEOPLE_SPEC
from annalist.plans.registry import query

_FACT = oracle.with_(PEOPLE_SNAP, FACT_SQL)
_IDENT = f"ident AS ({IDENTITY.sql()})"
_DIM = oracle.versions("dim", "people", PEOPLE_SPEC)
_EVENTS = oracle.with_(PEOPLE_SNAP, oracle.events("ev", "people", PEOPLE_SPEC))


def _events(spark, sf_dir) -> DataFrame:
    return versions.change_events(
        people_snapshot(spark, sf_dir), PEOPLE_SPEC, with_initial_flag=True
    )


def _moved(*columns: str) -> str:
    return "(" + " OR ".join(f"{c} IS DISTINCT FROM prev_{c}" for c in columns) + ")"


@query(
    _FACT + "SELECT snapshot_date, CAST(sum(active_headcount_flag) AS BIGINT) AS active_headcount"
    " FROM fact GROUP BY snapshot_date"
)
def headcount_daily(spark, sf_dir):
    return measures.active_headcount(people_fact(spark, sf_dir), ["snapshot_date"])


@query(
    _FACT + "SELECT max(snapshot_date) AS snapshot_date, count(*) FILTER (WHERE status = 'on_leave')"
    " AS on_leave FROM fact WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact)"
)
def on_leave_latest(spark, sf_dir):
    on_leave = F.col("status") == "on_leave"
    return measures.count_on_latest_day(
        people_fact(spark, sf_dir), "snapshot_date", on_leave, "on_leave"
    )


@query(
    _FACT + "SELECT max(snapshot_date) AS snapshot_date, count(*) FILTER (WHERE status = 'active')"
    " AS active_headcount FROM fact WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact)"
)
def headcount_latest(spark, sf_dir):
    active = F.col(measures.FLAG) == 1
    return measures.count_on_latest_day(
        people_fact(spark, sf_dir), "snapshot_date", active, "active_headcount"
    )


@query(
    _FACT + "SELECT org_unit, max(snapshot_date) AS snapshot_date, count(*) FILTER (WHERE status ="
    " 'on_leave') AS on_leave FROM fact JOIN (SELECT org_unit, max(snapshot_date) AS snapshot_date"
    " FROM fact GROUP BY org_unit) USING (org_unit, snapshot_date) GROUP BY org_unit"
)
def on_leave_by_unit(spark, sf_dir):
    """Each unit on its own latest day."""
    on_leave = F.col("status") == "on_leave"
    return measures.count_on_latest_day(
        people_fact(spark, sf_dir), "snapshot_date", on_leave, "on_leave", ["org_unit"]
    )


@query(
    _EVENTS + "SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, count(*) FILTER (WHERE"
    f" status = 'terminated' AND {_moved('status')} AND NOT is_initial) AS total_terminations,"
    f" count(*) FILTER (WHERE {_moved('org_unit', 'role_family')} AND NOT is_initial) AS internal_moves"
    " FROM ev GROUP BY 1"
)
def terminations_by_month(spark, sf_dir):
    """Terminations and internal moves of each month with events."""
    month = F.trunc("event_date", "month").alias("month")
    events = _events(spark, sf_dir)
    left = measures.terminations(events, by=[month])
    return left.join(measures.internal_moves(events, ["org_unit", "role_family"], by=[month]), "month")


@query(
    _EVENTS + "SELECT count(*) AS total_terminations FROM ev WHERE status = 'terminated' AND"
    f" {_moved('status')} AND NOT is_initial"
)
def terminations(spark, sf_dir):
    return measures.terminations(_events(spark, sf_dir))


@query(
    _EVENTS + "SELECT count(*) AS internal_moves FROM ev WHERE NOT is_initial AND"
    f" {_moved('org_unit', 'role_family')}"
)
def internal_moves(spark, sf_dir):
    return measures.internal_moves(_events(spark, sf_dir), ["org_unit", "role_family"])


@query(
    _EVENTS + "SELECT count(*) AS internal_moves FROM ev WHERE"
    f" {_moved('org_unit', 'role_family')}"
)
def internal_moves_with_first_days(spark, sf_dir):
    moves = ["org_unit", "role_family"]
    return measures.internal_moves(_events(spark, sf_dir), moves, count_initial=True)


@query(
    _FACT + "SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, snapshot_date AS"
    " counted_on, work_mode, CAST(sum(active_headcount_flag) AS BIGINT) AS active_headcount FROM"
    " fact WHERE snapshot_date IN (SELECT max(snapshot_date) FROM fact GROUP BY date_trunc('month',"
    " snapshot_date)) GROUP BY ALL"
)
def headcount_month(spark, sf_dir):
    return measures.headcount_by_month(people_fact(spark, sf_dir), "snapshot_date", ["work_mode"])


@query(
    _FACT + "SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, work_mode,"
    " round(sum(active_headcount_flag) / max(days), 6) AS active_headcount FROM fact JOIN (SELECT"
    " date_trunc('month', snapshot_date) AS m, count(DISTINCT snapshot_date) AS days FROM fact"
    " GROUP BY m) ON date_trunc('month', snapshot_date) = m GROUP BY 1, 2"
)
def headcount_month_average(spark, sf_dir):
    fact = people_fact(spark, sf_dir)
    months = measures.headcount_by_month(fact, "snapshot_date", ["work_mode"], "average")
    return months.withColumn("active_headcount", F.round("active_headcount", 6))


@query(
    _FACT + "SELECT org_unit, team, grouping(org_unit, team) AS level,"
    " CAST(sum(active_headcount_flag) AS BIGINT) AS active_headcount FROM fact"
    " GROUP BY ROLLUP (org_unit, team)"
)
def org_rollup(spark, sf_dir):
    return measures.headcount_rollup(people_fact(spark, sf_dir), ["org_unit", "team"])


def _kind() -> str:
    return (
        "CASE WHEN is_initial THEN 'hire' WHEN prev_status = 'terminated' AND status = 'active'"
        " THEN 'rehire' WHEN status = 'terminated' AND prev_status <> 'terminated' THEN"
        " 'termination' WHEN status = 'on_leave' AND prev_status <> 'on_leave' THEN 'leave_start'"
        " WHEN prev_status = 'on_leave' AND status = 'active' THEN 'leave_return' WHEN salary_band"
        " > prev_salary_band THEN 'promotion' WHEN salary_band < prev_salary_band THEN 'demotion'"
        f" WHEN {_moved('org_unit', 'team')} THEN 'transfer' WHEN {_moved('location')} THEN"
        " 'relocation' ELSE 'other' END"
    )


_MONTH = "CAST(date_trunc('month', event_date) AS DATE) AS month"


@query(
    _EVENTS + f"SELECT {_MONTH}, {_kind()} AS event_type, count(*) AS events FROM ev GROUP BY 1, 2"
)
def events_by_month_type(spark, sf_dir):
    return measures.events_by_month(measures.classify_events(_events(spark, sf_dir), hr.BANDS))


@query(
    _EVENTS
    + f"SELECT {_MONTH}, "
    + ", ".join(f"count(*) FILTER (WHERE {_kind()} = '{t}') AS {t}" for t in measures.EVENT_TYPES)
    + " FROM ev GROUP BY 1"
)
def events_by_month_wide(spark, sf_dir):
    return measures.events_by_month_wide(measures.classify_events(_events(spark, sf_dir), hr.BANDS))


@query(
    _EVENTS + f"SELECT {_MONTH}, count(*) FILTER (WHERE salary_band > prev_salary_band) AS"
    " promotions, count(*) FILTER (WHERE salary_band < prev_salary_band) AS demotions, count(*)"
    f" FILTER (WHERE {_moved('org_unit', 'team')}) AS transfers, count(*) FILTER (WHERE"
    f" {_moved('role_family')}) AS role_changes, count(*) FILTER (WHERE {_moved('location')}) AS"
    " relocations FROM ev WHERE NOT is_initial GROUP BY 1"
)
def mobility(spark, sf_dir):
    return measures.mobility(_events(spark, sf_dir), hr.BANDS)


_MIX = ("work_mode", "fte_flag", "status")


@query(
    _FACT
    + "SELECT *, round(people / sum(people) OVER (PARTITION BY snapshot_date, dimension), 6) AS"
    " share FROM ("
    + " UNION ALL ".join(
        f"SELECT snapshot_date, '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS"
        f" people FROM fact GROUP BY ALL"
        for d in _MIX
    )
    + ")"
)
def workforce_mix(spark, sf_dir):
    mix = measures.workforce_mix(people_fact(spark, sf_dir), ["snapshot_date"], _MIX)
    return mix.withColumn("share", F.round("share", 6))


@query(
    oracle.with_(PEOPLE_SNAP, FACT_SQL, _IDENT)
    + "SELECT snapshot_date, gender, CAST(sum(active_headcount_flag) AS BIGINT) AS active_headcount"
    " FROM fact LEFT JOIN ident USING (employee_id) GROUP BY ALL"
)
def headcount_by_gender(spark, sf_dir):
    star = asof.with_dimension(
        people_fact(spark, sf_dir), IDENTITY.frame(spark, sf_dir), "employee_id", ["gender"]
    )
    return measures.active_headcount(star, ["snapshot_date", "gender"])


@query(
    _FACT + "SELECT c_mktsegment, n_name, CAST(sum(active_headcount_flag) AS BIGINT) AS"
    " active_headcount FROM fact JOIN customer ON employee_id = c_custkey JOIN nation ON"
    " c_nationkey = n_nationkey GROUP BY ALL"
)
def star_by_segment(spark, sf_dir):
    # Reduced to one row per employee before it meets the dimensions.
    heads = measures.active_headcount(people_fact(spark, sf_dir), ["employee_id"])
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = heads.join(customer, F.col("employee_id") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy("c_mktsegment", "n_name").agg(
        F.sum("active_headcount").alias("active_headcount")
    )


@query(
    oracle.with_(PEOPLE_SNAP, _DIM, _IDENT)
    + "SELECT employee_id, 'Career History for ' || coalesce(max(full_name), '') || ':' || chr(10)"
    " || chr(10) || string_agg('• ' || strftime(effective_start_date, '%Y-%m-%d') || ' to ' ||"
    " CASE WHEN is_current THEN 'Present' ELSE strftime(effective_end_date, '%Y-%m-%d') END ||"
    " chr(10) || '  └ ' || role_family || ' (' || org_unit || ')', chr(10) || chr(10) ORDER BY"
    " effective_start_date) AS history FROM dim LEFT JOIN ident USING (employee_id) GROUP BY employee_id"
)
def career_timeline(spark, sf_dir):
    return measures.career_timeline(
        people_versions(spark, sf_dir), IDENTITY.frame(spark, sf_dir), "employee_id", "full_name",
        "role_family", "org_unit",
    )


@query(
    oracle.with_(PEOPLE_SNAP, _DIM, _IDENT)
    + f"SELECT employee_id, '📧 Email: ' || coalesce({oracle.email('work_email')}, '') || chr(10) ||"
    " '📞 Phone: ' || coalesce(team, '') || chr(10) || '🏢 Work Mode: ' || coalesce(work_mode, '') ||"
    " chr(10) || '🏠 Address: ' || coalesce(org_unit, '') || ', ' || coalesce(location, '') AS"
    " profile FROM ident LEFT JOIN (SELECT * FROM dim WHERE is_current) USING (employee_id)"
)
def profile_card(spark, sf_dir):
    static = IDENTITY.frame(spark, sf_dir).select(
        "employee_id", masking.mask_email("work_email").alias("work_email_masked")
    )
    return measures.profile_card(
        people_versions(spark, sf_dir), static, "employee_id", "work_email_masked",
        phone="team", mode="work_mode", street="org_unit", city="location",
    )


_SPELLS = """
marked AS (SELECT *, lag(status) OVER (PARTITION BY employee_id ORDER BY snapshot_date) AS was
  FROM people),
spells AS (SELECT employee_id, status, snapshot_date AS start,
  lead(snapshot_date) OVER w AS next_start, lead(status) OVER w AS next_status
  FROM marked WHERE was IS NULL OR was <> status
  WINDOW w AS (PARTITION BY employee_id ORDER BY snapshot_date))"""


@query(
    oracle.with_(PEOPLE_SNAP, _SPELLS)
    + "SELECT employee_id, start AS leave_start, CAST(next_start - 1 AS DATE) AS leave_end,"
    " CAST(next_start - start AS INT) AS leave_days, coalesce(next_status = 'active', false) AS"
    " returned, next_status FROM spells WHERE status = 'on_leave'"
)
def leave_spells(spark, sf_dir):
    return lifecycle.leave_spells(people_snapshot(spark, sf_dir), PEOPLE_SPEC, "status")


@query(
    oracle.with_(PEOPLE_SNAP, _SPELLS)
    + "SELECT t.employee_id, t.start AS terminated_on, min(a.start) AS rehired_on,"
    " CAST(min(a.start) - t.start AS INT) AS days_away FROM spells t LEFT JOIN spells a ON"
    " a.employee_id = t.employee_id AND a.status = 'active' AND a.start > t.start"
    " WHERE t.status = 'terminated' GROUP BY t.employee_id, t.start"
)
def rehire_windows(spark, sf_dir):
    return lifecycle.rehire_windows(people_snapshot(spark, sf_dir), PEOPLE_SPEC, "status")
