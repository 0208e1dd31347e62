"""Queries on masks, the static dimension, publishing rules and integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from annalist import hr
from annalist.functions import masking
from annalist.functions.fingerprint import configured_salt, stable_token
from annalist.operators import governance, keys, quality
from annalist.plans import history, inputs, oracle
from annalist.plans.inputs import IDENTITY, PEOPLE_SPEC
from annalist.plans.registry import query
from annalist.sources.scratch import materialize

_IDENT = f"ident AS ({IDENTITY.sql()})"


def _base(spark, sf_dir):
    placed = {
        "org_unit": "'org_' || CAST(employee_id % 5 AS STRING)",
        "role_family": "CASE WHEN employee_id % 4 > 0 THEN 'role_'"
        " || CAST(employee_id % 4 AS STRING) END",
        "location": "home_address_city",
    }
    exprs = [f"{e} AS {n}" for n, e in placed.items()]
    return IDENTITY.frame(spark, sf_dir).selectExpr("*", *exprs)


_CORE = (
    f"{oracle.birth_year('date_of_birth')} AS birth_year_masked, gender, full_name AS"
    f" full_name_masked, hire_date, {oracle.email('work_email')} AS work_email_masked,"
    f" {oracle.email('personal_email')} AS personal_email_masked, {oracle.last4('tax_id')} AS"
    f" tax_id_last4, {oracle.token('work_email')} AS work_email_token, {oracle.token('tax_id')} AS"
    " tax_id_token"
)


@query(
    oracle.with_(_IDENT)
    + "SELECT row_number() OVER (ORDER BY employee_id) AS employee_static_sk, employee_id,"
    f" {_CORE} FROM ident"
)
def masked_static_dim(spark, sf_dir):
    return hr.static_dimension(_base(spark, sf_dir))


_FULL = (
    f"{oracle.birth_year('date_of_birth', True)} AS birth_year_masked, gender,"
    f" {oracle.name('full_name')} AS full_name_masked, hire_date, 'org_' || CAST(employee_id % 5 AS"
    " VARCHAR) AS org_unit_at_hire, CASE WHEN employee_id % 4 > 0 THEN 'role_' ||"
    " CAST(employee_id % 4 AS VARCHAR) ELSE '' END AS role_family_at_hire, home_address_city AS"
    f" location_at_hire, {oracle.email('work_email', True)} AS work_email_masked,"
    f" {oracle.email('personal_email', True)} AS personal_email_masked,"
    f" {oracle.phone('phone_number')} AS phone_masked, home_address_city, home_address_state,"
    f" {oracle.postal('home_address_postal_code')} AS home_address_postal_masked,"
    f" {oracle.last4('tax_id', True)} AS tax_id_last4, {oracle.token('work_email')} AS"
    f" work_email_token, {oracle.token('phone_number')} AS phone_token, {oracle.token('tax_id')} AS"
    " tax_id_token"
)


@query(
    oracle.with_(_IDENT)
    + "SELECT row_number() OVER (ORDER BY employee_id) AS employee_static_sk, employee_id,"
    f" {_FULL} FROM ident"
)
def masked_static_dim_full(spark, sf_dir):
    return hr.static_dimension(_base(spark, sf_dir), policy="full")


@query(
    "WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text,"
    " '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+')) AS address FROM documents) SELECT doc_id,"
    f" {oracle.email('address')} AS email_masked, {oracle.email('address', True)} AS"
    f" email_masked_strict, {oracle.token('address')} AS email_token FROM m"
)
def email_masks(spark, sf_dir):
    found = F.regexp_extract_all("text", F.lit("[A-Za-z0-9._-]+@[A-Za-z0-9.-]+"), F.lit(0))
    docs = inputs.read(spark, sf_dir, "documents")
    # Most texts hold no address, and searching one for the pattern costs far more than this.
    docs = docs.filter(F.contains("text", F.lit("@")))
    mails = docs.select("doc_id", F.explode(found).alias("address"))
    return mails.select(
        "doc_id",
        masking.mask_email("address").alias("email_masked"),
        masking.mask_email("address", strict=True).alias("email_masked_strict"),
        stable_token("address", configured_salt(spark)).alias("email_token"),
    )


@query(
    oracle.with_(_IDENT)
    + f"SELECT employee_id, hire_date, {oracle.birth_year('date_of_birth')} AS date_of_birth,"
    f" gender, {oracle.name('full_name')} AS full_name, {oracle.email('personal_email', True)} AS"
    f" personal_email, {oracle.email('work_email', True)} AS work_email,"
    f" {oracle.phone('phone_number')} AS phone_number, home_address_city, home_address_state,"
    f" {oracle.postal('home_address_postal_code')} AS home_address_postal_code,"
    f" {oracle.last4('tax_id', True)} AS tax_id FROM ident"
)
def governed_projection(spark, sf_dir):
    return governance.governed(IDENTITY.frame(spark, sf_dir), hr.POLICY)


_LEAK_PAIRS = (
    ("full_name_masked", "full_name"),
    ("personal_email_masked", "personal_email"),
    ("work_email_masked", "work_email"),
    ("tax_id_last4", "tax_id"),
    ("home_address_city", "home_address_city"),
)


@query(
    oracle.with_(_IDENT, f"pub AS (SELECT employee_id, {_CORE}, home_address_city FROM ident)")
    + " UNION ALL ".join(
        f"SELECT '{p}' AS published_column, '{r}' AS raw_column, count(DISTINCT {p}) AS"
        f" leaked_values FROM pub WHERE {p} <> '' AND {p} IN (SELECT {r} FROM ident)"
        for p, r in _LEAK_PAIRS
    )
)
def pii_leaks(spark, sf_dir):
    base = _base(spark, sf_dir)
    published = base.select(
        "home_address_city",
        F.col("full_name").alias("full_name_masked"),
        masking.mask_email("personal_email").alias("personal_email_masked"),
        masking.mask_email("work_email").alias("work_email_masked"),
        masking.last4("tax_id").alias("tax_id_last4"),
    )
    return governance.leaked_values(published, base, _LEAK_PAIRS)


# Integrity checks.

_NAMES = ("scd2", "static", "daily")
_DIM = oracle.versions("dim", "people", PEOPLE_SPEC)


def _report_sql(dim: str, static: str, daily: str) -> str:
    return (
        f"SELECT 'null_key' AS check_name, 'scd2' AS table_name, count(*) FILTER (WHERE employee_id"
        " IS NULL OR effective_start_date IS NULL OR effective_end_date IS NULL) AS failures FROM"
        f" {dim} UNION ALL SELECT 'overlap', 'scd2', count(*) FILTER (WHERE effective_end_date >="
        " nxt) FROM seq UNION ALL SELECT 'continuity', 'scd2', count(*) FILTER (WHERE"
        " effective_end_date + 1 <> nxt) FROM seq UNION ALL SELECT 'single_current', 'scd2',"
        " count(*) FILTER (WHERE c <> 1) FROM (SELECT count(*) FILTER (WHERE is_current) AS c FROM"
        f" {dim} WHERE employee_id IS NOT NULL GROUP BY employee_id) UNION ALL SELECT"
        f" 'static_null_key', 'static', count(*) FILTER (WHERE employee_id IS NULL) FROM {static}"
        " UNION ALL SELECT 'daily_null_key', 'daily', count(*) FILTER (WHERE employee_id IS NULL OR"
        f" snapshot_date IS NULL) FROM {daily} UNION ALL SELECT 'non_empty', 'scd2', CASE WHEN"
        f" count(*) = 0 THEN 1 ELSE 0 END FROM {dim} UNION ALL SELECT 'non_empty', 'static', CASE"
        f" WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {static} UNION ALL SELECT 'non_empty', 'daily',"
        f" CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {daily}"
    )


def _seq(dim: str) -> str:
    return (
        "seq AS (SELECT *, lead(effective_start_date) OVER (PARTITION BY employee_id ORDER BY"
        f" effective_start_date) AS nxt FROM {dim} WHERE employee_id IS NOT NULL AND"
        " effective_start_date IS NOT NULL AND effective_end_date IS NOT NULL)"
    )


def _stored(spark, sf_dir):
    """The checked tables as a job finds them: written."""
    dim = materialize(history.people_versions(spark, sf_dir), "dimension")
    return dim, materialize(history.people_fact(spark, sf_dir), "fact")


@query(
    oracle.with_(history.PEOPLE_SNAP, _DIM, _IDENT, _seq("dim"))
    + _report_sql("dim", "ident", "people")
)
def quality_report(spark, sf_dir):
    dim, fact = _stored(spark, sf_dir)
    identity = IDENTITY.frame(spark, sf_dir)
    return quality.star_report(dim, identity, fact, "employee_id", "snapshot_date", _NAMES)


# Every kind of damage, spread over the whole dimension by employee.
_BROKEN = {
    "employee_id": "CASE WHEN employee_id % 101 = 1 THEN NULL ELSE employee_id END",
    "effective_start_date": "CASE WHEN employee_id % 101 = 2 AND is_current THEN NULL"
    " ELSE effective_start_date END",
    "effective_end_date": "CASE WHEN employee_id % 101 = 3 AND is_current THEN NULL"
    " WHEN employee_id % 101 = 4 AND NOT is_current THEN effective_end_date + 1"
    " WHEN employee_id % 101 = 5 AND NOT is_current THEN effective_end_date - 1"
    " ELSE effective_end_date END",
    "is_current": "CASE WHEN employee_id % 101 = 6 THEN false WHEN employee_id % 101 = 7 THEN true"
    " ELSE is_current END",
}
_BROKEN_LIST = ", ".join(f"{e} AS {n}" for n, e in _BROKEN.items())
_GAPPY = {
    "employee_id": "CASE WHEN employee_id % 103 = 1 THEN NULL ELSE employee_id END",
    "snapshot_date": "CASE WHEN employee_id % 103 = 2 THEN NULL ELSE snapshot_date END",
}
_GAPPY_LIST = ", ".join(f"{e} AS {n}" for n, e in _GAPPY.items())


@query(
    oracle.with_(
        history.PEOPLE_SNAP,
        _DIM,
        _IDENT,
        f"broken AS (SELECT {_BROKEN_LIST} FROM dim)",
        f"gappy AS (SELECT {_GAPPY_LIST} FROM people)",
        f"nameless AS (SELECT {_GAPPY['employee_id']} AS employee_id FROM ident)",
        _seq("broken"),
    )
    + _report_sql("broken", "nameless", "gappy")
)
def quality_report_broken(spark, sf_dir):
    def damaged(df, columns):
        return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])

    dim, fact = _stored(spark, sf_dir)
    nameless = damaged(
        IDENTITY.frame(spark, sf_dir), {"employee_id": _GAPPY["employee_id"]}
    )
    dim, fact = damaged(dim, _BROKEN), damaged(fact, _GAPPY)
    return quality.star_report(dim, nameless, fact, "employee_id", "snapshot_date", _NAMES)


@query(
    oracle.with_(history.PEOPLE_SNAP, _DIM)
    + "SELECT count(*) AS versions, count(*) AS distinct_keys FROM dim"
)
def hashed_keys(spark, sf_dir):
    dim = history.people_versions(spark, sf_dir)
    keyed = keys.hashed_keys(dim, ["employee_id", "effective_start_date"], "employee_sk")
    return keyed.agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct("employee_sk").alias("distinct_keys")
    )
