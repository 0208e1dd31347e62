"""The HR configuration: daily employee snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.functions import masking
from annalist.functions.fingerprint import configured_salt, stable_token
from annalist.operators import conform, facts, versions
from annalist.operators.keys import dense_keys
from annalist.spec import EntitySpec

# Columns every raw extract must have, in the order in which it delivers them.
RAW_COLUMNS = (
    "employee_id", "snapshot_date", "status", "manager_id", "team", "salary_band", "fte_flag",
    "work_mode", "org_unit", "role_family", "location", "hire_date", "date_of_birth", "gender",
    "full_name", "personal_email", "work_email", "phone_number", "home_address_line1",
    "home_address_city", "home_address_state", "home_address_postal_code", "tax_id",
)

# Columns whose change starts a new version, in fingerprint order.
TRACKED = (
    "status", "manager_id", "team", "salary_band", "fte_flag", "work_mode", "org_unit",
    "role_family", "location", "phone_number", "home_address_line1", "home_address_city",
    "home_address_state", "home_address_postal_code",
)

# Columns of the first-seen base table.
BASE_COLUMNS = (
    "employee_id", "hire_date", "date_of_birth", "gender", "full_name", "personal_email",
    "work_email", "phone_number", "home_address_line1", "home_address_city",
    "home_address_state", "home_address_postal_code", "tax_id", "org_unit", "role_family",
    "location",
)

# Salary bands from lowest to highest.
BANDS = ("B1", "B2", "B3", "B4", "B5")

DATE_COLUMNS = ("snapshot_date", "hire_date", "date_of_birth")
INT_COLUMNS = ("fte_flag",)

SPEC = EntitySpec(
    key="employee_id",
    date="snapshot_date",
    tracked=TRACKED,
    tie_break=("-ingest_ts", *RAW_COLUMNS),
)

# What may be published of the columns that identify a person.
POLICY = {
    "full_name": "name",
    "date_of_birth": "birth_year",
    "personal_email": "email",
    "work_email": "email",
    "phone_number": "phone",
    "home_address_line1": "drop",
    "home_address_postal_code": "postal",
    "tax_id": "last4",
}


def silver_snapshot(raw: DataFrame) -> DataFrame:
    """Typed and deduplicated; extra columns pass through.

    The load time of Bronze is kept, since it decides between conflicting rows; the time of
    this step is in ``silver_ts``.
    """
    if "ingest_ts" not in raw.columns:
        raw = raw.withColumn("ingest_ts", F.current_timestamp())
    clean = conform.conform_snapshot(raw, SPEC, DATE_COLUMNS, INT_COLUMNS)
    return clean.withColumn("silver_ts", F.current_timestamp())


def silver_base(snapshot: DataFrame) -> DataFrame:
    return conform.first_seen(snapshot, SPEC, BASE_COLUMNS)


def silver_events(snapshot: DataFrame, spec: EntitySpec = SPEC) -> DataFrame:
    return versions.change_events(snapshot, spec)


def static_dimension(base: DataFrame, policy: str = "core", strict: bool = False) -> DataFrame:
    """One masked row per employee with a dense key.

    ``core``: eleven columns.  ``full``: nineteen columns with the first assignment and the
    masked contact data, all masks strict.
    """
    if policy not in {"core", "full"}:
        raise ValueError("policy must be one of: core, full")
    full = policy == "full"
    strict = strict or full
    salt = configured_salt(base.sparkSession)
    key = F.col("employee_id")
    name = masking.mask_name("full_name") if strict else F.col("full_name")

    def text(c: str):
        return F.coalesce(F.col(c), F.lit(""))

    columns = [
        key,
        masking.birth_year("date_of_birth", strict).alias("birth_year_masked"),
        F.col("gender"),
        name.alias("full_name_masked"),
        F.col("hire_date"),
    ]
    if full:
        columns += [
            text("org_unit").alias("org_unit_at_hire"),
            text("role_family").alias("role_family_at_hire"),
            text("location").alias("location_at_hire"),
        ]
    columns += [
        masking.mask_email("work_email", strict).alias("work_email_masked"),
        masking.mask_email("personal_email", strict).alias("personal_email_masked"),
    ]
    if full:
        columns += [
            masking.mask_phone("phone_number").alias("phone_masked"),
            text("home_address_city").alias("home_address_city"),
            text("home_address_state").alias("home_address_state"),
            masking.mask_postal("home_address_postal_code").alias("home_address_postal_masked"),
        ]
    columns += [
        masking.last4("tax_id", strict).alias("tax_id_last4"),
        stable_token("work_email", salt).alias("work_email_token"),
    ]
    if full:
        columns.append(stable_token("phone_number", salt).alias("phone_token"))
    columns.append(stable_token("tax_id", salt).alias("tax_id_token"))
    # Masks and tokens are built behind the shuffle: once, and by all its tasks, however few files were read.
    placed = base.repartitionByRange("employee_id").select(*columns)
    return dense_keys(placed, ["employee_id"], "employee_static_sk", ranged=True)


def scd2_dimension(
    snapshot: DataFrame, spec: EntitySpec = SPEC, with_last_seen: bool = False
) -> DataFrame:
    """Type-2 history with a dense key by employee and start."""
    return versions.keyed_versions(snapshot, spec, "employee_sk", with_last_seen)


def daily_fact(snapshot: DataFrame) -> DataFrame:
    # The attributes reports slice by.
    attributes = ["status", "org_unit", "team", "work_mode", "fte_flag", "salary_band"]
    return facts.daily_fact(snapshot, SPEC, attributes, "status", "active")


def reporting_fact(snapshot: DataFrame) -> DataFrame:
    return facts.reporting_fact(
        snapshot, SPEC, "manager_id", "manager_employee_id", ["org_unit", "team"]
    )


def change_fact(events: DataFrame) -> DataFrame:
    return facts.change_fact(events, SPEC)
