import datetime as dt

import pytest
from pyspark.sql import functions as F

from annalist import hr
from annalist.functions import masking
from annalist.functions.fingerprint import stable_token
from annalist.operators import governance

EMAILS = [
    ("taylor.smith@company.example", "t***h@company.example", "t***h@company.example"),
    ("a@b", "a***a@b", "a***@b"),
    ("ab@c", "a***b@c", "a***@c"),
    ("..@c", "***@c", "***@c"),
    ("a@b@c", "a***a@b", "a***@b@c"),
    (None, "REDACTED_EMAIL", "REDACTED_EMAIL"),
    ("  ", "REDACTED_EMAIL", "REDACTED_EMAIL"),
    ("nodom", None, "REDACTED_EMAIL"),
]


def applied(spark, values, column):
    """``column`` over the values, in their order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_email(spark):
    values = [e[0] for e in EMAILS]
    assert applied(spark, values, masking.mask_email("x")) == [e[1] for e in EMAILS]
    assert applied(spark, values, masking.mask_email("x", strict=True)) == [e[2] for e in EMAILS]


def test_phone(spark):
    values = ["+1-415-555-1234", "123", None, "020 7946 0018"]
    shown = ["+******-1234", "REDACTED_PHONE", "REDACTED_PHONE", "******-0018"]
    assert applied(spark, values, masking.mask_phone("x")) == shown


def test_postal(spark):
    values = ["LG85", "SW1 2", "7", "", None, "AB"]
    shown = ["***G85", "***W12", "***7", "REDACTED_POSTAL", "REDACTED_POSTAL", "***B"]
    assert applied(spark, values, masking.mask_postal("x")) == shown


def test_name(spark):
    values = ["Taylor Smith", "Cher", "", "  \t", None, " ada  b lovelace\n"]
    redacted = "REDACTED_NAME"
    shown = ["T*** S.", "C*** C.", redacted, redacted, redacted, "A*** L."]
    assert applied(spark, values, masking.mask_name("x")) == shown


def test_last4(spark):
    values = ["008695125", "12", None, ""]
    assert applied(spark, values, masking.last4("x")) == ["5125", "12", "", ""]
    assert applied(spark, values, masking.last4("x", strict=True)) == ["5125", "", "", ""]


def test_birth_year(spark):
    day = F.try_to_date("x")
    assert applied(spark, ["1980-02-03", None], masking.birth_year(day)) == ["1980", None]
    strict = masking.birth_year(F.col("x"), strict=True)
    assert applied(spark, ["1980-02-03", None], strict) == ["1980", "REDACTED_BIRTHYEAR"]


def test_token_of_missing_is_token_of_empty(spark):
    a, b, c = applied(spark, [None, "", "x"], stable_token("x", "salt"))
    assert a == b != c and len(a) == 64


def person(spark, **changes):
    row = {c: c for c in hr.BASE_COLUMNS} | {
        "hire_date": dt.date(2020, 1, 1),
        "date_of_birth": dt.date(1980, 2, 3),
        "work_email": "taylor.smith@company.example",
        "tax_id": "008695125",
    }
    row |= changes
    schema = ", ".join(
        f"{c} {'date' if c in hr.DATE_COLUMNS else 'string'}" for c in hr.BASE_COLUMNS
    )
    return spark.createDataFrame([tuple(row[c] for c in hr.BASE_COLUMNS)], schema)


def test_static_dimension_columns(spark):
    core, full = hr.static_dimension(person(spark)), hr.static_dimension(person(spark), "full")
    assert core.columns == [
        "employee_static_sk", "employee_id", "birth_year_masked", "gender", "full_name_masked",
        "hire_date", "work_email_masked", "personal_email_masked", "tax_id_last4",
        "work_email_token", "tax_id_token",
    ]
    assert len(full.columns) == 19
    row = core.collect()[0]
    assert (row.full_name_masked, row.tax_id_last4) == ("full_name", "5125")
    assert full.collect()[0].full_name_masked == "F*** F."


def test_policy_covers_previous_values(spark):
    df = spark.createDataFrame([("+65-61234567", "+65-69999999")], "phone_number string, prev_phone_number string")
    row = governance.governed(df, hr.POLICY).collect()[0]
    assert (row.phone_number, row.prev_phone_number) == ("+******-4567", "+******-9999")


def test_policy_drops_and_refuses(spark):
    published = governance.governed(person(spark), hr.POLICY)
    assert "home_address_line1" not in published.columns
    assert governance.raw_columns(person(spark), hr.POLICY) != []
    with pytest.raises(ValueError, match="unknown rules"):
        governance.governed(person(spark), {"tax_id": "scramble"})


def test_tokens_need_a_salt(spark):
    from annalist.functions.fingerprint import SALT_CONF, configured_salt

    before = spark.conf.get(SALT_CONF)
    spark.conf.unset(SALT_CONF)
    try:
        with pytest.raises(RuntimeError, match=SALT_CONF):
            configured_salt(spark)
    finally:
        spark.conf.set(SALT_CONF, before)
