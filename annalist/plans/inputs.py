"""The driver's tables seen as snapshot feeds.

Each feed is a projection of whole tables, written in expressions that mean the same in
Spark SQL and in other SQL engines, so that one text serves the queries and their oracles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.spec import EntitySpec


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@dataclass(frozen=True)
class Feed:
    table: str
    columns: dict[str, str]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        exprs = [f"{e} AS {n}" for n, e in self.columns.items()]
        return read(spark, sf_dir, self.table).selectExpr(*exprs)

    def sql(self) -> str:
        exprs = ", ".join(f"{e} AS {n}" for n, e in self.columns.items())
        return f"SELECT {exprs} FROM {self.table}"


ORDERS = Feed(
    "orders",
    {
        "custkey": "o_custkey",
        "day": "CAST(o_orderdate AS DATE)",
        "orderkey": "o_orderkey",
        "status": "o_orderstatus",
        "priority": "o_orderpriority",
        "priority_or_null": "nullif(o_orderpriority, '5-LOW')",
        "even_status": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END",
        "odd_status": "CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END",
    },
)
ORDERS_SPEC = EntitySpec("custkey", "day", ("status",), ("orderkey",))

EVENTS = Feed(
    "events",
    {
        "user_id": "user_id",
        "day": "CAST(ts AS DATE)",
        "ts": "ts",
        "event_id": "event_id",
        "event_type": "event_type",
    },
)
EVENTS_SPEC = EntitySpec("user_id", "day", ("event_type",), ("-ts", "-event_id"))

# Orders read as the daily state of a workforce: the customer is the employee.
PEOPLE_STATE = {
    "status": "CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'on_leave'"
    " ELSE 'terminated' END",
    "manager_id": "CASE WHEN o_custkey = 0 THEN 5 ELSE CAST(floor((o_custkey"
    " + CAST(substr(o_orderpriority, 1, 1) AS BIGINT)) / 8.0) AS BIGINT) END",
    "team": "'team_' || CAST(o_orderkey % 15 AS STRING)",
    "salary_band": "'B' || substr(o_orderpriority, 1, 1)",
    "fte_flag": "CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END",
    "work_mode": "CASE WHEN o_totalprice < 150000 THEN 'onsite'"
    " WHEN o_totalprice < 350000 THEN 'hybrid' ELSE 'remote' END",
    "org_unit": "'org_' || CAST(o_orderkey % 5 AS STRING)",
    "role_family": "'org_' || CAST(o_orderkey % 5 AS STRING) || '_'"
    " || CAST(o_orderkey % 4 AS STRING)",
    "location": "'city_' || CAST(o_orderkey % 3 AS STRING)",
}
PEOPLE = Feed(
    "orders",
    {
        "employee_id": "o_custkey",
        "snapshot_date": "CAST(o_orderdate AS DATE)",
        "source_row": "o_orderkey",
        **PEOPLE_STATE,
    },
)
PEOPLE_SPEC = EntitySpec("employee_id", "snapshot_date", tuple(PEOPLE_STATE), ("source_row",))

# Customers read as identities, with every malformed value a mask has to face.
IDENTITY = Feed(
    "customer",
    {
        "employee_id": "c_custkey",
        "hire_date": "DATE '2015-01-01' + CAST(c_custkey % 3000 AS INT)",
        "date_of_birth": "CASE WHEN c_custkey % 11 > 0"
        " THEN DATE '1960-01-01' + CAST(c_custkey % 15000 AS INT) END",
        "gender": "CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'X' END",
        "full_name": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN 'Cher'"
        " ELSE ' taylor  ' || c_mktsegment || ' ' || c_name END",
        "personal_email": "CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'nodom'"
        " WHEN 3 THEN 'a@b' WHEN 4 THEN 'ab@c' WHEN 5 THEN 'a@b@c' WHEN 6 THEN '..@c'"
        " ELSE lower(c_mktsegment) || '.' || CAST(c_custkey AS STRING) || '@mail.example' END",
        "work_email": "lower(c_mktsegment) || CAST(c_nationkey AS STRING) || '@company.example'",
        "phone_number": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '123'"
        " WHEN 2 THEN '(020) 7946 ' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')"
        " ELSE '+1-415-555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END",
        "home_address_line1": "CAST(c_custkey % 900 AS STRING) || ' ' || c_mktsegment || ' St'",
        "home_address_city": "'city_' || CAST(c_nationkey % 5 AS STRING)",
        "home_address_state": "'S' || CAST(c_nationkey % 5 AS STRING)",
        "home_address_postal_code": "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'SW1 2'"
        " WHEN 2 THEN '7' WHEN 3 THEN 'AB' WHEN 4 THEN 'LG85'"
        " ELSE lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') END",
        "tax_id": "CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '12'"
        " ELSE lpad(CAST((c_custkey * 7919) % 1000000000 AS STRING), 9, '0') END",
    },
)

# Orders as text the way a raw extract delivers them, bad dates, flags and keys included.
RAW_TEXT = Feed(
    "orders",
    {
        "entity": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
        "day": "CASE WHEN o_orderkey % 50 = 0 THEN 'not a date' WHEN o_orderkey % 77 = 0 THEN NULL"
        " ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
        "flag": "CASE o_orderkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN '1.0' WHEN 2 THEN '0' WHEN 3"
        " THEN NULL ELSE '1' END",
        "row_id": "o_orderkey",
    },
)
RAW_TEXT_SPEC = EntitySpec("entity", "day", ("flag",), ("row_id",))

# Customers in reporting lines that form cycles everywhere.
CYCLIC_EDGES_SQL = (
    "SELECT c_custkey AS employee_id, (c_custkey * 7 + 3) % (SELECT count(*) FROM customer)"
    " AS manager_id FROM customer"
)


def cyclic_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select("c_custkey")
    people = customer.agg(F.count(F.lit(1))).scalar()
    return customer.select(
        F.col("c_custkey").alias("employee_id"),
        F.pmod(F.col("c_custkey") * 7 + 3, people).alias("manager_id"),
    )
