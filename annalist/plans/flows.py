"""Queries that run whole flows: text files in, tables out, streams of arriving files."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist import hr
from annalist.operators import asof, conform
from annalist.operators.quality import QualityError
from annalist.plans import inputs, jobs, oracle
from annalist.plans.inputs import EVENTS, EVENTS_SPEC, IDENTITY, PEOPLE, PEOPLE_STATE
from annalist.plans.registry import query
from annalist.sources import readers, tables
from annalist.sources.scratch import discard, scratch_path, scratch_tables, shuffles_removed
from annalist.streaming import ingest
from annalist.streaming.history import VersionedHistory, maintain_history

# The extract: every order as the daily state of an employee, beside the identity.
_STATE = {
    **PEOPLE.columns,
    "employee_id": "'E' || CAST(o_custkey AS STRING)",
    "manager_id": f"'E' || CAST({PEOPLE_STATE['manager_id']} AS STRING)",
}
_IDENTITY = {**IDENTITY.columns, "employee_id": "'E' || CAST(c_custkey AS STRING)"}
_IDENTITY_COLUMNS = [c for c in hr.RAW_COLUMNS if c in _IDENTITY and c != "employee_id"]
_STATE_COLUMNS = [c for c in hr.RAW_COLUMNS if c not in _IDENTITY_COLUMNS]

# The winner among rows of one day, all of the same load, is the first in column order.
_EXTRACT_SQL = (
    "extract AS (SELECT "
    + ", ".join(f"s.{c}" for c in _STATE_COLUMNS)
    + ", "
    + ", ".join(
        # An empty text in a CSV file reads as NULL.
        "nullif(i.personal_email, '') AS personal_email" if c == "personal_email" else f"i.{c}"
        for c in _IDENTITY_COLUMNS
    )
    + " FROM (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in _STATE.items())
    + " FROM orders) s JOIN (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in _IDENTITY.items())
    + " FROM customer) i USING (employee_id)),\n"
    "snap AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY employee_id,"
    " snapshot_date ORDER BY "
    + ", ".join(f"{c} NULLS LAST" for c in hr.RAW_COLUMNS)
    + ") AS rn FROM extract) WHERE rn = 1)"
)


def _extract(spark, sf_dir) -> DataFrame:
    orders, customer = (inputs.read(spark, sf_dir, t) for t in ("orders", "customer"))
    state = orders.selectExpr(*[f"{e} AS {n}" for n, e in _STATE.items()])
    identity = customer.selectExpr(*[f"{e} AS {n}" for n, e in _IDENTITY.items()])
    return asof.wide_extract(state, identity, "employee_id", _IDENTITY_COLUMNS, _STATE_COLUMNS)


def _extract_files(spark, sf_dir) -> str:
    folder = scratch_path(spark, "extract")
    tables.write_csv(_extract(spark, sf_dir), folder, hr.RAW_COLUMNS)
    return folder


def _layout(spark, buckets: int = 4) -> jobs.Layout:
    """Tables of one run, under names no other run uses."""
    prefix = scratch_tables(f"run_{uuid.uuid4().hex}_")
    return jobs.Layout(location=scratch_path(spark, "tables"), prefix=prefix, buckets=buckets)


def _landed(spark, sf_dir) -> jobs.Layout:
    layout = _layout(spark)
    jobs.run_all(spark, _extract_files(spark, sf_dir), layout)
    return layout


_TEXT_COLUMNS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in hr.RAW_COLUMNS)


_EXTRACT_ROWS = oracle.with_(_EXTRACT_SQL) + f"SELECT {_TEXT_COLUMNS} FROM extract"


@query(_EXTRACT_ROWS)
def csv_round_trip(spark, sf_dir):
    raw = readers.read_raw(spark, _extract_files(spark, sf_dir), hr.RAW_COLUMNS, "auto")
    return raw.select(*hr.RAW_COLUMNS)


@query(_EXTRACT_ROWS)
def csv_folder_glob(spark, sf_dir):
    files = f"{_extract_files(spark, sf_dir)}/*.csv"
    return readers.read_raw(spark, files, hr.RAW_COLUMNS, "csv").select(*hr.RAW_COLUMNS)


@query(_EXTRACT_ROWS)
def csv_bom(spark, sf_dir):
    """Every file begins with a byte order mark."""
    folder, first = scratch_path(spark, "extract"), hr.RAW_COLUMNS[0]
    marked = _extract(spark, sf_dir).withColumnRenamed(first, readers.BOM + first)
    tables.write_csv(marked, folder, [readers.BOM + first, *hr.RAW_COLUMNS[1:]])
    return readers.read_raw(spark, folder, hr.RAW_COLUMNS, "csv").select(*hr.RAW_COLUMNS)


@query(
    oracle.with_(_EXTRACT_SQL)
    + f"SELECT {_TEXT_COLUMNS}, CASE WHEN status = 'active' THEN 'more' END AS extra FROM extract"
)
def csv_mixed_headers(spark, sf_dir):
    """Files of one delivery whose headers differ in order and by an extra column."""
    root, rows = scratch_path(spark, "extract"), _extract(spark, sf_dir)
    active = rows.where("status = 'active'").withColumn("extra", F.lit("more"))
    tables.write_csv(active, f"{root}/a", [*hr.RAW_COLUMNS[::-1], "extra"])
    tables.write_csv(rows.where("status <> 'active'"), f"{root}/b", hr.RAW_COLUMNS)
    return readers.read_raw(spark, f"{root}/*", hr.RAW_COLUMNS, "csv").select(*hr.RAW_COLUMNS, "extra")


def _extract_text(spark, sf_dir) -> DataFrame:
    """The extract as text with empty values missing, as CSV delivers it."""
    return _extract(spark, sf_dir).selectExpr(
        *[f"nullif(CAST({c} AS STRING), '') AS {c}" for c in hr.RAW_COLUMNS]
    )


@query(_EXTRACT_ROWS)
def parquet_scan(spark, sf_dir):
    folder = scratch_path(spark, "extract")
    _extract_text(spark, sf_dir).write.parquet(folder)
    return readers.read_raw(spark, folder, hr.RAW_COLUMNS).select(*hr.RAW_COLUMNS)


@query(_EXTRACT_ROWS)
def append_sink(spark, sf_dir):
    """Two deliveries appended to one Bronze table."""
    layout, rows = _layout(spark), _extract_text(spark, sf_dir)
    for part in ("status = 'active'", "status <> 'active'"):
        layout.write(rows.where(part), "bronze", mode="append")
    return layout.read(spark, "bronze")


@query(_EXTRACT_ROWS)
def bronze_register(spark, sf_dir):
    layout = _layout(spark)
    jobs.bronze_job(spark, _extract_files(spark, sf_dir), layout, mode="register")
    return layout.read(spark, "bronze").select(*hr.RAW_COLUMNS)


@query(
    oracle.with_(_EXTRACT_SQL)
    + "SELECT employee_id, count(*) AS bronze_rows, count(DISTINCT snapshot_date) AS silver_rows,"
    " true AS from_files, true AS stamped FROM extract GROUP BY employee_id"
)
def load_stamps(spark, sf_dir):
    """Load columns of Bronze, and the time of the Silver step beside the kept time of the load."""
    folder, layout = _extract_files(spark, sf_dir), _layout(spark)
    jobs.bronze_job(spark, folder, layout)
    bronze = layout.read(spark, "bronze")
    here = F.contains("source_file", F.lit(folder.rsplit("/", 1)[-1]))
    loaded = bronze.groupBy("employee_id").agg(F.count("ingest_ts").alias("bronze_rows"), F.every(here).alias("from_files"))
    silver = hr.silver_snapshot(bronze).groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("silver_rows"), F.every(F.col("silver_ts") >= F.col("ingest_ts")).alias("stamped")
    )
    return loaded.join(silver, "employee_id").select("employee_id", "bronze_rows", "silver_rows", "from_files", "stamped")


_SPEC = hr.SPEC
_VERSIONS = oracle.versions("dim", "snap", _SPEC)
_VERSION_LIST = oracle.version_columns(_SPEC)


@query(
    oracle.with_(_EXTRACT_SQL, _VERSIONS)
    + "SELECT row_number() OVER (ORDER BY employee_id, effective_start_date) AS employee_sk,"
    f" {_VERSION_LIST} FROM dim"
)
def end_to_end_scd2(spark, sf_dir):
    return _landed(spark, sf_dir).read(spark, "gold_scd2")


def _days(extract: DataFrame) -> tuple:
    """The first and the last day; shuffle files of the look go with it."""
    with shuffles_removed(extract.sparkSession):
        return tuple(extract.agg(F.min("snapshot_date"), F.max("snapshot_date")).first())


def _delivered(spark, sf_dir, documented: bool = False) -> jobs.Layout:
    """Three deliveries: the newer half, then the older days, then a part of the first again."""
    layout = replace(_layout(spark, buckets=8), daily=True, documented=documented)
    extract = _extract(spark, sf_dir)
    first, last = _days(extract)
    middle, late = first + (last - first) / 2, first + (last - first) * 3 / 4
    parts = [F.col("snapshot_date") > middle, F.col("snapshot_date") <= middle, F.col("snapshot_date") > late]
    for part in parts:
        folder = scratch_path(spark, "delivery")
        tables.write_csv(extract.where(part), folder, hr.RAW_COLUMNS)
        jobs.run_day(spark, folder, layout, landed=partial(discard, spark, folder))
    return layout


@query(
    oracle.with_(_EXTRACT_SQL, oracle.versions("dim", "snap", _SPEC))
    + f"SELECT {oracle.version_columns(_SPEC, last_seen=True)} FROM dim"
)
def end_to_end_daily(spark, sf_dir):
    """Deliveries taken in one by one give the versions of a full build."""
    return _delivered(spark, sf_dir).read(spark, "gold_scd2").drop("employee_sk")


@query(
    oracle.with_(_EXTRACT_SQL, oracle.versions("dim", "snap", _SPEC))
    + "SELECT s.snapshot_date, s.employee_id, s.status, d.effective_start_date, 1 AS keys FROM snap s LEFT JOIN dim d"
    " ON s.employee_id = d.employee_id AND s.snapshot_date BETWEEN d.effective_start_date AND d.effective_end_date"
)
def end_to_end_daily_documented(spark, sf_dir):
    """Deliveries taken in one by one, published as documented: each daily fact has the key of the version valid on its day."""
    layout = _delivered(spark, sf_dir, documented=True)
    dim = layout.read(spark, "gold_scd2")
    if {"home_address_line1", "last_seen_date"} & set(dim.columns):
        raise AssertionError("a column is published that should not be")
    keys = dim.groupBy("employee_sk").agg(F.count(F.lit(1)).cast("int").alias("keys"), F.max("effective_start_date").alias("effective_start_date"))
    return layout.read(spark, "gold_daily").join(keys, "employee_sk", "left").select("snapshot_date", "employee_id", "status", "effective_start_date", "keys")


@query(
    oracle.with_(
        _EXTRACT_SQL,
        "half AS (SELECT min(snapshot_date) + CAST((max(snapshot_date) - min(snapshot_date)) / 2 AS INT) AS middle FROM snap)",
        "old AS (SELECT * FROM snap WHERE snapshot_date <= (SELECT middle FROM half))",
        oracle.versions("dim", "old", _SPEC),
    )
    + f"SELECT {oracle.version_columns(_SPEC, last_seen=True)} FROM dim"
)
def gold_after_refusal(spark, sf_dir):
    """The dimension after a good delivery and one that is refused, since its rows have no readable date."""
    layout = replace(_layout(spark, buckets=8), daily=True)
    extract = _extract(spark, sf_dir)
    first, last = _days(extract)
    old = F.col("snapshot_date") <= first + (last - first) / 2
    for rows, readable in ((extract.where(old), True), (extract.where(~old).withColumn("snapshot_date", F.lit("soon")), False)):
        folder = scratch_path(spark, "delivery")
        tables.write_csv(rows, folder, hr.RAW_COLUMNS)
        try:
            jobs.run_day(spark, folder, layout, landed=partial(discard, spark, folder))
        except QualityError:
            if readable:
                raise
    return layout.read(spark, "gold_scd2").drop("employee_sk")


@query(
    oracle.with_(_EXTRACT_SQL, oracle.events("ev", "snap", _SPEC))
    + "SELECT 'snapshot' AS kind, snapshot_date AS day, count(*) AS n FROM snap GROUP BY 2 UNION ALL"
    " SELECT 'daily', snapshot_date, count(*) FROM snap GROUP BY 2 UNION ALL"
    " SELECT 'change', event_date, count(*) FROM ev GROUP BY 2"
)
def end_to_end_daily_counts(spark, sf_dir):
    """Rows per day after deliveries taken in one by one."""
    layout = _delivered(spark, sf_dir)
    days = {"snapshot": ("silver_snapshot", "snapshot_date"), "daily": ("gold_daily", "snapshot_date"), "change": ("gold_changes", "event_date")}
    counts = [
        layout.read(spark, t).groupBy(F.col(d).alias("day")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "day", "n")
        for k, (t, d) in days.items()
    ]
    return reduce(DataFrame.unionByName, counts)


_KEYED_DIM = (
    "keyed AS (SELECT row_number() OVER (ORDER BY employee_id, effective_start_date) AS employee_sk, *"
    " FROM dim)"
)


def _published(spark, sf_dir) -> jobs.Layout:
    layout = replace(_layout(spark), documented=True)
    jobs.run_all(spark, _extract_files(spark, sf_dir), layout)
    return layout


@query(
    oracle.with_(_EXTRACT_SQL, _VERSIONS, _KEYED_DIM)
    + "SELECT s.snapshot_date, s.employee_id, s.status, k.employee_sk FROM snap s LEFT JOIN keyed k ON"
    " s.employee_id = k.employee_id AND s.snapshot_date BETWEEN k.effective_start_date AND"
    " k.effective_end_date"
)
def end_to_end_fact_sk(spark, sf_dir):
    """The daily fact as documented, with the key of the version valid on its day."""
    return _published(spark, sf_dir).read(spark, "gold_daily").select("snapshot_date", "employee_id", "status", "employee_sk")


@query(
    oracle.with_(_EXTRACT_SQL, _VERSIONS)
    + f"SELECT employee_id, effective_start_date, {oracle.phone('phone_number')} AS phone_number,"
    f" {oracle.postal('home_address_postal_code')} AS home_address_postal_code, home_address_city FROM dim"
)
def end_to_end_governed(spark, sf_dir):
    """The Type-2 dimension as documented, without raw personal data."""
    dim = _published(spark, sf_dir).read(spark, "gold_scd2")
    if "home_address_line1" in dim.columns:
        raise AssertionError("the street is published")
    return dim.select("employee_id", "effective_start_date", "phone_number", "home_address_postal_code", "home_address_city")


@query(
    oracle.with_(_EXTRACT_SQL, "b AS (SELECT min(snapshot_date) lo, max(snapshot_date) hi FROM snap)")
    + "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b"
)
def end_to_end_dim_date(spark, sf_dir):
    return _published(spark, sf_dir).read(spark, "gold_date").select("date")


@query(
    oracle.with_(_EXTRACT_SQL, oracle.events("ev", "snap", _SPEC))
    + f"SELECT {oracle.date_key('event_date')} AS date_key, event_date, employee_id, "
    + ", ".join(f"prev_{c}, {c}" for c in _SPEC.tracked)
    + " FROM ev"
)
def end_to_end_changes(spark, sf_dir):
    return _landed(spark, sf_dir).read(spark, "gold_changes")


@query(
    oracle.with_(
        _EXTRACT_SQL,
        "base AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY"
        " snapshot_date) AS rn FROM snap) WHERE rn = 1)",
        _VERSIONS,
        oracle.events("ev", "snap", _SPEC),
    )
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s}"
        for t, s in {
            "bronze": "extract",
            "silver_snapshot": "snap",
            "silver_base": "base",
            "silver_events": "ev",
            "gold_static": "base",
            "gold_scd2": "dim",
            "gold_daily": "snap",
            "gold_reporting": "snap",
            "gold_changes": "ev",
        }.items()
    )
)
def end_to_end_counts(spark, sf_dir):
    counts = jobs.run_all(spark, _extract_files(spark, sf_dir), _layout(spark))
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


# Streams.


def _arrivals(spark, sf_dir) -> str:
    """The events as arriving files: some by time, then a part delivered a second time."""
    folder = scratch_path(spark, "arrivals")
    events = EVENTS.frame(spark, sf_dir)
    events.repartitionByRange(4, "ts").write.parquet(folder)
    events.filter("event_id % 3 = 0").coalesce(1).write.mode("append").parquet(folder)
    return folder


_EVENTS_SNAP = oracle.snapshot("snap", EVENTS, EVENTS_SPEC)
_EVENTS_SCHEMA = "user_id bigint, day date, ts timestamp_ntz, event_id bigint, event_type string"


_EVENT_COLUMNS = ["user_id", "day", "event_id", "event_type"]
_EVENT_ROWS = oracle.with_(f"raw AS ({EVENTS.sql()})") + f"SELECT {', '.join(_EVENT_COLUMNS)} FROM raw"


def _ingested(spark, folder: str, files_per_batch: int) -> DataFrame:
    stream = ingest.arriving_files(
        spark, folder, _EVENTS_SCHEMA, "parquet", files_per_batch=files_per_batch
    )
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "checkpoint")
    ingest.ingest_fresh(stream, target, checkpoint, ["user_id", "day", "event_id"], "day").awaitTermination()
    return ingest.stored_rows(spark, target).select(*_EVENT_COLUMNS)


@query(_EVENT_ROWS)
def stream_drop_redelivered(spark, sf_dir):
    return _ingested(spark, _arrivals(spark, sf_dir), files_per_batch=2)


@query(_EVENT_ROWS)
def stream_drop_redelivered_late(spark, sf_dir):
    """Every delivery is older than all before it, and the first one comes again at the end."""
    folder = scratch_path(spark, "arrivals")
    events = EVENTS.frame(spark, sf_dir)
    first, last = events.agg(F.min("ts").cast("timestamp"), F.max("ts").cast("timestamp")).first()
    cuts = [last - (last - first) * i / 4 for i in range(5)]
    spans = [F.col("ts").cast("timestamp") > F.lit(c) for c in cuts[1:4]] + [F.lit(True)]
    for i, newer in enumerate([*spans, spans[0]]):
        part = events.where(newer & ~spans[i - 1]) if 0 < i < 4 else events.where(newer)
        part.coalesce(1).write.mode("append").parquet(folder)
    return _ingested(spark, folder, files_per_batch=1)


@query(oracle.with_(_EVENTS_SNAP) + "SELECT user_id, day, event_id, event_type FROM snap")
def stream_ingest_dedup(spark, sf_dir):
    stream = ingest.arriving_files(spark, _arrivals(spark, sf_dir), _EVENTS_SCHEMA, "parquet")
    target = scratch_path(spark, "ingested")
    ingest.ingest_available(stream, target, scratch_path(spark, "checkpoint")).awaitTermination()
    landed = spark.read.parquet(target)
    columns = ["user_id", "day", "event_id", "event_type"]
    return conform.conform_snapshot(landed, EVENTS_SPEC).select(*columns)


@query(
    oracle.with_(_EVENTS_SNAP, oracle.versions("dim", "snap", EVENTS_SPEC))
    + f"SELECT {oracle.version_columns(EVENTS_SPEC, last_seen=True)} FROM dim"
)
def stream_scd2(spark, sf_dir):
    store = VersionedHistory(spark, scratch_path(spark, "history"), EVENTS_SPEC)
    stream = ingest.arriving_files(
        spark, _arrivals(spark, sf_dir), _EVENTS_SCHEMA, "parquet", files_per_batch=2
    )
    run = maintain_history(stream, store, scratch_path(spark, "checkpoint"))
    run.awaitTermination()
    return store.dimension()


