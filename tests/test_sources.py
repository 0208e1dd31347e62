import pytest

from annalist import hr
from annalist.plans import jobs
from annalist.sources import readers, tables

COLUMNS = ("employee_id", "note", "code")


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_is_text_and_empty_is_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'employee_id,note,code\r\nE1,"x""y",008695125\r\nE2,,7\r\n')
    rows = readers.read_raw(spark, path, COLUMNS, "csv").collect()
    assert [tuple(r) for r in rows] == [("E1", 'x"y', "008695125"), ("E2", None, "7")]


def test_line_break_in_quotes_needs_multiline(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'employee_id,note,code\nE1,"p\nq",1\n')
    assert readers.read_csv(spark, path).count() == 2
    assert [r.note for r in readers.read_csv(spark, path, multiline=True).collect()] == ["p\nq"]


def test_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "a.csv", "\ufeffemployee_id,note,code\nE1,x,1\n")
    assert readers.read_raw(spark, path, COLUMNS, "csv").count() == 1
    df = spark.createDataFrame([("E1",)], "`\ufeffany` string")
    assert readers.strip_bom(df).columns == ["any"]


def test_missing_columns_are_named(spark, tmp_path):
    path = write(tmp_path / "a.csv", "employee_id,note\nE1,x\n")
    with pytest.raises(readers.ContractError, match="code"):
        readers.read_raw(spark, path, COLUMNS, "csv")


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="source_format"):
        readers.read_raw(spark, "/nowhere", COLUMNS, "xls")


def test_auto_lists_attempts(spark, tmp_path):
    with pytest.raises(readers.ContractError, match="csv .*nothing.*csv .*nothing/.*.csv"):
        readers.read_raw(spark, str(tmp_path / "nothing"), COLUMNS)


def test_auto_reads_parquet_and_folders_of_csv(spark, tmp_path):
    df = spark.createDataFrame([("E1", "x", "1")], "employee_id string, note string, code string")
    df.write.parquet(str(tmp_path / "p"))
    (tmp_path / "c").mkdir()
    write(tmp_path / "c" / "1.csv", "employee_id,note,code\nE1,x,1\n")
    for folder in ("p", "c"):
        got = readers.read_raw(spark, str(tmp_path / folder), COLUMNS).collect()
        assert [tuple(r) for r in got] == [("E1", "x", "1")]


def test_headers_in_another_order_and_more_columns(spark, tmp_path):
    write(tmp_path / "1.csv", "employee_id,note,code\nE1,a,1\n")
    write(tmp_path / "2.csv", "code,employee_id,more,note\n2,E2,m,b\n")
    write(tmp_path / "_hidden.csv", "other\nx\n")
    write(tmp_path / "empty.csv", "")
    df = readers.read_raw(spark, str(tmp_path), COLUMNS, source_column="source_file")
    got = {r.employee_id: (r.note, r.code, r.more, r.source_file[-5:]) for r in df.collect()}
    assert got == {"E1": ("a", "1", None, "1.csv"), "E2": ("b", "2", "m", "2.csv")}


def test_every_file_must_fulfil_the_contract(spark, tmp_path):
    write(tmp_path / "1.csv", "employee_id,note,code\nE1,a,1\n")
    write(tmp_path / "2.csv", "employee_id,note\nE2,b\n")
    with pytest.raises(readers.ContractError, match="code.*2.csv"):
        readers.read_raw(spark, str(tmp_path), COLUMNS)


def test_files_of_several_formats_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("E1", "x", "1")], "employee_id string, note string, code string")
    df.write.parquet(str(tmp_path / "p"))
    write(tmp_path / "p" / "z.csv", "employee_id,note,code\nE1,x,1\n")
    with pytest.raises(readers.ContractError, match="several formats"):
        readers.read_raw(spark, str(tmp_path / "p"), COLUMNS)


def test_csv_export_keeps_order_and_blanks(spark, tmp_path):
    df = spark.createDataFrame([("b", " x ", True), ("a", 'q"', False)], "k string, v string, f boolean")
    tables.write_csv(df, str(tmp_path / "out"), ["v", "f", "k"], order=["k"])
    back = readers.read_csv(spark, str(tmp_path / "out"))
    assert back.columns == ["v", "f", "k"]
    assert sorted(map(tuple, back.collect())) == [(" x ", "true", "b"), ('q"', "false", "a")]


def extract(spark, folder, days):
    """A small extract: two employees, one of whom moves on day 3."""
    rows = []
    for day in days:
        for who in ("E1", "E2"):
            row = dict.fromkeys(hr.RAW_COLUMNS, "v") | {
                "employee_id": who,
                "snapshot_date": f"2024-01-{day:02d}",
                "hire_date": "2020-01-01",
                "date_of_birth": "1980-02-03",
                "fte_flag": "1",
                "status": "active",
                "team": "new" if who == "E2" and day >= 3 else "old",
                "work_email": "taylor.smith@company.example",
            }
            rows.append(tuple(row[c] for c in hr.RAW_COLUMNS) + ("more",))
    df = spark.createDataFrame(rows, readers.text_schema([*hr.RAW_COLUMNS, "extra"]))
    tables.write_csv(df, folder, [*hr.RAW_COLUMNS, "extra"])
    return folder


def layout(tmp_path, prefix):
    return jobs.Layout(location=str(tmp_path / "tables"), prefix=prefix, buckets=2)


def test_run_all_then_append_and_replay(spark, tmp_path):
    lay = layout(tmp_path, "t1_")
    counts = jobs.run_all(spark, extract(spark, str(tmp_path / "x1"), [1, 2]), lay)
    assert counts["bronze"] == 4 and counts["gold_scd2"] == 2 and counts["gold_daily"] == 4
    second = extract(spark, str(tmp_path / "x2"), [2, 3])
    counts = jobs.run_all(spark, second, lay, write_mode="append")
    # Day 2 arrived twice and counts once.
    assert counts["silver_snapshot"] == 6 and counts["gold_scd2"] == 3
    events = lay.read(spark, "silver_events")
    assert events.filter("prev_team = 'old' AND team = 'new'").count() == 1
    assert "extra" in lay.read(spark, "silver_snapshot").columns
    assert "t1_gold_dim_employee_scd2" in tables.list_tables(spark)


def test_bucketed_snapshot_needs_no_shuffle_for_events(spark, tmp_path):
    lay = layout(tmp_path, "t2_")
    jobs.bronze_job(spark, extract(spark, str(tmp_path / "x"), [1, 2, 3]), lay)
    jobs.silver_job(spark, lay)
    events = hr.silver_events(lay.read(spark, "silver_snapshot"))
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_register_mode(spark, tmp_path):
    lay = layout(tmp_path, "t3_")
    source = extract(spark, str(tmp_path / "x"), [1, 2])
    counts = jobs.run_all(spark, source, lay, mode="register")
    assert "bronze" not in counts and counts["silver_snapshot"] == 4
    with pytest.raises(ValueError, match="mode"):
        jobs.bronze_job(spark, source, lay, mode="link")


def test_gate_stops_a_broken_dimension(spark, tmp_path):
    lay = layout(tmp_path, "t4_")
    jobs.run_all(spark, extract(spark, str(tmp_path / "x"), [1, 2, 3]), lay)
    broken = lay.read(spark, "gold_scd2").selectExpr("* EXCEPT (is_current)", "false AS is_current")
    tables.write_table(broken, "t4_broken", location=lay.location)
    with pytest.raises(AssertionError, match="single_current"):
        jobs.check_job(spark, jobs.Layout(**{**vars(lay), "gold_scd2": "broken"}))
