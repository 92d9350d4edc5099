import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from conftest import AS_OF, one, plan_text

from roadrisk import schemas
from roadrisk.operators import files, fill, quality, sinks
from roadrisk.plans import staging


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def ids(spark, path):
    return sorted(r.id for r in sinks.read(spark, path).collect())


def test_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(numbers(spark, 1, 2), path)
    sinks.replace(numbers(spark, 3), path)
    assert ids(spark, path) == [3]


def test_refresh_is_skipped_on_the_same_day(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.refresh_once_a_day(numbers(spark, 1), path, AS_OF)
    assert not sinks.refresh_once_a_day(numbers(spark, 2), path, "2024-02-01 23:00:00")
    assert ids(spark, path) == [1]
    assert sinks.refresh_once_a_day(numbers(spark, 2), path, "2024-02-02 00:00:00")
    assert ids(spark, path) == [2]


def test_append_with_and_without_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(numbers(spark, 1, 2), path, new_by=["id"])
    sinks.append(numbers(spark, 2, 3), path, new_by=["id"])
    assert ids(spark, path) == [1, 2, 3]
    sinks.append(numbers(spark, 3), path)
    assert ids(spark, path) == [1, 2, 3, 3]


def test_appended_keys_are_unique_and_null_is_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ((1, 1, 2, None), (3, 3, 2, None, None)):
        sinks.append(numbers(spark, *batch), path, new_by=["id"])
    assert sorted(str(r.id) for r in spark.read.parquet(path).collect()) == ["1", "2", "3", "None"]


def test_a_damaged_table_is_not_a_missing_one(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "_temporary").mkdir()
    with pytest.raises(AnalysisException):
        sinks.append(numbers(spark, 1), str(path), new_by=["id"])
    with pytest.raises(AnalysisException):
        sinks.refresh_once_a_day(numbers(spark, 1), str(path), AS_OF)
    assert sinks.existing(spark, str(tmp_path / "none")) is None


def test_a_failed_replace_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(numbers(spark, 1, 2), path)
    with pytest.raises(Exception, match="stop"):
        sinks.replace(numbers(spark, 3).selectExpr("if(id = 3, raise_error('stop'), id) AS id"), path)
    assert ids(spark, path) == [1, 2]
    # Rows may come from the table itself.
    sinks.replace(sinks.read(spark, path).selectExpr("id + 10 AS id"), path)
    assert sorted(r.id for r in sinks.existing(spark, path).collect()) == [11, 12]
    sinks.replace(numbers(spark, 4), path)
    assert ids(spark, path) == [4]
    assert len(list((tmp_path / "t" / sinks.DATA).iterdir())) == sinks.KEPT_VERSIONS  # nothing is left of the failed one


def test_a_reader_sees_one_version_at_every_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert sinks.replace(numbers(spark, 1, 2), path) == 1
    pinned = sinks.read(spark, path)
    seen = []
    look = lambda: seen.append(ids(spark, path))
    for name in ("create", "drop"):
        real = getattr(files, name)

        def step(*args, real=real):
            look()
            out = real(*args)
            look()
            return out
        monkeypatch.setattr(files, name, step)
    sinks.replace(numbers(spark, 3), path)
    assert seen == [[1, 2], [3]]
    assert sorted(r.id for r in pinned.collect()) == [1, 2]  # opened before the replace
    sinks.replace(numbers(spark, 4), path)
    assert seen[2:] == [[3]] + [[4]] * 5
    assert sinks.versions(spark, path) == [2, 3]
    assert [r.id for r in sinks.read(spark, path, version=2).collect()] == [3]
    with pytest.raises(ValueError, match="no version 1"):
        sinks.read(spark, path, version=1)


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.replace(numbers(spark, 1), path)
    real = files.create

    def late(*args):  # another writer commits between the look at the log and the entry
        monkeypatch.setattr(files, "create", real)
        sinks.replace(numbers(spark, 2), path)
        return real(*args)
    monkeypatch.setattr(files, "create", late)
    with pytest.raises(sinks.TableChanged):
        sinks.replace(numbers(spark, 3), path)
    assert ids(spark, path) == [2]
    with pytest.raises(sinks.TableChanged):
        sinks.replace(numbers(spark, 4), path, based_on=1)
    assert ids(spark, path) == [2] and sinks.replace(numbers(spark, 5), path, based_on=2) == 3
    assert len(list((tmp_path / "t" / sinks.DATA).iterdir())) == sinks.KEPT_VERSIONS


def test_a_plain_table_is_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(numbers(spark, 1), path)
    sinks.append(numbers(spark, 2), path)
    assert ids(spark, path) == [1, 2] and sinks.versions(spark, path) == []
    sinks.replace(numbers(spark, 3), path)
    assert ids(spark, path) == [3] and sorted(f.name for f in (tmp_path / "t").iterdir()) == [sinks.DATA, sinks.LOG]
    sinks.append(numbers(spark, 3, 4), path, new_by=["id"])
    assert ids(spark, path) == [3, 4]


def test_the_kept_row_of_a_key_does_not_depend_on_the_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(k, t, f"n{t}", {"a": 1}) for k in (1, 2, None) for t in (5, 3, None, 4)],
                                 "id long, t long, name string, m map<string,int>")
    for i, parts in enumerate((1, 5)):
        for order, want in ((["t"], None), (["name"], 3)):
            path = str(tmp_path / f"{i}{order[0]}")
            sinks.append(rows.repartition(parts, "t"), path, ["id"], order)
            sinks.append(rows.where("t = 3"), path, ["id"], order)
            got = sinks.read(spark, path).collect()
            assert len(got) == 3 and {r.t for r in got} == {want} and got[0].m == {"a": 1}


def test_audit_keeps_present_values(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'feed'), (2, NULL) AS t(id, data_source)")
    audited = {r.id: r for r in sinks.with_audit(rows, AS_OF, "archive").collect()}
    assert [audited[i].data_source for i in (1, 2)] == ["feed", "archive"]
    assert audited[1].load_timestamp == dt.datetime(2024, 2, 1)


def test_view_and_table(spark):
    sinks.publish_view(numbers(spark, 1, 2), "some_view")
    assert spark.sql("SELECT sum(id) FROM some_view").first()[0] == 3
    for number in (4, 5):
        sinks.save_table(numbers(spark, number), "some_table")
    assert [r.id for r in spark.table("some_table").collect()] == [5]


def test_load_stats(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a', 2D), (5, 'a', 4D), (3, NULL, NULL) AS t(t, city, x)")
    assert one(sinks.load_stats(rows, "t", ("city",), ("x",))) == (3, 1, 5, 1, 3.0, 4.0, 2.0)


def test_nan_and_defaults(spark):
    rows = spark.sql("SELECT double('NaN') AS a, CAST(NULL AS double) AS b, CAST(NULL AS string) AS c, "
                     "CAST(NULL AS boolean) AS d, double('NaN') AS e")
    filled = fill.fill_defaults(fill.nan_as_null(rows), {"a": 70.0, "b": 1.5}, ("c",), ("d",))
    assert one(filled) == (70.0, 1.5, "", False, None)


def flow(rows_of, *records):
    base = dict(state="CA", city="X", timestamp="2024-01-31 10:00:00", current_speed=1.0, free_flow_speed=2.0)
    return staging.stage_flow(rows_of(schemas.TRAFFIC_FLOW_RAW, *[{**base, **r} for r in records]))


def test_declared_checks():
    kinds = [c.kind for c in quality.CHECKS]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("accepted_values")) == (5, 14, 3)


def test_report_shows_every_failure(rows_of):
    rows = flow(rows_of, {"flow_id": "a"}, {"flow_id": "a"}, {"flow_id": "b", "city": None},
                {"flow_id": "c", "free_flow_speed": 0.0, "current_speed": 0.0}, {"flow_id": None}, {"flow_id": None})
    report = quality.run_checks(rows, "stg_traffic_flow_realtime")
    assert plan_text(report).count("Exchange hashpartitioning") == 1
    found = {(r.column_name, r.check): r.failures for r in report.collect()}
    assert found == {("flow_id", "unique"): 1, ("flow_id", "not_null"): 2, ("city", "not_null"): 1,
                     ("timestamp", "not_null"): 0, ("congestion_level", "accepted_values"): 1}


def test_null_severity_passes_accepted_values(spark):
    rows = spark.sql("SELECT * FROM VALUES (1), (7), (NULL) AS t(severity)")
    assert [tuple(r) for r in quality.unexpected_values(rows, "severity", ("1", "2", "3", "4")).collect()] == [("7", 1)]


def test_duplicate_and_null_counts(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', NULL), (NULL, 2), (NULL, 3) AS t(k, v)")
    assert [tuple(r) for r in quality.duplicate_keys(rows, "k").collect()] == [("a", 2)]
    assert {tuple(r) for r in quality.null_counts(rows, ["k", "v"]).collect()} == {("k", 2), ("v", 1)}


def test_date_outliers(spark):
    rows = spark.sql("""SELECT 'x' AS accident_id, d AS accident_date, 'c' AS city, 1 AS severity
        FROM VALUES (date'2024-02-02'), (date'2024-02-01'), (date'2014-02-01'), (date'2014-01-31') AS t(d)""")
    assert {(str(r.accident_date), r.failure_reason) for r in quality.date_outliers(rows, AS_OF).collect()} == {
        ("2024-02-02", "Future date"), ("2014-01-31", "Too old (>10 years)")}


def test_thresholds(spark):
    assert one(quality.volume_check(numbers(spark, 1, 2, 2, 3), "id")) == (4, 3, 0.25, False, False)
    assert one(quality.volume_check(numbers(spark), "id"), "n_records", "duplicate_rate") == (0, 0.0)


def test_freshness(spark):
    def status(text):
        rows = spark.sql(f"SELECT CAST({text} AS timestamp_ntz) AS load_timestamp")
        return one(quality.freshness(rows, as_of=AS_OF), "status")
    assert [status(t) for t in ("'2024-01-31 22:00:00'", "'2024-01-31 21:59:59'", "'2024-01-31 17:59:00'", "NULL")] == [
        "pass", "warn", "error", "error"]


def test_has_rows(spark):
    assert one(quality.has_rows(numbers(spark)), "has_rows") is False
    assert one(quality.has_rows(numbers(spark, 1, 2)), "has_rows") is True
