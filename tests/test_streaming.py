import datetime as dt
import json
import os
import random

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from checks import queries, roles
from roadrisk import schemas
from roadrisk.operators import shared, sinks
from roadrisk.plans import staging, traffic_mart
from roadrisk.sources import cities, payloads
from roadrisk.streaming import landing, panes, windows


def land(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def answer(city, speed, fetched="2024-01-31 10:00:00"):
    payload = json.dumps({"flowSegmentData": {"currentSpeed": speed, "freeFlowSpeed": 60}})
    return {"city": city, "fetched_at": fetched, "payload": payload}


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_snapshot_keeps_the_newest_batch(spark, tmp_path):
    landed, root = tmp_path / "landed", tmp_path / "out"
    cities_table = cities.city_dimension(spark)

    def stage(batch):
        return staging.stage_flow(payloads.flow_raw(batch, cities_table).withColumn(
            "load_timestamp", F.lit("2024-01-31").cast("timestamp_ntz")))

    def refresh():
        run(landing.refresh_snapshot(landing.landed_stream(spark, str(landed), max_files=1), [
            (stage, f"{root}/staging"), (traffic_mart.traffic_mart, f"{root}/mart")], f"{root}/progress",
            f"{root}/polls"))
        return {(r.city, r.congestion_score) for r in sinks.read(spark, f"{root}/mart").collect()}

    first, second = "2024-01-31 10:00:00", "2024-01-31 10:30:00"
    land(landed, "1.json", answer("Fresno", 15, first), answer("Oakland", 60, first))
    assert refresh() == {("Fresno", 100), ("Oakland", 10)}
    # One poll in three files, each a micro-batch of its own, and a row of the poll before that comes late.
    land(landed, "2.json", answer("Fresno", 30, second), answer("Fresno", "?", second))
    land(landed, "3.json", answer("Oakland", 15, second))
    land(landed, "4.json", answer("San Jose", 60, second), answer("Long Beach", 60, first))
    assert refresh() == {("Fresno", 80), ("Oakland", 100), ("San Jose", 10)}
    assert refresh() == {("Fresno", 80), ("Oakland", 100), ("San Jose", 10)}


def test_catching_up_builds_once(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "out")
    built = []

    def plan(rows):
        built.append(1)
        return rows

    def catch_up():
        new = landing.catch_up_snapshot(landing.table_stream(spark, landed, max_files=1), [(plan, f"{root}/t")],
                                        f"{root}/progress", f"{root}/polls", "poll")
        return new, sorted(r.n for r in sinks.read(spark, f"{root}/t").collect()), len(built)

    def land_rows(*rows):
        spark.createDataFrame(rows, "poll long, n long").coalesce(1).write.mode("append").parquet(landed)

    for n in range(3):
        land_rows((1, n), (0, n))
    assert catch_up() == (True, [0, 1, 2], 1)
    assert catch_up() == (False, [0, 1, 2], 1)
    land_rows((0, 9))
    assert catch_up() == (False, [0, 1, 2], 1)
    land_rows((1, 3))
    # A run that dies before it has built the tables.
    with pytest.raises(RuntimeError, match="stop"):
        landing.catch_up_snapshot(landing.table_stream(spark, landed, max_files=1), [
            (lambda rows: (_ for _ in ()).throw(RuntimeError("stop")), f"{root}/t")], f"{root}/progress", f"{root}/polls", "poll")
    assert catch_up() == (True, [0, 1, 2, 3], 2)


def test_landed_files_grow_in_number_with_the_table(spark, tmp_path, monkeypatch):
    tables = {"nation": [(0, "N", 0)], "supplier": [(1, "S", 0, 1.0)], "lineitem": [
        (i // 4, i, 1, i % 4 + 1, 30.0, 1.0, 0.0, 0.0, "R", "F", None) for i in range(400)]}
    for name, rows in tables.items():
        spark.createDataFrame(rows, roles.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(shared, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "ROWS_A_FILE", 20, raising=False)
    mart = queries.stream_snapshot(spark, str(tmp_path))
    assert sorted(r.flow_id for r in mart.select("flow_id").collect()) == sorted(f"{i // 4}_{i % 4 + 1}" for i in range(400))
    files = [f for f in os.listdir(tmp_path / "snapshot/landed") if f.endswith(".parquet")]
    held = [spark.read.parquet(f"{tmp_path}/snapshot/landed/{f}").count() for f in files]
    assert sum(held) == 500 and len(files) >= 12 and max(held) < 100
    batches = [f for f in os.listdir(tmp_path / "snapshot/progress/commits") if f.isdigit()]
    assert 3 <= len(batches) <= 4


def polls(spark, kind, *batches):
    return [(spark.createDataFrame(rows, f"poll {kind}, n long"), i) for i, rows in enumerate(batches)]


T = dt.datetime


@pytest.mark.parametrize("kind, a, b, c, d", [
    ("long", 9, 10, 11, 100), ("string", "a b/c", "b=1", "c:2", "d%"),
    ("timestamp_ntz", T(2024, 1, 31, 9), T(2024, 1, 31, 9, 30), T(2024, 1, 31, 9, 30, 0, 500), T(2024, 2, 1)),
    ("timestamp", T(2024, 1, 31, 9), T(2024, 1, 31, 9, 30), T(2024, 1, 31, 9, 30, 0, 500), T(2024, 2, 1)),
    ("date", dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 2, 1))])
def test_a_batch_reads_one_poll_and_old_polls_go(spark, tmp_path, kind, a, b, c, d):
    path = str(tmp_path / "polls")
    seen = []
    steps = polls(spark, kind, [(a, 1), (b, 2)], [(a, 3), (None, 4)], [(a, 5), (c, 6)], [(b, 7), (a, 8)], [(None, 9)], [(d, 10), (c, 11)])
    for batch, number in steps + steps[-1:]:  # the last one is repeated
        newest, grown = landing.keep_polls(batch, number, path, "poll", keep=2)
        held = landing.poll_rows(spark, path, batch.schema, newest)
        seen.append((sorted(r.n for r in held.collect()), grown, len(landing.known_polls(spark, path))))
        assert len([f for f in os.listdir(f"{path}/rows") if f.startswith("_poll=")]) <= 2
        assert len([f for f in os.listdir(f"{path}/polls") if not f.startswith(".")]) <= 2
    assert seen == [([2], True, 2), ([2], False, 2), ([6], True, 2), ([6], False, 2), ([6], False, 2), ([10], True, 2), ([10], True, 2)]
    # The poll is a filter on the column that the rows are stored by.
    text = plan_text(held)
    assert "PartitionFilters: [isnotnull(_poll" in text and "(_poll#" in text
    assert len(held.inputFiles()) == 1 or len(held.where("false").inputFiles()) <= 2


def test_polls_must_be_ordered_values(spark, tmp_path):
    with pytest.raises(TypeError, match="poll"):
        landing.keep_polls(spark.sql("SELECT 1.5D AS poll, 1L AS n"), 0, str(tmp_path / "p"), "poll")


def test_quarantine_leaves_other_rows_alone(spark, tmp_path):
    landed, root = tmp_path / "landed", tmp_path / "out"
    broken = {"city": "Fresno", "fetched_at": "2024-01-31 10:00:00", "payload": '{"flowSegmentData": {'}
    land(landed, "1.json", answer("Fresno", 15), broken)
    land(landed, "2.json", broken, answer("Oakland", 20))
    run(landing.split_quarantine(landing.landed_stream(spark, str(landed), max_files=1), "payload",
                                 schemas.FLOW_PAYLOAD, f"{root}/table", f"{root}/progress"))
    good, bad = (landing.of_status(spark, f"{root}/table", s) for s in (landing.GOOD, landing.BROKEN))
    assert {(r.city, r.parsed.flowSegmentData.currentSpeed) for r in good.collect()} == {("Fresno", 15), ("Oakland", 20)}
    assert [r._corrupt_record for r in bad.collect()] == [broken["payload"]] * 2


def readings(spark, path, rows):
    spark.createDataFrame(rows, "flow_id string, city string, ts timestamp_ntz, level double").write.mode(
        "append").parquet(str(path))


def test_trailing_windows_equal_the_batch(spark, tmp_path):
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    rows = [(str(i), rng.choice("abb"), start + dt.timedelta(minutes=rng.randrange(3000)),
             None if i % 9 == 0 else float(rng.randrange(50))) for i in range(400)]
    readings(spark, tmp_path / "in", rows)
    stream = landing.table_stream(spark, str(tmp_path / "in"))
    run(landing.append_stream(windows.trailing_means(stream, "ts", "city", ["level"]), str(tmp_path / "out"),
                              str(tmp_path / "progress")))
    got = {(r.window_end, r.city): (r.readings, r.avg_level)
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    closed = max(r[2] for r in rows) - dt.timedelta(hours=1)
    expected, end = {}, start + dt.timedelta(minutes=30)
    while end <= closed:
        for city in "ab":
            inside = [r for r in rows if r[1] == city and end - dt.timedelta(hours=24) <= r[2] < end]
            levels = [r[3] for r in inside if r[3] is not None]
            if inside:
                expected[(end, city)] = (len(inside), sum(levels) / len(levels) if levels else None)
        end += dt.timedelta(minutes=30)
    assert got == expected


def test_open_windows_equal_the_batch(spark, tmp_path):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = [(str(i), rng.choice("ab"), start + dt.timedelta(minutes=10 * i + rng.randrange(30)),
             None if i % 7 == 0 else float(rng.randrange(9))) for i in range(90)]

    def refresh(part):
        readings(spark, tmp_path / "in", part)
        run(panes.refresh_panes(landing.table_stream(spark, str(tmp_path / "in")), "ts", "city", ["level"],
                                str(tmp_path / "panes"), str(tmp_path / "progress")))
        out = panes.trailing_now(spark, str(tmp_path / "panes"), "city", ["level"], "3 hours")
        return {(r.window_end, r.city): (r.window_start, r.readings, r.avg_level) for r in out.collect()}

    for upto in (50, 90):
        got = refresh(rows[upto - 50 if upto == 50 else 50:upto])
        expected, end = {}, start + dt.timedelta(minutes=30)
        while end <= max(r[2] for r in rows[:upto]) + dt.timedelta(hours=3, minutes=30):
            for city in "ab":
                inside = [r for r in rows[:upto] if r[1] == city and end - dt.timedelta(hours=3) <= r[2] < end]
                levels = [r[3] for r in inside if r[3] is not None]
                if inside:
                    expected[end, city] = (end - dt.timedelta(hours=3), len(inside),
                                           sum(levels) / len(levels) if levels else None)
            end += dt.timedelta(minutes=30)
        assert got == expected


def test_late_rows_are_dropped_and_all_counted(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    start = dt.datetime(2024, 1, 1)
    late = windows.LateRows()
    spark.streams.addListener(late)

    def refresh():
        stream = landing.table_stream(spark, str(tmp_path / "in"), max_files=1)
        means = windows.trailing_means(stream, "ts", "city", ["level"], "2 hours", "1 hour", "1 hour")
        query = landing.append_stream(means, str(tmp_path / "out"), str(tmp_path / "progress"))
        run(query)
        return query

    try:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
        readings(spark, tmp_path / "in", [("1", "a", start, 1.0), ("2", "a", start + 30 * hour, 2.0)])
        assert late.total(refresh()) == 0
        # More late batches than the query keeps reports of.
        for i in range(5):
            readings(spark, tmp_path / "in", [(f"l{i}", "a", start, 50.0)])
        readings(spark, tmp_path / "in", [("4", "a", start + 40 * hour, 4.0)])
        query = refresh()
        assert late.total(query) == 5 and late.batches[str(query.runId)] > 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(late)
    means = {r.window_end: r.avg_level for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert means[start + hour] == 1.0 and means[start + 31 * hour] == 2.0
    assert 50.0 not in means.values()


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    def refresh():
        stream = landing.table_stream(spark, str(tmp_path / "in"))
        kept = windows.first_of_each(stream, ["flow_id"], "ts")
        run(landing.append_stream(kept, str(tmp_path / "out"), str(tmp_path / "progress")))
        return sorted(r.flow_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    readings(spark, tmp_path / "in", [("a", "x", start, 1.0), ("b", "x", start, 1.0), ("a", "x", start, 1.0)])
    assert refresh() == ["a", "b"]
    readings(spark, tmp_path / "in", [("a", "x", start, 1.0), ("c", "x", start, 1.0)])
    assert refresh() == ["a", "b", "c"]


def test_many_batches_leave_few_segments_and_late_rows_are_kept(spark, tmp_path):
    path, draw = str(tmp_path / "panes"), random.Random(8)
    start = dt.datetime(2024, 1, 1)
    timely, late, latest = [], [], None
    schema = "id long, city string, ts timestamp_ntz, level double"

    def add(rows, number):
        panes.add_batch(spark.createDataFrame(rows, schema), number, path, "ts", "city", ["level"], 1800, 3600)

    for n in range(22):
        rows = [(100 * n + i, draw.choice("ab"), start + dt.timedelta(minutes=40 * n - draw.choice([0, 10, 50, 200])),
                 draw.choice([None, 1.0, 7.0])) for i in range(6)] if n != 5 else []
        for row in rows:
            end = start + ((row[2] - start) // dt.timedelta(minutes=30) + 1) * dt.timedelta(minutes=30)
            behind = latest is not None and end <= latest - dt.timedelta(hours=1)
            (late if behind else timely).append((*row, end, n))
        latest = max([*([latest] if latest else []), *[r[2] for r in rows]])
        add(rows, n)
        if n in (7, 21):
            add(rows, n)  # a repeated batch
    assert len(panes.open_segments(spark, path)) <= 2 * (panes.FANOUT - 1) + 1
    held = panes.trailing_now(spark, path, "city", ["level"], "2 hours")
    assert len(held.inputFiles()) <= 4 * len(panes.open_segments(spark, path))
    assert len(os.listdir(f"{path}/segments")) <= 4 * panes.FANOUT and len(os.listdir(f"{path}/state")) <= 6
    kept = panes.late_rows(spark, path, schema).collect()
    assert late and sorted((r.id, r._batch) for r in kept) == sorted((r[0], r[5]) for r in late)
    assert {r.reason for r in kept} == {"behind the watermark"} and len(late) + len(timely) == 21 * 6
    expected, end = {}, min(r[4] for r in timely)
    while end < max(r[4] for r in timely) + dt.timedelta(hours=2):
        for city in "ab":
            inside = [r for r in timely if r[1] == city and end - dt.timedelta(hours=2) < r[4] <= end]
            levels = [r[3] for r in inside if r[3] is not None]
            if inside:
                expected[end, city] = (len(inside), sum(levels) / len(levels) if levels else None)
        end += dt.timedelta(minutes=30)
    assert {(r.window_end, r.city): (r.readings, r.avg_level) for r in held.collect()} == expected


def test_no_late_rows_and_no_panes(spark, tmp_path):
    path = str(tmp_path / "panes")
    with pytest.raises(ValueError, match="no panes"):
        panes.trailing_now(spark, path, "city", ["level"])
    assert panes.late_rows(spark, path, "id long").columns == ["id", "reason", "watermark", "_batch"]
    rows = spark.createDataFrame([(None, "a", 1.0)], "ts timestamp_ntz, city string, level double")
    panes.add_batch(rows, 0, path, "ts", "city", ["level"], 1800, 3600)
    assert panes.open_segments(spark, path) == []


def test_a_repeat_never_gets_in_however_late(spark, tmp_path):
    start, day = dt.datetime(2024, 1, 1), dt.timedelta(days=1)
    schema = landing.StructType.fromDDL("flow_id string, city string, ts timestamp_ntz, level double")

    def refresh():
        stream = landing.table_stream(spark, str(tmp_path / "in"), max_files=1)
        run(windows.keep_first(stream, ["flow_id"], ["ts"], str(tmp_path / "out"), str(tmp_path / "progress")))
        rows = landing.kept_batches(spark, str(tmp_path / "out"), schema).collect()
        return sorted(((r.flow_id or "none", r.city, r.ts - start, r.level) for r in rows))

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    land(("a", "x", start + day, 1.0), ("a", "y", start, 2.0), ("b", "x", start, None), (None, "n", start, 0.0))
    first = [("a", "y", 0 * day, 2.0), ("b", "x", 0 * day, None), ("none", "n", 0 * day, 0.0)]
    assert refresh() == first
    # Three days later, and from before the first; other keys make the time go on.
    land(("a", "z", start + 3 * day, 9.0), ("c", "x", start + 30 * day, 5.0), (None, "m", start, 1.0))
    land(("a", "z", start - day, 9.0), ("b", "x", start + 60 * day, 8.0), ("c", "w", start, 6.0))
    assert refresh() == sorted([*first, ("c", "x", 30 * day, 5.0)])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != windows.ROCKS
