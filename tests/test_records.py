import csv
import io
import random

import pytest
from conftest import AS_OF

from roadrisk.sources import accidents, records


def as_pandas_reads(text):
    """Records of a text as the standard reader cuts them."""
    return [row for row in csv.reader(io.StringIO(text, newline=""), strict=False) if row]


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that records cross several."""
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [7, 40, 100_000])
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_records_at_any_split(spark, tmp_path, small_splits, size, broadcast):
    small_splits(size)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    draw = random.Random(size)
    values = ["a", "", "two words", 'a "quoted" word', "a,b", "line\nbreak", "\n\n\n", "é漢", "x" * 30, '"', "tail\n"]
    want = []
    try:
        for name in ("one.csv", "two.csv"):
            rows = [[str(i), *[draw.choice(values) for _ in range(2)]] for i in range(60)]
            out = io.StringIO()
            csv.writer(out, lineterminator=draw.choice(["\n", "\r\n"])).writerows([["id", "b(x)", "c`d"], *rows])
            assert as_pandas_reads(out.getvalue())[1:] == rows
            (tmp_path / name).write_text(out.getvalue(), newline="")
            want += rows
        got = records.parsed(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.reason, r[records.CORRUPT]) for r in got} == {(None, None)}
    plain = lambda rows: sorted([v or "" for v in row] for row in rows)
    assert plain([r[0], r[1], r[2]] for r in got) == plain(want)


@pytest.mark.parametrize("size", [9, 100_000])
def test_every_record_is_good_or_kept_with_a_reason(spark, tmp_path, small_splits, size):
    small_splits(size)
    text = 'id,b,c\n1,x,y\n2,x\n\n3,"a\nb",y,z\n4,"p\nq",r\n   \n5,x,"open\nto the end\n6,x,y\n'
    (tmp_path / "t.csv").write_text(text)
    got = {(r.id, r.b, r.c, r._corrupt_record, r.reason) for r in records.parsed(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {("1", "x", "y", None, None), ("4", "p\nq", "r", None, None), (None, None, None, "2,x", records.FIELDS),
                   (None, None, None, '3,"a\nb",y,z', records.FIELDS),
                   (None, None, None, '5,x,"open\nto the end\n6,x,y', records.OPEN)}


def test_a_stray_quote_keeps_memory_bounded(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(records, "LONGEST", 50)
    lines = ["1,a", '2,"a', *["text"] * 40, 'end",3', "4,b"]
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(lines), "block": [0] * len(lines), "value": lines,
                                        "quotes": [v.count('"') for v in lines], "began_open": [False] * len(lines)})
    out = [r for b in records._joined(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert "\n".join(r["text"] for r in out) == "\n".join(lines)
    assert max(len(r["text"]) for r in out) < 80 and [r["kind"] for r in out if r["kind"] != records.CUT] == [records.WHOLE] * 2


def test_accidents_with_line_breaks(spark, tmp_path):
    from roadrisk.functions import fixed
    headers = [h for h, _ in fixed.rows(fixed.ACCIDENT_COLUMNS, header=False)]
    rows = [{"ID": "A-1", "State": "CA", "Description": "first\nsecond", "Severity": "2"}, {"ID": "A-2", "State": "TX"},
            {"ID": "A-3", "State": "CA", "Severity": "3"}]
    with open(tmp_path / "a.csv", "w", newline="") as file:
        writer = csv.DictWriter(file, headers)
        writer.writeheader()
        writer.writerows(rows)
        file.write("A-4,CA\n")
    path = str(tmp_path / "a.csv")
    good = {r.accident_id: r.description for r in accidents.read_records(spark, path, as_of=AS_OF).collect()}
    assert good == {"A-1": "first\nsecond", "A-3": None}
    assert [tuple(r) for r in accidents.broken_records(spark, path).collect()] == [("A-4,CA", records.FIELDS)]
    assert accidents.read_csv(spark, path, as_of=AS_OF).schema == accidents.read_records(spark, path, as_of=AS_OF).schema
