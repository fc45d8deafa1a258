import zipfile

from pyspark.sql import functions as F

from cratework.sources import deliveries

LINES = "archive string, member string, head string, sep string, tail string, line string"


def test_members_are_their_sorted_lines(spark, tmp_path):
    rows = [("f/a.zip", f"m{i % 3}", "[", ",\n", "]", None if i % 5 == 0 else f"é{i:03d}") for i in range(60)]
    rows += [("f/b.zip", "m0", "h\n", "\n", "\n", line) for line in ("z", "", "z")] + [("f/b.zip", "m1", "h", "", "", None)]
    report = deliveries.pack_archives(spark.createDataFrame(rows, LINES), str(tmp_path / "landing"))
    assert {tuple(r) for r in report.collect()} == {("f/a.zip", 3, 48), ("f/b.zip", 2, 3)}
    for name in ("f/a.zip", "f/b.zip"):
        with zipfile.ZipFile(tmp_path / "landing" / name) as archive:
            assert archive.testzip() is None
            for member in archive.namelist():
                own = [r for r in rows if r[:2] == (name, member)]
                wanted = own[0][2] + own[0][3].join(sorted(r[5] for r in own if r[5] is not None)) + own[0][4]
                assert archive.read(member).decode() == wanted


def test_runs_of_a_batch():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"archive": ["a", "a", "a", "b", None, None], "member": ["x", "x", "y", "y", "y", "y"]})
    assert list(deliveries._runs(batch)) == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 6)]
    assert list(deliveries._runs(batch.slice(0, 0))) == []


def test_csv_lines_look_for_quotes_in_texts_only(spark):
    df = spark.createDataFrame(
        [(1, 1.5, 'a"b', "", True), (None, None, None, None, None), (-2, float("nan"), ",", '""', False)],
        "n bigint, d double, t string, u string, b boolean",
    )
    lines = deliveries.as_csv(df, F.lit("f/a.zip"), F.lit("m.csv"), df.columns)
    assert [r["line"] for r in lines.collect()] == [
        '"1","1.5","a""b","","true"', '"","","","",""', '"-2","NaN",",","""""","false"',
    ]
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("replace(") == 3
    assert spark.range(1).select(deliveries.csv_line(F.lit('"'), F.lit(7), plain={1})).first()[0] == '"""","7"'


def test_archives_packed_in_pieces_are_the_same(spark, tmp_path):
    rows = [("f/a.zip", f"m{i % 3}", "[", ",\n", "]", None if i % 5 == 0 else f"é{i:05d}") for i in range(3000)]
    rows += [("f/b.zip", "m0", "h\n", "\n", "\n", line) for line in ("z", "", "z")] + [("f/b.zip", "m1", "h", "", "", None)]
    lines = spark.createDataFrame(rows, LINES)
    by_one = deliveries.pack_archives(lines, str(tmp_path / "one"))
    by_many = deliveries.pack_in_pieces(lines, str(tmp_path / "many"))
    assert sorted(map(tuple, by_many.collect())) == sorted(map(tuple, by_one.collect()))
    for name in ("f/a.zip", "f/b.zip"):
        with zipfile.ZipFile(tmp_path / "one" / name) as one, zipfile.ZipFile(tmp_path / "many" / name) as many:
            assert many.testzip() is None
            assert many.namelist() == one.namelist()
            for member in one.namelist():
                assert many.read(member) == one.read(member)
                assert many.getinfo(member).file_size == one.getinfo(member).file_size
    assert not list(tmp_path.glob("many-pieces-*"))


def test_large_table_is_packed_by_many_tasks(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    packed = []
    put_together = deliveries._reported
    monkeypatch.setattr(deliveries, "_reported", lambda written, root: packed.append(written) or put_together(written, root))
    entry.queries()["archive_json_large"](spark, "/root/testdata/sf0.001").count()
    plan = packed[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "start#" in plan and "line#" not in plan  # the archive's one task sees pieces, not lines
