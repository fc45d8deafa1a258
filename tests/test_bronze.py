import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cratework import fixed_values as fixed
from cratework.operators import bronze, contract
from cratework.sources import archives as zips

RUN = dt.datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=dt.timezone.utc)
SCHEMAS = {"ds": contract.text_schema(["id"]), "lots": contract.text_schema(["lot", "shelf", "mg"])}


@pytest.fixture
def load(spark, tmp_path):
    def run(run_id="run-1", schemas=SCHEMAS):
        archives = zips.list_archives(spark, str(tmp_path / "landing"))
        ledger = bronze.load_archives(archives, str(tmp_path / "bronze"), schemas, run_id, RUN)
        return {r["zip_file_name"]: r for r in ledger.collect()}

    return run


def folder(tmp_path, name, dataset="ds"):
    return tmp_path / "bronze" / "src" / dataset / "ingest_date=2026-01-01" / f"zip_name={name}"


def outcomes(spark, tmp_path, run_id="run-1"):
    rows = bronze.read_manifest(spark, str(tmp_path / "bronze"), run_id).collect()
    return {r["member"]: (r["outcome"], r["n_rows"]) for r in rows}


KEY = "src/ds/ingest_date=2026-01-01/{}.zip"


def test_mixed_archive(spark, tmp_path, make_zip, load):
    make_zip(
        KEY.format("a"),
        {
            "notes.md": b"# read me",
            "north.csv": b"id\n77\n",
            "blank.json": b" ",
            "south.json": b'{"id": 78}',
            "only_names.csv": b"id\n",
            "blank.csv": b"\n",
            "sub/": b"",
        },
    )
    row = load()["a.zip"]
    assert (row["status"], row["members"], row["uploaded"], row["n_rows"]) == ("complete", 7, 3, 2)
    assert outcomes(spark, tmp_path) == {
        "north.csv": ("valid", 1),
        "south.json": ("valid", 1),
        "only_names.csv": ("valid", 0),
        "notes.md": ("skipped_unsupported", 0),
        "sub/": ("skipped_unsupported", 0),
        "blank.csv": ("skipped_empty", 0),
        "blank.json": ("skipped_empty", 0),
    }
    assert sorted(p.name for p in folder(tmp_path, "a").iterdir()) == ["_SUCCESS", "schema_status=valid"]
    rows = bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"]).collect()
    assert sorted(r["id"] for r in rows) == ["77", "78"]


def test_end_to_end_types_and_lineage(spark, tmp_path, make_zip, load):
    make_zip(
        "src/lots/ingest_date=2026-01-01/stock.zip",
        {"shelves.csv": b"lot,shelf,mg\nL7,B2,0.125\nL8,,40\n", "counts.json": b'[{"lot": 9, "packs": 12.0}]'},
    )
    row = load()["stock.zip"]
    assert (row["status"], row["uploaded"], row["invalid"], row["n_rows"]) == ("complete", 2, 1, 3)
    base = folder(tmp_path, "stock", "lots")
    valid = spark.read.parquet(str(base / "schema_status=valid"))
    assert valid.columns == ["lot", "shelf", "mg", *fixed.LINEAGE_COLUMNS]
    first = valid.orderBy("lot").first()
    assert first["_bronze_processed_at"].microsecond == 678000
    assert (first["_dag_run_id"], first["_zip_file_name"], first["_source_file_name"], first["_schema_status"]) == (
        "run-1", "stock.zip", "shelves.csv", "valid",
    )
    invalid = spark.read.parquet(str(base / "schema_status=invalid"))
    assert invalid.columns == ["lot", "packs", *fixed.LINEAGE_COLUMNS]
    assert [(r["lot"], r["packs"]) for r in invalid.collect()] == [("9", "12.0")]
    manifest = bronze.read_manifest(spark, str(tmp_path / "bronze"), "run-1")
    report = bronze.invalid_schema_report(manifest, "s3://bronze").first()
    assert report["body"] == (
        "Files with invalid schema: counts.json<br>Location: "
        "s3://bronze/src/lots/ingest_date=2026-01-01/zip_name=stock/schema_status=invalid/"
    )
    view = bronze.quarantine_rows(spark, str(tmp_path / "bronze"), manifest).collect()
    assert [tuple(r) for r in view] == [("stock.zip", "counts.json", '{"lot":"9","packs":"12.0"}')]


def test_failure_stays_in_its_archive(spark, tmp_path, make_zip, load):
    make_zip(KEY.format("good"), {"a.csv": b"id\n1\n"})
    make_zip(KEY.format("json"), {"a.csv": b"id\n1\n", "b.json": b'[{"id": 1}'})
    make_zip(KEY.format("ragged"), {"a.csv": b"id\n1,2\n"})
    late = b"id\n" + b"1234567\n" * 1_000_000 + b"1,2\n"
    make_zip(KEY.format("late"), {"late.csv": late})
    make_zip(KEY.format("utf8"), {"a.csv": b"id\n\xff\n"})
    make_zip(KEY.format("nothing"), {"a.txt": b"x"})
    (tmp_path / "landing/src/ds/ingest_date=2026-01-01/broken.zip").write_bytes(b"not a zip")
    whole = make_zip(KEY.format("cut"), {"a.csv": b"id\n" + b"".join(b"%d\n" % i for i in range(5000))})
    data = bytearray(whole.read_bytes())
    data[200:300] = bytes(100)
    whole.write_bytes(bytes(data))
    make_zip("src/unknown/ingest_date=2026-01-01/x.zip", {"a.csv": b"id\n1\n"})
    make_zip("src/short/x2.zip", {"a.csv": b"id\n1\n"})
    got = {name: row["status"] for name, row in load().items()}
    assert got == {
        "good.zip": "complete",
        "json.zip": "failed",
        "ragged.zip": "failed",
        "late.zip": "failed",
        "utf8.zip": "failed",
        "nothing.zip": "empty",
        "broken.zip": "failed",
        "cut.zip": "failed",
        "x.zip": "failed_no_schema",
        "x2.zip": "failed_bad_key",
    }
    kept = sorted(p.name for p in (tmp_path / "bronze/src/ds/ingest_date=2026-01-01").iterdir())
    assert kept == ["zip_name=good"]
    assert bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"]).count() == 1


def test_rerun_replaces_output_and_spares_siblings(spark, tmp_path, make_zip, load):
    make_zip(KEY.format("a"), {"a.csv": b"id\n1\n"})
    make_zip(KEY.format("b"), {"b.csv": b"id\n2\n"})
    load()
    load("run-2")
    read = lambda: sorted(
        r["id"] for r in bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"]).collect()
    )
    assert read() == ["1", "2"]
    make_zip(KEY.format("a"), {"a.csv": b"id,more\n1,2\n"})
    (tmp_path / "landing" / KEY.format("b")).unlink()
    load("run-3")
    assert sorted(p.name for p in folder(tmp_path, "a").iterdir()) == ["_SUCCESS", "schema_status=invalid"]
    assert read() == ["2"]
    make_zip(KEY.format("a"), {"a.txt": b""})
    load("run-4")
    assert not folder(tmp_path, "a").exists()


def test_names_no_table_can_hold_are_kept_as_text(spark, tmp_path, make_zip, load):
    make_zip(
        KEY.format("007"),
        {"a.csv": b"id,ID\n1,2\n", "b.csv": b"id,_zip_file_name\n1,2\n", "x/c.json": b'[{"id": null}, {"id": null}]'},
    )
    assert load()["007.zip"]["status"] == "complete"
    assert outcomes(spark, tmp_path) == {"a.csv": ("invalid", 1), "b.csv": ("invalid", 1), "x/c.json": ("invalid", 2)}
    manifest = bronze.read_manifest(spark, str(tmp_path / "bronze"), "run-1")
    view = bronze.quarantine_rows(spark, str(tmp_path / "bronze"), manifest)
    assert view.where(F.col("member") == "a.csv").first()["row_json"] == (
        '[{"name": "id", "value": "1"}, {"name": "ID", "value": "2"}]'
    )
    assert view.where(F.col("member") == "x/c.json").count() == 2
    report = bronze.invalid_schema_report(manifest, "s3://bronze").first()
    assert report["file_names"] == "a.csv, b.csv, x__c.json"
    assert report["location"].endswith("zip_name=007/schema_status=invalid/")


def test_colliding_archive_keys_are_refused(tmp_path, make_zip, load):
    make_zip(KEY.format("a"), {"a.csv": b"id\n1\n"})
    make_zip("src/ds/ingest_date=2026-01-01/a.ZIP", {"a.csv": b"id\n2\n"})
    assert {r["status"] for r in load().values()} == {"failed_key_collision"}


def test_reprocess_after_registry_change(spark, tmp_path, make_zip, load):
    make_zip(KEY.format("a"), {"a.csv": b"id,more\n1,2\n"})
    load()
    target = str(tmp_path / "bronze")
    manifest = bronze.read_manifest(spark, target, "run-1")
    wider = {"ds": contract.text_schema(["id", "more"])}
    archives = zips.list_archives(spark, str(tmp_path / "landing"))
    ledger = bronze.reprocess_quarantine(archives, manifest, target, wider, "run-2").collect()
    assert [r["status"] for r in ledger] == ["complete"]
    assert [r["more"] for r in bronze.read_bronze(spark, target, "src", "ds", wider["ds"]).collect()] == ["2"]


def test_only_new_deliveries_are_pending(spark, tmp_path, make_zip, load):
    make_zip(KEY.format("a"), {"a.csv": b"id\n1\n"})
    load()
    target = str(tmp_path / "bronze")
    listing = lambda: zips.list_archives(spark, str(tmp_path / "landing"))
    pending = lambda: sorted(
        r["zip_file_name"] for r in bronze.pending_archives(listing(), bronze.read_ledger(spark, target), target).collect()
    )
    assert pending() == []
    make_zip(KEY.format("a"), {"a.csv": b"id\n12\n"})
    make_zip(KEY.format("b"), {"a.csv": b"id\n3\n"})
    assert pending() == ["a.zip", "b.zip"]


def test_status_needs_names_order_and_types(spark):
    a, b = contract.text_schema(["x", "y"]), contract.text_schema(["y", "x"])
    df = spark.createDataFrame([(a.json(), "d"), (b.json(), "d"), (a.json(), "other")], "s string, d string")
    got = [r[0] for r in df.select(contract.schema_status(F.col("s"), F.col("d"), {"d": a})).collect()]
    assert got == ["valid", "invalid", None]
    with pytest.raises(KeyError):
        contract.expected_schema("other", {"d": a})


def test_large_members_go_through_blocks(spark, tmp_path, make_zip, load, monkeypatch):
    monkeypatch.setattr(zips, "LARGE_MEMBER", 1_000_000)
    body = b"".join(b'"%d\n"\n' % i for i in range(1_500_000))
    make_zip(KEY.format("big"), {"big.csv": b"id\n" + body, "small.csv": b"id\nx\n"})
    make_zip(KEY.format("wide"), {"big.csv": b"id,b\n" + b"".join(b"%d,1\n" % i for i in range(1_500_000))})
    make_zip(KEY.format("late"), {"big.csv": b"id\n" + body + b"1,2\n"})
    got = {name: (r["status"], r["invalid"], r["n_rows"]) for name, r in load().items()}
    assert got == {
        "big.zip": ("complete", 0, 1_500_001),
        "wide.zip": ("complete", 1, 1_500_000),
        "late.zip": ("failed", 0, 0),
    }
    rows = bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"])
    number = F.expr("try_cast(trim('\n', id) as bigint)")
    assert rows.agg(F.count("*"), F.sum(number), F.countDistinct("id")).first()[:] == (
        1_500_001, 1_500_000 * 1_499_999 // 2, 1_500_001,
    )


def test_markers_of_many_archives_are_checked_in_tasks(spark, tmp_path, make_zip, load):
    for name in ("a", "b=1", "c:%", "d e"):
        make_zip(KEY.format(name), {"x.csv": b"id\n" + name.encode() + b"\n"})
    assert {r["status"] for r in load().values()} == {"complete"}
    read = lambda: bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"])
    assert sorted(r["id"] for r in read().collect()) == ["a", "b=1", "c:%", "d e"]
    for marker in (tmp_path / "bronze/src/ds/ingest_date=2026-01-01").glob("zip_name=[bc]*/_SUCCESS"):
        marker.unlink()
    assert sorted(r["id"] for r in read().collect()) == ["a", "d e"]
    assert sorted(r["zip_name"] for r in read().collect()) == ["a", "d e"]


def test_optional_lineage_columns(spark, make_zip, tmp_path):
    make_zip(KEY.format("a"), {"a.csv": b"id\n1\n"})
    splits = zips.plan_splits(zips.list_archives(spark, str(tmp_path / "landing")))
    rows = zips.read_rows(splits, SCHEMAS["ds"])
    both = bronze.with_lineage(rows, "r", RUN)
    assert both.columns == ["id", *fixed.LINEAGE_COLUMNS, *bronze.PARTITIONS]
    neither = bronze.with_lineage(rows, "r", RUN, file_name=False, schema_status=False)
    assert neither.columns == ["id", *fixed.LINEAGE_COLUMNS[:3], *bronze.PARTITIONS]
    assert neither.count() == 1


def test_last_load_of_a_path_decides(spark, tmp_path, make_zip, load):
    path = make_zip(KEY.format("a"), {"a.csv": b"id\n" + b"1234\n" * 2000})
    target = str(tmp_path / "bronze")
    listing = zips.list_archives(spark, str(tmp_path / "landing"))
    pending = lambda: bronze.pending_archives(listing, bronze.read_ledger(spark, target), target).count()
    load()
    assert pending() == 0
    (folder(tmp_path, "a") / "_SUCCESS").unlink()  # as if a later load had died half-way
    assert pending() == 1
    load("run-10")
    assert pending() == 0
    times, data = path.stat(), bytearray(path.read_bytes())
    data[45:55] = bytes(10)
    path.write_bytes(bytes(data))
    import os

    os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    assert load("run-9")["a.zip"]["status"] == "failed"
    assert pending() == 1
    last = bronze.last_attempts(bronze.read_ledger(spark, target)).collect()
    assert [(r["run_id"], r["status"]) for r in last] == [("run-9", "failed")]


def test_loads_under_one_run_id_add_up(spark, tmp_path, make_zip, load):
    first = make_zip(KEY.format("a"), {"a.csv": b"id\n1\n"})
    load("same")
    first.unlink()
    make_zip(KEY.format("b"), {"b.csv": b"id\n2\n"})
    load("same")
    ledger = bronze.read_ledger(spark, str(tmp_path / "bronze"))
    assert sorted(r["zip_file_name"] for r in ledger.collect()) == ["a.zip", "b.zip"]
    assert outcomes(spark, tmp_path, "same") == {"a.csv": ("valid", 1), "b.csv": ("valid", 1)}


def test_key_collision_with_an_earlier_load_is_refused(spark, tmp_path, make_zip, load):
    make_zip(KEY.format("a"), {"a.csv": b"id\n1\n"})
    load()
    make_zip("src/ds/ingest_date=2026-01-01/a.ZIP", {"a.csv": b"id\n2\n"})
    archives = zips.list_archives(spark, str(tmp_path / "landing")).where("zip_file_name = 'a.ZIP'")
    ledger = bronze.load_archives(archives, str(tmp_path / "bronze"), SCHEMAS, "run-2", RUN).collect()
    assert [r["status"] for r in ledger] == ["failed_key_collision"]
    rows = bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"]).collect()
    assert [r["id"] for r in rows] == ["1"]


def test_quarantine_holds_any_shapes(spark, tmp_path, make_zip, load):
    make_zip(
        KEY.format("a"),
        {
            "bool.json": b'[{"id": true}]',
            "wide.csv": b"id,more\n1,2\n3,4\n",
            "deep.json": b'[{"id": {"x": 1.50}}]',
            "void.json": b'[{"id": null, "k": 1}]',
        },
    )
    assert load()["a.zip"]["status"] == "complete"
    target = str(tmp_path / "bronze")
    view = bronze.quarantine_rows(spark, target, bronze.read_manifest(spark, target, "run-1"))
    assert sorted((r["member"], r["row_json"]) for r in view.collect()) == [
        ("bool.json", '{"id":true}'),
        ("deep.json", '{"id":{"x":"1.50"}}'),
        ("void.json", '{"id":null,"k":"1"}'),
        ("wide.csv", '{"id":"1","more":"2"}'),
        ("wide.csv", '{"id":"3","more":"4"}'),
    ]
    load("run-2")  # again: the last load's rows only
    assert bronze.quarantine_rows(spark, target, bronze.read_manifest(spark, target, "run-2")).count() == 5


def test_dropped_keys_are_in_the_manifest(spark, tmp_path, make_zip, load):
    make_zip(KEY.format("a"), {"a.json": b'[{"id": 1}, {"id": 2, "b": 3, "c": 4}]', "b.json": b'[{"id": 5}]'})
    row = load()["a.zip"]
    assert (row["status"], row["uploaded"], row["invalid"], row["n_rows"]) == ("complete", 2, 0, 3)
    rows = bronze.read_manifest(spark, str(tmp_path / "bronze"), "run-1").collect()
    assert {r["member"]: (r["outcome"], r["n_rows"], r["dropped_keys"]) for r in rows} == {
        "a.json": ("valid", 2, 2),
        "b.json": ("valid", 1, 0),
    }
    assert sorted(p.name for p in folder(tmp_path, "a").iterdir()) == ["_SUCCESS", "schema_status=valid"]


def test_json_limit_fails_its_archive_only(spark, tmp_path, make_zip):
    make_zip(KEY.format("big"), {"a.json": b'[{"id": "%s"}]' % (b"x" * 500)})
    make_zip(KEY.format("small"), {"a.json": b'[{"id": 1}]'})
    archives = zips.list_archives(spark, str(tmp_path / "landing"))
    for limit, want in ((100, "failed"), (None, "complete")):
        ledger = bronze.load_archives(archives, str(tmp_path / "bronze"), SCHEMAS, "r", RUN, json_limit=limit)
        assert {r["zip_file_name"]: r["status"] for r in ledger.collect()} == {"big.zip": want, "small.zip": "complete"}


def test_files_of_a_large_member_stay_few(spark, tmp_path, make_zip, load, monkeypatch):
    monkeypatch.setattr(zips, "LARGE_MEMBER", 1 << 20)
    monkeypatch.setattr(zips, "CSV_BLOCK", 1 << 18)
    monkeypatch.setattr(zips, "TASK_BYTES", 1 << 22)
    from cratework.sources import readers

    monkeypatch.setattr(readers, "CSV_BLOCK", 1 << 18)
    body = b"".join(b"%09d\n" % i for i in range(1_600_000))
    for name in "abc":
        make_zip(KEY.format(name), {"big.csv": b"id\n" + body})
    load()
    for name in "abc":
        files_of = list((folder(tmp_path, name) / "schema_status=valid").glob("*.parquet"))
        assert len(files_of) <= len(body) // (1 << 22) + 3


def test_compacted_ledger_says_the_same(spark, tmp_path, make_zip, load):
    """State, history and what is pending do not change when attempts are folded, also after a fold that died."""
    target = str(tmp_path / "bronze")
    assert bronze.compact_ledger(spark, target) == 0
    for name in "abc":
        make_zip(KEY.format(name), {"a.csv": b"id\n1\n"})
        load(f"run-{name}")
    listing = zips.list_archives(spark, str(tmp_path / "landing"))

    def seen():
        rows = lambda df: sorted(map(str, df.select("path", "attempt", "status", "run_id", "n_rows").collect()))
        pending = bronze.pending_archives(listing, bronze.current_ledger(spark, target), target)
        return rows(bronze.read_ledger(spark, target)), rows(bronze.current_ledger(spark, target)), pending.count()

    before = seen()
    assert [len(part) if isinstance(part, list) else part for part in before] == [1 + 2 + 3, 3, 0]
    loose = list((tmp_path / "bronze" / bronze.LEDGER).glob("run_id=*/attempt=*"))
    shutil.copytree(loose[0].parent, tmp_path / "kept")
    assert bronze.compact_ledger(spark, target) == 3 and seen() == before
    assert not list((tmp_path / "bronze" / bronze.LEDGER).glob("run_id=*/attempt=*"))
    shutil.copytree(tmp_path / "kept", loose[0].parent, dirs_exist_ok=True)  # as if it had died before it was deleted
    assert seen() == before
    (tmp_path / "landing" / KEY.format("b")).unlink()
    make_zip(KEY.format("d"), {"a.csv": b"id\n2\n"})
    load("run-d")
    assert bronze.compact_ledger(spark, target) == 2
    assert len(list((tmp_path / "bronze" / bronze.STATE).glob("version=*"))) == 1
    assert len(bronze.current_ledger(spark, target).collect()) == 4
    make_zip(KEY.format("a"), {"a.csv": b"id\n12\n"})
    again = zips.list_archives(spark, str(tmp_path / "landing"))
    assert [r.zip_file_name for r in bronze.pending_archives(again, bronze.current_ledger(spark, target), target).collect()] == ["a.zip"]


def test_unfinished_archives_are_found_in_tasks(spark, tmp_path, make_zip, load):
    odd = "a b%=1"
    for name in ("a", "b", odd):
        make_zip(KEY.format(name), {"a.csv": b"id\n1\n"})
    load()
    base = str(tmp_path / "bronze" / "src" / "ds")
    assert bronze.unfinished_archives(spark, base).count() == 0
    rows = lambda: bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"], ["2026-01-01"])
    assert rows().count() == 3
    for marker in (tmp_path / "bronze" / "src" / "ds").rglob("_SUCCESS"):
        if "zip_name=b" not in str(marker):
            marker.unlink()
    assert sorted(map(tuple, bronze.unfinished_archives(spark, base, ["2026-01-01"]).collect())) == [("2026-01-01", "a"), ("2026-01-01", odd)]
    assert [r.zip_name for r in rows().collect()] == ["b"] and rows().columns[0] == "id"
    assert bronze.unfinished_archives(spark, base, ["2026-01-05"]).count() == 0


def test_quarantine_files_of_lost_attempts_go(spark, tmp_path, make_zip, load, monkeypatch):
    """A file that a lost attempt left beside the counted ones is deleted, whatever it holds."""
    make_zip(KEY.format("a"), {"a.csv": b"id\n1\n", "b.csv": b"other,more\n1,2\n3,4\n"})
    real = bronze._drop_uncounted

    def with_stray(session, table):
        place = session.read.parquet(table).first()["file"].rsplit("/", 1)[0]
        shutil.copy(next(Path(place).glob("*.parquet")), f"{place}/member-1-0-lost.parquet")
        real(session, table)

    monkeypatch.setattr(bronze, "_drop_uncounted", with_stray)
    load()
    found = list((tmp_path / "bronze").rglob("schema_status=invalid/*.parquet"))
    assert len(found) == 1 and "lost" not in found[0].name
    assert spark.read.parquet(str(found[0])).count() == 2


@pytest.mark.parametrize("few", [0, 64])
def test_unfinished_archives_are_left_out_by_filter_or_join(spark, tmp_path, make_zip, load, monkeypatch, few):
    monkeypatch.setattr(bronze, "FEW_UNFINISHED", few)
    odd = "a b%=1"
    for name in ("a", "b", odd):
        make_zip(KEY.format(name), {"a.csv": b"id\n1\n"})
    load()
    for marker in (tmp_path / "bronze" / "src" / "ds").rglob("_SUCCESS"):
        if "zip_name=b" not in str(marker):
            marker.unlink()
    rows = bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", SCHEMAS["ds"], ["2026-01-01"])
    assert [r.zip_name for r in rows.collect()] == ["b"] and rows.columns[0] == "id"


def test_large_json_members_are_parsed_by_many_tasks(spark, tmp_path, make_zip, load, monkeypatch):
    """What pieces say together is what one reader says."""
    monkeypatch.setattr(zips, "LARGE_MEMBER", 1_000_000)
    parsed = []
    parse = zips.parse_pieces
    monkeypatch.setattr(zips, "parse_pieces", lambda pieces, schema: parsed.append(pieces) or parse(pieces, schema))
    n = 70_000
    rows = [b'{"id": %d, "b": "%s"}' % (i, b"x" * 60) for i in range(n)]
    sep = b",\n"
    members = {
        "good": rows,
        "late_key": [*rows, b'{"id": 1, "b": "y", "c": 5}'],  # dropped and counted
        "late_null": [b'{"id": null, "b": "z"}', *rows, b'{"id": null, "b": null}'],
        "void": [b'{"id": null, "b": "%s"}' % (b"x" * 60) for _ in range(n)],  # a column without a type
        "late_kind": [*rows, b'{"id": 1, "b": {"deep": 1}}'],
        "swapped": [b'{"b": "1", "id": 2}', *rows],
        "torn": [*rows, b'{"id": 1'],
        "odd": [*rows, b"7"],
        "inner": [*rows, *[b'{"id": 0, "b": "\\"},{ }}"}'] * n],  # texts that look like ends of records
    }
    for name, lines in members.items():
        make_zip(KEY.format(name), {"big.json": b"[" + (b"," if name == "inner" else sep).join(lines) + b"]"})
    make_zip(KEY.format("mixed"), {"big.json": b"[" + sep.join(rows) + b"]", "big.csv": b"id,b\n" + b"1,2\n" * 300_000, "s.json": b'[{"id": 1, "b": 2}]'})
    schemas = {"ds": contract.text_schema(["id", "b"])}
    ledger = bronze.load_archives(zips.list_archives(spark, str(tmp_path / "landing")), str(tmp_path / "bronze"), schemas, "r", RUN)
    got = {r["zip_name"]: (r["status"], r["invalid"], r["n_rows"]) for r in ledger.collect()}
    assert got == {
        "good": ("complete", 0, n), "late_key": ("complete", 0, n + 1), "late_null": ("complete", 0, n + 2),
        "void": ("complete", 1, n), "late_kind": ("failed", 0, 0), "swapped": ("complete", 1, n + 1),
        "torn": ("failed", 0, 0), "odd": ("failed", 0, 0), "inner": ("complete", 0, 2 * n),
        "mixed": ("complete", 0, n + 300_001),
    }
    read = bronze.read_bronze(spark, str(tmp_path / "bronze"), "src", "ds", schemas["ds"])
    counts = {r["zip_name"]: (r["n"], r["ids"]) for r in read.groupBy("zip_name").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).collect()}
    assert counts == {
        "good": (n, n), "late_key": (n + 1, n), "late_null": (n + 2, n), "inner": (2 * n, n), "mixed": (n + 300_001, n),
    }
    manifest = bronze.read_manifest(spark, str(tmp_path / "bronze"), "r")
    assert {r["zip_name"] for r in manifest.where("dropped_keys = 1").collect()} == {"late_key"}
    assert parsed[0].where("member = 'big.json'").groupBy("path").count().agg(F.max("count")).first()[0] > 1
    assert not list((tmp_path / "bronze/src/ds").glob("*/*/schema_status=[un]*"))
