import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cratework import files
from cratework.sources import landing

WORK = "source_name string, dataset_name string, bucket string, key string"
DAY = "2026-01-01"


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_copy_and_events(spark, tmp_path):
    put(tmp_path / "src/x/a.zip", b"x" * 13)
    put(tmp_path / "src/x/empty.zip", b"")
    bucket = str(tmp_path / "src")
    work = spark.createDataFrame(
        [("s", "d", bucket, "x/a.zip"), ("s", "d", bucket, "x/empty.zip"), ("s", "d", bucket, "gone.zip")], WORK
    )
    target = str(tmp_path / "landing")
    landed = landing.land_files(work, target, DAY, str(tmp_path / "report"), "{bucket}/{key}")
    got = {r["landing_key"].rsplit("/", 1)[-1]: r for r in landed.collect()}
    assert (got["a.zip"]["source_size"], got["a.zip"]["landed_size"], got["a.zip"]["error"]) == (13, 13, None)
    assert (got["empty.zip"]["source_size"], got["empty.zip"]["landed_size"]) == (0, 0)
    assert got["gone.zip"]["error"].startswith(f"Failed to upload {target}/s/d/ingest_date={DAY}/gone.zip")
    events = landing.batch_fan_out(landing.landed_events(landed, "landing"), "bronze", "run-1")
    assert sorted(tuple(r) for r in events.collect()) == [
        ("landing", f"s/d/ingest_date={DAY}/{n}.zip", "d", "bronze", "run-1") for n in ("a", "empty")
    ]


def test_equal_names_would_overwrite_each_other(spark, tmp_path):
    put(tmp_path / "src/x/a.zip", b"1")
    put(tmp_path / "src/y/a.zip", b"22")
    bucket = str(tmp_path / "src")
    work = spark.createDataFrame([("s", "d", bucket, "x/a.zip"), ("s", "d", bucket, "y/a.zip")], WORK)
    landed = landing.land_files(work, str(tmp_path / "landing"), DAY, str(tmp_path / "report"), "{bucket}/{key}")
    assert {r["error"] for r in landed.collect()} == {landing.COLLISION}
    assert not (tmp_path / "landing").exists()


def test_landing_again_overwrites(spark, tmp_path):
    work = spark.createDataFrame([("s", "d", str(tmp_path / "src"), "a.zip")], WORK)
    for data in (b"first", b"second one"):
        put(tmp_path / "src/a.zip", data)
        landing.land_files(work, str(tmp_path / "landing"), DAY, str(tmp_path / "report"), "{bucket}/{key}")
    assert (tmp_path / f"landing/s/d/ingest_date={DAY}/a.zip").read_bytes() == b"second one"


def test_size_check(spark, tmp_path):
    root = tmp_path / "landing"
    put(root / "ok.zip", b"x" * 13)
    put(root / "short.zip", b"x" * 13)
    expected = spark.createDataFrame([("ok.zip", 13), ("short.zip", 18), ("gone.zip", 1)], "key string, expected_size bigint")
    checked = landing.verify_landed(expected, str(root), str(tmp_path / "report"))
    got = {r["key"]: (r["status"], r["message"]) for r in checked.collect()}
    assert got == {
        "ok.zip": ("ok", None),
        "short.zip": ("mismatch_deleted", f"Transfer size mismatch for short.zip The file was deleted from {root}."),
        "gone.zip": ("unverifiable", f"{root}/gone.zip could not be verified"),
    }
    assert sorted(p.name for p in root.iterdir()) == ["ok.zip"]


@pytest.mark.skipif(os.geteuid() == 0, reason="root may delete anything")
def test_failed_delete_leaves_the_file(tmp_path):
    put(tmp_path / "l/a.zip", b"x")
    (tmp_path / "l").chmod(0o500)
    assert landing._settle(str(tmp_path / "l"), "a.zip", "mismatch")[0] == landing.MISMATCH_KEPT


def test_failed_delete_message(tmp_path, monkeypatch):
    def refuse(path):
        raise PermissionError(path)

    monkeypatch.setattr(files, "delete_file", refuse)
    assert landing._settle(str(tmp_path), "a.zip", "mismatch") == (
        "mismatch_delete_failed",
        "Transfer size mismatch for a.zip Attempted deletion also failed; object left in place.",
    )


def test_each_file_waits_on_its_own(spark):
    start = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    expected = spark.createDataFrame([("a",), ("b",)], "key string")
    listing = spark.createDataFrame([("a", 5, start)], "key string, length bigint, modificationTime timestamp")

    def states(hours):
        now = F.lit(start + dt.timedelta(hours=hours))
        return {r["key"]: r["state"] for r in landing.await_arrivals(expected, listing, F.lit(start), now).collect()}

    assert states(24) == {"a": "arrived", "b": "waiting"}
    assert states(25) == {"a": "arrived", "b": "timed_out"}
