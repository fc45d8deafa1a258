import hashlib

import pytest

from cratework.llm import warc_store

PAGE = "page_id long, url string, html string, digest string, size int"


def frame(session, rows):
    return session.createDataFrame([(*r, "clash", 1) for r in rows], PAGE).repartition(3)


ROWS = [
    (1, "http://a/1", "x" * 200),
    (2, "http://a/2", "x" * 200),
    (3, None, "short"),
    (4, "http://a/ 4\r\nX: y", "short"),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://ü/7", "é" * 50),
    (8, "u", "é" * 50),
    (9, "v", "y" * 99),
    (10, "v", "y" * 99),
    (11, "long", "<p>\r\n\r\n</p>" * 40_000),
    (None, "null", "x" * 200),
    (1, "http://a/1", "x" * 200),
]


def test_archive_round_trip(session, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc_store.write_archive(frame(session, ROWS), folder)
    got = warc_store.describe(warc_store.read_archive(session, folder)).collect()
    assert len(got) == len(ROWS) and all(r.digest_ok for r in got)
    by_page = {}
    for r in got:
        by_page.setdefault(r.page_id, []).append(r)
    for page, _, html in ROWS:
        payload = (html or "").encode()
        for r in by_page[page]:
            assert r.payload_bytes == len(payload) and r.payload_digest == hashlib.sha256(payload).hexdigest()
    kinds = {p: [(r.record_type, r.refers_to) for r in rs] for p, rs in by_page.items()}
    assert kinds[1] == [("response", None)] * 2 and kinds[2] == [("revisit", 1)] and kinds[None] == [("revisit", 1)]
    assert kinds[8] == [("revisit", 7)]
    assert all(kinds[p] == [("response", None)] for p in (3, 4, 5, 6, 7, 9, 10, 11))
    stored = session.read.parquet(f"{folder}/payloads")
    assert stored.count() == len({h or "" for _, _, h in ROWS})


def test_records_are_warc(session, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc_store.write_archive(frame(session, ROWS), folder)
    archive = warc_store.read_archive(session, folder)
    records = sorted(bytes(r.record) for r in archive.collect())
    for record in records:
        head, rest = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        assert b" " not in fields[b"WARC-Target-URI"]
    ids = [r.split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for r in records if b"WARC-Type: response" in r]
    for r in records:
        if b"WARC-Type: revisit" in r:
            assert r.split(b"WARC-Refers-To: ")[1].split(b"\r\n")[0] in ids
    exported = warc_store.export_files(archive, f"file://{tmp_path}/files")
    assert sorted(bytes(r.record) for r in warc_store.import_files(exported).collect()) == records


def test_damage_is_found(session, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc_store.write_archive(frame(session, ROWS[:3]), folder)
    other = session.read.parquet(f"{folder}/payloads").selectExpr("digest", "concat(payload, cast('!' as binary)) as payload")
    other.write.parquet(f"{folder}/damaged")
    (tmp_path / "w" / "payloads").rename(tmp_path / "w" / "was")
    (tmp_path / "w" / "damaged").rename(tmp_path / "w" / "payloads")
    with pytest.raises(Exception, match="payload does not have digest"):
        warc_store.read_archive(session, folder).collect()


def test_no_pages(session, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc_store.write_archive(frame(session, ROWS).limit(0), folder)
    assert warc_store.describe(warc_store.read_archive(session, folder)).count() == 0


def test_files_say_the_same(session, tmp_path):
    """Bytes, digest, type and target from WARC files alone, a revisit's from its response."""
    folder = f"file://{tmp_path}/w"
    warc_store.write_archive(frame(session, ROWS), folder)
    archive = warc_store.read_archive(session, folder)
    records = warc_store.read_records(warc_store.export_files(archive, f"{folder}/files"))
    got = sorted(map(tuple, warc_store.describe_records(records).collect()), key=str)
    assert got == sorted(map(tuple, warc_store.describe(archive).drop("digest_ok").collect()), key=str)
    assert {r.body_bytes for r in records.where("record_type = 'revisit'").collect()} == {None}


def test_a_damaged_file_is_found(session, tmp_path):
    import gzip

    folder = f"file://{tmp_path}/w"
    warc_store.write_archive(frame(session, ROWS[:1]), folder)
    exported = warc_store.export_files(warc_store.read_archive(session, folder), f"{folder}/files")
    path = exported.collect()[0].path.removeprefix("file://")
    with gzip.open(path) as file:
        content = file.read()
    with gzip.open(path, "w") as file:
        file.write(content.replace(b"xx\r\n\r\n", b"xy\r\n\r\n"))
    with pytest.raises(Exception, match="payload does not have digest"):
        warc_store.read_records(exported).collect()
