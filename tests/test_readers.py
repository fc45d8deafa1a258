import csv
import io
import json
import zipfile

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cratework.sources import readers


def read(name: str, data: bytes, **options):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(name, data)
    archive = zipfile.ZipFile(buffer)
    schema, batches = readers.read_member(archive, archive.infolist()[0], **options)
    return schema, pa.Table.from_batches(list(batches), schema)


def rows(name: str, data: bytes):
    _, table = read(name, data)
    return table.to_pylist()


@pytest.mark.parametrize(
    "data, expected",
    [
        (b"id\n1\n", [{"id": "1"}]),
        (b"id,b\r\n1,\r\n\r\n,NULL", [{"id": "1", "b": ""}, {"id": "", "b": "NULL"}]),
        (b"\xef\xbb\xbfid, a \n1,x y \n", [{"id": "1", " a ": "x y "}]),
        (b'id\n"say ""hi"""\n"a\nb"\n"back\\slash"\n', [{"id": 'say "hi"'}, {"id": "a\nb"}, {"id": "back\\slash"}]),
        (b"a;b\n1;2\n", [{"a;b": "1;2"}]),
        (b'"x\ny",z\n1,2\n', [{"x\ny": "1", "z": "2"}]),
        (b'5" pipe,z\n1,2\n', [{'5" pipe': "1", "z": "2"}]),
        (b"\n\nid\n1\n", [{"id": "1"}]),
        (b"id\n", []),
        (b"id\n1.10\n1e5\n-0\n007\n", [{"id": "1.10"}, {"id": "1e5"}, {"id": "-0"}, {"id": "007"}]),
    ],
)
def test_csv(data, expected):
    assert rows("x.csv", data) == expected


@pytest.mark.parametrize("name", ["x.CSV", "x.Csv", "dir/x.csv"])
def test_extension_case(name):
    assert rows(name, b"id\n1\n") == [{"id": "1"}]


@pytest.mark.parametrize(
    "name, data",
    [("x.csv", b""), ("x.csv", b"id"), ("x.csv", b"\n\n"), ("x.txt", b"id\n1\n"), ("csv", b"id\n1\n"), (".csv", b"id\n1\n")]
    + [("x.json", text) for text in (b"", b"  \n", b"{}", b"[]", b"[{}]", b"[{}, {}]")],
)
def test_nothing_to_load(name, data):
    with pytest.raises(readers.Skipped):
        read(name, data)


@pytest.mark.parametrize(
    "name, data",
    [
        ("x.csv", b"id\n1,2\n"),
        ("x.csv", b"id,b\n1\n"),
        ("x.csv", b"id\n\xff\n"),
        ("x.json", b'[{"id": 1}'),
        ("x.json", b'{"id": 1}\n{"id": 2}\n'),
        ("x.json", b"5"),
        ("x.json", b"null"),
        ("x.json", b'["x"]'),
        ("x.json", b'[null, {"a": 1}]'),
        ("x.json", b'[{"a": 1}, {"a": {"b": 2}}]'),
    ],
)
def test_broken_members_fail(name, data):
    with pytest.raises(Exception) as failure:
        read(name, data)
    assert not isinstance(failure.value, (readers.Skipped, OSError))


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"pack":7,"mg":0.125},{"pack":8,"mg":40.0}]', [{"pack": "7", "mg": "0.125"}, {"pack": "8", "mg": "40.0"}]),
        ('{"shelf":"B2","open":false}', [{"shelf": "B2", "open": False}]),
        ('[{"lot":3,"box":{"width":10.50,"unit":"cm"}}]', [{"lot": "3", "box": {"unit": "cm", "width": "10.50"}}]),
        ('[{"mg":null},{"mg":0.125}]', [{"mg": None}, {"mg": "0.125"}]),
        ('[{"a":1.10,"b":1e5,"c":-0,"d":true}]', [{"a": "1.10", "b": "1e5", "c": "-0", "d": True}]),
        ('[{"a":1},{"a":2,"b":3}]', [{"a": "1"}, {"a": "2"}]),
        ('[{"a":1,"b":2},{"a":3}]', [{"a": "1", "b": "2"}, {"a": "3", "b": None}]),
        ('{"a":1,"a":2}', [{"a": "2"}]),
        ('﻿{"a":[1,2.50]}', [{"a": ["1", "2.50"]}]),
    ],
)
def test_json(text, expected):
    assert rows("x.json", text.encode()) == expected


def test_json_types():
    schema, _ = read("x.json", b'[{"a":null,"b":true,"c":NaN}]')
    assert schema.types == [pa.null(), pa.bool_(), pa.float64()]


def test_json_limit_is_an_argument():
    text = b'[{"lot": 12}, {"lot": 345}]'
    assert len(read("x.json", text)[1]) == 2
    assert len(read("x.json", text, json_limit=len(text))[1]) == 2
    with pytest.raises(ValueError, match=f"larger than {len(text) - 1} bytes"):
        read("x.json", text, json_limit=len(text) - 1)


def test_dropped_keys_are_counted():
    notes = readers.Notes()
    _, table = read("x.json", b'[{"a":1},{"a":2,"b":3,"c":4},{"c":5}]', notes=notes)
    assert table.to_pylist() == [{"a": "1"}, {"a": "2"}, {"a": None}] and notes.dropped_keys == 3


@pytest.mark.parametrize("chunk", [1, 7, 64, 4096])
def test_json_of_any_size_is_read_in_pieces(monkeypatch, chunk):
    monkeypatch.setattr(readers, "JSON_CHUNK", chunk)
    records_in = [{"n": k, "s": 'q"\\é' * (k % 5), "deep": {"x": [k, None], "y": None if k % 3 else True}} for k in range(300)]
    for text in (json.dumps(records_in), json.dumps(records_in, indent=2, ensure_ascii=False)):
        got = rows("x.json", text.encode())
        assert [r["n"] for r in got] == [str(k) for k in range(300)]
        assert [r["s"] for r in got] == [r["s"] for r in records_in]
        assert got[5]["deep"] == {"x": ["5", None], "y": None} and got[6]["deep"]["y"] is True
    for broken in (b'[{"n": 1} {"n": 2}]', b'[{"n": 1},]', b'[{"n": 1}', b'[{"n": "x}]', b'[{"n": 1}] x', b'[{"n": tru}]'):
        with pytest.raises(json.JSONDecodeError):
            rows("x.json", broken)


def test_types_agree_over_pieces(monkeypatch):
    monkeypatch.setattr(readers, "JSON_CHUNK", 1)
    schema, table = read("x.json", b'[{"a":null,"b":{"x":null}},{"a":[],"b":{"z":1}},{"a":[true],"b":null}]')
    assert schema.field("a").type == pa.list_(pa.bool_())
    assert schema.field("b").type == pa.struct([("x", pa.null()), ("z", pa.string())])
    assert table.num_rows == 3
    with pytest.raises(pa.ArrowInvalid):
        read("x.json", b'[{"a":1},{"a":true}]')


def test_lone_quote_in_a_long_member():
    body = b"".join(b"%d,2\n" % k for k in range(400_000))
    assert len(read("x.csv", b'5" pipe,z\n' + body)[1]) == 400_000


def test_values_across_blocks_and_long_headers(monkeypatch):
    monkeypatch.setattr(readers, "HEADER_CHUNK", 7)
    monkeypatch.setattr(readers, "CSV_BLOCK", 64)
    names = [f"column_{i}" for i in range(3)]
    lines = [",".join(names)] + [f'"{i}\nx",b,"c""{i}"' for i in range(200)]
    got = rows("x.csv", "\n".join(lines).encode())
    assert got == [{names[0]: f"{i}\nx", names[1]: "b", names[2]: f'c"{i}'} for i in range(200)]


cell = st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=12)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=20))
def test_quoted_csv_keeps_every_character(table):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([("a", "b"), *table])
    assert [(r["a"], r["b"]) for r in rows("x.csv", out.getvalue().encode())] == table


numbers = st.one_of(
    st.integers().map(str),
    st.decimals(allow_nan=False, allow_infinity=False, places=3).map(lambda d: format(d, "f")),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(numbers, cell), min_size=1, max_size=20))
def test_json_numbers_keep_their_text(table):
    text = "[" + ",".join(f'{{"n": {n}, "s": {json.dumps(s)}}}' for n, s in table) + "]"
    assert [(r["n"], r["s"]) for r in rows("x.json", text.encode())] == table


value = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers().map(str), st.sampled_from(["", "x", "é"])),
    lambda inner: st.one_of(
        st.lists(inner, max_size=3), st.dictionaries(st.sampled_from("zyxab"), inner, max_size=3)
    ),
    max_leaves=6,
)
records = st.lists(st.dictionaries(st.sampled_from(["b", "a", "Z", "é"]), value, max_size=4), min_size=1, max_size=5)


@settings(max_examples=300, deadline=None)
@given(records)
def test_records_become_the_columns_arrow_would_make(rows_in):
    readers.JSON_CHUNK, before = 1, readers.JSON_CHUNK  # every record a batch of its own
    try:
        want = pa.Table.from_pylist(rows_in)
    except Exception:
        want = None
    try:
        names = list(rows_in[0])
        kind = {name: pa.null() for name in names}
        for rows in readers.json_batches(iter(rows_in), names):
            found = pa.array(rows).type
            kind = {name: readers.common_type(kind[name], readers._field(found, name)) for name in names}
        schema = pa.schema(list(kind.items()))
        parts = [pa.array(r, pa.struct(list(schema))) for r in readers.json_batches(iter(rows_in), names) if names]
        got = pa.Table.from_batches([readers._record_batch(r, schema) for r in parts], schema)
    except Exception:
        got = None
    readers.JSON_CHUNK = before
    assert (got is None) == (want is None)
    if want is not None and rows_in[0]:
        assert got.schema.equals(want.schema)
        assert got.to_pylist() == want.to_pylist()


@pytest.mark.parametrize("between", [",", ",\n", " ,\n  "])
@pytest.mark.parametrize("chunk", [16, 300, 5000])
def test_json_records_in_runs_are_the_same_one_by_one(monkeypatch, between, chunk):
    """Ends of records inside texts and nested lists are no ends, wherever the text is cut."""
    monkeypatch.setattr(readers, "JSON_CHUNK", chunk)
    record = '{{"id":{0},"price":{0}.10,"text":"}}{1}{{","parts":[{{"a":1.50}}{2}{{"a":"\\u00e9,\\"}}"}}]}}'
    text = "[" + between.join(record.format(i, between.replace("\n", "\\n"), between) for i in range(200)) + "]"
    found = list(readers.json_values(io.BytesIO(text.encode())))
    assert found == json.loads(text, parse_int=str, parse_float=str)
    for broken in (text[:-1] + ",]", text.replace('"id":150', '"id":,150'), text[:-1], text + "x"):
        with pytest.raises(json.JSONDecodeError):
            list(readers.json_values(io.BytesIO(broken.encode())))


def test_a_small_json_member_of_several_batches_is_parsed_once(monkeypatch):
    calls = []
    values = readers.json_values
    monkeypatch.setattr(readers, "json_values", lambda stream: calls.append(1) or values(stream))
    monkeypatch.setattr(readers, "JSON_CHUNK", 640)

    def read(records, held=1 << 20):
        calls.clear()
        monkeypatch.setattr(readers, "JSON_HELD", held)
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            archive.writestr("a.json", json.dumps(records))
        with zipfile.ZipFile(packed) as archive:
            schema, batches = readers.read_member(archive, archive.infolist()[0])
            return [row for batch in batches for row in batch.to_pylist()], schema

    plain = [{"a": str(i), "b": "x"} for i in range(50)]
    assert read(plain)[0] == plain and len(calls) == 1
    assert read(plain, held=100)[0] == plain and len(calls) == 2
    gaps = [{"a": str(i), "b": None, "c": None} if i < 25 else {"a": str(i), "b": "y"} for i in range(50)]
    assert read(gaps)[0] == [{**{"b": None, "c": None}, **r} for r in gaps] and len(calls) == 2


@pytest.mark.parametrize(
    "data, opened",
    [
        (b"id,b\n1,2\n", 2),
        (b'\xef\xbb\xbf"id","b"\n1,2\n', 2),
        (b"id,id\n1,2\n", 2),
        (b'"i,d",b\n1,2\n', 3),
        (b'"i""d",b\n1,2\n', 3),
        (b'"i\nd",b\n1,2\n', 3),
    ],
)
def test_csv_with_a_plain_header_is_parsed_once(monkeypatch, data, opened):
    seen = []
    plain = zipfile.ZipFile.open
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("a.csv", data)
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, *args, **more: seen.append(1) or plain(self, *args, **more))
    archive = zipfile.ZipFile(buffer)
    schema, batches = readers.read_member(archive, archive.infolist()[0])
    table = pa.Table.from_batches(list(batches), schema)
    assert schema.types == [pa.string()] * 2
    assert [column.to_pylist() for column in table.columns] == [["1"], ["2"]]
    assert schema.names == next(csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")))
    assert len(seen) == opened


def test_json_pieces_hold_whole_records(tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "JSON_CHUNK", 64)

    def pieces(text: bytes):
        with zipfile.ZipFile(tmp_path / "p.zip", "w") as archive:
            archive.writestr("a.json", text)
        with zipfile.ZipFile(tmp_path / "p.zip") as archive:
            return list(readers.json_pieces(archive, archive.infolist()[0]))

    def parsed(found):
        return [row for piece in found for rows in readers.parse_piece(piece, readers.Notes(), ["a", "b", "c"]) for row in rows.to_pylist()]

    for between in (", ", ",", ",\n", " ,\t"):
        rows = ["{" + f'"a": {i}, "b": "é{{}}", "c": [{{"x": 1}}{between}{{"x": 2}}]' + "}" for i in range(100)]
        found = pieces((" [" + between.join(rows) + "]\n").encode())
        assert None not in found and len(found) > 10, between
        assert [r["a"] for r in parsed(found)] == [str(i) for i in range(100)], between
    whole = (b"", b"[]", b"[{}]", b'{"a": 1}', b'[{"a": 1}]', b'[1, {"a": 1}]', '[{"a": 1}, {"a": 2}]'.encode("utf-16"), b'\xef\xbb\xbf[{"a": 1},{"a": 2}]')
    assert all(pieces(text) == [None] for text in whole)
    assert pieces(b'[{"a": 1},{"a": 2}] x')[-1] is None
    rows = b",".join(b'{"a": %d}' % i for i in range(100))
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as archive:
        archive.writestr("a.json", b"[" + rows + b"]")
        archive.writestr("a.txt", b"[" + rows + b"]")
    with zipfile.ZipFile(tmp_path / "p.zip") as archive:
        assert list(readers.json_pieces(archive, archive.infolist()[0], 100)) == [None]
        assert list(readers.json_pieces(archive, archive.infolist()[1])) == [None]
