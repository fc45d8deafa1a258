import pytest
from pyspark.sql import functions as F

from cratework.sources import registry as reg

SCHEMES = ["s3", "https"]
GOOD = [{"path": "shelf/{{x}}.csv", "dataset_name": "shelves"}]
LAID = "shelf/{x}.csv"


def errors_of(spark, fields, name="depot"):
    df = reg.registry_from_dict(spark, {name: fields})
    return df.select(reg.source_errors(SCHEMES)).first()[0]


@pytest.mark.parametrize(
    "fields, expected",
    [
        ({"base_url": "s3://depot-west", "endpoints": GOOD}, []),
        (
            {"base_url": "sftp://depot-west", "endpoints": GOOD},
            ["Source 'depot' has base_url 'sftp://depot-west'; expected one of ['s3', 'https'] as the scheme."],
        ),
        (
            {"base_url": "depot-west:22/in", "endpoints": GOOD},
            ["Source 'depot' has base_url 'depot-west:22/in'; expected one of ['s3', 'https'] as the scheme."],
        ),
        (
            {"base_url": "https://", "endpoints": GOOD},
            ["Source 'depot' has nothing after the scheme in base_url 'https://'."],
        ),
        (
            {},
            [
                "Source 'depot' must have a 'base_url'.",
                "At least one endpoint is required: the depot source has no endpoints.",
            ],
        ),
        (
            {"base_url": "s3://b", "endpoints": [{"dataset_name": "lots"}, 17]},
            [
                "Source 'depot' has an endpoint that is missing 'path' or 'dataset_name': {'dataset_name': 'lots'}",
                "Source 'depot' has an endpoint that is missing 'path' or 'dataset_name': 17",
            ],
        ),
    ],
)
def test_validation_messages(spark, fields, expected):
    assert errors_of(spark, fields) == expected


def endpoints(spark, fields, **runtime):
    df = reg.registry_from_dict(spark, {"depot": {"base_url": "s3://b", "dag_ids": ["d"], **fields}})
    good, bad = reg.resolve(df, "d", SCHEMES, runtime)
    rows = [(r["path"], r["dataset_name"]) for r in good.orderBy("position").collect()]
    return rows, [m for r in bad.collect() for m in r["errors"]]


def test_templates_without_and_with_values_of_the_run(spark):
    fields = {
        "endpoints": [
            {"path": "lists/depots.csv.zip", "dataset_name": "depots"},
            {"path": "{shift}/tills-{till}.zip", "dataset_name": "tills_{shift}"},
        ]
    }
    want = [("lists/depots.csv.zip", "depots"), ("night/tills-0042.zip", "tills_night")]
    assert endpoints(spark, fields, shift="night", till="0042") == (want, [])


def test_keyword_product_order_and_precedence(spark):
    fields = {
        "endpoints": [{"path": "{a}/{b}", "dataset_name": "{a}_x"}, {"path": "{b}", "dataset_name": "{c}"}],
        "keywords": {"a": ["1", "2"], "b": ["x", "y", "z"], "c": ["kw"]},
    }
    rows, bad = endpoints(spark, fields, c="run")
    assert bad == []
    assert rows == [
        ("1/x", "1_x"), ("x", "run"), ("1/y", "1_x"), ("y", "run"), ("1/z", "1_x"), ("z", "run"),
        ("2/x", "2_x"), ("2/y", "2_x"), ("2/z", "2_x"),
    ]


def test_large_product_is_complete(spark):
    fields = {
        "endpoints": [{"path": "{a}-{b}-{c}", "dataset_name": "d"}],
        "keywords": {"a": list(range(30)), "b": list(range(20)), "c": list(range(25))},
    }
    df = reg.registry_from_dict(spark, {"s": {"base_url": "s3://b", "dag_ids": ["d"], **fields}})
    good, _ = reg.resolve(df, "d", SCHEMES)
    assert good.select("path").distinct().count() == 15000


def test_duplicates_empty_keyword_and_braces(spark):
    twice = {"endpoints": [{"path": "{b}/data", "dataset_name": "f"}], "keywords": {"b": ["r", "r"]}}
    assert endpoints(spark, twice) == ([("r/data", "f")], [])
    assert endpoints(spark, {**twice, "keywords": {"b": []}}) == ([], [])
    braces = {"endpoints": [{"path": "{{x}}/{b}", "dataset_name": "f"}], "keywords": {"b": ["{c}"], "c": ["no"]}}
    assert endpoints(spark, braces) == ([("{x}/{c}", "f")], [])


TEMPLATES = [
    "{{{a}}}", "{a}{{}}", "{{{{a}}}}", "x{a}y{b}", "", "{{", "}}", "{", "x/{", "{a", "a}", "{a}}", "{}", "{1}", "x{0}", "{{{b}}}{",
    "{no}", "{a}{no}{", "}{a}", "{a{b}", "{07}", "a\nb{a}",
]


@pytest.mark.parametrize("path", TEMPLATES)
def test_templates_are_read_as_python_reads_them(spark, path):
    values = {"a": "{b}", "b": "V"}
    fields = {"endpoints": [{"path": path, "dataset_name": "lots"}], "keywords": {k: [v] for k, v in values.items()}}
    rows, bad = endpoints(spark, fields)
    try:
        want, cause = path.format(**values), None
    except (KeyError, IndexError, ValueError) as error:
        cause = str(error)
    if cause is None:
        assert (rows, bad) == ([(want, "lots")], [])
    else:
        assert rows == []
        assert bad == [
            f"Endpoint '{path}' or dataset name 'lots' in source 'depot' is invalid "
            f"or references an undefined parameter: {cause}"
        ]


def test_first_problem_of_a_source_is_told(spark):
    fields = {"endpoints": [{"path": "ok", "dataset_name": "{gone}_lots"}, {"path": "{z}", "dataset_name": "q"}]}
    rows, bad = endpoints(spark, fields)
    assert rows == [] and len(bad) == 1 and bad[0].endswith("undefined parameter: 'gone'")


def test_scope_disabled_and_isolation(spark):
    sources = {
        "mine": {"base_url": "s3://b", "endpoints": GOOD, "dag_ids": ["d1"]},
        "other": {"base_url": "s3://b", "endpoints": GOOD, "dag_ids": ["d2"]},
        "off": {"base_url": "ftp://b", "endpoints": GOOD, "dag_ids": ["d1"], "enabled": False},
        "off_null": {"base_url": "s3://b", "endpoints": GOOD, "dag_ids": ["d1"], "enabled": None},
        "never": {"base_url": "s3://b", "endpoints": GOOD},
        "never_too": {"base_url": "s3://b", "endpoints": GOOD, "dag_ids": []},
        "bad": {"base_url": "ftp://b", "endpoints": GOOD, "dag_ids": ["d1"]},
    }
    good, bad = reg.resolve(reg.registry_from_dict(spark, sources), "d1", SCHEMES)
    assert [r["source_name"] for r in good.collect()] == ["mine"]
    assert [r["source_name"] for r in bad.collect()] == ["bad"]


def test_work_list_connections_and_bucket(spark):
    sources = {
        "a": {"base_url": "s3://depot-west/2026/", "endpoints": GOOD, "dag_ids": ["d"], "airflow_conn": "mine"},
        "b": {"base_url": "s3://other", "endpoints": GOOD, "dag_ids": ["d"]},
        "c": {"base_url": "s3://third", "endpoints": GOOD, "dag_ids": ["d"], "airflow_conn": None},
    }
    good, _ = reg.resolve(reg.registry_from_dict(spark, sources), "d", SCHEMES)
    work = reg.work_list(good, "default").orderBy("ordinal")
    assert [(r["bucket"], r["key"], r["aws_conn_id"]) for r in work.collect()] == [
        ("depot-west/2026", LAID, "mine"),
        ("other", LAID, "default"),
        ("third", LAID, None),
    ]


def test_error_report(spark):
    errors = spark.createDataFrame(
        [("south", 4, ["no shelf"]), ("north", 2, ["late", "torn"])],
        "source_name string, ordinal int, errors array<string>",
    )
    assert reg.error_report(errors).first()[0] == (
        "Malformed sources:<ul><li><b>north</b>: late; torn</li><li><b>south</b>: no shelf</li></ul>"
    )


def test_yaml_file(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "sources.yaml"
    path.write_text(
        "market:\n  base_url: s3://bucket\n  dag_ids: [d]\n  endpoints:\n"
        "    - path: '{cat}/{sym}-{date}.zip'\n      dataset_name: 'daily_{cat}'\n"
        "  keywords:\n    sym: [B, E]\n    cat: [trades]\n"
    )
    good, bad = reg.resolve(reg.load_registry(spark, str(path)), "d", ["s3"], {"date": "2026-01-01"})
    assert [r["path"] for r in good.orderBy("position").collect()] == ["trades/B-2026-01-01.zip", "trades/E-2026-01-01.zip"]
    assert bad.where(F.lit(True)).count() == 0
