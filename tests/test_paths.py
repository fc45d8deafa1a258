import posixpath

import pytest
from pyspark.sql import functions as F

from cratework import files
from cratework.functions import paths


def values(spark, texts, build):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("t"))).collect()]


def test_layer_keys(spark):
    key = "in/2031/week 9/lots.v2.zip"
    landed = values(spark, [key], lambda c: paths.landing_key(F.lit("depot"), c, F.lit("shelves"), F.lit("2031-02-28")))
    assert landed == ["depot/shelves/ingest_date=2031-02-28/lots.v2.zip"]
    assert values(spark, landed, paths.bronze_key) == [
        "depot/shelves/ingest_date=2031-02-28/zip_name=lots.v2"
    ]
    assert values(spark, landed, lambda c: paths.schema_status_key(c, F.lit("valid"))) == [
        "depot/shelves/ingest_date=2031-02-28/zip_name=lots.v2/schema_status=valid"
    ]
    assert values(spark, ["a/b/c.zip", "a/b/c/d/e", "a/b/date/c.zip"], paths.bronze_key) == [None, None, None]


NAMES = ["a.zip", "a.tar.gz", ".zip", "noext", "a.", "..zip", "a..zip", "x.y.CSV", "a.b/c", "d.x/.hidden", "é.Json"]


def test_stems_and_extensions_follow_the_usual_rules(spark):
    stems = [posixpath.splitext(posixpath.basename(n))[0] for n in NAMES]
    kinds = [posixpath.splitext(n)[1].lstrip(".").lower() for n in NAMES]
    assert values(spark, NAMES, lambda c: paths.file_stem(paths.base_name(c))) == stems
    assert values(spark, NAMES, paths.extension) == kinds


def test_member_names(spark):
    assert values(spark, ["west/in/lots.csv", "top.csv"], paths.flat_member_name) == ["west__in__lots.csv", "top.csv"]
    parts = ["x/schema_status=invalid/a.csv_part-0.parquet", "x/sub__b_part-1.json_part-12.parquet"]
    assert values(spark, parts, paths.member_from_part) == ["a.csv", "sub__b_part-1.json"]


@pytest.mark.parametrize("name", ["plain", "007", "a b", "x=y", "50%", "a:b", "q?*", "[x]{y}", "it's", "#1", "ü"])
def test_partition_folders_are_named_as_spark_names_them(spark, tmp_path, name):
    out = str(tmp_path / "t")
    spark.createDataFrame([(1, name)], "v int, zip_name string").write.partitionBy("zip_name").parquet(out)
    folder = f"{out}/{files.partition_dir('zip_name', name)}"
    found = files.glob(spark, f"{out}/{files.glob_text(files.partition_dir('zip_name', name))}")
    assert files.delete_tree(folder)
    assert [f.removeprefix("file:") for f in found] == [folder]
    assert not files.delete_tree(folder)
