"""The source registry: declared sources become a list of expected files.

A registry is a DataFrame with one row per source:

    source_name string, ordinal int, enabled boolean, base_url string,
    airflow_conn string, has_airflow_conn boolean, dag_ids array<string>,
    endpoints array<struct<path string, dataset_name string, declared string>>,
    keywords array<struct<name string, choices array<string>>>

``declared`` is the text of the endpoint as written; an endpoint lacking a part has
null there. Keyword products are numbered, and every number is decoded on its own,
so a backfill of many days and keywords is spread over tasks and no row holds it all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratework import fixed_values as fixed
from cratework.functions.paths import fill

REGISTRY_SCHEMA = (
    "source_name string, ordinal int, enabled boolean, base_url string, airflow_conn string, "
    "has_airflow_conn boolean, dag_ids array<string>, "
    "endpoints array<struct<path: string, dataset_name: string, declared: string>>, "
    "keywords array<struct<name: string, choices: array<string>>>"
)
# Combinations decoded by one input row.
COMBOS_PER_ROW = 4096


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry from a YAML file (configuration: read once, on the driver)."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return registry_from_dict(spark, yaml.safe_load(handle) or {})


def registry_from_dict(spark: SparkSession, sources: Mapping[str, dict]) -> DataFrame:
    """Registry from a mapping of source name to its fields."""
    rows = [_source_row(ordinal, name, fields) for ordinal, (name, fields) in enumerate(sources.items())]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def _source_row(ordinal: int, name: str, fields: dict) -> tuple:
    enabled = fields["enabled"] if "enabled" in fields else True
    endpoints = [
        (
            _text(e.get("path")) if isinstance(e, dict) else None,
            _text(e.get("dataset_name")) if isinstance(e, dict) else None,
            str(e),
        )
        for e in fields.get("endpoints") or []
    ]
    keywords = [(k, [str(v) for v in choices]) for k, choices in (fields.get("keywords") or {}).items()]
    return (
        name,
        ordinal,
        bool(enabled),
        fields.get("base_url"),
        fields.get("airflow_conn"),
        "airflow_conn" in fields,
        fields.get("dag_ids"),
        endpoints,
        keywords,
    )


def _text(value) -> str | None:
    return None if value is None else str(value)


def select_sources(registry: DataFrame, dag_id: str) -> DataFrame:
    """Enabled sources attached to a job; the others are never validated."""
    attached = F.coalesce(F.array_contains("dag_ids", dag_id), F.lit(False))
    return registry.where(attached & F.col("enabled"))


def source_errors(allowed_schemes: list[str]) -> Column:
    """Validation messages of a source, in a fixed order; empty where it is sound."""
    source, url = F.col("source_name"), F.col("base_url")
    scheme = F.substring_index(url, "://", 1)
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    known = url.contains("://") & scheme.isin(*allowed_schemes)
    no_endpoints = F.coalesce(F.size("endpoints"), F.lit(0)) <= 0
    url_error = (
        F.when(url.isNull(), fill(fixed.MSG_NO_BASE_URL, source=source))
        .when(
            ~known,
            fill(fixed.MSG_BAD_SCHEME, source=source, base_url=url, schemes=F.lit(str(list(allowed_schemes)))),
        )
        .when(F.rtrim(rest, F.lit("/")) == "", fill(fixed.MSG_NOTHING_AFTER_SCHEME, source=source, base_url=url))
    )
    endpoint_errors = F.transform(
        F.filter("endpoints", lambda e: e["path"].isNull() | e["dataset_name"].isNull()),
        lambda e: fill(fixed.MSG_BAD_ENDPOINT, source=source, endpoint=e["declared"]),
    )
    missing = F.array(fill(fixed.MSG_NO_ENDPOINTS, source=source))
    return F.concat(
        F.array_compact(F.array(url_error)),
        F.when(no_endpoints, missing).otherwise(endpoint_errors),
    )


def keyword_product(sources: DataFrame) -> DataFrame:
    """One row per source and keyword combination, the last keyword turning fastest.

    No keywords give one empty combination; a keyword without choices gives none.
    """
    sizes = F.transform("keywords", lambda k: F.size(k["choices"]).cast("bigint"))
    total = F.aggregate(sizes, F.lit(1).cast("bigint"), lambda acc, n: acc * n)
    # Steps between two choices of the same keyword: the product of all later sizes.
    strides = F.transform(
        "keywords",
        lambda k, i: F.aggregate(
            F.slice("sizes", i + 2, F.size("sizes")), F.lit(1).cast("bigint"), lambda acc, n: acc * n
        ),
    )
    counted = (
        sources.withColumn("keywords", F.coalesce("keywords", F.array().cast("array<struct<name:string,choices:array<string>>>")))
        .withColumn("sizes", sizes)
        .withColumn("strides", strides)
        .withColumn("total", total)
        .where("total > 0")
    )
    step = F.lit(COMBOS_PER_ROW).cast("bigint")
    ranges = counted.withColumn("first_combo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, step)))
    spread = ranges.repartition("source_name", "first_combo")
    last = F.least(F.col("total"), F.col("first_combo") + COMBOS_PER_ROW) - 1
    picked = F.transform(
        "keywords",
        lambda k, i: F.struct(
            k["name"].alias("name"),
            F.get(
                k["choices"],
                (F.expr("combo") / F.get("strides", i)).cast("bigint") % F.get("sizes", i),
            ).alias("value"),
        ),
    )
    return (
        spread.withColumn("combo", F.explode(F.sequence("first_combo", last)))
        .withColumn("params", picked)
        .drop("sizes", "strides", "total", "first_combo")
    )


def format_template(template: Column, params: Column) -> tuple[Column, Column]:
    """(filled text, error cause) of a ``{name}`` template over a name -> value map.

    The template is read from left to right, as Python reads it: a doubled brace is a
    literal brace, a field ends at the next closing brace. Values that contain braces are
    left alone. Format specs, attributes and indexes are not part of the registry
    language: such a field counts as an undefined parameter.
    """
    pieces = F.regexp_extract_all(template, F.lit(r"\{\{|\}\}|\{[^{}]*\}|\{|\}|[^{}]+"), F.lit(0))
    pieces = F.when(template == "", F.array(F.lit(""))).otherwise(pieces)

    def is_field(piece: Column) -> Column:
        return piece.rlike(r"(?s)^\{[^{}]*\}$")

    def field(piece: Column) -> Column:
        return F.regexp_extract(piece, r"(?s)^\{(.*)\}$", 1)

    def opens(piece: Column) -> Column:
        return piece.startswith("{")

    def cause(piece: Column, at: Column) -> Column:
        index = F.when(field(piece) == "", "0").otherwise(F.regexp_replace(field(piece), r"^0+(?=\d)", ""))
        undefined = is_field(piece) & ~F.map_contains_key(params, field(piece))
        return (
            F.when(is_field(piece) & field(piece).rlike(r"^\d*$"), fill(fixed.CAUSE_POSITIONAL, index=index))
            .when(undefined, F.concat(F.lit("'"), field(piece), F.lit("'")))
            .when((piece == "{") & (at + 1 == F.size(pieces)), F.lit(fixed.CAUSE_LAST_BRACE))
            .when((piece == "{") & F.exists(F.slice(pieces, at + 2, F.size(pieces)), opens), F.lit(fixed.CAUSE_INNER_BRACE))
            .when(piece == "{", F.lit(fixed.CAUSE_OPEN_BRACE))
            .when(piece == "}", F.lit(fixed.CAUSE_CLOSE_BRACE))
        )

    def filled(piece: Column) -> Column:
        return (
            F.when(is_field(piece), F.element_at(params, field(piece)))
            .when(piece == "{{", "{")
            .when(piece == "}}", "}")
            .otherwise(piece)
        )

    error = F.get(F.filter(F.transform(pieces, cause), lambda c: c.isNotNull()), F.lit(0))
    return F.when(error.isNull(), F.array_join(F.transform(pieces, filled), "")), error


def format_endpoints(sources: DataFrame, runtime: Mapping[str, str]) -> DataFrame:
    """Every endpoint of every keyword combination with its templates filled.

    Runtime parameters win over keywords of the same name. ``position`` orders the
    rows of a source: combinations outside, endpoints inside.
    """
    given = [F.struct(F.lit(k).alias("name"), F.lit(str(v)).alias("value")) for k, v in runtime.items()]
    names = F.array(*[F.lit(k) for k in runtime]).cast("array<string>")
    kept = F.filter("params", lambda p: ~F.array_contains(names, p["name"]))
    entries = F.concat(kept, F.array(*given)) if given else F.col("params")
    params = F.map_from_entries(F.transform(entries, lambda p: F.struct(p["name"], p["value"])))
    combos = keyword_product(sources).withColumn("params", params)
    rows = combos.select("*", F.posexplode("endpoints").alias("endpoint_no", "endpoint"))
    path, path_cause = format_template(F.col("endpoint.path"), F.col("params"))
    dataset, dataset_cause = format_template(F.col("endpoint.dataset_name"), F.col("params"))
    cause = F.coalesce(path_cause, dataset_cause)
    return rows.select(
        "source_name",
        "ordinal",
        "base_url",
        "airflow_conn",
        "has_airflow_conn",
        F.struct("combo", "endpoint_no").alias("position"),
        path.alias("path"),
        dataset.alias("dataset_name"),
        F.when(
            cause.isNotNull(),
            fill(
                fixed.MSG_BAD_TEMPLATE,
                path=F.col("endpoint.path"),
                dataset_name=F.col("endpoint.dataset_name"),
                source=F.col("source_name"),
                cause=cause,
            ),
        ).alias("error"),
    )


def dedupe_endpoints(formatted: DataFrame) -> DataFrame:
    """Equal (path, dataset) pairs of a source once, at their first position."""
    same = ["source_name", "ordinal", "base_url", "airflow_conn", "has_airflow_conn", "path", "dataset_name"]
    return formatted.groupBy(*same).agg(F.min("position").alias("position"))


def resolve(
    registry: DataFrame, dag_id: str, allowed_schemes: list[str], runtime: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(endpoints of sound sources, errors of the others) for a job.

    A malformed source never holds up the others: its messages are returned as
    (source_name, ordinal, errors).
    """
    checked = select_sources(registry, dag_id).withColumn("errors", source_errors(allowed_schemes))
    formatted = format_endpoints(checked.where(F.size("errors") == 0), runtime or {})
    # Only the first template error of a source is reported.
    bad = formatted.groupBy("source_name", "ordinal").agg(
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("position"))).alias("error")
    ).where("error is not null")
    sound = formatted.join(bad.select("source_name"), "source_name", "left_anti")
    errors = (
        checked.where(F.size("errors") > 0)
        .select("source_name", "ordinal", "errors")
        .unionByName(bad.select("source_name", "ordinal", F.array("error").alias("errors")))
    )
    return dedupe_endpoints(sound), errors


def work_list(endpoints: DataFrame, default_conn: str) -> DataFrame:
    """One row per file to land. A connection that is declared null stays null."""
    location = F.regexp_replace("base_url", r"(?s)^.*?://", "")
    return endpoints.select(
        "source_name",
        "dataset_name",
        F.rtrim(location, F.lit("/")).alias("bucket"),
        F.col("path").alias("key"),
        F.when(F.col("has_airflow_conn"), F.col("airflow_conn")).otherwise(F.lit(default_conn)).alias("aws_conn_id"),
        "ordinal",
        "position",
    )


def error_report(errors: DataFrame) -> DataFrame:
    """All malformed sources as one HTML text, in declared order (one row, one e-mail)."""
    item = fill(fixed.ERRORS_ITEM, source=F.col("source_name"), messages=F.array_join("errors", "; "))
    items = F.array_sort(F.collect_list(F.struct("ordinal", item.alias("item"))))
    return errors.agg(
        F.concat(
            F.lit(fixed.ERRORS_HEAD),
            F.array_join(F.transform(items, lambda i: i["item"]), ""),
            F.lit(fixed.ERRORS_TAIL),
        ).alias("message")
    )
