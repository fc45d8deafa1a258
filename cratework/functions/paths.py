"""Layer keys and file names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratework import fixed_values as fixed


def fill(template: str, **parts: Column) -> Column:
    """A ``{name}`` template filled with columns."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        text, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += ([F.lit(text)] if text else []) + [parts[name]]
    return F.concat(*pieces, *([F.lit(rest)] if rest else []))


def base_name(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def file_stem(name: Column) -> Column:
    """File name without its last extension; a name that only starts with dots keeps all."""
    return F.regexp_replace(name, r"^(\.*[^.].*)\.[^.]*$", "$1")


def extension(path: Column) -> Column:
    """Lower-cased text after the last dot of the file name, empty if there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"^\.*[^.].*\.([^.]*)$", 1))


def landing_key(source_name: Column, source_key: Column, dataset_name: Column, date: Column) -> Column:
    """Key of a landed file; only the last part of the source key is kept."""
    return fill(
        fixed.LANDING_KEY,
        source_name=source_name,
        dataset_name=dataset_name,
        date=date,
        file_name=base_name(source_key),
    )


def is_landing_key(key: Column) -> Column:
    """Exactly four segments, the third one with an equals sign."""
    parts = F.split(key, "/")
    return (F.size(parts) == 4) & F.coalesce(F.get(parts, F.lit(2)).contains("="), F.lit(False))


def landing_part(key: Column, name: str) -> Column:
    """One part of a landing key: source_name, dataset_name, ingest_date or zip_name."""
    parts = F.split(key, "/")
    if name == "source_name":
        return F.get(parts, F.lit(0))
    if name == "dataset_name":
        return F.get(parts, F.lit(1))
    if name == "ingest_date":
        return F.regexp_extract(F.get(parts, F.lit(2)), r"^[^=]*=(.*)$", 1)
    if name == "zip_name":
        return file_stem(F.get(parts, F.lit(3)))
    raise KeyError(name)


def bronze_key(key: Column) -> Column:
    """Bronze key of a landed archive, null where the key has not the landing layout."""
    filled = fill(
        fixed.BRONZE_KEY,
        source_name=landing_part(key, "source_name"),
        dataset_name=landing_part(key, "dataset_name"),
        date=landing_part(key, "ingest_date"),
        zip_stem=landing_part(key, "zip_name"),
    )
    return F.when(is_landing_key(key), filled)


def schema_status_key(key: Column, status: Column) -> Column:
    """Bronze key of the rows of one archive with the given schema status."""
    return fill(fixed.SCHEMA_STATUS_KEY, bronze_key=bronze_key(key), schema_status=status)


def flat_member_name(member: Column) -> Column:
    """Member path as one file name."""
    return F.replace(member, F.lit("/"), F.lit("__"))


def member_from_part(key: Column) -> Column:
    """Flat member name of a written part file."""
    return F.regexp_replace(base_name(key), r"^(.*)_part-.*$", "$1")
