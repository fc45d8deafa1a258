"""The schema contract: expected schemas and how members compare with them."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratework import fixed_values as fixed

# Expected columns per dataset, data columns only.
EXPECTED_COLUMNS = {
    "daily_trades": ["id", "price", "qty", "quote_qty", "time", "is_buyer_maker"],
}


def text_schema(columns: list[str]) -> T.StructType:
    """A bronze schema: every column nullable text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


EXPECTED_SCHEMAS = {name: text_schema(columns) for name, columns in EXPECTED_COLUMNS.items()}


def expected_schema(dataset: str, schemas: dict[str, T.StructType] = EXPECTED_SCHEMAS) -> T.StructType:
    """Expected schema of a dataset; KeyError where the registry has none."""
    return schemas[dataset]


def schema_status(observed: Column, dataset: Column, schemas: dict[str, T.StructType]) -> Column:
    """valid or invalid for an observed schema text; null for an unknown dataset.

    Names, order, types and nullability all count.
    """
    status = F.lit(None).cast("string")
    for name, schema in schemas.items():
        same = F.when(observed == schema.json(), fixed.VALID).otherwise(fixed.INVALID)
        status = F.when(dataset == name, same).otherwise(status)
    return status


def fits_a_table(schema_text: str, reserved: tuple[str, ...]) -> bool:
    """Whether members of this schema can be a table: no clash of names in any struct."""

    def clash_free(node: dict, taken: tuple[str, ...]) -> bool:
        names = [field["name"].lower() for field in node["fields"]]
        if len(set(names)) < len(names) or set(names) & set(taken):
            return False
        return all(clash_free(inner, ()) for field in node["fields"] for inner in structs(field["type"]))

    def structs(kind) -> list[dict]:
        if not isinstance(kind, dict):
            return []
        if kind["type"] == "struct":
            return [kind]
        return structs(kind.get("elementType"))

    return clash_free(json.loads(schema_text), reserved)
