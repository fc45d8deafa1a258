"""Relational rules as data-quality checks.

A check passes on null, as in SQL. All row rules of a table are counted in one scan;
key rules reduce to one row per key before anything is compared, so a hot key weighs
as much as any other.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cratework.sources.erp import ForeignKey, Table
from cratework.staging import free_shuffles

REPORT_COLUMNS = ("table_name", "rule_kind", "rule", "violations")


def violates(predicate: str) -> Column:
    """True where the predicate is false; null passes."""
    return F.coalesce(F.expr(predicate) == F.lit(False), F.lit(False))


def outside(column: str, allowed: tuple[str, ...]) -> Column:
    """True where a value is present but not in the list."""
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(False))


def row_rules(table: Table) -> list[tuple[str, str, Column]]:
    """(kind, rule, violation) of each rule that one row decides."""
    return [
        *[("not_null", column, F.col(column).isNull()) for column in table.not_null],
        *[("check", predicate, violates(predicate)) for predicate in table.checks],
        *[("domain", column, outside(column, values)) for column, values in table.domains.items()],
    ]


def count_row_rules(df: DataFrame, name: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Violations of every row rule, in one pass over the table."""
    counts = df.agg(*[F.count_if(violation).alias(f"r{i}") for i, (_, _, violation) in enumerate(rules)])
    entries = [
        F.struct(F.lit(kind).alias("rule_kind"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (kind, rule, _) in enumerate(rules)
    ]
    return counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*entries))).select(*REPORT_COLUMNS)


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key value, without keys that have a null part.

    All key rules start from this, so that Spark shuffles the same key of the same
    table once, however many rules need it.
    """
    present = functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their counts; a null is never equal."""
    return key_counts(df, keys).where("n > 1")


def missing_parents(child: DataFrame, parent: DataFrame, key: ForeignKey) -> DataFrame:
    """Child key values without a parent row, with the number of child rows.

    A key with a null part passes.
    """
    used = key_counts(child, list(key.columns))
    known = key_counts(parent, list(key.parent_columns)).select(
        *[F.col(p).alias(c) for c, p in zip(key.columns, key.parent_columns)]
    )
    return used.join(known, list(key.columns), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: ForeignKey) -> DataFrame:
    """Child rows without a parent row."""
    present = functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in key.columns])
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(key.columns, key.parent_columns)])
    return child.where(present).join(known, list(key.columns), "left_anti").select(*child.columns)


def failing_rows(df: DataFrame, table: Table) -> DataFrame:
    """Rows that break a row rule, with the names of the rules."""
    broken = F.array_compact(F.array(*[F.when(v, F.lit(f"{kind}: {rule}")) for kind, rule, v in row_rules(table)]))
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


OWN = -1
# Rows of a table whose keys are sorted and packed at a time.
PACKED_ROWS = 1 << 19
# Uses of keys that one task counts, and that are shuffled before the shuffle files are let go.
TASK_USES = 1 << 21
PASS_USES = 1 << 28
PACKED_SCHEMA = "bucket int, domain int, slot int, width int, keys binary, times binary"

Use = tuple[int, tuple[str, ...], int]


def _key_hashes(columns) -> list[Column]:
    """A key's parts, as text, in 96 bits: two hashes of different kinds, of the parts in their order; null where a part is."""
    texts = [F.col(c).cast("string") for c in columns]
    whole = functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return [F.when(whole, F.xxhash64(*texts)), F.when(whole, F.hash(*texts))]


def pack_uses(df: DataFrame, uses: list[Use], bits: int) -> DataFrame:
    """Every use of a key (domain, columns, slot) in packed form, in one pass over the table.

    Keys are dealt out to 2 ** bits buckets by the first bits of their hash. Of some hundred thousand rows the
    keys of a use are sorted, those that repeat become one with a count, and ``keys`` has for each the distance of
    the first hash from the one before, in ``width`` bytes, and the second hash: about ten bytes for a key.
    """
    out = to_arrow_schema(T.StructType.fromDDL(PACKED_SCHEMA))
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits if bits else 0)

    def packed(number: int, domain: int, slot: int, rows: pa.Table) -> pa.RecordBatch | None:
        key = rows.column(2 * number).drop_null().to_numpy().view(np.uint64)
        other = rows.column(2 * number + 1).drop_null().to_numpy().view(np.uint32)
        if not len(key):
            return None
        order = np.argsort(key)
        key, other = key[order], other[order]
        new = np.append(True, (key[1:] != key[:-1]) | (other[1:] != other[:-1]))
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(key))).astype(np.uint32)
        key, other = key[first], other[first]
        cuts = np.append(np.searchsorted(key, edges), len(key))
        filled = np.flatnonzero(np.diff(cuts))
        step = np.append(key[:1], np.diff(key))
        step[cuts[filled]] = key[cuts[filled]] - edges[filled]
        width = max((int(step.max()).bit_length() + 7) // 8, 1)
        data = np.empty((len(key), width + 4), np.uint8)
        data[:, :width] = step.view(np.uint8).reshape(-1, 8)[:, :width]
        data[:, width:] = other.view(np.uint8).reshape(-1, 4)

        def cut(values: np.ndarray, size: int) -> pa.Array:
            offsets = (np.append(cuts[filled], len(key)) * size).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(filled), [None, pa.py_buffer(offsets), pa.py_buffer(values)])

        once = len(first) == len(new)
        labels = [pa.repeat(pa.scalar(v, pa.int32()), len(filled)) for v in (domain, slot, width)]
        counts = pa.nulls(len(filled), pa.binary()) if once else cut(times, 4)
        return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *labels, cut(data, width + 4), counts], schema=out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            if n >= PACKED_ROWS or (batch is None and n):
                rows = pa.Table.from_batches(held)
                found = (packed(i, domain, slot, rows) for i, (domain, _, slot) in enumerate(uses))
                yield from (batch for batch in found if batch is not None)
                held, n = [], 0

    hashes = [h for _, columns, _ in uses for h in _key_hashes(columns)]
    return df.select(*[h.alias(f"h{i}") for i, h in enumerate(hashes)]).mapInArrow(pack, PACKED_SCHEMA)


def count_uses(packed: DataFrame, bits: int) -> DataFrame:
    """(domain, slot, n) of packed uses: keys that own more than one row, and rows that refer to a key nobody owns."""
    schema = "domain int, slot int, n bigint"
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def unpacked(width: int, keys: bytes, times: bytes | None) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(keys, np.uint8).reshape(-1, width + 4)
        steps = np.zeros((len(data), 8), np.uint8)
        steps[:, :width] = data[:, :width]
        many = np.ones(len(data), np.int64) if times is None else np.frombuffer(times, np.uint32).astype(np.int64)
        # All keys here are of one bucket, so what they begin with does not matter.
        return np.cumsum(steps.view(np.uint64).ravel()), data[:, width:].copy().view(np.uint32).ravel(), many

    def counted(parts: list[tuple]) -> Iterator[tuple[int, int]]:
        key, other, times = (np.concatenate([part[i] for part in parts]) for i in (1, 2, 3))
        slot = np.concatenate([np.full(len(part[1]), part[0], np.int16) for part in parts])
        order = np.argsort(key)
        if np.any((key[order][1:] == key[order][:-1]) & (other[order][1:] != other[order][:-1])):
            order = np.lexsort((other, key))
        key, other, times, slot = key[order], other[order], times[order], slot[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (other[1:] != other[:-1])))
        own = np.add.reduceat(np.where(slot == OWN, times, 0), first)
        yield OWN, int(np.count_nonzero(own > 1))
        for i in np.unique(slot[slot != OWN]):
            yield int(i), int(np.add.reduceat(np.where(slot == i, times, 0), first)[own == 0].sum())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["slot"], *unpacked(row["width"], row["keys"], row["times"]))
                parts.setdefault(row["domain"], []).append(own)
        for domain in list(parts):
            rows = [{"domain": domain, "slot": slot, "n": n} for slot, n in counted(parts.pop(domain))]
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return packed.repartitionById(1 << bits, F.col("bucket")).mapInArrow(count, schema).groupBy("domain", "slot").agg(F.sum("n").alias("n"))


def _passes(uses: dict[str, list[Use]], sizes: Mapping[str, int]) -> list[tuple[set[int], int]]:
    """Domains in groups of about PASS_USES uses of keys, with the number of uses."""
    weights: dict[int, int] = {}
    for name, listed in uses.items():
        for domain, _, _ in listed:
            weights[domain] = weights.get(domain, 0) + sizes[name]
    groups: list[tuple[set[int], int]] = []
    for domain, weight in weights.items():
        if groups and groups[-1][1] + weight <= PASS_USES:
            groups[-1] = (groups[-1][0] | {domain}, groups[-1][1] + weight)
        else:
            groups.append(({domain}, weight))
    return groups


def _count_keys(tables: Mapping[str, DataFrame], uses: dict[str, list[Use]]) -> dict[tuple[int, int], int]:
    """Violations of every key rule, by domain and slot."""
    used = {name: listed for name, listed in uses.items() if listed}
    if not used:
        return {}
    spark = next(iter(tables.values())).sparkSession
    rows = [tables[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name in used]
    sizes = {r["name"]: r["n"] for r in functools.reduce(DataFrame.unionByName, rows).collect()}
    found: dict[tuple[int, int], int] = {}
    for domains, n in _passes(used, sizes):
        bits = max(n // TASK_USES, 1).bit_length() - 1
        wanted = {name: [use for use in listed if use[0] in domains] for name, listed in used.items()}
        packed = [pack_uses(tables[name], listed, bits) for name, listed in wanted.items() if listed]
        counts = count_uses(functools.reduce(DataFrame.unionByName, packed), bits).collect()
        found |= {(r["domain"], r["slot"]): r["n"] for r in counts}
        del packed
        free_shuffles(spark)
    return found


def constraint_report(tables: Mapping[str, DataFrame], rules: Mapping[str, Table]) -> DataFrame:
    """(table, kind, rule, violations) of every rule of every given table.

    Key rules count the violating key values (unique) or child rows (foreign). A
    foreign key whose parent table is not given is left out.

    Two passes over each table: one counts all row rules; the other packs every use of a key, and those of
    one bucket of hashes meet in one task, the rows that own a key and those that refer to it (summed
    per task before the shuffle). So reads and shuffles do not grow with the rules. Of large tables the keys are
    counted in several passes, each over a few keys and their columns only, so that the disk holds the shuffle of
    one pass. Keys meet by 96 bits of hash: of a billion keys of one domain, two are taken for one in fewer
    than one of 10**10 reports. Key rules are counted at once, not when the report is read.
    """
    stated: list[tuple[int, int, str, str, str]] = []
    uses: dict[str, list[Use]] = {name: [] for name in tables}
    domains: dict[tuple[str, tuple[str, ...]], int] = {}
    slots: dict[int, int] = {}

    def domain(name: str, columns: tuple[str, ...]) -> int:
        """The keys that these columns of a table own, by number."""
        number = domains.setdefault((name, columns), len(domains))
        if number not in slots:
            slots[number] = 0
            uses[name].append((number, columns, OWN))
        return number

    for name in tables:
        for keys in rules[name].unique:
            stated.append((domain(name, tuple(keys)), OWN, name, "unique", ", ".join(keys)))
        for key in rules[name].foreign:
            if key.parent in tables:
                owner = domain(key.parent, tuple(key.parent_columns))
                uses[name].append((owner, tuple(key.columns), slots[owner]))
                stated.append((owner, slots[owner], name, "foreign", f"{', '.join(key.columns)} -> {key.parent}"))
                slots[owner] += 1
    row_counts = [count_row_rules(df, name, row_rules(rules[name])) for name, df in tables.items() if row_rules(rules[name])]
    counts = _count_keys(tables, uses)
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, kind, rule, counts.get((owner, slot), 0)) for owner, slot, name, kind, rule in stated]
    found = spark.createDataFrame(rows, "table_name string, rule_kind string, rule string, violations bigint")
    return functools.reduce(DataFrame.unionByName, row_counts, found)
