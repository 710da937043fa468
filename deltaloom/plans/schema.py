"""Schemas: flat types, target types, validation, evolution and migration."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BIG = T.DecimalType(38, 0)


@dataclass(frozen=True)
class Field:
    """A location of a document as a flat named field."""

    name: str
    types: tuple[str, ...]
    format: str | None = None
    required: bool = False
    content: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    max_length: int | None = None
    key: bool = False
    items: str | None = None
    meta: dict = field(default_factory=dict, compare=False)


def flat_type(f: Field) -> tuple[str, bool]:
    """(flat type, nullable) of a field (H1): null becomes nullability, several types ``multiple``."""
    kinds = sorted(set(f.types) - {"null"})
    nullable = "null" in f.types or not f.required
    if not kinds:
        return "never", True
    if set(kinds) == {"integer", "number"}:
        kinds = ["number"]
    if f.format in ("integer", "number") and not f.key and set(kinds) <= {"string", f.format, "integer"} and "string" in kinds:
        return f"string_{f.format}", nullable
    if len(kinds) > 1:
        return "multiple", nullable
    if kinds == ["string"] and f.meta.get("contentEncoding") == "base64" and f.content in (None, "application/octet-stream"):
        return "binary", nullable
    return kinds[0], nullable


def outside_long(f: Field) -> bool:
    return (f.minimum is not None and f.minimum < -(2**63)) or (f.maximum is not None and f.maximum >= 2**63)


#: Characters up to which text of a bounded length is varchar.
VARCHAR = 65_535
_TIMES = {"date": T.DateType(), "date-time": T.TimestampType()}


def spark_type(f: Field, cast_to_string: bool = False) -> T.DataType | None:
    """The column type of a field (H2); None for fields that are only null.

    A type that the user gave (``ddl`` in ``meta``) goes first, then text where all is cast to text. Text of a
    bounded length is varchar of that many characters; text that holds JSON (its content type) stays text.
    """
    kind, _ = flat_type(f)
    if f.meta.get("ddl"):
        return T.StructType.fromDDL(f"v {f.meta['ddl']}")["v"].dataType
    if cast_to_string:
        return T.StringType()
    if kind == "string" and f.format not in _TIMES and f.max_length is not None and f.content is None and 0 < f.max_length <= VARCHAR:
        return T.VarcharType(f.max_length)
    if kind == "string" and f.format in _TIMES:
        return _TIMES[f.format]
    if kind == "integer" or kind == "string_integer":
        return BIG if outside_long(f) or kind == "string_integer" else T.LongType()
    return {
        "never": None, "boolean": T.BooleanType(), "number": T.DoubleType(), "string_number": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType(),
        "array": T.ArrayType({"integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}.get(f.items or "", T.StringType())) if f.items else T.StringType(), "object": T.StringType(), "multiple": T.StringType(),
    }[kind]


def cast_field(f: Field, cast_to_string: bool = False) -> Column | None:
    """A document's raw column as the field's column (H1, H2)."""
    kind, target = flat_type(f)[0], spark_type(f, cast_to_string)
    c = F.col(f"`{f.name}`")
    if target is None:
        return None
    if kind == "binary":
        return F.unbase64(c).alias(f.name)
    if kind == "string_number":
        return F.when(c == "Infinity", float("inf")).when(c == "-Infinity", float("-inf")).otherwise(c.try_cast("double")).alias(f.name)
    if kind == "string_integer":
        return F.substring_index(c, ".", 1).try_cast(BIG).alias(f.name)
    return c.try_cast(target).alias(f.name)


def map_fields(df: DataFrame, fields: list[Field]) -> DataFrame:
    """The frame with its fields cast; only-null fields are dropped."""
    return df.select(*[c for f in fields if (c := cast_field(f)) is not None])


PARQUET_AS_STRING = ("time", "duration", "uuid")


def parquet_schema(fields: list[Field], as_string: tuple[str, ...] = PARQUET_AS_STRING, variant: bool = False) -> T.StructType:
    """Parquet-side schema (H3): integers are int64, formats in ``as_string`` text, objects JSON text or variant."""
    out = []
    for f in fields:
        kind, nullable = flat_type(f)
        if kind == "never":
            continue
        if kind in ("integer", "string_integer"):
            t: T.DataType = T.LongType()
        elif kind in ("object", "multiple", "array"):
            t = T.VariantType() if variant else T.StringType()
        elif kind == "string" and f.format == "duration" and "duration" not in as_string:
            t = T.DayTimeIntervalType()
        else:
            t = spark_type(f)
        out.append(T.StructField(f.name, t, nullable))
    return T.StructType(out)


def table_schema(fields: list[Field]) -> T.StructType:
    """Table-format schema (H4): lists typed by one item type, wide integers decimal(38,0)."""
    return T.StructType([T.StructField(f.name, t, flat_type(f)[1]) for f in fields if (t := spark_type(f)) is not None])


def infer_schema(spark: SparkSession, texts: DataFrame, column: str) -> T.StructType:
    """The read schema of JSON documents from the data (H5), by the distributed variant aggregate.

    Objects are structs, what is only null is text; text that is no JSON is left out. A schema that is no object's
    is one field ``value``.
    """
    found = texts.select(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first().s
    kind = spark.createDataFrame([], f"v {struct_ddl(found or 'VOID')}").schema["v"].dataType
    return kind if isinstance(kind, T.StructType) else T.StructType([T.StructField("value", kind)])


def struct_ddl(variant: str) -> str:
    """A variant's schema text as DDL. Types end at ``,``, ``>`` or the end and names at ``:``, and names in backticks stand as they are."""
    parts = re.split(r"(`(?:[^`]|``)*`)", variant)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"(?<![^ <])VOID(?=[,>]|$)", "STRING", re.sub(r"(?<![^ <])OBJECT<", "STRUCT<", parts[i]))
    return "".join(parts)


def collection_schema(table: T.StructType, keys: list[str]) -> T.StructType:
    """Change-document schema of a table (H6): ``_meta`` with op, source and before, required keys."""
    row = T.StructType([T.StructField(f.name, f.dataType, f.name not in keys) for f in table.fields])
    source = T.StructType([T.StructField("ts_ms", T.LongType()), T.StructField("schema", T.StringType()), T.StructField("table", T.StringType()), T.StructField("snapshot", T.BooleanType())])
    meta = T.StructType([T.StructField("op", T.StringType(), False, {"description": "c, u or d", "delete": "d"}), T.StructField("source", source), T.StructField("before", row)])
    return T.StructType([*row.fields, T.StructField("_meta", meta, False)])


#: Widening migrations that a cast can do; "*" stands for any type.
MIGRATIONS: dict[str, tuple[str, ...]] = {
    "bigint": ("decimal(38,0)", "double", "string"), "decimal(38,0)": ("double", "string"), "double": ("string",), "boolean": ("string",), "date": ("timestamp", "string"), "timestamp": ("string",), "*": ("string",),
}


def migration_allowed(old: T.DataType, new: T.DataType) -> bool:
    a, b = old.simpleString(), new.simpleString()
    return a == b or b in MIGRATIONS.get(a, ()) or b in MIGRATIONS["*"]


def validate_fields(spark: SparkSession, fields: list[Field], existing: T.StructType | None, max_name: int = 255) -> DataFrame:
    """(field, constraint, reason) of each field against an existing table (H7, H8)."""
    rows, seen = [], {}
    for f in fields:
        t = spark_type(f)
        if t is None:
            row = ("forbidden", "only null values")
        elif len(f.name.encode()) > max_name:
            row = ("forbidden", f"name is longer than {max_name} bytes")
        elif f.key and flat_type(f)[1] and "default" not in f.meta:
            row = ("incompatible", "key may be null and has no default")
        elif f.name.lower() in seen:
            row = ("incompatible", f"same column as {seen[f.name.lower()]}")
        elif existing is not None and f.name in existing.names:
            old = existing[f.name].dataType
            row = ("required", "already in the table") if old == t or (not f.key and migration_allowed(old, t)) else ("incompatible", f"{old.simpleString()} can't become {t.simpleString()}")
        elif f.key:
            row = ("required", "key")
        else:
            row = ("recommended", "single type") if len(set(f.types) - {"null"}) == 1 else ("optional", "several types")
        seen.setdefault(f.name.lower(), f.name)
        rows.append((f.name, *row))
    return spark.createDataFrame(rows, "field string, constraint string, reason string")


def check_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(key, nulls): how many rows have a null in each key column (H8)."""
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return counts.unpivot([], keys, "key", "nulls")


def shared_tables(bindings: DataFrame, binding: str, path: str, folded: bool = True) -> DataFrame:
    """(table, bindings) of tables that several bindings resolve to (H8); ``path`` is an array of names, whose case does not count if ``folded``."""
    table = F.array_join(F.transform(path, lambda p: F.replace(F.lower(p) if folded else p, F.lit("."), F.lit("\\."))), ".")
    return bindings.groupBy(table.alias("table")).agg(F.sort_array(F.collect_set(binding)).alias("bindings")).where(F.size("bindings") > 1)


def plan_changes(old: T.StructType | None, new: T.StructType, keys: list[str]) -> list[tuple[str, str]]:
    """Actions that take a table from one schema to another (H9)."""
    if old is None:
        return [("create", "*")]
    out = []
    for f in new.fields:
        if f.name not in old.names:
            out.append(("add", f.name))
        elif old[f.name].dataType != f.dataType:
            out.append(("migrate" if f.name not in keys and migration_allowed(old[f.name].dataType, f.dataType) else "backfill", f.name))
        elif f.nullable and not old[f.name].nullable:
            out.append(("drop not null", f.name))
    return out + [("drop not null", f.name) for f in old.fields if f.name not in new.names and not f.nullable]


def backfill_action(old: T.StructType, new: T.StructType, keys: list[str]) -> str:
    """Truncate if every field stays compatible, else drop and create (H10); keys never migrate."""
    return "recreate" if any(a == "backfill" for a, _ in plan_changes(old, new, keys)) else "truncate"


def migrate_columns(df: DataFrame, new: T.StructType) -> DataFrame:
    """The frame under a new schema (H11, H13): casts where types differ, nulls for added columns, old ones kept."""
    out = []
    for f in new.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    return df.select(*out, *[F.col(f"`{c}`") for c in df.columns if c not in new.names])


def add_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """Union under the grown schema: missing columns are null."""
    return df.unionByName(other, allowMissingColumns=True)


def select_fields(df: DataFrame, keys: list[str], depth: int = 1, include: dict[str, bool] | None = None) -> list[tuple[str, Column]]:
    """Selected fields (H14): keys, then locations down to ``depth``; include adds or removes by path."""
    include = include or {}
    out = [(k, F.col(f"`{k}`")) for k in keys]

    def walk(schema: T.StructType, path: str, c: Column | None, level: int) -> None:
        for f in schema.fields:
            name = f"{path}/{f.name}" if path else f.name
            here = F.col(f"`{f.name}`") if c is None else c[f.name]
            inner = isinstance(f.dataType, T.StructType)
            if name not in keys and include.get(name, level <= depth and not (inner and level < depth)):
                out.append((name, here))
            if inner:
                walk(f.dataType, name, here, level + 1)

    walk(df.schema, "", None, 1)
    return out


def index_mapping(f: Field) -> dict:
    """Search-index mapping of a field (H15): several types or mixed arrays are wrapped and flattened."""
    kind, _ = flat_type(f)
    if kind == "multiple" or (kind == "array" and not f.items):
        return {"type": "flattened", "wrapped": True}
    if kind == "array":
        kind = f.items or "string"
    if kind == "string":
        formats = {"date": "date", "date-time": "date", "ipv4": "ip", "ipv6": "ip"}
        return {"type": formats.get(f.format or "", "keyword" if f.key else "text")}
    return {"type": {"integer": "unsigned_long" if (f.maximum or 0) >= 2**63 else "long", "string_integer": "long", "number": "double", "string_number": "double", "boolean": "boolean", "binary": "binary", "object": "flattened", "never": "keyword"}[kind]}
