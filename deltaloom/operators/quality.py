"""Comparison, state checks, masking and change workloads."""

from __future__ import annotations

import hashlib
import json
import random
import string

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaves(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, value): every leaf of typed documents as text; null leaves are left out."""
    found: list[Column] = []

    def walk(c: Column, kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(c[f.name], f.dataType, f"{path}/{f.name}")
        else:
            text = F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType)) else c.cast("string")
            found.append(F.struct(F.lit(path).alias("path"), text.alias("value")))

    for f in df.schema.fields:
        if f.name not in keys:
            walk(F.col(f"`{f.name}`"), f.dataType, f"/{f.name}")
    return df.select(*keys, F.explode(F.array(*found)).alias("_l")).select(*keys, "_l.path", "_l.value").where("value IS NOT NULL")


def compare_docs(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Paths where the actual document lacks or differs from the expected one (Q1); extra leaves are allowed."""
    want, have = leaves(expected, keys).withColumnRenamed("value", "expected"), leaves(actual, keys).withColumnRenamed("value", "actual")
    return want.join(have, [*keys, "path"], "left").where(~F.col("expected").eqNullSafe(F.col("actual")))


def check_transitions(events: DataFrame, keys: list[str], order: list[str], event: str, allowed: list[tuple[str | None, str]]) -> DataFrame:
    """Events that no allowed transition leads to (Q2); None is the state before a key's first event."""
    spark = events.sparkSession
    table = spark.createDataFrame([(a or "", b) for a, b in allowed], "_from string, _to string")
    before = F.coalesce(F.lag(event).over(Window.partitionBy(*keys).orderBy(*order)), F.lit(""))
    return events.withColumn("_from", before).withColumn("_to", F.col(event)).join(F.broadcast(table), ["_from", "_to"], "left_anti").withColumnRenamed("_from", "before").drop("_to")


#: Seconds from 1970 in which a masked instant lies, and the first and the number of the
#: ideographs that stand for any character without a case (fixed values).
INSTANTS, IDEOGRAPH, IDEOGRAPHS = 2_082_758_400, 0x4E00, 0x9FA5 - 0x4E00 + 1
#: Text that is a date, or a date and time.
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}([Tt ]\d{2}:\d{2}(:\d{2})?(\.\d+)?([Zz]|[+-]\d{2}:?\d{2})?)?$"


def _draw(salt: str, *of: Column) -> Column:
    """A number from 0 to 2**31 - 1 from a keyed digest: the salt can't be told from the masks."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x00", F.lit(salt), *[x.cast("string") for x in of]), 256), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(2**31 - 1))


def mask_text(c: Column, salt: str) -> Column:
    """Text with every character replaced by one of its class, drawn by salt, text and place (Q3).

    Digits stay digits, cased letters become a-z or A-Z, all else an ideograph; the number of
    characters stays. A date or a date and time becomes another valid one. The same text gives
    the same mask, so equal values stay equal.
    """
    seed = F.sha2(F.concat_ws("\x00", F.lit(salt), c), 256)

    def one(x: Column, i: Column) -> Column:
        draw = F.pmod(F.xxhash64(seed, i), F.lit(2**31))
        new = F.when(x.rlike(r"^\p{Nd}$"), draw % 10 + ord("0")).when(x.rlike(r"^\p{Ll}$"), draw % 26 + ord("a")).when(x.rlike(r"^\p{Lu}$"), draw % 26 + ord("A")).otherwise(draw % IDEOGRAPHS + IDEOGRAPH)
        return F.decode(F.unhex(F.lpad(F.hex(new), 4, "0")), "UTF-16BE")

    at = F.timestamp_seconds(_draw(salt, c) % INSTANTS)
    moved = F.when(c.contains(":"), F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(at, "yyyy-MM-dd"))
    return F.when(c.rlike(DATE_TEXT), moved).otherwise(F.array_join(F.transform(F.split(c, ""), one), ""))


def obfuscate(df: DataFrame, salt: str, keep: list[str]) -> DataFrame:
    """Every leaf masked but those under the paths in ``keep`` (Q3).

    Text as in ``mask_text``; whole numbers keep sign and digits, fractions their sign and rough
    size; booleans are drawn; dates and times become others of INSTANTS; binaries become as many other bytes. Keys
    of maps are data and are masked too, told apart by a digest. Of variants only the values are masked, names stay.
    """
    return df.select(*[_masked(F.col(f"`{f.name}`"), f.dataType, f"/{f.name}", salt, keep).alias(f.name) for f in df.schema.fields])


def _masked(c: Column, kind: T.DataType, path: str, salt: str, keep: list[str]) -> Column:
    if path in keep:
        return c
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_masked(c[f.name], f.dataType, f"{path}/{f.name}", salt, keep).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _masked(x, kind.elementType, path, salt, keep))
    if isinstance(kind, T.MapType):
        name = lambda k: F.concat(mask_text(k, salt), F.lit("-"), F.substring(F.sha2(F.concat_ws("\x00", F.lit(salt), k), 256), 1, 12)) if isinstance(kind.keyType, T.StringType) else k
        values = F.transform_values(c, lambda k, v: _masked(v, kind.valueType, path, salt, keep))
        return F.transform_keys(values, lambda k, v: name(k))
    if isinstance(kind, T.StringType):
        return mask_text(c, salt)
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.substring(F.repeat(F.sha2(F.concat_ws("\x00", F.lit(salt), F.hex(c)), 256), (F.octet_length(c) / 32 + 1).cast("int")), F.lit(1), 2 * F.octet_length(c)))
    if isinstance(kind, T.BooleanType):
        return F.when(c.isNotNull(), _draw(salt, c, F.lit(path)) % 2 == 0)
    if isinstance(kind, T.DateType):
        return F.when(c.isNotNull(), F.date_from_unix_date((_draw(salt, c) % (INSTANTS // 86400)).cast("int")))
    if isinstance(kind, T.TimestampType):
        return F.when(c.isNotNull(), F.timestamp_seconds(_draw(salt, F.unix_micros(c)) % INSTANTS))
    if isinstance(kind, T.TimestampNTZType):
        return F.when(c.isNotNull(), F.timestamp_add("SECOND", _draw(salt, c) % INSTANTS, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(_masked_json(F.to_json(c), F.lit(salt)))
    if isinstance(kind, T.IntegralType):
        size = F.length(F.abs(c.cast("decimal(20,0)")).cast("string"))
        low = F.when(size > 1, F.pow(F.lit(10), size - 1).cast("decimal(20,0)")).otherwise(F.lit(0).cast("decimal(20,0)"))
        # The type's greatest value has fewer numbers of its length below it.
        span = F.least(F.pow(F.lit(10), size).cast("decimal(20,0)") - 1, F.lit(_GREATEST[kind.typeName()]).cast("decimal(20,0)")) - low + 1
        return (F.when(c < 0, -1).otherwise(1) * (low + _draw(salt, c) % span)).cast(kind)
    if isinstance(kind, T.FractionalType):
        share = F.lit(0.5) + _draw(salt, c) / float(2**31)
        if isinstance(kind, T.DecimalType):
            return (c.cast("double") * share).try_cast(kind)
        return F.round(c * share, 6).cast(kind)
    return F.lit(None).cast(kind)


@F.pandas_udf(T.StringType())
def _masked_json(texts: pd.Series, salts: pd.Series) -> pd.Series:
    """JSON text with every value masked by kind: characters by their class, digits by digits, booleans drawn."""

    def mask(value, salt: str):
        if isinstance(value, dict):
            return {k: mask(v, salt) for k, v in value.items()}
        if isinstance(value, list):
            return [mask(v, salt) for v in value]
        if value is None:
            return None
        drawn = random.Random(hashlib.sha256(f"{salt}\x00{value!r}".encode()).digest())
        if isinstance(value, bool):
            return drawn.random() < 0.5
        if isinstance(value, str):
            return "".join(drawn.choice("0123456789") if c.isdigit() else drawn.choice(string.ascii_lowercase) if c.islower() else drawn.choice(string.ascii_uppercase) if c.isupper() else chr(IDEOGRAPH + drawn.randrange(IDEOGRAPHS)) for c in value)
        if isinstance(value, int):
            low = 10 ** (len(str(abs(value))) - 1) if abs(value) > 9 else 0
            return (-1 if value < 0 else 1) * drawn.randint(low, 10 * max(low, 1) - 1)
        return round(value * (0.5 + drawn.random()), 6)

    return pd.Series([None if t is None else json.dumps(mask(json.loads(t), salt), ensure_ascii=False) for t, salt in zip(texts, salts, strict=True)], dtype=object)


_GREATEST = {"byte": 2**7 - 1, "short": 2**15 - 1, "integer": 2**31 - 1, "long": 2**63 - 1}


def change_workload(spark, docs_per_tx: list[int], size: int, updates: float, deletes: float, seed: int) -> DataFrame:
    """Transactions of (tx, id, op, payload) with exact payload sizes (Q4).

    From the second on, the given fractions of a transaction's documents update or delete
    earlier ids, chosen by hash rank over the id range, the rest is fresh. Equal seeds give equal rows.
    """
    out, known = None, 0
    for tx, n in enumerate(docs_per_tx):
        old = min(round(n * (updates + deletes)), known) if tx else 0
        gone = round(old * deletes / (updates + deletes)) if old else 0
        step = max(1, known // old) if old else 1
        base = spark.range(n).withColumnRenamed("id", "i")
        # One id of each of ``old`` equal stretches of the known range.
        draw = F.col("i") * step + F.pmod(F.xxhash64(F.lit(seed), F.lit(tx), "i"), F.lit(step))
        rows = base.select(
            F.lit(tx).alias("tx"), F.when(F.col("i") < old, draw).otherwise(F.lit(known) + F.col("i") - old).alias("id"), F.when(F.col("i") < gone, "d").when(F.col("i") < old, "u").otherwise("c").alias("op")
        )
        rows = rows.withColumn("payload", F.rpad(F.sha2(F.concat_ws("-", F.lit(str(seed)), "tx", "id"), 256), size, "0123456789abcdef"))
        out, known = rows if out is None else out.unionByName(rows), known + n - old
    return out


def sample_zipf(df: DataFrame, n: int, rank: Column, s: float, seed: int, id_col: str) -> DataFrame:
    """Weighted sample of n rows without replacement, weight rank ** -s (Q5): greatest log(u) * rank ** s first."""
    u = (F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(2**53)) + 1) / F.lit(float(2**53 + 1))
    return df.withColumn("_p", F.log(u) * F.pow(rank, F.lit(float(s)))).orderBy(F.desc("_p"), id_col).limit(n).drop("_p")


def throughput_stats(log: DataFrame, tx: str, start: str, end: str, n_docs: str, n_bytes: str) -> DataFrame:
    """Documents and MiB per second of each transaction and, with a null transaction, in total (Q6)."""
    seconds = F.max(F.unix_micros(end)) - F.min(F.unix_micros(start))
    stats = [F.sum(n_docs).alias("docs"), F.round(F.sum(n_docs) * 1000000 / seconds, 3).alias("docs_per_s"), F.round(F.sum(n_bytes) * 1000000 / seconds / 1048576, 6).alias("mib_per_s")]
    return log.groupBy(tx).agg(*stats).unionByName(log.agg(F.lit(None).cast(log.schema[tx].dataType).alias(tx), *stats))


def stream_lag(df: DataFrame, stream: list[str], ts: str, now: Column) -> DataFrame:
    """Documents and seconds behind of each stream (Q7)."""
    return df.groupBy(*stream).agg(F.count(F.lit(1)).alias("n"), ((F.unix_micros(now) - F.max(F.unix_micros(ts))) / 1000000).alias("lag_s"))


def describe_projection(schema: T.StructType, titles: dict[str, str]) -> list[tuple[str, str]]:
    """Comment text of each column from its title and types (Q8)."""
    return [(f.name, "\n".join(x for x in (titles.get(f.name), f"location /{f.name}, type {f.dataType.simpleString()}") if x)) for f in schema.fields]
