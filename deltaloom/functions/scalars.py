"""Scalar functions on columns: special floats, dates, arrays, encodings."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def special_floats_to_text(c: Column) -> Column:
    """NaN and infinities as text, null for any other value (F1)."""
    return F.when(F.isnan(c), "NaN").when(c == float("inf"), "Infinity").when(c == float("-inf"), "-Infinity")


def text_to_float(c: Column, nan: float | None = None, inf: float | None = None, ninf: float | None = None) -> Column:
    """Text to double with a target's replacements for special values (F2); other text that is no number is null."""
    return F.when(c == "NaN", F.lit(nan)).when(c == "Infinity", F.lit(inf)).when(c == "-Infinity", F.lit(ninf)).otherwise(c.try_cast("double"))


def text_to_int(c: Column) -> Column:
    """The digits before the point as decimal(38,0)."""
    return F.substring_index(c, ".", 1).try_cast("decimal(38,0)")


def to_text(c: Column, kind: T.DataType) -> Column:
    """Any scalar as text; floats with all their digits, without an exponent and trailing zeros."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(special_floats_to_text(c), _plain_digits(c.cast("string")))
    return c.cast("string")


def _plain_digits(c: Column) -> Column:
    """``-1.25E-7`` as ``-0.000000125``: the shortest digits with the point where the exponent puts it.

    Most numbers have no exponent and only lose a fraction of zeros. Every step names its parts once, in a lambda.
    """
    return F.when(c.contains("E"), _let(c, _shifted)).otherwise(F.regexp_replace(c, r"\.0+$", ""))


def _let(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(c), then), 1)


def _shifted(c: Column) -> Column:
    mantissa = F.substring_index(F.ltrim(c, F.lit("-")), "E", 1)
    parts = F.struct(
        F.rtrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0")).alias("digits"),
        (F.length(F.substring_index(mantissa, ".", 1)) + F.substring_index(c, "E", -1).cast("int")).alias("point"),
        F.when(c.startswith("-"), "-").otherwise("").alias("sign"),
    )
    return _let(parts, _pointed)


def _pointed(part: Column) -> Column:
    digits, point, n = part["digits"], part["point"], F.length(part["digits"])
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    cut = F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n))
    return F.concat(part["sign"], F.when(digits == "", "0").when(point <= 0, small).when(point < n, cut).otherwise(F.rpad(digits, point, F.lit("0"))))


def utc_text(c: Column, kind: T.DataType) -> Column:
    """A time as RFC 3339 text in UTC with six digits, whatever the session's zone; times without a zone count as UTC."""
    plain = c if isinstance(kind, T.TimestampNTZType) else F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    text = plain.cast("string")
    time = F.substring_index(text, " ", -1)
    return F.concat(F.substring_index(text, " ", 1), F.lit("T"), F.rpad(F.when(time.contains("."), time).otherwise(F.concat(time, F.lit("."))), 15, "0"), F.lit("Z"))


def duration_text(c: Column, kind: T.DataType) -> Column:
    """An interval as an ISO 8601 duration: months, or days, hours, minutes and seconds, without those that are 0."""
    if isinstance(kind, T.YearMonthIntervalType):
        months = c.cast("interval year to month").cast("string")
        months = 12 * F.regexp_extract(months, r"(\d+)-", 1).cast("int") + F.regexp_extract(months, r"-(\d+)'", 1).cast("int")
        return F.concat(F.when(c.cast("string").contains("'-"), "-").otherwise(""), F.lit("P"), months.cast("string"), F.lit("M"))
    seconds = c.cast("interval day to second").cast("decimal(20,6)")
    size = F.abs(seconds)
    part = lambda per, of: F.floor(size / per).cast("long") % of
    named = lambda n, mark: F.when(n > 0, F.concat(n.cast("string"), F.lit(mark))).otherwise("")
    rest = F.regexp_replace(F.regexp_replace((size % 60).cast("decimal(8,6)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    time = F.concat(named(part(3600, 24), "H"), named(part(60, 60), "M"), F.when(size % 60 > 0, F.concat(rest, F.lit("S"))).otherwise(""))
    body = F.concat(named(F.floor(size / 86400).cast("long"), "D"), F.when(time != "", F.concat(F.lit("T"), time)).otherwise(""))
    return F.concat(F.when(seconds < 0, "-").otherwise(""), F.lit("P"), F.when(body == "", "T0S").otherwise(body))


def to_json_text(c: Column) -> Column:
    """A value as JSON text, null stays null."""
    whole = F.to_json(F.struct(c.alias("v")))
    return F.when(c.isNotNull(), F.regexp_extract(whole, r'(?s)^\{"v":(.*)\}$', 1))


def parse_rfc3339(c: Column) -> Column:
    """RFC 3339 with lower-case z or t and a space as separator too (F6); nanoseconds are cut."""
    text = F.regexp_replace(F.regexp_replace(F.upper(c), r"^(\d{4}-\d{2}-\d{2})[T ]", "$1T"), r"(\.\d{6})\d+", "$1")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"), F.try_to_timestamp(text))


def clamp_year_zero(c: Column) -> Column:
    """Dates and times of year 0000 become the first instant of year 1."""
    return F.when(c.rlike(r"^0000-\d{2}-\d{2}$"), F.lit("0001-01-01")).when(c.startswith("0000-"), F.lit("0001-01-01T00:00:00Z")).otherwise(c)


def clamp_range(c: Column, low: str, high: str) -> Column:
    """A date or time as text to the edges of a target's range by its year in UTC (F8); edges are given as text.

    An offset can move the last or first hours of a year into the next or the one before.
    """
    form = r"^([+-]?\d+)-(\d{2})-(\d{2})(?:[Tt ](\d{2}):(\d{2})\S*?(?:([+-])(\d{2}):(\d{2}))?)?[Zz]?$"
    part = lambda i: F.coalesce(F.regexp_extract(c, form, i).try_cast("int"), F.lit(0))
    ahead = F.when(F.regexp_extract(c, form, 6) == "-", -1).otherwise(1) * (part(7) * 60 + part(8))
    minutes, day = part(4) * 60 + part(5) - ahead, part(2) * 100 + part(3)
    year = F.regexp_extract(c, r"^([+-]?\d+)-\d{2}-\d{2}", 1).try_cast("int")
    year = year + F.when((day == 1231) & (minutes >= 1440), 1).when((day == 101) & (minutes < 0), -1).otherwise(0)
    return F.when(year < int(low.split("-")[0]), F.lit(low)).when(year > int(high.split("-")[0]), F.lit(high)).otherwise(c)


def base64_to_binary(c: Column) -> Column:
    return F.unbase64(c)


def base64_to_hex(c: Column) -> Column:
    return F.lower(F.hex(F.unbase64(c)))


def range_to_text(lower: Column, upper: Column, lower_inc: Column, upper_inc: Column, empty: Column) -> Column:
    """Bounds as ``[a,b)``; an open end is empty text, an empty range ``empty``."""
    text = F.concat(F.when(lower_inc, "[").otherwise("("), F.coalesce(lower.cast("string"), F.lit("")), F.lit(","), F.coalesce(upper.cast("string"), F.lit("")), F.when(upper_inc, "]").otherwise(")"))
    return F.when(empty, F.lit("empty")).otherwise(text)


def unflatten_array(elements: Column, dims: list[int]) -> Column:
    """A flat array as nested arrays of given dimensions, row-major."""
    for width in reversed(dims[1:]):
        elements = _rows_of(elements, width)
    return elements


def _rows_of(flat: Column, width: int) -> Column:
    starts = F.when(F.size(flat) > 0, F.sequence(F.lit(0), (F.size(flat) / width).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(flat, i * width + 1, F.lit(width)))


def fix_unpaired_surrogates(c: Column) -> Column:
    r"""Escapes of lone surrogates in JSON text become �."""
    high, low = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
    once = F.regexp_replace(c, rf"(?<!\\)((?:\\\\)*){high}(?!{low})", r"$1\\ufffd")
    return F.regexp_replace(once, rf"(?<!{high}){low}", r"\\ufffd")


def time_text(c: Column, form: str) -> Column:
    """Times as fixed text; ``infinity`` and ``-infinity`` go to the edges of the year range."""
    return F.when(c == "infinity", "9999-12-31T23:59:59Z").when(c == "-infinity", "0000-01-01T00:00:00Z").otherwise(F.date_format(F.try_to_timestamp(c), form))


def date_text(c: Column, as_date: bool = True) -> Column:
    """Dates as text to text (F13): infinities go to the edges, years outside 0 to 9999 to the first day of year 0.

    Without ``as_date`` they are midnight in UTC. Text that is no date is null.
    """
    form = r"^([+-]?\d+)-(\d{2})-(\d{2})( BC)?$"
    year = F.regexp_extract(c, form, 1).try_cast("int")
    day = F.when(c == "infinity", "9999-12-31").when((c == "-infinity") | (c.rlike(form) & (~year.between(0, 9999) | c.endswith(" BC"))), "0000-01-01").when(c.rlike(form), c)
    if as_date:
        return day
    return F.when(c == "infinity", "9999-12-31T23:59:59Z").otherwise(F.concat(day, F.lit("T00:00:00Z")))


def time_of_day_text(micros: Column) -> Column:
    """Microseconds since midnight as a time in UTC without trailing zeros."""
    part = lambda per, of, width: F.lpad((F.floor(micros / per) % of).cast("long").cast("string"), width, "0")
    fraction = F.rtrim(part(1, 1_000_000, 6), F.lit("0"))
    return F.concat(part(3_600_000_000, 24, 2), F.lit(":"), part(60_000_000, 60, 2), F.lit(":"), part(1_000_000, 60, 2), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)), F.lit("Z"))


def timetz_text(c: Column) -> Column:
    """A time with its offset, such as 12:34:56.50+02, as 12:34:56.5+02:00, and Z for no offset (F13); other text stays."""
    form = r"^(\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?(?:Z|([+-]\d{2})(?::(\d{2}))?)$"
    part = lambda i: F.regexp_extract(c, form, i)
    fraction, minutes = F.rtrim(part(2), F.lit("0")), F.when(part(4) == "", "00").otherwise(part(4))
    zone = F.when((part(3) == "") | (part(3).isin("+00", "-00") & (minutes == "00")), "Z").otherwise(F.concat(part(3), F.lit(":"), minutes))
    return F.when(c.rlike(form), F.concat(part(1), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)), zone)).otherwise(c)


def zero_dates(c: Column) -> Column:
    """Zero months and days of MySQL become 01, zero years 0001."""
    out = F.regexp_replace(c, r"^0000-", "0001-")
    out = F.regexp_replace(out, r"^(\d{4})-00-", "$1-01-")
    return F.regexp_replace(out, r"^(\d{4}-\d{2})-00", "$1-01")


def bits_to_number(c: Column) -> Column:
    """A bit string such as 0101 of up to 64 bits as a number (F15); a longer one or other text gives null."""
    return F.when(c.rlike("^0*[01]{1,64}$"), F.conv(c, 2, 10).try_cast("decimal(20,0)"))


def uuid_text(c: Column) -> Column:
    """16 bytes as UUID text."""
    return F.regexp_replace(F.lower(F.hex(c)), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def tiny_boolean(c: Column) -> Column:
    return c != 0


_WKB = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION"}


#: The reference system whose texts name the latitude first (fixed value).
LATITUDE_FIRST = 4326


def _coordinate(v: float) -> str:
    """The shortest digits that give the value again, with an exponent only for very large and very small ones."""
    if v and not 1e-14 <= abs(v) < 1e15:
        return np.format_float_scientific(v, trim="-", exp_digits=2).replace("e+", "e")
    return np.format_float_positional(v, trim="-")


def _wkt(data: bytes, at: int, swap: bool) -> tuple[str, str, int]:
    end = "<" if data[at] == 1 else ">"
    kind = struct.unpack_from(end + "I", data, at + 1)[0]
    at += 5

    def count() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(end + "I", data, at - 4)[0]

    def points(n: int) -> str:
        nonlocal at
        xy = struct.unpack_from(f"{end}{2 * n}d", data, at)
        at += 16 * n
        pairs = zip(xy[1::2], xy[::2], strict=True) if swap else zip(xy[::2], xy[1::2], strict=True)
        return ",".join(f"{_coordinate(x)} {_coordinate(y)}" for x, y in pairs)

    if kind == 1:
        body = f"({points(1)})"
    elif kind == 2:
        body = f"({points(count())})"
    elif kind == 3:
        body = "(" + ",".join(f"({points(count())})" for _ in range(count())) + ")"
    else:
        parts = []
        for _ in range(count()):
            name, inner, at = _wkt(data, at, swap)
            parts.append(name + inner if kind == 7 else inner)
        body = "(" + ",".join(parts) + ")" if parts else " EMPTY"
    return _WKB[kind], body, at


@F.pandas_udf(T.StringType())
def wkb_to_wkt(c: pd.Series) -> pd.Series:
    """Geometry bytes after a 4-byte SRID as WKT, seven types (F16); null stays null."""
    swap = lambda v: int.from_bytes(bytes(v)[:4], "little") == LATITUDE_FIRST
    return pd.Series([None if v is None else "".join(_wkt(bytes(v), 4, swap(v))[:2]) for v in c], dtype=object)


def bson_scalar(c: Column) -> Column:
    """Extended-JSON values (``$oid``, ``$date``, ``$numberDecimal``, ``$numberLong``) as plain JSON text."""
    at = lambda name: F.get_json_object(c, f"$.{name}")
    quoted = F.coalesce(at("$oid"), at("$date"), at("$numberDecimal"))
    return F.when(quoted.isNotNull(), F.concat(F.lit('"'), quoted, F.lit('"'))).otherwise(F.coalesce(at("$numberLong"), at("$numberInt"), c))


def _plain_bson(value, root: bool = False):
    """A value of extended JSON without its wrappers."""
    if isinstance(value, list):
        return [_plain_bson(v) for v in value]
    if not isinstance(value, dict):
        return value
    if len(value) == 1:
        (kind, inner), = value.items()
        if kind in ("$oid", "$numberDecimal", "$symbol"):
            return str(inner)
        if kind in ("$numberLong", "$numberInt"):
            return int(inner)
        if kind == "$numberDouble":
            return inner if inner in ("NaN", "Infinity", "-Infinity") else float(inner)
        if kind == "$binary":
            return inner["base64"] if isinstance(inner, dict) else inner
        if kind == "$date":
            millis = _plain_bson(inner)
            return millis if isinstance(millis, str) else _instant_text(millis)
    out = {k: _plain_bson(v) for k, v in value.items()}
    if root and "_id" in out and not isinstance(out["_id"], str):
        out["_id"] = json.dumps(out["_id"], separators=(",", ":"))
    return out


def _instant_text(millis: int) -> str:
    seconds, rest = divmod(millis, 1000)
    return f"{np.datetime64(seconds, 's')}" + (f".{rest:03}".rstrip("0") if rest else "") + "Z"


@F.pandas_udf(T.StringType())
def bson_documents(c: pd.Series) -> pd.Series:
    """Documents in extended JSON as plain JSON text (F17): wrappers at any depth become values, a root ``_id`` that is no text becomes its JSON.

    Object ids, decimals and special floats are text, times RFC 3339 in UTC, binaries base64. Null, and text that is no JSON, give null.
    """
    out = []
    for text in c:
        try:
            out.append(None if text is None else json.dumps(_plain_bson(json.loads(text), root=True), ensure_ascii=False, separators=(",", ":")))
        except ValueError:
            out.append(None)
    return pd.Series(out, dtype=object)


def decimals_to_text(df: DataFrame) -> DataFrame:
    """Decimals anywhere in a row as exact text, nested ones too."""
    return df.select(*[_decimal(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def _decimal(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return c.cast("string")
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_decimal(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _decimal(x, kind.elementType))
    return c


def encode_row(columns: list[str], skip_nulls: bool = False) -> Column:
    """A row as a JSON object with sorted names."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": str(skip_nulls).lower()})


def embedding_input(columns: list[str]) -> Column:
    """``name: json`` lines, sorted by name, as text for a vector model (F20); null values are left out."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), to_json_text(F.col(c))) for c in sorted(columns)])


def normalize_datetimes(df: DataFrame) -> DataFrame:
    """``YYYY-MM-DD HH:MM:SS`` text anywhere in a document as RFC 3339."""
    return df.select(*[_datetimes(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def _datetimes(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        out = F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2}:\d{2}(?:\.\d+)?)$", "$1T$2Z")
        return F.regexp_replace(out, r"^(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2}:\d{2}(?:\.\d+)?)([+-]\d{2}:\d{2})$", "$1T$2$3")
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_datetimes(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _datetimes(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda k, v: _datetimes(v, kind.valueType))
    return c


_FIXED = {"boolean": 1, "int": 4, "bigint": 8, "double": 8, "float": 4, "date": 4, "timestamp": 8, "smallint": 2, "tinyint": 1}


def est_row_size(df: DataFrame) -> Column:
    """Estimated bytes of a row: the fixed part and the lengths of what varies."""
    size = F.lit(0)
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in _FIXED:
            size = size + F.lit(_FIXED[kind])
        elif kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
        else:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0))
    return size


def interval_text(months: Column, days: Column, millis: Column) -> Column:
    """Months, days and milliseconds as an ISO 8601 duration."""
    seconds = F.regexp_replace(F.regexp_replace((millis / 1000).cast("decimal(18,3)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.concat(F.lit("P"), months.cast("string"), F.lit("M"), days.cast("string"), F.lit("DT"), seconds, F.lit("S"))
