"""Registered queries of operators that shape single rows and values, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import avro
from deltaloom.functions import scalars as fn
from deltaloom.operators import changes, merging, quality, reduction, shaping
from deltaloom.plans import schema
from deltaloom.plans.catalog import query, table
from deltaloom.sources import scans


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("c9_json_diff", "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN '{\"a b\":' || event_id || ',\"k\":' || json_extract_string(props, '$.k') || '}' WHEN event_id % 9 = 2 THEN '[' || user_id || ']' WHEN event_id % 2 = 0 THEN '{\"k\":' || event_id || '}' ELSE '{\"k\":' || json_extract_string(props, '$.k') || ',\"n\":' || user_id || '}' END AS doc FROM events")
def c9_json_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    edit = lambda op, path, value: F.array(F.struct(F.lit(op).alias("op"), F.lit(path).alias("path"), value.cast("string").alias("value")))
    diffs = F.when(F.col("event_id") % 2 == 0, edit("replace", "$.k", F.col("event_id"))).otherwise(edit("insert", "$.n", F.col("user_id")))
    kind = F.col("event_id") % 9
    diffs = F.when(kind == 1, edit("insert", '$."a b"', F.col("event_id"))).when(kind == 2, edit("replace", "$", F.format_string("[%d]", "user_id"))).otherwise(diffs)
    return events(spark, sf_dir).select("event_id", changes.apply_json_diff(F.when(kind != 0, F.col("props")), diffs).alias("doc"))


@query("e1_message_doc", """
SELECT event_id AS "offset", event_id::VARCHAR AS id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 5 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS k,
  CASE WHEN event_id % 4 <> 0 AND event_id % 5 = 0 THEN '[1]' END AS other, CASE WHEN event_id % 4 = 0 THEN 'd' ELSE 'c' END AS op FROM events""")
def e1_message_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("event_id") % 4 == 0, None).when(F.col("event_id") % 5 == 0, "[1]").otherwise(F.col("props"))
    rows = events(spark, sf_dir).select(body.alias("value"), F.format_string('{"id":%d}', "event_id").alias("key"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    return shaping.message_doc(rows).select("_meta.offset", F.col("document")["id"].alias("id"), F.col("document")["k"].alias("k"), F.col("document")["_value"].alias("other"), "_meta.op")


#: A registry's schema of an event: unions, a map and logical types.
EVENT_AVRO = """{"type":"record","name":"event","fields":[{"name":"id","type":"long"},{"name":"kind","type":["null","string"]},{"name":"at","type":{"type":"long","logicalType":"timestamp-micros"}},{"name":"tags","type":{"type":"map","values":"long"}},{"name":"value","type":"double"}]}"""


@query("e2_registry_messages", """
SELECT event_id AS id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END AS at, user_id AS tag, value FROM events""")
def e2_registry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three messages are Avro, the third is JSON under a schema id of its own."""
    rows = events(spark, sf_dir)
    kind = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    text = F.to_json(F.struct(F.col("event_id").alias("id"), kind.alias("kind"), (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000000).alias("at"), F.create_map(F.lit("user"), F.col("user_id")).alias("tags"), "value"), {"ignoreNullFields": "false"})
    plain = F.concat(F.unhex(F.lit("0000000009")), F.encode(text, "UTF-8"))
    rows = rows.select(F.when(F.col("event_id") % 3 == 0, plain).otherwise(avro.encode_registry(text, 7, EVENT_AVRO)).alias("m"))
    found = rows.select(F.from_json(avro.decode_registry(F.col("m"), {7: EVENT_AVRO, 9: None}), "id long, kind string, at string, tags map<string,long>, value double").alias("d"))
    return found.select("d.id", "d.kind", F.when(F.col("d.id") % 3 != 0, F.col("d.at")).alias("at"), F.col("d.tags")["user"].alias("tag"), "d.value")


@query("e3_avro_values", "SELECT o_orderkey::VARCHAR AS k, o_totalprice::DECIMAL(12, 2)::VARCHAR AS price, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS at, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_custkey = 0 THEN '0' ELSE o_custkey || repeat('0', 12) END AS m, 'P' || CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 7 || 'D' ELSE '' END || 'T3H' || CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 5 || '.5S' ELSE '0.5S' END AS took FROM orders")
def e3_avro_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.col("o_orderdate").alias("at"), F.to_date("o_orderdate").alias("day"), F.create_map(F.lit("c"), F.col("o_custkey") * 1e12).alias("m"), F.make_dt_interval(F.col("o_orderkey").cast("int") % 7, F.lit(3), F.lit(0), F.col("o_orderkey").cast("int") % 5 + F.lit(0.5).cast("decimal(18,6)")).alias("took"))
    return shaping.avro_values(rows).withColumn("m", F.col("m")["c"])


@query("e4_spread_body", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"body":"[' || event_id || ']","_meta":{"event_id":' || event_id || '}}' ELSE '{"k":' || json_extract_string(props, '$.k') || ',"_meta":{"event_id":' || event_id || '}}' END AS document FROM events""")
def e4_spread_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("props", F.when(F.col("event_id") % 3 == 0, F.format_string("[%d]", "event_id")).otherwise(F.col("props")))
    found = shaping.spread_body(rows, "props", ["event_id"])
    return found.select(F.get_json_object("document", "$._meta.event_id").cast("long").alias("event_id"), "document")


@query("e6_stream_record_doc", """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS document, CASE WHEN event_id % 2 = 0 THEN 'kept' END AS own FROM events""")
def e6_stream_record_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    payload = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"k":'), k, F.lit(',"_meta":{"own":"kept","event_id":"x"}}'))).otherwise(F.concat(F.lit('{"k":'), k, F.lit(',"_meta":7}')))
    found = shaping.stream_record_doc(events(spark, sf_dir).withColumn("p", payload), "p", ["event_id"])
    return found.select(F.col("_meta")["event_id"].cast("long").alias("event_id"), "document", F.col("_meta")["own"].alias("own"))


@query("e10_record_ids", "SELECT event_id, 'r' || event_id AS id FROM events")
def e10_record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.create_map(F.lit("X-Id"), F.format_string("r%d", "event_id"))
    return events(spark, sf_dir).select("event_id", shaping.record_ids(headers, "X-Id").alias("id"))


@query("e12_properties_to_pairs", "SELECT event_id, 'kind=' || event_type || ';props=' || props AS pairs FROM events")
def e12_properties_to_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = shaping.properties_to_pairs(F.create_map(F.lit("props"), F.col("props"), F.lit("kind"), F.col("event_type")))
    return events(spark, sf_dir).select("event_id", F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p["name"], p["value"])), ";").alias("pairs"))


@query("e15_unique_names", r"""
WITH n AS (SELECT DISTINCT user_id, CASE event_id % 3 WHEN 0 THEN '$' || event_type WHEN 1 THEN upper(event_type) ELSE event_type END AS name FROM events)
SELECT user_id, name, repeat('_', (row_number() OVER (PARTITION BY user_id, lower(ltrim(name, '$')) ORDER BY name) - 1)::INT) || ltrim(name, '$') AS unique_name FROM n""")
def e15_unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("$"), "event_type")).when(F.col("event_id") % 3 == 1, F.upper("event_type")).otherwise(F.col("event_type"))
    return shaping.unique_name_rows(events(spark, sf_dir).select("user_id", kind.alias("name")).distinct(), "name", ["user_id"])


@query("e21_export_rows", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag, CASE WHEN event_id % 2 = 0 THEN 'd' ELSE 'u' END AS op FROM events")
def e21_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("event_id") % 3 == 0, "True").when(F.col("event_id") % 3 == 1, "false").otherwise("")
    rows = events(spark, sf_dir).select("event_id", flag.alias("flag"), F.when(F.col("event_id") % 2 == 0, "True").alias("IsDelete"))
    return shaping.export_rows(rows, ["flag", "absent"]).select("event_id", "flag", "_meta.op")


@query("e23_two_formats", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('second', o_orderdate) ELSE date_trunc('day', o_orderdate) END - INTERVAL 2 HOUR AS at FROM orders")
def e23_two_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", shaping.two_format_time(text, "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "+02:00").alias("at"))


@query("e24_title_case", 'SELECT c_custkey AS "C_Custkey", c_name AS "C_Name" FROM customer')
def e24_title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.title_case_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_name"))


def _special() -> Column:
    at = F.col("event_id") % 4
    return F.when(at == 0, "NaN").when(at == 1, "Infinity").when(at == 2, "-Infinity").otherwise(F.col("value").cast("string"))


@query("f1_special_floats", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' WHEN 2 THEN '-Infinity' END AS t FROM events")
def f1_special_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", fn.special_floats_to_text(_special().cast("double")).alias("t"))


@query("f2_text_to_float", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 1000000.0 WHEN 2 THEN -1000000.0 ELSE value END::DOUBLE AS x FROM events")
def f2_text_to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", fn.text_to_float(_special(), None, 1e6, -1e6).alias("x"))


@query("f4_to_text", r"SELECT event_id, regexp_replace(value::VARCHAR, '\.0$', '') AS t, user_id::VARCHAR AS u, CASE WHEN user_id = 0 THEN '0' ELSE user_id || repeat('0', 30) END AS large, '-0.' || repeat('0', 19) || '1' AS small FROM events")
def f4_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", fn.to_text(F.col("value"), T.DoubleType()).alias("t"), fn.to_text(F.col("user_id"), T.LongType()).alias("u"), fn.to_text(F.concat(F.col("user_id").cast("string"), F.lit("e30")).cast("double"), T.DoubleType()).alias("large"), fn.to_text(F.lit(-1e-20), T.DoubleType()).alias("small"))


@query("f5_to_json_text", "SELECT event_id, '\"' || event_type || '\"' AS t, CASE WHEN event_id % 2 = 0 THEN '[' || user_id || ']' END AS a FROM events")
def f5_to_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", fn.to_json_text(F.col("event_type")).alias("t"), fn.to_json_text(F.when(F.col("event_id") % 2 == 0, F.array("user_id"))).alias("a"))


@query("f7_clamp_year_zero", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN '0001-01-01' WHEN 1 THEN '0001-01-01T00:00:00Z' ELSE strftime(ts, '%Y-%m-%d') END AS t FROM events")
def f7_clamp_year_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "-MM-dd")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("0000"), day)).when(F.col("event_id") % 3 == 1, F.concat(F.lit("0000"), day, F.lit("T01:00:00Z"))).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return events(spark, sf_dir).select("event_id", fn.clamp_year_zero(text).alias("t"))


@query("f8_clamp_range", "SELECT event_id, CASE WHEN 9997 + event_id % 4 + (event_id % 3 = 0)::INT > 9999 THEN '9999-12-31T23:59:59.999999Z' ELSE (9997 + event_id % 4) || '-12-31T23:30:00' || CASE WHEN event_id % 3 = 0 THEN '-01:00' ELSE 'Z' END END AS t FROM events")
def f8_clamp_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat((9997 + F.col("event_id") % 4).cast("string"), F.lit("-12-31T23:30:00"), F.when(F.col("event_id") % 3 == 0, "-01:00").otherwise("Z"))
    return events(spark, sf_dir).select("event_id", fn.clamp_range(text, "0001-01-01T00:00:00Z", "9999-12-31T23:59:59.999999Z").alias("t"))


@query("f12_surrogates", r"""SELECT event_id, CASE event_id % 3 WHEN 0 THEN '"\ufffd' || event_type || '"' WHEN 1 THEN '"😀' || event_type || '"' ELSE '"' || event_type || '\ufffd"' END AS t FROM events""")
def f12_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("event_id") % 3
    text = F.when(part == 0, F.concat(F.lit(r'"\ud83d'), "event_type", F.lit('"'))).when(part == 1, F.concat(F.lit(r'"😀'), "event_type", F.lit('"'))).otherwise(F.concat(F.lit('"'), "event_type", F.lit(r'\ude00"')))
    return events(spark, sf_dir).select("event_id", fn.fix_unpaired_surrogates(text).alias("t"))


@query("f13_time_text", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN '9999-12-31T23:59:59Z' WHEN 1 THEN '0000-01-01T00:00:00Z' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS t FROM events")
def f13_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 5 == 0, "infinity").when(F.col("event_id") % 5 == 1, "-infinity").otherwise(F.col("ts").cast("string"))
    return events(spark, sf_dir).select("event_id", fn.time_text(text, "yyyy-MM-dd HH:mm").alias("t"))


@query("f14_zero_dates", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN '0001-01-01' WHEN 1 THEN '2024-01-' || lpad((event_id % 28 + 1)::VARCHAR, 2, '0') ELSE '2024-05-01' END AS t FROM events")
def f14_zero_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0")
    text = F.when(F.col("event_id") % 3 == 0, "0000-00-00").when(F.col("event_id") % 3 == 1, F.concat(F.lit("2024-00-"), day)).otherwise("2024-05-00")
    return events(spark, sf_dir).select("event_id", fn.zero_dates(text).alias("t"))


@query("f17_bson_scalar", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '"' || hex(event_type) || '"' WHEN 1 THEN event_id::VARCHAR ELSE '"' || event_type || '"' END AS t FROM events""")
def f17_bson_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("event_id") % 3
    text = F.when(part == 0, F.concat(F.lit('{"$oid":"'), F.hex("event_type"), F.lit('"}'))).when(part == 1, F.format_string('{"$numberLong":"%d"}', "event_id")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    return events(spark, sf_dir).select("event_id", fn.bson_scalar(text).alias("t"))


@query("f18_decimals_to_text", "SELECT o_orderkey, o_totalprice::DECIMAL(14, 3)::VARCHAR AS price, o_totalprice::DECIMAL(14, 3)::VARCHAR || ';' || o_custkey::DECIMAL(9, 1)::VARCHAR AS nested FROM orders")
def f18_decimals_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(14,3)")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"), F.struct(F.array(price).alias("p"), F.col("o_custkey").cast("decimal(9,1)").alias("c")).alias("n"))
    return fn.decimals_to_text(rows).select("o_orderkey", "price", F.concat_ws(";", F.col("n.p")[0], "n.c").alias("nested"))


@query("f21_normalize_datetimes", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS t, event_type AS u FROM events")
def f21_normalize_datetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", F.array(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "event_type").alias("a"))
    return fn.normalize_datetimes(rows).select("event_id", F.col("a")[0].alias("t"), F.col("a")[1].alias("u"))


@query("f23_interval_text", r"SELECT event_id, 'P' || event_id % 14 || 'M' || user_id || 'DT' || CASE WHEN event_id % 2 = 0 THEN event_id % 60 || '.5' ELSE (event_id % 60)::VARCHAR END || 'S' AS t FROM events")
def f23_interval_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.col("event_id") % 60 * 1000 + F.when(F.col("event_id") % 2 == 0, 500).otherwise(0)
    return events(spark, sf_dir).select("event_id", fn.interval_text(F.col("event_id") % 14, F.col("user_id"), millis).alias("t"))


@query("h11_migrate_columns", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey, NULL::VARCHAR AS note FROM orders")
def h11_migrate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = T.StructType().add("o_orderkey", "string").add("o_custkey", "long").add("note", "string")
    return schema.migrate_columns(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), new)


@query("h13_add_columns", "SELECT o_orderkey AS k, o_orderstatus AS status, NULL::VARCHAR AS name FROM orders UNION ALL SELECT c_custkey, NULL, c_name FROM customer")
def h13_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return schema.add_columns(orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status")), customers.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")))


@query("j3_merge_bounds", "SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN (SELECT min(o_orderkey) FROM orders WHERE o_custkey % 7 = 3 AND o_orderstatus = 'O') AND (SELECT max(o_orderkey) FROM orders WHERE o_custkey % 7 = 3 AND o_orderstatus = 'O')")
def j3_merge_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return merging.within_bounds(orders, merging.merge_bounds(orders.where("o_custkey % 7 = 3 AND o_orderstatus = 'O'"), ["o_orderkey"])).select("o_orderkey")


@query("q6_throughput", """
SELECT o_orderstatus AS tx, count(*) AS docs, round(count(*) * 1000000 / (epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate)) + 86400000000), 3) AS docs_per_s FROM orders GROUP BY 1
UNION ALL SELECT NULL, count(*), round(count(*) * 1000000 / (epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate)) + 86400000000), 3) FROM orders""")
def q6_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("tx"), start.alias("s"), (start + F.expr("INTERVAL 1 DAY")).alias("e"), F.lit(1).cast("long").alias("n"), F.lit(100).cast("long").alias("b"))
    return quality.throughput_stats(rows, "tx", "s", "e", "n", "b").select("tx", "docs", "docs_per_s")


@query("r11_strip_nulls", """SELECT event_id, '{"event_id":' || event_id || CASE WHEN event_id % 2 = 0 THEN ',"kind":"' || event_type || '"' ELSE '' END || ',"user":' || CASE WHEN event_id % 3 = 0 THEN user_id::VARCHAR ELSE 'null' END || '}' AS doc FROM events""")
def r11_strip_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("user"))
    return rows.select("event_id", reduction.strip_null_fields(rows, ["event_id", "kind", "user"], ["user"]).alias("doc"))


@query("s11_type_bracketed", "SELECT event_id FROM events WHERE event_id % 2 = 1 OR user_id > 20")
def s11_type_bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of two types: numbers, and texts, which sort after them."""
    rank = F.when(F.col("event_id") % 2 == 0, scans.TYPE_RANKS["number"]).otherwise(scans.TYPE_RANKS["string"])
    rows = events(spark, sf_dir).select("event_id", rank.alias("rank"), F.col("user_id").alias("number"), F.col("event_type").alias("text"))
    return scans.resume_type_bracketed(rows, "rank", "number", "text", scans.TYPE_RANKS["number"], 20).select("event_id")


@query("s13_restated_rows", "SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN event_type END, '') AS kind, '20240105' AS table_date FROM events WHERE ts::DATE = DATE '2024-01-05'")
def s13_restated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = events(spark, sf_dir).where(F.to_date("ts") == "2024-01-05").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("kind"))
    return scans.read_restated_table(day, "20240105", {"kind": ""}, ["event_id"]).select("event_id", "kind", "_meta.table_date")


@query("s21_finished_folders", """
WITH f AS (SELECT ts::DATE AS folder, max(ts) AS created, count(*) % 3 <> 0 AS done FROM events GROUP BY 1), n AS (SELECT *, (SELECT min(g.folder) FROM f g WHERE g.folder > f.folder) AS next FROM f),
s AS (SELECT n.*, CASE WHEN n.done THEN 'read' WHEN g.created <= TIMESTAMP '2024-01-20' THEN 'skip' ELSE 'wait' END AS state FROM n LEFT JOIN f g ON g.folder = n.next)
SELECT folder, CASE WHEN EXISTS (SELECT 1 FROM s p WHERE p.folder < s.folder AND p.state = 'wait') THEN 'wait' ELSE state END AS action FROM s""")
def s21_finished_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = events(spark, sf_dir).groupBy(F.to_date("ts").alias("folder")).agg(F.max("ts").alias("created"), (F.count(F.lit(1)) % 3 != 0).alias("done"))
    return scans.finished_folders(folders, "folder", "created", "done", "1 hour", F.lit("2024-01-20 01:00:00").cast(folders.schema["created"].dataType)).select("folder", "action")
