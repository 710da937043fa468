"""Registered queries of operators that sweep, write, stage and type whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import scalars as fn
from deltaloom.operators import changes, merging, reduction, shaping
from deltaloom.plans import schema
from deltaloom.plans.catalog import query, table
from deltaloom.plans.schema import Field
from deltaloom.session import work_folder
from deltaloom.sources import scans, sinks


@query("s1_sweep_files", 'SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS "offset" FROM orders')
def s1_sweep_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets are positions in the file, which is written in key order."""
    listed = scans.sweep_listing(scans.list_files(spark, sf_dir), scans.SweepState(), r"/orders\.parquet")
    found = scans.sweep_files(spark, [row.path for row in listed.select("path").collect()], "parquet")
    return found.select("o_orderkey", F.col("_meta.offset").alias("offset"))


@query("s2_sweep_bounds", "SELECT event_id FROM events WHERE user_id % 5 <> 0 AND ts > (SELECT max(ts) FROM events WHERE user_id % 5 <> 0 AND ts < TIMESTAMP '2024-01-10')")
def s2_sweep_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a listing: the second sweep takes what changed after the newest file of the first; empty files stay out."""
    listing = table(spark, sf_dir, "events").select("event_id", F.format_string("f/%09d", "event_id").alias("path"), F.col("ts").alias("modified"), (F.col("user_id") % 5).alias("size"))
    first = scans.sweep_listing(listing, scans.SweepState(max_bound="2024-01-10"))
    return scans.sweep_listing(listing, scans.next_sweep_bounds(scans.SweepState(), first, monotonic=False)).select("event_id")


@query("s3_resolve_format", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'parquet' WHEN 1 THEN 'json' WHEN 2 THEN 'csv' WHEN 3 THEN 'txt' END AS format FROM events")
def s3_resolve_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(x) for x in ("PARQUET.gz", "jsonl", "csv.tsv.zst", "txt", "bin")]), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", scans.resolve_format(F.concat(F.lit("root.csv/"), "event_type", F.lit("."), ending)).alias("format"))


@query("s4_csv_nulls", "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type || ', \"' || user_id || '\"' END AS kind FROM events")
def s4_csv_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "s4")
    kind = F.when(F.col("event_id") % 3 > 0, F.concat("event_type", F.lit(', "'), "user_id", F.lit('"'))).otherwise("n/a")
    sinks.write_csv(table(spark, sf_dir, "events").select("event_id", kind.alias("kind")), path)
    return scans.read_csv_nulls(spark, path, "event_id long, kind string", null_value="n/a", escape='"')


@query("s16_split_window", """
WITH b AS (SELECT floor(epoch(max(ts)))::BIGINT - floor(epoch(min(ts)))::BIGINT AS span FROM events), n AS (SELECT span, greatest(1, least(24, span // 3600))::BIGINT AS n FROM b)
SELECT i, span * i // n AS from_s, span * (i + 1) // n AS to_s FROM n, (SELECT unnest(range(24)) AS i) WHERE i < n""")
def s16_split_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "events").agg(*[F.date_trunc("second", f("ts")).cast("string").alias(n) for f, n in ((F.min, "a"), (F.max, "b"))]).first()
    found = scans.split_window(spark, edges.a, edges.b, 24, 3600)
    since = lambda c: F.unix_seconds(c) - F.unix_seconds(F.lit(edges.a).cast("timestamp"))
    return found.select(F.col("i").cast("long").alias("i"), since("start").alias("from_s"), since("end").alias("to_s"))


@query("c3_unfiltered_backfill", "SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def c3_unfiltered_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan has even events, the changes are the odd ones and some that the scan saw too: reduction makes them converge."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    both = changes.unfiltered_backfill(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1 OR event_id % 6 = 0"))
    return reduction.reduce_collection(both, ["user_id"], ["event_id"], {"value": "lastWriteWins", "event_id": "lastWriteWins"}).select("user_id", "event_id", "value")


@query("j6_insert_only", "SELECT o_orderkey, 'fresh' AS batch, true AS appended FROM orders WHERE o_orderkey % 2 = 1 UNION ALL SELECT o_orderkey, 'known', false FROM orders WHERE o_orderkey % 3 = 0")
def j6_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target, out = orders.where("o_orderkey % 2 = 0"), []
    for name, batch in (("fresh", orders.where("o_orderkey % 2 = 1")), ("known", orders.where("o_orderkey % 3 = 0"))):
        out.append(batch.select("o_orderkey", F.lit(name).alias("batch"), F.lit(merging.is_insert_only(target, batch, ["o_orderkey"])).alias("appended")))
    return out[0].unionByName(out[1])


@query("j10_union_staged", "SELECT o_orderkey, o_orderstatus, NULL::DOUBLE AS note FROM orders")
def j10_union_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two staged files, one plain and one compressed, under one schema."""
    orders, paths = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), [work_folder(spark, "j10") for _ in range(2)]
    for i, path in enumerate(paths):
        sinks.write_json(orders.where(F.col("o_orderkey") % 2 == i), path, gzip=bool(i))
    return merging.union_staged(spark, paths, T.StructType().add("o_orderkey", "long").add("o_orderstatus", "string").add("note", "double"))


@query("j12_compact_versions", "SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1 HAVING max(event_id) % 10 <> 9")
def j12_compact_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "j12")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("event_id") % 10 == 9).alias("gone"), (F.col("user_id") % 4).alias("part"))
    rows.write.partitionBy("part").parquet(path)
    merging.compact_versions(rows, ["user_id"], "event_id", "gone", path, "part")
    return spark.read.parquet(path).select("user_id", "event_id", "value")


@query("j13_move_partitions", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0")
def j13_move_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition of the stage is replaced, the others stay."""
    path, orders = work_folder(spark, "j13"), table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    merging.move_partitions(orders, path, "o_orderstatus", append=True)
    merging.move_partitions(orders.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0)), path, "o_orderstatus")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("e2_registry_wire", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id::INT END AS schema_id, CASE WHEN event_id % 3 < 2 THEN props END AS value,
  CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN '{"_key":' || event_id || '}' ELSE '{"_key":"' || base64(encode('~' || event_type)) || '"}' END AS key FROM events""")
def e2_registry_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, framed = F.col("event_id") % 3, F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex("user_id"), 8, "0"))), F.col("props").cast("binary"))
    value = F.when(part == 0, framed).when(part == 1, F.col("props").cast("binary")).otherwise(F.concat(F.lit("~"), "event_type").cast("binary"))
    key = F.when(part == 1, F.col("event_id").cast("string").cast("binary")).otherwise(value)
    rows = table(spark, sf_dir, "events").select("event_id", value.alias("v"), key.alias("k"))
    return rows.select("event_id", shaping.registry_header(F.col("v")).alias("schema_id"), shaping.decode_json_wire(F.col("v")).alias("value"), shaping.decode_json_wire(F.col("k"), key=True).alias("key"))


@query("e5_attribute_messages", """
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"_meta":{"event_id":' || event_id || ',"topic":"t","attributes":{"kind":"' || event_type || '"}' || CASE WHEN event_id % 2 = 0 THEN ',"ordering_key":"u' || user_id || '"' ELSE '' END || '}}' AS document FROM events""")
def e5_attribute_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes and the ordering key, where a message has one, go into ``_meta``."""
    rows = table(spark, sf_dir, "events").withColumns({"topic": F.lit("t"), "attributes": F.create_map(F.lit("kind"), "event_type"), "ordering_key": F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("u"), "user_id"))})
    found = shaping.spread_body(rows, "props", ["event_id", "topic", "attributes", "ordering_key"])
    return found.select(F.get_json_object("document", "$._meta.event_id").cast("long").alias("event_id"), "document")


@query("e14_report_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate::DATE END AS day, o_orderkey * 1001 AS millis FROM orders")
def e14_report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth date is 30 February."""
    real = F.col("o_orderkey") % 6 != 0
    at = F.struct(F.year("o_orderdate").alias("year"), F.when(real, F.month("o_orderdate")).otherwise(2).alias("month"), F.when(real, F.dayofmonth("o_orderdate")).otherwise(30).alias("day"))
    return table(spark, sf_dir, "orders").select("o_orderkey", shaping.ymd_date(at).alias("day"), F.unix_millis(shaping.epoch_millis(F.col("o_orderkey") * 1001)).alias("millis"))


#: Little-endian doubles and their shortest texts.
DOUBLES = {"0000000000000000": "0", "000000000000F03F": "1", "000000000000E0BF": "-0.5", "9A9999999999B93F": "0.1"}


def _pick(values, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


@query("f16_wkb_to_wkt", """
WITH n AS (SELECT event_id, ['0', '1', '-0.5', '0.1'][event_id % 4 + 1] AS x, ['0', '1', '-0.5', '0.1'][user_id % 4 + 1] AS y FROM events)
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'POINT(' || y || ' ' || x || ')' ELSE 'LINESTRING(' || x || ' ' || y || ',' || y || ' ' || x || ')' END AS wkt FROM n""")
def f16_wkb_to_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the system that names the latitude first, and lines without a system."""
    x, y = _pick(DOUBLES, F.col("event_id") % 4), _pick(DOUBLES, F.col("user_id") % 4)
    data = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("E61000000101000000"), x, y)).otherwise(F.concat(F.lit("00000000010200000002000000"), x, y, y, x))
    return table(spark, sf_dir, "events").select("event_id", fn.wkb_to_wkt(F.unhex(data)).alias("wkt"))


@query("h1_map_fields", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'Infinity' ELSE o_totalprice::VARCHAR END::DOUBLE AS price, o_orderdate::DATE AS day, o_orderkey % 2 = 0 AS even FROM orders")
def h1_map_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of a document typed by its fields; one that is only null has no column."""
    price = F.when(F.col("o_orderkey") % 5 == 0, "Infinity").otherwise(F.col("o_totalprice").cast("string"))
    rows = table(spark, sf_dir, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("k"), price.alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), (F.col("o_orderkey") % 2 == 0).cast("string").alias("even"), F.lit(None).cast("string").alias("none"))
    fields = [Field("k", ("integer", "string"), "integer"), Field("price", ("number", "string"), "number"), Field("day", ("string",), "date"), Field("even", ("boolean",)), Field("none", ("null",))]
    return schema.map_fields(rows, fields).withColumn("k", F.col("k").cast("long"))


@query("h3_parquet_schema", "SELECT o_orderkey, o_totalprice, o_orderdate::DATE AS day, '{\"s\":\"' || o_orderstatus || '\"}' AS doc FROM orders")
def h3_parquet_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written and read under the schema that fields give: whole numbers are int64, objects JSON text."""
    fields = [Field("o_orderkey", ("integer",), key=True, required=True), Field("o_totalprice", ("number",)), Field("day", ("string",), "date"), Field("doc", ("object",))]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), F.to_json(F.struct(F.col("o_orderstatus").alias("s"))).alias("doc"))
    kinds, path = schema.parquet_schema(fields), work_folder(spark, "h3")
    sinks.write_parquet(schema.migrate_columns(rows, kinds), path, row_group=1 << 20, dictionary=False)
    return spark.read.schema(kinds).parquet(path)


@query("h4_table_schema", "SELECT user_id, list_sort(list(event_id)) [1] AS least, count(*) AS n FROM events GROUP BY 1")
def h4_table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list typed by its items and a wide integer as decimal(38,0)."""
    fields = [Field("user_id", ("integer",), key=True, required=True), Field("ends", ("array",), items="integer"), Field("n", ("integer",), maximum=2**64)]
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array(F.min("event_id"), F.max("event_id")).alias("ends"), F.count(F.lit(1)).alias("n"))
    return schema.migrate_columns(rows, schema.table_schema(fields)).select("user_id", F.col("ends")[0].alias("least"), F.col("n").cast("long").alias("n"))


@query("h5_infer_schema", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, user_id AS avoid, event_type AS void, NULL::VARCHAR AS nothing FROM events")
def h5_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field names that hold names of types, and one that is only null."""
    names = F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), F.struct(F.col("user_id").alias("AVOID")).alias("OBJECT"), F.array(F.struct(F.col("event_type").alias("VOID"))).alias("ARRAY"), F.lit(None).cast("string").alias("NULL,VOID>"))
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(names, {"ignoreNullFields": "false"}).alias("doc"))
    found = rows.select("event_id", F.from_json("doc", schema.infer_schema(spark, rows, "doc")).alias("d"))
    return found.select("event_id", F.col("d.k").cast("long").alias("k"), F.col("d.OBJECT.AVOID").cast("long").alias("avoid"), F.col("d.ARRAY")[0]["VOID"].alias("void"), F.col("d")["NULL,VOID>"].alias("nothing"))


@query("h6_collection_schema", "SELECT event_id, event_type, CASE WHEN event_id % 10 = 9 THEN 'd' ELSE 'u' END AS op, event_id * 7 AS ts_ms, CASE WHEN event_id % 10 = 9 THEN user_id END AS old_user FROM events")
def h6_collection_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change documents as JSON text, read under the schema that their table gives."""
    rows, gone = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), F.col("event_id") % 10 == 9
    meta = F.struct(F.when(gone, "d").otherwise("u").alias("op"), F.struct((F.col("event_id") * 7).alias("ts_ms"), F.lit("events").alias("table")).alias("source"), F.when(gone, F.struct("event_id", "user_id")).alias("before"))
    text = F.to_json(F.struct("event_id", "event_type", meta.alias("_meta")))
    docs = rows.select(F.from_json(text, schema.collection_schema(rows.schema, ["event_id"])).alias("d"))
    return docs.select("d.event_id", "d.event_type", "d._meta.op", "d._meta.source.ts_ms", F.col("d._meta.before.user_id").alias("old_user"))


@query("h14_select_fields", 'SELECT event_id, value, event_type AS "m/event_type", user_id AS "m/in/user_id" FROM events')
def h14_select_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two levels and one named location below; an excluded one stays out."""
    rows = table(spark, sf_dir, "events").select("event_id", "value", F.struct("event_type", "props", F.struct("user_id", "ts").alias("in")).alias("m"))
    found = schema.select_fields(rows, ["event_id"], depth=2, include={"m/in/user_id": True, "m/props": False, "m/in": False})
    return rows.select(*[c.alias(name) for name, c in found])


@query("k1_rolling_files", "SELECT o_orderkey, o_orderstatus, true AS split FROM orders")
def k1_rolling_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files of a few thousand bytes, read back; ``split`` says that there is more than one file."""
    path = work_folder(spark, "k1")
    sinks.write_rolling_files(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, "parquet", 4096)
    found = spark.read.parquet(path)
    names = found.select(F.col("_metadata.file_path").alias("name"))
    one = names.first()
    return found.withColumn("split", F.lit(one is not None and not names.where(F.col("name") != one.name).isEmpty()))


@query("k2_file_key", "SELECT event_id, 'out/' || strftime(ts, '%Y/%m/%d/h=%H') || '/v0000000003/' || lpad(event_id::VARCHAR, 20, '0') AS key FROM events")
def k2_file_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", sinks.file_key("out/", "%Y/%m/%d/h=%H", F.col("ts"), 3, F.col("event_id")).alias("key"))


@query("k3_write_parquet", "SELECT * FROM customer")
def k3_write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "k3")
    sinks.write_parquet(table(spark, sf_dir, "customer"), path, row_group=1 << 20, compression="zstd")
    return spark.read.parquet(path)


@query("k4_write_csv", """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'a "b", c' WHEN 1 THEN c_name END AS name FROM customer""")
def k4_write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes and separators inside a value, and nulls, come back."""
    path = work_folder(spark, "k4")
    name = F.when(F.col("c_custkey") % 3 == 0, 'a "b", c').when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
    sinks.write_csv(table(spark, sf_dir, "customer").select("c_custkey", name.alias("name")), path)
    return spark.read.schema("c_custkey long, name string").options(header="true", escape='"').csv(path)


@query("k5_write_json", """SELECT '{"c_custkey":' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ',"name":"' || c_name || '"' ELSE '' END || '}' AS line FROM customer""")
def k5_write_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as they stand in the compressed files, without null fields."""
    path = work_folder(spark, "k5")
    sinks.write_json(table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name")), path, skip_nulls=True)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("k15_clone_then_stream", "SELECT c_custkey, c_name || CASE WHEN c_custkey % 6 = 0 THEN '/2' WHEN c_custkey % 3 = 0 THEN '/1' ELSE '' END AS name FROM customer")
def k15_clone_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each key over a clone and two staged batches."""
    clone = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    batch = lambda n: clone.where(F.col("c_custkey") % (3 * n) == 0).select("c_custkey", F.concat("name", F.lit(f"/{n}")).alias("name"), F.lit(n).cast("long").alias("seq"), F.col("c_custkey").alias("offset"))
    rows = sinks.clone_then_stream(clone, batch(1).unionByName(batch(2)), "seq", "offset")
    return rows.groupBy("c_custkey").agg(F.max_by("name", F.struct("seq", "offset")).alias("name"))
