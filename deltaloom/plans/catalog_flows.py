"""Registered queries of operators that keep state or files between their steps, and their SQL."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.operators import changes, quality, shaping
from deltaloom.plans import migration, schema
from deltaloom.plans.catalog import query, table
from deltaloom.session import work_folder
from deltaloom.sources import large_json, named_files, resume, scans
from deltaloom.streaming import capture, transactions


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


@query("c14_cursor_stream", "SELECT event_id, user_id, event_type, true AS twice FROM events")
def c14_cursor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log captured by its id in two runs of a stream, the first up to half of it; ``twice`` says that both had rows."""
    path, log, kinds = work_folder(spark, "c14"), f"{sf_dir}/events.parquet", T.StructType.fromDDL("event_id long, user_id long, event_type string")
    half = table(spark, sf_dir, "events").agg(F.floor(F.max("event_id") / 2).cast("long")).first()[0]
    counts = []
    for horizon in (half, None):
        capture.run_to_files(capture.read_cursor(spark, capture.ParquetLog(log, "event_id", -1, horizon), kinds), f"{path}/out", f"{path}/checkpoint")
        counts.append(spark.read.schema(kinds).parquet(f"{path}/out").count())
    return spark.read.schema(kinds).parquet(f"{path}/out").withColumn("twice", F.lit(0 < counts[0] < counts[1]))


@query("s2_sweep_stream", "SELECT o_orderkey, o_custkey, row_number() OVER () - 1 AS n FROM orders")
def s2_sweep_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of orders swept by a stream, each record with its number in the file."""
    path, kinds = work_folder(spark, "s2"), T.StructType.fromDDL("o_orderkey long, o_custkey long")
    swept = capture.read_sweep(spark, f"{sf_dir}/orders.parquet", "parquet", kinds)
    capture.run_to_files(swept, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select("o_orderkey", "o_custkey", F.col("offset").alias("n"))


@query("c21_transaction_stream", """
WITH l AS (SELECT user_id, event_id, event_type, CASE WHEN event_id % 5 = 4 THEN CASE WHEN user_id % 3 = 0 THEN 'rollback' ELSE 'commit' END ELSE 'row' END AS kind FROM events)
SELECT user_id, event_id, event_type FROM (SELECT *, first_value(CASE WHEN kind <> 'row' THEN kind END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS fate FROM l) WHERE kind = 'row' AND fate = 'commit'""")
def c21_transaction_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events up to each fifth are a transaction; the log comes in two batches, so most go on from one to the other."""
    path = work_folder(spark, "c21")
    kind = F.when(F.col("event_id") % 5 == 4, F.when(F.col("user_id") % 3 == 0, "rollback").otherwise("commit")).otherwise("row")
    log = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", kind.alias("kind"))
    half = log.agg(F.floor(F.max("event_id") / 2).cast("long")).first()[0]
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", transactions.STORE):
        for part in (F.col("event_id") <= half, F.col("event_id") > half):
            log.where(part).write.mode("append").parquet(f"{path}/log")
            stream = spark.readStream.schema(log.schema).parquet(f"{path}/log")
            capture.run_to_files(transactions.committed_stream(stream, "user_id", "kind", "event_id"), f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema(log.schema).parquet(f"{path}/out").select("user_id", "event_id", "event_type")


@query("s8_resumed_segments", "SELECT c_custkey, c_name, true AS in_order FROM customer")
def s8_resumed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four segments scanned in steps by two scans one after the other; ``in_order`` says that later steps have later keys."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name").withColumn("segment", resume.segment(["c_custkey"], 4))
    path, rows = work_folder(spark, "s8"), customer.count() // 8 + 1
    resume.ResumableScan(spark, path, "segment", ["c_custkey"]).step(customer, rows)
    scan = resume.ResumableScan(spark, path, "segment", ["c_custkey"])
    scan.run(customer, rows)
    found = scan.read()
    steps = found.groupBy("segment", "step").agg(F.min("c_custkey").alias("low"), F.max("c_custkey").alias("high"))
    mixed = steps.alias("a").join(steps.alias("b"), F.expr("a.segment = b.segment AND a.step < b.step AND a.high >= b.low"), "left_semi")
    return found.select("c_custkey", "c_name", F.lit(mixed.isEmpty()).alias("in_order"))


@query("c15_subtasks", "SELECT event_id, CASE WHEN ts <= TIMESTAMP '2024-01-10' THEN 'backfill' ELSE 'incremental' END AS subtask FROM events")
def c15_subtasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill and incremental rows as two subtasks of one scan with a cursor each."""
    rows = table(spark, sf_dir, "events").select("event_id", resume.subtask("ts", F.lit("2024-01-10").cast("timestamp")).alias("subtask"))
    scan = resume.ResumableScan(spark, work_folder(spark, "c15"), "subtask", ["event_id"])
    scan.run(rows, rows.count() // 3 + 1)
    return scan.read().select("event_id", "subtask")


@query("h11_resumed_migration", "SELECT o_orderkey::VARCHAR AS id, o_custkey, NULL::VARCHAR AS note, o_orderstatus FROM orders")
def h11_resumed_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status under a new schema; the first run stops after its first partition."""
    path = work_folder(spark, "h11")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(f"{path}/old")
    new = T.StructType.fromDDL("id string NOT NULL, o_custkey long, note string, o_orderstatus string")
    move = migration.Migration(spark, f"{path}/old", f"{path}/new", new, "o_orderstatus", ["o_totalprice"], {"o_orderkey": "id"})

    def stop(step: str) -> None:
        if step.startswith("partitions"):
            raise InterruptedError(step)

    try:
        move.run(stop, together=1)
    except InterruptedError:
        move.run(together=1)
    return move.read().select("id", "o_custkey", "note", "o_orderstatus")


@query("k2_named_files", "SELECT event_id, event_type, true AS named FROM events")
def k2_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in files of some kilobytes under names of their own, read back with a look at each name."""
    path = work_folder(spark, "k2")
    named_files.write_named_files(table(spark, sf_dir, "events").select("event_id", "event_type"), path.removeprefix("file://"), "parquet", 8_192, "%Y/%m-%d", 7, "2024-05-06T07:08:09+00:00")
    found = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return found.select("event_id", "event_type", F.col("_metadata.file_path").rlike(r"/2024/05-06/v0000000007/\d{20}\.parquet$").alias("named"))


@query("c3_backfill_modes", """
WITH s AS (SELECT *, CASE event_type WHEN 'click' THEN 'Backfill' WHEN 'error' THEN 'Active' WHEN 'view' THEN 'KeylessBackfill' ELSE 'UnfilteredBackfill' END AS mode FROM events)
SELECT event_type, user_id, count(*) AS n FROM (SELECT event_type, user_id FROM s WHERE event_id % 2 = 0 AND mode <> 'Active' UNION ALL SELECT event_type, user_id FROM s WHERE event_id % 2 = 1 AND (mode <> 'Backfill' OR (event_id >= 50 AND user_id <= 20))) GROUP BY ALL""")
def c3_backfill_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events are scan rows, odd ones changes; each type is a table with a mode of its own."""
    rows = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    kinds = rows.select("event_type").distinct()
    mode = F.when(F.col("event_type") == "click", "Precise").when(F.col("event_type") == "error", "Only Changes").when(F.col("event_type") == "view", "Without Primary Key").otherwise("Normal")
    states = kinds.select("event_type", changes.backfill_state(mode, F.lit(True), F.lit(False), F.lit(False)).alias("mode"))
    chunks = kinds.select("event_type", F.lit(50).cast("long").alias("event_id"), F.lit(20).cast("long").alias("upper"))
    found = changes.backfilled(rows.where("event_id % 2 = 0"), chunks, rows.where("event_id % 2 = 1"), states, "event_type", "user_id", "event_id")
    return found.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))


@query("c10_after_drops", "SELECT DISTINCT event_type, CASE WHEN event_type = 'error' THEN 'Ignore' WHEN event_type = 'click' THEN 'Missing' ELSE 'Active' END AS mode FROM events")
def c10_after_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    bindings = rows.select("event_type", F.when(F.col("event_type") == "error", "Ignore").otherwise("Active").alias("mode")).distinct()
    return changes.after_drops(bindings, rows, rows, "event_type", F.col("event_type").isin("click", "error") & (F.col("event_id") % 7 == 0))


@query("s11_resume_after", "SELECT event_id FROM events WHERE event_id % 4 IN (1, 2) OR (event_id % 4 = 0 AND user_id > 20) OR event_id % 4 = 3")
def s11_resume_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of four types: numbers, of which those above 20 are left, text, booleans and times."""
    kind = F.col("event_id") % 4
    key = F.when(kind == 0, F.col("user_id").cast("variant")).when(kind == 1, F.col("event_type").cast("variant")).when(kind == 2, (F.col("user_id") > 5).cast("variant")).otherwise(F.col("ts").cast("timestamp").cast("variant"))
    return scans.resume_after(table(spark, sf_dir, "events").withColumn("key", key), "key", 20).select("event_id")


@query("e22_sheet_rows", "SELECT o_orderkey, o_orderstatus AS \"A\", CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS \"B\", strftime(DATE '1899-12-30' + (o_orderkey % 50000)::INT, '%Y-%m-%d') AS \"C\" FROM orders WHERE o_orderkey % 5 <> 0")
def e22_sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth row has empty cells only."""
    cell = lambda text=None, flag=None, number=None: F.struct(*[(F.lit(None) if v is None else F.when(F.col("o_orderkey") % 5 != 0, v)).cast(t).alias(n) for n, v, t in (("text", text, "string"), ("flag", flag, "boolean"), ("number", number, "double"))], F.lit("DATE").alias("form"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.array(cell(F.col("o_orderstatus")), cell(flag=F.col("o_orderkey") % 2 == 0), cell(number=F.col("o_orderkey") % 50000)).alias("cells"))
    found = shaping.sheet_rows(rows, "cells", shaping.sheet_headers(3))
    return found.select("o_orderkey", *[F.try_variant_get(F.col("cells")[name], "$", "string").alias(name) for name in "ABC"])


@query("e23_datatypes", "SELECT o_orderkey, date_trunc('day', o_orderdate) AS at, CASE WHEN o_orderkey % 2 = 0 THEN 'true' END AS flag, o_totalprice::DECIMAL(12,2)::VARCHAR AS price FROM orders")
def e23_datatypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("at"), F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("").alias("flag"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    found = shaping.normalize_by_datatype(rows, {"at": "TIMESTAMP", "flag": "BOOLEAN", "price": "CURRENCY"}, "UTC")
    return found.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("e8_body_routes", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'head' WHEN user_id = 7 THEN 'seven' WHEN event_type = 'click' THEN 'clicks' ELSE 'rest' END AS target FROM events")
def e8_body_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.to_json(F.struct(F.struct(F.col("user_id").alias("id")).alias("user"), F.col("event_type").alias("kind")))
    headers = F.create_map(F.lit("X-Hook"), (F.col("event_id") % 10).cast("string"))
    target = shaping.route_requests(F.lit("/hook"), [("*", "rest")], headers=(headers, [("x-hook", "0", "head")]), body=(body, [("user.id", "7", "seven"), ("kind", "click", "clicks")]))
    return table(spark, sf_dir, "events").select("event_id", target.alias("target"))


@query("h8_shared_tables", "SELECT lower(event_type) AS \"table\", list_sort(list(DISTINCT name)) AS bindings FROM (SELECT event_type, CASE WHEN event_id % 2 = 0 THEN event_type ELSE upper(event_type) END AS name FROM events) GROUP BY 1 HAVING count(DISTINCT name) > 1")
def h8_shared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise(F.upper("event_type"))
    return schema.shared_tables(table(spark, sf_dir, "events").select(name.alias("name")), "name", F.array("name"))


@query("q5_sample_zipf", "SELECT count(*) >= 1 AS some, 50 AS n, 50 AS known FROM customer")
def q5_sample_zipf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the sample and how many of them are customers, once each; a smaller table has fewer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    found = quality.sample_zipf(customer, 50, F.col("c_custkey") + 1, 1.2, 1, "c_custkey")
    return found.join(customer, "c_custkey", "left_semi").agg((F.count(F.lit(1)) >= 1).alias("some"), F.count(F.lit(1)).cast("int").alias("n"), F.count_distinct("c_custkey").cast("int").alias("known"))


@query("s5_large_document", "SELECT event_id, event_type, user_id FROM events")
def s5_large_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one JSON document, whose items are read in ranges of some kilobytes; its last item is null."""
    path = work_folder(spark, "s5")
    body = table(spark, sf_dir, "events").select(F.concat(F.to_json(F.struct("event_id", "event_type", "user_id")), F.lit(",")).alias("value"), F.lit(1).alias("at"))
    ends = spark.createDataFrame([('{"of":{"n":[1,2]},"data":{"events":[', 0), ('null]},"end":"]"}', 2)], "value string, at int")
    body.unionByName(ends).repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    document = spark.read.text(path).inputFiles()[0].removeprefix("file://")
    items, _ = large_json.read_large_json_items(spark, document, "data.events", 1 << 16)
    return items.where(~F.col("item").rlike(r"^\s*null\s*$")).select(F.from_json("item", "event_id long, event_type string, user_id long").alias("e")).select("e.*")
