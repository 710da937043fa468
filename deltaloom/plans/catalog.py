"""Registered queries over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.functions import scalars as fn
from deltaloom.operators import changes, merging, quality, reduction, shaping
from deltaloom.sources import scans

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Events as a change log: every tenth row is a delete.
LOG = "(SELECT event_id, ts, user_id, event_type, value, props, CASE WHEN event_id % 10 = 9 THEN 'd' WHEN event_id % 10 < 3 THEN 'c' ELSE 'u' END AS op FROM events)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def greatest(df: DataFrame, name: str) -> int:
    """Greatest value of a whole-number column, as a poll or a scan plan starts with it."""
    return df.agg(F.max(name)).first()[0] or 0


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_id") % 10 == 9, "d").when(F.col("event_id") % 10 < 3, "c").otherwise("u")
    return table(spark, sf_dir, "events").withColumn("op", op)


@query("r1_reduce_collection", f"""
WITH l AS {LOG}, a AS (SELECT * FROM l QUALIFY coalesce(max(CASE WHEN op = 'd' THEN event_id END) OVER (PARTITION BY user_id), -1) < event_id)
SELECT user_id, arg_max(event_type, event_id) AS event_type, min(value) AS value, max(ts) AS ts, list_sort(list(DISTINCT event_type))[1] AS first_type FROM a GROUP BY user_id""")
def r1_reduce_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = log(spark, sf_dir).withColumn("types", F.array("event_type"))
    out = reduction.reduce_collection(df, ["user_id"], ["event_id"], {"event_type": "lastWriteWins", "value": "minimize", "ts": "maximize", "types": "set"}, F.col("op") == "d")
    return out.select("user_id", "event_type", "value", "ts", F.col("types")[0].alias("first_type"))


@query("r2_first_last_write", "SELECT user_id, arg_max(event_type, event_id) AS last_type, arg_min(event_type, event_id) AS first_type, arg_max(value, event_id) AS last_value FROM events GROUP BY user_id")
def r2_first_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.struct("event_id")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(reduction.last_write_wins("event_type", o).alias("last_type"), reduction.first_write_wins("event_type", o).alias("first_type"), reduction.last_write_wins("value", o).alias("last_value"))


@query("r3_min_max", "SELECT o_custkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY o_custkey")
def r3_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(reduction.minimize("o_totalprice", F.lit(0)).alias("lo"), reduction.maximize("o_totalprice", F.lit(0)).alias("hi"))


@query("r4_sum", "SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total FROM lineitem GROUP BY l_suppkey")
def r4_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    return df.groupBy("l_suppkey").agg(reduction.total("price", F.lit(0)).cast("double").alias("total"))


@query("r5_append", "SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS types FROM events GROUP BY user_id")
def r5_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("t", F.array("event_type"))
    return df.groupBy("user_id").agg(F.array_join(reduction.append("t", F.struct("event_id")), ",").alias("types"))


@query("r6_set", "SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS states FROM orders GROUP BY o_custkey")
def r6_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").withColumn("s", F.array("o_orderstatus"))
    return reduction.set_union(df, ["o_custkey"], "s").select("o_custkey", F.array_join("s", ",").alias("states"))


@query("r7_deep_merge", "SELECT user_id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) FILTER (WHERE event_id % 3 = 0) AS third FROM events GROUP BY user_id")
def r7_deep_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    doc = F.struct(F.col("event_type").alias("kind"), F.struct(F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("third")).alias("in"))
    out = reduction.reduce_collection(df.withColumn("doc", doc), ["user_id"], ["event_id"], {"doc": "merge"})
    return out.select("user_id", "doc.kind", "doc.in.third")


@query("r8_delete_cuts", f"""
WITH l AS {LOG}, x AS (SELECT *, max(CASE WHEN op = 'd' THEN event_id END) OVER (PARTITION BY user_id) AS cut FROM l)
SELECT user_id, event_id, event_type FROM x WHERE cut IS NULL OR event_id > cut""")
def r8_delete_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduction.after_last_delete(log(spark, sf_dir), ["user_id"], ["event_id"], F.col("op") == "d").select("user_id", "event_id", "event_type")


@query("r9_merge_patch", "SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN json_merge_patch(props::JSON, json_object('t', event_type))::VARCHAR END AS doc FROM events")
def r9_merge_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh patch is no JSON."""
    patch = F.when(F.col("event_id") % 11 == 0, "{no JSON").otherwise(F.to_json(F.struct(F.col("event_type").alias("t"))))
    return table(spark, sf_dir, "events").select("event_id", reduction.json_merge_patch("props", patch).alias("doc"))


@query("r10_delta_combine", "SELECT user_id, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY user_id")
def r10_delta_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumns({"n": F.lit(1).cast("long"), "total": F.col("value").cast("decimal(18,2)")})
    out = reduction.delta_combine(df, ["user_id"], ["event_id"], {"n": "sum", "total": "sum"})
    return out.select("user_id", "n", F.col("total").cast("double").alias("total"))


@query("c1_change_event", f"SELECT op, event_type AS kind, CASE WHEN op = 'u' THEN user_id END AS before_user, event_id AS pos FROM {LOG}")
def c1_change_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = log(spark, sf_dir).withColumns({"image": F.struct(F.col("event_type").alias("kind"), F.col("user_id")), "pos": F.col("event_id")})
    out = changes.change_event(df, "op", "image", "image", ["pos"])
    return out.select("_meta.op", "kind", F.col("_meta.before.user_id").alias("before_user"), F.col("_meta.source.pos").alias("pos"))


@query("c2_precise_backfill", "SELECT event_id, user_id FROM events WHERE event_id >= 400 OR (event_id >= 100 AND user_id <= (event_id // 100) * 10)")
def c2_precise_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = spark.range(1, 5).select((F.col("id") * 100).alias("event_id"), F.when(F.col("id") < 4, F.col("id") * 10).alias("upper"))
    return changes.precise_backfill(chunks, table(spark, sf_dir, "events"), "user_id", "event_id").select("event_id", "user_id")


@query("c4_scan_order", "SELECT o_orderkey, o_custkey FROM (SELECT *, lag(o_custkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS b FROM orders) WHERE o_custkey < b")
def c4_scan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scan_order_violations(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"], "o_orderstatus").select("o_orderkey", "o_custkey")


@query("c5_pack_key", "SELECT user_id, event_type, rank() OVER (ORDER BY event_type, user_id) AS place FROM (SELECT DISTINCT user_id, event_type FROM events)")
def c5_pack_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    packed = F.concat(changes.pack_string(F.col("event_type")), changes.pack_long(F.col("user_id")))
    return changes.row_numbers(df.withColumn("k", packed), ["k"]).select("user_id", "event_type", (F.col("row_id") + 1).alias("place"))


@query("c6_pair_halves", "SELECT event_id // 2 AS row_id, CASE WHEN count(*) = 2 THEN 'u' WHEN max(event_id % 2) = 1 THEN 'c' ELSE 'd' END AS op, max(CASE WHEN event_id % 2 = 0 THEN value END) AS old, max(CASE WHEN event_id % 2 = 1 THEN value END) AS new FROM events WHERE event_id % 7 <> 0 GROUP BY 1")
def c6_pair_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").where("event_id % 7 <> 0").selectExpr("event_id div 2 AS row_id", "0 AS seq", "IF(event_id % 2 = 0, 'DELETE', 'INSERT') AS action", "true AS is_update", "value")
    out = changes.pair_update_halves(df, "row_id", "seq", "action", "is_update", ["value"])
    return out.select("row_id", "op", F.col("before.value").alias("old"), F.col("after.value").alias("new"))


@query("c7_changes_join_current", """
WITH l AS (SELECT user_id, max(event_id) AS version, arg_max(CASE WHEN event_id % 10 = 9 THEN 'D' WHEN event_id % 10 < 3 THEN 'I' ELSE 'U' END, event_id) AS o FROM events WHERE event_id > (SELECT max(event_id) // 10 FROM events) AND event_id <= (SELECT max(event_id) * 9 // 10 FROM events) GROUP BY user_id)
SELECT user_id AS c_custkey, CASE o WHEN 'I' THEN 'c' WHEN 'U' THEN 'u' ELSE 'd' END AS op, version, CASE WHEN o <> 'D' THEN c_name END AS c_name FROM l LEFT JOIN customer ON user_id = c_custkey""")
def c7_changes_join_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 10 == 9, "D").when(F.col("event_id") % 10 < 3, "I").otherwise("U")
    df = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), F.col("event_id").alias("version"), kind.alias("o"))
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    last = greatest(df, "version")
    return changes.changes_join_current(df, base, ["c_custkey"], "version", "o", last // 10, last * 9 // 10)


@query("c8_fill_unchanged", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR ELSE event_type END AS a FROM events")
def c8_fill_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").selectExpr("event_id", "struct(cast(user_id AS string) AS a) AS b", "struct(event_type AS a) AS n", "IF(event_id % 2 = 0, array('a'), array()) AS same")
    return df.select("event_id", *changes.fill_unchanged(df, "b", "n", "same", ["a"]))


@query("c10_drop_non_bound", "SELECT event_id FROM events WHERE event_type IN ('click', 'error')")
def c10_drop_non_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    bindings = kinds.withColumn("mode", F.when(F.col("event_type").isin("click", "error"), "Active").otherwise("Ignore"))
    return changes.drop_non_bound(table(spark, sf_dir, "events"), bindings, "event_type").select("event_id")


@query("c11_committed_only", "SELECT event_id FROM events WHERE event_id % 17 <> 0 AND event_id // 5 IN (SELECT event_id // 5 FROM events WHERE event_id % 17 = 0)")
def c11_committed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("tx", F.expr("event_id div 5"))
    return changes.committed_only(df, "tx", F.col("event_id") % 17 == 0).select("event_id")


@query("c12_snapshot_diff", "SELECT row_id, c_custkey, op FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_id, c_custkey, CASE WHEN row_id < 100 THEN 'u' ELSE 'c' END AS op FROM customer)")
def c12_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.snapshot_diff(table(spark, sf_dir, "customer").select("c_custkey"), 100, ["c_custkey"]).select("row_id", "c_custkey", "op")


@query("c13_full_refresh_tail", "SELECT i AS row_id, CASE WHEN i < (SELECT count(*) FROM supplier) THEN 'u' ELSE 'd' END AS op FROM range(0, (SELECT count(*) + 25 FROM supplier)) t(i)")
def c13_full_refresh_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "supplier").select("s_suppkey")
    return changes.snapshot_diff(df, df.count() + 25, ["s_suppkey"]).select("row_id", "op")


@query("c14_incremental", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-02' AND ts <= TIMESTAMP '2024-01-05'")
def c14_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lambda s: F.lit(s).cast("timestamp_ntz")
    df = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return changes.incremental_capture(df, "ts", cut("2024-01-02"), cut("2024-01-05")).select("event_id")


@query("c15_backfill_split", "SELECT event_id, event_id <= 500 AS backfill FROM events")
def c15_backfill_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = changes.backfill_plus_incremental(table(spark, sf_dir, "events").select("event_id"), "event_id", 500)
    return old.withColumn("backfill", F.lit(True)).unionByName(new.withColumn("backfill", F.lit(False)))


@query("c16_history", "SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS until FROM events")
def c16_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduction.history(table(spark, sf_dir, "events"), ["user_id"], ["event_id"]).select("event_id", F.col("valid_to.event_id").alias("until"))


@query("c17_tombstones", "SELECT o_orderkey, 'd' AS op FROM orders WHERE o_orderstatus = 'F'")
def c17_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.tombstones(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), ["o_orderkey"]).select("o_orderkey", "_meta.op")


@query("c18_join_fragments", "SELECT event_id // 3 AS ev, arg_max(value, event_id)::VARCHAR AS v, count(*) AS n FROM events GROUP BY 1")
def c18_join_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select(F.expr("event_id div 3").alias("ev"), F.col("event_id").alias("f"), F.create_map(F.lit("v"), F.col("value").cast("string"), F.concat(F.lit("k"), F.col("event_id")), F.lit("1")).alias("b"))
    return changes.join_fragments(df, "ev", "f", "b").select("ev", F.col("b")["v"].alias("v"), (F.size("b") - 1).cast("long").alias("n"))


@query("c19_oversize", "SELECT doc_id, CASE WHEN strlen(text) > 200 THEN '{\"truncated\":true,\"original_size\":' || strlen(text) || '}' ELSE text END AS t FROM documents")
def c19_oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", changes.oversize_placeholder(F.col("text"), 200, is_json=True).alias("t"))


@query("c20_multi_log", "SELECT event_id FROM events WHERE event_id <= (SELECT min(m) FROM (SELECT max(event_id) AS m FROM events GROUP BY event_type))")
def c20_multi_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.multi_log_merge(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id").select("event_id")


@query("c21_transactions", "SELECT event_id // 6 AS xid, CASE WHEN max((event_id % 11 = 0)::INT) = 1 THEN 'rolled back' WHEN max((event_id % 4 = 0 AND event_id % 11 <> 0)::INT) = 1 THEN 'committed' ELSE 'pending' END AS state, min(event_id) AS start, count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 4 <> 0) AS n FROM events GROUP BY 1")
def c21_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 11 == 0, "rollback").when(F.col("event_id") % 4 == 0, "commit").otherwise("row")
    df = table(spark, sf_dir, "events").select(F.expr("event_id div 6").alias("xid"), kind.alias("kind"), "event_id")
    return changes.resolve_transactions(df, "xid", "kind", "event_id")


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates and deletes of every third order, and fresh orders."""
    orders = table(spark, sf_dir, "orders")
    old = orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X"))
    new = orders.where("o_orderkey % 5 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10000000)
    return old.unionByName(new)


BATCH = "(SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 5 = 0)"


@query("j1_load_existing", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM {BATCH})")
def j1_load_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _batch(spark, sf_dir)
    return merging.load_existing(table(spark, sf_dir, "orders"), batch, ["o_orderkey"], merging.merge_bounds(batch, ["o_orderkey"])).select("o_orderkey", "o_totalprice")


@query("j2_load_reconstruct", "SELECT c_custkey, '{\"c_custkey\":' || c_custkey || ',\"c_mktsegment\":\"' || c_mktsegment || '\"}' AS document FROM customer WHERE c_custkey % 2 = 0")
def j2_load_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return merging.load_reconstruct(df, df.where("c_custkey % 2 = 0"), ["c_custkey"])


@query("j4_combine_bounds", "SELECT 'k' AS \"column\", min(event_id) AS lo, max(event_id) AS hi FROM events UNION ALL SELECT 'm', NULL, NULL")
def j4_combine_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One batch a type; column m has no lower bound in the batches of one type.
    per = table(spark, sf_dir, "events").groupBy("event_type").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"), F.max(F.when(F.col("event_id") % 3 == 1, F.col("event_id"))).alias("m_hi"))
    first, second = per.select(F.lit("k").alias("column"), "lo", "hi"), per.select(F.lit("m").alias("column"), F.when(F.col("event_type") != "error", F.col("lo")).alias("lo"), F.col("m_hi").alias("hi"))
    return merging.combine_bounds(first.unionByName(second))


@query("j5_merge_into", f"""
WITH b AS {BATCH} SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN t.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus
FROM orders t FULL JOIN b ON t.o_orderkey = b.o_orderkey WHERE b.o_orderkey IS NULL OR b.o_orderkey % 2 = 0""")
def j5_merge_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merge_into(table(spark, sf_dir, "orders"), _batch(spark, sf_dir), ["o_orderkey"], F.col("o_orderkey") % 2 != 0).select("o_orderkey", "o_orderstatus")


@query("j7_delete_by_key", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0")
def j7_delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return merging.delete_by_key(orders, orders.where("o_orderkey % 3 = 0"), ["o_orderkey"]).select("o_orderkey")


@query("j8_skip_absent_deletes", f"SELECT o_orderkey FROM {BATCH} WHERE o_orderkey % 2 = 0 OR o_orderkey IN (SELECT o_orderkey FROM orders)")
def j8_skip_absent_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.skip_absent_deletes(_batch(spark, sf_dir), table(spark, sf_dir, "orders"), ["o_orderkey"], F.col("o_orderkey") % 2 != 0).select("o_orderkey")


@query("j9_soft_delete", f"""
WITH b AS {BATCH} SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN t.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus
FROM orders t FULL JOIN b ON t.o_orderkey = b.o_orderkey WHERE t.o_orderkey IS NOT NULL OR b.o_orderkey % 2 = 0""")
def j9_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merging.merge_into(table(spark, sf_dir, "orders"), _batch(spark, sf_dir), ["o_orderkey"], F.col("o_orderkey") % 2 != 0, soft=True).select("o_orderkey", "o_orderstatus")


@query("j11_versioned_read", f"SELECT user_id, event_id, value FROM (SELECT * FROM {LOG} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE op <> 'd'")
def j11_versioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = log(spark, sf_dir).withColumn("gone", F.col("op") == "d")
    return merging.versioned_read(df.select("user_id", "event_id", "value", "gone"), ["user_id"], "event_id", "gone").select("user_id", "event_id", "value")


@query("j14_join_split_fields", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE c_name END AS c_name, c_acctbal FROM customer")
def j14_join_split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer")
    parts = [df.select("c_custkey", "c_name"), df.select("c_custkey", "c_acctbal"), df.where("c_custkey % 2 = 0").select("c_custkey", F.lit("even").alias("c_name"))]
    return merging.join_split_fields(parts, ["c_custkey"])


@query("j15_attach_children", "SELECT n_nationkey, array_to_string(list_sort(list(s_suppkey) FILTER (WHERE s_suppkey IS NOT NULL)), ',') AS children FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def j15_attach_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merging.attach_children(table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "n_nationkey", "s_nationkey", ["s_suppkey"], "c")
    return out.select("n_nationkey", F.when(F.size("c") > 0, F.array_join(F.transform("c", lambda x: x["s_suppkey"].cast("string")), ",")).alias("children"))


@query("j16_associated", "SELECT conv_id, turn, role FROM conversations")
def j16_associated(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role")).alias("turns"))
    return merging.associated_documents(turns, "turns", ["conv_id"])[1]


@query("e7_webhook_docs", "SELECT event_id || '/' || i AS id, CASE i WHEN 0 THEN user_id::VARCHAR ELSE '{\"a\":' || event_id || '}' END AS body, 'X-Id' AS headers FROM events, range(0, 2) t(i) WHERE event_id % 2 = 0 UNION ALL SELECT event_id::VARCHAR, '{\"b\":\"' || event_type || '\"}', 'X-Id' FROM events WHERE event_id % 2 = 1")
def e7_webhook_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("event_id") % 2 == 0, F.format_string('[%d,{"a":%d}]', "user_id", "event_id")).otherwise(F.format_string('{"b":"%s"}', "event_type"))
    df = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), body.alias("body"), F.create_map(F.lit("Authorization"), F.lit("x"), F.lit("X-Id"), F.col("event_type")).alias("h"))
    return shaping.webhook_docs(df, "body", "id", "h", ["authorization"]).select("id", "body", F.array_join(F.map_keys("h"), ",").alias("headers"))


@query("e8_route_requests", r"SELECT page_id, CASE WHEN regexp_matches(p, '^/en/[^/]+/?$') THEN 'english' WHEN regexp_matches(p, '^/[^/]+/[^/]+/?$') THEN 'any' ELSE 'rest' END AS target FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS p FROM pages)")
def e8_route_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", shaping.route_requests(path, [("*", "rest"), ("/{lang}/{id}", "any"), ("/en/{id}", "english")]).alias("target"))


@query("e9_path_params", r"SELECT page_id, regexp_extract(p, '^/([^/]+)/([^/]+)/?$', 1) AS lang, regexp_extract(p, '^/([^/]+)/([^/]+)/?$', 2) AS item FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS p FROM pages) WHERE regexp_matches(p, '^/([^/]+)/([^/]+)/?$')")
def e9_path_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", shaping.path_params(path, "/{lang}/{item}").alias("p")).where("p IS NOT NULL").select("page_id", "p.lang", "p.item")


@query("e11_event_rows", "SELECT conv_id, turn, role FROM conversations")
def e11_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role")).alias("acts"))
    return shaping.event_rows_with_envelope(members, "acts", ["conv_id"]).select("_meta.conv_id", "turn", "role")


@query("e13_report_rows", "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def e13_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.lit("status"), F.lit("priority")).alias("h"), F.array("o_orderstatus", "o_orderpriority").alias("v"))
    return df.select("o_orderkey", *shaping.report_rows(df, "h", "v", ["status", "priority"]))


@query("e16_coerce_text", "SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 7 = 0 THEN NULL ELSE floor(value)::BIGINT END AS n FROM events")
def e16_coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 14 == 0, "1e30").when(F.col("event_id") % 7 == 0, "many").otherwise(F.floor("value").cast("double").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", shaping.coerce_text(text, "integer").alias("n"))


@query("e17_hourly", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, max(ts) AS last_update, round(sum(value::DECIMAL(18,4)), 4)::DOUBLE AS total FROM events WHERE ts < date_trunc('hour', TIMESTAMP '2024-01-20 10:10:00' - INTERVAL 15 MINUTE) GROUP BY 1, 2")
def e17_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shaping.hourly_aggregates(table(spark, sf_dir, "events"), "ts", ["event_type"], "value", F.lit("2024-01-20 10:10:00").cast("timestamp_ntz"))
    return out.withColumn("total", F.col("total").cast("double"))


@query("e18_index_by_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def e18_index_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", shaping.index_by_path(F.col("props"), "$.k").alias("k"))


@query("e19_key_pointer", "SELECT p_partkey, '/' || replace(replace(p_type || '/~', '~', '~0'), '/', '~1') AS pointer, p_type || '/~' AS name FROM part")
def e19_key_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = shaping.key_pointer(F.concat("p_type", F.lit("/~")))
    return table(spark, sf_dir, "part").select("p_partkey", p.alias("pointer"), shaping.pointer_name(p).alias("name"))


@query("e20_catalog_name", r"SELECT s_suppkey, 'db/' || regexp_replace(lower(s_name), '[^\p{L}\p{N}_.-]', '_', 'g') AS name FROM supplier")
def e20_catalog_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", shaping.catalog_name(F.lit("DB"), F.col("s_name")).alias("name"))


@query("e22_sheet_dates", "SELECT o_orderkey, (DATE '1899-12-30' + (o_orderkey % 50000)::INT)::DATE AS d FROM orders")
def e22_sheet_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", shaping.sheet_value((F.col("o_orderkey") % 50000).cast("double"), "date").alias("d"))


@query("f3_text_to_int", "SELECT o_orderkey, floor(o_totalprice)::BIGINT AS n FROM orders")
def f3_text_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.text_to_int(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).cast("long").alias("n"))


@query("f6_parse_rfc3339", "SELECT event_id, ts FROM events")
def f6_parse_rfc3339(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("z"))
    return table(spark, sf_dir, "events").select("event_id", fn.parse_rfc3339(text).cast("timestamp_ntz").alias("ts"))


@query("f9_base64_hex", "SELECT c_custkey, lower(hex(c_name)) AS h FROM customer")
def f9_base64_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", fn.base64_to_hex(F.base64(F.col("c_name").cast("binary"))).alias("h"))


@query("f10_range_text", "SELECT o_orderkey, '[' || o_orderkey || ',' || (o_orderkey + 5) || ')' AS r FROM orders")
def f10_range_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.range_to_text(F.col("o_orderkey"), F.col("o_orderkey") + 5, F.lit(True), F.lit(False), F.lit(False)).alias("r"))


@query("f11_unflatten", "SELECT vec_id, i::INT AS row_no, embedding[4 * i + 1]::DOUBLE AS first, embedding[4 * i + 4]::DOUBLE AS last FROM (SELECT vec_id, embedding, unnest(range(0, len(embedding) // 4)) AS i FROM embeddings)")
def f11_unflatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "embeddings")
    n = df.select(F.size("embedding").alias("n")).first().n
    rows = df.select("vec_id", F.posexplode(fn.unflatten_array(F.col("embedding"), [n // 4, 4])).alias("row_no", "r"))
    return rows.select("vec_id", "row_no", F.col("r")[0].cast("double").alias("first"), F.col("r")[3].cast("double").alias("last"))


@query("f15_bits", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN '18446744073709551615' WHEN 1 THEN NULL ELSE user_id::VARCHAR END AS n FROM events")
def f15_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = F.when(F.col("event_id") % 5 == 0, "1" * 64).when(F.col("event_id") % 5 == 1, "12").otherwise(F.bin("user_id"))
    return table(spark, sf_dir, "events").select("event_id", fn.bits_to_number(bits).cast("string").alias("n"))


@query("f19_encode_row", "SELECT n_nationkey, '{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}' AS doc FROM nation")
def f19_encode_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", fn.encode_row(["n_regionkey", "n_nationkey", "n_name"]).alias("doc"))


@query("f20_embedding_input", "SELECT n_nationkey, 'n_name: \"' || n_name || '\"' || chr(10) || 'n_regionkey: ' || n_regionkey AS text FROM nation")
def f20_embedding_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", fn.embedding_input(["n_regionkey", "n_name"]).alias("text"))


@query("f22_est_row_size", "SELECT s_suppkey, (8 + 8 + 4 + strlen(s_name))::INT AS size FROM supplier")
def f22_est_row_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "supplier")
    return df.select("s_suppkey", fn.est_row_size(df).alias("size"))


@query("s6_keyset_chunk", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey) > (100, 2, 0) ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 500")
def s6_keyset_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.scan_keyset_chunk(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber", "l_partkey"], [100, 2, 0], 500)


@query("s7_scan_ranges", "WITH m AS (SELECT max(o_orderkey) AS m FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey <= m // 4 THEN 0 ELSE 1 END AS range_no FROM orders, m WHERE o_orderkey > m // 10 AND o_orderkey <= m")
def s7_scan_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last = greatest(orders, "o_orderkey")
    return scans.scan_ranges(orders, "o_orderkey", [(last // 10, last // 4), (last // 4, last)]).select("o_orderkey", "range_no")


@query("s8_scan_segments", "SELECT count(*) AS n, count(DISTINCT c_custkey) AS keys FROM customer")
def s8_scan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.scan_segments(table(spark, sf_dir, "customer"), "c_custkey", 8).where("segment BETWEEN 0 AND 7").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("keys"))


@query("s9_poll_cursor", "SELECT event_id FROM events WHERE user_id > 20 OR (user_id = 20 AND event_id > 50)")
def s9_poll_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.poll_cursor(table(spark, sf_dir, "events"), ["user_id", "event_id"], [20, 50]).select("event_id")


@query("s10_xid_window", "WITH m AS (SELECT max(event_id) AS m FROM events) SELECT event_id FROM events, m WHERE event_id >= m // 10 AND event_id <= m * 9 // 10")
def s10_xid_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Transaction ids that begin at 10 and wrap at 32 bits; frozen ids don't occur among those asked for.
    events = table(spark, sf_dir, "events")
    last = greatest(events, "event_id")
    wrapped = events.withColumn("xid", F.pmod(F.col("event_id") + 2**32 + 10, F.lit(2**32)))
    return scans.poll_xid_window(wrapped, "xid", last // 10 + 10, last * 9 // 10 + 10).select("event_id")


@query("s12_restated_tables", "WITH t AS (SELECT DISTINCT ts::DATE AS d FROM events), o AS (SELECT d AS oldest FROM t ORDER BY d DESC LIMIT 1 OFFSET 2) SELECT d, CASE WHEN d <= (SELECT oldest FROM o) THEN 'final' ELSE 'arrival' END AS action FROM t")
def s12_restated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct().withColumn("state", F.lit(None).cast("string"))
    return scans.plan_restated_tables(days, "d", "state", 3, False).select("d", "action")


@query("s14_select_tables", """
WITH n AS (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN 'app' ELSE 'app.c' END AS schema, event_type || CASE WHEN event_id % 3 = 0 THEN '.old' ELSE '' END AS name FROM events)
SELECT schema, name FROM n WHERE schema = 'app' AND name LIKE 'c%' OR name LIKE '_rror' OR name LIKE 'p%.old'""")
def s14_select_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob with a schema, one for every schema, and one with a dot in the name."""
    schema = F.when(F.col("event_id") % 2 == 0, "app").otherwise("app.c")
    names = table(spark, sf_dir, "events").select(schema.alias("schema"), F.concat("event_type", F.when(F.col("event_id") % 3 == 0, ".old").otherwise("")).alias("name")).distinct()
    return scans.select_tables(names, ["app.c*", "?rror", r"p*\.old"], table="name")


@query("s15_plan_windows", """
WITH RECURSIVE c AS MATERIALIZED (SELECT row_number() OVER (ORDER BY start) AS i, * FROM (SELECT date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY 1)),
w AS (SELECT i, start, n, 0::BIGINT AS window_no, n AS held FROM c WHERE i = 1
  UNION ALL SELECT c.i, c.start, c.n, window_no + (held + c.n > 100)::BIGINT, CASE WHEN held + c.n > 100 THEN c.n ELSE held + c.n END FROM w JOIN c ON c.i = w.i + 1)
SELECT window_no, min(start) AS start, max(start) AS last, sum(n)::BIGINT AS n FROM w GROUP BY 1""")
def s15_plan_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.plan_windows(table(spark, sf_dir, "events"), "ts", 100)


@query("s18_hash_ranges", "SELECT o_orderkey FROM orders")
def s18_hash_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    halves = [scans.hash_range_filter(orders, ["o_orderkey"], a, b) for a, b in ((0, 2**31 - 1), (2**31, 2**32 - 1))]
    return halves[0].unionByName(halves[1])


@query("s19_realtime_delayed", """
WITH f AS (SELECT * FROM events WHERE event_id % 3 <> 0), s AS (SELECT user_id, max(ts) AS seen FROM f GROUP BY 1)
SELECT event_id FROM f UNION ALL SELECT e.event_id FROM events e LEFT JOIN s USING (user_id) WHERE seen IS NULL OR seen < ts""")
def s19_realtime_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return scans.realtime_plus_delayed(events.where("event_id % 3 <> 0"), events, ["user_id"], "ts").select("event_id")


@query("q1_compare_docs", "SELECT c_custkey, '/c_name' AS path FROM customer WHERE c_custkey % 4 = 0")
def q1_compare_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    have = want.withColumn("c_name", F.when(F.col("c_custkey") % 4 != 0, F.col("c_name"))).withColumn("more", F.lit(1))
    return quality.compare_docs(have, want, ["c_custkey"]).select("c_custkey", "path")


@query("q2_check_transitions", "SELECT event_id FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b = event_type")
def q2_check_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kinds = [r.event_type for r in events.select("event_type").distinct().collect()]
    allowed = [(a, b) for a in [None, *kinds] for b in kinds if a != b]
    return quality.check_transitions(events, ["user_id"], ["event_id"], "event_type", allowed).select("event_id")


@query("q3_obfuscate", r"""
SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(c_name, '[^A-Za-z0-9]', '~', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '9', 'g') AS shape,
  true AS hidden, length(abs(c_nationkey)::VARCHAR) AS digits, sign(c_acctbal)::INT AS sign, c_custkey AS first_of_segment FROM (SELECT *, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS f FROM customer) WHERE c_custkey = f
UNION ALL SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(c_name, '[^A-Za-z0-9]', '~', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '9', 'g'),
  true, length(abs(c_nationkey)::VARCHAR), sign(c_acctbal)::INT, f FROM (SELECT *, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS f FROM customer) WHERE c_custkey <> f""")
def q3_obfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each masked character, whether the name changed, and the first key of each masked segment."""
    customer = table(spark, sf_dir, "customer")
    masked = quality.obfuscate(customer, "salt", ["/c_custkey"]).join(customer.select("c_custkey", F.col("c_name").alias("old")), "c_custkey")
    shape = F.col("c_name")
    for pattern, letter in (("[^A-Za-z0-9]", "~"), ("[A-Z]", "A"), ("[a-z]", "a"), ("[0-9]", "9")):
        shape = F.regexp_replace(shape, pattern, letter)
    firsts = masked.groupBy("c_mktsegment").agg(F.min("c_custkey").alias("first_of_segment"))
    return masked.join(firsts, "c_mktsegment").select("c_custkey", shape.alias("shape"), (F.col("c_name") != F.col("old")).alias("hidden"), F.length(F.abs("c_nationkey").cast("string")).cast("long").alias("digits"), F.signum("c_acctbal").cast("int").alias("sign"), "first_of_segment")


@query("q7_stream_lag", "SELECT event_type, count(*) AS n, (epoch_us(TIMESTAMP '2024-03-01') - max(epoch_us(ts))) / 1000000 AS lag_s FROM events GROUP BY 1")
def q7_stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return quality.stream_lag(df, ["event_type"], "ts", F.lit("2024-03-01 00:00:00").cast("timestamp"))


FLAGSHIP: Query = r1_reduce_collection


def queries() -> dict[str, Query]:
    from deltaloom.plans import catalog_flows, catalog_tables, catalog_values  # noqa: F401  register their queries

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
