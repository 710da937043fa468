import json
import random
import struct
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import scalars as fn
from deltaloom.operators import changes, merging, quality, reduction, shaping
from deltaloom.plans import schema as sc
from deltaloom.sources import scans, sinks


def one(spark, *exprs):
    return spark.range(1).select(*exprs).first()


def test_delete_then_insert_again(spark):
    df = spark.createDataFrame([(1, 1, "c", "a", 5), (1, 2, "d", None, 7), (1, 3, "c", "b", None), (2, 4, "c", "x", 1), (2, 5, "d", None, 1), (None, 6, "c", "n", 2)], "k int, pos int, op string, name string, v int")
    out = reduction.reduce_collection(df, ["k"], ["pos"], {"name": "lastWriteWins", "v": "sum"}, F.col("op") == "d")
    assert {(r.k, r.name, r.v) for r in out.collect()} == {(1, "b", None), (None, "n", 2)}


def test_reduction_of_empty_frame(spark):
    df = spark.createDataFrame([], "k int, pos int, v int")
    assert reduction.reduce_collection(df, ["k"], ["pos"], {"v": "sum"}).count() == 0


def test_json_merge_patch_and_fold(spark):
    df = spark.createDataFrame([('{"a":{"b":1,"c":2},"d":3}', '{"a":{"b":null},"e":[1]}'), (None, '{"x":null}'), ('{"a":1}', None)], "t string, p string")
    got = [r[0] for r in df.select(reduction.json_merge_patch("t", "p")).collect()]
    assert got == ['{"a":{"c":2},"d":3,"e":[1]}', "{}", '{"a":1}']
    rows = spark.createDataFrame([(1, 2, '{"a":null,"b":2}'), (1, 1, '{"a":1}'), (1, 3, None)], "k int, pos int, doc string")
    assert reduction.reduce_collection(rows, ["k"], ["pos"], {"doc": "merge"}).first().doc == '{"b":2}'


def test_patch_map_and_strip_nulls(spark):
    m = one(spark, reduction.patch_map(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit(None).cast("string"), F.lit("c"), F.lit("3"))).alias("m")).m
    assert m == {"b": "2", "c": "3"}
    df = spark.createDataFrame([(1, None, None)], "a int, b int, c int")
    assert df.select(reduction.strip_null_fields(df, ["a", "b", "c"]).alias("j")).first().j == '{"a":1}'
    assert json.loads(df.select(reduction.strip_null_fields(df, ["a", "b", "c"], ["c"]).alias("j")).first().j) == {"a": 1, "c": None}


def test_json_diff(spark):
    diffs = "array<struct<op:string,path:string,value:string>>"
    df = spark.createDataFrame([('{"a":[1,2],"b":{"c":1}}', [("insert", "$.a[1]", "9"), ("replace", "$.b.c", '"x"'), ("remove", "$.a[0]", None)])], f"d string, x {diffs}")
    assert df.select(changes.apply_json_diff("d", "x")).first()[0] == '{"a":[9,2],"b":{"c":"x"}}'


def test_oversize_cut_keeps_code_points(spark):
    df = spark.createDataFrame([("héllo",), ("abc",), (None,), ("日本",)], "c string")
    assert [r[0] for r in df.select(changes.oversize_placeholder(F.col("c"), 2)).collect()] == ["h", "ab", None, ""]


def test_content_digest_sees_order(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "row_id int, v string")
    b = spark.createDataFrame([(0, "y"), (1, "x")], "row_id int, v string")
    assert changes.content_digest(a).first() != changes.content_digest(b).first()


def test_digest_of_repeated_rows_and_unchanged_snapshots(spark):
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    digest = changes.snapshot_digest
    assert digest(rows("a", "a", "b")) == digest(rows("b", "a", "a").repartition(3)) != digest(rows("b")) and digest(rows("a", "a")) != digest(rows("b", "b")) and digest(rows(None)) != digest(rows("null"))
    now = rows("a", "b", "c")
    assert changes.snapshot_diff(now, 3, ["v"], digest(rows("c", "b", "a"))).count() == 0
    assert sorted((r.row_id, r.op) for r in changes.snapshot_diff(now, 4, ["v"], digest(rows("a"))).collect()) == [(0, "u"), (1, "u"), (2, "u"), (3, "d")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sets_and_patches_of_hot_keys(spark):
    """A million rows of one key, without gathering them."""
    many = spark.range(1_000_000).selectExpr("0 AS k", "id AS pos", "array(id % 7, null) AS s")
    out = reduction.reduce_collection(many, ["k"], ["pos"], {"s": "set", "pos": "maximize"})
    assert "collect_list" not in plan_of(out) and [tuple(r) for r in out.collect()] == [(0, [None, 0, 1, 2, 3, 4, 5, 6], 999_999)]
    odd = spark.createDataFrame([(1, None), (1, []), (2, None), (None, [3, 3])], "k int, s array<int>")
    assert {(r.k, tuple(r.s)) for r in reduction.set_union(odd, ["k"], "s").collect()} == {(1, ()), (2, ()), (None, (3,))}


def test_composed_patches_equal_a_fold(spark):
    rng = random.Random(5)

    def patch(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([None, 1, "x", [1], {}])
        return {rng.choice("abc"): patch(depth - 1) for _ in range(rng.randint(0, 3))}

    rows, want = [], {}
    for k in [None, *range(6)]:
        value, seen = None, False
        for pos in range(rng.choice([1, 5, 300])):
            p = rng.choice([patch(3), patch(3), "bad", None])
            text = None if p is None else "{bad" if p == "bad" else json.dumps(p)
            rows.append((k, pos, text))
            if text is not None and text != "{bad":
                value, seen = reduction._patched(value, p), True
        want[k] = json.dumps(value, sort_keys=True, separators=(",", ":")) if seen else None
    df = spark.createDataFrame(rows, "k int, pos int, doc string").repartition(5)
    out = reduction.reduce_collection(df, ["k"], ["pos"], {"doc": "merge", "pos": "maximize"})
    assert "collect_list" not in plan_of(out) and {r.k: r.doc for r in out.collect()} == want
    trees = [reduction.patch_tree(patch(3)) for _ in range(60)]
    for a, b, c in zip(trees, trees[1:], trees[2:]):
        assert reduction.composed(reduction.composed(a, b), c) == reduction.composed(a, reduction.composed(b, c))
        for doc in (None, 5, {"a": {"b": 1, "c": 2}, "b": {"a": 3}}):
            assert reduction.applied(reduction.composed(a, b), doc) == reduction.applied(b, reduction.applied(a, doc))


def test_as_of_join_on_random_logs(spark, monkeypatch):
    rng = random.Random(8)
    marks = [(rng.randrange(300), rng.choice([0, 1, None]), rng.choice([None, *range(50)])) for _ in range(60)]
    rows = [(rng.randrange(-5, 310), rng.choice([0, 1, 2, None]), rng.randrange(50)) for _ in range(900)]
    chunks, log = spark.createDataFrame(marks, "pos long, t long, upper long"), spark.createDataFrame(rows, "pos long, t long, k long").withColumn("id", F.monotonically_increasing_id())
    far = lambda u: float("inf") if u is None else u
    for partition in (None, "t"):
        def passes(pos, t, k):
            seen = [(m[0], far(m[2])) for m in marks if m[0] <= pos and (partition is None or (m[1] == t and t is not None))]
            return bool(seen) and k <= max(seen)[1]

        want = sorted((r for r in rows if passes(*r)), key=str)
        for most in (10_000, 0):
            monkeypatch.setattr(changes, "MARKS", most)
            out = changes.precise_backfill(chunks, log, "k", "pos", partition)
            if most:
                assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
            assert sorted(((r.pos, r.t, r.k) for r in out.collect()), key=str) == want, (partition, most)


def test_merge_variants(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    batch = spark.createDataFrame([(1, "A", False), (2, None, True), (4, "d", False), (5, "e", True)], "k int, v string, gone boolean")
    assert {tuple(r) for r in merging.merge_into(target, batch, ["k"], F.col("gone")).collect()} == {(1, "A"), (3, None), (4, "d")}
    assert {tuple(r) for r in merging.merge_into(target, batch, ["k"], F.col("gone"), soft=True).collect()} == {(1, "A"), (2, None), (3, None), (4, "d")}
    assert merging.merge_bounds(batch, ["k"]) == {"k": (1, 5)} and merging.merge_bounds(batch.limit(0), ["k"]) == {}
    assert not merging.is_insert_only(target, batch, ["k"]) and merging.is_insert_only(target, batch.where("k > 3"), ["k"])


def test_dynamic_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, p string, v int").write.partitionBy("p").parquet(path)
    merging.move_partitions(spark.createDataFrame([(9, "a", 5)], "k int, p string, v int"), path, "p")
    assert {(r.k, r.p) for r in spark.read.parquet(path).collect()} == {(9, "a"), (2, "b")}


def test_message_shapes(spark):
    df = spark.createDataFrame([("t", 0, 1, '{"a":1,"id":5}', '{"id":7}', 0), ("t", 0, 2, None, '{"id":8}', 0)], "topic string, partition int, offset long, value string, key string, timestamp long")
    got = [(r.document, r._meta.op) for r in shaping.message_doc(df).collect()]
    assert [({k: v for k, v in d.items()}, o) for d, o in got] == [({"a": "1", "id": "7"}, "c"), ({"id": "8"}, "d")]
    body = spark.createDataFrame([('{"x":12345678901234567890,"_meta":{"q":1}}', "m1"), ("plain", "m2"), ("{}", "m3")], "body string, id string")
    docs = [json.loads(r.document) for r in shaping.spread_body(body, "body", ["id"]).collect()]
    assert docs == [{"x": 12345678901234567890, "_meta": {"id": "m1"}}, {"body": "plain", "_meta": {"id": "m2"}}, {"_meta": {"id": "m3"}}]


def test_registry_wire(spark):
    df = spark.createDataFrame([(b"\x00\x00\x00\x00\x07" + b'{"a":1}',), (b'{"b":2}',), (b"\xff\xfe",)], "v binary")
    got = [tuple(r) for r in df.select(shaping.registry_header(F.col("v")), shaping.decode_json_wire(F.col("v")), shaping.decode_json_wire(F.col("v"), key=True)).collect()]
    assert got == [(7, '{"a":1}', '{"a":1}'), (None, '{"b":2}', '{"b":2}'), (None, None, '{"_key":"//4="}')]


def test_routes_refuse_ambiguity():
    with pytest.raises(ValueError):
        shaping.check_routes(["/a/{x}", "/{y}/b"])
    shaping.check_routes(["/a/{x}", "/{x}/{y}", "*"])


def test_names():
    assert shaping.unique_names(["$city", "City", "name"]) == {"$city": "city", "City": "_City", "name": "name"}


def test_scalars(spark):
    r = one(
        spark, fn.special_floats_to_text(F.lit(float("nan"))).alias("nan"), fn.to_text(F.lit(1.5e10), T.DoubleType()).alias("plain"), fn.to_json_text(F.lit("a\"b")).alias("json"), fn.clamp_year_zero(F.lit("0000-05-01")).alias("zero"),
        fn.clamp_range(F.lit("10001-01-01"), "0001-01-01", "9999-12-31").alias("high"), fn.zero_dates(F.lit("2020-00-00")).alias("dates"), fn.uuid_text(F.unhex(F.lit("00112233445566778899AABBCCDDEEFF"))).alias("uuid"),
        fn.interval_text(F.lit(1), F.lit(2), F.lit(3500)).alias("iv"), fn.fix_unpaired_surrogates(F.lit(r'"\ud800x 😀"')).alias("sur"), fn.bson_scalar(F.lit('{"$numberLong":"5"}')).alias("bson"),
    )
    assert (r.nan, r.plain, r.json, r.zero, r.high, r.dates) == ("NaN", "15000000000", '"a\\"b"', "0001-01-01", "9999-12-31", "2020-01-01")
    assert (r.uuid, r.iv, r.sur, r.bson) == ("00112233-4455-6677-8899-aabbccddeeff", "P1M2DT3.5S", chr(34) + chr(92) + "ufffdx 😀" + chr(34), "5")


def test_wkb(spark):
    point = struct.pack("<I", 4326) + struct.pack("<BIdd", 1, 1, 1.5, -2.0)
    line = struct.pack("<I", 0) + struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1)
    df = spark.createDataFrame([(point,), (line,), (None,)], "g binary")
    assert [r[0] for r in df.select(fn.wkb_to_wkt("g")).collect()] == ["POINT(-2 1.5)", "LINESTRING(0 0,1 1)", None]


def test_schema_mapping(spark):
    fields = [sc.Field("id", ("integer",), required=True, key=True), sc.Field("n", ("string", "integer"), format="integer"), sc.Field("x", ("null",)), sc.Field("m", ("string", "object")), sc.Field("d", ("string", "null"), format="date"), sc.Field("big", ("integer",), maximum=2**70)]
    assert [sc.flat_type(f)[0] for f in fields] == ["integer", "string_integer", "never", "multiple", "string", "integer"]
    assert [f.dataType.simpleString() for f in sc.table_schema(fields).fields] == ["bigint", "decimal(38,0)", "string", "date", "decimal(38,0)"]
    got = {r.field: r.constraint for r in sc.validate_fields(spark, fields, None).collect()}
    assert got == {"id": "required", "n": "optional", "x": "forbidden", "m": "optional", "d": "recommended", "big": "recommended"}
    old = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.LongType())])
    new = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.StringType()), T.StructField("w", T.LongType())])
    assert sc.plan_changes(old, new, ["id"]) == [("migrate", "v"), ("add", "w")] and sc.backfill_action(old, new, ["id"]) == "truncate"
    assert sc.backfill_action(new, old, ["id"]) == "recreate"
    assert [tuple(r) for r in sc.migrate_columns(spark.createDataFrame([(1, 5)], old), new).collect()] == [(1, "5", None)]
    texts = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2.5}',)], "j string")
    assert set(sc.infer_schema(spark, texts, "j").names) == {"a", "b"}


def test_file_sweep(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,canary\n1,x\n2,\n")
    (tmp_path / "b.jsonl").write_text('{"id":3}\n{"id":4}\n')
    (tmp_path / "empty.json").write_text("")
    listing = scans.list_files(spark, str(tmp_path))
    taken = scans.sweep_listing(listing, scans.SweepState(), r"\.(csv|jsonl)$")
    assert {(r.path.rsplit("/", 1)[1], r.format) for r in taken.collect()} == {("a.csv", "csv"), ("b.jsonl", "json")}
    rows = scans.sweep_files(spark, [str(tmp_path / "b.jsonl")], "json").orderBy("id").collect()
    assert [(r.id, r._meta.offset) for r in rows] == [(3, 0), (4, 1)]
    state = scans.next_sweep_bounds(scans.SweepState(), taken, monotonic=False)
    assert scans.sweep_listing(listing, state).count() == 0
    assert [tuple(r) for r in scans.read_csv_nulls(spark, str(tmp_path / "a.csv"), "id int, canary string").collect()] == [(1, "x"), (2, None)]
    (tmp_path / "doc.json").write_text('{"items":[{"a":1},{"a":2}],"n":5}')
    items, rest = scans.read_json_items(spark, str(tmp_path / "doc.json"), "items")
    assert sorted(r.a for r in items.collect()) == [1, 2] and rest.columns == ["n"]


def test_windows_and_folders(spark):
    w = scans.split_window(spark, "2024-01-01", "2024-01-02", 4, 3600).orderBy("i").collect()
    assert len(w) == 4 and w[0].end == w[1].start and w[3].end == datetime(2024, 1, 2)
    df = spark.createDataFrame([("f1", datetime(2024, 1, 1), True), ("f2", datetime(2024, 1, 2), False), ("f3", datetime(2024, 1, 3), True), ("f4", datetime(2024, 1, 9), False)], "f string, c timestamp, m boolean")
    got = [r.action for r in scans.finished_folders(df, "f", "c", "m", "1 day", F.lit("2024-01-09").cast("timestamp")).orderBy("f").collect()]
    assert got == ["read", "skip", "read", "wait"]


def test_key_globs(spark):
    df = spark.createDataFrame([("public", "users"), ("public", "user_x"), ("a", "b*c")], "schema string, table string")
    pick = lambda *g: {r.table for r in scans.select_tables(df, list(g)).collect()}
    assert pick("public.user?") == {"users"} and pick(r"a.b\*c") == {"b*c"} and pick("*.user*") == {"users", "user_x"}


def test_versioned_table_commits_once(spark, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert t.merge(rows, "q-0", ["k"]) and not t.merge(rows, "q-0", ["k"])
    assert t.merge(spark.createDataFrame([(1, "A"), (3, "c")], "k int, v string"), "q-1", ["k"])
    assert {tuple(r) for r in t.read().collect()} == {(1, "A"), (2, "b"), (3, "c")}
    fence = t.install_fence()
    with pytest.raises(RuntimeError):
        t.append(rows, "q-2", fence - 1)
    assert t.append(spark.createDataFrame([(4, "d")], "k int, v string"), "q-3", fence) and t.read().count() == 4


def test_stream_into_table_replays(spark, tmp_path):
    from deltaloom.streaming.streams import materialize_stream

    src = str(tmp_path / "src")
    spark.createDataFrame([(1, 1, "c", 5), (2, 2, "c", 6), (1, 3, "u", 7)], "k int, pos int, op string, v int").coalesce(1).write.parquet(src)
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))

    def run(checkpoint):
        s = spark.readStream.schema("k int, pos int, op string, v int").parquet(src)
        materialize_stream(s, t.read, lambda rows, batch: t.merge(rows, batch, ["k"], F.col("_gone")), "q", ["k"], ["pos"], {"op": "lastWriteWins", "v": "lastWriteWins", "pos": "maximize"}, str(tmp_path / checkpoint), "op").awaitTermination()

    run("c1")
    run("c2")  # the same batch id again: nothing is applied twice
    assert {(r.k, r.v) for r in t.read().collect()} == {(1, 7), (2, 6)} and t.commits().count() == 1


def test_batches_reduce_like_one(spark):
    """Three batches with deletes, a null key and every kind of strategy equal one batch."""
    from deltaloom.streaming.streams import reduced_with_loaded

    strategies = {"s": "sum", "lo": "minimize", "tags": "append", "first": "firstWriteWins", "last": "lastWriteWins"}
    rows = [(k, pos, "d" if pos % 7 == 3 else "c", pos, 50 - pos, [str(pos)], f"f{pos}", None if pos % 5 == 0 else f"l{pos}") for pos in range(30) for k in [None if pos % 6 == 0 else pos % 4]]
    kind = "k int, pos int, op string, s bigint, lo int, tags array<string>, first string, last string"
    frame = lambda some: spark.createDataFrame(some, kind)
    target = None
    for part in (rows[:9], rows[9:10], rows[10:22], rows[22:]):
        out = reduced_with_loaded(target, frame(part), ["k"], ["pos"], strategies, "op")
        base = frame([]).select("k", *strategies) if target is None else target
        merged = merging.merge_into(base, out, ["k"], F.col("_gone"))
        target = spark.createDataFrame(merged.collect(), merged.schema)
    want = reduction.reduce_collection(frame(rows), ["k"], ["pos"], strategies, F.col("op") == "d")
    assert sorted(map(str, target.select("k", *strategies).collect())) == sorted(map(str, want.collect())) and target.count() > 2


def test_null_keys_match(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "A"), (2, "c")], "k int, v string")
    assert {tuple(r) for r in merging.merge_into(old, new, ["k"]).collect()} == {(None, "A"), (1, "b"), (2, "c")}
    assert {tuple(r) for r in merging.merge_into(old, new, ["k"], F.col("k").isNull()).collect()} == {(1, "b"), (2, "c")}
    assert {tuple(r) for r in merging.load_existing(old, new, ["k"], merging.merge_bounds(new, ["k"])).collect()} == {(None, "a")}
    assert {tuple(r) for r in merging.join_split_fields([old, new.withColumnRenamed("v", "w")], ["k"]).collect()} == {(None, "a", "A"), (1, "b", None), (2, None, "c")}
    assert {tuple(r) for r in merging.delete_by_key(old, new, ["k"]).collect()} == {(1, "b")}


def test_windows_stay_below_the_limit(spark):
    hours = [60, 60, 60, 10, 30, 250, 5, 95, 1]
    df = spark.createDataFrame([(datetime(2024, 1, 1, h),) for h, n in enumerate(hours) for _ in range(n)], "ts timestamp")
    assert [r.n for r in scans.plan_windows(df, "ts", 100).orderBy("window_no").collect()] == [60, 60, 100, 250, 100, 1]
    assert scans.plan_windows(df.limit(0), "ts", 100).count() == 0
    rng = random.Random(1)
    sizes = [(datetime(2024, 1, 1 + i // 24, i % 24), rng.choice([1, 3, 9, 20])) for i in range(600)]
    many = spark.createDataFrame(sizes, "ts timestamp, n int").selectExpr("explode(array_repeat(ts, n)) AS ts")
    want, held = [], 0
    for _, n in sizes:
        if held and held + n > 21:
            held = 0
        want[-1:] = [held + n] if held else [*want[-1:], n]
        held += n
    assert [r.n for r in scans.plan_windows(many, "ts", 21).orderBy("window_no").collect()] == want
    assert [r.window_no for r in scans.plan_windows(many, "ts", 21).orderBy("start").collect()] == list(range(len(want)))


def test_final_day_of_the_window(spark):
    days = spark.createDataFrame([(f"2024010{i}", "final" if i == 1 else None) for i in range(1, 6)], "d string, s string")
    got = {r.d: r.action for r in scans.plan_restated_tables(days, "d", "s", 3, False).collect()}
    assert got == {"20240105": "arrival", "20240104": "arrival", "20240103": "final", "20240102": "final"}
    assert {r.action for r in scans.plan_restated_tables(days.where("d > '20240103'"), "d", "s", 3, False).collect()} == {"arrival"}


def test_payloads_and_keys_that_are_no_objects(spark):
    df = spark.createDataFrame([("[1]", "7", "t", 0, 1, None), ("oops", '{"id":1}', "t", 0, 2, None), (None, None, "t", 0, 3, None)], "value string, key string, topic string, partition int, offset long, timestamp timestamp")
    got = [r.document for r in shaping.message_doc(df).collect()]
    assert got == [{"_value": "[1]", "_key": "7"}, {"_value": '"oops"', "id": "1"}, {}]
    shards = spark.createDataFrame([('{"a":1,"_meta":5}', "s1"), ("[2]", "s2"), ('{"_meta":{"x":"y"}}', "s3")], "p string, shard string")
    assert [(r.document, r._meta) for r in shaping.stream_record_doc(shards, "p", ["shard"]).collect()] == [('{"a":1}', {"shard": "s1"}), ('{"_value":[2]}', {"shard": "s2"}), ("{}", {"x": "y", "shard": "s3"})]


def test_routes_neither_more_specific(spark):
    with pytest.raises(ValueError):
        shaping.check_routes(["/a/{x}/{y}", "/{x}/b/c"])
    with pytest.raises(ValueError):
        shaping.check_routes(["/a/{x}", "/a/{y}"])
    shaping.check_routes(["/a/b/{y}", "/a/{x}/{y}", "/{z}/c/{y}/d", "*"])


def test_year_in_utc_decides(spark):
    texts = ["9999-12-31T23:59:59-14:00", "9999-12-31T23:59:59+14:00", "0001-01-01T01:00:00+02:00", "0001-01-01", "2024-05-05T00:00:00Z", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(fn.clamp_range(F.col("t"), "0001-01-01", "9999-12-31")).collect()]
    assert got == ["9999-12-31", texts[1], "0001-01-01", texts[3], texts[4], None]


def test_coordinates_are_shortest(spark):
    def point(x, y, srid=0):
        return struct.pack("<IBIdd", srid, 1, 1, x, y)

    df = spark.createDataFrame([(point(0.1, -2.5),), (point(0.1, 3.0, 4326),), (point(1e15, 1e-15),), (point(123456789012345.0, 1e-7),)], "g binary")
    assert [r[0] for r in df.select(fn.wkb_to_wkt("g")).collect()] == ["POINT(0.1 -2.5)", "POINT(3 0.1)", "POINT(1e15 1e-15)", "POINT(123456789012345 0.0000001)"]


def test_masks_leave_nothing(spark):
    df = spark.sql("SELECT 'Ab-9é日' AS t, '2020-01-02' AS d, '2020-01-02T03:04:05Z' AS ts, 12.5D AS x, true AS b, 123.45BD AS dec, map('name', 'Bob') AS m, X'0102' AS raw, -907 AS n, 0 AS z, CAST(9223372036854775807 AS bigint) AS big, 127Y AS tiny, array(1.5D) AS a, CAST(NULL AS string) AS none")
    row, again = quality.obfuscate(df, "salt", []).first(), quality.obfuscate(df, "salt", []).first()
    old = df.first()
    assert row == again and row.none is None
    assert all(row[c] != old[c] for c in ("t", "d", "ts", "x", "dec", "m", "raw", "n", "a"))
    assert len(row.t) == 6 and row.t[0].isupper() and row.t[1].islower() and row.t[2] > "\u4dff" and row.t[3].isdigit() and row.t[4].isascii() and row.t[4].islower() and row.t[5] != "日"
    datetime.strptime(row.d, "%Y-%m-%d"), datetime.strptime(row.ts, "%Y-%m-%dT%H:%M:%SZ")
    assert -999 <= row.n <= -100 and 0 <= row.z <= 9 and row.big >= 10**18 and 100 <= row.tiny <= 127 and "name" not in row.m and "Bob" not in row.m.values() and len(row.raw) == 2


def test_chunks_by_intervals_or_by_union(spark, monkeypatch):
    events = spark.range(200).selectExpr("id AS pos", "id % 2 AS t", "(id * 7) % 50 AS k")
    chunks = spark.createDataFrame([(20, 0, 10), (60, 1, 30), (90, 0, 40), (150, 1, None)], "pos long, t long, upper long")
    for partition in (None, "t"):
        few = {r.pos for r in changes.precise_backfill(chunks, events, "k", "pos", partition).collect()}
        monkeypatch.setattr(changes, "MARKS", 0)
        assert few == {r.pos for r in changes.precise_backfill(chunks, events, "k", "pos", partition).collect()} and 20 < len(few) < 180
        monkeypatch.undo()


def test_stream_drops_late_rows(spark, tmp_path):
    from deltaloom.streaming.streams import dedup_emitted

    src, at = str(tmp_path / "s"), datetime(2024, 1, 1, 10)
    rows = [("a", at, True, 1), ("a", at, False, 2), ("b", at, False, 3)]
    spark.createDataFrame(rows, "k string, ts timestamp, fast boolean, n int").coalesce(1).write.parquet(src)
    feed = spark.readStream.schema("k string, ts timestamp, fast boolean, n int").parquet(src)
    q = dedup_emitted(feed, "k", "ts").writeStream.format("memory").queryName("late_rows").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.n for r in spark.table("late_rows").collect()} == {1, 3}


def test_rolling_files_and_keys(spark, tmp_path):
    sinks.write_rolling_files(spark.range(1000), str(tmp_path / "r"), "parquet", 800)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1000 and len(list((tmp_path / "r").glob("*.parquet"))) >= 10
    key = one(spark, sinks.file_key("p", "%Y/%m", F.lit("2024-03-01").cast("timestamp"), 2, F.lit(7)).alias("k")).k
    assert key == "p/2024/03/v0000000002/00000000000000000007"
    sinks.write_json(spark.createDataFrame([(1, None)], "a int, b int"), str(tmp_path / "j"), skip_nulls=True)
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":1}'
    assert 'WHEN MATCHED AND s."gone" THEN DELETE' in sinks.merge_statement("t", "s", ["k", "v"], ["k"], "gone")


def test_many_rolling_files_are_written_by_several_tasks_in_order(spark, tmp_path):
    sinks.write_rolling_files(spark.range(2000).coalesce(1), str(tmp_path), "parquet", 80)
    files = sorted(tmp_path.glob("*.parquet"))
    assert len({f.name[:10] for f in files}) > 1 and len(files) >= 200
    found = [spark.read.parquet(str(f)) for f in files[:2] + files[-1:]]
    first, second, last = ([r.id for r in f.collect()] for f in found)
    assert first == list(range(10)) and second == list(range(10, 20)) and last[-1] == 1999
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path)).collect()) == list(range(2000))


def test_masking_is_deterministic(spark):
    df = spark.createDataFrame([("Ab-12 é", 123, datetime(2024, 1, 1), Row(uuid="u1", t="xyz"))], "s string, n int, at timestamp, _meta struct<uuid:string,t:string>")
    a, b = (quality.obfuscate(df, "salt", ["/_meta/uuid"]).first() for _ in range(2))
    assert a == b and a.s != "Ab-12 é" and len(a.s) == 7 and a.s[2] > "\u4dff" and a._meta.uuid == "u1" and 100 <= a.n <= 999
    assert quality.obfuscate(df, "other", []).first() != a


def test_workload_and_sample(spark):
    w = quality.change_workload(spark, [100, 100], 64, 0.2, 0.1, 3)
    assert [tuple(r) for r in w.groupBy("tx", "op").count().orderBy("tx", "op").collect()] == [(0, "c", 100), (1, "c", 70), (1, "d", 10), (1, "u", 20)]
    assert w.where("length(payload) <> 64").count() == 0 and w.where("tx = 1").select("id").distinct().count() == 100
    assert sorted(w.collect()) == sorted(quality.change_workload(spark, [100, 100], 64, 0.2, 0.1, 3).collect())
    s = quality.sample_zipf(spark.range(1, 1001), 50, F.col("id"), 1.2, 1, "id")
    assert s.count() == 50 and s.select("id").distinct().count() == 50


def test_globs_of_schemas_and_names(spark):
    df = spark.createDataFrame([("s", "foo"), ("s", "app_y"), ("app_x", "foo"), ("ms", "foo.bar"), ("s", "foo\nx")], "schema string, table string")
    pick = lambda g: sorted((r.schema, r.table) for r in scans.select_tables(df, [g]).collect())
    assert pick("foo") == [("app_x", "foo"), ("s", "foo")] and pick("app_*") == [("s", "app_y")] and pick("app_x.*") == [("app_x", "foo")]
    assert pick(r"foo\.bar") == pick(r"ms.foo\.bar") == [("ms", "foo.bar")] and pick("*.foo") == pick("foo") and pick("s.foo?x") == [("s", "foo\nx")]
    for bad in ("a.b.c", ".a", "a.", "", "a\\"):
        with pytest.raises(ValueError):
            scans.glob_regexes(bad)


def test_all_digits_of_floats(spark):
    cases = {1e30: "1" + "0" * 30, 1e-20: "0." + "0" * 19 + "1", -1.25e-7: "-0.000000125", 123.456: "123.456", -0.0: "-0", 1e7: "10000000", 1.7976931348623157e308: "17976931348623157" + "0" * 292, 100.5: "100.5", float("inf"): "Infinity"}
    df = spark.createDataFrame([(x,) for x in cases], "x double")
    assert [r[0] for r in df.select(fn.to_text(F.col("x"), T.DoubleType())).collect()] == list(cases.values())


def test_values_are_ready_for_json_in_any_zone(spark):
    sql = "SELECT TIMESTAMP '2024-01-01 00:00:00Z' AS t, TIMESTAMP '2024-11-03 05:30:00.25Z' AS fold, TIMESTAMP_NTZ '2024-03-10 02:30:00' AS gap, map('a', array(1e10D)) AS m, INTERVAL '1 02:03:04.5' DAY TO SECOND AS d, INTERVAL '-0 00:00:01' DAY TO SECOND AS neg, INTERVAL '0' SECOND AS zero, INTERVAL '1-2' YEAR TO MONTH AS ym, CAST(NULL AS TIMESTAMP) AS none"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = shaping.avro_values(spark.sql(sql)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.t, r.fold, r.gap, r.none) == ("2024-01-01T00:00:00.000000Z", "2024-11-03T05:30:00.250000Z", "2024-03-10T02:30:00.000000Z", None)
    assert r.m == {"a": ["10000000000"]} and (r.d, r.neg, r.zero, r.ym) == ("P1DT2H3M4.5S", "-PT1S", "PT0S", "P14M")


def test_values_outside_their_type(spark):
    r = one(spark, shaping.coerce_text(F.lit("1e30"), "integer").alias("n"), fn.bits_to_number(F.lit("1" * 64)).alias("bits"), fn.bits_to_number(F.lit("2")).alias("no"), fn.bits_to_number(F.lit("0" * 9 + "1" * 64)).alias("led"), shaping.ymd_date(F.struct(F.lit(2023).alias("year"), F.lit(2).alias("month"), F.lit(30).alias("day"))).alias("none"), shaping.ymd_date(F.struct(F.lit(2024).alias("year"), F.lit(2).alias("month"), F.lit(29).alias("day"))).cast("string").alias("leap"))
    assert tuple(r) == (None, 2**64 - 1, None, 2**64 - 1, None, "2024-02-29")


def test_edits_of_odd_documents(spark):
    diffs = "array<struct<op:string,path:string,value:string>>"
    rows = [
        (None, [("replace", "$.a", "1")]), (None, [("replace", "$", '{"n":1}'), ("insert", "$.m", "2")]), ("no JSON", [("insert", "$.a", "1")]), ('{"a":1}', [("remove", "$", None)]), ('{"a b":{"c.d":1}}', [("replace", '$."a b"."c.d"', "2")]),
        ('{"a":1}', [("replace", "$.b", "2"), ("remove", "$.x.y[3]", None), ("insert", "$.a.z", "1")]), ('{"a":[1]}', [("replace", "$.a[5]", "2"), ("insert", "$.a[5]", "3")]), ('{"a":1}', None),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, f"d string, x {diffs}").select(changes.apply_json_diff("d", "x")).collect()]
    assert got == [None, '{"m":2,"n":1}', None, None, '{"a b":{"c.d":2}}', '{"a":1}', '{"a":[1,3]}', '{"a":1}']
    assert changes.key_path('$.a."b\\"c"[10].d') == ["a", 'b"c', 10, "d"]


def test_patches_that_are_no_json(spark):
    df = spark.createDataFrame([("{", '{"a":1}'), ('{"a":1}', "oops"), ("{", None), ("{", "5")], "t string, p string")
    assert [r[0] for r in df.select(reduction.json_merge_patch("t", "p")).collect()] == [None, None, "{", None]


def test_schema_texts_keep_names(spark):
    texts = spark.createDataFrame([('{"AVOID":1,"VOID":null,"OBJECT":{"a`VOID>":[null]},"x,VOID>":{}}',), ("no JSON",)], "j string")
    found = sc.infer_schema(spark, texts, "j")
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {"AVOID": "bigint", "VOID": "string", "OBJECT": "struct<a`VOID>:array<string>>", "x,VOID>": "struct<>"}
    assert sc.infer_schema(spark, texts.where("j = 'no JSON'"), "j").names == ["value"]


def test_masks_of_times_and_variants(spark):
    df = spark.sql("""SELECT TIMESTAMP '2024-05-06 07:08:09Z' AS t, TIMESTAMP_NTZ '2024-05-06 07:08:09' AS n, DATE '2024-05-06' AS d, CAST(NULL AS DATE) AS none, parse_json('{"name":"Bob7","n":[-1234,2.5,true,null]}') AS v""")
    times = lambda row: (row.t, row.n, row.d)
    rows = [quality.obfuscate(df, salt, []).selectExpr("t", "n", "d", "none", "to_json(v) AS v").first() for salt in ("a", "b", "a")]
    assert rows[0] == rows[2] and all(x != y for x, y in zip(times(rows[0]), times(rows[1]))) and rows[0].none is None
    assert any((r.t.minute, r.t.second) != (8, 9) for r in rows[:2]) and any(abs((r.t - datetime(2024, 5, 6)).days) > 999 for r in rows[:2])
    v = json.loads(rows[0].v)
    assert set(v) == {"name", "n"} and v["name"] != "Bob7" and v["name"][0].isupper() and v["name"][3].isdigit() and -9999 <= v["n"][0] <= -1000 and v["n"][3] is None


def test_merge_text_quotes_names():
    text = sinks.merge_statement("s.t", "stage", ['a"b', "v"], ['a"b'], "gone")
    assert 'MERGE INTO "s"."t" t USING "stage" s ON t."a""b" IS NOT DISTINCT FROM s."a""b"' in text and 's."gone" IS NOT TRUE' in text
    assert "UPDATE" not in sinks.merge_statement("t", "s", ["k"], ["k"])


def test_backfill_modes_and_drops(spark):
    rows = [("", True, False, False), ("", True, True, False), (None, True, False, True), ("Normal", True, False, False), ("Precise", True, True, True), ("Only Changes", True, False, False), ("Without Primary Key", True, False, False), ("Precise", False, False, False)]
    df = spark.createDataFrame(rows, "m string, b boolean, u boolean, f boolean")
    state = changes.backfill_state(F.col("m"), F.col("b"), F.col("u"), F.col("f"))
    assert [r[0] for r in df.select(state).collect()] == ["Backfill", "UnfilteredBackfill", "UnfilteredBackfill", "UnfilteredBackfill", "Backfill", "Active", "KeylessBackfill", "Ignore"]
    with pytest.raises(Exception, match="invalid backfill mode"):
        spark.createDataFrame([("Odd", True, False, False)], df.schema).select(state).collect()
    modes = {"p": "Backfill", "u": "UnfilteredBackfill", "k": "KeylessBackfill", "a": "Active", "i": "Ignore", "m": "Missing"}
    states = spark.createDataFrame(list(modes.items()), "t string, mode string")
    scan = spark.createDataFrame([(t, k, 0, "s") for t in modes for k in (1, 2, 2)], "t string, k int, pos int, v string")
    events = spark.createDataFrame([(t, k, p, "e") for t in [*modes, "x"] for k, p in ((1, 10), (5, 20))], scan.schema)
    chunks = spark.createDataFrame([("p", 5, 3)], "t string, pos int, upper int")
    got = changes.backfilled(scan, chunks, events, states, "t", "k", "pos").collect()
    count = lambda t, v: sorted((r.k, r._meta.row if r._meta else None) for r in got if (r.t, r.v) == (t, v))
    assert count("p", "s") == count("u", "s") == [(1, None), (2, None), (2, None)] and count("k", "s") == [(1, 1), (2, 1), (2, 2)] and not count("a", "s")
    assert count("p", "e") == [(1, None)] and count("u", "e") == count("k", "e") == count("a", "e") == [(1, None), (5, None)] and {r.t for r in got} == {"p", "u", "k", "a"}
    bound = spark.createDataFrame([("a", "Active"), ("b", "Missing"), ("c", "Ignore"), ("d", "Missing")], "t string, mode string")
    log = spark.createDataFrame([("a", "drop"), ("a", "row"), ("c", "drop"), ("z", "drop")], "t string, kind string")
    found = changes.after_drops(bound, log, spark.createDataFrame([("a",), ("b",)], "t string"), "t", F.col("kind") == "drop")
    assert {r.t: r.mode for r in found.collect()} == {"a": "Missing", "b": "Pending", "c": "Ignore", "d": "Missing"}


def test_body_and_header_routes(spark):
    rows = [("/x", '{"a":{"b":7},"t":true}', {}), ("/x", '{"a":{"b":"seven"}}', {}), ("/x", "[1]", {}), ("/x", '{"a":5}', {}), ("/x", '{"a":{"b":7}}', {"x-kind": "h"}), ("/y", "no JSON", {}), ("/y", '{"t":null}', {}), ("/y", '{"t":true}', {})]
    df = spark.createDataFrame(rows, "p string, b string, h map<string,string>")
    target = shaping.route_requests(F.col("p"), [("/x", "url")], headers=(F.col("h"), [("X-Kind", "h", "head")]), body=(F.col("b"), [("a.b", "7", "number"), ("a.b", "seven", "text"), ("t", "True", "flag")]))
    assert [r[0] for r in df.select(target).collect()] == ["number", "text", "url", "url", "head", None, None, "flag"]
    for bad in ([("a", "1", "x"), ("a", "1", "y")], [("a.", "1", "x")]):
        with pytest.raises(ValueError):
            shaping.route_requests(F.col("p"), [], body=(F.col("b"), bad))
    with pytest.raises(ValueError):
        shaping.route_requests(F.col("p"), [], headers=(F.col("h"), [("A", "1", "x"), ("a", "1", "y")]))


def test_resume_over_mixed_types(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, parse_json('null')), (2, parse_json('5')), (3, parse_json('7.25')), (4, parse_json('1e300')), (5, parse_json('9007199254740993')), (6, parse_json('"a"')), (7, parse_json('"é"')), (8, parse_json('{"x":1}')),
      (9, CAST(X'01FF' AS variant)), (10, parse_json('false')), (11, parse_json('true')), (12, CAST(TIMESTAMP '2024-01-01 00:00:00Z' AS variant)), (13, CAST(DATE '2024-06-01' AS variant)), (14, CAST(NULL AS variant)) AS t(i, c)""")
    after = lambda last: sorted(r.i for r in scans.resume_after(df, "c", last).collect())
    everything = list(range(2, 14))
    assert after(None) == everything and after(5) == everything[1:] and after(7.25) == [4, *everything[3:]] and after(9007199254740992) == [4, *everything[3:]] and after(2e300) == everything[4:]
    assert after("a") == everything[5:] and after("z") == everything[5:] and after("日") == everything[6:] and after(b"\x01") == everything[7:] and after(False) == everything[9:] and after(True) == [12, 13] and after(datetime(2024, 3, 1)) == [13]
    with pytest.raises(TypeError):
        scans.resume_after(df, "c", [1])


def test_sheets_and_datatypes(spark):
    assert shaping.sheet_headers(28)[-3:] == ["Z", "AA", "AB"] and shaping.sheet_headers(703)[-1] == "AAA"
    cell = "struct<text:string,flag:boolean,number:double,form:string>"
    rows = [(1, [("x", None, None, None), (None, False, None, None), (None, None, 2.5, None)]), (2, [(None, None, 45292.0, "DATE"), (None, None, 45292.75, "DATE_TIME"), (None, None, None, None)]), (3, [(None, None, None, None)]), (4, [])]
    got = shaping.sheet_rows(spark.createDataFrame(rows, f"n int, cells array<{cell}>"), "cells", ["h1", "h2", "h3"])
    docs = {r.n: json.loads(r.j) for r in got.select("n", F.to_json("cells").alias("j")).collect()}
    assert docs[1] == {"h1": "x", "h2": False, "h3": 2.5} and docs[2]["h1"] == "2024-01-01" and docs[2]["h2"].startswith("2024-01-01 18:00:00") and set(docs) == {1, 2}
    with pytest.raises(Exception, match="more cells"):
        shaping.sheet_rows(spark.createDataFrame(rows, f"n int, cells array<{cell}>"), "cells", ["h1"]).collect()
    df = spark.createDataFrame([("01/02/2024 03:04:05", "", 1.5, None), ("01/02/2024", "true", None, None)], "t string, b string, d double, s string")
    out = shaping.normalize_by_datatype(df, {"t": "TIMESTAMP", "b": "BOOLEAN", "d": "DECIMAL", "s": "SEQUENCE"}, "+02:00").collect()
    assert [tuple(r) for r in out] == [(datetime(2024, 1, 2, 1, 4, 5), None, "1.5", None), (datetime(2024, 1, 1, 22), "true", None, None)]
    for bad in ({"t": "TIMESTAMP"}, {"t": "SEQUENCE"}):
        with pytest.raises(Exception):
            shaping.normalize_by_datatype(spark.createDataFrame([("2024-01-02",)], "t string"), bad, "UTC").collect()


def test_null_tokens_and_types_of_targets(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v,n\n1,NULL,5\n2,,n/a\nn/a,"x,y",7\n')
    rows = scans.read_csv_nulls(spark, str(tmp_path / "a.csv"), "id int, v string, n long", null_values={"NULL", "n/a"}).collect()
    assert [tuple(r) for r in rows] == [(1, None, 5), (2, "", None), (None, "x,y", 7)]
    assert [r.v for r in scans.read_csv_nulls(spark, str(tmp_path / "a.csv"), "id string, v string, n string", null_values={"", "NULL"}).collect()] == [None, None, "x,y"]
    (tmp_path / "b.csv").write_text("id,v\n1,2,3\n")
    with pytest.raises(Exception):
        scans.read_csv_nulls(spark, str(tmp_path / "b.csv"), "id int, v string", null_values={""}).collect()
    F_ = sc.Field
    kinds = [sc.spark_type(f).simpleString() for f in (F_("a", ("string",), max_length=20), F_("b", ("string",), max_length=10**6), F_("c", ("string",), max_length=9, content="application/json"), F_("d", ("integer",), meta={"ddl": "decimal(9,2)"}), F_("e", ("string",), format="date", max_length=10))]
    assert kinds == ["varchar(20)", "string", "string", "decimal(9,2)", "date"]
    bound = spark.createDataFrame([("x", ["S", "T"]), ("y", ["s", "t"]), ("z", ["s.t"]), ("w", ["s", "u"])], "b string, p array<string>")
    assert [(r.table, r.bindings) for r in sc.shared_tables(bound, "b", "p").collect()] == [("s.t", ["x", "y"])] and sc.shared_tables(bound, "b", "p", folded=False).count() == 0


def test_times_and_dates_of_all_ages(spark):
    dates = ["2024-01-02", "infinity", "-infinity", "20221-05-06", "0044-03-15 BC", "oops", None]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    assert [tuple(r) for r in df.select(fn.date_text(F.col("d")), fn.date_text(F.col("d"), as_date=False)).collect()] == [
        ("2024-01-02", "2024-01-02T00:00:00Z"), ("9999-12-31", "9999-12-31T23:59:59Z"), ("0000-01-01", "0000-01-01T00:00:00Z"), ("0000-01-01", "0000-01-01T00:00:00Z"), ("0000-01-01", "0000-01-01T00:00:00Z"), (None, None), (None, None),
    ]
    times = ["12:34:56.50+02", "12:34:56-05:30", "01:02:03.123456789Z", "01:02:03+00", "noon"]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in times], "t string").select(fn.timetz_text(F.col("t"))).collect()] == ["12:34:56.5+02:00", "12:34:56-05:30", "01:02:03.123456789Z", "01:02:03Z", "noon"]
    assert [r[0] for r in spark.createDataFrame([(0,), (45_296_500_000,), (86_399_999_999,), (None,)], "m long").select(fn.time_of_day_text(F.col("m"))).collect()] == ["00:00:00Z", "12:34:56.5Z", "23:59:59.999999Z", None]


def test_extended_json_documents(spark):
    docs = ['{"_id":{"$oid":"ab"},"t":{"$date":{"$numberLong":"1730233606250"}},"u":{"$date":1730233606000},"n":[{"$numberDecimal":"1.50"},{"$numberLong":"9"},{"$numberDouble":"NaN"}],"b":{"x":{"$binary":{"base64":"SGk=","subType":"00"}},"_id":5}}', '{"_id":{"a":1}}', '{"_id":7,"$oid":"x"}', "no", None]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in docs], "d string").select(fn.bson_documents("d")).collect()]
    assert json.loads(got[0]) == {"_id": "ab", "t": "2024-10-29T20:26:46.25Z", "u": "2024-10-29T20:26:46Z", "n": ["1.50", 9, "NaN"], "b": {"x": "SGk=", "_id": 5}}
    assert [None if g is None else json.loads(g) for g in got[1:]] == [{"_id": '{"a":1}'}, {"_id": "7", "$oid": "x"}, None, None]


def test_ads_reports(spark):
    doc = {
        "id": 5, "pivot": "p", "changeAuditStamps": {"created": {"time": 1629581275000}, "lastModified": {"time": 1629664544760}}, "dateRange": {"start": {"month": 8, "day": 13, "year": 2021}, "end": {"month": 2, "day": 30, "year": 2021}},
        "targetingCriteria": {"include": {"and": [{"or": {"titles": ["t1", "t2"], "odd": 5}}, {"or": {"geo": {"g": 1}}}]}, "exclude": {"or": {"k1": [], "k2": ["x"]}}},
        "variables": {"data": {"Creative": {"activity": "urn", "n": 0, "deep": {"a": [1]}}}}, "pivotValues": ["a", "b"],
    }
    rows = [json.dumps(doc), '{"id":6,"variables":{"other":1}}', "[1]", None]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = [r[0] for r in shaping.flatten_ads(spark.createDataFrame([(r,) for r in rows], "d string"), "d", ["pivot"]).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert json.loads(got[0]) == {
        "id": 5, "_pivot": "p", "created": "2021-08-21 21:27:55", "lastModified": "2021-08-22 20:35:44", "start_date": "2021-08-13", "pivotValues": ["a", "b"], "string_of_pivot_values": "a,b",
        "targetingCriteria": {"include": {"and": [{"type": "odd", "values": []}, {"type": "titles", "values": ["t1", "t2"]}, {"type": "geo", "values": [{"g": 1}]}]}, "exclude": {"or": [{"type": "k1", "values": []}, {"type": "k2", "values": ["x"]}]}},
        "variables": {"type": "Creative", "values": [{"key": "activity", "value": '"urn"'}, {"key": "deep", "value": '{"a":[1]}'}, {"key": "n", "value": "0"}]},
    }
    assert json.loads(got[1]) == {"id": 6, "variables": {"other": 1}} and got[2:] == [None, None]


def test_digits_of_floats_are_planned_once(spark):
    """Digits of random exponents and signs; the text and its parts are not computed again for every use."""
    from decimal import Decimal

    df = spark.range(400).selectExpr("cast(concat(if(id % 2 = 0, '-', ''), pmod(hash(id), 100000), 'e', id - 200) as double) AS x")
    found = df.select(F.col("x").cast("string").alias("s"), fn.to_text(F.col("x"), T.DoubleType()).alias("t"))
    for s, t in found.collect():
        want = format(Decimal(s), "f")
        assert t == (want.rstrip("0").rstrip(".") if "." in want else want), s
    plan = df.select(fn.to_text(F.col("x"), T.DoubleType()).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp") <= 1
