import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.plans import migration
from deltaloom.sources import resume


class Killed(Exception):
    pass


@pytest.mark.parametrize("kind", ["segments", "subtasks"])
def test_killed_scans_go_on(spark, tmp_path, monkeypatch, kind):
    """The run is killed after rows were written and before their state, at two of its steps."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", None]), 1000 - i) for i in rng.sample(range(5_000), 300)]
    part = resume.segment(["k"], 8) if kind == "segments" else resume.subtask("ts", F.lit(400))
    table = spark.createDataFrame(rows, "k long, v string, ts long").withColumn("part", part)
    scan = resume.ResumableScan(spark, str(tmp_path / "scan"), "part", ["k"])
    steps, real = [], resume.ResumableScan.state

    def killed(self):
        if len(steps) in (2, 5):
            steps.append("killed")
            raise Killed
        steps.append("read")
        return real(self)

    for _ in range(4):
        try:
            monkeypatch.setattr(resume.ResumableScan, "state", killed)
            scan.run(table, 17)
        except Killed:
            # Rows of a step without a state are not read.
            monkeypatch.undo()
            spark.createDataFrame([(-1, "x", 1, 0 if kind == "segments" else "backfill")], table.schema).write.mode("overwrite").parquet(f"{tmp_path}/scan/rows/step={len(scan._steps())}")
    monkeypatch.undo()
    found = scan.read()
    assert sorted(tuple(r) for r in found.select("k", "ts").collect()) == sorted((k, ts) for k, _, ts in rows)
    assert scan.state().where("NOT done").isEmpty() and not scan.step(table, 17)
    sizes = [r["count"] for r in found.groupBy("part", "step").count().collect()]
    assert max(sizes) == 17 and found.select("step").distinct().count() >= 3
    assert scan.state().count() == table.select("part").distinct().count()


def test_scan_of_an_empty_table(spark, tmp_path):
    scan = resume.ResumableScan(spark, str(tmp_path), "p", ["k"])
    assert scan.read() is None
    scan.run(spark.createDataFrame([], "k long, p int"), 5)
    assert scan.read().count() == 0


NEW = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("total", T.DoubleType()), T.StructField("note", T.StringType()), T.StructField("p", T.StringType())])


def test_migration_killed_after_every_step(spark, tmp_path):
    rows = [(i, i / 2, "x", ["a", "b", "c", None][i % 4]) for i in range(40)]
    spark.createDataFrame(rows, "k long, amount double, old string, p string").write.partitionBy("p").parquet(str(tmp_path / "old"))
    want = sorted((str(k), amount, None, p or "") for k, amount, _, p in rows)
    seen = []
    for kill in ["schema", "partitions to a", "partitions to b", "partitions to c", "partitions to None", "end", None]:
        def stop(step, kill=kill):
            seen.append(step)
            if step == kill:
                raise Killed

        m = migration.Migration(spark, str(tmp_path / "old"), str(tmp_path / "new"), NEW, "p", ["old"], {"amount": "total"})
        if not m.finished():
            assert m.read().columns == ["k", "amount", "old", "p"]
        try:
            m.run(stop, together=1)
        except Killed:
            continue
    assert len(seen) == len(set(seen)) == 6 and m.finished()
    out = m.read()
    assert sorted((r.k, r.total, r.note, r.p or "") for r in out.collect()) == want and dict(out.dtypes)["k"] == "string"
    with pytest.raises(ValueError):
        migration.Migration(spark, str(tmp_path / "old"), str(tmp_path / "new"), T.StructType(NEW.fields[:2]), "p").run()


def test_migration_refuses_nulls(spark, tmp_path):
    spark.createDataFrame([(None, "a")], "k long, p string").write.partitionBy("p").parquet(str(tmp_path / "old"))
    m = migration.Migration(spark, str(tmp_path / "old"), str(tmp_path / "new"), T.StructType([NEW["k"], NEW["p"]]), "p")
    with pytest.raises(Exception, match="null in required k"):
        m.run()
    assert not m.finished()
