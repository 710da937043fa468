import gzip
import json
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from deltaloom.sources import named_files


def names(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file())


def test_names_and_numbers(spark, tmp_path):
    df = spark.range(2_000, numPartitions=2).selectExpr("id", "concat('text ', id) AS t", "if(id % 3 = 0, null, id / 4) AS x")
    named_files.write_named_files(df, str(tmp_path), "parquet", 9_000, "%Y/%m-%d/%H%M%S%z", 3, "2024-05-06T07:08:09+02:00")
    found = names(tmp_path)
    assert found == [f"2024/05-06/050809+0000/v0000000003/{n:020d}.parquet" for n in range(len(found))] and len(found) == 2
    assert sorted(tuple(r) for r in spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path)).collect()) == sorted(tuple(r) for r in df.collect())
    named_files.write_named_files(df.limit(5), str(tmp_path), "parquet", pattern="%Y/%m-%d/%H%M%S%z", version=3, time="2024-05-06T05:08:09+00:00")
    assert names(tmp_path)[-1].endswith(f"/{2:020d}.parquet") and len(names(tmp_path)) == 3
    named_files.write_named_files(df.limit(0), str(tmp_path / "none"))
    assert names(tmp_path / "none") == []
    zone = timezone(timedelta(hours=9))
    assert named_files.file_prefix("r/", "%Y%Z%%q", datetime(2024, 1, 1, 3, tzinfo=zone), 12) == "r/2023UTC%%q/v0000000012"


def test_size_limit_by_bytes_written(spark, tmp_path):
    df = spark.range(20_000, numPartitions=2).selectExpr("id", "sha2(string(id), 256) AS t")
    named_files.write_named_files(df, str(tmp_path), "csv", 200_000)
    sizes = [p.stat().st_size for p in sorted(tmp_path.rglob("*.csv"))]
    assert len(sizes) == 8 and all(200_000 <= s < 200_000 + 75 * named_files.STEP for s in (sizes[:3] + sizes[4:7]))
    assert spark.read.option("recursiveFileLookup", "true").option("header", "true").csv(str(tmp_path)).distinct().count() == 20_000


def test_json_lines(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b, TIMESTAMP '2024-01-02 03:04:05Z' AS t, 1.50BD AS d, array(named_struct('x', 'é')) AS n")
    named_files.write_named_files(df, str(tmp_path / "z"), "json", skipNulls="true")
    assert names(tmp_path / "z") == [f"v{0:010d}/{0:020d}.jsonl.gz"]
    assert json.loads(gzip.open(next((tmp_path / "z").rglob("*.gz"))).read()) == {"a": 1, "t": "2024-01-02T03:04:05.000000Z", "d": "1.50", "n": [{"x": "é"}]}
    named_files.write_named_files(df.select("a", "b"), str(tmp_path / "p"), "json", gzip="false")
    assert next((tmp_path / "p").rglob("*.jsonl")).read_text() == '{"a":1,"b":null}\n'


def test_failed_tasks_leave_nothing(spark, tmp_path):
    rows = spark.range(4_000, numPartitions=4).select(F.when(F.col("id") == 3_500, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        named_files.write_named_files(rows, str(tmp_path), "csv", 100)
    assert names(tmp_path) == []
    named_files.write_named_files(spark.range(10), str(tmp_path), "csv", 100)
    assert [re.sub("^.*/", "", n) for n in names(tmp_path)] and not list(tmp_path.rglob("_staging/*"))
