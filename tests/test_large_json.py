import json
import random

import pytest

from deltaloom.sources import large_json


def value(rng, depth):
    kind = rng.choice(["int", "text", "list", "object", "null"]) if depth else rng.choice(["int", "text", "null"])
    if kind == "list":
        return [value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    if kind == "object":
        return {rng.choice(["items", "a", 'q"', "b\\"]): value(rng, depth - 1) for _ in range(rng.randint(0, 3))}
    return {"int": rng.randint(-9, 999), "text": "".join(rng.choice('ab"\\[]{},:é\n') for _ in range(rng.randint(0, 9))), "null": None}[kind]


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_items_equal_the_parsed_document(spark, tmp_path, size):
    rng = random.Random(size)
    for indent in (None, 2):
        items = [value(rng, 3) for _ in range(25)]
        doc = {"x": value(rng, 3), "items": {"no": [1]}, "data": {"more": value(rng, 2), "items": items, "tail": [1, 2]}, "end": '"items":['}
        path = tmp_path / f"{size}-{indent}.json"
        path.write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(indent)))
        found, rest = large_json.read_large_json_items(spark, str(path), "data.items", size)
        assert [json.loads(r.item) for r in found.orderBy("at").collect()] == items
        assert json.loads(rest) == {**doc, "data": {**doc["data"], "items": []}}
        assert found.rdd.getNumPartitions() == -(-path.stat().st_size // size)


def test_paths_that_lead_to_no_array(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"a":{"b":[]},"c":5,"d":{"x":[1]}, "e": [ ]}')
    items = lambda p: [r.item for r in large_json.read_large_json_items(spark, str(path), p, 9)[0].orderBy("at").collect()]
    assert items("a.b") == [] and items("d.x") == ["1"] and items("e") == []
    for bad in ("c", "a", "a.x", "z"):
        with pytest.raises(ValueError):
            items(bad)


def test_small_ranges_share_tasks(spark, tmp_path):
    """A thousand ranges are scanned by fewer tasks, and every item comes out once."""
    path, items = tmp_path / "small.json", [{"a": i, "b": "\\\" [,"} for i in range(900)]
    path.write_text(json.dumps({"x": items}))
    found, _ = large_json.read_large_json_items(spark, str(path), "x", 20)
    assert path.stat().st_size > 20_000 and found.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert [json.loads(r.item) for r in found.orderBy("at").collect()] == items
