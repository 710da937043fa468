"""Keyed reduction of change documents under declared strategies."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def last_write_wins(value: str, order: Column) -> Column:
    """The value of the newest row, null included; ``order`` must be unique within a key."""
    return F.max_by(F.struct(F.col(value).alias("v")), order)["v"]


def first_write_wins(value: str, order: Column) -> Column:
    return F.min_by(F.struct(F.col(value).alias("v")), order)["v"]


def maximize(value: str, order: Column) -> Column:
    return F.max(value)


def minimize(value: str, order: Column) -> Column:
    return F.min(value)


def total(value: str, order: Column) -> Column:
    """Sum; use decimals where the result must not depend on the order of rows."""
    return F.sum(value)


def append(value: str, order: Column) -> Column:
    """Arrays joined in order; a null array adds nothing."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(value).alias("v"))))
    return F.flatten(F.filter(F.transform(pairs, lambda p: p["v"]), lambda v: v.isNotNull()))


def set_union(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value): distinct elements of all arrays of a key, sorted; only adding is defined.

    Elements are made distinct before they are gathered, in each task and by element, so a
    hot key's rows stay spread and what meets is the result itself. Keys without elements have an empty array.
    """
    elements = df.select(*keys, F.explode_outer(value).alias("_e"), (F.coalesce(F.size(value), F.lit(0)) > 0).alias("_any")).distinct()
    # A null element is one; a struct around it keeps it.
    found = F.sort_array(F.collect_set(F.when(F.col("_any"), F.struct("_e"))))
    return elements.groupBy(*keys).agg(F.transform(found, lambda x: x["_e"]).alias(value))


STRATEGIES: dict[str, Callable[[str, Column], Column]] = {
    "lastWriteWins": last_write_wins, "firstWriteWins": first_write_wins, "maximize": maximize, "minimize": minimize, "sum": total, "append": append,
}


def merge_leaves(schema: T.StructType, order: Column, path: str = "") -> list[Column]:
    """Deep merge of typed objects: each leaf takes its newest present (non-null) value."""
    out = []
    for field in schema.fields:
        name = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            out.append(F.struct(*merge_leaves(field.dataType, order, name)).alias(field.name))
        else:
            out.append(F.max_by(F.col(name), F.when(F.col(name).isNotNull(), order)).alias(field.name))
    return out


def after_last_delete(df: DataFrame, keys: list[str], order: list[str], deleted: Column) -> DataFrame:
    """Rows after the last delete of their key: nothing from before it may survive a re-insert.

    The last delete is an aggregate joined back, so a hot key's rows stay spread.
    """
    position = F.struct(*order)
    cuts = df.where(deleted).groupBy(*keys).agg(F.max(position).alias("_cut"))
    joined = df.alias("d").join(cuts.alias("c"), [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys], "left")
    kept = joined.where(F.col("_cut").isNull() | (F.struct(*[F.col(f"d.{o}") for o in order]) > F.col("_cut")))
    return kept.select("d.*")


def reduce_collection(df: DataFrame, keys: list[str], order: list[str], strategies: Mapping[str, str], delete_when: Column | None = None) -> DataFrame:
    """One row a key: each column reduced by its strategy, ``merge`` for struct columns.

    ``order`` must end in a unique column. With ``delete_when``, events up to a key's last
    delete are cut first, and a key whose last event is a delete is gone. Null keys are a
    key. Reduction is partial before the shuffle except for append, whose arrays are the result.
    Sets and merges of JSON patches are reduced in steps of their own (``set_union``,
    ``merge_patches``) and joined by key.
    """
    if delete_when is not None:
        df = after_last_delete(df, keys, order, delete_when)
    position = F.struct(*order)
    plain, stepwise = [], []
    for name, strategy in strategies.items():
        if strategy == "set":
            stepwise.append(set_union(df, keys, name))
        elif strategy == "merge" and not isinstance(df.schema[name].dataType, T.StructType):
            stepwise.append(merge_patches(df, keys, order, name))
        elif strategy == "merge":
            plain.append(F.struct(*merge_leaves(df.schema[name].dataType, position, f"`{name}`")).alias(name))
        else:
            plain.append(STRATEGIES[strategy](name, position).alias(name))
    parts = ([df.groupBy(*keys).agg(*plain)] if plain or not stepwise else []) + stepwise
    for i, part in enumerate(parts[1:]):
        renamed = part.withColumnsRenamed({k: f"_k{i}_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_k{i}_{k}`")) for k in keys])
        parts[0] = parts[0].join(renamed, same).drop(*[f"_k{i}_{k}" for k in keys])
    return parts[0].select(*keys, *strategies)


def _patched(target, patch):
    if not isinstance(patch, dict):
        return patch
    out = dict(target) if isinstance(target, dict) else {}
    for name, value in patch.items():
        if value is None:
            out.pop(name, None)
        else:
            out[name] = _patched(out.get(name), value)
    return out


@F.pandas_udf(T.StringType())
def json_merge_patch(target: pd.Series, patch: pd.Series) -> pd.Series:
    """RFC 7396: null removes, objects recurse, anything else replaces. A null patch column changes nothing; keys come sorted.

    Where the patch or the target that it needs is no JSON, the result is null.
    """
    out = []
    for a, b in zip(target, patch, strict=True):
        try:
            out.append(a if b is None else json.dumps(_patched(None if a is None else json.loads(a), json.loads(b)), sort_keys=True, separators=(",", ":")))
        except ValueError:
            out.append(None)
    return pd.Series(out, dtype=object)


#: A patch as a tree that composes: [SET, value] replaces, [MERGE, {name: tree}] goes into an object.
SET, MERGE = 0, 1


def patch_tree(patch):
    """An RFC 7396 patch as a tree; its nulls set null until the tree is applied."""
    return [MERGE, {k: patch_tree(v) for k, v in patch.items()}] if isinstance(patch, dict) else [SET, patch]


def composed(first, then):
    """The tree that does what ``first`` and then ``then`` do, to any document; composing is associative."""
    if then[0] == SET:
        return then
    if first[0] == SET:
        return [SET, applied(then, first[1])]
    out = dict(first[1])
    for name, tree in then[1].items():
        out[name] = composed(out[name], tree) if name in out else tree
    return [MERGE, out]


def applied(tree, document):
    """A document after a tree; names that it sets to null go."""
    if tree[0] == SET:
        return tree[1]
    out = dict(document) if isinstance(document, dict) else {}
    for name, part in tree[1].items():
        value = applied(part, out.get(name))
        if value is None:
            out.pop(name, None)
        else:
            out[name] = value
    return out


def _folded(pieces: DataFrame, keys: list[str], last: bool):
    """A function over batches of (keys, tree) in order that gives one composed tree for each run of a key."""
    kinds = ", ".join(f"`{k}` {pieces.schema[k].dataType.simpleString()}" for k in keys)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, held, done = object(), None, []
        now = none

        def flush(schema: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array([row[0][i] for row in done], schema.field(k).type) for i, k in enumerate(keys)]
            texts = [row[1] if not last else None if row[1] is None else json.dumps(applied(row[1], None), sort_keys=True, separators=(",", ":")) for row in done]
            texts = texts if last else [None if t is None else json.dumps(t, separators=(",", ":")) for t in texts]
            done.clear()
            return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keys, "_tree"])

        schema = None
        for batch in batches:
            schema = batch.schema
            for *key, text in zip(*[batch.column(k).to_pylist() for k in keys], batch.column("_tree").to_pylist()):
                tree = _read_tree(text, raw=not last)
                if now is none or key != now:
                    if now is not none:
                        done.append((now, held))
                    now, held = key, tree
                elif tree is not None:
                    held = tree if held is None else composed(held, tree)
                if len(done) >= 1_000:
                    yield flush(schema)
        if now is not none:
            done.append((now, held))
            yield flush(schema)

    return fold, f"{kinds}, `_tree` string"


def _read_tree(text: str | None, raw: bool):
    if text is None:
        return None
    if not raw:
        return json.loads(text)
    try:
        return patch_tree(json.loads(text))
    except ValueError:
        return None


def merge_patches(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, value): fold of a key's JSON merge patches in order (RFC 7396).

    Null patches and texts that are no JSON change nothing; a key with no others is null. Rows are dealt by
    ranges of key and order, and each range composes its patches to one tree a key; the few trees of a
    key that several ranges have are composed in range order. So no task holds more of a hot key than its range and
    one tree, whose nulls wait until the end.
    """
    rows = df.select(*keys, *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(value).alias("_tree"))
    by = [*keys, *[f"_o{i}" for i in range(len(order))]]
    fold, kinds = _folded(rows, keys, last=False)
    pieces = rows.repartitionByRange(*by).sortWithinPartitions(*by).select(*keys, "_tree").mapInArrow(fold, kinds)
    # The trees of one range get its number with them.
    pieces = pieces.withColumn("_range", F.spark_partition_id())
    fold, kinds = _folded(pieces, keys, last=True)
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "_range").select(*keys, "_tree").mapInArrow(fold, kinds).withColumnRenamed("_tree", value)


def patch_map(target: Column, patch: Column) -> Column:
    """One-level merge patch of maps, in the JVM: patch entries win, null values remove."""
    merged = F.map_zip_with(F.coalesce(target, F.create_map().cast("map<string,string>")), patch, lambda k, a, b: F.when(F.map_contains_key(patch, k), b).otherwise(a))
    return F.map_filter(merged, lambda k, v: v.isNotNull())


def delta_combine(batch: DataFrame, keys: list[str], order: list[str], strategies: Mapping[str, str]) -> DataFrame:
    """Reduction inside one batch only; targets are not read and consumers may reduce further."""
    return reduce_collection(batch, keys, order, strategies)


def strip_null_fields(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> Column:
    """JSON of columns without null fields; those in ``keep`` stay as null."""
    keep = keep or []
    body = F.to_json(F.struct(*[c for c in columns if c not in keep]))
    if not keep:
        return body
    rest = F.to_json(F.struct(*keep), {"ignoreNullFields": "false"})
    left, right = F.regexp_replace(body, r"\}$", ""), F.regexp_replace(rest, r"^\{", "")
    return F.when(body == "{}", rest).otherwise(F.concat(left, F.lit(","), right))


def history(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every change kept, with the position until which it held (``valid_to``, null for the last)."""
    return df.withColumn("valid_to", F.lead(F.struct(*order)).over(Window.partitionBy(*keys).orderBy(*order)))
