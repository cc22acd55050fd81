"""JSON of unknown shape against plain recursion."""

import json
import random

import pytest

from sparkpanel.operators import documents as D


def leaves(v, path="$"):
    if isinstance(v, dict) and v:
        for k, x in v.items():
            step = f".{k}" if k.isidentifier() and k.isascii() else f"['{k}']"
            yield from leaves(x, path + step)
    elif isinstance(v, list) and v:
        for i, x in enumerate(v):
            yield from leaves(x, f"{path}[{i}]")
    else:
        kind = {dict: "OBJECT<>", list: "ARRAY<>", bool: "BOOLEAN", int: "BIGINT", str: "STRING", type(None): "VOID"}[type(v)]
        yield path, kind, None if v is None else json.dumps(v) if isinstance(v, (bool, dict, list)) else str(v)


def value(rng, depth):
    kind = rng.choice(["object", "list", "scalar", "scalar"]) if depth else "scalar"
    if kind == "object":
        return {k: value(rng, depth - 1) for k in rng.sample(["a", "b", "odd name", "c1", "é", ""], rng.randint(0, 4))}
    if kind == "list":
        return [value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, False, 0, -7, 2 ** 40, "", "text", "{}", "[]", "null"])


def test_leaves_of_random_documents(spark):
    rng = random.Random(2)
    docs = [value(rng, 5) for _ in range(200)] + [{"a": {"a": {"a": {"a": {"a": {"a": [[[[1]]]]}}}}}}, {}, [], None, "x", {"big": "y" * 200_000}]
    rows = [(i, json.dumps(d), "k", "v") for i, d in enumerate(docs)] + [(900, None, "k", "v"), (901, "{bad", "k", "v"), (None, '{"a": 1}', "k", "v")]
    df = spark.createDataFrame(rows, "id int, raw string, key string, value string")
    got = sorted(map(tuple, D.open_leaves(df, "id", "raw").collect()), key=str)
    want = [(i, *leaf) for i, d in enumerate(docs) for leaf in leaves(d)] + [(None, "$.a", "BIGINT", "1")]
    assert got == sorted(want, key=str)
    assert D.open_leaves(df.limit(0), "id", "raw").count() == 0


def test_columns_of_the_union_of_all_shapes(spark):
    rows = [(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"b": {"d": [1, 2]}, "e": true}'), (3, "{}"), (4, None), (5, "{bad"), (6, '{"a": 2.5, "b": {"c": null}}')]
    df = spark.createDataFrame(rows, "id int, raw string")
    out = D.open_columns(df, "raw")
    assert sorted(out.columns) == ["a", "b_c", "b_d", "e", "id"]
    got = {r.id: (r.a is not None and float(r.a), r.b_c, r.b_d, r.e) for r in out.collect()}
    assert got == {1: (1.0, "x", None, None), 2: (False, None, [1, 2], True), 3: (False, None, None, None), 4: (False, None, None, None),
                   5: (False, None, None, None), 6: (2.5, None, None, None)}
    with pytest.raises(ValueError, match="not all objects"):
        D.open_columns(spark.createDataFrame([(1, "[1]")], df.schema), "raw")
    assert D.open_columns(spark.createDataFrame([(1, None)], df.schema), "raw").columns == ["id"]
