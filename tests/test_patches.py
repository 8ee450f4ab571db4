"""Patches filtered by a table of retained paths, against plain Python and the column function for a few paths."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions import documents as doc
from ledgerspark.operators.patches import filter_patches

NAMES = ["a", "b", "c/d", "e~f"]


def escaped(name):
    return name.replace("~", "~0").replace("/", "~1")


def slow_filter(patch, paths):
    deeper = lambda at: any(p.startswith(f"{at}/") for p in paths)

    def prune(value, at):
        if not deeper(at):
            return value
        if not isinstance(value, dict):
            return value if at in paths else None
        kept = {k: prune(v, f"{at}/{escaped(k)}") for k, v in value.items() if f"{at}/{escaped(k)}" in paths or deeper(f"{at}/{escaped(k)}")}
        dropped = [k for k, v in value.items() if k in kept and kept[k] is None and (v is not None or deeper(f"{at}/{escaped(k)}") and f"{at}/{escaped(k)}" not in paths)]
        kept = {k: v for k, v in kept.items() if k not in dropped}
        return kept or None

    out = []
    for e in patch:
        at, value = e["path"], e.get("value")
        above = any(at == p or at.startswith(f"{p}/") for p in paths)
        known = at in paths or deeper(at)
        if e["op"] == "remove":
            out += [e] if above or known else []
        elif isinstance(value, dict) and known:
            pruned = prune(value, at)
            out += [{**e, "value": pruned}] if pruned else []
        elif above:
            out.append(e)
    return out


def random_value(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        return rng.choice([1, 2.5, "x", None, True, [1, {"a": 2}], {}])
    return {n: random_value(rng, depth - 1) for n in rng.sample(NAMES, rng.randrange(1, 4))}


def random_path(rng, most=3):
    return "".join(f"/{escaped(rng.choice(NAMES))}" for _ in range(rng.randrange(most + 1)))


def filtered(spark, patches, paths):
    rows = [(i, None if p is None else json.dumps(p)) for i, p in enumerate(patches)]
    retained = spark.createDataFrame([(p,) for p in paths], "path string")
    got = filter_patches(spark.createDataFrame(rows, "id int, patch string"), ["id"], "patch", retained).collect()
    return [None if r.kept is None else json.loads(r.kept) for r in sorted(got, key=lambda r: r.id)]


def test_random_patches_equal_plain_python(spark):
    rng = random.Random(4)
    patches = [
        [dict(op=rng.choice(["add", "replace"]), path=random_path(rng), value=random_value(rng, 3)) if rng.random() < 0.8 else dict(op="remove", path=random_path(rng)) for _ in range(rng.randrange(5))]
        for _ in range(60)
    ]
    for paths in (["/a"], ["/a", "/a/b"], ["/b/c~1d/a", "/e~0f", "/a/a", "/a/b/e~0f"], [""], ["", "/a/b"], sorted({random_path(rng) for _ in range(12)})):
        assert filtered(spark, patches, paths) == [slow_filter(p, paths) for p in patches]


def test_the_same_as_the_column_function(spark):
    place = {"zip": 150, "city": "Oslo", "geo": {"lon": 10.75, "lat": 59.9, "src": "gps"}}
    patch = [{"op": "replace", "path": p, "value": place} for p in ("/home", "/homes", "", "/person/home")]
    patch += [{"op": "remove", "path": p} for p in ("/phone", "/home/city", "/home/geo/lat")] + [{"op": "add", "path": "/home/zip", "value": 7}]
    for paths in (["/home/city"], ["/home/geo", "/home/geo/lat"], ["/zip"], ["/hom", "/homecity"], ["/home"], ["/person"], ["/phone/mobile"]):
        df = spark.createDataFrame([(json.dumps(patch),)], "p string")
        assert filtered(spark, [patch], paths) == [json.loads(df.select(doc.patch_filter(F.col("p"), *paths)).first()[0])]


def test_odd_rows(spark):
    """Null patches and keys, empty patches, no retained paths, nulls among them, and operations that are not supported."""
    patch = [{"op": "add", "path": "/a", "value": 1}]
    assert filtered(spark, [None, [], patch], ["/a"]) == [None, [], patch]
    assert filtered(spark, [patch], []) == [[]]
    df = spark.createDataFrame([(None, None, json.dumps(patch)), (1, None, json.dumps(patch))], "k int, l string, patch string")
    retained = spark.createDataFrame([("/a",), (None,), ("/a",)], "path string")
    got = filter_patches(df, ["k", "l"], "patch", retained)
    assert got.columns == ["k", "l", "kept"] and [json.loads(r.kept) for r in got.collect()] == [patch, patch]
    with pytest.raises(Exception, match="not supported"):
        filtered(spark, [[{"op": "move", "path": "/a"}]], ["/b"])


def test_the_plan_does_not_grow_with_the_paths(spark, tmp_path):
    rng = random.Random(8)
    docs = spark.createDataFrame([(1, json.dumps([{"op": "add", "path": "", "value": {"k7": {"x1": 1, "x2": 2}, "z": 3}}]))], "id int, patch string")
    sizes = []
    for n in (2, 1000):
        paths = ["/k7/x1", "/k9/x9"] + [f"/k{rng.randrange(100, 10**6)}/x{i}" for i in range(n - 2)]
        spark.createDataFrame([(p,) for p in paths], "path string").write.parquet(str(tmp_path / str(n)))
        out = filter_patches(docs, ["id"], "patch", spark.read.parquet(str(tmp_path / str(n))))
        sizes.append(len(out._jdf.queryExecution().optimizedPlan().treeString().splitlines()))
        assert json.loads(out.first().kept) == [{"op": "add", "path": "", "value": {"k7": {"x1": 1}}}]
    assert sizes[0] == sizes[1]


def test_patches_of_one_row_group_are_read_in_several_tasks(spark, monkeypatch):
    import __spark_entry__ as entry
    from ledgerspark.plans import documents

    monkeypatch.setattr(documents, "filter_patches", lambda patches, *rest: patches)
    read = entry.queries()["patch_filter"](spark, "/root/testdata/sf0.001")
    assert read.groupBy(F.spark_partition_id()).count().count() > 1
