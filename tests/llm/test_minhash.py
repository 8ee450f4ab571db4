"""MinHash near-duplicates against brute force over whole sets of shingles."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from ledgerspark.llm import minhash_dedup as md
from ledgerspark.llm import queries
from ledgerspark.llm.simhash_dedup import components
from tests.llm.conftest import LONG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_shingles(text, size=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def slow_rows(rows, size=4):
    """rows: (key, text) -> (key, set size, smallest key reachable), through an inverted index."""
    sets = [slow_shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            common.update((j, i) for j in index[x])
            index[x].append(i)
    for (i, j), n in common.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[root(i)].append(key)
    return [(k, len(s), min((x for x in least[root(i)] if x is not None), default=None)) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall()
    got = queries.op13_minhash_dedup(spark, path)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}
    got = got.collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(slow_rows(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(rng, text, times):
    text = list(text)
    for at in rng.sample(range(len(text)), min(times, len(text))):
        text[at] = f"e{rng.randrange(10**6)}"
    return text


@pytest.mark.parametrize("block", [7, 512])
def test_copies_chains_hubs_and_texts_nearly_alike(spark, block):
    """Chains of copies, a base with many copies, groups just above and below the similarity, a passage that many share;
    in blocks of several sizes."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, base, other, texts = words(40), words(100), words(60), []
    for _ in range(50):
        now = words(rng.randint(4, 150))
        for _ in range(rng.randint(1, 4)):
            texts.append(now)
            now = edited(rng, now, rng.randint(0, 3))
    texts += [base, *(edited(rng, base, 2) for _ in range(40)), *(edited(rng, other, 2) for _ in range(60)), *(edited(rng, words(8), 0) for _ in range(5))]
    texts += [*(passage + words(30) for _ in range(40)), *(passage + words(rng.randint(3, 12)) for _ in range(30))]
    rows = list(enumerate([" ".join(t) for t in texts]))
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    points = md.described(docs, "doc_id", "text").selectExpr("fp", "row", "n", "sig").dropDuplicates(["fp"])
    stars = md.links(points, docs, block=block).collect()
    root = {bytes(r.hi): bytes(r.lo) for r in stars}
    fps = {r.doc_id: bytes(r.fp) for r in md.described(docs, "doc_id", "text").collect()}
    want = {k: c for k, _, c in slow_rows(rows)}
    group = {k: root.get(f, f) for k, f in fps.items()}
    assert len(set(zip(group.values(), (want[k] for k in group)))) == len(set(group.values())) == len(set(want.values()))


def test_hostile_rows(spark, hostile, nothing):
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    assert any(t == LONG for _, t in rows)
    got = md.near_duplicates(hostile)
    assert found(got) == Counter(slow_rows(rows))
    assert md.near_duplicates(nothing).count() == 0
    kept = md.one_of_each(hostile, words=5)
    assert kept.columns == hostile.columns and md.one_of_each(nothing).count() == 0
    sets = {frozenset(slow_shingles(t, 5)) for _, t in rows}
    assert kept.count() == len(sets)


def test_signatures_collide_at_the_least_similarity():
    rng = np.random.default_rng(3)
    fewest = 64
    for _ in range(3000):
        x = np.unique(rng.integers(0, 2**63, 100, np.uint64))
        a, b = md.signature(x[:90]), md.signature(x[10:])
        fewest = min(fewest, int((a == b).sum()))
        at, to = md.colliding(np.stack([a, b]), np.array([0]), np.array([1]))
        assert (len(at) == 1) == ((a == b).sum() >= md.MATCHES)
    assert fewest >= md.MATCHES


def test_intersections_pair_by_pair_and_as_a_product():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 9000, n)).astype(np.int64) for n in (1, 50, 300, 300, 2000, 5000)]
    at, to = (np.array(x) for x in zip(*[(i, j) for i in range(6) for j in range(6) if i != j]))
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(at, to)]
    assert md.in_common(sets, at, to).tolist() == want
    assert md.in_common(sets, np.tile(at, 3), np.tile(to, 3)).tolist() == want * 3


def test_components_of_binary_names(spark):
    edges = [(bytes([i + 1]), bytes([i])) for i in range(20)]
    stars = components(spark.createDataFrame(edges, "hi binary, lo binary")).collect()
    assert sorted((bytes(r.hi), bytes(r.lo)) for r in stars) == [(bytes([i]), b"\0") for i in range(1, 21)]


def test_proposed_pairs_are_confirmed_whatever_their_collisions(spark, monkeypatch):
    monkeypatch.setattr(md, "MATCHES", md.COORDINATES + 1)  # the lists propose nothing
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:-1] + ["x"])), (2, " ".join(words[:20]))]

    def every(points):
        a, b = points.select(md.F.col("fp").alias("a")), points.select(md.F.col("fp").alias("b"))
        return a.join(b, md.F.col("a") < md.F.col("b"))

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(md.near_duplicates(docs, propose=every)) == Counter(slow_rows(rows))
    assert {r.component_id for r in md.near_duplicates(docs).collect()} == {0, 1, 2}


def test_blocks_of_one_group_are_dealt_out(spark):
    """The rows of a group meet in a join, which leaves them in one task: their blocks are tasks' work one by one."""
    rows = [(b"h", bytes([i]), bytes([i]), 10, [i // 2] * md.COORDINATES) for i in range(20)]
    members = spark.createDataFrame(rows, "head binary, fp binary, root binary, n long, sig array<int>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = md._spanning(md._blocks(members, "head", 4), "head", False)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert {(bytes(r.hi), bytes(r.lo)) for r in found.collect()} == {(bytes([i + 1]), bytes([i])) for i in range(0, 20, 2)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.search(r"hashpartitioning\((.*?)\)", plan[plan.index("FlatMapGroupsInPandas") :]).group(1)
    assert re.findall(r"(\w+)#", dealt) == ["head", "kind", "i", "j"]
