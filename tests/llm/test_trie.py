"""The prefix trie against plain Python, for short, long, shared, empty and hostile conversations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from ledgerspark.llm import conversation_trie as ct
from ledgerspark.llm import queries
from tests.oracle import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), tie, (role, text)))
    turns = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - int(math.fmod(c, 20)), [])[: heads[c]] + t[heads[c] :] for c, t in turns.items()}


def slow_trie(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in slow_rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in sorted(members.items(), key=lambda x: -len(x[0])):
        if not children[p]:
            leaves[p] += 1
        saved[p] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    assert {t for n, t in df.dtypes if n in COLUMNS[:-1]} == {"bigint"}
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_plain_python_and_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{path}/conversations.parquet'").fetchall()
    assert found(queries.op11_conversation_trie(spark, path)) == slow_trie(rows)


def test_sql_on_hostile_rows(spark, tmp_path):
    rows = hostile_rows()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    df = ct.trie(spark.read.parquet(str(tmp_path / "c"))).drop("n_ends")
    assert compare(df, con, queries.ORACLE["op11_conversation_trie"]) is None


def hostile_rows():
    """Nulls everywhere, repeated rows and turns, blank and long texts, negative ids, conversations without turns of their own."""
    rows = [(None, 1, "user", "nobody's"), (None, None, None, None)]
    for c in (0, 1, 2, 3, 4, 7, 21, 22, 23, 41, -3, 60, 61):
        rows += [(c, t, ("user", "assistant")[t % 2], f"hello {min(c, t)}") for t in range(4)]
    rows += [(5, 0, None, None), (5, 0, "", ""), (5, None, "user", " \t"), (6, 0, "user", "a b"), (6, 0, "user", "a b"), (8, 3, "us", "er x"), (8, 3, "user", " x")]
    rows += [(9, 1, "user", "long words " * 20000), (29, 1, "user", "long words " * 20000), (101, 0, "user", "only turn"), (102, 0, "user", "ünï 中文")]
    return rows


def test_hostile_rows(spark):
    rows = hostile_rows()
    clash = "c d id n i key node words depth nth turns conv parent".split()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", *[f"'x' AS `{c}`" for c in clash]).repartition(3)
    assert found(ct.trie(df)) == slow_trie(rows)
    assert ct.trie(df.limit(0)).count() == 0


def test_long_and_shared_conversations(spark):
    """Segments of 3 turns: conversations of many segments and blocks, long shared beginnings, copies, a hot first turn."""
    rng = random.Random(2)
    long = [f"turn {rng.randrange(5)}" for _ in range(120)]
    rows = []
    for c in range(90):
        start = rng.choice((0, 1, 2, 3, 27, 28, 81, 100, 120))
        texts = long[:start] + [f"word {rng.randrange(3)}" for _ in range(rng.randrange(5))]
        rows += [(c, t, "user", x) for t, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    assert found(ct.trie(df, segment=3)) == slow_trie(rows)


def test_radix_tree_layouts():
    """All four layouts, split paths, keys that end within others, and turn-aligned depths only."""
    rng = random.Random(6)
    for bytes_used in (3, 12, 40, 256):
        ids = [bytes([rng.randrange(bytes_used), rng.randrange(2)]) * 8 for _ in range(300)]
        keys = [b"\0" * 16 + b"".join(rng.choices(ids, k=rng.randrange(1, 4))) for _ in range(900)]
        root = ct.Node(b"")
        for c, k in enumerate(keys):
            ct.insert(root, k, c, True)
        want = defaultdict(list)
        for c, k in enumerate(keys):
            for at in range(32, len(k) + 1, 16):
                want[k[16:at]].append(c)
        got, ended = {}, Counter()
        path = {b"\0" * 16: b""}
        for made, parent, before, turn, turn_id, node, ends in ct.aligned(root):
            path[made] = path[parent] + turn_id
            assert before == b"\0" * 16 and len(path[made]) == 16 * turn
            got[path[made]] = (node.least, node.n)
            if ends:
                ended[path[made]] += len(node.ends)
        assert got == {p: (min(m), len(m)) for p, m in want.items()}
        assert +ended == Counter(k[16:] for k in keys)
