"""The pipeline's stages against plain Python, on hostile rows, an empty table and the smallest tables."""

from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from ledgerspark.llm import quality_cnn, simhash_dedup, source_mix
from ledgerspark.session import table
from tests.llm.test_groups import slow_targets
from tests.llm.test_minhash import slow_rows
from tests.llm.test_rows import WORD, expected_tokens

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def slow_kept(rows):
    """Keys of one row of each group of five-word shingles; texts without words are one group. Keys may repeat over groups."""
    groups = {}
    for (key, text), (_, n, _), g in zip(rows, slow_rows(rows, 5), slow_groups(rows)):
        groups.setdefault(g if n else None, []).append((key is None, key, text or ""))
    return [min(m, key=lambda x: (x[0], x[1] or 0))[1] for m in groups.values()]


def slow_groups(rows):
    """Number of the first row reachable: the smallest when the keys are the rows' numbers."""
    return [c for *_, c in slow_rows([(i, t) for i, (_, t) in enumerate(rows)], 5)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_near_duplicates_equal_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall()
    got = corpus_pipeline.near_duplicates(spark, table(spark, path, "documents"), path)
    assert got.columns == COLUMNS and sorted(r.doc_id for r in got.collect()) == sorted(slow_kept(rows))


def test_stages_one_by_one(spark):
    reference = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, SF, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.stored(stage(spark, steps[-1], SF), "test"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert steps[-1].columns == COLUMNS
    rows = [s.collect() for s in steps]

    net = quality_cnn.fit(docs, table(spark, SF, "labels"))
    score = quality_cnn.score_texts(net, [r.text.encode() for r in rows[0]])
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r, s in zip(rows[0], score) if s >= 0.3}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    clean = [i for i, q in labels.items() if q == 1]
    assert len({r.doc_id for r in rows[1]} & set(clean)) > 0.97 * len(clean)

    assert sorted(r.doc_id for r in rows[2]) == sorted(slow_kept([(r.doc_id, r.text) for r in rows[1]]))

    before = {r.doc_id: r for r in rows[2]}
    assert {r.doc_id for r in rows[3]} == set(before)
    for r in rows[3]:
        assert r.text == before[r.doc_id].text or "[SECRET]" in r.text and r.n_chars == len(r.text)

    sizes, got = Counter(), Counter()
    longest = defaultdict(int)
    for r in rows[3]:
        n = len(WORD.findall(r.text))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in rows[4]:
        got[r.source] += len(WORD.findall(r.text))
    times = Counter(r.doc_id for r in rows[4])
    assert max(times.values()) <= 3
    for source, target in slow_targets(dict(sizes)).items():
        assert abs(got[source] - target) <= longest[source]

    texts = {r.doc_id: r.text for r in rows[4]}
    assert Counter(r.doc_id for r in rows[5]) == times
    for r in rows[5]:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected_tokens(reference, texts[r.doc_id])
        assert len(r.ids) == r.n_tokens

    whole = entry.queries()["pipeline"](spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert Counter(map(tuple, whole)) == Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in rows[5])


def test_stages_hostile(spark, hostile, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, hostile, SF)
        none = stage(spark, nothing, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == none.columns == hostile.columns
        assert out.count() > 0 and none.count() == 0
    # key 4 names two texts, each the representative of its own group
    kept = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, hostile, SF).collect()]
    assert Counter(kept) == Counter(slow_kept([(r.doc_id, r.text) for r in hostile.collect()]))
    mixed = source_mix.mixed_rows(hostile)
    assert mixed.columns == hostile.columns and mixed.filter("text IS NULL OR trim(text) = ''").count() == 0


def test_representatives_are_looked_up_unsorted(spark):
    """Rows hold whole texts: only those with a copy of key and text are sorted, for their first."""
    rows = [(1, "a", 5), (1, "a", 3), (1, "b", 1), (2, "a", 2), (3, "c", 1), (None, "d", 1), (None, "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n int")
    near = docs.selectExpr("doc_id", "xxhash64(text) AS digest", "text AS `group`")
    out = simhash_dedup.first_of_groups(docs, near)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 4 and Counter(t for _, t, _ in got) == Counter("abcd") and not set(got) - set(rows)
    assert (1, "a", 5) in got or (1, "a", 3) in got
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_classifier_takes_a_few_rows_at_a_time():
    batch = pa.record_batch({"doc_id": list(range(1000)), "text": ["some text"] * 1000})
    for net in (None, quality_cnn.Network.start(1)):
        parts = list(quality_cnn._kept(iter([batch]), net, 1))
        assert max(p.num_rows for p in parts) <= quality_cnn.PART and sum(p.num_rows for p in parts) in (0, 1000)
