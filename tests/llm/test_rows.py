"""Row-wise operators against plain Python, on hostile rows, empty tables and the smallest tables."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerspark.llm import bpe, license_scan, quality_cnn, quality_rules, queries, secret_scan, token_counts, url_filter
from tests.llm.conftest import LONG, TEXTS
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) is None


def test_all_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


# --- BPE


def expected_tokens(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    packed = np.array(ids, "<u4").tobytes()
    shown = reference.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()


def test_bpe_equals_the_library(spark, reference):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_bpe(spark, SF).collect()}
    assert got == {i: expected_tokens(reference, t) for i, t in documents()}


def test_bpe_hostile(spark, hostile, nothing, reference):
    rows = bpe.round_trip(hostile).join(hostile.select("doc_id").distinct(), "doc_id").collect()
    texts = dict(enumerate(TEXTS))
    for r in rows:
        if r.doc_id != 4:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected_tokens(reference, texts[r.doc_id])
    assert bpe.round_trip(hostile).count() == hostile.count()
    assert bpe.round_trip(nothing).count() == 0
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(hostile)).collect()}
    assert back[10] == reference.decode(reference.encode(LONG, add_special_tokens=False).ids, skip_special_tokens=False)
    assert back[0] == "" and back[None] is not None


def test_bpe_any_text(reference):
    rng = np.random.default_rng(5)
    letters = [*"abAB 'sStTré  \t\n123½²٣中文😀ΣσςǅßẞİıK<|>_-!aaa힣ﬁำ", "\x1c", "\x85", "\u0345", "\u0301", "<|endoftext|>", "'re", "'LL", "aaaaaa"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    own = bpe.Tokenizer(bpe.VOCABULARY).encode(texts)
    for t, a, b in zip(texts, own, reference.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(a, "<u4").tolist() == b.ids, ascii(t)
    plain = bpe.Tokenizer(bpe.VOCABULARY, special=False).encode(["x <|endoftext|> y"])[0]
    assert 49407 not in np.frombuffer(plain, "<u4")


def test_bpe_rejects_merges_out_of_order():
    symbols = {c: i for i, c in enumerate(bpe._byte_letters())}
    symbols |= {c + "</w>": 256 + i for i, c in enumerate(bpe._byte_letters())}
    symbols |= {"abc": 512, "ab": 513}
    with pytest.raises(ValueError, match="order"):
        bpe.PairIndex(symbols, [("ab", "c"), ("a", "b")], "</w>")


def test_token_memory_bound_changes_nothing(monkeypatch):
    whole = bpe.Tokenizer(bpe.VOCABULARY).encode(TEXTS[1:])
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    small = bpe.Tokenizer(bpe.VOCABULARY)
    assert [small.encode([t])[0] for t in TEXTS[1:]] == whole


# --- token counts


def test_token_counts_equal_direct_counts(spark, reference):
    got = {r.doc_id: r.n_tokens for r in queries.op9_token_counts(spark, SF).collect()}
    reference.encode_special_tokens = True
    want = {i: len(reference.encode(t, add_special_tokens=False).ids) for i, t in documents()}
    reference.encode_special_tokens = False
    assert got == want


def test_token_counts_across_blocks(spark):
    """Documents span many blocks; empty and unclosed documents, an empty block, several files."""
    rng = np.random.default_rng(2)
    files, rows = {}, []
    for file in range(3):
        flat = np.where(rng.random(4000) < (0.01, 0.3, 0.0005)[file], 9, 1).astype("<u2")
        files[file] = flat
        at = 0
        while at < len(flat):
            n = int(rng.integers(1, 60))
            rows.append((file, at, bytearray(flat[at : at + n].tobytes())))
            at += n
    rows.append((3, 0, bytearray()))
    blocks = spark.createDataFrame(rows, "file int, offset long, data binary")
    got = sorted((r.file, r.ordinal, r.start, r.n_tokens) for r in token_counts.count_tokens(blocks, 9, chunks=7).collect())
    want = []
    for file, flat in files.items():
        start = ordinal = 0
        for stop in np.flatnonzero(flat == 9).tolist():
            want.append((file, ordinal, start, stop - start))
            ordinal, start = ordinal + 1, stop + 1
        if start < len(flat):
            want.append((file, ordinal, start, len(flat) - start))
    assert got == want
    assert token_counts.count_tokens(blocks.limit(0), 9).count() == 0


def test_token_counts_hostile(spark, hostile, nothing):
    got = token_counts.document_token_counts(hostile)
    assert got.count() == hostile.count()
    assert {r.n_tokens for r in got.filter("doc_id IN (0, 1, 2)").collect()} == {0}
    assert token_counts.document_token_counts(nothing).count() == 0


def test_raw_token_files(spark, tmp_path):
    flat = np.array([5, 5, 9, 9, 5, 5, 5, 9, 5], "<u2")
    (tmp_path / "a.bin").write_bytes(flat.tobytes())
    counted = token_counts.count_tokens(token_counts.read_tokens(spark, str(tmp_path), block_tokens=2), 9)
    assert sorted((r.ordinal, r.n_tokens) for r in counted.collect()) == [(0, 2), (1, 0), (2, 3), (3, 1)]


# --- quality rules


def slow_measures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 500 else None
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), None if covered is None else len(covered)


def test_rules_equal_brute_force(spark, hostile, nothing):
    for r in quality_rules.ledger(hostile).filter("doc_id IS NOT NULL AND doc_id <> 4").collect():
        n, chars, symbols, dups, repeats = slow_measures(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (n, chars, symbols, dups)
        assert repeats is None or r.n_repeat_words == repeats
    assert quality_rules.ledger(hostile).count() == hostile.count()
    assert quality_rules.ledger(nothing).count() == 0 == quality_rules.ablation(quality_rules.ledger(nothing)).count()


def test_ablation_counts(spark):
    rows = spark.createDataFrame([(1,), (1,), (3,), (2,), (0,), (4,)], "failed long")
    got = {r.rule: (r.fail, r.only_this, r.removed_by_policy) for r in quality_rules.ablation(rows, {"p": 3}).collect()}
    assert got == {"few_words": (3, 2, 4), "repeated_words": (2, 1, 4)}


# --- licences


def test_licenses(spark, hostile, nothing):
    known = license_scan.known_licenses(spark)
    got = {r.doc_id: r for r in license_scan.scan_licenses(hostile, known).collect()}
    assert got[9].notices == ["Apache-2.0", "MIT"] and got[9].license is None and got[9].kind == "permissive"
    assert got[3].notices == [] and got[3].kind is None
    assert license_scan.scan_licenses(hostile, known).count() == hostile.count()
    assert license_scan.scan_licenses(nothing, known).count() == 0
    assert license_scan.scan_licenses(hostile, known.limit(0)).filter("kind IS NOT NULL").count() == 0
    text = next(t for n, _, t in license_scan.KNOWN if n == "Zlib").upper().replace("ACKNOWLEDGMENT", "acknowledgement")
    text = "Copyright (c) 1999 A. Person\n\n" + text.replace("\n", "\r\n").replace(",", " ,")
    whole = spark.createDataFrame([(1, text), (2, text + " more")], "doc_id long, text string")
    assert {r.doc_id: (r.license, r.kind) for r in license_scan.scan_licenses(whole, known).collect()} == {1: ("Zlib", "permissive"), 2: (None, None)}


def test_licenses_equal_brute_force(spark):
    known = {license_scan.canonical(t): (n, k) for n, k, t in license_scan.KNOWN}
    got = {r.doc_id: (r.license, r.notices, r.text_digest) for r in queries.op4_license_scan(spark, SF).collect()}
    for i, text in documents():
        lines = {known[c][0] for c in map(license_scan.canonical_line, text.split("\n")) if c in known}
        assert got[i] == (known.get(license_scan.canonical(text), (None,))[0], sorted(lines), hashlib.sha256(text.encode()).hexdigest())


# --- quality classifier


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op5_quality_cnn(spark, sf).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    held = [(rows[i].predicted, q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in labels)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    clean, junk = [p for p, q in held if q == 1], [p for p, q in held if q == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.3


def test_classifier_hostile(spark, hostile, nothing):
    labels = spark.createDataFrame([(6, 1), (8, 0), (10, 1), (None, 1), (3, None), (4, 0), (4, 1)], "doc_id long, quality int")
    net = quality_cnn.fit(hostile, labels)
    scored = quality_cnn.score(hostile, net)
    assert scored.count() == hostile.count() and scored.filter("score IS NULL OR isnan(score)").count() == 0
    assert quality_cnn.score(nothing, net).count() == 0
    assert quality_cnn.fit(hostile, labels.filter("quality = 1")) is None
    assert quality_cnn.score(hostile, None).filter("score <> 0.5").count() == 0


def test_classifier_score_does_not_depend_on_neighbours():
    net = quality_cnn.Network.start(1)
    texts = [b"", b"a", b"ab" * 300, bytes(range(256)) * 5, b"x" * 253, b"x" * 254, LONG.encode()]
    alone = [quality_cnn.score_texts(net, [t])[0] for t in texts]
    assert np.allclose(quality_cnn.score_texts(net, texts), alone, rtol=0, atol=1e-12)
    first, last = net.taps, None
    data = np.frombuffer(texts[3] + bytes(8), np.uint8)
    peak = max(sum(first[k, data[i + k], 0] for k in range(4)) for i in range(len(texts[3])))
    near, far, _ = quality_cnn._lay_out([texts[3]])
    a, b = quality_cnn._tables(net.taps)
    assert np.isclose((a[near] + b[far])[: len(texts[3]), 0].max(), peak)


def slow_score(net, text):
    """One position, filter and chunk after another."""
    blocks = (len(text) + quality_cnn.WIDTH - 2) // quality_cnn.BLOCK + 1
    data = text + bytes(blocks * quality_cnn.BLOCK - len(text) + quality_cnn.WIDTH)
    features = []
    for f in range(quality_cnn.FILTERS):
        response = [sum(float(net.taps[k, data[i + k], f]) for k in range(quality_cnn.WIDTH)) for i in range(blocks * quality_cnn.BLOCK)]
        chunks = [response[b * quality_cnn.BLOCK : (b + 2) * quality_cnn.BLOCK] for b in range(blocks)]
        active = [max(max(c) + float(net.bias[f]), 0.0) for c in chunks]
        features.append((sum(active) / blocks, max(active)))
    x = [m for m, _ in features] + [t for _, t in features]
    return 1 / (1 + np.exp(-(sum(a * b for a, b in zip(x, net.weights)) + net.offset)))


def test_scores_equal_a_plain_forward_pass(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = quality_cnn.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = [t.encode() for _, t in documents()[:12]] + [b"", b"a", b"x" * 253, b"x" * 254, bytes(range(256)) * 5]
    assert np.allclose(quality_cnn.score_texts(net, texts), [slow_score(net, t) for t in texts], rtol=0, atol=1e-5)


def test_gradients_are_slopes():
    net = quality_cnn.Network.start(3)
    texts, labels = [b"some bytes here" * 40, b"!!! ###" * 60, b"zz"], np.array([1.0, 0.0, 1.0])

    def loss(n):
        p = quality_cnn.score_texts(n, texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    g = quality_cnn._gradients(net, texts, labels)
    step = 1e-3
    for at in ((0, ord("s"), 2), (1, ord("#"), 0), (3, ord("!"), 5)):
        up, down = net.taps.copy(), net.taps.copy()
        up[at] += step
        down[at] -= step
        made = [quality_cnn.Network(t, net.bias, net.weights, net.offset) for t in (up, down)]
        assert np.isclose((loss(made[0]) - loss(made[1])) / (2 * step), g[0][at], atol=2e-3)


# --- URL filter


def test_urls(spark, nothing):
    urls = [
        None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "https://www.example.com/en/a/b?x#y", "http://a.b.net/es/1",
        "http://net/fr/", "http://anet/fr/", "http://x.com", "http://x.com/?q=/en/", "http://example.com/enx", "http://x.com:80/", "a://b://c.net/es/",
        "http://deep.example.com/en/" + "d/" * 3000,
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(4, urls[4], "h")], "page_id long, url string, verdict string")
    rules = url_filter.rule_table(spark, queries.URL_RULES)
    got = url_filter.judge_urls(pages, rules).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        url = urls[r.page_id]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
        fits = []
        for verdict, rule in queries.URL_RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(rule), rule, verdict))
        best = max(fits, default=(0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[1], best[2])
    odd = spark.createDataFrame(
        [("block", "com", "/ab"), ("allow", "com", "/ab"), ("block", "x.org", ""), (None, "a", "/"), ("block", None, "/")],
        "verdict string, host string, path string",
    )
    got = {r.url: r.verdict for r in url_filter.judge_urls(
        spark.createDataFrame([("http://q.com/abc",), ("http://q.com/a",), ("http://x.org",)], "url string"), odd, key="url").collect()}
    assert got == {"http://q.com/abc": "block", "http://q.com/a": "allow", "http://x.org": "block"}
    assert url_filter.judge_urls(pages, rules.limit(0)).filter("rule IS NOT NULL").count() == 0
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_findings_are_planned_without_a_literal_for_each_word(spark):
    prose = [f"word{i}" for i in range(400)]
    plan = secret_scan.labelled_findings(spark, prose)._jdf.queryExecution().logical().toJSON()
    assert plan.count("expressions.Literal") < 4 * len(prose)
