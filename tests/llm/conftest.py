import pytest

#: Nulls, empty and blank texts, ties, repeated rows, a long text, and columns whose names clash with results.
LONG = "Long words of a very long text, again and again. " * 4000 + "tail " * 50
TEXTS = [
    None, "", " \t\n", "one", "one two three", "Ünïcode wörds ß İ Σίσυφος <|endoftext|> 中文 e\u0301",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3,
    "line one here\nline one here\n\nline two there\r\nline one here",
    'the token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" leaks here and commit 0beec7b5ea3f0fdbc95d0dd47f3c5bc275da8a33 does not',
    "Licence:\n(c) 2020 Someone\nReleased under the MIT Licence!\nlicensed  under the apache license, version 2.0",
    LONG,
]


@pytest.fixture(scope="session")
def hostile(spark):
    rows = [(i, t, "en", ("s1", None, "s2", "")[i % 4], len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[6], rows[6], (None, "no key at all", None, "s1", None), (None, None, None, None, None), (4, "one two four", "en", "s2", 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = "score fingerprint fp size taken kept failed license ids n_tokens start digest file shard _id _key _hash slot rank".split()
    return docs.selectExpr("*", *[f"'x' AS `{c}`" for c in clash]).repartition(3)


@pytest.fixture(scope="session")
def nothing(hostile):
    return hostile.limit(0)
