"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and one bit per
failed rule; a policy is a versioned mask over those bits, so applying a policy, changing one or
asking what a rule alone removes needs the ledger only, never the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouts")

#: Rule -> failure condition over the measurements; a rule's bit is its position. Only add at the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "shouting": "10 * n_shouts > 5 * n_words",
    "repeated_lines": "10 * n_dup_lines > 5 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 40 * n_words",
}
BIT = {rule: 1 << i for i, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Version -> mask of the rules that reject a document.
POLICIES = {
    "v1-base": BASE,
    "v2-junk": BASE | BIT["symbols"] | BIT["shouting"],
    "v3-strict": sum(BIT.values()),
}
CURRENT = "v2-junk"


def repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    # pairs get dense ids first, so that the key of three cannot overflow
    _, pair = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)
    _, three, count = np.unique(pair[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    hit = np.zeros(n, bool)
    twice = count[three] > 1
    for shift in range(3):
        hit[shift : n - 2 + shift] |= twice
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``; null is an empty text.

    Words are runs without space, tab, LF, VT, FF and CR. Lines are split at LF and count when they hold a word.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at exactly these six
    joined = b"".join(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass")),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated(words),
        sum(w.endswith(b"!!") for w in words),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t.as_py()) for t in batch.column(1)]
        columns = [pa.array(column, pa.int64()) for column in zip(*rows)] or [pa.array([], pa.int64())] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [batch.schema.names[0], *MEASURES])


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, the measurements and ``failed``, the bits of the failed rules.

    Rows are measured on their own, without a shuffle, so hot keys and copies do not matter. A null
    or empty text has zero measurements (and fails ``few_words``); a null key stays null; repeated
    rows give repeated rows. Only ``key`` and ``text`` are read, so other columns may have any name.
    """
    schema = ", ".join([f"`{key}` {docs.schema[key].dataType.simpleString()}", *[f"{m} bigint" for m in MEASURES]])
    rows = docs.select(key, text).mapInArrow(_measured, schema)
    bits = [F.when(F.expr(fails), BIT[rule]).otherwise(0) for rule, fails in RULES.items()]
    return rows.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint"))


def rejected(policy: str = CURRENT) -> Column:
    """Whether a ledger row fails a rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) != 0


def ablation(rows: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule: documents that fail it, and those that only this rule removes.

    The ledger shrinks to one count per distinct bit pattern, at most 2 to the number of rules;
    policies and rules only meet those patterns. An empty ledger gives no rows.
    """
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("_n"))
    asked = [
        F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(mask).cast("bigint").alias("mask"), F.lit(BIT[r]).cast("bigint").alias("bit"))
        for v, mask in policies.items()
        for r in RULES
        if mask & BIT[r]
    ]
    each = patterns.select("failed", "_n", F.explode(F.array(*asked)).alias("_a")).select("failed", "_n", "_a.*")
    under = F.col("failed").bitwiseAND(F.col("mask"))
    return each.groupBy("policy", "rule").agg(
        F.sum(F.when(under.bitwiseAND(F.col("bit")) != 0, F.col("_n")).otherwise(0)).alias("fail"),
        F.sum(F.when(under == F.col("bit"), F.col("_n")).otherwise(0)).alias("only_this"),
        F.sum(F.when(under != 0, F.col("_n")).otherwise(0)).alias("removed_by_policy"),
        F.sum("_n").alias("documents"),
    )
