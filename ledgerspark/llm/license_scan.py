"""License scans: canonical texts, looked up whole by digest.

Case, punctuation, white space, copyright lines and equivalent spellings are normalised; the digest
of what is left is joined to the digests of known licences. The texts looked up are each document
as a whole, each of its lines, and each run of lines that opens like a known text and has as many
words, so a licence file, a one-line notice and a licence within a longer document are all found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.license_texts import EQUIVALENT, KNOWN

_WORD = re.compile(r"\w+")
# "Copyright 2024 Someone", "(c) 2024 Someone", but not the words of a licence about copyright notices
_COPYRIGHT = re.compile(r"\W*(?:copyright\b\W*(?:\(c\)|©|\d{4}|by\b)|\(c\)|©)", re.IGNORECASE)
#: Words at the start of a known text by which runs of lines are chosen.
OPENING = 4
#: Digests that a task holds before it hands them on.
UNITS = 1 << 16
#: From the strictest on.
KIND_ORDER = ("restricted", "copyleft", "permissive")


def canonical_line(line: str) -> str:
    """Words in lower case with one spelling each; "" for a copyright line."""
    if _COPYRIGHT.match(line):
        return ""
    return " ".join([EQUIVALENT.get(w, w) for w in _WORD.findall(line.lower())])


def canonical(text: str) -> str:
    """Canonical form of a whole text: its canonical lines, joined."""
    return " ".join(filter(None, map(canonical_line, text.split("\n"))))


def digest(canonical_text: str) -> bytes:
    return hashlib.sha256(canonical_text.encode("utf-8", "surrogatepass")).digest()


def known_licenses(spark: SparkSession, known: Iterable[tuple[str, str, str]] = KNOWN) -> DataFrame:
    """Known texts as license, kind, digest of the canonical text, its first words and their number."""
    texts = {(name, kind, canonical(text)) for name, kind, text in known if canonical(text)}
    rows = [(n, k, bytearray(digest(t)), t.split(" ")[:OPENING], t.count(" ") + 1) for n, k, t in sorted(texts)]
    return spark.createDataFrame(rows, "license string, kind string, digest binary, opening array<string>, words int")


def _shapes(known: DataFrame) -> dict[str, list[tuple[list[str], list[int]]]]:
    """First word -> the openings that start with it, each with the lengths of its texts; bounded by the known licences.

    A table without these columns, of digests alone, is met by whole texts and lines only.
    """
    if not {"opening", "words"} <= set(known.columns):
        return {}
    shapes: dict[str, list[tuple[list[str], list[int]]]] = {}
    for r in known.groupBy("opening").agg(F.collect_set("words").alias("lengths")).collect():
        shapes.setdefault(r.opening[0], []).append((r.opening, r.lengths))
    return shapes


def runs(lines: list[str], shapes: dict[str, list[tuple[list[str], list[int]]]]) -> Iterator[str]:
    """Runs of canonical lines that open like a known text and are as long."""
    words, starts = [], []
    for line in lines:
        starts.append(len(words))
        words += line.split(" ")
    ends = {*starts, len(words)}
    for at in starts:
        for opening, lengths in shapes.get(words[at], ()):
            if words[at : at + len(opening)] == opening:
                yield from (" ".join(words[at : at + n]) for n in lengths if at + n in ends)


def _units(batches: Iterator[pa.RecordBatch], shapes: dict[str, list[tuple[list[str], list[int]]]]) -> Iterator[pa.RecordBatch]:
    """Digests of each text and of its distinct lines and runs; ``whole`` marks the text's own."""

    def flushed() -> pa.RecordBatch:
        columns = (ids, pa.int64()), (row_digests, pa.binary()), (whole, pa.bool_()), (found, pa.binary())
        rows, *rest = [pa.array(values, kind) for values, kind in columns]
        return pa.RecordBatch.from_arrays([batch.column(0).take(rows), *rest], [batch.schema.names[0], "text_digest", "whole", "digest"])

    for batch in batches:
        ids, row_digests, whole, found = [], [], [], []
        for i, text in enumerate(batch.column(1)):
            raw = text.as_py() or ""
            lines = [c for c in map(canonical_line, raw.split("\n")) if c]
            own = hashlib.sha256(raw.encode("utf-8", "surrogatepass")).digest()
            units = [digest(" ".join(lines)), *map(digest, dict.fromkeys([*lines, *runs(lines, shapes)]))]
            ids += [i] * len(units)
            row_digests += [own] * len(units)
            whole += [True] + [False] * (len(units) - 1)
            found += units
            if len(found) >= UNITS:
                yield flushed()
                ids, row_digests, whole, found = [], [], [], []
        if found:
            yield flushed()


def scan_licenses(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, text_digest (SHA-256 of the raw text, hex), license (the whole
    text is this licence, else null), notices (sorted licences of its lines and runs of lines) and kind.

    ``kind`` is the strictest of what was found: restricted, copyleft, permissive, or null. A text that
    equals two known licences takes the first by name. A null text is an empty one and has no
    licence; a null key stays; repeated rows give repeated rows; empty tables work. Only ``key`` and
    ``text`` are read, so other columns may have any name.

    Every document, line and run meets the known digests in one join. A document's units are folded
    back per key and text, with partial sums before the shuffle, so a long text is no hot key; the
    notices of one document are bounded by the known licences.
    """
    kind = docs.schema[key].dataType.simpleString()
    shapes = _shapes(known)
    units = docs.select(key, text).mapInArrow(lambda batches: _units(batches, shapes), f"`{key}` {kind}, text_digest binary, whole boolean, digest binary")
    names = known.groupBy("digest").agg(F.min(F.struct("license", "kind")).alias("_k"))
    met = units.join(names, "digest", "left")
    strictest = F.min(F.when(F.col("_k").isNotNull(), F.array_position(F.lit(list(KIND_ORDER)), F.col("_k.kind"))))
    per_text = met.groupBy(key, "text_digest").agg(
        F.max(F.when(F.col("whole"), F.col("_k.license"))).alias("license"),
        F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("_k.license")))).alias("notices"),
        F.get(F.lit(list(KIND_ORDER)), (strictest - 1).cast("int")).alias("kind"),
        F.count_if("whole").alias("_copies"),
    )
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return per_text.select(key, F.lower(F.hex("text_digest")).alias("text_digest"), "license", "notices", "kind", copies.alias("_n")).drop("_n")
