"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so a longer text has a
larger sketch and two sketches of any sizes can be compared or merged. Short texts would keep next
to nothing; a sketch therefore also keeps the smallest ``FLOOR`` hashes, which merges as well.
Everything is a DataFrame expression: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.sampling import SPLIT_ROWS
from ledgerspark.operators.ordered import Previous, with_running
from ledgerspark.session import stored

WORDS = 5
#: One hash in so many is kept, and at least so many of a text.
SCALE, FLOOR = 8, 32
#: Hashes are signed 64-bit: the fraction at the lower end of their range.
LIMIT = -(1 << 63) + (1 << 64) // SCALE
_TOP = (1 << 63) - 1


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """XXH64 of every run of ``words`` words, from the words' own hashes; a shorter text is one run."""
    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    own = F.transform(split, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        return (
            F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
            .when(F.size(h) < words, F.array(F.xxhash64(h)))
            .otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)])
                )
            )
        )

    # binds the words' hashes to a name, so that they are computed once
    return F.get(F.transform(F.array(own), runs), 0)


def sketch(text: Column, words: int = WORDS) -> Column:
    """Sorted distinct hashes below the limit, and the smallest ``FLOOR`` ones where those are fewer."""

    def keep(h: Column) -> Column:
        below = F.array_distinct(F.filter(h, lambda x: x < LIMIT))
        return F.get(
            F.transform(
                F.array(below),
                lambda b: F.when(F.size(b) >= FLOOR, F.sort_array(b)).otherwise(F.slice(F.sort_array(F.array_distinct(h)), 1, FLOOR)),
            ),
            0,
        )

    return F.get(F.transform(F.array(shingle_hashes(text, words)), keep), 0)


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts' shingles together, from their sketches."""
    both = F.sort_array(F.array_union(a, b))
    return F.filter(both, lambda x, i: (x < LIMIT) | (i < FLOOR))


def _complete_to(s: Column) -> Column:
    """Largest hash up to which a sketch holds all of its text's."""
    largest = F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(_TOP))
    return F.when(F.size(s) < FLOOR, F.lit(_TOP)).when(largest < LIMIT, F.lit(LIMIT - 1)).otherwise(largest)


def overlap(a: Column, b: Column) -> Column:
    """Distinct shingles that two sketches show of each text and in common, up to the same limit."""

    def count(t: Column) -> Column:
        x, y = F.filter(a, lambda v: v <= t), F.filter(b, lambda v: v <= t)
        return F.struct(F.size(x).alias("a"), F.size(y).alias("b"), F.size(F.array_intersect(x, y)).alias("both"))

    return F.get(F.transform(F.array(F.least(_complete_to(a), _complete_to(b))), count), 0)


def likeness(o: Column) -> Column:
    """Estimated Jaccard similarity, from 0 to 1; two empty texts are alike, an empty one and another are not."""
    union = o["a"] + o["b"] - o["both"]
    return F.when(union == 0, F.lit(1.0)).otherwise(o["both"] / union)


def containment(o: Column) -> Column:
    """Estimated share of the first text's shingles that the second holds; 1 when the first shows none."""
    return F.when(o["a"] == 0, F.lit(1.0)).otherwise(o["both"] / o["a"])


def fingerprint(s: Column) -> Column:
    """A sketch as text: its hashes, 16 lowercase hex digits each; "" for an empty text."""
    return F.lower(F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key and the sketch of the whole text. Null is an empty text."""
    return docs.select(key, sketch(F.coalesce(text, F.lit(""))).alias("sketch"))


_NAME = ["_null", "_id", "_hash"]


def next_texts(rows: DataFrame, text: str) -> DataFrame:
    """For each document (``_null``, ``_id``, ``_hash``, as ``_of...``) the start of the next one, as long as a
    quarter of its own text, and the next one's sketch. After the last comes the first.

    Neighbours are found over ids and lengths only; of the texts, the quarters travel.
    """
    names = stored(rows.select(*_NAME, F.length(text).alias("_n")).distinct().withColumn("_me", F.struct(*_NAME, "_n")), "names")
    linked = with_running(names, [], _NAME, chunk_rows=SPLIT_ROWS, _before=Previous("_me"))
    last = linked.agg(F.max("_me").alias("m")).select("m.*").first()
    wrap = F.struct(*[F.lit(v).cast(linked.schema["_me"].dataType[n].dataType).alias(n) for n, v in last.asDict().items()])
    linked = linked.select(*_NAME, F.coalesce("_before", wrap).alias("_before"))
    quarter = F.expr(f"substring({text}, 1, CAST(_before._n DIV 4 AS INT))")
    return (
        rows.join(linked, _NAME)
        .select(*[F.col(f"_before.{c}").alias(f"_of{c}") for c in _NAME], quarter.alias("_start"), sketch(F.col(text)).alias("_next"))
        .dropDuplicates([f"_of{c}" for c in _NAME])
    )


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, contained_edited and contained_next.

    The edited text ends in the start of the next document, by ascending key, instead of its own
    last quarter. Rows with one key are ordered by a hash of their text, null keys come last, and rows that
    repeat both key and text are one document with one result each. Null is an empty text; a
    single document is its own next; an empty table gives no rows. Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    kind = docs.schema[key].dataType
    rows = docs.select(
        F.col(key).isNull().alias("_null"), F.coalesce(F.col(key), F.lit(0).cast(kind)).alias("_id"),
        F.xxhash64(whole).alias("_hash"), whole.alias("_text"),
    )
    following = next_texts(rows, "_text")
    same = [F.col(c) == F.col(f"_of{c}") for c in _NAME]
    n = F.length("_text")
    edited = F.expr("concat(substring(_text, 1, CAST(length(_text) - length(_text) DIV 4 AS INT)), _start)")
    paired = rows.join(following, same, "left").select(
        F.when(~F.col("_null"), F.col("_id")).alias(key), n.cast("bigint").alias("n_chars"), edited.alias("_edited"), "_text", "_next"
    )
    sketched = paired.select(
        key, "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        sketch(F.col("_text")).alias("_own"), sketch(F.col("_edited")).alias("_new"), "_next",
    )
    compared = sketched.withColumns({"_to_new": overlap(F.col("_own"), F.col("_new")), "_to_next": overlap(F.col("_own"), F.col("_next"))})
    return compared.select(
        key,
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("_own")).alias("fingerprint"),
        fingerprint(F.col("_new")).alias("edited_fingerprint"),
        likeness(F.col("_to_new")).alias("near_edited"),
        likeness(F.col("_to_next")).alias("near_next"),
        containment(F.col("_to_new")).alias("contained_edited"),
        containment(F.col("_to_next")).alias("contained_next"),
    )
