"""Mixing sources to target weights with a low-discrepancy schedule.

Slots of equal words are dealt to the sources by a low-discrepancy sequence, mapped through the
sources' cumulative targets, so any stretch of the schedule is close to the target mix. The slots
of a source are ranked, and the slot of rank r takes the r-th block of equal words of the source's shuffled
documents; a source with more slots than blocks starts again from its first document. How many words a source
gives, and where in the mix a document stands, therefore follow from the points that it got.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.sampling import SPLIT_ROWS
from ledgerspark.operators.ordered import RowNumber, RunningSum, with_running
from ledgerspark.session import stored

WEIGHTS = (5, 2, 1)
#: Most words per block and slot, and slots that a smaller corpus is cut into; a source is repeated at most so often.
BLOCK_WORDS, FINE, MOST = 64, 1 << 16, 3
#: Cells of the unit interval in which points meet the sources that reach into them.
CELLS = 4096
SEED = 10
GOLDEN = (math.sqrt(5) - 1) / 2
_LOW = 1 << 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, size; one row each) plus source_no, weight and target.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all sizes. A
    target stops at ``most`` times the size; what that leaves over goes to the others by weight. In
    ascending order of size per weight the sources that stop come first, so one running sum finds them.
    """
    n = len(weights)
    ranked = with_running(sizes.withColumn("_null", F.col("source").isNull()), [], ["_null", "source"], chunk_rows=SPLIT_ROWS, source_no=RowNumber())
    weighed = ranked.withColumn("weight", F.get(F.lit(list(weights)), ((F.col("source_no") - 1) % n).cast("int")).cast("bigint"))
    weighed = weighed.withColumn("_ratio", F.col("size") / F.col("weight"))
    run = with_running(weighed, [], ["_ratio", "source_no"], chunk_rows=SPLIT_ROWS, _s=RunningSum("size"), _w=RunningSum("weight"))
    total, weight = run.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left = F.lit(total) - most * (F.col("_s") - F.col("size"))  # before this source takes its part
    stops = most * F.col("_ratio") * (F.lit(weight) - F.col("_w") + F.col("weight")) < left
    run = stored(run.withColumn("_stops", stops), "targets")
    part = run.filter("_stops").agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = (total - most * part[0]) / (weight - part[1]) if weight > part[1] else 0.0
    target = F.when(F.col("_stops"), (most * F.col("size")).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return run.select("source", "size", "source_no", "weight", target.alias("target"))


def golden_points(slot: Column) -> Column:
    """Fractional part of slot times the golden ratio; the two parts of the slot keep it exact."""
    high, low = F.floor(slot / _LOW), slot % _LOW
    x = high * F.lit(math.fmod(_LOW * GOLDEN, 1.0)) + low * F.lit(GOLDEN)
    return x - F.floor(x)


def van_der_corput(slot: Column) -> Column:
    """The slot's 48 binary digits in reverse, as a fraction."""
    return F.conv(F.reverse(F.lpad(F.bin(slot), 48, "0")), 2, 10).cast("double") / F.lit(2.0**48)


def schedule(shares: DataFrame, slots: int, sequence: Callable[[Column], Column] = golden_points) -> DataFrame:
    """``shares`` (source_no, words) -> slot (from 1), source_no and rank of the slot within its source: slot i goes to
    the source whose part of the words, one after the other, holds point i of the sequence."""
    spark = shares.sparkSession
    laid = stored(with_running(shares.filter("words > 0"), [], ["source_no"], chunk_rows=SPLIT_ROWS, _hi=RunningSum("words")), "shares")
    total = laid.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    width = max(1, -(-total // CELLS))
    spans = laid.withColumn("_lo", F.col("_hi") - F.col("words")).select(
        "source_no", "_lo", "_hi", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))).alias("_cell")
    )
    at = F.least(F.floor(sequence(F.col("slot")) * total), F.lit(total - 1))
    points = spark.range(1, (slots if total else 0) + 1).select(F.col("id").alias("slot")).withColumn("_at", at)
    met = points.withColumn("_cell", F.floor(F.col("_at") / width)).join(spans, "_cell").filter("_at >= _lo AND _at < _hi")
    return with_running(stored(met.select("slot", "source_no"), "slots"), ["source_no"], ["slot"], chunk_rows=SPLIT_ROWS, rank=RowNumber())


def _placed(
    docs: DataFrame, key: str, text: str, source: str, weights: Sequence[int], block: int | None, seed: int, sequence: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their place _start in the source's shuffled words, source_no, target and the words the mix takes of the
    source; the schedule; and the words of a block."""
    order = ["_shuffle", "_key", "digest"]
    rows = docs.select(
        F.col(key).alias("_key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("_shuffle"), F.xxhash64(F.col(text)).alias("digest"),
    )
    rows = stored(rows, "sizes")
    placed = with_running(rows, ["source"], order, chunk_rows=SPLIT_ROWS, _end=RunningSum("size"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    quota = stored(source_targets(sizes, weights), "quota")
    total = quota.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    block = block or max(1, min(BLOCK_WORDS, total[0] // FINE))
    words = F.floor(F.col("target") + 0.5).alias("words")
    dealt = stored(schedule(quota.select("source_no", words), -(-round(total[1]) // block), sequence), "schedule")
    got = dealt.groupBy("source_no").agg(F.count(F.lit(1)).alias("_slots"))
    # a source that has given all it may gives no more
    taken = F.least(F.coalesce("_slots", F.lit(0)) * block, F.col("size") * MOST).alias("_taken")
    known = quota.join(got, "source_no", "left").select(F.col("source").alias("_source"), "source_no", F.col("size").alias("source_size"), "target", taken)
    met = placed.join(known, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_start", F.col("_end") - F.col("size"))
    return met.drop("_source"), dealt, block


def _slot_of(passes: int | Column, block: int) -> Column:
    """Rank of the slot that takes the first word of a row in a pass over its source, counted from 0."""
    return (F.floor((passes * F.col("source_size") + F.col("_start")) / block) + 1).cast("bigint")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
    block: int | None = None, seed: int = SEED, sequence: Callable[[Column], Column] = golden_points,
) -> DataFrame:
    """One row per row of ``docs``: key, source, digest (of the text, as a row's tie-break), size (words), source_size,
    target (of the source), taken (words the mix takes of this row, repeats counted) and slot, where the
    mix first takes of it (null: nowhere).

    A source's taken words are the words of the slots it got, so they are its target but for the few slots that
    the sequence is off; no document exceeds three times its size. A block has BLOCK_WORDS words, or fewer in a
    corpus of less than FINE such blocks. Within a source the documents are ordered by a seeded hash of key and
    text, so reruns agree. A null text has size 0 and takes part in nothing; a null source is a source of
    its own; a null key is a key; repeated rows are separate rows; an empty table gives no rows. Only the three
    named columns are read.

    No source is ever in one task: places and ranks are running values over ranges, and rows meet slots by
    (source, rank).
    """
    placed, dealt, block = _placed(docs, key, text, source, weights, block, seed, sequence)
    whole = F.expr("IF(source_size > 0, _taken DIV source_size, 0L)")
    rest = F.col("_taken") - whole * F.col("source_size")
    part = F.greatest(F.least(F.col("_end"), rest) - F.col("_start"), F.lit(0))
    rows = placed.withColumns({"taken": (whole * F.col("size") + part).cast("bigint"), "rank": F.when(F.col("size") > 0, _slot_of(0, block))})
    slots = dealt.select("source_no", "rank", "slot")
    met = rows.join(slots, ["source_no", "rank"], "left")
    shown = F.when(F.col("taken") > 0, F.col("slot")).alias("slot")
    return met.select(F.col("_key").alias(key), "source", "digest", "size", "source_size", "target", "taken", shown)


def mixed_rows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS,
    block: int | None = None, seed: int = SEED, sequence: Callable[[Column], Column] = golden_points, slot: str | None = None,
) -> DataFrame:
    """``docs``, all columns, in the order of the schedule, each row as often as the mix takes it: its taken words over its
    size, rounded. Column ``slot``, if named, says which slot takes the row.

    Rows without words are in no mix. Of each source at most the one document that its words end in is rounded.
    Rows equal in key, source and text have the same slots, those of the first of them.
    """
    placed, dealt, block = _placed(docs, key, text, source, weights, block, seed, sequence)
    half = F.floor((F.col("_taken") - F.col("_start") - (F.col("size") + 1) / 2) / F.col("source_size")) + 1
    times = placed.filter("size > 0").withColumn("_times", F.greatest(half, F.lit(0)).cast("int")).filter("_times > 0")
    copies = times.select("*", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("_copy"))
    copies = copies.withColumn("rank", _slot_of(F.col("_copy"), block)).join(dealt, ["source_no", "rank"])
    first = copies.groupBy("_key", "source", "digest", "_copy").agg(F.min("slot").alias("slot")).select(F.struct("*").alias("_t"))
    t = first["_t"]
    same = docs[key].eqNullSafe(t["_key"]) & docs[source].eqNullSafe(t["source"]) & (F.xxhash64(docs[text]) == t["digest"])
    each = docs.join(first, same).select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), t["slot"].alias("_slot"))
    ordered = each.repartitionByRange("_slot").sortWithinPartitions("_slot")
    return ordered.select("_row.*", *([F.col("_slot").alias(slot)] if slot else []))
