"""Change logs of form entries, kept as a long table.

A *cell* is one field of an entry, or one sub-field of one row of a table field: its path is
(field, ordinal, sub), with ordinal and sub -1 for a plain field. ``values`` is an array of text.
Everything works per cell, so no entry's whole history has to meet in one place, and the ordered
steps go through ``with_running``, which splits a long history over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import LastNonNull, Previous, RowNumber, with_running

PATH = ("field", "ordinal", "sub")
# Fields that the form system fills itself.
SYSTEM_FIELDS = (2, 3, 4)


def _filled(values: str) -> Column:
    return F.coalesce(F.size(values) > 0, F.lit(False))


def changelog_patch(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Patch that leads from the before cells to the after cells of each log entry.

    ``before``, ``after``: keys, field, ordinal, sub, values. Result: path, op and values, where op
    is add, replace or remove. A plain field that comes up is an add; cleared to an empty list it
    is left alone. In a table, all cells of a row that goes are removed, and so is a cell that had
    values and is empty now; a cell that a staying row no longer lists, and a table that goes as a
    whole, yield nothing.
    """
    path = [*keys, *PATH]
    b = before.select(*path, F.col("values").alias("b"), F.lit(True).alias("has_b"))
    a = after.select(*path, F.col("values").alias("a"), F.lit(True).alias("has_a"))
    cells = b.join(a, path, "full").withColumns(
        {"has_b": F.coalesce("has_b", F.lit(False)), "has_a": F.coalesce("has_a", F.lit(False))}
    )
    # windows over one log entry's table, not a history: bounded by the form
    field_stays = F.max("has_a").over(Window.partitionBy(*keys, "field"))
    row_stays = F.max("has_a").over(Window.partitionBy(*keys, "field", "ordinal"))
    plain = F.col("ordinal") < 0
    op = (
        F.when(_filled("a"), F.when(plain & ~F.col("has_b"), "add").otherwise("replace"))
        .when(plain, F.when(~F.col("has_a") & _filled("b"), "remove"))
        .when(F.col("has_a"), F.when(_filled("b"), "remove"))
        .when(F.col("_field_stays") & ~F.col("_row_stays"), "remove")
    )
    return (
        cells.withColumns({"_field_stays": field_stays, "_row_stays": row_stays})
        .withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select(*path, "op", F.when(F.col("op") != "remove", F.col("a")).alias("values"))
    )


@dataclass(frozen=True)
class NextReset(LastNonNull):
    """Last non-null value of the rows before this one (after it, when the order is reversed)."""

    def local(self, w: WindowSpec) -> Column:
        return F.last(self.col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))


def changelog_rebuild_state(log: DataFrame, keys: Sequence[str], log_id: str = "log_id", **kw) -> DataFrame:
    """State after every log entry, as values with the log range in which they hold.

    ``log``: keys (entity and path), log_id, op, values. The state after entry t is the rows with
    valid_from <= t and (valid_to is null or t < valid_to); ``nth`` orders the values of one
    entry. A replace or remove ends all earlier values of its path, an add joins them.
    """
    resets = log.withColumns({"_neg": -F.col(log_id), "_reset": F.when(F.col("op") != "add", F.col(log_id))})
    ended = with_running(resets, keys, ["_neg"], valid_to=NextReset("_reset"), **kw)
    return ended.filter("op <> 'remove'").select(
        *keys, F.col(log_id).alias("valid_from"), "valid_to", F.posexplode("values").alias("nth", "value")
    )


def final_state(rebuilt: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """What holds at the end of a rebuilt log, one row per value: keys, place (from 1) and value."""
    numbered = with_running(rebuilt.filter("valid_to IS NULL"), keys, ["valid_from", "nth"], place=RowNumber(), **kw)
    return numbered.select(*keys, "place", "value")


def changelog_check_before(log: DataFrame, keys: Sequence[str], log_id: str = "log_id", **kw) -> DataFrame:
    """Entries whose recorded ``before`` is not what the entry before them left; empty is absent."""
    checked = with_running(log, keys, [log_id], _prev=Previous("after"), **kw)
    none = F.array().cast(log.schema["after"].dataType)
    return (
        checked.filter(~F.coalesce("before", none).eqNullSafe(F.coalesce("_prev", none)))
        .select(*keys, log_id, F.col("before").alias("recorded"), F.col("_prev").alias("state"))
    )


def state_values(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A state with one array per cell (keys, title, values) as one row per value."""
    return state.select(*keys, "title", F.posexplode("values").alias("place", "value"))


def state_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells that differ between two states, one row per value (keys, title, place, value).

    Values compare place by place, as text, so a cell of any length is never brought together. A
    title that is null or empty on either side is an error in the data and is reported as one.
    """
    place = [*keys, "place"]

    def side(state: DataFrame, s: str) -> DataFrame:
        return state.select(
            *[F.col(c).alias(f"{s}_{c}") for c in place], F.struct(F.col("title").alias("t"), F.col("value").alias("v")).alias(s)
        )

    same = reduce(lambda a, b: a & b, [F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in place])
    met = side(left, "l").join(side(right, "r"), same, "full")
    own = [F.when(F.col("l").isNotNull(), F.col(f"l_{k}")).otherwise(F.col(f"r_{k}")).alias(k) for k in keys]

    def untitled(s: str) -> Column:
        return F.col(s).isNotNull() & F.coalesce(F.col(f"{s}.t") == "", F.lit(True))

    cells = met.groupBy(*own).agg(
        F.count("l").alias("n_l"),
        F.count("r").alias("n_r"),
        F.bool_or(untitled("l") | untitled("r")).alias("untitled"),
        F.bool_or(F.coalesce(F.col("l.t") != F.col("r.t"), F.lit(False))).alias("title"),
        F.bool_or(~F.col("l.v").eqNullSafe(F.col("r.v"))).alias("values"),
    )
    problem = (
        F.when(F.col("n_r") == 0, "only left")
        .when(F.col("n_l") == 0, "only right")
        .when(F.col("untitled"), "no title")
        .when(F.col("title"), "title")
        .when(F.col("values") | (F.col("n_l") != F.col("n_r")), "values")
    )
    return cells.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select(*keys, "problem")


def changelog_check_final(rebuilt: DataFrame, online: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Differences between the rebuilt state and the online one, system fields left out."""
    skip = F.col("field").isin(*SYSTEM_FIELDS)
    return state_differences(rebuilt.filter(~skip), online.filter(~skip), keys)
