"""Row-level expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import RowNumber, RunningMax, with_running

# Region type codes, device status codes, and the status that counts as idle.
REGION_TYPES = {1: "省", 2: "市", 3: "县", 4: "乡镇", 5: "村庄"}
DEVICE_STATUS = {1: "空闲", 3: "运行", 4: "故障", 5: "游离", 6: "掉线", 7: "维护", 8: "上线"}
IDLE, RUNNING = "空闲", "运行"

# A contract's yearly-cost clause, an account title, and a discount note.
CLAUSE = r"截止\d{4}-\d{2}-\d{2}，每年费用([\d\.]+)元.*"
CLAUSE_DATE = r"截止(\d{4}-\d{2}-\d{2})"
TITLE = r"^\d+\.\d+([^\-]+)\-(.*)"
DISCOUNT = r"^(\d{4}-\d{2}-\d{2})至(\d{4}-\d{2}-\d{2})优惠([\d\.]+)元.*$"

# Layout of a 64-bit id and the epoch of its millisecond part.
ID_EPOCH_MS = 1585644268888
SEQUENCE_BITS, WORKER_BITS, DATACENTER_BITS = 12, 5, 5


def lookup(codes: dict, code: Column) -> Column:
    """Name of a code; null when there is none."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), code)


def normal_status(status: Column) -> Column:
    return F.when(status == RUNNING, IDLE).otherwise(status)


def split_trim_omit(text: Column, sep: str = ",") -> Column:
    """Parts between separators, trimmed, without the empty ones."""
    parts = F.transform(F.split(text, sep), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda p: p != "")


MARK, CUT, ESCAPED = "\u0001", "\u0001c", "\u0001e"


def split_keep_delimiter(text: Column, pattern: str) -> Column:
    """Text cut after each match of ``pattern``; the matches stay, the remainder is the last part.

    Cuts are marked with a control character, which is escaped where the text itself has it.
    """
    escaped = F.replace(text, F.lit(MARK), F.lit(ESCAPED))
    cut = F.regexp_replace(escaped, f"({pattern})", f"$1{CUT}")
    return F.transform(F.split(cut, CUT, -1), lambda p: F.replace(p, F.lit(ESCAPED), F.lit(MARK)))


def extract_clauses(
    df: DataFrame, text: str, *keep: str, pattern: str = CLAUSE, date_pattern: str = CLAUSE_DATE
) -> DataFrame:
    """All clauses of a text, one row each: offset, date and amount, the first group of ``pattern``.

    Every part but the last ends with its clause, so offsets follow from the parts' lengths.
    """
    parts = df.select(*keep, split_keep_delimiter(F.col(text), pattern).alias("_parts"))
    placed = parts.select(*keep, "_parts", F.posexplode(F.slice("_parts", F.lit(1), F.size("_parts") - 1)).alias("_i", "_part"))
    before = F.aggregate(F.slice("_parts", F.lit(1), F.col("_i")), F.lit(0), lambda n, p: n + F.length(p))
    clause = F.regexp_extract("_part", f"({pattern})$", 1)
    return placed.select(
        *keep,
        (before + F.length("_part") - F.length(clause)).alias("offset"),
        F.regexp_extract(clause, date_pattern, 1).alias("date"),
        F.regexp_extract(clause, pattern, 1).alias("amount"),
    )


def json_point_at(document: Column, pointer: str) -> Column:
    """Value at a JSON Pointer such as ``/0/value``, as text; null when absent."""
    path = "$"
    for part in pointer.split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        path += f"[{part}]" if part.isdigit() else f"['{part}']"
    return F.get_json_object(document, path)


def snowflake_ids(df: DataFrame, ts: str, worker: str, datacenter: str, order: str, **kw) -> DataFrame:
    """64-bit ids: milliseconds, data centre, worker and a sequence within the millisecond.

    ``order`` breaks ties of ``ts`` and is unique per worker. A millisecond holds 4096 ids of one
    worker; the next one takes what is over. With slots numbered ms * 4096 + sequence, a row's
    slot is the larger of its own first slot and the slot after the row before it, which is a
    running maximum of (first slot - row number) plus the row number.
    """
    ms = F.unix_millis(F.col(ts).cast("timestamp")) - ID_EPOCH_MS
    rows = df.withColumn("_first", F.shiftleft(ms, SEQUENCE_BITS))
    keys = [datacenter, worker]
    rows = with_running(rows, keys, ["_first", order], _rn=RowNumber(), **kw)
    rows = rows.withColumn("_lead", F.col("_first") - F.col("_rn"))
    rows = with_running(rows, keys, ["_first", order], _max=RunningMax("_lead"), **kw)
    slot = F.col("_max") + F.col("_rn")
    place = F.shiftleft(F.col(datacenter).cast("bigint"), WORKER_BITS).bitwiseOR(F.col(worker).cast("bigint"))
    time = F.shiftleft(F.shiftright(slot, SEQUENCE_BITS), SEQUENCE_BITS + WORKER_BITS + DATACENTER_BITS)
    sequence = slot.bitwiseAND(F.lit((1 << SEQUENCE_BITS) - 1))
    return rows.select(*df.columns, time.bitwiseOR(F.shiftleft(place, SEQUENCE_BITS)).bitwiseOR(sequence).alias("id"))


def is_odd(x: Column) -> Column:
    return x.bitwiseAND(F.lit(1)) == 1


def negate_by_bits(x: Column) -> Column:
    return F.bitwise_not(x) + 1


def abs_by_bits(x: Column) -> Column:
    """Absolute value of a bigint from its sign bits."""
    sign = F.shiftright(x, 63)
    return x.bitwiseXOR(sign) - sign
