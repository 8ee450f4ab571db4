"""Form answers: arrays of typed answers and the JSON documents made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE = "struct<value:string,id:int,email:string,otherInfo:string,ordinal:int>"
CELL = f"struct<queId:int,queTitle:string,queType:int,values:array<{VALUE}>>"
ANSWER = f"struct<queId:int,queTitle:string,queType:int,values:array<{VALUE}>,tableValues:array<array<{CELL}>>>"

# Field types by the shape of their value.
ONE_TEXT = (1, 2, 3, 4, 6, 7, 9, 10, 11, 16, 19)
MANY_TEXTS = (12, 13, 15, 21)
MEMBER, NUMBER, PERIOD, TABLE, DEPARTMENT = 5, 8, 14, 18, 22


def json_text(text: Column) -> Column:
    """A text as a JSON string; the JSON writer is used only where something must be escaped."""
    quoted = F.to_json(F.array(text))
    escaped = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    return F.when(text.rlike(r'["\\\x00-\x1f]'), escaped).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def _list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _object(pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _nullable(text: Column) -> Column:
    return F.coalesce(json_text(text), F.lit("null"))


def _number(text: Column) -> Column:
    """A whole number, else a decimal, else null when empty, else the text itself."""
    whole = text.try_cast("bigint")
    return (
        F.when(text == "", "null")
        .when(whole.isNotNull() & text.rlike("^[+-]?[0-9]+$"), whole.cast("string"))
        .when(text.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), text)
        .otherwise(json_text(text))
    )


def _cell_value(a: Column) -> Column:
    values, kind = a["values"], a["queType"]
    first = F.get(values, F.lit(0))["value"]
    texts = F.transform(values, lambda v: json_text(v["value"]))
    members = F.transform(
        values,
        lambda v: F.concat(
            F.lit('{"uid":'), v["id"], F.lit(',"name":'), _nullable(v["value"]), F.lit(',"email":'), _nullable(v["email"]),
            F.lit(',"head":'), _nullable(v["otherInfo"]), F.lit("}"),
        ),
    )
    departments = F.transform(
        values, lambda v: F.concat(F.lit('{"id":'), v["id"], F.lit(',"name":'), _nullable(v["value"]), F.lit("}"))
    )
    period = F.transform(F.split(F.regexp_replace(first, "~+$", ""), "~"), json_text)
    return (
        F.when(kind.isin(*ONE_TEXT), json_text(first))
        .when(kind.isin(*MANY_TEXTS), _list(texts))
        .when(kind == NUMBER, _number(first))
        .when(kind == MEMBER, _list(members))
        .when(kind == DEPARTMENT, _list(departments))
        .when(kind == PERIOD, _list(period))
    )


def _pairs(answers: Column, value) -> Column:
    return F.transform(answers, lambda a: F.concat(json_text(a["queTitle"]), F.lit(":"), _required(value(a), a["queType"])))


def _required(value: Column, kind: Column) -> Column:
    problem = F.concat(F.lit("no value for an answer of type "), F.coalesce(kind.cast("string"), F.lit("null")))
    return F.coalesce(value, F.raise_error(problem).cast("string"))


def form_answer_to_value(answers: Column) -> Column:
    """JSON array of typed answers to one JSON object keyed by title. An unknown type, or a type
    that needs a value and has none, is an error; a null document stays null."""
    parsed = parse_answers(answers)

    def value(a: Column) -> Column:
        rows = F.transform(a["tableValues"], lambda row: _object(_pairs(row, _cell_value)))
        return F.when(a["queType"] == TABLE, _list(rows)).otherwise(_cell_value(a))

    return _object(_pairs(parsed, value))


def form_row_to_answers(
    df: DataFrame, form: Sequence[tuple[int, str, int]], keys: Sequence[str], members: DataFrame | None = None
) -> DataFrame:
    """Table rows to answers: ``[{queId, values: [{value}]}]`` of the non-null fields of the form.

    ``form``: (queId, title, type), the title naming the column; field 0 is the entry's own number
    and left out. A member field looks its id up in ``members`` (name, id); an unknown name gives
    no answer. Tables and many-valued types are an error. The row is shaped in place.
    """
    answers = []
    for que_id, title, kind in form:
        if que_id == 0:
            continue
        if kind == TABLE or kind in MANY_TEXTS:
            raise ValueError(f"field {title} of type {kind} cannot be filled from one column")
        text = F.col(title).cast("string")
        member = F.lit(None).cast("bigint")
        present = text.isNotNull()
        if kind == MEMBER:
            if members is None:
                raise ValueError(f"field {title} needs the members table")
            found = members.select(F.col("name").alias(f"_{title}"), F.col("id").cast("bigint").alias(f"_id_{title}"))
            df = df.join(found, text == F.col(f"_{title}"), "left")
            member = F.col(f"_id_{title}")
            present = present & member.isNotNull()
        value = F.struct(member.alias("id"), text.alias("value"))
        answers.append(F.when(present, F.struct(F.lit(que_id).alias("queId"), F.array(value).alias("values"))))
    filled = F.filter(F.array(*answers), lambda a: a.isNotNull())
    return df.select(*keys, F.to_json(filled).alias("answers"))


def form_mix_definition(answers: DataFrame, form: DataFrame) -> DataFrame:
    """Answers (one row each, with queId) joined with their field definitions, sub-fields included.

    ``form``: queId, queTitle, queType, subQuestionBaseInfos (array of the same three).
    """
    top = form.select("queId", "queTitle", "queType")
    sub = form.select(F.inline("subQuestionBaseInfos")).select("queId", "queTitle", "queType")
    return answers.join(top.unionAll(sub), "queId", "left")


def parse_answers(answers: Column) -> Column:
    """JSON array of answers as an array column."""
    return F.from_json(answers, f"array<{ANSWER}>")


def answer_get_by_title(answers: Column, title: str, kind: str = "string") -> Column:
    """First value of the first answer with this title that is not the entry's own number (id 0).

    ``answers``: as ``parse_answers`` gives them, so that several titles share one parse.
    ``kind``: string, long or timestamp. No such answer is an error.
    """
    named = F.filter(answers, lambda a: (a["queTitle"] == title) & ~F.coalesce(a["queId"] == 0, F.lit(False)))
    first = F.get(F.get(named, F.lit(0))["values"], F.lit(0))["value"]
    typed = {
        "string": first,
        "long": first.try_cast("bigint"),
        "timestamp": F.try_to_timestamp(first, F.lit("yyyy-MM-dd HH:mm:ss")),
    }[kind]
    missing = F.raise_error(F.lit(f"no answer titled {title}"))
    return F.when(F.size(named) > 0, typed).otherwise(missing.cast({"string": "string", "long": "bigint"}.get(kind, kind)))
