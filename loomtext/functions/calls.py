"""Plain-text calls: speakers, their turns, and questions with their answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A speaker's line: a name of capitalised words, a colon, the text up to the next such line.
TURN = r"(?ms)^([A-Z][\w.'-]*(?: [A-Z][\w.'-]*){0,4}):[ \t]*(.*?)(?=^[A-Z][\w.'-]*(?: [A-Z][\w.'-]*){0,4}:|\z)"


def turns(text: Column) -> Column:
    """Array of (speaker, said) in order."""
    names, said = F.regexp_extract_all(text, F.lit(TURN), 1), F.regexp_extract_all(text, F.lit(TURN), 2)
    return F.zip_with(names, said, lambda n, s: F.struct(n.alias("speaker"), F.trim(F.regexp_replace(s, r"\s+", " ")).alias("said")))


def participants(text: Column) -> Column:
    return F.array_distinct(F.transform(turns(text), lambda t: t["speaker"]))


def questions_and_answers(all_turns: Column, analysts: Column) -> Column:
    """Array of (question, answer): a question is what an analyst says, its answer what others say until the next one."""
    start = F.struct(F.array().cast("array<struct<question:string,answer:string>>").alias("done"), F.lit(None).cast("string").alias("question"), F.lit("").alias("answer"))

    def close(a: Column) -> Column:
        pair = F.struct(a["question"].alias("question"), F.trim(a["answer"]).alias("answer"))
        return F.when(a["question"].isNotNull() & (a["answer"] != ""), F.array_append(a["done"], pair)).otherwise(a["done"])

    def step(a: Column, t: Column) -> Column:
        asks = F.array_contains(analysts, t["speaker"])
        fresh = asks & ((a["answer"] != "") | a["question"].isNull())
        question = F.when(fresh, t["said"]).when(asks, F.concat(a["question"], F.lit(" "), t["said"])).otherwise(a["question"])
        answer = F.when(asks, F.lit("")).when(a["question"].isNotNull(), F.concat(a["answer"], F.lit(" "), t["said"])).otherwise(a["answer"])
        return F.struct(F.when(fresh, close(a)).otherwise(a["done"]).alias("done"), question.alias("question"), answer.alias("answer"))

    return F.aggregate(all_turns, start, step, close)


def joined_bigrams(words: Column, bigrams: Column) -> Column:
    """Words with every pair that is among ``bigrams`` (a_b) put together, from the left."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("open"))

    def step(a: Column, w: Column) -> Column:
        pair = F.concat(F.try_element_at(a["out"], F.lit(-1)), F.lit("_"), w)
        joins = a["open"] & F.coalesce(F.array_contains(bigrams, pair), F.lit(False))
        before = F.slice(a["out"], F.lit(1), F.greatest(F.size(a["out"]) - 1, F.lit(0)))
        return F.struct(F.when(joins, F.array_append(before, pair)).otherwise(F.array_append(a["out"], w)).alias("out"), (~joins).alias("open"))

    return F.aggregate(words, start, step, lambda a: a["out"])
