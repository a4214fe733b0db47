"""Who says what in transcript XML: speakers resolved to roles and companies by their ids, within the document's row.

Defined cases: XML that can't be parsed keeps its row, with error = 'yes', empty lists and null values otherwise; null XML
does too. Speakers whose id is no participant's are left out; blank paragraphs are dropped and white space in others is
one space; a participant without a title is no chief executive. Column names of the input are kept; those that are added
here replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "_id string, _product string, meta struct<title:string, date:string, companies:struct<company:array<string>>,"
    " participants:struct<participant:array<struct<_VALUE:string,_id:string,_type:string,_title:string,_affiliation:string,_affiliation_entity:string,_entity:string>>>>,"
    " body struct<section:array<struct<_name:string, speaker:array<struct<_id:string, plist:struct<p:array<string>>>>>>>"
)
#: What a chief executive's title holds, and the names of the two sections.
CEO_TITLES = ("ceo", "chief executive officer", "c.e.o")
DISCUSSION, QUESTIONS = "MANAGEMENT DISCUSSION SECTION", "Q&A"
ADDED = (
    "transcript_id", "status", "title", "call_date", "error", "corp_ids", "analyst_ids", "ceo_ids", "ceo_entities", "company_name", "company_id",
    "ceo_discussion", "exec_discussion", "analyst_questions", "ceo_answers", "exec_answers", "management", "answers", "qa",
)


def is_ceo(title: Column) -> Column:
    low = F.lower(F.coalesce(title, F.lit("")))
    return F.contains(low, F.lit(CEO_TITLES[0])) | F.contains(low, F.lit(CEO_TITLES[1])) | F.contains(low, F.lit(CEO_TITLES[2]))


def _fields(people: Column, field: str) -> Column:
    return F.transform(people, lambda p: p[field])


def _strings(column: Column) -> Column:
    return F.coalesce(column, F.array().cast("array<string>"))


def _said(section: str, ids: Column, but: Column | None = None) -> Column:
    """Paragraphs of the section's speakers that are among ``ids`` (and not among ``but``), in order."""
    of_section = F.filter("doc.body.section", lambda s: s["_name"] == section)
    speakers = F.flatten(F.transform(of_section, lambda s: F.coalesce(s["speaker"], F.array().cast("array<struct<_id:string,plist:struct<p:array<string>>>>"))))

    def wanted(k: Column) -> Column:
        among = F.array_contains(ids, F.coalesce(k["_id"], F.lit("")))
        return among if but is None else among & ~F.array_contains(but, k["_id"])

    texts = F.flatten(F.transform(F.filter(speakers, wanted), lambda k: _strings(k["plist"]["p"])))
    tidy = F.transform(texts, lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    return _strings(F.filter(tidy, lambda p: p != ""))


def parse_speakers(df: DataFrame, xml: str = "raw_xml", fallback_id: str | None = None) -> DataFrame:
    """``df`` with the columns ADDED: metadata, ids by role, and paragraphs by role and section.

    The company is that of the chief executives (``company_name`` joins their affiliations), or else the first one named;
    a transcript without id takes the column ``fallback_id``, where given. ``management``, ``answers`` and ``qa`` are the
    texts put together, chief executives first.
    """
    kept = [c for c in df.columns if c.lower() not in ADDED]
    row = df.select(F.struct(*kept).alias("row"), F.from_xml(F.col(xml), SCHEMA, {"rowTag": "transcript", "mode": "PERMISSIVE"}).alias("doc"), (F.col(fallback_id) if fallback_id else F.lit(None)).cast("string").alias("fallback"))
    people = F.col("doc.meta.participants.participant")
    row = row.withColumns({"corp": F.filter(people, lambda p: p["_type"] == "corprep"), "analysts": F.filter(people, lambda p: p["_type"] == "analyst")})
    row = row.withColumn("ceos", F.filter("corp", lambda p: is_ceo(p["_title"])))
    row = row.withColumns({"corp_ids": _strings(_fields("corp", "_id")), "analyst_ids": _strings(_fields("analysts", "_id")), "ceo_ids": _strings(_fields("ceos", "_id"))})
    row = row.withColumns(
        {
            "ceo_discussion": _said(DISCUSSION, F.array_intersect("corp_ids", "ceo_ids")),
            "exec_discussion": _said(DISCUSSION, F.col("corp_ids"), F.col("ceo_ids")),
            "analyst_questions": _said(QUESTIONS, F.col("analyst_ids")),
            "ceo_answers": _said(QUESTIONS, F.array_intersect("corp_ids", "ceo_ids")),
            "exec_answers": _said(QUESTIONS, F.col("corp_ids"), F.col("ceo_ids")),
        }
    )
    joined = lambda c: F.array_join(c, " ")
    answers = F.concat(joined("ceo_answers"), joined("exec_answers"))
    values = {
        "transcript_id": F.coalesce(F.nullif(F.col("doc._id"), F.lit("")), F.col("fallback")), "status": F.col("doc._product"),
        "title": F.col("doc.meta.title"), "call_date": F.col("doc.meta.date"), "error": F.when(F.col("doc.body").isNull(), "yes").otherwise("no"),
        "ceo_entities": _strings(_fields("ceos", "_entity")), "company_name": F.array_join(_strings(_fields("ceos", "_affiliation")), " "),
        "company_id": F.when(F.size("ceo_ids") > 0, F.get(_fields("ceos", "_affiliation_entity"), F.lit(0))).otherwise(F.get("doc.meta.companies.company", F.lit(0))),
        "management": F.concat(joined("ceo_discussion"), joined("exec_discussion")), "answers": answers, "qa": F.concat(joined("analyst_questions"), answers),
    }
    return row.select("row.*", *[values.get(c, F.col(c)).alias(c) for c in ADDED])


def corrected(df: DataFrame, status: str = "status") -> DataFrame:
    """Only transcripts whose status says that they are corrected."""
    return df.filter(F.contains(F.lower(status), F.lit("correct")))
