"""Rules as they are defined, worked out by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from loomtext.functions import lexicon as L
from loomtext.operators import models
from loomtext.operators import relational as R
from loomtext.sources import transcripts

XML = """<transcript id="" product="CorrectedTranscript"><meta><title>T</title><date>2020-01-01</date><companies><company>C1</company><company>C2</company></companies><participants>
 <participant id="1" type="corprep" title="President &amp; C.E.O." affiliation="Acme" affiliation_entity="E1" entity="U1">Ann</participant><participant id="2" type="corprep" affiliation="Acme">Bob</participant>
 <participant id="3" type="analyst" title="CEO of a fund">Cyd</participant></participants></meta><body><section name="MANAGEMENT DISCUSSION SECTION"><speaker id="1"><plist><p>One
   two.</p><p> </p></plist></speaker><speaker id="2"><plist><p>Three.</p></plist></speaker><speaker id="9"><plist><p>Lost.</p></plist></speaker><speaker id="3"><plist><p>Analyst here.</p></plist></speaker></section>
 <section name="Q&amp;A"><speaker id="3"><plist><p>Why?</p></plist></speaker><speaker id="1"><plist><p>So.</p></plist></speaker><speaker id="2"><plist><p>Also.</p></plist></speaker></section></body></transcript>"""


def test_speakers(spark):
    rows = spark.createDataFrame([(1, XML, "t1"), (2, "<broken", "t2"), (3, None, "t3"), (4, XML.replace("C.E.O.", "Chair"), "t4")], "doc int, raw_xml string, row string")
    out = {r.doc: r for r in transcripts.parse_speakers(rows, fallback_id="row").collect()}
    r = out[1]
    assert (r.ceo_ids, r.corp_ids, r.analyst_ids, r.ceo_entities, r.company_id, r.company_name) == (["1"], ["1", "2"], ["3"], ["U1"], "E1", "Acme")
    assert (r.ceo_discussion, r.exec_discussion, r.analyst_questions, r.ceo_answers, r.exec_answers) == (["One two."], ["Three."], ["Why?"], ["So."], ["Also."])
    assert (r.management, r.answers, r.qa, r.transcript_id, r.row, r.error) == ("One two.Three.", "So.Also.", "Why?So.Also.", "t1", "t1", "no")
    assert (out[4].ceo_ids, out[4].company_id, out[4].exec_discussion, out[4].company_name) == ([], "C1", ["One two.", "Three."], "")
    for k in (2, 3):
        assert (out[k].error, out[k].ceo_ids, out[k].qa, out[k].company_id) == ("yes", [], "", None)
    assert sorted(r.doc for r in transcripts.corrected(transcripts.parse_speakers(rows)).collect()) == [1, 4]


def test_fog_of_a_section(spark):
    text = "The andation was ereding 3 times. It is 1 a. b"
    # Sentences of 6, 4 and 1 raw words ("The ... times", "It is 1 a", "b"), 11 words in all, two of them complex.
    rows = spark.createDataFrame([(text,), ("word 1 2",), ("",), (None,)], "t string").select(*[c.alias(k) for k, c in L.fog_of_section(F.col("t")).items()]).collect()
    assert rows[0].n_words == 11 and rows[0].n_complex == 2 and math.isclose(rows[0].words_a_sentence, 11 / 3)
    assert math.isclose(rows[0].fog, 0.4 * (11 / 3 + 100 * 2 / 11))
    assert all(tuple(r) == (None,) * 4 for r in rows[1:])


def test_flags(spark):
    rows = spark.createDataFrame([("a rise in sales", ["a", "rise", "in", "sales"]), ("no rise", ["no", "rise"]), ("sales in", ["sales", "in"]), ("up-beat", ["up", "beat"]), ("", [])], "low string, w array<string>")
    got = rows.select(L.match_flag(F.col("low"), F.col("w"), ["rise"], ["sales in"], ["p-b"], ["no "])).collect()
    assert [r[0] for r in got] == [True, False, True, True, False]


class Fails(models.StubScorer):
    calls = 0

    def score(self, texts, labels):
        if any(t.endswith("13") for t in texts):
            raise ValueError("thirteen")
        return super().score(texts, labels)


class FailsToLoad:
    def __init__(self):
        raise RuntimeError("no model")


def test_failures_stand_alone(spark):
    texts = [f"text {i}" for i in range(1000)]
    df = spark.createDataFrame([(i, t, "up") for i, t in enumerate(texts)], "k long, text string, label string")
    want = models.StubScorer().score(texts, ["up"] * 1000)
    for r in models.score_or_error(df, Fails).collect():
        assert (r.score, r.error) == ((None, "ValueError: thirteen") if r.text.endswith("13") else (want[r.k], None))
    with pytest.raises(Exception, match="no model"):
        models.score_or_error(df, FailsToLoad).collect()
    lists = spark.createDataFrame([(1, ["a", "b 13"]), (2, ["a"]), (3, []), (4, None)], "k long, texts array<string>")
    got = {r.k: (r.scores, r.error) for r in models.score_lists_or_empty(lists, "k", "texts", "up", Fails).collect()}
    assert got == {1: ([], "ValueError: thirteen"), 2: (models.StubScorer().score(["a"], ["up"]), None), 3: ([], None), 4: ([], None)}


def test_summary(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (None, None)], "a double, b double")
    a, b = R.summary(df, ["a", "b"]).collect()
    assert (a["name"], a.n, a.lowest, a.q25, a.q50, a.q75, a.highest) == ("a", 3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert math.isclose(a["mean"], 7 / 3) and math.isclose(a["std"], math.sqrt(7 / 3))
    assert tuple(b) == ("b", 0, *[None] * 7)
