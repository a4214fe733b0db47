"""Numeric goldens and defined cases of functions and operators."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from loomtext.functions import scores as C
from loomtext.functions import text as X
from loomtext.operators import relational as R
from loomtext.operators import timeseries as S
from loomtext.operators import topics
from loomtext.operators.models import StubScorer, score_pairs, udf_of
from loomtext.sources import io


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first().asDict()


def ints(*v):
    return F.array(*[F.lit(x) for x in v]) if v else F.array().cast("array<int>")


def test_sentence_scores(spark):
    r = one(
        spark, w=C.sentence_score(ints(1, 2), ints(1, 2)), u=C.sentence_score(ints(1, 2), ints(1, 2), False), e=C.sentence_score(ints(), ints()),
        x=C.sentence_score(ints(1), ints(1, 1)), n=C.net_score(ints(1, 2), ints(1, 2)), nx=C.net_score(ints(1), ints(1, 1)),
    )
    assert r == {"w": 2.5, "u": 1.5, "e": None, "x": None, "n": 3.0, "nx": None}


def test_merged_counts(spark):
    m = lambda **k: F.create_map(*[F.lit(x) for kv in k.items() for x in kv])
    r = one(spark, z=C.merged_counts(F.array(m(a=0), m(a=0))), s=C.merged_counts(F.array(m(revenue=0), m(revenue=1))), e=C.merged_counts(F.array().cast("array<map<string,int>>")))
    assert r == {"z": {"NO_MATCH": 1}, "s": {"revenue": 1}, "e": {"NO_MATCH": 1}}


def test_duplicates(spark):
    abab = F.array(*[F.lit(x) for x in "abab"])
    r = one(spark, p=X.duplicate_percent(abab), z=X.duplicate_percent(F.array().cast("array<string>")), n=F.size(X.distinct_if_many(abab)))
    assert r == {"p": 50.0, "z": 0.0, "n": 2}


def test_text_rules(spark):
    r = one(
        spark, a=X.is_operator_turn(F.lit("operator, next question please")), b=X.is_operator_turn(F.lit("we grew a lot")), g=X.kept_sentence(F.lit("Good morning to you all and welcome")),
        k=X.kept_sentence(F.lit("Thank you Bea we grew by a lot"), legacy=True), t=X.kept_sentence(F.lit("Thank you Bea we grew by a lot")), c=X.any_contains(F.lit("The CEO spoke"), X.CEO_TITLES), n=X.any_contains(F.lit(None).cast("string"), X.CEO_TITLES),
        d=X.dollar_count(F.lit("$5 and $ 6")), m=X.number_count(F.lit("$5.2 and 7")), q=X.no_questions(F.array(F.lit("a?"), F.lit("b.")), ints(1, 2))[1], f=X.ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 2),
        x=X.expand_contractions(F.lit("don’t go"), {"don't": "do not"}), p=X.parse_list(F.lit("['a','b']")), bad=X.parse_list(F.lit("nonsense")), j=X.joined(F.array(F.lit(" "), F.lit(""))),
    )
    assert r == {"a": 1, "b": 0, "g": None, "k": " Bea we grew by a lot", "t": "Bea we grew by a lot", "c": 1, "n": 0, "d": 1, "m": 2, "q": [2], "f": ["a b", "b c"], "x": "do not go", "p": ["a", "b"], "bad": [], "j": None}


def test_argmax_tie_order(spark):
    half = F.array(F.lit(0.5))
    r = one(spark, a=C.argmax_label(half, half, half), b=C.argmax_label(half, half, half, ("neu", "pos", "neg")), e=C.argmax_label(F.array().cast("array<double>"), half, half))
    assert r == {"a": [1], "b": [0], "e": []}


def test_merge_twice_changes_nothing(spark):
    h = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    n = spark.createDataFrame([(2, "c"), (3, "d"), (None, "e")], "id int, v string")
    once = R.merge_insert(h, n, ["id"])
    assert sorted(once.collect(), key=repr) == sorted([(1, "a"), (2, "b"), (3, "d"), (None, "e")], key=repr)
    assert R.merge_insert(once, n.filter("id is not null"), ["id"]).count() == 4


def test_validity_equals_day_by_day(spark):
    rows = [(e, date(2020, 1, 1 + (e * 7 + k * 3) % 27), e * 10 + k) for e in range(5) for k in range(4)]
    df = spark.createDataFrame(rows, "entity int, day date, version int")
    lo, hi = date(2020, 1, 5), date(2020, 2, 5)
    got = {(r.series_day, r.entity): r.version for r in S.valid_days(df, "entity", "day", "version", 10, F.lit(lo), F.lit(hi)).collect()}
    want = {}
    for n in range((hi - lo).days + 1):
        d = date.fromordinal(lo.toordinal() + n)
        for e in range(5):
            seen = [(x[1], x[2]) for x in rows if x[0] == e and 0 <= (d - x[1]).days < 10]
            if seen:
                want[d, e] = max(seen)[1]
    assert got == want


def test_pipeline_of_columns(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    assert R.transformed(df, [("n", "t", lambda c: F.size(F.split(c, " ")))]).first().n == 2
    with pytest.raises(ValueError):
        R.transformed(df, [("n", "missing", F.upper)])
    assert R.transformed(df, [("n", "missing", F.upper)], missing="skip").columns == ["t"]
    with pytest.raises(KeyError):
        R.parsed_times(df, {"x": "yyyy"})
    with pytest.raises(ValueError):
        R.parsed_times(df, {})


def test_unknown_statistics(spark):
    with pytest.raises(ValueError):
        topics.topic_report(None, None, stats=("median",))


def test_sources(spark, tmp_path):
    (tmp_path / "lex").write_text("Alpha\n\n beta \nalpha\n")
    assert sorted(r.word for r in io.read_lexicon(spark, str(tmp_path / "lex")).collect()) == ["alpha", "beta"]
    (tmp_path / "syl").write_text("word 2\nbroken\nother x\n")
    assert [tuple(r) for r in io.read_counts(spark, str(tmp_path / "syl")).collect()] == [("word", 2)]
    with pytest.raises(ValueError):
        io.write_table(spark.range(1), str(tmp_path / "x.doc"))
    with pytest.raises(ValueError):
        io.fill_template("select {a} from {b}", a=1)
    io.write_table(spark.range(3), str(tmp_path / "x.csv"), mode="overwrite")
    assert io.read_csv(spark, str(tmp_path / "x.csv"), "id long").count() == 3
    import pandas as pd

    df = io.pandas_to_spark(spark, pd.DataFrame({"a": [1, 2], "b_list": [["x"], []], "c": [1.5, None]}), {"list": "arr[str]"})
    assert dict(df.dtypes) == {"a": "bigint", "b_list": "array<string>", "c": "double"} and df.filter("c is null").count() == 1


def test_transcripts(spark):
    xml = """<transcript id="1" product="p"><meta><title>T</title><date>2020-01-01</date></meta><body><section name="MANAGEMENT DISCUSSION SECTION">
      <speaker id="1"><plist><p>One.</p><p>Two.</p></plist></speaker></section><section name="Q&amp;A"><speaker id="2"><plist><p>Why?</p></plist></speaker></section></body></transcript>"""
    rows = io.parse_transcripts(spark.createDataFrame([(1, xml), (2, "<broken")], "id int, raw_xml string")).orderBy("id").collect()
    assert (rows[0].title, rows[0].management, rows[0].questions, rows[0].error) == ("T", ["One.", "Two."], ["Why?"], "no")
    assert (rows[1].management, rows[1].error) == ([], "yes")


def test_models(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x")], "text string, label string")
    assert [r.score for r in score_pairs(df).orderBy("text").collect()] == StubScorer().score(["a", "b"], ["x", "x"])
    with pytest.raises(ValueError):
        udf_of(len, "complex")


def test_streams(spark, tmp_path):
    from loomtext.streaming import jobs

    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    for _ in range(2):
        e = jobs.stream_table(spark, "/root/testdata/sf0.001", "events.parquet", schema).select("event_id", "user_id")
        jobs.append_new(e, str(tmp_path / "out"), ["event_id"], str(tmp_path / f"state{_}")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("event_id").distinct().count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_files_that_a_strict_reader_refuses(spark, tmp_path):
    from loomtext.sources import io

    (tmp_path / "counts.txt").write_text("Alpha 3\nbeta 4\n")
    (tmp_path / "broken.txt").write_text("Alpha 3\nno count here\n")
    rows = lambda name, **kw: sorted(tuple(r) for r in io.read_counts(spark, f"{tmp_path}/{name}", **kw).collect())
    assert rows("counts.txt", strict=True) == rows("counts.txt") == [("alpha", 3), ("beta", 4)]
    assert rows("broken.txt") == [("alpha", 3)]
    with pytest.raises(Exception, match="malformed line"):
        rows("broken.txt", strict=True)


def test_a_bucketed_join_has_no_exchange(spark, tmp_path):
    from loomtext.sources import io

    for name in ("left_side", "right_side"):
        io.write_bucketed(spark.range(100).withColumnRenamed("id", f"{name}_id"), name, 4, f"{name}_id", path=f"{tmp_path}/{name}")
    j = spark.table("left_side").join(spark.table("right_side").hint("merge"), F.col("left_side_id") == F.col("right_side_id"))
    assert j.count() == 100
    assert "Exchange" not in j._jdf.queryExecution().sparkPlan().toString()
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    for name in ("left_side", "right_side"):
        spark.sql(f"drop table {name}")


def test_merged_counts_of_nothing(spark):
    from loomtext.functions import scores

    none = F.array().cast("array<map<string,int>>")
    maps = F.array(F.create_map(F.lit("a"), F.lit(0)), F.create_map(F.lit("a"), F.lit(0)))
    r = spark.range(1).select(scores.merged_counts_with_zeros(none).alias("e"), scores.merged_counts_with_zeros(maps).alias("z"), scores.merged_counts(maps).alias("n")).first()
    assert (r.e, r.z, r.n) == ({"ERROR": 1}, {"a": 0}, {"NO_MATCH": 1})


def test_ranks_of_many_values_and_of_ties(spark, monkeypatch):
    from loomtext.operators import evaluate

    monkeypatch.setattr(evaluate, "RANGE_ROWS", 60)
    values = [float(k % 7) for k in range(50)] + [100.0 + k for k in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.r for r in evaluate.average_ranks(df, "v", "r").collect()}
    ordered = sorted(values)
    assert got == {v: (ordered.index(v) + 1 + len(ordered) - ordered[::-1].index(v)) / 2 for v in set(values)}
    assert evaluate.average_ranks(df.limit(0), "v", "r").count() == 0
