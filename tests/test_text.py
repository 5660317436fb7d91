"""Text expressions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from postloom.functions import dates, numbers, text, vectors
from postloom.operators import keywords as kw
from postloom.plans import weekly

CLEANED = [
    (None, ""),
    ("", ""),
    ("see https://a.b/c?d=1 now", "see now"),
    ("go to www.example.com today", "go to today"),
    ("R&amp;D &lt;b&gt; x&#x200B;y", "R&D <b> xy"),
    ("**bold** and *italic* and ~~gone~~", "bold and italic and gone"),
    ("&gt; quoted\n> again\nplain", "quoted again plain"),
    ("a [name](target) b", "a name b"),
    # The URL step comes first and takes the closing bracket along.
    ("a [name](https://x.y) b", "a [name]( b"),
    ("[Removed] rest [DELETED]", "rest"),
    ("  many\t  spaces \n", "many spaces"),
    ("**two\nlines**", "**two lines**"),
]


@pytest.mark.parametrize("raw,want", CLEANED)
def test_clean_text(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.clean_text(F.col("t"))).first()[0] == want


def test_title_and_body(spark):
    rows = [(" T ", " body "), ("T", "[Removed]"), ("T", None), (None, "b"), ("T", "  ")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(text.combine_title_body(F.col("a"), F.col("b"))).collect()]
    assert got == ["T body", "T", "T", " b", "T"]


def test_tokens(spark):
    df = spark.createDataFrame([("The Größe of http://x @you #tag wwwhat cats' naïve word2 about cats CATS",)], "t string")
    assert df.select(text.keyword_tokens(F.col("t"), ["about"])).first()[0] == ["größe", "naïve", "cats", "cats"]
    terms = df.select(text.term_tokens(F.lit("A big-red fox_1, the end"), ["the"])).first()[0]
    assert terms == ["big", "red", "fox_1", "end"]
    grams = df.select(text.ngrams(F.array(*[F.lit(w) for w in "abc"]), 2, 3)).first()[0]
    assert grams == ["a b", "b c", "a b c"]
    assert df.select(text.ngrams(F.array(F.lit("a")), 2, 3)).first()[0] == []


def test_sentiment_and_labels(spark):
    df = spark.createDataFrame([("Urban life",), ("A fine day",)], "t string")
    assert [r[0] for r in df.select(text.is_critical(F.col("t"))).collect()] == [True, False]
    assert [r[0] for r in df.select(text.is_critical(F.col("t"), whole_words=True)).collect()] == [False, False]
    one = spark.range(1)
    got = one.select(
        text.sentiment_label(F.lit(0.51)), text.sentiment_label(F.lit(0.5)), text.sentiment_label(F.lit(0.19)),
        text.niche_title(F.lit("worldnews")), text.niche_title(F.lit("pc-games")), text.niche_title(F.lit("my.wORLD")),
    ).first()
    assert list(got) == [
        "mostly negative/critical", "mixed sentiment", "mostly positive/excited", "World News", "Pc Games", "My.WORLD",
    ]


def test_dates_and_numbers(spark):
    ts = F.lit("2027-01-01 10:00:00").cast("timestamp_ntz")
    got = spark.range(1).select(
        dates.iso_year(ts), dates.iso_week(ts), dates.row_label(ts), numbers.to_number(F.lit("x")), numbers.to_number(F.lit("2.5")),
        numbers.percent_text(F.lit(0.256)), numbers.fixed(F.lit(2.345), 2), dates.stamp_text(dates.from_epoch(F.lit(0))),
        vectors.parse_vector(F.lit("[1, 2.5]")), vectors.parse_vector(F.lit("oops")),
    ).first()
    assert list(got) == [2026, 53, "Week 53 (Jan 01 – Jan 03, 2027)", 0.0, 2.5, "26%", "2.35", "1970-01-01 00:00:00", [1.0, 2.5], None]


def test_phrases_and_entities(spark):
    rows = [("a", 1, "Big Red Fox runs"), ("a", 2, "big red fox sleeps"), ("a", 3, "The Fox Company and Al"), ("b", 1, "Big Red Fox")]
    df = spark.createDataFrame(rows, "g string, id int, title string")
    got = kw.recurring_phrases(df, ["g"], "title", "id", 10, ["the", "and"]).collect()
    assert [(r.phrase, r.uses, r.titles) for r in got] == [("big red", 2, 2), ("big red fox", 2, 2), ("red fox", 2, 2)]
    names = kw.entity_counts(df, ["g"], "title").collect()
    assert {(r.g, r["name"]) for r in names} == {("a", "Big Red Fox"), ("a", "The Fox Company"), ("b", "Big Red Fox")}


def test_replies(spark):
    good = '{"niche": "n", "trends": [{"rank": 1, "title": "T", "description": "D"}]}'
    rows = [(0, good), (1, f"```json\n{good}\n```"), (2, good[:30]), (3, ""), (4, None), (5, '{"niche": "n"}')]
    got = spark.createDataFrame(rows, "i int, r string").select("i", weekly.parsed_trends(F.col("r")).alias("t")).orderBy("i").collect()
    assert [None if r.t is None else len(r.t) for r in got] == [1, 1, None, None, None, 0]
    trend = got[0].t[0]
    assert trend.sentiment == "mixed" and trend.importance == "" and trend.references == []
    assert trend.key_entities.companies == [] and trend.title == "T"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_and_phrases_are_not_dealt_by_document(spark):
    """Texts are dealt by their id; terms and phrases, many times as much, are only dealt once they are counted for all documents."""
    from postloom.operators import keywords as kw

    rows = [(i, i % 2, "Red apples taste good with red wine") for i in range(6)] + [(5, 1, "red apples again"), (None, 0, "Red apples taste")]
    df = spark.createDataFrame(rows, "doc_id long, cluster int, text string")
    phrases = kw.recurring_phrases(df, ["cluster"], "text", "doc_id", 100, [])
    weights = kw.tfidf(df, "doc_id", "text", min_df=1, max_df=1.0, stop_words=[])
    counts = kw._term_counts(df, ["doc_id"], "doc_id", "text", 2, [])
    for plan, name in ((_plan(phrases), "phrase"), (_plan(counts), "term")):
        assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "doc_id" in line and name in line.split("hashpartitioning")[1]]
    found = {(r["cluster"], r["phrase"]): (r["uses"], r["titles"]) for r in phrases.collect()}
    assert found[0, "red apples"] == (4, 4) and found[1, "red apples"] == (4, 3)
    lengths = weights.groupBy("doc_id").agg({"weight": "max", "term": "count"}).collect()
    assert len(lengths) == 7


def test_texts_of_posts_join_last(spark, tmp_path):
    """No join but that with the documents moves texts."""
    import datetime

    from postloom.sources import fixtures as fx

    now = datetime.datetime(2024, 1, 3)
    tables = {
        "events": ([(i, now, i, "view", 1.0, '{"k": 2}') for i in range(8)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "documents": ([(i, f"title {i}\nbody", "en", "s", 9) for i in (0, 1, 1, 2)], "doc_id long, text string, lang string, source string, n_chars long"),
        "embeddings": ([(i, [1.0, float(i)], i % 2) for i in range(4)], "vec_id long, embedding array<float>, label int"),
        "labels": ([(1, 3, 0)], "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    posts = fx.clustered_posts(spark, str(tmp_path), with_text=True)
    joins = [line for line in posts._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert "doc_id" in joins[0] and "Inner" in joins[0] and any("vec_id" in j for j in joins[1:])
    assert posts.count() == 8  # ids 0-3 of documents: 3 has none, 1 has two rows


def test_text_vectors_do_not_shuffle_common_terms(spark, monkeypatch):
    """Whichever terms are broadcast, the vectors are the same: ids come twice, a text is missing. No shuffle deals the terms of a document."""
    import numpy as np
    from postloom.operators import reduction

    rows = [(i % 20, f"alpha beta word{i % 3} gamma word{i} alpha") for i in range(30)] + [(99, None), (98, "the of")]
    df = spark.createDataFrame(rows, "id bigint, t string").repartition(3)
    found = []
    for terms in (1, 5, 100_000):
        monkeypatch.setattr(reduction, "COMMON_TERMS", terms)
        out = reduction.hashed_vectors(df, "id", "t", 16)
        assert "hashpartitioning(id#" in (plan := out._jdf.queryExecution().executedPlan().toString())
        assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(id" in line and ", term#" in line]
        found.append(sorted((r["id"], [round(x, 6) for x in r["embedding"]]) for r in out.collect()))
    assert len(found[0]) == 32 and all(np.allclose([v for _, v in f], [v for _, v in found[0]], atol=1e-5) for f in found)
