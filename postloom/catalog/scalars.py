"""Projections, scalar functions and filters (survey groups B and C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import dates, numbers, text, vectors
from ..functions.stopwords import default_stop_words
from ..operators import aggregates as agg
from ..session import scratch_path
from ..sources import files, fixtures as fx, schemas
from . import _sql as S
from . import query
from ._frames import stamp, vector_text

_STOP = default_stop_words()
_STOP_SQL = S.word_list(_STOP)
_SPACE = text.SPACE


@query("b1_record_defaults", S.with_(S.POSTS) + """
SELECT post_id, CASE WHEN author = '0' THEN '[deleted]' ELSE author END AS author,
  CASE WHEN num_comments % 2 = 0 THEN 'https://example.com/' || post_id ELSE '' END AS url,
  CASE WHEN num_comments % 3 = 0 THEN 'Body of ' || post_id ELSE '' END AS selftext, num_comments % 4 = 0 AS is_video, upvote_ratio
FROM posts""")
def record_defaults(spark, sf):
    """Records of listing pages in which author, link, body and video flag may be missing."""
    n = F.col("num_comments")
    record = F.struct(
        F.col("post_id").alias("id"),
        F.when(F.col("author") != "0", F.col("author")).alias("author"),
        F.when(n % 2 == 0, F.concat(F.lit("https://example.com/"), "post_id")).alias("url"),
        F.when(n % 3 == 0, F.concat(F.lit("Body of "), "post_id")).alias("selftext"),
        F.when(n % 4 == 0, F.lit(True)).alias("is_video"),
        "upvote_ratio",
    )
    page = F.struct(F.lit(None).cast("string").alias("after"), F.array(F.struct(record.alias("data"))).alias("children"))
    path = scratch_path(spark, "records")
    files.write_json_rows(fx.posts(spark, sf).select(F.lit("new").alias("listing"), page.alias("data")), path, ["listing"])
    pages = spark.read.schema(schemas.LISTING_PAGE + ", listing string").json(path)
    return files.posts_of_pages(pages, "listing").select("post_id", "author", "url", "selftext", "is_video", "upvote_ratio")


@query("b2_epoch_time", f"""
SELECT event_id, {S.stamp("make_timestamp(CAST(epoch_us(ts) // 1000000 * 1000000 AS BIGINT))")} AS timestamp_utc FROM events""")
def epoch_time(spark, sf):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return fx.table(spark, sf, "events").select(
        "event_id", dates.stamp_text(dates.from_epoch(seconds)).alias("timestamp_utc")
    )


@query("b3_links", S.with_(S.POSTS) + """
SELECT post_id, 'https://reddit.com/r/' || niche || '/' || post_id AS permalink, 'r/' || niche AS tag FROM posts""")
def links(spark, sf):
    path = F.concat(F.lit("/r/"), "niche", F.lit("/"), "post_id")
    return fx.posts(spark, sf, with_ratio=False).select(
        "post_id", text.absolute_link(path).alias("permalink"), text.niche_tag(F.col("niche")).alias("tag")
    )


@query("b4_best_text", S.with_(S.POSTS) + "SELECT post_id, md5(coalesce(text_translated, full_text)) AS body FROM posts")
def best_text(spark, sf):
    posts = fx.posts(spark, sf, with_text=True, with_ratio=False)
    return posts.select("post_id", F.md5(text.best_text(F.col("text_translated"), F.col("full_text"))).alias("body"))


@query("b5_numbers", S.with_(S.POSTS) + """
SELECT post_id, coalesce(try_cast(niche AS DOUBLE), 0) AS not_a_number, coalesce(try_cast(author AS DOUBLE), 0) AS text_number,
  coalesce(CAST(num_comments AS DOUBLE), 0) AS num_comments, coalesce(upvote_ratio, 0) AS upvote_ratio FROM posts""")
def number_cleanup(spark, sf):
    return fx.posts(spark, sf).select(
        "post_id", numbers.to_number(F.col("niche")).alias("not_a_number"),
        numbers.to_number(F.col("author")).alias("text_number"),
        numbers.to_number(F.col("num_comments")).alias("num_comments"),
        numbers.to_number(F.col("upvote_ratio")).alias("upvote_ratio"),
    )


@query("b6_filled_text", S.with_(S.POSTS) + """
SELECT post_id, md5(coalesce(text_translated, '')) AS text_translated, coalesce(title, '') AS title FROM posts""")
def filled_text(spark, sf):
    posts = fx.posts(spark, sf, with_text=True, with_ratio=False)
    return posts.select(
        "post_id", F.md5(F.coalesce("text_translated", F.lit(""))).alias("text_translated"),
        F.coalesce("title", F.lit("")).alias("title"),
    )


@query("b7_parsed_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed, CAST(dayofyear(ts) AS INTEGER) AS day FROM events")
def parsed_time(spark, sf):
    as_text = dates.stamp_text(F.col("ts"))
    parsed = F.to_timestamp_ntz(as_text, F.lit("yyyy-MM-dd HH:mm:ss"))
    return fx.table(spark, sf, "events").select(
        "event_id", dates.stamp_text(parsed).alias("parsed"), F.dayofyear(parsed).alias("day")
    )


@query("b8_iso_weeks", """
SELECT event_id, CAST(isoyear(ts) AS INTEGER) AS week_year, CAST(week(ts) AS INTEGER) AS week_number,
  CAST(isoyear(ts - INTERVAL 5 DAY) AS INTEGER) AS earlier_year, CAST(week(ts - INTERVAL 5 DAY) AS INTEGER) AS earlier_week FROM events""")
def iso_weeks(spark, sf):
    ts, earlier = F.col("ts"), F.col("ts") - F.expr("INTERVAL 5 DAY")
    return fx.table(spark, sf, "events").select(
        "event_id", dates.iso_year(ts).alias("week_year"), dates.iso_week(ts).alias("week_number"),
        dates.iso_year(earlier).alias("earlier_year"), dates.iso_week(earlier).alias("earlier_week"),
    )


@query("b9_slice_labels", S.with_(S.CLEAN) + """
SELECT niche, week_year, week_number,
  strftime(min(timestamp_utc), '%b %d') || ' – ' || strftime(max(timestamp_utc), '%b %d, %Y') AS week_label
FROM clean GROUP BY niche, week_year, week_number""")
def slice_labels(spark, sf):
    rows = fx.with_weeks(fx.posts(spark, sf, with_ratio=False))
    return rows.groupBy(*agg.SLICE).agg(
        dates.span_label(F.min("timestamp_utc"), F.max("timestamp_utc")).alias("week_label")
    )


@query("b10_row_labels", S.with_(S.CLEAN) + """
SELECT post_id, 'Week ' || week_number || ' (' || strftime(timestamp_utc, '%b %d') || ' – ' ||
  strftime(date_trunc('week', timestamp_utc) + INTERVAL 6 DAY, '%b %d, %Y') || ')' AS label FROM clean""")
def row_labels(spark, sf):
    return fx.posts(spark, sf, with_ratio=False).select("post_id", dates.row_label(F.col("timestamp_utc")).alias("label"))


@query("b12_engagement", S.with_(S.CLEAN) + """
SELECT post_id, round(score + num_comments + 1e-9, 4) AS engagement,
  round(score * 0.5 + num_comments * 0.3 + upvote_ratio * 100 * 0.2 + 1e-9, 4) AS weighted FROM clean""")
def engagement(spark, sf):
    score, comments, ratio = F.col("score"), F.col("num_comments"), F.col("upvote_ratio")
    return fx.with_numbers(fx.posts(spark, sf)).select(
        "post_id", numbers.rounded(numbers.engagement(score, comments), 4).alias("engagement"),
        numbers.rounded(numbers.weighted_engagement(score, comments, ratio), 4).alias("weighted"),
    )


def _clean_sql(column: str) -> str:
    sql = f"coalesce({column}, '')"
    for pattern, replacement in text.CLEANING_STEPS:
        pattern = pattern.replace("(?md)", "(?m)").replace("'", "''")
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"trim({sql}, ' ')"


@query("b13_clean_text", f"""
SELECT 'document' AS kind, doc_id AS id, {_clean_sql('text')} AS cleaned FROM documents
UNION ALL SELECT 'page', page_id, {_clean_sql('html')} FROM pages""")
def clean_text(spark, sf):
    documents = fx.documents(spark, sf).select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), text.clean_text(F.col("text")).alias("cleaned"))
    pages = fx.spread(fx.table(spark, sf, "pages")).select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), text.clean_text(F.col("html")).alias("cleaned"))
    return documents.unionByName(pages)


_STRIP = rf"'\A{_SPACE}+|{_SPACE}+\z', '', 'g'"


@query("b14_title_and_body", f"""
WITH parts AS (
  SELECT doc_id, regexp_replace(split_part(text, chr(10), 1), {_STRIP}) AS title,
    regexp_replace(CASE lang WHEN 'en' THEN text WHEN 'de' THEN ' [Removed] ' WHEN 'fr' THEN NULL ELSE '[deleted]' END, {_STRIP}) AS body
  FROM documents)
SELECT doc_id, md5(CASE WHEN lower(coalesce(body, '')) IN ('[removed]', '[deleted]', '') THEN title ELSE title || ' ' || body END) AS joined
FROM parts""")
def title_and_body(spark, sf):
    body = (
        F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "de", " [Removed] ")
        .when(F.col("lang") == "fr", F.lit(None)).otherwise("[deleted]")
    )
    joined = text.combine_title_body(text.first_line(F.col("text")), body)
    return fx.documents(spark, sf).select("doc_id", F.md5(joined).alias("joined"))


KEYWORD_SQL = f"""[w FOR w IN regexp_split_to_array(lower(text), '{_SPACE}+') IF length(w) > 3 AND regexp_matches(w, '\\A\\p{{L}}+\\z')
  AND NOT (starts_with(w, 'http') OR starts_with(w, '@') OR starts_with(w, '#') OR starts_with(w, 'www')) AND w NOT IN ({_STOP_SQL})]"""
TERM_SQL = f"[w FOR w IN regexp_extract_all(lower(text), '{text.WORD}') IF w NOT IN ({_STOP_SQL})]"


@query("b15_keyword_tokens", f"SELECT doc_id, array_to_string({KEYWORD_SQL}, ' ') AS tokens FROM documents")
def keyword_tokens(spark, sf):
    tokens = text.keyword_tokens(F.col("text"), _STOP)
    return fx.documents(spark, sf).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("b16_term_ngrams", f"""
WITH t AS (SELECT doc_id, {TERM_SQL} AS terms FROM documents)
SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms,
  md5(array_to_string(list_concat(terms,
    [terms[i] || ' ' || terms[i + 1] FOR i IN range(1, len(terms))],
    [terms[i] || ' ' || terms[i + 1] || ' ' || terms[i + 2] FOR i IN range(1, len(terms) - 1)]), '|')) AS grams FROM t""")
def term_ngrams(spark, sf):
    terms = fx.documents(spark, sf).select("doc_id", text.term_tokens(F.col("text"), _STOP).alias("terms"))
    return terms.select(
        "doc_id", F.size("terms").alias("n_terms"),
        F.md5(F.array_join(text.ngrams(F.col("terms"), 1, 3), "|")).alias("grams"),
    )


_CUTS = [120, 100, 140, 150, 80, 512, 300]


@query("b17_prefix_cuts", "SELECT doc_id, " + ", ".join(f"substr(text, 1, {n}) AS first_{n}" for n in _CUTS) + " FROM documents")
def prefix_cuts(spark, sf):
    body = F.col("text")
    return fx.documents(spark, sf).select("doc_id", *[text.cut_to(body, n).alias(f"first_{n}") for n in _CUTS])


@query("b18_number_formats", S.with_(S.CLEAN) + """
SELECT post_id, format('{:,}', CAST(floor(score * 1000) AS BIGINT)) AS grouped, printf('%.0f', round(score + 1e-9, 0)) AS whole,
  printf('%.2f', round(score + 1e-9, 2)) AS two, printf('%.0f', round(num_comments / 150.0 * 100 + 1e-9, 0)) || '%' AS share,
  printf('%.1f', round(num_comments / 150.0 * 100 + 1e-9, 1)) || '%' AS share_one FROM clean""")
def number_formats(spark, sf):
    rows = fx.with_numbers(fx.posts(spark, sf))
    share = F.col("num_comments") / F.lit(150.0)
    return rows.select(
        "post_id", F.format_number(F.floor(F.col("score") * 1000), 0).alias("grouped"),
        numbers.fixed(F.col("score"), 0).alias("whole"), numbers.fixed(F.col("score"), 2).alias("two"),
        numbers.percent_text(share).alias("share"), numbers.percent_text(share, 1).alias("share_one"),
    )


_CRITICAL_SQL = "(" + " OR ".join(f"contains(lower(title), '{w}')" for w in config.CRITICAL_WORDS) + ")"


@query("b21_critical_titles", S.with_(S.POSTS) + f"SELECT post_id, {_CRITICAL_SQL} AS critical FROM posts")
def critical_titles(spark, sf):
    posts = fx.posts(spark, sf, with_text=True, with_ratio=False)
    return posts.select("post_id", text.is_critical(F.col("title")).alias("critical"))


@query("b22_vector_text", f"SELECT vec_id, {S.vector_text('embedding')} AS embedding FROM embeddings")
def vector_from_text(spark, sf):
    as_text = fx.embeddings(spark, sf).select("vec_id", F.to_json("embedding").alias("v"))
    parsed = as_text.select("vec_id", vectors.parse_vector(F.col("v")).alias("embedding"))
    return parsed.select("vec_id", vector_text("embedding"))


@query("b23_cosine", """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) + 0.0 AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine(spark, sf):
    a = fx.embeddings(spark, sf)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    similarity = vectors.cosine_similarity(F.col("embedding"), F.col("other"))
    return a.join(b, "vec_id").select("vec_id", (F.round(similarity, 6) + F.lit(0.0)).alias("cosine"))


@query("b24_unit_vectors", f"""
WITH n AS (SELECT vec_id, label, [x * (label + 1) FOR x IN embedding] AS v FROM embeddings),
l AS (SELECT *, sqrt(list_sum([CAST(x AS DOUBLE) * x FOR x IN v])) AS len FROM n)
SELECT vec_id, round(len, 5) AS length, {S.vector_text('[x / len FOR x IN v]')} AS unit FROM l""")
def unit_vectors(spark, sf):
    scaled = F.transform("embedding", lambda x: x * (F.col("label") + 1).cast("float"))
    rows = fx.embeddings(spark, sf).select("vec_id", scaled.alias("v"))
    unit = vectors.l2_normalised(F.col("v"))
    return rows.select("vec_id", F.round(vectors.norm(F.col("v")), 5).alias("length"), unit.alias("unit")).select(
        "vec_id", "length", vector_text("unit")
    )


@query("b25_label_codes", S.with_(S.POSTS) + """
SELECT niche, CAST(dense_rank() OVER (ORDER BY niche) - 1 AS INTEGER) AS code, count(*) AS posts FROM posts GROUP BY niche""")
def label_codes(spark, sf):
    posts = fx.posts(spark, sf, with_ratio=False)
    counts = agg.count_by(posts, "niche")
    return counts.join(agg.label_codes(posts, "niche"), "niche").select("niche", "code", "posts")


@query("b29_display_labels", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'World View' ELSE upper(event_type[1]) || event_type[2:] || ' Group' END AS label FROM events""")
def display_labels(spark, sf):
    slug = F.concat("event_type", F.lit("-group"))
    label = text.niche_title(slug, {"view-group": "World View"})
    return fx.table(spark, sf, "events").select("event_id", label.alias("label"))


# Filters ---------------------------------------------------------------------------------------------

@query("c2_posts_of_week", S.with_(S.CLEAN) + f"""
SELECT post_id, {S.stamp('timestamp_utc')} AS timestamp_utc FROM clean WHERE niche = 'error' AND week_year = 2024 AND week_number = 3""")
def posts_of_week(spark, sf):
    rows = fx.with_weeks(fx.posts(spark, sf, with_ratio=False))
    return rows.where("niche = 'error' AND week_year = 2024 AND week_number = 3").select("post_id", stamp("timestamp_utc"))


@query("c3_posts_with_text", S.with_(S.POSTS) + f"""
SELECT post_id FROM posts WHERE regexp_replace(coalesce(text_translated, ''), {_STRIP}) <> ''""")
def posts_with_text(spark, sf):
    rows = fx.posts(spark, sf, with_text=True, with_ratio=False)
    return rows.where(~text.is_blank(F.col("text_translated"))).select("post_id")


@query("c5_without_noise", S.with_(S.NOISY) + "SELECT post_id, cluster FROM noisy WHERE cluster <> -1")
def without_noise(spark, sf):
    return fx.noisy_posts(spark, sf).where(F.col("cluster") != agg.NOISE).select("post_id", "cluster")


@query("c6_slice_gate", S.with_(S.CLEAN) + """
SELECT niche, week_year, week_number, count(*) AS posts FROM clean GROUP BY ALL HAVING count(*) >= 200""")
def slice_gate(spark, sf):
    rows = fx.with_weeks(fx.posts(spark, sf, with_ratio=False))
    return agg.count_by(agg.slice_gate(rows, 200), *agg.SLICE)


@query("c9_confident_share", S.with_(S.NOISY) + """
SELECT round(avg(CASE WHEN probability >= 0.2 THEN 1.0 ELSE 0.0 END) * 100 + 1e-9, 1) AS high_confidence_pct FROM noisy WHERE cluster <> -1""")
def confident_share(spark, sf):
    return agg.confident_share(fx.noisy_posts(spark, sf), 0.2)


@query("c11_posts_of_top_clusters", S.with_(S.NOISY) + """
SELECT post_id, cluster FROM noisy WHERE cluster IN (
  SELECT cluster FROM noisy WHERE cluster <> -1 GROUP BY cluster ORDER BY count(*) DESC, cluster LIMIT 6)""")
def posts_of_top_clusters(spark, sf):
    rows = fx.noisy_posts(spark, sf)
    return agg.only_clusters(rows, agg.largest_clusters(rows, 6)).select("post_id", "cluster")
