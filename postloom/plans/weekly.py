"""The weekly report: cluster every niche and week, describe the top clusters, store what a writer makes
of the descriptions. One plan covers all slices; nothing loops over niches or weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import dates, numbers, text
from ..operators import aggregates as agg, keywords as kw, ranking
from ..operators.hdbscan import hdbscan
from ..operators.reduction import reduce_slices
from ..session import cut
from ..sources import schemas

SLICE = agg.SLICE
CLUSTER = [*SLICE, "cluster"]
#: Characters of a title in the list of a context.
TITLE_CHARS = 120


def clustered_posts(posts: DataFrame, embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Posts of large enough slices with cluster and membership strength.

    `posts` has the slice key; posts without a vector are left out.
    """
    joined = posts.join(embeddings.select("post_id", "embedding"), "post_id")
    gated = cut(agg.slice_gate(joined, settings.min_slice_posts))  # the joins are done once, it is read several times
    reduced = cut(reduce_slices(gated, SLICE, "post_id", "embedding", settings.reduce_components, settings.reduce_above_dim))
    labels = hdbscan(reduced, SLICE, "id", "vector", settings.min_cluster_size, settings.min_samples)
    return gated.drop("embedding").join(labels.withColumnRenamed("id", "post_id"), [*SLICE, "post_id"])


# Descriptions ----------------------------------------------------------------------------------------

def _entity_block(entities: DataFrame) -> DataFrame:
    """One line per label: the label and its names with their counts."""
    names = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "name", "mentions"))),
        lambda s: F.concat(s["name"], F.lit(" ("), s["mentions"].cast("string"), F.lit("x)")),
    )
    order = F.array_position(F.array(*[F.lit(x) for x in ("ORG", "PRODUCT", "PERSON", "GPE")]), F.col("label"))
    lines = entities.groupBy(*CLUSTER, "label").agg(F.array_join(names, ", ").alias("_names")).select(
        *CLUSTER, order.alias("_order"),
        F.concat(F.lit("  "), text.entity_title(F.col("label")), F.lit(": "), F.col("_names")).alias("_line"),
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_order", "_line"))), lambda s: s["_line"])
    return lines.groupBy(*CLUSTER).agg(F.array_join(ordered, "\n").alias("entity_block"))


def _post_lines(top_posts: DataFrame) -> DataFrame:
    """The numbered lines of the representative posts, with a link where there is one."""
    head = F.concat(
        F.lit("  "), F.col("position").cast("string"), F.lit(". [Score: "), F.format_number(F.floor("score"), 0),
        F.lit(" | Comments: "), F.format_number(F.floor("num_comments"), 0), F.lit(" | Prob: "),
        numbers.fixed(F.col("probability"), 2), F.lit("] "), text.cut_to(F.col("title"), TITLE_CHARS),
    )
    link = F.when(F.col("permalink").isNotNull(), F.concat(F.lit("\n     URL: "), F.col("permalink")))
    lines = top_posts.select(*CLUSTER, "position", F.concat(head, F.coalesce(link, F.lit(""))).alias("_line"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", "_line"))), lambda s: s["_line"])
    return lines.groupBy(*CLUSTER).agg(F.array_join(ordered, "\n").alias("post_block"))


def cluster_contexts(
    posts: DataFrame, settings: Settings = Settings(), gazetteer: DataFrame | None = None, stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Text that describes each top cluster of each slice: slice, cluster, cluster_rank, context.

    `posts` has slice, cluster, probability, engagement numbers, title, body and permalink. Only posts of top
    clusters are read for text, and every part is an aggregate per cluster before it is joined.
    """
    top = agg.top_clusters(agg.cluster_stats(posts), settings.top_clusters).select(*CLUSTER, "cluster_rank")
    mine = posts.join(F.broadcast(top.select(*CLUSTER)), CLUSTER, "left_semi")  # few for each slice, and texts stay where they are
    means = mine.groupBy(*CLUSTER).agg(
        F.count("*").alias("n"), F.avg("score").alias("s"), F.avg("num_comments").alias("c"), F.avg("upvote_ratio").alias("u")
    )
    words = kw.joined_terms(kw.top_keywords(mine, CLUSTER, "body", settings.top_keywords, stop_words), CLUSTER, "keyword", "keywords")
    phrases = kw.joined_terms(
        kw.recurring_phrases(mine, CLUSTER, "title", "post_id", settings.top_phrases, stop_words), CLUSTER, "phrase", "phrases"
    )
    mood = kw.sentiment(mine, CLUSTER, "title")
    entities = _entity_block(kw.entity_counts(mine, CLUSTER, "title", gazetteer, settings.top_entities))
    shown = mine.withColumn("title", text.cut_to(F.col("title"), TITLE_CHARS))  # before the join that looks the posts up
    listed = _post_lines(ranking.representative_posts(shown, CLUSTER, settings.top_posts))

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value)

    # The wording and order of the lines.
    context = F.concat_ws(
        "\n",
        F.concat(F.lit("--- CLUSTER "), F.col("cluster").cast("string"), F.lit(" ---")),
        line("Post count         : ", F.col("n").cast("string")),
        line("Avg score          : ", numbers.fixed(F.col("s"), 0)),
        line("Avg comments       : ", numbers.fixed(F.col("c"), 0)),
        line("Avg upvote ratio   : ", numbers.fixed(F.col("u"), 2)),
        F.concat(F.lit("Community sentiment: "), F.col("sentiment"), F.lit(" ("), numbers.percent_text(F.col("critical_share")), F.lit(" posts are critical)")),
        F.lit(""),
        line("Recurring keywords : ", F.coalesce("keywords", F.lit(""))),
        line("Recurring phrases  : ", F.coalesce("phrases", F.lit("n/a"))),
        F.lit(""),
        F.lit("Named entities mentioned across posts (frequency in brackets):"),
        F.coalesce("entity_block", F.lit("  None detected")),
        F.lit(""),
        F.lit("Top posts by representativeness + engagement:"),
        F.col("post_block"),
    )
    joined = top.join(means, CLUSTER).join(mood, CLUSTER).join(listed, CLUSTER)
    for part in (words, phrases, entities):
        joined = joined.join(part, CLUSTER, "left")
    return joined.select(*CLUSTER, "cluster_rank", context.alias("context"))


def prompts(contexts: DataFrame, labels: DataFrame) -> DataFrame:
    """One request per slice for a writer, human or model: slice, week_label, n_trends, prompt.

    `labels` has slice and week_label. A slice has at most as many contexts as it has top clusters.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("cluster_rank", "context"))), lambda s: s["context"])
    slices = contexts.groupBy(*SLICE).agg(F.array_join(ordered, "\n\n").alias("_contexts"), F.count("*").alias("n_trends"))
    n = F.col("n_trends").cast("string")
    shape = (
        '{"niche": "%s", "trends": [{"rank": 1, "title": "", "description": "", "key_entities": {"companies": [], '
        '"products": [], "people": []}, "sentiment": "positive|negative|mixed", "importance": "", "references": []}]}'
    )
    prompt = F.concat(
        F.lit("You describe what a community keeps coming back to. The community is r/"), F.col("niche"),
        F.lit(", the time "), F.col("week_label"), F.lit(".\n\nA trend is a pattern over many posts, not one event.\n\nCLUSTERS\n"),
        F.col("_contexts"), F.lit("\n\nWrite exactly "), n, F.lit(" trend(s), one per cluster, in the order above. For each: a title of at most "
        "ten words; a description of three sentences (the pattern, why it recurs, what it signals); the companies, products and people "
        "in it; the sentiment; one sentence on why it matters; two or three links from the posts above.\n"
        "Answer with JSON only, in this shape, with exactly "), n, F.lit(" object(s) in trends:\n"), F.format_string(shape, "niche"),
    )
    return slices.join(labels, SLICE).select(*SLICE, "week_label", "n_trends", prompt.alias("prompt"))


# Results ---------------------------------------------------------------------------------------------

def parsed_trends(reply: Column) -> Column:
    """Trends of a reply in JSON, code fences allowed, missing fields filled; null if it is no JSON."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    schema = schemas.REPLY[:-1] + ", _bad: string>"
    parsed = F.from_json(text.unfenced(reply), schema, options)
    empty = F.array().cast("array<string>")

    def filled(t: Column) -> Column:
        names = t["key_entities"]
        return F.struct(
            t["rank"].alias("rank"), t["title"].alias("title"), t["description"].alias("description"),
            F.struct(*[F.coalesce(names[c], empty).alias(c) for c in ("companies", "products", "people")]).alias("key_entities"),
            F.coalesce(t["sentiment"], F.lit("mixed")).alias("sentiment"),
            F.coalesce(t["importance"], F.lit("")).alias("importance"),
            F.coalesce(t["references"], empty).alias("references"),
        )

    bad = reply.isNull() | (text.unfenced(reply) == "") | parsed["_bad"].isNotNull()
    trends = F.coalesce(F.transform(parsed["trends"], filled), F.array().cast(f"array<{schemas.TREND}>"))
    return F.when(~bad, trends)


def slice_facts(posts: DataFrame) -> DataFrame:
    """Label, size, clusters found and noise of each slice."""
    noise = F.col("cluster") == agg.NOISE
    return posts.groupBy(*SLICE).agg(
        dates.span_label(F.min("timestamp_utc"), F.max("timestamp_utc")).alias("week_label"),
        F.count("*").alias("post_count"),
        F.countDistinct(F.when(~noise, F.col("cluster"))).alias("clusters_found"),
        F.sum(noise.cast("bigint")).alias("noise_posts"),
    )


def week_results(posts: DataFrame, replies: DataFrame) -> DataFrame:
    """One nested row per slice whose reply could be read: facts, trends, cluster statistics by importance.

    `replies` has slice and reply. A slice without clusters, or with a reply that is no JSON, has no row.
    """
    stats = agg.cluster_stats(posts).withColumn(
        "_s",
        F.struct(
            F.col("cluster").cast("int").alias("cluster_id"), "importance_score", "post_count", "avg_score", "avg_comments",
            "avg_upvote_ratio",
        ),
    )
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("importance_score")).alias("o"), F.col("cluster").alias("c"), F.col("_s").alias("s")))),
        lambda x: x["s"],
    )
    per_slice = stats.groupBy(*SLICE).agg(ordered.alias("cluster_stats"))
    parsed = replies.select(*SLICE, parsed_trends(F.col("reply")).alias("trends")).where(F.col("trends").isNotNull())
    return slice_facts(posts).join(per_slice, SLICE).join(parsed, SLICE).select(
        *SLICE, "week_label", "post_count", "clusters_found", "noise_posts", "trends", "cluster_stats"
    )


def unread_replies(replies: DataFrame) -> DataFrame:
    """How many replies could and could not be read."""
    ok = parsed_trends(F.col("reply")).isNotNull()
    return replies.agg(F.sum(ok.cast("bigint")).alias("parsed"), F.sum((~ok).cast("bigint")).alias("unread"))
