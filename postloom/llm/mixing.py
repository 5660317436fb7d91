"""Mixing of sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words: its share of all words by weight, at most `MOST_EPOCHS` times what it has, the excess
shared out again by weight. A source gives its documents as often as whole epochs fit the budget; what is left of the budget is
a weighted sample without replacement: each document draws an exponential number over its quality, -ln(u) / quality, and the
documents come in the order of these keys until the budget is full. The last one gives only its first words, so a source
meets its budget to the word.

u is a digest of the seed, the id and the text, so reruns agree and exact copies with different ids draw apart. The quality
is the share of letters among the characters of the text, at least `LEAST_QUALITY`, unless another expression is given.

Words of a source are summed up in the order of keys by ranges (`running_totals`), so that no source has to fit a task.
Texts stay in the first scan; only keys and sizes are shuffled. Rows with one source, id and text are one row with a count there.

Defined results: a null text is empty and has size 0; a null source is a source, the last one; a null id stays null; each of
several equal rows gets its part (their multiset is what counts); sources without words have target 0; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .running import running_totals

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"
LEAST_QUALITY = 0.05
_STEP = 10_000


def letter_share(text: Column) -> Column:
    """Share of letters among the characters of a text, at least `LEAST_QUALITY`."""
    size = F.char_length(text)
    letters = size - F.char_length(F.regexp_replace(text, r"\p{L}+", ""))
    return F.greatest(F.lit(LEAST_QUALITY), F.when(size > 0, letters / size).otherwise(F.lit(0.0)))


def sampling_key(doc_id: Column, text: Column, quality: Column, seed: str = SEED) -> Column:
    """Exponential number over the quality: the smaller, the earlier the document comes."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), text).cast("binary"))
    u = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.ln(u) / quality


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """`sources` (source_key, source_size) with `target`: weights go round in the order of the keys.

    A source is full if its share would pass its limit. The others share what is left by weight, which may fill more of
    them; sums of a few numbers go to the driver each time, not the sources.
    """
    placed = running_totals(sources, "all", ["source_key"], F.lit(1), "at")
    choice = F.array(*(F.lit(w) for w in weights))
    weighed = cut(placed.select(
        "source_key", "source_size", F.get(choice, F.pmod("at", F.lit(len(weights))).cast("int")).alias("weight"),
        (F.col("source_size") * most_epochs).alias("most")))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while total and level != before:
        filled = F.col("most") < F.col("weight") * F.lit(level)
        sums = weighed.agg(F.sum(F.when(filled, F.col("most"))).alias("most"), F.sum(F.when(~filled, F.col("weight"))).alias("weight")).first()
        before, level = level, (total - (sums["most"] or 0)) / sums["weight"]
    open_target = F.col("weight") * F.lit(level)
    return weighed.select("source_key", "source_size", F.when(F.col("most") < open_target, F.col("most").cast("double")).otherwise(open_target).alias("target"))


def mixture(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS, quality: Column | None = None, seed: str = SEED,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Per row of `docs`: doc_id, source, text_key (a digest), size, source_size, target, epochs, last_words, taken.

    The mix takes the whole text `epochs` times and then its first `last_words` words.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = sampling_key(F.col(doc_id), whole, letter_share(whole) if quality is None else quality, seed)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        # Sources in the order of their bytes, which is that of code points; null after all others.
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("t")).alias("source_key"),
        F.md5(whole.cast("binary")).alias("text_key"), F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), key.alias("key"),
    )
    combined = cut(rows.groupBy("source_key", "source", "doc_id", "text_key", "size", "key").agg(F.count("*").alias("copies")))
    sources = combined.groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    budgets = cut(targets(sources.withColumn("all", F.lit(0)), weights, most_epochs))
    ordered = running_totals(combined, "source_key", ["key", "doc_id", "text_key"], F.col("size") * F.col("copies"), "before", about=budgets)
    # Equal rows come one by one again, in steps, so that no list grows with their number.
    stepped = ordered.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_STEP}"))))
    first = F.col("_step") * _STEP
    copy = F.explode(F.sequence(first, F.least(F.col("copies") - 1, first + _STEP - 1)))
    each = stepped.withColumn("_copy", copy).withColumn("before", F.col("before") + F.col("_copy") * F.col("size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    return (
        each.withColumn("epochs", epochs)
        .withColumn("last_words", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before"))))
        .select("doc_id", "source", "text_key", "size", "source_size", "target", "epochs", "last_words",
                (F.col("epochs") * F.col("size") + F.col("last_words")).alias("taken"))
    )


def mixed_texts(docs: DataFrame, plan: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: doc_id, source, epoch, text, a row for each time a document is taken; `plan` is what `mixture` gives.

    Equal rows of `docs` are one row here, taken as often as all of them."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    given = docs.select(
        F.col(doc_id).cast("long").alias("d"), F.col(source).cast("string").alias("s"), F.md5(whole.cast("binary")).alias("k"), whole.alias("text"))
    taken = plan.groupBy("doc_id", "source", "text_key", "epochs").agg(F.count("*").alias("copies"), F.collect_list(F.when(
        (F.col("last_words") > 0) & (F.col("last_words") < F.col("size")), F.col("last_words"))).alias("cuts"),
        F.count_if((F.col("last_words") > 0) & (F.col("last_words") == F.col("size"))).alias("again"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("text_key") == F.col("k"))
    joined = taken.join(given.dropDuplicates(["d", "s", "k"]), same)
    times = F.col("epochs") * F.col("copies") + F.col("again")
    wholes = joined.where(times > 0).select(
        "doc_id", "source", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("epoch"), "text")
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), 1, F.col("words")), " ")
    parts = joined.select("doc_id", "source", times.alias("times"), "text", F.explode("cuts").alias("words")).select(
        "doc_id", "source", (F.col("times") + 1).alias("epoch"), first_words.alias("text"))
    return wholes.unionByName(parts)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, and how: source, epochs, last_words."""
    return mixture(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "epochs", "last_words")
