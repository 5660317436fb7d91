"""Text expressions. Patterns name their character classes, so that they do not depend on the
regex engine's idea of white space and line ends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

# White space as Unicode has it; `\S` and `\s` of a regex engine may mean ASCII only.
_SPACE_CHARS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE = f"[{_SPACE_CHARS}]"
NOT_SPACE = f"[^{_SPACE_CHARS}]"
WORD = r"[\p{L}\p{N}_]{2,}"

# (pattern, replacement) in the order they apply: order is part of the meaning, since an unescaped
# `&gt;` can start a quote and a link loses its target to the URL step first.
CLEANING_STEPS = [
    (f"https?://{NOT_SPACE}+", ""),
    (rf"www\.{NOT_SPACE}+", ""),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&#x200B;", ""),
    (r"\*\*([^\n]+?)\*\*", "$1"),
    (r"\*([^\n]+?)\*", "$1"),
    (r"~~([^\n]+?)~~", "$1"),
    (f"(?md)^>{SPACE}?", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"(?i)\[removed\]", ""),
    (r"(?i)\[deleted\]", ""),
    (f"{SPACE}+", " "),
]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def clean_text(text: Column) -> Column:
    cleaned = reduce(
        lambda col, step: F.regexp_replace(col, step[0], step[1]), CLEANING_STEPS, F.coalesce(text, F.lit(""))
    )
    return F.trim(cleaned)


def combine_title_body(title: Column, body: Column) -> Column:
    title, body = strip(F.coalesce(title, F.lit(""))), strip(F.coalesce(body, F.lit("")))
    return F.when(F.lower(body).isin(config.DELETION_MARKS), title).otherwise(F.concat(title, F.lit(" "), body))


def best_text(translated: Column, full: Column) -> Column:
    """Translated text where there is one, else the full text, row by row."""
    return F.coalesce(translated, full)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def cut_to(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def _not_stopped(stop_words: Sequence[str]):
    words = list(stop_words)
    return lambda w: ~w.isin(words)


def keyword_tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case letter-only words of more than three letters that are no stop words."""
    keep = _not_stopped(stop_words)
    return F.filter(
        F.split(F.lower(text), f"{SPACE}+"),
        lambda w: (F.length(w) > 3) & w.rlike(r"\A\p{L}+\z")
        & ~reduce(lambda a, b: a | b, [w.startswith(s) for s in config.NOT_A_WORD_STARTS])
        & keep(w),
    )


def term_tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Words of two or more word characters, stop words taken out."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})")), _not_stopped(stop_words))


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of `low` to `high` tokens, joined by a blank; tokens must be stop-word free already. Longer runs
    are shorter ones zipped with the tokens that follow."""
    runs = {1: tokens}
    for n in range(2, high + 1):
        count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        runs[n] = F.zip_with(
            F.slice(runs[n - 1], 1, count), F.slice(tokens, n, count), lambda head, word: F.concat(head, F.lit(" "), word)
        )
    parts = [runs[n] for n in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def is_critical(title: Column, words: Sequence[str] = config.CRITICAL_WORDS, whole_words: bool = False) -> Column:
    """True if any word occurs in the title; as a plain substring unless `whole_words`."""
    lowered = F.lower(title)
    if whole_words:
        return lowered.rlike(r"(?<![\p{L}\p{N}_])(" + "|".join(words) + r")(?![\p{L}\p{N}_])")
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def sentiment_label(critical_share: Column) -> Column:
    return (
        F.when(critical_share > config.NEGATIVE_ABOVE, config.SENTIMENT_NEGATIVE)
        .when(critical_share < config.POSITIVE_BELOW, config.SENTIMENT_POSITIVE)
        .otherwise(config.SENTIMENT_MIXED)
    )


def absolute_link(path: Column, prefix: str = config.LINK_PREFIX) -> Column:
    return F.concat(F.lit(prefix), path)


def niche_tag(niche: Column) -> Column:
    return F.concat(F.lit("r/"), niche)


def niche_title(niche: Column, known: dict[str, str] | None = None) -> Column:
    """Display name: a known label, else the name with blanks for dashes and each word capitalised."""
    words = F.split(F.replace(niche, F.lit("-"), F.lit(" ")), r"\b")
    fallback = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )
    labels = config.NICHE_LABELS if known is None else known
    if not labels:
        return fallback
    lookup = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, niche), fallback)


def entity_title(label: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in config.ENTITY_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, label), label)


def trend_headline(trends: Column) -> Column:
    """`#1 First title | #2 Second title`."""
    return F.array_join(
        F.transform(trends, lambda t: F.concat(F.lit("#"), t["rank"].cast("string"), F.lit(" "), t["title"])), " | "
    )


def unfenced(reply: Column) -> Column:
    """Reply text without Markdown code fences."""
    return strip(F.replace(F.replace(reply, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
