"""Settings and fixed values."""

from __future__ import annotations

from dataclasses import dataclass

# Weights of the engagement and importance formula.
W_SCORE = 0.5
W_COMMENTS = 0.3
W_UPVOTE = 0.2

# Weights of the representative-post rank.
W_PROBABILITY_RANK = 0.6
W_ENGAGEMENT_RANK = 0.4

# Substrings that mark a title as critical.
CRITICAL_WORDS = [
    "ban", "fail", "broken", "worst", "hate", "scam", "fraud",
    "wrong", "bad", "terrible", "dangerous", "illegal", "blocked",
    "cancelled", "delayed", "fined", "crash", "layoff", "leak",
]

# Sentiment labels and their thresholds on the critical share.
SENTIMENT_NEGATIVE = "mostly negative/critical"
SENTIMENT_POSITIVE = "mostly positive/excited"
SENTIMENT_MIXED = "mixed sentiment"
NEGATIVE_ABOVE = 0.5
POSITIVE_BELOW = 0.2

# Bodies that count as no body.
DELETION_MARKS = ["[removed]", "[deleted]", ""]

# Word starts that are not keywords.
NOT_A_WORD_STARTS = ["http", "@", "#", "www"]

# Listings in order of priority for first-seen dedup.
LISTINGS = ["new", "top/month", "top/week", "controversial/month", "controversial/week"]

# Entity labels and how a report names them.
ENTITY_LABELS = {
    "ORG": "🏢 Companies/Orgs",
    "PRODUCT": "📦 Products/Services",
    "PERSON": "👤 People",
    "GPE": "🌍 Places",
}

# Display names of known niches.
NICHE_LABELS = {
    "technology": "Technology",
    "science": "Science",
    "worldnews": "World News",
    "gaming": "Gaming",
    "smartphones": "Smartphones",
    "movies": "Movies",
}

# Fixed value: prefix of an absolute link.
LINK_PREFIX = "https://reddit.com"

# The parameter grid of the density sweep.
GRID = {
    "n_components": [10, 15, 20, 25, 30],
    "min_cluster_size": [10, 15, 20, 25, 30, 40, 50],
    "min_samples": [3, 5, 7, 10, 15],
    "selection": ["eom", "leaf"],
}


@dataclass(frozen=True)
class Settings:
    """Parameters of the weekly report; the defaults are fixed values."""

    min_slice_posts: int = 20
    min_cluster_size: int = 10
    min_samples: int = 5
    reduce_above_dim: int = 20
    reduce_components: int = 10
    top_clusters: int = 3
    top_posts: int = 8
    top_keywords: int = 15
    top_phrases: int = 10
    top_entities: int = 8


# Rows of one vector block; a task holds two blocks and their distance matrix.
BLOCK_ROWS = 2_048
