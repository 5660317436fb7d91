"""SQL fragments that the twins share: the posts mapping, clean numbers, given clusters."""

from __future__ import annotations

POSTS = """posts AS (
  SELECT CAST(e.event_id AS VARCHAR) AS post_id, e.event_type AS niche, CAST(e.user_id AS VARCHAR) AS author,
    e.value AS score, CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS num_comments,
    e.ts AS timestamp_utc, d.doc_id, CAST(l.quality AS DOUBLE) AS upvote_ratio, d.text AS full_text,
    CASE WHEN d.lang = 'en' THEN d.text END AS text_translated, split_part(d.text, chr(10), 1) AS title
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

CLEAN = POSTS + """,
clean AS (
  SELECT * REPLACE (coalesce(score, 0.0) AS score, CAST(coalesce(num_comments, 0) AS DOUBLE) AS num_comments,
    coalesce(upvote_ratio, 0.0) AS upvote_ratio),
    CAST(isoyear(timestamp_utc) AS INTEGER) AS week_year, CAST(week(timestamp_utc) AS INTEGER) AS week_number
  FROM posts)"""

GIVEN = """comps AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
cents AS (SELECT label, pos, avg(x) AS c FROM comps GROUP BY label, pos),
given AS (
  SELECT vec_id, label AS cluster, round(sum(x * c) / (sqrt(sum(x * x)) * sqrt(sum(c * c))), 9) AS probability
  FROM comps JOIN cents USING (label, pos) GROUP BY vec_id, label)"""

CLUSTERED = CLEAN + ",\n" + GIVEN + """,
clustered AS (
  SELECT p.*, g.cluster, g.probability FROM clean p
  JOIN given g ON g.vec_id = CAST(p.post_id AS BIGINT) % (SELECT count(*) FROM embeddings))"""

STATS = """stats AS (
  SELECT niche, week_year, week_number, cluster,
    round(avg(score) * 0.5 + avg(num_comments) * 0.3 + avg(upvote_ratio) * 100 * 0.2 + 1e-9, 2) AS importance_score,
    count(*) AS post_count, round(avg(score) + 1e-9, 1) AS avg_score,
    round(avg(num_comments) + 1e-9, 1) AS avg_comments, round(avg(upvote_ratio) + 1e-9, 3) AS avg_upvote_ratio
  FROM gated WHERE cluster <> -1 GROUP BY niche, week_year, week_number, cluster)"""

# Posts whose vector lies far from its centroid count as noise.
NOISY = CLUSTERED + """,
noisy AS (SELECT * REPLACE (CASE WHEN probability < 0.05 THEN -1 ELSE cluster END AS cluster),
  score + num_comments AS engagement FROM clustered)"""

GATED = """gated AS (
  SELECT * FROM clustered JOIN (
    SELECT niche, week_year, week_number FROM clustered GROUP BY ALL HAVING count(*) >= 20) USING (niche, week_year, week_number))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def vector_text(column: str) -> str:
    """Vector as text of whole millionths."""
    return f"array_to_string([CAST(CAST(floor(CAST(x AS DOUBLE) * 1000000 + 0.5) AS BIGINT) AS VARCHAR) FOR x IN {column}], ',')"


def word_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
