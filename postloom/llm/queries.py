"""The queries of this subpackage over the test tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, extraction, fingerprints, kneser_ney, langid, merkle, mixing, packing, periods, setsketch, small_world, superkmers

#: Vocabulary file of the two queries on tokens, a file of the installed package of public vocabularies.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.dedup_digests(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted_languages(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(turns.unionByName(own))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicate_rows(table(spark, sf_dir, "documents"), percent=85)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.scored_documents(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_world.near_vector_rows(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digests(table(spark, sf_dir, "documents"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proof_rows(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_bpe_tokens, op3_substring_dedup, op4_html_extraction, op5_language_id, op6_chat_formatting, op7_minhash_near_dedup,
        op8_lm_scoring, op9_embedding_near_dedup, op10_document_fingerprints, op11_periodic_runs, op12_source_mixing, op13_merkle_manifest,
    )
}

#: Lengths of the marks: head, gap after the role, between texts, after the block.
_CHAT_SQL = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), o AS (
    SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
        length(role) + length(regexp_replace(role, '[^#<:\\\\]', '', 'g')) AS role_size,
        length(text) + length(regexp_replace(text, '[^#<:\\\\]', '', 'g')) AS text_size
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(text_size + CASE WHEN opens THEN 4 + role_size + 2 + 8 ELSE 7 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

_SUBSTRING_SQL = r"""
WITH w AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), x AS (
    SELECT doc_id, s, array_to_string(ws[s : s + 19], ' ') AS t
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w)
), r AS (
    SELECT doc_id, s FROM x QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, s) > 1
), c AS (
    SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS i FROM r
), k AS (
    SELECT a.doc_id, a.i, a.word, c.i IS NULL AS stays
    FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) a
    LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.i
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(g.n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(g.kept, '')) AS kept_sha256
FROM w LEFT JOIN (
    SELECT doc_id, count(*) FILTER (NOT stays) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (stays) AS kept
    FROM k GROUP BY doc_id
) g ON w.doc_id = g.doc_id
"""

_NEAR_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS t
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), e AS MATERIALIZED (
    SELECT p.a, p.b
    FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
    JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
    WHERE 100 * p.both >= 85 * (x.n + y.n - p.both)
), r AS (
    SELECT doc_id, doc_id AS reached FROM documents
    UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

_VECTOR_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
    SELECT vec_id, embedding::DOUBLE[] AS e, len(embedding) AS n FROM embeddings WHERE embedding IS NOT NULL
), e AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.e, y.e) AS c FROM v x JOIN v y ON x.n = y.n AND x.vec_id <> y.vec_id
    ) WHERE isfinite(c) AND c >= 0.9
), r AS (
    SELECT vec_id, vec_id AS reached FROM embeddings
    UNION SELECT r.vec_id, e.b FROM r JOIN e ON e.a = r.reached
)
SELECT c.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id) c
LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY a) l ON l.a = c.vec_id
"""

#: CRC-32 of the decimal id, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)"""

#: A run has six words or more that come again a period later, so pairs of equal places are joined by six words.
_RUNS_SQL = rf"""
WITH c AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_CRC32} AS h FROM documents
), g AS (
    SELECT *, len(ws) AS n, h // 10 AS g FROM c
), a AS (
    SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM g
), p AS MATERIALIZED (
    SELECT doc_id, n, list_transform(range(0, n), lambda i:
        ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) AS ws FROM a
), k AS MATERIALIZED (
    SELECT doc_id, i, array_to_string(ws[i + 1 : i + 6], ' ') AS t FROM (SELECT doc_id, ws, unnest(range(0, n - 5)) AS i FROM p)
), e AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.t = y.t AND x.i < y.i
), s AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island
    HAVING count(*) + 5 + q >= greatest(12, 2 * q)
), r AS MATERIALIZED (
    SELECT * FROM s WHERE NOT EXISTS (
        SELECT 1 FROM s d WHERE d.doc_id = s.doc_id AND d.q < s.q AND d.start <= s.start AND d.start + d.length >= s.start + s.length)
), o AS (
    SELECT doc_id, count(*) AS n_runs, arg_min({{'start': start, 'length': length, 'period': q}}, (-length, start, q)) AS best,
        string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
        list_distinct(flatten(list(range(start + q, start + length)))) AS gone
    FROM r GROUP BY doc_id
)
SELECT p.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start AS start, best.length AS length, best.period AS period,
    1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_transform(
        list_filter(range(0, n), lambda i: NOT list_contains(gone, i)), lambda i: ws[i + 1]) END, ' ')) AS collapsed_sha256,
    n::BIGINT AS n_words, (n - coalesce(len(gone), 0))::BIGINT AS n_kept
FROM p LEFT JOIN o ON p.doc_id = o.doc_id
"""

#: The level at which shares are cut is found among the sources in the order in which they fill up.
_MIX_SQL = r"""
WITH d AS MATERIALIZED (
    SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(t) AS text_key,
        (('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, '-') || ':' || t)[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u,
        greatest(0.05, CASE WHEN t = '' THEN 0 ELSE (length(t) - length(regexp_replace(t, '\p{L}+', '', 'g'))) / length(t) END) AS quality
    FROM (SELECT *, coalesce(text, '') AS t FROM documents)
), s AS (
    SELECT source, source_size, 3 * source_size AS most,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), f AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s WINDOW o AS (ORDER BY most / weight, source NULLS LAST)
), l AS (
    SELECT coalesce(arg_min(level, most / weight) FILTER (level * weight <= most), 0) AS level FROM f
), t AS (
    SELECT source, source_size, CASE WHEN most < weight * l.level THEN most::DOUBLE ELSE weight * l.level END AS target FROM s, l
), k AS (
    SELECT d.*, source_size, target, coalesce(sum(size) OVER (
        PARTITION BY d.source ORDER BY -ln(u) / quality, doc_id, text_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (epochs * size + last_words)::BIGINT AS taken, source, epochs, last_words
FROM (SELECT *, greatest(0, least(size, round(target)::BIGINT - epochs * source_size - before))::BIGINT AS last_words FROM k)
"""

_LEAF_SQL = "sha256(concat(" + ", ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + "))"

#: A tree is a row with the list of its nodes, which shrinks level by level; the sources are the first tree, their subroots the second.
_MERKLE_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT *, {_CRC32} % 2 = 0 AS tampered FROM documents
), v AS MATERIALIZED (
    SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS spot,
        {_LEAF_SQL.format(text="text")} AS leaf,
        {_LEAF_SQL.format(text="CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END")} AS changed
    FROM d
), tree AS (
    SELECT source, 0 AS level, list(leaf ORDER BY spot) AS nodes FROM v GROUP BY source
    UNION ALL
    SELECT source, level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))
    FROM tree WHERE len(nodes) > 1
), tops AS MATERIALIZED (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spot, nodes[1] AS top, level AS height FROM tree WHERE len(nodes) = 1
), upper AS (
    SELECT 0 AS level, list(top ORDER BY spot) AS nodes FROM tops
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1 : 3 * i + 3], '')))
    FROM upper WHERE len(nodes) > 1
), steps AS MATERIALIZED (
    SELECT v.doc_id, t.level, (v.spot // (3 ** t.level)::BIGINT)::BIGINT AS place, t.nodes FROM v JOIN tree t ON v.source IS NOT DISTINCT FROM t.source WHERE len(t.nodes) > 1
    UNION ALL
    SELECT v.doc_id, o.height + u.level, (o.spot // (3 ** u.level)::BIGINT)::BIGINT, u.nodes
    FROM v JOIN tops o ON v.source IS NOT DISTINCT FROM o.source, upper u WHERE len(u.nodes) > 1
), run AS MATERIALIZED (
    SELECT doc_id, level, array_to_string(nodes[3 * (place // 3) + 1 : place], '') AS before,
        array_to_string(nodes[place + 2 : 3 * (place // 3) + 3], '') AS after FROM steps
), fold AS (
    SELECT doc_id, 0::BIGINT AS level, changed AS node FROM v
    UNION ALL
    SELECT f.doc_id, f.level + 1, sha256(r.before || f.node || r.after) FROM fold f JOIN run r ON r.doc_id = f.doc_id AND r.level = f.level
), proof AS (
    SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM run GROUP BY doc_id
), done AS (
    SELECT doc_id, arg_max(node, level) AS node FROM fold GROUP BY doc_id
)
SELECT v.doc_id, v.leaf, o.top AS subroot, u.nodes[1] AS root, coalesce(p.proof, sha256('')) AS proof_sha256, n.node AS folded_root,
    n.node = u.nodes[1] AS verified, v.source, v.spot AS leaf_number
FROM v JOIN tops o ON v.source IS NOT DISTINCT FROM o.source JOIN done n ON n.doc_id = v.doc_id LEFT JOIN proof p ON p.doc_id = v.doc_id,
    upper u WHERE len(u.nodes) = 1
"""

SQL: dict[str, str] = {
    "op11_periodic_runs": _RUNS_SQL, "op12_source_mixing": _MIX_SQL, "op13_merkle_manifest": _MERKLE_SQL,
    "op3_substring_dedup": _SUBSTRING_SQL, "op6_chat_formatting": _CHAT_SQL, "op7_minhash_near_dedup": _NEAR_SQL,
    "op9_embedding_near_dedup": _VECTOR_SQL,
}
