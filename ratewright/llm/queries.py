"""Queries of the numbered operators over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.llm import chat, decontamination, embeddings, jaccard, language, language_model, licenses
from ratewright.llm import mixing, negatives, packing, prefix_trie, quality, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; every executor has the package."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path(name))


@query("op3_pack_tokens")
def op3_pack_tokens(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer_file())


_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
shown AS (
  SELECT *, regexp_matches(text, '<\\*\|') OR regexp_matches(role, '<\\*\|') OR contains(role, chr(10)) AS conflict,
    replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>') AS safe_role,
    regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS safe_text FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + CASE WHEN conflict THEN length(safe_role) + length(safe_text)
    ELSE length(role) + length(text) END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""


@query("op4_format_chats", _CHAT_SQL)
def op4_format_chats(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


@query("op6_find_benchmark")
def op6_find_benchmark(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.digests(decontamination.find_passages(docs, table(spark, folder, "benchmark")))


@query("op8_detect_language")
def op8_detect_language(spark, folder):
    docs = table(spark, folder, "documents")
    return language.decisions(language.predict(docs, language.fit(docs)))


@query("op9_score_toxicity")
def op9_score_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.decisions(toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels"))))


@query("op10_rank_quality")
def op10_rank_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.decisions(quality.score(docs, quality.fit(docs, table(spark, folder, "labels"))))


@query("op2_score_language_model")
def op2_score_language_model(spark, folder):
    docs = table(spark, folder, "documents")
    train = language_model.training_rows(docs)
    lex = language_model.lexicon(train)
    return language_model.score(docs, lex, language_model.train(train, lex))


@query("op5_join_shingles")
def op5_join_shingles(spark, folder):
    return jaccard.join_texts(table(spark, folder, "documents"), words=4, percent=85)


@query("op1_link_vectors")
def op1_link_vectors(spark, folder):
    return embeddings.link_vectors(table(spark, folder, "embeddings"))


_LICENCES_SQL = f"""
WITH known(licence_id, text) AS (VALUES {", ".join("('" + i + "', '" + t.replace("'", "''") + "')" for i, t in licenses.KNOWN)}),
texts AS (SELECT doc_id, text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents),
known_digests AS (SELECT sha256({licenses.canonical_sql("text")}) AS digest, min(licence_id) AS licence_id FROM known GROUP BY 1),
quoted AS (SELECT doc_id, string_agg(DISTINCT licence_id, ',' ORDER BY licence_id) AS line_licences
  FROM lines JOIN known_digests ON sha256({licenses.canonical_sql("lines.text")}) = digest GROUP BY doc_id)
SELECT t.doc_id, t.digest, k.licence_id, coalesce(q.line_licences, '') AS line_licences
FROM (SELECT doc_id, sha256({licenses.canonical_sql("text")}) AS digest FROM texts) t
LEFT JOIN known_digests k ON k.digest = t.digest LEFT JOIN quoted q ON q.doc_id = t.doc_id"""


@query("op7_scan_licences", _LICENCES_SQL)
def op7_scan_licences(spark, folder):
    docs, known = table(spark, folder, "documents").select("doc_id", "text"), licenses.known_table(spark)
    quoted = licenses.scan_lines(docs, known).groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("licence_id")), ",").alias("line_licences")
    )
    return licenses.scan(docs, known).join(quoted, "doc_id", "left").na.fill("", ["line_licences"])


_WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_MIX_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, CAST({_WORDS_SQL} AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12) AS BIGINT) AS draw FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM rows GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS bound FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER before, 0)) / sum(weight) OVER after AS level FROM weighed
  WINDOW before AS (ORDER BY bound / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY bound / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
free AS (
  SELECT *, first(CASE WHEN level * weight < bound THEN level END IGNORE NULLS) OVER (ORDER BY bound / weight, rank) AS common FROM levels),
goals AS (SELECT source, rank, source_size, coalesce(common * weight, bound) AS target FROM free),
sizes AS (
  SELECT g.rank, g.source_size, target, size, count(*) AS n, CAST(floor(target / g.source_size) AS BIGINT) AS copies,
    CAST(floor(target + 0.5) AS BIGINT) - CAST(floor(target / g.source_size) AS BIGINT) * g.source_size AS rest
  FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source WHERE size > 0 GROUP BY ALL),
cut AS (
  SELECT *, rest - coalesce(sum(size * n) OVER (PARTITION BY rank ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(CAST(size AS HUGEINT) * size * n) OVER (PARTITION BY rank ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS squares
  FROM sizes),
plan AS (
  SELECT rank, any_value(copies) AS copies, coalesce(max(size) FILTER (WHERE size * left_over < squares), 0) + 1 AS certain,
    coalesce(CAST(arg_max(left_over, size) FILTER (WHERE size * left_over < squares) AS BIGINT), 0) AS wanted,
    CAST(arg_max(squares, size) FILTER (WHERE size * left_over < squares) AS DOUBLE) AS squares
  FROM cut GROUP BY rank),
placed AS (
  SELECT doc_id, size, draw, g.rank, g.source_size, target, copies, certain, wanted,
    (draw + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u, CAST(size AS DOUBLE) * (CAST(wanted AS DOUBLE) / squares) AS l
  FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source LEFT JOIN plan p ON p.rank = g.rank),
ranked AS (
  SELECT *, CASE WHEN size > 0 AND size < certain AND wanted > 0
    THEN CAST(floor(u * (1 - l) / (u * (1 - l) + (1 - u) * l) * 281474976710656.0::DOUBLE) AS BIGINT) END AS place FROM placed),
summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY rank, place IS NULL ORDER BY place, draw, size, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ranked)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE copies * size
  + CASE WHEN place IS NOT NULL THEN greatest(0, least(size, wanted - before)) WHEN size >= certain THEN size ELSE 0 END END AS BIGINT) AS taken
FROM summed"""


@query("op11_mix_sources", _MIX_SQL)
def op11_mix_sources(spark, folder):
    return mixing.digests(mixing.mix(table(spark, folder, "documents")))


_NEGATIVES_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
positives AS (
  SELECT a.vec_id AS anchor_id, a.label, a.v, p.vec_id AS positive_id, CAST(list_inner_product(a.v, p.v) AS BIGINT) AS positive_score
  FROM rows a JOIN rows p ON a.label = p.label AND a.vec_id <> p.vec_id WHERE a.vec_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, p.vec_id) <= 5),
scores AS (
  SELECT a.vec_id AS anchor_id, n.vec_id AS negative_id, CAST(list_inner_product(a.v, n.v) AS BIGINT) AS negative_score
  FROM rows a JOIN rows n ON a.label <> n.label WHERE a.vec_id % 100 = 0)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
  negative_id, positive_score, negative_score
FROM positives JOIN scores USING (anchor_id) WHERE 30 * positive_score <= 100 * negative_score AND 100 * negative_score <= 90 * positive_score
QUALIFY rank <= 10"""


@query("op12_mine_negatives", _NEGATIVES_SQL)
def op12_mine_negatives(spark, folder):
    vec = F.col("vec_id")
    rows = table(spark, folder, "embeddings")
    rows = rows.withColumn("label", F.when(vec % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, vec % 100 == 0)


_TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(id) + 1), lambda i: CAST(ord(id[i]) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END)),
    CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, p, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND p > h),
seqs AS (
  SELECT c.conv_id, coalesce(s, []) AS s FROM convs c
  LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, p) AS s FROM rebuilt GROUP BY conv_id) r ON r.conv_id = c.conv_id),
prefixes AS (SELECT conv_id, len(s) AS n, d, s[1:d] AS path FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^ 	-
]+')) END AS words
  FROM prefixes GROUP BY path, d),
children AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path),
below AS (
  SELECT path[1:d] AS path, d AS depth, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1, 2)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.depth = c.depth AND b.path = c.path
LEFT JOIN nodes u ON u.depth = c.depth - 1 AND u.path = c.path[1:c.depth - 1]"""


@query("op13_build_trie", _TRIE_SQL)
def op13_build_trie(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.conversations(rows)))
