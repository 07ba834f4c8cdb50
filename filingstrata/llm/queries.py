"""One query per operator over its whole table; each takes (spark, folder of the Parquet tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, copies, decontaminate, jaccard, mixing, neighbours, ngram_lm, passages, preferences, tokens, toxicity, tries, urls
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item within its error budget, with the place."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic spans and scores of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of every document that repeat a passage of another one."""
    return passages.find_passages(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the url of every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a trigram Kneser-Ney model of nine tenths of them."""
    return ngram_lm.score_corpus(table(spark, sf_dir, "documents"), order=3)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of five-word shingles are at least 0.8 alike."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.93."""
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mixture of its sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    return mixing.interleave(docs)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as the preferred one of a pair, with its prompt and both completions.

    The arrays of text and mask are joined to one string each, so that rows compare as text.
    """
    done = preferences.format_pairs(preferences.pairs_by_next(table(spark, sf_dir, "conversations")))
    mask = lambda c: F.concat_ws("", F.transform(c, lambda s: F.repeat(s["mask"].cast("string"), F.length(s["text"]))))
    return done.select(
        F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen_text", "rejected_text",
        F.md5(mask("chosen")).alias("chosen_mask"), F.md5(mask("rejected")).alias("rejected_mask"),
        "n_chosen_trained", "n_rejected_trained", "usable",
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 50k byte-level vocabulary."""
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every group of equal texts the document that stays."""
    return copies.exact_copies(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all conversations, first turns taken from the first of their twenty."""
    convs = tries.conversations(table(spark, sf_dir, "conversations"))
    return tries.prefix_nodes(tries.with_shared_heads(convs)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under both vocabularies aligned, scored by the pairs of the whole corpus."""
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_corpus(table(spark, sf_dir, "documents"), *paths)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_toxicity, op3_substring_dedup, op4_url_filter, op5_lm_scoring,
        op6_ngram_jaccard_join, op7_embedding_near_dedup, op8_source_mixing, op9_chat_formatting, op10_token_counts,
        op11_exact_dedup, op12_prefix_trie, op13_token_alignment,
    )
}

ORACLES = {
    "op6_ngram_jaccard_join": """
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM lists WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id
""",
    "op9_chat_formatting": """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
), finals AS (
  SELECT conv_id - 1 AS conv_id, text AS other FROM numbered WHERE i = n
), rejected AS (
  SELECT a.conv_id, a.i, a.role, CASE WHEN a.i = a.n THEN f.other ELSE a.text END AS text
  FROM numbered a LEFT JOIN finals f USING (conv_id) WHERE a.i < a.n OR f.conv_id IS NOT NULL
), lengths AS (
  SELECT a.conv_id, max(a.n) AS n,
         coalesce(min(a.i) FILTER (WHERE r.i IS NULL OR coalesce(a.text, '') <> coalesce(r.text, '')), max(a.n) + 1) - 1 AS k
  FROM numbered a LEFT JOIN rejected r ON a.conv_id = r.conv_id AND a.i = r.i GROUP BY a.conv_id
), sides AS (
  SELECT 'chosen' AS side, conv_id, i, role, text FROM numbered
  UNION ALL SELECT 'rejected', conv_id, i, role, text FROM rejected
), parts AS (
  SELECT s.side, s.conv_id, s.i, l.k, '<|turn|>' || coalesce(role, '') || chr(10) AS head,
         coalesce(text, '') || '<|end|>' || chr(10) AS body, coalesce(role, '') = 'assistant' AS answer
  FROM sides s JOIN lengths l USING (conv_id)
), done AS (
  SELECT conv_id,
    coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 'chosen' AND i <= k), '') AS prompt,
    coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 'chosen' AND i > k), '') AS chosen_text,
    coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 'rejected' AND i > k), '') AS rejected_text,
    md5(coalesce(string_agg(repeat('0', length(head)) || repeat(CASE WHEN answer THEN '1' ELSE '0' END, length(body)), '' ORDER BY i)
        FILTER (WHERE side = 'chosen' AND i > k), '')) AS chosen_mask,
    md5(coalesce(string_agg(repeat('0', length(head)) || repeat(CASE WHEN answer THEN '1' ELSE '0' END, length(body)), '' ORDER BY i)
        FILTER (WHERE side = 'rejected' AND i > k), '')) AS rejected_mask,
    coalesce(sum(length(body)) FILTER (WHERE side = 'chosen' AND i > k AND answer), 0)::BIGINT AS n_chosen_trained,
    coalesce(sum(length(body)) FILTER (WHERE side = 'rejected' AND i > k AND answer), 0)::BIGINT AS n_rejected_trained
  FROM parts GROUP BY conv_id
)
SELECT d.conv_id, l.k::INTEGER AS n_prompt_turns, prompt, chosen_text, rejected_text, chosen_mask, rejected_mask,
       n_chosen_trained, n_rejected_trained, n_chosen_trained > 0 AND n_rejected_trained > 0 AS usable
FROM done d JOIN lengths l USING (conv_id)
""",
    "op11_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op12_prefix_trie": """
WITH own AS (
  SELECT conv_id, coalesce(text, '') AS text, sha256(sha256(coalesce(role, '')) || coalesce(text, '')) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(sha256(coalesce(role, '')) || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,  -- crc32, byte by byte and bit by bit, of the decimal id
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
           lambda c: list_prepend(ascii(c)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), rebuilt AS (
  SELECT ids.conv_id, i, text, said FROM ids JOIN own o ON o.conv_id = ids.base AND o.i <= ids.h
  UNION ALL SELECT conv_id, i, text, said FROM own JOIN ids USING (conv_id) WHERE i > h
), numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, said,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt
), paths AS (
  SELECT conv_id, d, words, md5(string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), nodes AS (
  SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY node, d
), linked AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.d = n.depth - 1
), children AS (
  SELECT parent AS node, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT p.node, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((l.n_convs - 1) * l.words) AS saved
  FROM linked l LEFT JOIN children c USING (node) JOIN paths p ON p.conv_id = l.conv_id AND p.d <= l.depth GROUP BY p.node
), lengths AS (
  SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id
), ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths JOIN lengths USING (conv_id, d) GROUP BY node
)
SELECT l.conv_id, l.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, l.n_convs, coalesce(c.n, 0) AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM linked l JOIN below b USING (node) LEFT JOIN children c USING (node) LEFT JOIN ends e USING (node) LEFT JOIN nodes q ON q.node = l.parent
""",
}
