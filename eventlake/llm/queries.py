"""The registered queries of the text operators, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import decontam, fixity, language, linededup, mixing, neardup, negatives, ngrams, pieces, prefixes, quality, tokens, toxicity
from eventlake.llm.tables import remainder, stored, table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte convolutional network, learned from two thirds of the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    net = language.train_language(docs.where(remainder("doc_id", 3) != 1))
    return language.identify_language(docs, net).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """b-bit MinHash on two-word shingles: components of documents at 80 percent or more."""
    docs = table(spark, sf_dir, "documents")
    found = neardup.near_duplicates(docs.select(F.col("doc_id").alias("id"), "text"), size=2)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block quotas from a hypergeometric splitting tree: what the mix takes of each document, and for which shards."""
    docs = table(spark, sf_dir, "documents")
    rows = stored(mixing.sized(docs, ["doc_id"]), "sizes")
    return mixing.draw(rows).select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards")


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, by BM25 with block-max pruning and verified overlap."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees over document statistics, fitted to the quality labels."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality_rules(docs, quality.train_quality(docs, table(spark, sf_dir, "labels")))


def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC files, and a replica in which every 1009th record is damaged, audited by Merkle trees."""
    return fixity.audited(table(spark, sf_dir, "pages"), 1009, 7)


OP6_SQL = """
WITH records AS (
  SELECT page_id, chr(0) || 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
    || chr(13) || chr(10) || chr(13) || chr(10) AS bytes
  FROM pages)
SELECT page_id, CAST(strlen(bytes) - 1 AS BIGINT) AS n_bytes, sha256(bytes) AS digest,
       CASE WHEN page_id % 1009 = 7 THEN 'corrupt' ELSE 'intact' END AS state
FROM records
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or of sentence scores, learned from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    return toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted",
        F.transform("spans", lambda s: s["sentence"]).alias("sentences"))


def op8_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted backoff automaton over nine tenths of the corpus, scoring all of it."""
    docs = table(spark, sf_dir, "documents")
    return ngrams.score_texts(docs, remainder("doc_id", 10) != 0).select(
        "doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids in packed blocks, written in document order and read back."""
    return tokens.tokenized(table(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus, by content-defined line chunks: one row for each document that has some."""
    found = linededup.repeated_passages(table(spark, sf_dir, "documents"))
    span = F.struct("start", "end", "n_lines", "n_words", "first_doc_id")
    return found.groupBy("doc_id", "key").agg(F.sum("n_words").alias("removed_words"), F.array_sort(F.collect_list(span)).alias("passages")).drop("key")


def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of rebuilt conversations: identical ones collapsed, leaves by anti-join, weighted prefixes aggregated."""
    trie = prefixes.prefix_trie(*prefixes.rebuilt(table(spark, sf_dir, "conversations")))
    return trie.nodes.join(prefixes.ends_digest(trie.ends), ["conv_id", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


# crc32 bit by bit, as SQL has no function for it.
OP11_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns,
         xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
           lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 4 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, coalesce(o.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
  FROM own c LEFT JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '') AS ends
  FROM steps GROUP BY ALL),
links AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         CASE WHEN n.depth = 0 THEN 0 ELSE len(regexp_extract_all(n.path[n.depth].text, '[^\x20\x09-\x0D]+')) END AS words,
         NOT EXISTS (SELECT 1 FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS childless
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
up AS (SELECT path, depth, n_convs, words, childless, unnest(range(0, depth + 1)) AS above FROM links),
sums AS (
  SELECT above, path[1:above] AS top, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (WHERE childless) AS n_leaves,
         count(*) FILTER (WHERE depth = above + 1) AS n_children
  FROM up GROUP BY ALL)
SELECT conv_id, l.depth, parent_conv_id, l.n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM links l JOIN sums s ON s.above = l.depth AND s.top = l.path
"""


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents by an agenda of symbol pairs, and the text that they decode to."""
    found = pieces.encode_pieces(table(spark, sf_dir, "documents"), decoded=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, from lists sorted once for each cluster of anchors."""
    vectors = table(spark, sf_dir, "embeddings").where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
hard AS (
  SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank,
         n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5
"""


QUERIES = {f.__name__: f for f in (op1_language, op2_neardup, op3_mixing, op4_decontam, op5_quality, op6_fixity, op7_toxicity, op8_ngrams, op9_tokens, op10_passages,
                                  op11_prefixes, op12_pieces, op13_negatives)}
SQL: dict[str, str] = {"op6_fixity": OP6_SQL, "op11_prefixes": OP11_SQL, "op13_negatives": OP13_SQL}
