"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airdata.llm import ann, language, lm, minhash, mixing, negatives, packing, quality_rules, rule_ensemble, sharding, token_files, trie, warc
from airdata.llm.common import table
from airdata.llm.tokens import vocabulary

#: Production parameters of the dealt queries.
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: sets of 4 words, 80 per cent of the union."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to token files in the order of doc_id and read back."""
    shards = token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, shards, ids=False)


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target of the quality rules: documents labelled as good."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and n-gram likelihood ratio of all documents."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted_documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids; only the digests of the ids go along."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), order=("doc_id", "piece", "ids_crc32"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document by its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(docs, ["doc_id"], SHARDS)


def remainder(key, n: int):
    """crc32 of an id as text, modulo n; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a rule ensemble that learns from four fifths of the labels."""
    held_out = remainder("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored, _ = rule_ensemble.classify(table(spark, sf_dir, "documents"), labels, ~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix of all documents takes of each: sources weigh 5, 2, 1 in turn, up to 3 times their size."""
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record of a ZIP package and read back from there."""
    packages = warc.write_packages(table(spark, sf_dir, "pages"))
    return warc.read_packages(spark, packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of all documents under the context mixing model of six sevenths of them."""
    held_out = remainder("doc_id", 7) == 2
    docs = table(spark, sf_dir, "documents")
    scored = lm.score(docs, ~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations with the totals of every subtree."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of every seventh are moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.hard_negatives(vectors, F.col("key") % 100 == 0)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; every text with letters gets the nearest language, ``rejected`` tells whether it is far."""
    held_out = remainder("doc_id", 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~held_out)
    told = language.predict(docs.select("doc_id", "text"), model, reject=False)
    return told.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (pipeline, op1_minhash_near_dedup, op2_token_files, op3_quality_rules, op4_packing, op5_sharding, op6_rule_ensemble, op7_mixing,
                                   op8_permutation_index, op9_warc, op10_context_mixing, op11_prefix_trie, op12_hard_negatives, op13_language_id)}


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS n, b.n AS m, count(*) AS k
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL
), links AS (
  SELECT u, v FROM common WHERE 100 * k >= 80 * (n + m - k)
), both_ways AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT u AS node, v AS seen FROM both_ways
  UNION
  SELECT r.node, b.v FROM reach r JOIN both_ways b ON r.seen = b.u
), least AS (
  SELECT node, min(seen) AS seen FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.seen, s.doc_id)) AS component_id,
  least(s.doc_id, coalesce(l.seen, s.doc_id)) = s.doc_id AS kept
FROM sets s LEFT JOIN least l ON l.node = s.doc_id
"""

OP9_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS payload_digest FROM pages
), o AS (
  SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < original THEN original END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""


OP11_SQL = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (  -- crc32 of the decimal number, a byte and a bit at a time
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM own GROUP BY conv_id
), turns AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), placed AS (
  SELECT conv_id, row_number() OVER w AS depth, len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
    string_agg(sha256(sha256(role) || sha256(text)), '') OVER w AS path
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
), members AS (
  SELECT conv_id, depth, words, path, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM placed
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM placed) FROM convs
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth
), marked AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[:64 * n.depth] = n.path) AS n_children FROM nodes n
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
  CAST(count(*) FILTER (WHERE u.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens, v.ends_sha256
FROM marked v JOIN marked u ON u.depth >= v.depth AND u.path[:64 * v.depth] = v.path
LEFT JOIN marked p ON p.depth = v.depth - 1 AND p.path = v.path[:64 * p.depth]
GROUP BY ALL
"""


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""


def op5_sql() -> str:
    """The table is data of the shards alone; hashing and placement are SQL's own."""
    slots = ",".join(map(str, sharding.fill(SHARDS)))
    names = ",".join(f"'{s}'" for s in SHARDS)
    return f"""
WITH lookup AS (SELECT [{slots}] AS slots, [{names}] AS names),
d AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce('v' || CAST(doc_id AS VARCHAR), 'n')), 1, 15) AS BIGINT) % {sharding.SLOTS} AS slot FROM documents)
SELECT doc_id, slot, names[slots[slot + 1] + 1] AS shard FROM d, lookup
"""


def oracle_sql():
    return {"op1_minhash_near_dedup": OP1_SQL, "op5_sharding": op5_sql(), "op9_warc": OP9_SQL, "op11_prefix_trie": OP11_SQL, "op12_hard_negatives": OP12_SQL}
