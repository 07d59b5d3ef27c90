"""Registered queries of this package, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import (
    archives,
    chat,
    decontaminate,
    hard_negatives,
    mixing,
    ngram_join,
    quality_rules,
    quality_sampling,
    secret_scan,
    substring,
    token_counts,
    token_files,
    whitening,
)
from tastegraph.llm.common import WORD, fresh_path, read_table, stage


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    archives.write_warc(archives.pages_to_arc(read_table(spark, sf_dir, "pages")), path, least_bytes=0)
    return archives.read_warc(spark, path).drop("record")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = ngram_join.link_documents(read_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id", "links")


CONTROL = "</s>[INST] ok [/INST]"


def op3_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kind = "conv_id long, turn long, role string, text string"
    more = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], kind)
    formatted = stage(chat.format_paths(chat.turns_to_replies(turns.unionByName(more))), "formatted")
    back = chat.read_back(formatted)
    return back.withColumnRenamed("tree", "conv_id").withColumn("conv_id", F.expr("try_cast(conv_id AS BIGINT)"))


def op4_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_shared")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op6_rabin_karp_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.cut(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_files(read_table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_files.read_files(spark, path)


def op8_ngram_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_rules.score(docs, model)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return scored.select("doc_id", *counts, "base_failed", "kept", F.round("probability", 4).alias("probability"))


def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = quality_sampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return chosen.select("doc_id", "n_words", F.round("log_weight", 4).alias("log_weight"), "kept")


def op10_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    of_kind = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of_kind([k])).cast("long").alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(secret_scan.joined(of_kind(secret_scan.BASE)), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op12_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), label=label)


QUERIES = {
    "op1_arc_to_warc": op1_arc_to_warc,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_reply_tree_chat": op3_reply_tree_chat,
    "op4_minhash_containment": op4_minhash_containment,
    "op5_transducer_token_counts": op5_transducer_token_counts,
    "op6_rabin_karp_windows": op6_rabin_karp_windows,
    "op7_repair_token_files": op7_repair_token_files,
    "op8_ngram_quality_rules": op8_ngram_quality_rules,
    "op9_importance_resampling": op9_importance_resampling,
    "op10_pivotal_mixing": op10_pivotal_mixing,
    "op11_assignment_secrets": op11_assignment_secrets,
    "op12_bit_sliced_whitening": op12_bit_sliced_whitening,
    "op13_bond_hard_negatives": op13_bond_hard_negatives,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOWER_WORDS = rf"regexp_extract_all({_LOWER}, '{WORD}')"

_ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"

SQL: dict[str, str] = {
    "op3_reply_tree_chat": f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|turn|>' || replace({_ESCAPED.format("role")}, chr(10), '&#10;') || chr(10)
                || {_ESCAPED.format("text")} || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
""",
    # Every shingle of the documents against every shingle of the items.
    "op4_minhash_containment": rf"""
WITH item_words AS (SELECT item_id, {_LOWER_WORDS} AS w FROM benchmark),
item_grams AS (
    SELECT item_id, least(5, len(w)) AS width,
           unnest(list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                  lambda i: array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')))) AS gram
    FROM item_words WHERE len(w) > 0
),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_grams GROUP BY item_id),
doc_words AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
doc_grams AS (
    SELECT doc_id, width,
           unnest(list_distinct(list_transform(range(1, len(w) - width + 2),
                  lambda i: array_to_string(list_slice(w, i, i + width - 1), ' ')))) AS gram
    FROM doc_words, (SELECT DISTINCT width FROM item_grams)
),
shared AS (
    SELECT d.doc_id, i.item_id, count(*) AS n_shared
    FROM doc_grams d JOIN item_grams i ON d.gram = i.gram AND d.width = i.width GROUP BY d.doc_id, i.item_id
)
SELECT doc_id, s.item_id, n_item, n_shared FROM shared s JOIN sizes z ON s.item_id = z.item_id
WHERE 100 * n_shared >= 75 * n_item
""",
    # Shingles that two texts share are counted per pair of different sets; closure over links.
    "op2_ngram_jaccard_join": rf"""
WITH RECURSIVE doc_words AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
doc_sets AS (
    SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2),
           lambda i: array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')))) AS grams
    FROM doc_words WHERE len(w) > 0
),
keyed AS (SELECT doc_id, len(grams) AS size, sha256(array_to_string(grams, chr(10))) AS key, grams FROM doc_sets),
sets AS (SELECT key, min(doc_id) AS least, any_value(size) AS size, any_value(grams) AS grams FROM keyed GROUP BY key),
entries AS (SELECT least, unnest(grams) AS gram FROM sets),
pairs AS (
    SELECT a.least AS a, b.least AS b, count(*) AS shared
    FROM entries a JOIN entries b ON a.gram = b.gram AND a.least <> b.least GROUP BY a.least, b.least
),
linked AS (
    SELECT a, b FROM pairs p JOIN sets x ON p.a = x.least JOIN sets y ON p.b = y.least
    WHERE 100 * shared >= 75 * (x.size + y.size - shared)
),
reach AS (SELECT least AS a, least AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS links FROM linked GROUP BY a)
SELECT d.doc_id, coalesce(k.size, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id, coalesce(g.links, 0) AS links
FROM documents d LEFT JOIN keyed k ON d.doc_id = k.doc_id LEFT JOIN sets s ON k.key = s.key
LEFT JOIN roots r ON s.least = r.a LEFT JOIN degrees g ON s.least = g.a
""",
    # Every window of every document by its words; covered words by a running sum of window starts.
    "op6_rabin_karp_windows": rf"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc_words WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS key FROM places),
least AS (SELECT key, min(doc_id) AS doc_id FROM windows GROUP BY key),
repeated AS (SELECT x.doc_id, x.i FROM windows x JOIN least l ON x.key = l.key AND l.doc_id < x.doc_id),
word_rows AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
marked AS (
    SELECT t.doc_id, t.i, t.word,
           count(r.i) OVER (PARTITION BY t.doc_id ORDER BY t.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS covered
    FROM word_rows t LEFT JOIN repeated r ON t.doc_id = r.doc_id AND t.i = r.i
),
counted AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (covered) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (NOT covered) AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted c ON d.doc_id = c.doc_id
""",
    # Every row against every anchor.
    "op13_bond_hard_negatives": """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
           CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
    FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
     AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
}
