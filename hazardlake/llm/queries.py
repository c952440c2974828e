"""One registered query for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import alignment, archive, fingerprints, language, licenses, neighbours, packing, surrogates, toxicity, trie
from hazardlake.llm.near_dedup import near_groups
from hazardlake.llm.pieces import encode_texts
from hazardlake.llm.span_dedup import without_repeats

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


#: Sets of shingles, all pairs that share one, and what can be reached over the similar ones.
_NEAR = r"""WITH RECURSIVE split AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
    listed AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5
        THEN [array_to_string(words, ' ')] ELSE list_transform(range(1, len(words) - 3),
        lambda i: array_to_string(words[i:i + 4], ' ')) END AS shingles FROM split),
    sets AS (SELECT DISTINCT doc_id, unnest(shingles) AS shingle FROM listed),
    sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS met FROM sets a
        JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * met >= 75 * (x.n + y.n - met)),
    steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT a AS doc_id, a AS other FROM steps
        UNION SELECT r.doc_id, s.b FROM reached r JOIN steps s ON r.other = s.a),
    least AS (SELECT doc_id, MIN(other) AS low FROM reached GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, d.doc_id) AS component_id,
        coalesce(low, d.doc_id) = d.doc_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    encoded = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), round_trip=True, keep=["doc_id"])
    return encoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


ORACLES["op2_near_duplicates"] = _NEAR


@_query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_documents(spark, sf_dir)).drop("text_hash")


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(_documents(spark, sf_dir))
    return cut.select("row.doc_id", F.col("kept_text").alias("text"), "sentences", "removed")


@_query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    aside = language.held_out(F.col("doc_id"), 3, 1)
    model = language.fit(docs.filter(~aside))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "row.doc_id",
        language.held_out(F.col("row.doc_id"), 3, 1).alias("held_out"),
        F.col("language").alias("lang_pred"),
        "score",
        "rejected",
    )


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), packing.word_count(F.col("text")))


#: Key of the registered surrogates; a production job passes its own secret.
SURROGATE_KEY = "registered-query"


@_query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = surrogates.with_surrogates(_documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)
    return masked.select("row.doc_id", F.col("masked").alias("text"), "replaced")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Trained on the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.fit(_documents(spark, sf_dir), labels.filter(~language.held_out(F.col("doc_id"), 4, 2)))


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir))
    return scored.select(
        "row.doc_id",
        language.held_out(F.col("row.doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )


@_query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_notices(_documents(spark, sf_dir).select("doc_id", "text"))
    return licenses.digest(found).select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@_query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 50 == 0, 5)


@_query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(_documents(spark, sf_dir))


@_query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    models = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = alignment.align(_documents(spark, sf_dir).select("doc_id", "text"), *models, keep=["doc_id"])
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


ORACLES["op13_warc"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    named AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
    firsts AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first FROM named)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM firsts"""


@_query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return records.select(
        "page_id",
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


#: Sequences are told apart by a digest of all turns up to each; the crc32 is taken bit by bit.
_TRIE = """WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split(conv_id::VARCHAR, ''), lambda d: [unicode(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
        AS crc FROM (SELECT DISTINCT conv_id FROM t)),
    h AS (SELECT conv_id, xor(crc, 4294967295) % 6 AS h FROM c),
    r AS (SELECT h.conv_id, 0 AS kind, t.i, role, text FROM h JOIN t
            ON t.conv_id = h.conv_id - h.conv_id % 100 AND t.i <= h
        UNION ALL SELECT conv_id, 1, i, role, text FROM t JOIN h USING (conv_id) WHERE i > h),
    n AS (SELECT conv_id, row_number() OVER w AS depth, length(text) AS size,
            sha256(string_agg(sha256(role) || sha256(text), '') OVER w) AS key
        FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY kind, i)),
    s AS (SELECT * FROM n UNION ALL SELECT conv_id, 0, 0, '' FROM h),
    ends AS (SELECT conv_id, MAX(depth) AS depth FROM s GROUP BY conv_id),
    nodes AS (SELECT s.depth, key, MIN(s.conv_id) AS conv_id, COUNT(*) AS n_convs, MIN(size) AS size,
            sha256(coalesce(string_agg(ends.conv_id::VARCHAR, ',' ORDER BY ends.conv_id), '')) AS ends_sha256
        FROM s LEFT JOIN ends ON ends.conv_id = s.conv_id AND ends.depth = s.depth GROUP BY s.depth, key),
    up AS (SELECT nodes.*, p.conv_id AS parent_conv_id, p.key AS parent_key FROM nodes
        LEFT JOIN s ON s.conv_id = nodes.conv_id AND s.depth = nodes.depth - 1
        LEFT JOIN nodes p ON p.depth = s.depth AND p.key = s.key),
    kids AS (SELECT depth - 1 AS depth, parent_key AS key, COUNT(*) AS n_children FROM up
        WHERE parent_key IS NOT NULL GROUP BY 1, 2),
    whole AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (depth, key)),
    below AS (SELECT s.depth, s.key, COUNT(*) FILTER (n_children = 0) AS n_leaves,
            SUM((w.n_convs - 1) * w.size) AS saved_tokens
        FROM whole w JOIN s ON s.conv_id = w.conv_id AND s.depth <= w.depth GROUP BY s.depth, s.key)
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves,
        saved_tokens::BIGINT AS saved_tokens, ends_sha256 FROM whole JOIN below USING (depth, key)"""

ORACLES["op12_prefix_trie"] = _TRIE


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), trie.borrowed_openings)
