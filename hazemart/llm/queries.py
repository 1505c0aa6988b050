"""The registered queries of this subpackage and the SQL they are checked against, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemart.llm import bag_minhash, bilinear_lm, decontaminate, language_crf, line_spread, page_wrappers, piece_sampling, prefix_trie, quality_rules, ranked_search, surrogates, token_counts, vector_links

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bag_minhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, folder, "documents"))


@query("op2_line_spread", """
WITH lines AS (SELECT doc_id, source, trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
spread AS (
  SELECT line, min(doc_id) AS first_id FROM lines WHERE regexp_matches(line, '\\S')
  GROUP BY line HAVING count(DISTINCT source) >= 5
),
gone AS (
  SELECT l.doc_id, list(DISTINCT l.line) AS gone FROM lines l JOIN spread s ON l.line = s.line AND l.doc_id <> s.first_id
  GROUP BY l.doc_id
),
parts AS (
  SELECT d.doc_id, string_split(coalesce(d.text, ''), chr(10)) AS parts, d.text IS NULL AS missing, coalesce(g.gone, []) AS gone
  FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id
),
kept AS (SELECT *, list_filter(parts, lambda x: NOT list_contains(gone, trim(x))) AS kept FROM parts)
SELECT doc_id, CASE WHEN missing THEN 0 ELSE len(parts) END AS n_lines, len(parts) - len(kept) AS n_removed,
  md5(array_to_string(kept, chr(10))) AS text_md5
FROM kept
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = line_spread.remove_spread_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def remainder(divisor: int) -> Column:
    """Of the fold of a document; one without an id is in the fold of an empty id, so that no condition on it is null."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


@query("op4_piece_sampling")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return piece_sampling.sampled_segmentations(
        table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model")
    )


@query("op5_language_crf")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_crf.fit_documents(docs, remainder(4) != 2)
    found = language_crf.predict(docs, model)
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op3_vector_links")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return vector_links.linked_vectors(table(spark, folder, "embeddings"))


@query("op6_decontaminate")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_bilinear_lm")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = bilinear_lm.scored(table(spark, folder, "documents"), remainder(10) != 0)
    return found.withColumn("held_out", remainder(10) == 0)


@query("op8_token_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op9_surrogates")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    replaced = surrogates.with_surrogates(table(spark, folder, "documents"), secret="corpus")
    return replaced.select(
        "doc_id", F.size("entities").cast("long").alias("n_entities"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
        F.concat_ws(",", F.transform("entities", lambda e: F.concat_ws(":", e["type"], e["start"], e["end"]))).alias("spans"),
        "n_collisions", F.col("text").alias("text"),
    )


@query("op10_quality_rules")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_rules.fit(docs, table(spark, folder, "labels"), remainder(4) != 2)
    return quality_rules.scored(docs, model).withColumn("held_out", remainder(4) == 2)


@query("op11_ranked_search", """
WITH words AS (
  SELECT rowid AS doc, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
),
postings AS (SELECT doc, doc_id, term, count(*) AS tf FROM words GROUP BY doc, doc_id, term),
lengths AS (SELECT doc, sum(tf)::BIGINT AS n FROM postings GROUP BY doc),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
normal AS (SELECT doc, 50 + (50 * n * docs) // total AS m FROM lengths, whole),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
  FROM benchmark
),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * holders + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS holders FROM postings WHERE term IN (SELECT term FROM wanted) GROUP BY term), whole
),
scores AS (
  SELECT item_id, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN normal USING (doc)
  GROUP BY item_id, doc, doc_id
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"), top=50)


@query("op12_prefix_trie", """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), id) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(
      list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
  FROM turns GROUP BY conv_id
),
sized AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON c.base = b.conv_id),
rebuilt AS (
  SELECT s.conv_id, t.k AS d, t.id, t.text FROM sized s JOIN turns t ON t.conv_id = s.base AND t.k <= s.h
  UNION ALL
  SELECT s.conv_id, s.taken + t.k - s.h AS d, t.id, t.text FROM sized s JOIN turns t ON t.conv_id = s.conv_id AND t.k > s.h
),
paths AS (
  SELECT conv_id, d, strlen(text) AS bytes, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
),
lengths AS (SELECT conv_id, max(d) AS len FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, d, max(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = d), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, d
),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
known AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (path)),
above AS (SELECT left(path, 32 * unnest(range(0, d + 1))) AS path, n_children = 0 AS leaf, (n_convs - 1) * bytes AS saved FROM known),
sums AS (SELECT path, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY path)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM known n JOIN sums s USING (path) LEFT JOIN known p ON n.d > 0 AND p.path = left(n.path, length(n.path) - 32)
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


# the SQL knows how these pages mark their articles; the query has to find that out
@query("op13_page_wrappers", """
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS inner_html FROM pages
),
blocks AS (
  SELECT page_id, url, list_transform(
    regexp_split_to_array(inner_html, '</?(?:p|h1)>'),
    lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(
      regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))) AS parts
  FROM articles
),
texts AS (SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '') AS text FROM blocks)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return page_wrappers.main_texts(table(spark, folder, "pages"))
