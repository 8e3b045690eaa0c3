"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontam, exact_dedup, html_extract, langid, lexical, licences, packing, pii, quality, sharding, simhash,
               spelling)
from .common import table


def fold(doc_id: Column, of: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def language_rows(docs: DataFrame) -> DataFrame:
    """The rows that language models may learn from."""
    return docs.where(fold(F.col("doc_id"), 4) != 2)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", F.col("size").cast("long").alias("group_size"), "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = quality.learn(spark, docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return quality.score(spark, docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(spark, table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.contamination(spark, docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP4_SQL = r"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), (SELECT p FROM word)) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), (SELECT p FROM word)) AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
              array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.Tokenizer(spark))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.spans(docs, pii.model(spark)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.concat_ws(",", "base"), 256).alias("base_sha256"), F.concat_ws(",", "spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(spark, docs.select("doc_id", "text"), langid.learn(spark, language_rows(docs)))
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = licences.scan(spark, docs, licences.learn(spark, docs))
    return out.select(F.col("id").alias("doc_id"), F.concat_ws(",", "families").alias("families"),
                      F.concat_ws(",", "lines").alias("lines"), "n_confirmed", "n_unconfirmed", "score")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lexical.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


OP11_SQL = r"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS p),
lower_of AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), (SELECT a FROM lower_of), (SELECT b FROM lower_of)),
             (SELECT p FROM word)) AS t FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), (SELECT a FROM lower_of),
             (SELECT b FROM lower_of)), (SELECT p FROM word))) AS term FROM benchmark),
stats AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
held AS (SELECT doc_id, n, term, count(*) AS tf
         FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM held, stats GROUP BY term, n_docs),
asked AS (SELECT item_id, term, count(*) AS repeats FROM q GROUP BY item_id, term),
scored AS (SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf)
                  // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // total))))) AS BIGINT) AS score
           FROM asked JOIN w USING (term) JOIN held USING (term), stats GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(spark, table(spark, sf_dir, "documents"), packing.Tokenizer(spark), with_ids=False)
    return out.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_sharding": op3_sharding,
    "op4_decontamination": op4_decontamination,
    "op5_bpe": op5_bpe,
    "op6_pii": op6_pii,
    "op7_language": op7_language,
    "op8_simhash": op8_simhash,
    "op9_licences": op9_licences,
    "op10_html": op10_html,
    "op11_lexical": op11_lexical,
    "op12_spelling": op12_spelling,
    "op13_packing": op13_packing,
}

ORACLE = {
    "op1_exact_dedup": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op11_lexical": OP11_SQL,
}
