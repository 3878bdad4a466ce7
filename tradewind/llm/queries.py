"""The corpus operators as named queries over the whole tables of a folder, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.storage import fresh_path
from tradewind.llm import chats, exact, idfile, lines, mixing, neardup, packing, pages, passages, pii, quality, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _named(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_named
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find(_table(spark, sf_dir, "documents"))


@_named
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find(_table(spark, sf_dir, "documents"))


ORACLE["op2_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     r AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                  first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""


@_named
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    idfile.write(_table(spark, sf_dir, "documents"), path)
    return idfile.index(spark, path)


@_named
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs))


@_named
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


@_named
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.find(_table(spark, sf_dir, "documents"))


ORACLE["op6_line_dedup"] = r"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
             FROM documents),
     l AS (SELECT doc_id, line_no, list_filter(regexp_split_to_array(
               translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS words
           FROM raw WHERE regexp_matches(line, '[^ 	-
]')),
     c AS (SELECT words, min(doc_id * 2147483648 + line_no) AS first, row_number() OVER () AS class FROM l GROUP BY words),
     s AS (SELECT class, unnest(list_distinct(CASE WHEN len(words) < 5 THEN [words] ELSE
               list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4]) END)) AS shingle FROM c),
     n AS (SELECT class, count(*) AS n FROM s GROUP BY class),
     p AS (SELECT a.class AS a, b.class AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.class <> b.class GROUP BY ALL),
     m AS (SELECT p.a AS class, min(o.first) AS other FROM p JOIN n x ON x.class = p.a JOIN n y ON y.class = p.b JOIN c o ON o.class = p.b
           WHERE 100 * shared >= 75 * (x.n + y.n - shared) GROUP BY p.a),
     j AS (SELECT l.doc_id, l.line_no, NOT (l.doc_id * 2147483648 + l.line_no = c.first AND coalesce(m.other > c.first, true)) AS gone
           FROM l JOIN c ON c.words = l.words LEFT JOIN m ON m.class = c.class),
     g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                  string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (gone) AS removed FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN g ON g.doc_id = d.doc_id
"""


@_named
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


@_named
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_named
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


@_named
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_named
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@_named
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = _table(spark, sf_dir, "conversations")
    return chats.report(chat, chats.damage(chat))


@_named
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find(_table(spark, sf_dir, "documents")).drop("starts", "ends")
