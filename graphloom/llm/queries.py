"""Each operator applied to its whole table, with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import (
    decontaminate, exact_dedup, host_trust, nn_descent, order_minhash, qdwh_whitening, role_repair, sentence_spans, severity, simple8b,
    tag_paths, turn_alignment, unigram,
)
from graphloom.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_tag_paths(spark: SparkSession, folder: str) -> DataFrame:
    return tag_paths.extract(table(spark, folder, "pages"))


@query("""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents
), items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark
), starts AS (
  SELECT item_id, ws, least(len(ws), 13) AS l, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS o
  FROM items WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item_id, l, array_to_string(ws[o : o + l - 1], ' ') AS phrase FROM starts
), places AS (
  SELECT rid, l, p, array_to_string(ws[p : p + l - 1], ' ') AS phrase
  FROM (SELECT rid, ws, l, unnest(range(1, len(ws) - l + 2)) AS p
        FROM docs, (SELECT DISTINCT l FROM windows) WHERE len(ws) >= l)
), met AS (
  SELECT rid, p, l, item_id FROM places JOIN windows USING (l, phrase)
), hit AS (
  SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(p, p + l)) AS w FROM met) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
""")
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key", "matches")


@query()
def op3_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_spans.remove_repeats(table(spark, folder, "documents"))


@query()
def op4_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    return role_repair.repair(table(spark, folder, "conversations"))


@query()
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return unigram.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op6_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return host_trust.verdicts(table(spark, folder, "pages"))


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return severity.severity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM docs JOIN groups USING (t)
""")
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query()
def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, folder, "documents")).drop("text_key")


@query()
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return simple8b.token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op11_qdwh_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return qdwh_whitening.whiten(table(spark, folder, "embeddings"))


@query()
def op12_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.near_vectors(table(spark, folder, "embeddings"))


@query()
def op13_turn_alignment(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return turn_alignment.repair(turn_alignment.damage(turns), turns.select("conv_id"))
