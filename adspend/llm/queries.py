"""Registered queries: each operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, hard_negatives, langid, quality, secret_scan, warc
from . import sentencepiece_codec as codec
from .decontaminate import mark_contamination
from .exact_dedup import exact_dedup
from .html_extract import extract
from .licenses import scan_licenses
from .near_dedup import near_classes

#: A SentencePiece model file, by its name among the public tokenizers.
PIECE_MODEL = "piece_bpe_32k.model"


#: Where this package lies, for Python workers started without it on their path
#: (local runs; on a cluster it is installed or passed with --py-files).
_HOME = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    env = spark.sparkContext.environment
    if _HOME not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_HOME, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model(name: str = PIECE_MODEL) -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def op1_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = codec.round_trip(docs, piece_model())
    return rows.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~out))
    return langid.predict(docs.select("doc_id", "text", out.alias("held_out")), model)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.payloads(folder, index)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"  # the contract's own conversation, full of control strings
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.format_turns(rows.unionByName(extra)))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_contamination(docs, table(spark, sf_dir, "benchmark"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), mixed=False)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan_secrets(docs, secret_scan.train(docs))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("bigint")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.prepare(table(spark, sf_dir, "embeddings"), label=label, anchor=vec_id % 100 == 0)
    return hard_negatives.mine(rows)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece_codec": op1_sentencepiece_codec,
    "op2_language_id": op2_language_id,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_near_dedup": op4_near_dedup,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_license_scan": op6_license_scan,
    "op7_chat_format": op7_chat_format,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_html_extract": op9_html_extract,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# the control strings of chat.CONTROL without their first character, for RE2
_CONTROL_REST = "|".join(re.sub(r"([|\[\]])", r"\\\1", c[1:]) for c in sorted(chat.CONTROL, key=len, reverse=True))
_ESCAPED = rf"regexp_replace(t, '([<\[])(\\*)({_CONTROL_REST})', '\1\2\\\3', 'g')"

ORACLE: dict[str, str] = {
    "op4_near_dedup": rf"""
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                                   ELSE [list_slice(w, i, i + 4) for i in range(1, len(w) - 3)] END) AS g FROM word),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
                      FROM shingle x JOIN shingle y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL)
    JOIN size s ON s.doc_id = a JOIN size t ON t.doc_id = b WHERE 100 * k >= 85 * (s.n + t.n - k)),
side AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS v, doc_id AS u FROM word UNION SELECT v, b FROM reach JOIN side ON u = a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id, doc_id = m AS kept
FROM word LEFT JOIN size USING (doc_id) JOIN (SELECT v, min(u) AS m FROM reach GROUP BY v) ON v = doc_id""",
    "op5_warc_round_trip": """
SELECT page_id, strlen(h) AS payload_bytes, d AS payload_digest,
       CASE WHEN strlen(h) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, h, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS first
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))""",
    "op7_chat_format": rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS LAST, r, t)) AS turns_sha256,
       count(*) FILTER (r = 'assistant') AS n_examples,
       coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS LAST, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || r || chr(10) || {_ESCAPED} || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op8_benchmark_decontamination": rf"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k,
               unnest([list_slice(w, i, i + least(10, len(w)) - 1)
                       for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS g
        FROM item WHERE len(w) > 0),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT r, k, i, list_slice(w, i, i + k - 1) AS g
          FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM doc, (SELECT DISTINCT k FROM win) AS sizes)),
occ AS (SELECT r, i, win.k, item_id FROM place JOIN win ON place.k = win.k AND place.g = win.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM occ GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN its USING (r)""",
    "op10_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY n ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(n) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
WINDOW same AS (PARTITION BY n)""",
    "op12_hard_negatives": """
WITH part AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
           list_dot_product(a.v, b.v)::BIGINT AS score
    FROM part a JOIN part b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
pos AS (
    SELECT ar, anchor_id, br, id AS positive_id, score AS positive_score FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= 5)
SELECT pos.anchor_id, positive_id,
       row_number() OVER (PARTITION BY pos.ar, pos.br ORDER BY score DESC, id, pair.br)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN pair ON pair.ar = pos.ar AND NOT same
     AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10""",
    "op13_collocations": rf"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
word AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word GROUP BY lang),
place AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM word, range(1, 5) AS sizes(m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS a
      FROM place GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (SELECT lang, phrase, a, m, w, unnest(range(1, m)) AS k FROM cand),
scored AS (
    SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, ((2000000::HUGEINT * cut.a) // (x.a + y.a))::BIGINT AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(w, 1, k), ' ')
    JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(w, k + 1, cut.m), ' ')
    QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1),
inner_part AS (
    SELECT lang, a, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase
    FROM (SELECT lang, a, w, m, s, unnest(range(1, m - s + 2)) AS i
          FROM (SELECT lang, a, w, m, unnest(range(2, m)) AS s FROM cand))),
around AS (SELECT lang, phrase, max(a) AS b FROM inner_part GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM scored LEFT JOIN around USING (lang, phrase) JOIN n USING (lang)
WHERE b IS NULL OR 100 * b::HUGEINT < 80 * a::HUGEINT
QUALIFY rank <= 2000""",
}
