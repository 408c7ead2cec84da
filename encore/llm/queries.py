"""The registered queries of the training-data operators and, where SQL can express one, the same in DuckDB's SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import (bagminhash, bloom_dedup, hd_langid, hilbert_pack, kronecker_negatives, ngram_resample,
                        record_files, suffix_decontam, temperature_mix, token_secrets, toxicity, url_cascade, winnow_lines)
from encore.llm.common import prepare

#: op1: the rules, and the hosts that are blocked where no rule fits.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow",
             "net/es/": "block", "net/fr/": "block"}
BLOCKED_HOSTS = [f"{name}.example.{tld}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets",
                                                      "spam-farm") for tld in ("com", "net", "org")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out() -> Column:
    """Rows that nothing is learned from: a third of the ids, by their CRC-32. A null id is not held out."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    return F.coalesce(remainder == 1, F.lit(False))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_cascade.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, BLOCKED_HOSTS)
    return judged.select("row.page_id", "judged.*")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_decontam.digest(suffix_decontam.find_contamination(docs, table(spark, sf_dir, "benchmark")))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixture = temperature_mix.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixture.select("row.doc_id", "row.source", "n_tokens", "epoch", "place", "block")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = winnow_lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "deduped.*")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = hd_langid.learn(docs.filter(~held_out()))
    found = hd_langid.predict(docs.select("doc_id", "text", held_out().alias("held_out")), prototypes)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_secrets.find_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_secrets.digest(found)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedup.dedup_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """The model of the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    found = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return found.select("row.doc_id", "row.held_out", "score", "predicted")


def encoded(docs: DataFrame) -> DataFrame:
    """Write ``docs`` as record files and read them back."""
    folder, _ = record_files.write_records(docs, public_tokenizers.path("word_bpe_49k.json"))
    return record_files.read_records(docs.sparkSession, folder, with_ids=False)


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hilbert_pack.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_resample.resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "n_features", "weight", "score", "rank")


#: op13: whole numbers to a unit of a component; the rows whose label is moved on; the rows that are anchors.
VECTOR_UNIT, MOVED, LABELS, ANCHOR = 256, 7, 10, 100


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(VECTOR_UNIT)) * x.cast("double")))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    moved = F.when(F.col("vec_id") % MOVED == 0, F.pmod(F.col("label") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    rows = rows.filter(F.col("embedding").isNotNull() & finite).select("vec_id", moved.alias("label"), whole.alias("vector"))
    return kronecker_negatives.hard_negatives(rows, F.col("vec_id") % ANCHOR == 0)


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_decontamination, op3_source_mix, op4_line_dedup, op5_language_id, op6_secret_scan,
    op7_exact_dedup, op8_toxicity, op9_token_records, op10_near_dedup,
    op11_curve_packing, op12_importance_resample, op13_hard_negatives)}


def _in_list(host: str, entries: list[str]) -> str:
    return " OR ".join(f"{host} = '{e}' OR ends_with({host}, '.{e}')" for e in entries)


ORACLES = {
    "op1_url_filter": f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, rest,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), ruled AS (
    SELECT page_id, host, path,
           CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
                THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
                THEN 'example.com/en/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN {_in_list('host', BLOCKED_HOSTS)} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op4_line_dedup": """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL
), solid AS (
    SELECT doc_id, i, trim(line, ' ') AS line, len(string_split_regex(trim(line, ' '), ' +')) AS n,
           row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
    FROM lines WHERE trim(line, ' ') <> ''
), runs AS (
    SELECT doc_id, k, 1 AS size, md5(line) AS run FROM solid WHERE n >= 50
    UNION ALL
    SELECT a.doc_id, a.k, 2, md5(a.line || chr(10) || b.line)
    FROM solid a JOIN solid b ON b.doc_id = a.doc_id AND b.k = a.k + 1 WHERE a.n + b.n >= 50
    UNION ALL
    SELECT a.doc_id, a.k, 3, md5(a.line || chr(10) || b.line || chr(10) || c.line)
    FROM solid a JOIN solid b ON b.doc_id = a.doc_id AND b.k = a.k + 1
                 JOIN solid c ON c.doc_id = a.doc_id AND c.k = a.k + 2
), later AS (
    SELECT doc_id, k, size FROM (SELECT *, row_number() OVER (PARTITION BY size, run ORDER BY doc_id, k) AS nth FROM runs) WHERE nth > 1
), gone AS (
    SELECT DISTINCT s.doc_id, s.i FROM later l JOIN solid s ON s.doc_id = l.doc_id AND s.k BETWEEN l.k AND l.k + l.size - 1
), kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
    FROM lines l LEFT JOIN gone g USING (doc_id, i) WHERE g.i IS NULL GROUP BY l.doc_id
), solids AS (SELECT doc_id, count(*) AS n FROM solid GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_lines, coalesce(r.n, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN solids s USING (doc_id) LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
    "op7_exact_dedup": """
WITH n AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
           AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n""",
    "op12_importance_resample": """
WITH RECURSIVE polynomial AS (
    SELECT i AS b, i::BIGINT AS c, 0 AS step FROM range(256) t(i)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM polynomial WHERE step < 8
), crc_table AS (
    SELECT list(c ORDER BY b) AS t FROM polynomial WHERE step = 8
), doc_words AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), doc_features AS (
    SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(words) AS word FROM doc_words) GROUP BY rid, word
), target_features AS (
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY word
), spelled AS (
    SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM doc_features UNION SELECT word FROM target_features)
), hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
               lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM spelled, crc_table
), corpus AS (SELECT bucket, sum(n) AS s FROM doc_features JOIN hashed USING (word) GROUP BY bucket
), target AS (SELECT bucket, sum(n) AS t FROM target_features JOIN hashed USING (word) GROUP BY bucket
), sums AS (
    SELECT (SELECT coalesce(sum(s), 0) FROM corpus)::DOUBLE + 10000 AS big_s, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE + 10000 AS big_t
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * big_s / ((s + 1)::DOUBLE * big_t)))::BIGINT AS gain
    FROM corpus LEFT JOIN target USING (bucket), sums
), weighed AS (
    SELECT rid, floor(sum(n * gain) / sum(n))::BIGINT AS weight, sum(n)::BIGINT AS n_features
    FROM doc_features JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY rid
), scored AS (
    SELECT d.rid, d.doc_id, len(d.words) AS n_words, coalesce(w.n_features, 0) AS n_features, coalesce(w.weight, 0) AS weight,
           coalesce(w.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                       / 4294967296::DOUBLE)))::BIGINT AS score
    FROM doc_words d LEFT JOIN weighed w USING (rid)
), ranked AS (
    SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r.nth <= 10 * r.n // 100 THEN r.nth END AS rank
FROM scored s LEFT JOIN ranked r USING (rid)""",
    "op13_hard_negatives": """
WITH rows AS (
    SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.rid AS a, a.vec_id AS anchor_id, b.rid AS b, b.vec_id, a.label = b.label AS same,
           list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT a, b AS p, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5
), negatives AS (
    SELECT s.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY a, p ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
    FROM scored s JOIN positives USING (a)
    WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10""",
}
