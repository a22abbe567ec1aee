"""The registered queries of the operators for training text, each over whole tables, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import alignment, bpe, classifier, common, decontaminate, jaccard, mixing_lm, quality_rules, sharding, suffix_dedup, token_counts, token_files, vector_codes, warc
from tributary.session import staging_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(common.start(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def tokenizer(name: str) -> str:
    """File of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontaminate(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.matches(docs, common.read(spark, sf_dir, "benchmark"), keep_text=False))


@query
def op2_quality_rules(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    trusted = common.read(spark, sf_dir, "labels").where("quality = 1")
    scores = quality_rules.score(docs.select("doc_id", "text"), quality_rules.fit(docs, trusted))
    return quality_rules.verdicts(scores)


@query
def op3_warc(spark, sf_dir):
    files = warc.write(common.read(spark, sf_dir, "pages"), staging_path(spark, "warc"))
    return warc.read(files, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_token_counts(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    counts = token_counts.histogram(token_counts.lengths(docs, tokenizer("byte_bpe_50k.json")))
    return token_counts.by_limit(token_counts.suffix_sums(common.Staged(counts, "lengths").df))


@query
def op5_ngram_jaccard(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    return jaccard.classes(docs).select("doc_id", "n_shingles", "component_id")


@query
def op6_token_files(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    files = token_files.write(docs, tokenizer("word_bpe_49k.json"), 2, token_files.new_folder(spark))
    return token_files.with_crc32(token_files.read(files))


@query
def op7_context_mixing(spark, sf_dir):
    held_out = common.crc_of("doc_id") % 7 == 2
    scores = mixing_lm.score(common.read(spark, sf_dir, "documents"), ~held_out)
    columns = ("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    return scores.select(*columns)


@query
def op8_bpe(spark, sf_dir):
    path = tokenizer("byte_bpe_50k.json")
    encoded = bpe.encode(common.read(spark, sf_dir, "documents"), path)
    return bpe.digests(bpe.decode(encoded, path))


@query
def op9_suffix_dedup(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.report(suffix_dedup.removed(docs))


@query
def op10_classifier(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    held_out = common.crc_of("doc_id") % 5 == 0
    learnt = classifier.labelled(docs.where(~held_out), common.read(spark, sf_dir, "labels"), "quality")
    scores = classifier.score(docs, classifier.fit(learnt))
    predicted = (F.col("score") >= classifier.THRESHOLD).cast("int")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op11_vector_codes(spark, sf_dir):
    return vector_codes.report(vector_codes.Codes(common.read(spark, sf_dir, "embeddings")))


ORACLES["op11_vector_codes"] = """
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, len(embedding) // 16 AS d, row_number() OVER (ORDER BY vec_id) - 1 AS k
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS (SELECT vec_id, label, p, d, k, list_slice(v, p * d + 1, p * d + d) AS x FROM whole, range(16) AS parts(p)),
book0 AS (SELECT p, k AS e, x AS c FROM points WHERE k < 64),
""" + "".join(f"""
near{n} AS (
  SELECT vec_id, p, any_value(label) AS label, any_value(x) AS x, min({{'apart': apart, 'e': e}}) AS best FROM (
    SELECT vec_id, label, p, x, e, list_sum(list_transform(range(1, d + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS apart FROM points JOIN book{n} USING (p))
  GROUP BY vec_id, p),
mean{n} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, best.e AS e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM near{n}, LATERAL unnest(range(1, len(x) + 1)) AS places(i) GROUP BY ALL)
  GROUP BY p, e),
book{n + 1} AS (SELECT p, e, coalesce(mean{n}.c, book{n}.c) AS c FROM book{n} LEFT JOIN mean{n} USING (p, e)),
""" for n in range(3)) + """
codes AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.apart)::BIGINT AS error FROM near2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM codes
"""


@query
def op12_alignment(spark, sf_dir):
    return alignment.report(common.read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


@query
def op13_sharding(spark, sf_dir):
    return sharding.assign(common.read(spark, sf_dir, "documents"))


ORACLES["op13_sharding"] = """
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
groups AS (SELECT t, sha256(t) AS k, count(*) AS n, count(*) * (strlen(t) + 8) AS b FROM docs GROUP BY t),
ranked AS (SELECT *, row_number() OVER by_size - 1 AS i, sum(b) OVER () - sum(b) OVER by_size + b AS rest FROM groups WINDOW by_size AS (ORDER BY b DESC, k)),
alone AS (SELECT coalesce(min(i) FILTER (WHERE i = 23 OR b * (24 - i) <= rest), count(*)) AS m FROM ranked),
ends AS (SELECT k, n, sum(b) OVER (ORDER BY k) AS e FROM ranked, alone WHERE i >= m),
rest AS (SELECT coalesce(list(e ORDER BY e), []) AS es, coalesce(max(e), 0) AS total, any_value(24 - m) AS shards FROM alone LEFT JOIN ends ON true),
search AS (
  SELECT 0::HUGEINT AS low, total::HUGEINT AS high FROM rest
  UNION ALL
  SELECT CASE WHEN fits THEN low ELSE middle END, CASE WHEN fits THEN middle ELSE high END FROM (
    SELECT low, high, middle, list_reduce(range(shards::BIGINT), lambda p, x: coalesce(list_max(list_filter(es, lambda y: y <= p + middle)), p)::HUGEINT, 0::HUGEINT) = total AS fits
    FROM (SELECT *, (low + high) // 2 AS middle FROM search WHERE high - low > 1), rest)),
capacity AS (SELECT min(high) AS c FROM search),
filled AS (
  SELECT 0 AS j, 0::HUGEINT AS p
  UNION ALL
  SELECT j + 1, list_max(list_filter(es, lambda y: y <= p + c)) FROM filled, rest, capacity WHERE p < total),
homes AS (
  SELECT k, i AS shard FROM ranked, alone WHERE i < m
  UNION ALL
  SELECT k, m + (SELECT count(*) - 1 FROM filled WHERE p < e) FROM ends, alone),
byte_table AS (
  SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc FROM range(256) AS bytes(b)),
crcs AS (
  SELECT k, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM groups, byte_table)
SELECT doc_id, strlen(t) + 8 AS size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM docs JOIN homes ON sha256(t) = k JOIN crcs USING (k)
"""
