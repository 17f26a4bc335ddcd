"""The registered queries over the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataudit.llm import clusters, ctw, decontaminate, language, lines, mixing, negatives, parity, quality, secrets, simhash, warc, weighted
from strataudit.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("known", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.listed(F.col("known")), 256).alias("base_sha256"),
                        secrets.listed(F.concat("known", "random")).alias("spans"),
                        F.size("random").cast("bigint").alias("n_random"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.mix(table(spark, sf_dir, "documents"))
    return made.taken.select("doc_id", "size", "source_size", "target", "taken")


def op4_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    chunks = warc.read(warc.write(pages), keep_data=False).where("last")
    own = F.col("record_type") == "response"
    return chunks.select(F.col("page_id").cast("bigint").alias("page_id"),
                         F.when(own, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
                         F.when(own, F.col("digest_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
                         "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "at", "words", "equal")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return fitted.decide(fitted.scores).select("doc_id", "lang", "n_bytes", "perplexity", "limit", "keep")


def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.compare(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"), label="CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parity.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, num=85, den=100)
    return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id")


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_secret_scan, op3_source_mix, op4_context_tree_scores, op5_warc_chunks,
                                  op6_benchmark_decontamination, op7_line_dedup, op8_quality_classifier, op9_language_crf,
                                  op10_weighted_fingerprints, op11_hard_negatives, op12_centroid_clusters, op13_parity_join)}

_ROUNDS = "".join(f"""
        d{r} AS (SELECT v.id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c USING (j) GROUP BY ALL),
        a{r} AS (SELECT id, arg_min(k, d * 100 + k) AS k, min(d) AS d FROM d{r} GROUP BY id),
        s{r} AS (SELECT k, j, sum(x) AS s, count(*) AS n FROM a{r} JOIN v USING (id) GROUP BY ALL),
        c{r + 1} AS (SELECT c.k, c.j, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{r} c LEFT JOIN s{r} USING (k, j)),"""
                  for r in range(4))

ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
        WITH e AS (SELECT vec_id AS id, label + 0 AS own, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: isfinite(x))), true)),
        r AS (SELECT id, CASE WHEN id % 7 = 0 THEN (own + 1) % 10 ELSE own END AS label, v FROM e),
        s AS (SELECT a.id AS a, r.id AS b, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS s FROM r a JOIN r ON a.id % 100 = 0 AND a.id <> r.id),
        p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS n FROM s WHERE same) q WHERE n <= 5),
        h AS (SELECT p.a, p.b AS p, s.b AS h, p.s AS ps, s.s AS hs, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS n
              FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.s <= 100 * s.s AND 100 * s.s <= 100 * p.s)
        SELECT a AS anchor_id, p AS positive_id, n::INT AS rank, h AS negative_id, ps AS positive_score, hs AS negative_score FROM h WHERE n <= 5""",
    "op12_centroid_clusters": f"""
        WITH w AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        v AS (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM w),
        f AS (SELECT id, row_number() OVER (ORDER BY sha256('1:' || id)) - 1 AS k FROM w),
        c0 AS (SELECT k, j, x FROM f JOIN v USING (id) WHERE k < 16),{_ROUNDS}
        m AS (SELECT k, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY j)) AS h FROM c3 GROUP BY k),
        t AS (SELECT k, sum(d) AS t FROM a3 GROUP BY k)
        SELECT id AS vec_id, k::INT AS cluster, d::BIGINT AS distance, t::BIGINT AS cluster_inertia, (SELECT sum(d) FROM a3)::BIGINT AS inertia,
               h AS centroid_sha256 FROM a3 JOIN m USING (k) JOIN t USING (k)""",
    "op5_warc_chunks": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
        d AS (SELECT page_id, n, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + (((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31))::INT, 1)), '') AS b
              FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY b, n) AS first FROM d)
        SELECT page_id, n::BIGINT AS payload_bytes, b AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to FROM f""",
}
