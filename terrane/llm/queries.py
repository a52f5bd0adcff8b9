"""A query for each operator over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm.centroids import cluster_vectors
from terrane.llm.decontamination import contamination
from terrane.llm.fill_in_middle import fill_in_middle, restore
from terrane.llm.jaccard_join import jaccard_components
from terrane.llm.neighbours import nearest_neighbours
from terrane.llm.packing import pack
from terrane.llm.pii import personal_data
from terrane.llm.quality import learn_bands, quality
from terrane.llm.sentencepieces import sentence_pieces
from terrane.llm.sharding import shard
from terrane.llm.token_files import token_files
from terrane.llm.toxicity import learn, score_toxicity
from terrane.llm.url_filter import host_of, judge_urls
from terrane.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        @wraps(build)
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return prepared

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentence_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), 24)


# Fixed rules of the query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# Words whose hosts the query lists for blocking.
LISTED_WORDS = ["ads", "adult", "bets", "casino", "pills", "spam"]

_LISTED = f"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"
_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_URL_RE = "(?s)^.*?://([^/?#]*)([^?#]*)"


@query(
    "op3_url_filter",
    f"""
    WITH p AS (
        SELECT row_number() OVER () AS row_id, page_id,
               translate(coalesce(regexp_extract(url, '{_URL_RE}', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '{_URL_RE}', 2), '') AS path
        FROM pages),
    r AS (SELECT * FROM (VALUES {_RULES}) AS t(rule_host, rule_path, rule_verdict)),
    fits AS (
        SELECT p.row_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
        FROM p JOIN r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host))
                     AND starts_with(p.path, rule_path)
        GROUP BY p.row_id)
    SELECT page_id, host, path, rule,
           coalesce(rule_verdict,
                    CASE WHEN regexp_matches(host, '{_LISTED}') THEN 'block' ELSE 'allow' END)
           AS verdict
    FROM p LEFT JOIN fits USING (row_id)""",
)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is made from the pages themselves: urls of hosts that carry a listed word."""
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    listed = pages.select("url").filter(host_of(F.col("url")).rlike(_LISTED)).distinct()
    return judge_urls(pages, rules, listed)


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("class")


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0").select("vec_id"), 10)


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality(docs, learn_bands(docs, labels)).drop("ratio", "bad_chunk_share")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_toxicity(docs, learn(docs, labels))


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op11_decontamination",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, w, least(10, len(w)) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
    item_windows AS (
        SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS words
        FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM i WHERE size > 0)),
    sizes AS (SELECT DISTINCT size FROM item_windows),
    doc_windows AS (
        SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS words
        FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k
              FROM d JOIN sizes ON len(w) >= size)),
    hits AS (SELECT r, k, size, item_id FROM doc_windows JOIN item_windows USING (size, words)),
    words_hit AS (
        SELECT r, count(DISTINCT place) AS n_hit
        FROM (SELECT r, unnest(range(k, k + size)) AS place FROM (SELECT DISTINCT r, k, size FROM hits))
        GROUP BY r),
    items_hit AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)""",
)
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    listed = F.array_join("item_ids", ",").cast("binary")
    sets = found.item_sets.select(
        F.col("item_set").alias("key"), F.size("item_ids").alias("n_items"), F.sha2(listed, 256).alias("items_sha256")
    )
    # Documents without a hit have no set; their ids keep them from meeting in one task.
    keyed = found.documents.withColumn("key", F.coalesce("item_set", F.col("doc_id").cast("string")))
    return keyed.join(sets, "key", "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(b""), 256)).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _clustering_sql(clusters: int, dimensions: int, rounds: int, seed: int) -> str:
    """Every round written out: distances to all centroids, then floored means by component."""
    parts = [
        f"""
    v AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS p
        FROM embeddings
        WHERE len(embedding) = {dimensions} AND len([x FOR x IN embedding IF isfinite(x)]) = {dimensions}),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), p) - 1 AS c, p
        FROM v QUALIFY c < {clusters})"""
    ]
    square = f"list_sum([(v.p[j] - c.p[j]) * (v.p[j] - c.p[j]) FOR j IN range(1, {dimensions + 1})])"
    for k in range(rounds + 1):
        parts.append(f"""
    a{k} AS MATERIALIZED (
        SELECT v.r, min({{'d': {square}::BIGINT, 'c': c.c}}) AS best FROM v, c{k} AS c GROUP BY v.r)""")
        if k < rounds:
            parts.append(f"""
    s{k} AS (
        SELECT best.c AS c, j, sum(p[j]) AS s, count(*) AS n
        FROM a{k} JOIN v USING (r), range(1, {dimensions} + 1) AS t(j) GROUP BY ALL),
    m{k} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS p FROM s{k} GROUP BY c),
    c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m{k}.p, c{k}.p) AS p FROM c{k} LEFT JOIN m{k} USING (c))""")
    return f"""
    WITH {",".join(parts)}
    SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
           (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
           (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.p, ',')) AS centroid_sha256
    FROM a{rounds} JOIN v USING (r) JOIN c{rounds} ON best.c = c{rounds}.c"""


@query("op12_centroid_clustering", _clustering_sql(8, 64, 10, 3))
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(table(spark, sf_dir, "embeddings"), clusters=8, dimensions=64, rounds=10, seed=3)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return found.described().withColumn("centroid_sha256", digest).drop("centroid")


@query(
    "op13_fill_in_middle",
    r"""
    WITH u AS (
        SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''),
                   '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
               sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest
        FROM documents),
    h AS (
        SELECT *, len(units) AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
               ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4
        FROM u),
    c AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM h),
    p AS (
        SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
               array_to_string(units[b + 1:n], '') AS suffix
        FROM c)
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                            WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p""",
)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = restore(fill_in_middle(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80))
    digests = [F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256") for name in ("output", "restored")]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
