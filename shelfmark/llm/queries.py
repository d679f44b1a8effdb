"""The operators applied to whole tables, with SQL twins where SQL can say the same."""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..checkpoints import checkpoint_dir
from . import (centroids, fingerprints, html_text, mixing, neighbours, packing, pii, quality, secrets, sharding, simhash,
               spelling, token_files)

LENGTH, END_ID = 1024, 2


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def vocabulary() -> tuple[str, str]:
    """The ranks file of the byte-level vocabulary, and the pattern that splits texts for it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _counts(kinds: tuple[str, ...]) -> list[Column]:
    """Number of the rules' spans of each kind."""
    return [F.expr(f"cast(size(filter(rule_spans, s -> s.kind = '{kind}')) AS long)").alias(f"n_{kind}")
            for kind in kinds]


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_versions(documents(spark, folder))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, folder))
    return found.select("doc_id", *_counts(tuple(rule.kind for rule in secrets.BASE)),
                        F.sha2(pii.listed(F.col("rule_spans")), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id % 100 = 0")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_private(documents(spark, folder))
    return found.select("doc_id", *_counts(pii.KINDS), F.sha2(pii.listed(F.col("rule_spans")), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), *vocabulary(), LENGTH, END_ID)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, folder))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.page_texts(spark.read.parquet(f"{folder}/pages.parquet"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    cut = sharding.cut_shards(documents(spark, folder), 24)
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder))


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = f"{checkpoint_dir(spark)}/token-files-{uuid4().hex}"
    token_files.write_tokens(documents(spark, folder), path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_fingerprints": op2_fingerprints,
    "op3_secrets": op3_secrets,
    "op4_simhash": op4_simhash,
    "op5_neighbours": op5_neighbours,
    "op6_pii": op6_pii,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_html_text": op9_html_text,
    "op10_sharding": op10_sharding,
    "op11_spelling": op11_spelling,
    "op12_token_files": op12_token_files,
    "op13_centroids": op13_centroids,
}


def _clustering(rounds: int) -> str:
    """The clustering of ``embeddings`` with so many rounds, each of them a few tables."""
    tables = ["""kept AS (
            SELECT row_number() OVER () AS row, vec_id,
                   [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
            FROM embeddings
            WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64)""",
              """c0 AS (
            SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q
            FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, q FROM kept ORDER BY h, q LIMIT 16))"""]
    for n in range(rounds + 1):
        tables.append(f"""a{n} AS (
            SELECT row, min(struct_pack(d := d, c := c)) AS best
            FROM (SELECT row, c, CAST(list_sum([(k.q[i] - o.q[i]) * (k.q[i] - o.q[i]) FOR i IN generate_series(1, 64)])
                                   AS BIGINT) AS d
                  FROM kept k, c{n} o)
            GROUP BY row)""")
        if n < rounds:
            tables.append(f"""m{n} AS (
            SELECT c, list(CAST(floor_sum AS BIGINT) ORDER BY i) AS q
            FROM (SELECT c, i, (s - ((s % n) + n) % n) // n AS floor_sum
                  FROM (SELECT best.c AS c, i, CAST(sum(v) AS HUGEINT) AS s, count(*) AS n
                        FROM (SELECT row, unnest(q) AS v, generate_subscripts(q, 1) AS i FROM kept) JOIN a{n} USING (row)
                        GROUP BY best.c, i))
            GROUP BY c),
        c{n + 1} AS (SELECT o.c, coalesce(m.q, o.q) AS q FROM c{n} o LEFT JOIN m{n} m USING (c))""")
    return f"""WITH {", ".join(tables)}
        SELECT vec_id, CAST(best.c AS INT) AS cluster, best.d AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(o.q, ',')) AS centroid_sha256
        FROM kept JOIN a{rounds} USING (row) JOIN c{rounds} o ON o.c = best.c"""


SQL: dict[str, str] = {
    "op13_centroids": _clustering(3),
    "op8_mixing": """
        WITH sized AS (
            SELECT doc_id, source, text,
                   CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size,
                   ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15))::BIGINT
                       AS place
            FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight,
                   row_number() OVER (ORDER BY source NULLS LAST) AS rank
            FROM sources),
        levels AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size) OVER filled, 0) * 2.0::DOUBLE)
                      / sum(weight) OVER onward AS level, source_size / weight AS ratio
            FROM weighed
            WINDOW filled AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   onward AS (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        opened AS (SELECT level FROM levels WHERE level * weight <= source_size * 2.0 ORDER BY ratio, rank LIMIT 1),
        targets AS (
            SELECT source, source_size,
                   least(source_size * 2.0::DOUBLE, coalesce((SELECT level FROM opened), 0) * weight) AS target
            FROM levels),
        budgets AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies
            FROM targets),
        running AS (
            SELECT s.doc_id, s.size, b.source_size, b.target, b.copies,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place
                                              RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   sum(s.size) OVER (PARTITION BY s.source, s.place) AS together,
                   count(*) OVER (PARTITION BY s.source, s.place) AS alike,
                   row_number() OVER (PARTITION BY s.source, s.place) AS number
            FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(size * (copies + CASE WHEN before + (number - 0.5) * together / alike < target - copies * source_size
                                          THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM running""",
}
