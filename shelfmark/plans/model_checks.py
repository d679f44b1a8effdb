"""What can be said of the fitted models in SQL: counts, scaling, nearest centres, order, parameters."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..checkpoints import materialise
from ..functions.numbers import rounded
from ..operators import clustering, ratings as rt, recommend as rec
from ..operators.top_items import top_items
from ..sources import tables as tb
from .checks import DEDUPED, INDEXED, RATED, SQL_LETTERS, TERMS, _indexed, _round, query

STOP = ["the", "of", "and", "le", "der"]
# White space parts words; blanks at the end leave no empty word behind.
TOKENS = f"""texts AS (SELECT doc_id, rtrim({SQL_LETTERS}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM documents WHERE {SQL_LETTERS} <> ''),
words AS (SELECT doc_id, unnest(CASE WHEN t = '' THEN [] ELSE regexp_split_to_array(t, '[\\t-\\r ]') END) AS w FROM texts)"""
STOPPED = "w NOT IN (" + ", ".join(f"'{w}'" for w in STOP) + ")"


@query(f"""WITH {TOKENS} SELECT doc_id AS book_id, count(w) FILTER (WHERE {STOPPED}) AS words
  FROM texts LEFT JOIN words USING (doc_id) GROUP BY doc_id""")
def tfidf_words(spark, sf):
    """Words that the term frequencies of each text add up to."""
    texts = tb.texts(spark, sf)
    _, model = clustering.tfidf_features(texts, stop_words=STOP)
    counted = clustering.cleaned_texts(texts, "book_id", "title", "description")
    for stage in model.stages[:-1]:
        counted = stage.transform(counted)
    return counted.select("book_id", F.aggregate(vector_to_array("raw_features"), F.lit(0.0),
                                                 lambda a, v: a + v).cast("long").alias("words"))


@query(f"WITH {TOKENS} SELECT count(*) AS texts, count(*) AS weighed FROM texts")
def tfidf_document_count(spark, sf):
    """Texts that the document frequencies were counted over."""
    features, model = clustering.tfidf_features(tb.texts(spark, sf), stop_words=STOP)
    return features.agg(F.count(F.lit(1)).alias("texts"), F.lit(model.stages[-1].numDocs).cast("long").alias("weighed"))


@query(f"WITH {RATED} " + " UNION ALL ".join(
    f"""SELECT '{name}' AS feature, {_round(f"avg(coalesce({column}, 0))", 4)} AS mean,
    {_round(f"stddev_samp(coalesce({column}, 0))", 4)} AS std FROM rated"""
    for name, column in (("avg_rating", "average_rating"), ("num_pages", "num_pages"), ("ratings_count", "ratings_count"),
                         ("reviews_count", "text_reviews_count"))))
def feature_scaling(spark, sf):
    books = tb.rated_catalogue(spark, sf)
    _, model = clustering.feature_clusters(books, k=8)
    names = clustering.feature_inputs(books)[1]
    scaler = model.stages[1]
    rows = [(n, float(m), float(s)) for n, m, s in zip(names, scaler.mean, scaler.std)]
    return spark.createDataFrame(rows, "feature string, mean double, std double").select(
        "feature", rounded(F.col("mean"), 4).alias("mean"), rounded(F.col("std"), 4).alias("std"))


@query(f"""WITH {RATED}, {TOKENS} SELECT 'numbers' AS clustering, count(*) AS records, 0 AS violations FROM rated
  UNION ALL SELECT 'keywords', count(*), 0 FROM texts UNION ALL SELECT 'texts', count(*), 0 FROM texts""")
def clusters_at_nearest_centre(spark, sf):
    """Rows of each clustering, and those that are not in the cluster of the nearest centre."""
    books, texts = tb.rated_catalogue(spark, sf), tb.texts(spark, sf)
    inputs = {"numbers": (clustering.feature_inputs(books)[0], clustering.feature_clusters(books, k=8)[1]),
              "keywords": (clustering.keyword_inputs(texts, TERMS)[0],
                           clustering.keyword_clusters(texts, keywords=TERMS)[1]),
              "texts": (clustering.cleaned_texts(texts, "book_id", "title", "description"),
                        clustering.text_clusters(texts, k=8)[1])}
    found = [clustering.off_centre(model.transform(rows), model.stages[-1]).select(
        F.lit(name).alias("clustering"), "records", F.col("violations").cast("int").alias("violations"))
        for name, (rows, model) in inputs.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(f"""WITH {TOKENS}, counted AS (SELECT doc_id, count(*) FILTER (WHERE {STOPPED} AND w <> '') AS n
  FROM words GROUP BY doc_id)
SELECT (SELECT count(*) FROM texts) AS texts, CAST(sum(n) AS BIGINT) AS words,
       count(*) FILTER (WHERE n > 0) AS with_topic, 0 AS off FROM counted""")
def lda_coverage(spark, sf):
    """Texts and words read, texts with a topic, and texts whose weights do not add up to 1."""
    texts = tb.texts(spark, sf)
    assigned = clustering.lda_topics(texts, k=4, max_iter=3, stop_words=STOP)[0]
    return clustering.lda_coverage(texts, assigned, STOP).select("texts", "words", "with_topic",
                                                                 F.col("off").cast("int").alias("off"))


# --------------------------------------------------------------- recommender

def _fitted(spark, sf):
    indexed = materialise(_indexed(spark, sf))
    train, test = rt.split(indexed, bucket=(F.col("user_id") * 31 + F.col("book_id") * 17) % 100)
    return indexed, train, test, rec.fit_als(train, rank=8, max_iter=4)


SPLIT = f"""{INDEXED}, train AS (SELECT kept.* FROM kept JOIN users USING (user_id) JOIN items USING (book_id)
  WHERE (user_id * 31 + book_id * 17) % 100 < 80)"""


@query(f"""WITH {SPLIT} SELECT count(DISTINCT user_id) AS users,
  count(DISTINCT user_id) * least(10, count(DISTINCT book_id)) AS recommendations, 0 AS wrong_titles FROM train""")
def als_recommendation_counts(spark, sf):
    """Ten items for every user, each with the title that its item has."""
    indexed, _, _, model = _fitted(spark, sf)
    titles = rt.item_titles(tb.titled_ratings(spark, sf))
    recs = materialise(rec.recommend(model, indexed, titles))
    parts = tb.table(spark, sf, "part").select(F.col("p_partkey").alias("book_id"), F.col("p_name").alias("given"))
    wrong = recs.join(parts, "book_id", "left").agg(
        F.count_if(~F.col("title").eqNullSafe(F.col("given"))).cast("int").alias("wrong_titles"))
    counted = recs.agg(F.count_distinct("user_idx").alias("users"), F.count(F.lit(1)).alias("recommendations"))
    return counted.withColumn("one", F.lit(1)).join(wrong.withColumn("one", F.lit(1)), "one").drop("one")


@query("SELECT CAST(8 AS BIGINT) AS rank, 0.1::DOUBLE AS \"regParam\", CAST(4 AS BIGINT) AS \"maxIter\", true AS in_range")
def als_metrics_line(spark, sf):
    """The parameters of the fit, and whether its error is one that ratings from 1 to 5 allow."""
    _, _, test, model = _fitted(spark, sf)
    line = rec.als_metrics(model, test, rank=8, max_iter=4)
    return line.select("rank", "regParam", "maxIter", F.col("rmse").between(0.01, 4.0).alias("in_range"))


@query(f"""WITH {DEDUPED} SELECT book_id, max(title) AS title FROM deduped GROUP BY book_id""")
def items_with_titles(spark, sf):
    """One row for each item key, though many ratings carry it."""
    titled = tb.titled_ratings(spark, sf).filter("rating > 0")
    indexed = rt.frequency_index(titled, "book_id", "book_idx")
    return rec.item_lookup(indexed, rt.item_titles(titled)).select("book_id", "title")


# Whole components, so that a score is the same in whatever order it is added up. Vectors are long or short by their id,
# as the factors of known and unknown items are.
WHOLE = """whole AS (SELECT vec_id, [floor(64 * x::DOUBLE) * (1 + vec_id % 5) for x in embedding] AS v
  FROM embeddings WHERE len(embedding) = 64)"""


@query(f"""WITH {WHOLE}, scored AS (SELECT u.vec_id AS user, i.vec_id AS item,
    CAST(list_dot_product(u.v, i.v) AS FLOAT) AS score FROM whole u, whole i)
SELECT user, item, CAST(score AS DOUBLE) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY user ORDER BY score DESC, item) <= 10""")
def inner_product_top(spark, sf):
    """The ten vectors of greatest inner product for every vector: the longest are scored first, the others in blocks."""
    vectors = tb.table(spark, sf, "embeddings").filter(F.size("embedding") == 64).select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double")
                                                 * (1 + F.col("vec_id") % 5)).alias("features"))
    found = top_items(vectors, vectors, 10, head=64, block_items=64, group_users=128).rows
    return found.select("user", "item", F.col("score").cast("double").alias("score"))
