"""K-Means groupings of a catalogue and an LDA topic model, on MLlib.

A fit reads its input many times, so texts are turned into vectors once, the
vectors kept, and every fit and prediction runs on those. Clusters do not depend
on the number of cores or on how the files were cut: ``kmeans`` adds up whole
numbers. For the topic model alone the texts are dealt by a hash of the key, for its start.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (IDF, CountVectorizerModel, HashingTF, StopWordsRemover, Tokenizer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..checkpoints import materialise, pin_partitions
from ..functions.text import KEPT, KEYWORDS, letters_only, mentions
from .kmeans import kmeans_model, scaler_model
from .reports import label_counts
from .topic_model import predicted, topic_model

SEED = 42
# Partitions in which the start of the topic model is drawn; raise it with the data.
FIT_PARTITIONS = 16
# Slots that words are hashed into for the topic model.
TERM_SLOTS = 1 << 16
PROFILE = ("average_rating", "num_pages", "ratings_count", "text_reviews_count")


def cleaned_texts(df: DataFrame, key: str, title: str, text: str) -> DataFrame:
    """key, title and the letters of the text, where any character is left of it; cleaned texts stay as they are.

    The filter asks the raw text for one such character, so that the cleaning is
    not done a second time for the comparison with ''.
    """
    if "description_clean" in df.columns:
        return df.select(key, title, "description_clean")
    return (df.filter(F.col(text).rlike(KEPT))
              .select(key, title, letters_only(F.col(text)).alias("description_clean")))


def fixed_partitions(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """``df`` kept in partitions and an order that depend on its keys alone."""
    return pin_partitions(df.repartition(partitions, key).sortWithinPartitions(key))


def _apply(stages: Sequence, df: DataFrame) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df


def keyword_inputs(df: DataFrame, keywords: Sequence[str], key: str = "book_id", title: str = "title",
                   text: str = "description", clean_keywords: bool = False) -> tuple[DataFrame, list[str]]:
    """key, title and a flag for each keyword; the names of the flags."""
    probes = ["".join(c for c in w if c.isalpha() or c.isspace()) if clean_keywords else w for w in keywords]
    names = [f"kw_{i}" for i in range(len(probes))]
    flags = cleaned_texts(df, key, title, text).selectExpr(
        key, title, *[f"int({mentions('description_clean', w)}) AS {n}" for n, w in zip(names, probes)])
    return flags, names


def feature_inputs(df: DataFrame, columns: Sequence[str] = PROFILE, key: str = "book_id",
                   title: str = "title") -> tuple[DataFrame, list[str]]:
    """key, title and the numbers under the names they have among the features, NULL as 0."""
    renamed = {"average_rating": "avg_rating", "text_reviews_count": "reviews_count"}
    names = [renamed.get(c, c) for c in columns]
    numbers = df.select(key, title, *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    return numbers.na.fill(0.0, subset=names), names


def off_centre(predicted: DataFrame, model) -> DataFrame:
    """(records, violations): rows in all, and rows whose cluster is not that of the nearest centre."""
    centres = np.array([c for c in model.clusterCenters()])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = violations = 0
        for batch in batches:
            points, own = batch.column("point"), batch.column("cluster").to_numpy(zero_copy_only=False)
            for begin in range(0, batch.num_rows, 1024):
                some = points.slice(begin, 1024).flatten().to_numpy(zero_copy_only=False).reshape(-1, centres.shape[1])
                apart = np.stack([((some - c) ** 2).sum(axis=1) for c in centres])
                cluster = own[begin:begin + 1024]
                violations += int((apart[cluster, np.arange(len(some))] > apart.min(axis=0) * (1 + 1e-9) + 1e-9).sum())
                records += len(some)
        yield pa.RecordBatch.from_pydict({"records": pa.array([records]), "violations": pa.array([violations])})

    measured = predicted.select(vector_to_array("features").alias("point"), "cluster")
    return measured.mapInArrow(counted, "records long, violations long").agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))


def keyword_clusters(df: DataFrame, keywords: Sequence[str] = KEYWORDS, k: int = 10, seed: int = SEED,
                     key: str = "book_id", title: str = "title", text: str = "description",
                     clean_keywords: bool = False) -> tuple[DataFrame, PipelineModel]:
    """Records grouped by which keywords their text contains.

    Cleaning removes the hyphen from the text, so "self-help" is never found
    unless ``clean_keywords`` removes it from the keyword as well.
    """
    flags, names = keyword_inputs(df, keywords, key, title, text, clean_keywords)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    vectors = materialise(assembler.transform(flags).select(key, title, "features"))
    model = kmeans_model(vectors, k, seed)
    return model.transform(vectors).select(key, title, "cluster"), PipelineModel([assembler, model])


def feature_clusters(df: DataFrame, columns: Sequence[str] = PROFILE, k: int = 10, seed: int = SEED,
                     key: str = "book_id", title: str = "title") -> tuple[DataFrame, PipelineModel]:
    """Records grouped by standardised numbers, NULL counting as 0."""
    numbers, names = feature_inputs(df, columns, key, title)
    assembler = VectorAssembler(inputCols=names, outputCol="features_raw")
    numbers = materialise(numbers)
    scaler = scaler_model(numbers, names)
    vectors = materialise(scaler.transform(assembler.transform(numbers)))
    model = kmeans_model(vectors, k, seed)
    shown = [n for n in names if n != "reviews_count"]
    return (model.transform(vectors).select(key, title, *shown, "cluster"),
            PipelineModel([assembler, scaler, model]))


def _tokens(text: str = "description_clean", stop_words: Sequence[str] | None = None) -> list:
    remover = StopWordsRemover(inputCol="words", outputCol="filtered_words")
    if stop_words is not None:
        remover = remover.setStopWords(list(stop_words))
    return [Tokenizer(inputCol=text, outputCol="words"), remover]


def tfidf_features(df: DataFrame, num_features: int = 1000, key: str = "book_id", title: str = "title",
                   text: str = "description",
                   stop_words: Sequence[str] | None = None) -> tuple[DataFrame, PipelineModel]:
    """Hashed term frequencies weighted by inverse document frequency."""
    stages = [*_tokens(stop_words=stop_words), HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features)]
    counted = materialise(_apply(stages, cleaned_texts(df, key, title, text)).select(key, title, "raw_features"))
    idf = IDF(inputCol="raw_features", outputCol="features").fit(counted)
    return idf.transform(counted).select(key, title, "features"), PipelineModel([*stages, idf])


def text_clusters(df: DataFrame, k: int = 10, seed: int = SEED, num_features: int = 1000,
                  key: str = "book_id", title: str = "title", text: str = "description") -> tuple[DataFrame, PipelineModel]:
    """Records grouped by the TF-IDF vector of their text."""
    vectors, weighting = tfidf_features(df, num_features, key, title, text)
    model = kmeans_model(vectors, k, seed)
    return model.transform(vectors).select(key, title, "cluster"), PipelineModel([*weighting.stages, model])


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return label_counts(clustered, "cluster")


def term_slots(words: str, slots: int) -> Column:
    """The slot of each word: a hash, so that no list of words has to be agreed on."""
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(slots)).cast("int"))


def lda_topics(df: DataFrame, k: int = 8, terms: int = 10, max_iter: int = 10, slots: int = TERM_SLOTS,
               partitions: int = FIT_PARTITIONS, stop_words: Sequence[str] | None = None, seed: int = SEED,
               key: str = "book_id", title: str = "title",
               text: str = "description") -> tuple[DataFrame, DataFrame, PipelineModel]:
    """(records with their main topic, topics with their heaviest terms, model).

    Expectation maximisation, so every iteration reads every text, and every word counts:
    words are hashed into ``slots``, a size of the model as ``k`` is. A slot goes by its
    most frequent word, looked up in a table of words and counts that Spark makes. Texts
    are tokenised once for the fit, and once more if the terms of the topics are asked for.
    ``topic`` and ``weight`` are NULL for texts of stop words alone.
    """
    stages = _tokens(stop_words=stop_words)
    # What the two stages make, as columns: words need not leave Spark's own rows.
    stopped = [w.lower() for w in stages[1].getStopWords()]
    tokens = cleaned_texts(df, key, title, text).select(key, title, F.filter(
        F.split(F.lower("description_clean"), r"\s"), lambda w: (w != "") & ~w.isin(stopped)).alias("filtered_words"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(slots)], inputCol="slots",
                                                   outputCol="features")
    placed = materialise(tokens.select(key, title, term_slots("filtered_words", slots).alias("slots")))
    lda = topic_model(placed, k, max_iter, slots, partitions, seed, key, "slots")

    weights = predicted(placed, lda, "slots", "_w")
    heaviest = F.nullif(F.array_max("_w"), F.lit(0.0))
    assigned = weights.select(key, title, (F.array_position("_w", heaviest) - 1).cast("int").alias("topic"),
                              heaviest.alias("weight"), F.aggregate("_w", F.lit(0.0), lambda a, w: a + w).alias("total"))
    counts = tokens.select(F.explode("filtered_words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    slot = F.pmod(F.xxhash64("term"), F.lit(slots)).cast("int")
    names = counts.groupBy(slot.alias("slot")).agg(F.max_by("term", F.struct("n", "term")).alias("term"))
    listed = lda.describeTopics(terms).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")))
    named = listed.select("topic", "pos", F.col("col.termIndices").alias("slot"),
                          F.col("col.termWeights").alias("weight")).join(names, "slot", "left")
    topics = named.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("pos", "term", "weight"))).alias("t")).select(
        "topic", F.col("t.term").alias("terms"), F.col("t.weight").alias("termWeights"))
    return assigned, topics, PipelineModel([*stages, counter, lda])


def lda_coverage(df: DataFrame, assigned: DataFrame, stop_words: Sequence[str], text: str = "description",
                 key: str = "book_id", title: str = "title") -> DataFrame:
    """One row: texts, words counted, texts with a topic, and texts whose topic weights do not add up to 1."""
    tokens = _apply(_tokens(stop_words=stop_words), cleaned_texts(df, key, title, text))
    words = tokens.select(F.size(F.filter("filtered_words", lambda w: w != "")).alias("n"))
    read = words.agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("words"))
    fitted = assigned.agg(F.count("topic").alias("with_topic"),
                          F.count_if(F.abs(F.col("total") - 1) > 1e-6).alias("off"))
    return read.select("texts", "words", F.lit(1).alias("_one")).join(
        fitted.withColumn("_one", F.lit(1)), "_one").drop("_one")
