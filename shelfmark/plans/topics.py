"""Shelf topics, the three clusterings and the topic model of a catalogue."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..checkpoints import materialise
from ..operators import clustering, tags
from ..schemas import CURATED_BOOKS
from ..sources import files


def run(spark: SparkSession, source: str, out: str, json: bool = False, keyword_k: int = 10,
        feature_k: int = 8, text_k: int = 8, lda_k: int = 8) -> dict[str, DataFrame]:
    """Write the topics and clusterings under ``out``; returns the cluster size tables.

    ``source`` is the curated Parquet, or its JSON sample with ``json``, which is
    parsed once. The descriptions are cleaned once for the three fits that read them.
    """
    books = files.read_json(spark, source, CURATED_BOOKS) if json else files.read_parquet(spark, source)
    if json:
        books = books.persist(StorageLevel.MEMORY_AND_DISK)

    files.write_parquet(tags.top_topics(books), f"{out}/shelf_topics")
    texts = materialise(clustering.cleaned_texts(books, "book_id", "title", "description"))
    made = {"keyword_clusters": clustering.keyword_clusters(texts, k=keyword_k)[0],
            "feature_clusters": clustering.feature_clusters(books, k=feature_k)[0],
            "description_clusters": clustering.text_clusters(texts, k=text_k)[0]}
    assigned, topics, _ = clustering.lda_topics(texts, k=lda_k)
    files.write_parquet(assigned.drop("total"), f"{out}/lda_topics")
    files.write_parquet(topics, f"{out}/lda_terms")
    sizes = {}
    for name, frame in made.items():
        files.write_parquet(frame, f"{out}/{name}")
        sizes[name] = clustering.cluster_sizes(files.read_parquet(spark, f"{out}/{name}"))
    if json:
        books.unpersist()
    return sizes
