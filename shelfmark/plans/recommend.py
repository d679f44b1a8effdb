"""Train the recommender, measure it on held-out ratings, and recommend."""

from pyspark.sql import DataFrame, SparkSession

from ..checkpoints import materialise
from ..operators import ratings as rt, recommend as rec
from ..sources import files


def run(spark: SparkSession, source: str, out: str, k: int = 10, blocks: int | None = None,
        min_user: int = 5, min_item: int = 10, rank: int = rec.RANK, reg_param: float = rec.REG_PARAM,
        max_iter: int = rec.MAX_ITER) -> DataFrame:
    """Write ``als_metrics`` (JSON) and ``als_recommendations`` (Parquet); returns the metrics.

    Each shrinking step is materialised once, as the next one reads it several times;
    titles stay out of those rows and join the recommendations at the end.
    """
    given = files.read_parquet(spark, source)
    deduped = materialise(rt.dedupe_ratings(given, title=None))
    hot = rt.hot_ids(deduped)
    kept = materialise(rt.support_filter(deduped, min_user=min_user, min_item=min_item, hot=hot))
    indexed = materialise(rt.index_ids(kept, hot=hot))
    train, test = rt.split(indexed)

    model = rec.fit_als(train, rank=rank, reg_param=reg_param, max_iter=max_iter, blocks=blocks)
    files.write_json(rec.als_metrics(model, test, rank, reg_param, max_iter), f"{out}/als_metrics")
    files.write_parquet(rec.recommend(model, indexed, rt.item_titles(given), k), f"{out}/als_recommendations")
    return spark.read.json(f"{out}/als_metrics")
