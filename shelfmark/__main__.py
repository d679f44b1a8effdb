"""Command line: ``spark-submit`` or ``python -m shelfmark <job> ...``."""

import argparse

from pyspark.sql import SparkSession

from .checkpoints import scratch
from .plans import index, prepare, recommend, sentiment, statistics, topics
from .sources import files


def main() -> None:
    parser = argparse.ArgumentParser(prog="shelfmark", description="Catalogue and review analytics.")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, help_ in (("prepare", "raw JSON to curated datasets"),
                        ("statistics", "descriptive statistics as CSV"),
                        ("topics", "shelf topics and clusterings"),
                        ("sentiment", "review sentiment and book insights"),
                        ("recommend", "ALS metrics and recommendations"),
                        ("index", "bulk lines for a search index"),
                        ("inspect", "schema, first rows and row count of a dataset")):
        job = jobs.add_parser(name, help=help_)
        job.add_argument("source")
        if name != "inspect":
            job.add_argument("out")
        if name == "topics":
            job.add_argument("--json", action="store_true", help="source is the JSON sample")
        if name == "sentiment":
            job.add_argument("--lexicon", required=True, help="CSV with a header: word, polarity")
        if name == "recommend":
            job.add_argument("--blocks", type=int, help="number of user and item blocks")
        if name == "index":
            job.add_argument("--index", default="catalogue")
            job.add_argument("--docs-per-batch", type=int, default=500)
            job.add_argument("--docs-per-file", type=int, help="text files of so many documents instead of JSON rows")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"shelfmark-{args.job}").getOrCreate()
    with scratch(spark):
        run(spark, args)
    spark.stop()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "prepare":
        prepare.run(spark, args.source, args.out).show()
    elif args.job == "statistics":
        for name, frame in statistics.run(spark, args.source, args.out).items():
            print(name)
            frame.show(50, truncate=False)
    elif args.job == "topics":
        for name, frame in topics.run(spark, args.source, args.out, json=args.json).items():
            print(name)
            frame.show()
    elif args.job == "sentiment":
        lexicon = sentiment.read_lexicon(spark, args.lexicon)
        for name, frame in sentiment.run(spark, args.source, lexicon, args.out).items():
            print(name)
            frame.show(truncate=False)
    elif args.job == "recommend":
        recommend.run(spark, args.source, args.out, blocks=args.blocks).show()
    elif args.job == "index":
        index.run(spark, args.source, args.out, args.index, args.docs_per_batch, args.docs_per_file)
    else:
        for frame in files.profile_table(files.read_parquet(spark, args.source)):
            frame.show(50, truncate=False)


if __name__ == "__main__":
    main()
