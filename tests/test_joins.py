import pytest
from pyspark.sql import functions as F

from shelfmark.operators import joins
from shelfmark.operators.joins import hot_keys, skew_join

LOOK = {"sample": 1.0, "min_rows": 0, "share": 0.1}


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows share one key, a few have none."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None)
         .otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
        F.col("id").alias("n"))


@pytest.fixture(scope="module")
def dim(spark):
    keys = ["hot", "hot", *[f"k{i}" for i in range(20)], "unused", None]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, label int")


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_hot_keys_are_found(fact):
    assert hot_keys(fact, "key", **LOOK) == {"hot": 4}     # a third of the rows, in parts of a tenth
    assert hot_keys(fact, "key") == {}                       # too few rows for a key to matter
    assert hot_keys(fact.filter("key IS NULL"), "key", **LOOK) == {None: 10}


def test_hot_keys_are_bounded(spark):
    many = spark.range(4000).select(F.floor(F.sqrt(F.col("id") % 1000)).alias("key"))
    found = hot_keys(many, "key", share=0.05, sample=1.0, min_rows=0)
    assert found and sum(found.values()) <= 2 / 0.05


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [{"hot": 7}, {"hot": 64, "k1": 2, "not there": 3, "k30": 1}, {None: 5}, {None: 3, "k2": 4}])
def test_salting_changes_no_result(fact, dim, how, hot):
    salted = skew_join(fact, dim, "key", how, hot=hot)
    assert rows(salted) == rows(fact.join(dim, "key", how))


@pytest.fixture
def plain_joins(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_task(joined):
    return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_hot_rows_are_spread_over_the_tasks(plain_joins, fact, dim):
    assert largest_task(skew_join(fact, dim, "key", "left_semi", hot={})) >= 1000
    assert largest_task(skew_join(fact.repartition(40), dim, "key", "left_semi", hot={"hot": 64}, salt=["n"])) < 500


def test_equal_rows_and_nulls_are_spread(plain_joins, spark, dim):
    """A fact of nothing but the key, in 40 partitions: the row itself cannot tell its copies apart."""
    only = spark.range(0, 8000, 1, 40).select(F.when(F.col("id") % 2 == 0, "hot").alias("key"))
    joined = skew_join(only, dim.distinct().dropDuplicates(["key"]), "key", "left", hot={"hot": 64, None: 64})
    assert joined.count() == 8000
    assert largest_task(joined) < 2500


def test_salting_reads_no_more_columns(plain_joins, spark, tmp_path):
    spark.range(100).selectExpr("id AS key", "string(id) AS wide", "id AS narrow").write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    dim = spark.range(10).selectExpr("id AS key", "id AS y")
    plan = skew_join(fact, dim, "key", hot={3: 4}).select("narrow", "y")._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan


def test_a_small_side_is_not_searched(spark, fact, dim, monkeypatch):
    small = spark.range(30).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    monkeypatch.setattr(joins, "hot_keys", lambda *_: pytest.fail("searched"))
    assert rows(skew_join(fact, small.withColumnRenamed("id", "m"), "key")) == rows(
        fact.join(small.withColumnRenamed("id", "m"), "key"))


def test_joins_that_would_repeat_rows_are_refused(fact, dim):
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            skew_join(fact, dim, "key", how, hot={"hot": 2})


def test_number_keys(spark):
    fact = spark.range(900).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("key"), "id")
    dim = spark.range(0, 900, 2).select(F.col("id").alias("key"), F.lit("x").alias("y")).unionByName(
        spark.createDataFrame([(7, "z")], "key long, y string"))
    for how in ("inner", "left"):
        assert rows(skew_join(fact, dim, "key", how, hot={7: 5})) == rows(fact.join(dim, "key", how))
