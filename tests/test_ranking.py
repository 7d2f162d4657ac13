import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwise.operators.ranking import with_global_rank


def check(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v bigint").repartition(7)
    expected = df.withColumn("r", F.rank().over(Window.orderBy(F.desc_nulls_last("v"))))
    found = with_global_rank(df, "v", "r")
    assert sorted(map(tuple, found.select("id", "r").collect())) == sorted(
        map(tuple, expected.select("id", "r").collect())
    )


def test_matches_single_task_rank(spark):
    rng = random.Random(7)
    check(spark, [rng.randint(0, 400) for _ in range(2000)])


def test_ties_across_most_rows_and_nulls(spark):
    check(spark, [5] * 700 + [None] * 40 + list(range(300)))


def test_few_values(spark):
    check(spark, [1])
    check(spark, [None, None])
    check(spark, [2, 2, 1])


def test_no_rows(spark):
    df = spark.createDataFrame([], "id int, v bigint")
    assert with_global_rank(df, "v", "r").count() == 0
