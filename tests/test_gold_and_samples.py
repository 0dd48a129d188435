import pytest
from pyspark.sql import functions as F

from meterline.operators.columns import add_calendar
from meterline.operators.profile import column_profile, columns_with_values, output_statistics, table_checks
from meterline.operators.sample import preview, top_per_group
from meterline.plans.gold import MODELS, average_by_hour, average_by_month, build_gold
from meterline.sources.sinks import write_partitioned


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips(spark):
    return spark.sql("""
        SELECT CAST(o AS TINYINT) origin_id, CAST(t AS TIMESTAMP) pickup_datetime, CAST(p AS TINYINT) passenger_count,
               CAST(a AS DOUBLE) total_amount
        FROM VALUES (1, '2023-01-05 10:00:00', 1, 10), (1, '2023-01-06 11:00:00', 2, 20), (2, '2023-01-06 11:00:00', 2, 90),
                    (1, '2023-05-01 10:10:00', 3, 30), (2, '2023-05-02 10:20:00', 4, 40), (1, '2023-05-03 23:00:00', 6, -5),
                    (1, '2023-06-01 10:00:00', 1, 70), (1, '2022-05-01 10:00:00', 1, 80) AS v(o, t, p, a)""")


def test_questions(trips):
    assert [tuple(r) for r in average_by_month(trips).collect()] == [(1, 15.0), (5, 30.0)]
    assert [tuple(r) for r in average_by_hour(trips).collect()] == [(10, 3.5)]
    assert [tuple(r) for r in average_by_month(trips, cents=True).collect()] == [(1, 15.0), (5, 30.0)]


def test_questions_on_silver_prune_partitions_and_columns(spark, trips, tmp_path):
    path = str(tmp_path / "silver")
    write_partitioned(add_calendar(trips, "pickup_datetime"), path)
    silver = spark.read.parquet(path)
    answer = average_by_month(silver)
    assert [tuple(r) for r in answer.collect()] == [(1, 15.0), (5, 30.0)]
    text = answer._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "passenger_count" not in text.split("ReadSchema")[1][:200]
    tables = build_gold(spark, silver, str(tmp_path / "gold"))
    assert set(tables) == set(MODELS)
    assert sorted(tuple(r) for r in tables["avg_fare_by_month"].collect()) == [(1, 15.0), (5, 30.0)]
    assert [tuple(r) for r in tables["avg_passengers_by_hour"].collect()] == [(10, 3.5)]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5), ("a", 4), ("b", 3)], "g string, v int")
    top = top_per_group(df, ["g"], [F.col("v").desc()])
    assert sorted((r.g or "", r.v) for r in top.collect()) == [("", 2), ("a", 5), ("b", 3)]
    text = plan(top)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert top_per_group(df, ["g"], ["v"], k=2).count() == 5


def test_preview_is_a_top_n(spark):
    first = preview(spark.range(100), [F.col("id").desc()], 3)
    assert [r.id for r in first.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(first)


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame(
        [("N/A", 0.0, [1]), ("N/A", -0.0, [1]), (None, 1.0, [2])], "a string, b double, c array<int>"
    )
    want = {"a": (2, 3), "b": (2, 3), "c": (2, 3)}
    for approximate in (False, True):
        profile = column_profile(df, approximate).collect()
        assert {r.column_name: (r.n_unique, r.n_rows) for r in profile} == want
    assert profile[0].unique_ratio == pytest.approx(2 / 3)


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert column_profile(empty).count() == 0
    assert sorted(map(tuple, column_profile(empty, True).collect())) == [("a", 0, 0, None), ("b", 0, 0, None)]


def test_table_checks_and_values(spark):
    df = spark.createDataFrame([(1, None), (5, None)], "a int, b int")
    row = table_checks(df, small=F.col("a") < 3, known=F.col("b") > 0).first()
    assert (row.all_small, row.any_small, row.n_small) == (False, True, 1)
    assert (row.all_known, row.any_known, row.n_known) == (None, None, 0)
    assert {r.column_name: r.all_null for r in columns_with_values(df).collect()} == {"a": False, "b": True}


def test_output_statistics(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t"))
    row = output_statistics(spark, str(tmp_path / "t")).first()
    assert (row.row_count, row.n_files) == (10, 3) and row.size_bytes > 0


def test_profile_groups_each_column_in_its_own_type(spark):
    rows = [(1, 0.0, "a", [1]), (1, -0.0, "a", [1]), (2, float("nan"), None, None), (None, float("nan"), "b", [2])]
    df = spark.createDataFrame(rows, "n int, x double, s string, list array<int>").withColumn("t", F.timestamp_seconds("n"))
    want = [("list", 3, 4), ("n", 3, 4), ("s", 3, 4), ("t", 3, 4), ("x", 2, 4)]
    for frame in (df, df.distinct().unionAll(df.limit(1)), df.select("*", F.lit(None).alias("none")).drop("none")):
        profile = column_profile(frame)
        assert sorted(tuple(r)[:3] for r in profile.collect()) == want
        # No pairs of column and value: a column of many values shares its map with no other.
        assert "Expand" not in plan(profile)
