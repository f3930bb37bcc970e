"""What models are fitted on: staging rows computed once, vectors without a column a level."""

from pyspark.sql import functions as F

from skydrift.operators.features import Preprocessor
from skydrift.plans.model_queries import _split

SMALL = "/root/testdata/sf0.001"


def _rows(spark):
    return spark.range(200).selectExpr(
        "cast(id as string) as id", "if(id % 9 = 0, null, concat('k', id % 4)) as k", "if(id % 13 = 0, null, cast(id % 6 as int)) as n",
        "id % 3 as m", "cast(id % 2 as double) as half", "concat('w', id % 23) as who", "if(id % 11 = 0, null, id % 13 + 0.5) as x",
        "id * 3.0 as far", "cast(id % 5 as double) as y")


def test_vectors_without_columns_are_the_same(spark):
    df = _rows(spark)
    fitted = Preprocessor(low_card_cols=["k", "n", "m", "half"], high_card_cols=["who"], numeric_cols=["x"], skewed_numeric_cols=["far"],
                          target="y", fold_key="id").fit(df)
    unseen = df.withColumn("k", F.when(F.col("m") == 2, "new").otherwise(F.col("k"))).withColumn("n", F.col("n") + F.when(F.col("m") == 1, 100).otherwise(0))
    for rows, training in ((df, True), (df, False), (unseen, False)):
        want = fitted.transform(rows, training=training)
        got = fitted.transform(rows, training=training, columns=False)
        assert not [c for c in got.columns if c.startswith(("k__", "n__", "m__")) and not c.endswith("__onehot")]
        assert sorted(map(repr, got.select("id", "features").collect())) == sorted(map(repr, want.select("id", "features").collect()))


def test_parts_are_scans_of_staging_rows_written_once(spark):
    for part in _split(spark, SMALL):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Aggregate" not in plan


def test_log_rows_come_from_given_staging_rows(spark):
    from skydrift.plans.log_queries import _log
    from skydrift.sources.fixtures import fx_stg
    stg = fx_stg(spark, SMALL).limit(20).persist()
    assert _log(spark, "/no/such/folder", stg).count() == 20
    stg.unpersist()
