"""What one task sorts is bounded: tasks follow the rows, and generated methods are small enough to be compiled."""

from pyspark.sql import functions as F

from millrace.operators import features
from millrace.plans import views
from millrace.sources import tables
from millrace.workspace import tasks_for
from tests.test_slices import arrivals


def test_tasks_follow_the_rows(spark, sf_dir, tmp_path):
    assert [tasks_for(spark, n) for n in (0, 400_000, 400_001, 36_000_000)] == [4, 4, 5, 360]
    views.source(spark, sf_dir)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    df = arrivals(spark)
    sliced = features.sliced_features(df, tasks=7)
    assert "_slice" in (plan := sliced._jdf.queryExecution().executedPlan().toString()) and ", 7), REPARTITION_BY_NUM" in plan
    assert sorted(map(str, sliced.collect())) == sorted(map(str, features.sliced_features(df).collect()))
    tables.write_events(df, str(tmp_path / "events"), 3, tasks=9)
    stored = spark.read.parquet(str(tmp_path / "events"))
    assert stored.count() == 1500 and stored.select(F.input_file_name()).distinct().count() > stored.select("event_date").distinct().count()
