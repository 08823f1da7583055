"""Rolling features sort and window a few columns, however wide the events are."""

from pyspark.sql import functions as F

from millrace.operators import features
from tests.test_slices import arrivals


def windows(plan):
    """How many columns each window of a plan gives."""
    own = [plan.output().size()] if plan.nodeName() == "Window" else []
    return own + [n for k in range(plan.children().size()) for n in windows(plan.children().apply(k))]


def test_windows_carry_other_columns_as_one(spark):
    df = arrivals(spark).withColumns({f"other_{k}": F.lit(k) + F.col("offset") for k in range(60)})
    plain = features.rolling_features(df)
    assert plain.columns[: len(df.columns) + 1] == [*df.columns, "eff"]
    held = windows(plain._jdf.queryExecution().optimizedPlan())
    # before, each carried the 60 columns too
    assert held and max(held) < 60
    with_eff = features.rolling_features(features.with_effective_time(df))
    assert with_eff.columns == plain.columns
    assert sorted(map(str, with_eff.collect())) == sorted(map(str, plain.collect()))
    assert plain.filter("other_59 <> offset + 59").count() == 0
