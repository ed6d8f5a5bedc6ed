"""Exact distributed quantile == NumPy linear quantile on arbitrary inputs (property test)."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.quantile import exact_quantiles

values = st.lists(st.one_of(st.integers(-5, 5).map(float),
                            st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=300)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, q=st.sampled_from([0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]), acc=st.sampled_from([10, 100, 10_000]))
def test_exact_quantile_property(spark, vals, q, acc):
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    got = exact_quantiles(df, ["x"], q, accuracy=acc)["x"]
    want = float(np.quantile(np.array(vals), q))
    assert abs(got - want) <= 1e-9 * max(1.0, abs(want))


def test_collected_slice_stays_small(spark, monkeypatch):
    """Whatever the column's length, at most ``most`` values reach the driver."""
    import numpy as np
    from pyspark.sql import functions as F

    from tidemark.operators.quantile import exact_quantiles
    DataFrame = type(spark.range(1))
    seen, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(real(self)) or seen[-1])
    for n in (2_000, 40_000, 200_000):
        df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("x"))
        values = [r.x for r in real(df)]
        got = exact_quantiles(df, ["x"], 0.999, accuracy=500, most=300)["x"]
        assert got == np.quantile(values, 0.999)
    assert max(map(len, seen)) <= 300
