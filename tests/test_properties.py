"""Property tests with generated data (few examples: each runs Spark jobs)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitalframe.operators import aggregate as AG
from vitalframe.operators import phases as PH

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False, allow_infinity=False), min_size=1, max_size=300),
       st.sampled_from([0.0, 0.1, 0.5, 0.9, 0.999, 1.0]))
def test_quantile_equals_numpy(spark, vals, q):
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, v double")
    got = AG.quantile_by(df, ["g"], "v", q).first().q
    assert abs(got - float(np.quantile(np.array(vals), q))) <= 1e-9 * max(1.0, abs(got))


def _islands_brute(hours):
    """hours: {hour: max value}; islands of consecutive hours in the same state."""
    hs = sorted(hours)
    state = {h: int(hours[h] >= 22) for h in hs}
    out, i = {}, 0
    while i < len(hs):
        j = i
        while j + 1 < len(hs) and hs[j + 1] == hs[j] + 1 and state[hs[j + 1]] == state[hs[i]]:
            j += 1
        length = j - i + 1
        for h in hs[i:j + 1]:
            out[h] = (int(state[h] == 1 and length <= 2), int(state[h] == 1 and length > 2))
        i = j + 1
    return out


@SETTINGS
@given(st.dictionaries(st.integers(0, 60), st.floats(0, 40, allow_nan=False), min_size=1, max_size=40))
def test_islands_equal_brute_force(spark, hours):
    rows = [(1, "ICP", h * 60 + 1, float(v)) for h, v in hours.items()]
    df = spark.createDataFrame(rows, "pat_id long, measure string, rel_time long, value double")
    got = {r.rel_time_hour: (r.critical_short, r.critical_long) for r in PH.critical_phases(df).collect()}
    assert got == _islands_brute(hours)
