"""The stand-in data takes both sides of the outlier modes and of the floor."""

import pytest
from pyspark.sql import functions as F

from costlens.operators.outliers import iqr_bounds, treat_outliers
from costlens.plans.join_queries import GROUPS, _outlier_base
from costlens.plans import catalog  # noqa: F401
from costlens.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("mode", ["upper", "lower", "both", "none"])
def test_both_tails_are_treated(spark, mode):
    df = _outlier_base(spark, SF).na.drop(subset=list(GROUPS))
    marked = df.join(iqr_bounds(df, GROUPS, "cost_two"), list(GROUPS))
    low, high = marked.agg(F.count_if(F.col("cost_two") < F.col("lower_bound")), F.count_if(F.col("cost_two") > F.col("upper_bound"))).first()
    assert low > 0 and high > 0
    gone = {"upper": low, "lower": high, "both": 0, "none": low + high}[mode]
    assert treat_outliers(df, GROUPS, "cost_two", mode).count() == df.count() - gone


def test_floor_branches(spark):
    rows = QUERIES["floor_metrics_low"](spark, SF).collect()
    assert all(0 < r["pct_both_below"] < r["pct_lower_below"] and r["lifted_width_mean"] is not None for r in rows)
