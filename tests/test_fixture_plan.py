"""The raw rows' lists are made without a function called for each line of an order, but for the one that pads."""

from rosterlens.sources.fixtures import raw_profiles

from conftest import SF_SMALL


def test_lists_of_raw_rows_are_slices(spark):
    plan = raw_profiles(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    assert plan.count("transform(") <= 2  # the value and the test that it is not empty
