"""Expectation suites (fixed values: the four stage suites of the panel pipeline).

Each entry is {"expectation_type": ..., "kwargs": {...}} in suite order.
"""

from __future__ import annotations


def _e(kind: str, **kwargs) -> dict:
    return {"expectation_type": kind, "kwargs": kwargs}


RAW_FACTS_SUITE = [
    _e("expect_table_row_count_to_be_between", min_value=100000, max_value=2000000),
    _e("expect_table_columns_to_match_ordered_list",
       column_list=["Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday",
                    "SchoolHoliday"]),
    _e("expect_column_values_to_not_be_null", column="Store"),
    _e("expect_column_values_to_not_be_null", column="Date"),
    _e("expect_column_values_to_not_be_null", column="DayOfWeek"),
    _e("expect_column_values_to_be_between", column="Sales", min_value=0, max_value=50000),
    _e("expect_column_values_to_be_between", column="Customers", min_value=0, max_value=10000, mostly=0.95),
    _e("expect_column_values_to_be_in_set", column="Open", value_set=[0, 1]),
    _e("expect_column_values_to_be_in_set", column="Promo", value_set=[0, 1]),
    _e("expect_column_values_to_be_in_set", column="DayOfWeek", value_set=[1, 2, 3, 4, 5, 6, 7]),
    _e("expect_column_values_to_be_in_set", column="StateHoliday", value_set=["0", "a", "b", "c", 0]),
    _e("expect_column_values_to_be_in_set", column="SchoolHoliday", value_set=[0, 1]),
    _e("expect_column_values_to_be_between", column="Store", min_value=1, max_value=1200),
]

RAW_DIM_SUITE = [
    _e("expect_table_row_count_to_be_between", min_value=1000, max_value=1200),
    _e("expect_table_columns_to_match_ordered_list",
       column_list=["Store", "StoreType", "Assortment", "CompetitionDistance", "CompetitionOpenSinceMonth",
                    "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear",
                    "PromoInterval"]),
    _e("expect_column_values_to_not_be_null", column="Store"),
    _e("expect_column_values_to_be_unique", column="Store"),
    _e("expect_column_values_to_be_in_set", column="StoreType", value_set=["a", "b", "c", "d"]),
    _e("expect_column_values_to_be_in_set", column="Assortment", value_set=["a", "b", "c"]),
    _e("expect_column_values_to_be_between", column="CompetitionDistance", min_value=0, max_value=100000,
       mostly=0.7),
    _e("expect_column_values_to_be_in_set", column="Promo2", value_set=[0, 1]),
    _e("expect_column_values_to_be_between", column="Store", min_value=1, max_value=1200),
]

PROCESSED_SUITE = [
    _e("expect_table_row_count_to_be_between", min_value=100000, max_value=2000000),
    *[_e("expect_column_to_exist", column=c)
      for c in ["Store", "Date", "Sales", "Open", "Promo", "StoreType", "Assortment"]],
    _e("expect_column_values_to_not_be_null", column="Store"),
    _e("expect_column_values_to_not_be_null", column="Date"),
    _e("expect_column_values_to_not_be_null", column="Sales"),
    _e("expect_column_values_to_be_between", column="Sales", min_value=0),
    _e("expect_column_values_to_be_in_set", column="Open", value_set=[0, 1]),
    _e("expect_column_values_to_be_in_set", column="Promo", value_set=[0, 1]),
    _e("expect_column_values_to_be_in_set", column="StoreType", value_set=["a", "b", "c", "d"]),
    _e("expect_column_values_to_be_in_set", column="Assortment", value_set=["a", "b", "c"]),
]

FEATURES_SUITE = [
    _e("expect_table_row_count_to_be_between", min_value=100000, max_value=2000000),
    *[_e("expect_column_to_exist", column=c)
      for c in ["Store", "Date", "Sales", "Year", "Month", "Week", "DayOfWeek"]],
    *[_e("expect_column_values_to_not_be_null", column=c) for c in ["Store", "Date", "Sales", "Year", "Month"]],
    _e("expect_column_values_to_be_between", column="Sales", min_value=0),
    _e("expect_column_values_to_be_between", column="Year", min_value=2013, max_value=2016),
    _e("expect_column_values_to_be_between", column="Month", min_value=1, max_value=12),
    _e("expect_column_values_to_be_between", column="Week", min_value=1, max_value=53),
    _e("expect_column_values_to_be_between", column="DayOfWeek", min_value=1, max_value=7),
]

# Expectations described for the panel (documented rules, V11-V16), parameterised here.
EXTENDED_SUITE = [
    _e("expect_column_mean_to_be_between", column="Sales", min_value=0, max_value=1000000),
    _e("expect_column_stdev_to_be_between", column="Sales", min_value=0, max_value=1000000),
    _e("expect_column_quantile_values_to_be_between", column="Sales",
       quantile_ranges={"quantiles": [0.05, 0.5, 0.95], "value_ranges": [[0, 50000], [0, 200000], [0, 500000]]}),
    _e("expect_column_unique_value_count_to_be_between", column="Store", min_value=1, max_value=1200),
    _e("expect_column_values_to_match_regex", column="PromoInterval", regex=r"^([A-Z][a-z]{2,3}(,|$))*$"),
    _e("expect_column_values_to_be_of_type", column="Sales", type_="double"),
    _e("expect_table_columns_to_match_set", column_set=[
        "Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday", "SchoolHoliday",
        "StoreType", "Assortment", "CompetitionDistance", "CompetitionOpenSinceMonth",
        "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval"]),
    _e("expect_column_values_to_not_be_infinite", column="CompetitionDistance"),
]
