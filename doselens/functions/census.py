"""County population fields."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, as_column

# State code to postal code.
STATE_POSTAL_CODES = {
    1: "AL", 2: "AK", 4: "AZ", 5: "AR", 6: "CA", 8: "CO", 9: "CT", 10: "DE",
    11: "DC", 12: "FL", 13: "GA", 15: "HI", 16: "ID", 17: "IL", 18: "IN",
    19: "IA", 20: "KS", 21: "KY", 22: "LA", 23: "ME", 24: "MD", 25: "MA",
    26: "MI", 27: "MN", 28: "MS", 29: "MO", 30: "MT", 31: "NE", 32: "NV",
    33: "NH", 34: "NJ", 35: "NM", 36: "NY", 37: "NC", 38: "ND", 39: "OH",
    40: "OK", 41: "OR", 42: "PA", 44: "RI", 45: "SC", 46: "SD", 47: "TN",
    48: "TX", 49: "UT", 50: "VT", 51: "VA", 53: "WA", 54: "WV", 55: "WI",
    56: "WY", 72: "PR",
}

# Survey variable to bronze column.
CENSUS_VARIABLES = {
    "DP05_0001E": "Total_Population",
    "DP05_0002E": "Male_Population",
    "DP05_0003E": "Female_Population",
    "DP05_0005E": "Under_5_Population",
    "DP05_0006E": "5_To_9_Population",
    "DP05_0007E": "10_To_14_Population",
    "DP05_0008E": "15_To_19_Population",
    "DP05_0009E": "20_To_24_Population",
    "DP05_0010E": "25_To_34_Population",
    "DP05_0011E": "35_To_44_Population",
    "DP05_0012E": "45_To_54_Population",
    "DP05_0013E": "55_To_59_Population",
    "DP05_0014E": "60_To_64_Population",
    "DP05_0015E": "65_To_74_Population",
    "DP05_0016E": "75_To_84_Population",
    "DP05_0017E": "85_Plus_Population",
    "DP05_0068E": "White_Population",
    "DP05_0069E": "Black_Or_African_American_Population",
    "DP05_0070E": "American_Indian_And_Alaska_Native_Population",
    "DP05_0071E": "Asian_Population",
    "DP05_0072E": "Native_Hawaiian_And_Other_Pacific_Islander_Population",
    "DP05_0073E": "Some_Other_Race_Population",
}

# Bronze column to cleaned column.
POPULATION_COLUMNS = {
    "Total_Population": "total_population",
    "Male_Population": "male_population",
    "Female_Population": "female_population",
    "Under_5_Population": "pop_under_5",
    "5_To_9_Population": "pop_5_to_9",
    "10_To_14_Population": "pop_10_to_14",
    "15_To_19_Population": "pop_15_to_19",
    "20_To_24_Population": "pop_20_to_24",
    "25_To_34_Population": "pop_25_to_34",
    "35_To_44_Population": "pop_35_to_44",
    "45_To_54_Population": "pop_45_to_54",
    "55_To_59_Population": "pop_55_to_59",
    "60_To_64_Population": "pop_60_to_64",
    "65_To_74_Population": "pop_65_to_74",
    "75_To_84_Population": "pop_75_to_84",
    "85_Plus_Population": "pop_85_plus",
    "White_Population": "pop_white",
    "Black_Or_African_American_Population": "pop_black",
    "American_Indian_And_Alaska_Native_Population": "pop_amer_indian_ak_native",
    "Asian_Population": "pop_asian",
    "Native_Hawaiian_And_Other_Pacific_Islander_Population": "pop_hawaiian_pac_islander",
    "Some_Other_Race_Population": "pop_other_race",
}

# Broad band to the cleaned columns it sums (Q8).
BROAD_AGE_BANDS = {
    "pop_0_to_19_approx": ["pop_under_5", "pop_5_to_9", "pop_10_to_14", "pop_15_to_19"],
    "pop_20_to_54_approx": ["pop_20_to_24", "pop_25_to_34", "pop_35_to_44", "pop_45_to_54"],
    "pop_50_to_64_approx": ["pop_55_to_59", "pop_60_to_64"],
    "pop_65_plus": ["pop_65_to_74", "pop_75_to_84", "pop_85_plus"],
}


def state_postal_code(code: ColumnOrName) -> Column:
    """State number to postal code, null where there is none."""
    by_number = F.array(
        *[
            F.lit(STATE_POSTAL_CODES.get(number)).cast("string")
            for number in range(max(STATE_POSTAL_CODES) + 1)
        ]
    )
    return F.get(by_number, as_column(code))


def total_of(names: list[str]) -> Column:
    """Row sum that is null when any part is null."""
    return reduce(add, [F.col(name) for name in names])
