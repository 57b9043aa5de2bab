"""Positional layouts of the five CSV feeds and the typed staging schemas.

Each feed is read as all-string columns ``c1..cN`` and projected by position:
``(position, name, type)``. A position missing from a layout is read and dropped
(the listing feed skips its second field).
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, STR, DOUBLE, BOOL, DATE = "bigint", "string", "double", "boolean", "date"

FEEDS: dict[str, list[tuple[int, str, str]]] = {
    "listings": [
        (1, "listing_id", LONG),
        (3, "scraped_date", DATE),
        (4, "host_id", LONG),
        (5, "host_name", STR),
        (6, "host_since", STR),
        (7, "host_is_superhost", BOOL),
        (8, "host_neighbourhood", STR),
        (9, "listing_neighbourhood", STR),
        (10, "property_type", STR),
        (11, "room_type", STR),
        (12, "accommodates", LONG),
        (13, "price", LONG),
        (14, "has_availability", BOOL),
        (15, "availability_30", LONG),
        (16, "number_of_reviews", LONG),
        (17, "review_scores_rating", LONG),
        (18, "review_scores_accuracy", LONG),
        (19, "review_scores_cleanliness", LONG),
        (20, "review_scores_checkin", LONG),
        (21, "review_scores_communication", LONG),
        (22, "review_scores_value", LONG),
    ],
    "census_1": [
        (1, "lga_code_2016", STR),
        (2, "tot_p_m", LONG),
        (3, "tot_p_f", LONG),
        (4, "tot_p_p", LONG),
    ],
    "census_2": [
        (1, "lga_code_2016", STR),
        (2, "median_age_persons", LONG),
        (3, "median_mortgage_repay_monthly", LONG),
        (4, "median_tot_prsnl_inc_weekly", LONG),
        (5, "median_rent_weekly", LONG),
        (6, "median_tot_fam_inc_weekly", LONG),
        (7, "average_num_psns_per_bedroom", DOUBLE),
        (8, "median_tot_hhd_inc_weekly", LONG),
        (9, "average_household_size", DOUBLE),
    ],
    "lga_code": [
        (1, "lga_code", STR),
        (2, "lga_name", STR),
    ],
    "lga_suburb": [
        (1, "lga_name", STR),
        (2, "suburb_name", STR),
    ],
}


def width(feed: str) -> int:
    """Number of physical CSV fields of a feed."""
    return max(p for p, _, _ in FEEDS[feed])


def raw_schema(feed: str) -> T.StructType:
    """All-string schema c1..cN used to read a feed by position."""
    return T.StructType([T.StructField(f"c{i}", T.StringType(), True)
                         for i in range(1, width(feed) + 1)])


def typed_schema(feed: str) -> T.StructType:
    """The staging schema a feed has after the positional projection."""
    mapping = {LONG: T.LongType(), STR: T.StringType(), DOUBLE: T.DoubleType(),
               BOOL: T.BooleanType(), DATE: T.DateType()}
    return T.StructType([T.StructField(n, mapping[t], True) for _, n, t in FEEDS[feed]])


def columns(feed: str) -> list[str]:
    return [n for _, n, _ in FEEDS[feed]]
