"""Fixed values of the lineage rules, and the rule sets (profiles) built from them."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Input and output contracts.
EDGE_COLUMNS = [
    "source_table",
    "source_column",
    "target_table",
    "target_column",
    "relation",
    "parent",
    "parent_type",
]
FACT_COLUMNS = EDGE_COLUMNS + ["transformation_logic", "query_uuid"]
DIM_COLUMNS = ["query_uuid", "sql_query", "file_path", "parse_status", "parse_error"]
DEDUP_KEY = ["source_table", "source_column", "target_table", "target_column", "parent"]

# Words that stand for a missing cell, lower case.
NA_WORDS = ["", "nan", "none", "na", "n/a", "#n/a"]

# Cells that a lineage CSV reader turns into a missing value.
CSV_NA_VALUES = ["", "NA", "N/A", "#N/A", "None", "none"]

# Source names that mean "a constant is written".
STATIC_MARKERS = [
    "*",
    "STATIC",
    "STATICVALUE",
    "STATIC VALUE",
    "STATIC_VALUE",
    "HARDCODED",
    "HARDCODED VALUE",
    "HARDCODED_VALUE",
    "LITERAL",
    "LITERAL VALUE",
    "LITERAL_VALUE",
    "CONSTANT",
    "CONSTANT VALUE",
    "CONSTANT_VALUE",
    "DERIVED",
]

# Outcome words of transformation_logic.
NULL_LITERAL = "NULL"
NOT_FOUND = "TRANSFORM_NOT_FOUND"
PARSE_FAILED = "PARSE_FAILED"
MISSING_SOURCE = "MISSING_SOURCE_COLUMN"
MISSING_TARGET = "MISSING_TARGET_COLUMN"
MISSING_BOTH = "MISSING_BOTH_COLUMNS"
PROCESSING_ERROR = "PROCESSING_ERROR"
EXTRACT_ERROR = "EXTRACT_ERROR"

# Column of edges that says why a row cannot be explained; null where it can.
ROW_ERROR = "row_error"

# Texts that describe reads and wildcards.
READ_PROJECTION = "Read in SELECT projection: "
READ_NAMED_PROJECTION = "Read in SELECT (aliased as "
READ_JOIN = "Read in JOIN ON condition: "
READ_WHERE = "Read in WHERE filter: "
READ_GROUP_BY = "Read in GROUP BY clause"
READ_ORDER_BY = "Read in ORDER BY clause"
READ_INPUT = "Read as input column"
WILDCARD_ROWS = "Wildcard SELECT * - all source columns"
WILDCARD_ALL = "Wildcard SELECT * — all source columns"
WILDCARD_DELETE = "Wildcard DELETE — affects all rows"

# Output names of the ``concat`` rules.
CONCAT_OUTPUTS = [
    "Enterprise_Fact_Lineage",
    "Enterprise_Dim_Queries",
    "Summary",
    "lineage_extractor",
]


@dataclass(frozen=True)
class Profile:
    """One rule set.

    ``rows`` writes one fact row per best candidate, ``concat`` writes one row
    per edge and joins distinct candidates with `` | ``; ``patched`` is
    ``concat`` with every hit of a statement kept and the leading alias checked.
    """

    name: str
    multi_row: bool
    passthrough: str
    static_fallback: str
    all_hits: bool = False
    check_leading_alias: bool = False


ROWS = Profile("rows", True, "DIRECT_PASS_THROUGH", "STATIC_VALUE")
CONCAT = Profile("concat", False, "Direct pass through", "STATIC")
PATCHED = replace(CONCAT, name="patched", all_hits=True, check_leading_alias=True)
PROFILES = {p.name: p for p in (ROWS, CONCAT, PATCHED)}


def get_profile(profile: str | Profile) -> Profile:
    if isinstance(profile, Profile):
        return profile
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, expected one of {sorted(PROFILES)}")
    return PROFILES[profile]
