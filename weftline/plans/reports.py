"""Counts and classes over the fact and dimension tables, and the warnings relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CONCAT,
    MISSING_BOTH,
    MISSING_SOURCE,
    MISSING_TARGET,
    NOT_FOUND,
    PARSE_FAILED,
    ROW_ERROR,
    ROWS,
    Profile,
    get_profile,
)
from ..operators.statements import missing_files


def labelled_counts(passthrough: str = CONCAT.passthrough) -> list[Column]:
    """Nine labelled counts over the fact table, as aggregates."""
    logic = F.col("transformation_logic")
    misses = [NOT_FOUND, PARSE_FAILED, MISSING_BOTH, MISSING_SOURCE, MISSING_TARGET]
    labelled = [
        ("Total Records", F.lit(True)),
        ("Transformations Found", ~logic.isin(misses)),
        ("Direct Pass Through", logic == passthrough),
        ("Static Value", F.upper(logic).startswith("STATIC")),
        ("Parse Failed (manual)", logic == PARSE_FAILED),
        ("Missing Source Column", logic == MISSING_SOURCE),
        ("Missing Target Column", logic == MISSING_TARGET),
        ("Missing Both Columns", logic == MISSING_BOTH),
        ("Transform Not Found", logic == NOT_FOUND),
    ]
    return [F.count_if(test).alias(label) for label, test in labelled]


def summary_metrics(fact: DataFrame, passthrough: str = CONCAT.passthrough) -> DataFrame:
    """Nine labelled counts as ``(category, n)``, in one pass over the fact table."""
    counts = fact.agg(*labelled_counts(passthrough))
    return counts.unpivot([], counts.columns, "category", "n")


def logic_counts(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(F.col("transformation_logic").alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "category")
    )


def summarize(fact: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """The summary table: counts per outcome for ``rows``, the labelled counts for ``concat``."""
    return logic_counts(fact) if get_profile(profile).multi_row else summary_metrics(fact)


def row_class(logic: Column, profile: str | Profile = "rows") -> Column:
    """Semantic class of a fact row; null where no class applies."""
    profile = get_profile(profile)
    upper = F.upper(F.trim(logic))
    if profile.multi_row:
        return (
            F.when(upper == ROWS.passthrough, "DIRECT_PASSTHRU")
            .when(upper == PARSE_FAILED, "PARSE_FAILED")
            .when(upper.startswith("MISSING"), "MISSING")
            .when(upper == "NULL", "NULL_LITERAL")
            .when(upper.contains("STATIC"), "STATIC")
            .when(upper == NOT_FOUND, "NF")
            .otherwise("FOUND")
        )
    return (
        F.when(logic == "", None)
        .when(logic.isin(MISSING_BOTH, MISSING_SOURCE, MISSING_TARGET), "MISSING")
        .when(logic == profile.passthrough, "DIRECT_PASSTHRU")
        .when(logic == PARSE_FAILED, "PARSE_FAILED")
        .when(F.upper(logic).startswith("STATIC"), "STATIC")
        .when(logic != NOT_FOUND, "FOUND")
    )


def class_counts(fact: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    classed = row_class(F.col("transformation_logic"), profile)
    return fact.groupBy(classed.alias("row_class")).agg(F.count(F.lit(1)).alias("n"))


def parse_status_counts(dim: DataFrame) -> DataFrame:
    return dim.groupBy("parse_status").agg(F.count(F.lit(1)).alias("n"))


def edges_per_file(edges: DataFrame) -> DataFrame:
    return edges.groupBy("parent").agg(F.count(F.lit(1)).alias("n"))


def missing_file_report(edges: DataFrame, sql_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number of missing files, and their names in order; show as many as wanted."""
    missing = missing_files(edges, sql_files)
    return missing.agg(F.count(F.lit(1)).alias("n")), missing.orderBy("parent")


def warnings(
    edges: DataFrame, sql_files: DataFrame, statements: DataFrame
) -> DataFrame:
    """Non-fatal findings as ``(parent, code, message)``."""
    missing = missing_files(edges, sql_files).select(
        "parent",
        F.lit("READ_ERROR").alias("code"),
        F.concat(F.lit("Missing SQL file: "), F.col("parent")).alias("message"),
    )
    failed = statements.where(
        (F.col("parse_status") != "OK") & (F.col("parse_error") != "NO_STATEMENTS")
    ).select(
        "parent",
        F.lit("PARSE_WARN").alias("code"),
        F.concat_ws(" ", F.lit("statement"), F.col("stmt_no").cast("string"), "parse_error").alias(
            "message"
        ),
    )
    return missing.unionByName(failed)


def row_warnings(edges: DataFrame) -> DataFrame:
    """One warning per edge that cannot be read, as given."""
    parent = F.coalesce("parent", F.lit(""))
    return edges.where(F.col(ROW_ERROR).isNotNull()).select(
        parent.alias("parent"),
        F.lit("ROW_ERROR").alias("code"),
        F.concat(F.lit("parent="), parent, F.lit(" err="), F.col(ROW_ERROR)).alias("message"),
    )


def first_warnings(warning_rows: DataFrame, n: int | None = None) -> DataFrame:
    """Warnings in order; only the first ``n`` if a display asks for that."""
    ordered = warning_rows.orderBy("parent", "code", "message")
    return ordered if n is None else ordered.limit(n)
