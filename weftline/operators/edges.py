"""Lineage edges: checks, normal form, input dedup and the gate each edge takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEDUP_KEY, EDGE_COLUMNS, NULL_LITERAL, ROW_ERROR, Profile, get_profile
from ..functions import names as N
from .candidates import ASSIGNED, READ_COLUMN, TARGET_TABLE


def check_columns(edges: DataFrame) -> DataFrame:
    """Raise when a required column is missing; runs no job."""
    missing = [c for c in EDGE_COLUMNS if c not in edges.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return edges


def with_row_id(edges: DataFrame) -> DataFrame:
    """Keep the given ``row_id``, else number the rows by their position in the table."""
    if "row_id" in edges.columns:
        return edges
    return edges.withColumn("row_id", F.monotonically_increasing_id())


def with_file_key(edges: DataFrame) -> DataFrame:
    """``parent`` becomes the key of the SQL file, ``parent_given`` keeps the input's text.

    Edges without a column ``row_error`` have no errors.
    """
    check_columns(edges)
    if ROW_ERROR not in edges.columns:
        edges = edges.withColumn(ROW_ERROR, F.lit(None).cast("string"))
    key = "parent_key" if "parent_key" in edges.columns else "parent"
    keyed = with_row_id(edges).withColumn("parent_given", F.col("parent"))
    names = ["row_id", *EDGE_COLUMNS, "parent_given", ROW_ERROR]
    return keyed.withColumn("parent", F.col(key)).select(*names)


def dedup_edges(edges: DataFrame) -> DataFrame:
    """First row (by ``row_id``) per tables, columns and parent; rows with errors by error too.

    An aggregate, not a window: copies are merged on the map side, so a large
    group of copies never meets in one task.
    """
    key = DEDUP_KEY + [c for c in edges.columns if c in ("parent_given", ROW_ERROR)]
    others = [c for c in edges.columns if c not in key and c != "row_id"]
    first = F.min(F.struct("row_id", *others)).alias("first")
    # This aggregate sorts, as a struct of texts has no fixed width: the column with the most
    # values in front settles comparisons that else run over several equal texts.
    return (
        edges.groupBy(*sorted(key, key=lambda c: c != "parent"))
        .agg(first)
        .select("first.row_id", *key, *[f"first.{c}" for c in others])
    )


def sanitize_edges(edges: DataFrame) -> DataFrame:
    texts = [c for c in edges.columns if c in EDGE_COLUMNS or c == "parent_given"]
    return edges.withColumns({c: N.sanitize(F.col(c)) for c in texts})


def normalize_edges(edges: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """Add names in comparable form to cleaned edges: ``src_name``/``tgt_name`` as written,
    ``src_col``/``tgt_col`` as looked up, ``src_tbl``/``tgt_tbl``, ``rel``, ``is_static``."""
    rows = get_profile(profile).multi_row

    def upper(name: str) -> Column:
        return F.upper(N.strip(F.coalesce(name, F.lit(""))))

    def table(name: str) -> Column:
        return N.bare_name(upper(name)) if rows else N.bare_table_ident(F.col(name))

    named = edges.withColumns(
        {
            "src_name": N.normalize_column(F.col("source_column")),
            "tgt_name": N.normalize_column(F.col("target_column")),
            "src_tbl": table("source_table"),
            "tgt_tbl": table("target_table"),
            "rel": upper("relation"),
        }
    )
    look: dict[str, Column] = {"src_col": F.col("src_name"), "tgt_col": F.col("tgt_name")}
    if rows:
        look = {
            k: N.last_dotted(F.replace(v, F.lit('"'), F.lit(""))) for k, v in look.items()
        }
    return named.withColumns(look).withColumn("is_static", N.is_static_marker(F.col("src_name")))


def with_gate(edges: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """The first gate that applies, and the lookup the edge needs for it."""
    rows = get_profile(profile).multi_row
    src, tgt = F.col("src_name"), F.col("tgt_name")
    if rows:
        star = (src == "*") | (tgt == "*")
    else:
        star = F.coalesce(F.col("source_column") == "*", F.lit(False)) | F.coalesce(
            F.col("target_column") == "*", F.lit(False)
        )
    broken = F.col(ROW_ERROR).isNotNull() if ROW_ERROR in edges.columns else F.lit(False)
    gate = (
        F.when(broken, "row_error")
        .when(F.coalesce("parent", F.lit("")) == "", "file_error")
        .when((src == NULL_LITERAL) | (tgt == NULL_LITERAL), "null")
        .when(star, "wildcard")
        .when((F.col("rel") == "READ") & (src != "") & (tgt == ""), "read")
        .when((src == "") & (tgt == ""), "missing_both")
        .when(src == "", "missing_source")
        .when(tgt == "", "missing_target")
        .when(F.col("is_static"), "static")
        .otherwise("normal")
    )
    gated = edges.withColumn("gate", gate)
    on_column = F.col("gate").isin("null", "static", "normal")
    if not rows:
        on_column = on_column & (tgt != NULL_LITERAL)
    kind = (
        F.when(on_column, ASSIGNED)
        .when(F.col("gate") == "wildcard", TARGET_TABLE)
        .when((F.col("gate") == "read") & F.lit(not rows), READ_COLUMN)
        .otherwise("")
    )
    keyed = gated.withColumn("kind", kind)
    key = (
        F.when(F.col("kind") == ASSIGNED, F.col("tgt_col"))
        .when(F.col("kind") == TARGET_TABLE, F.col("tgt_tbl"))
        .when(F.col("kind") == READ_COLUMN, F.col("src_col"))
        .otherwise("")
    )
    return keyed.withColumn("key", key)


# What decides an edge's outcome. Raw texts matter only where an outcome shows them.
CASE_COLUMNS = [
    "parent", "gate", "kind", "key", "src_name", "tgt_name", "src_col", "tgt_col", "src_tbl",
    "tgt_tbl", "shown_column", "shown_target", "shown_table", "shown_target_table",
]


def with_case(gated: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """Add the raw texts that outcomes show and ``case_id``, equal for edges that ask the same."""
    shows = F.col("gate").isin("wildcard", "read") & F.lit(not get_profile(profile).multi_row)
    raw = {
        "shown_column": "source_column",
        "shown_target": "target_column",
        "shown_table": "source_table",
        "shown_target_table": "target_table",
    }
    shown = gated.withColumns({k: F.when(shows, F.col(v)) for k, v in raw.items()})
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("0")) for c in CASE_COLUMNS]
    # 16 bytes, half of the digest's text: many rows carry it.
    return shown.withColumn("case_id", F.unhex(F.md5(F.concat_ws("\x1f", *parts))))


def cases(prepared: DataFrame) -> DataFrame:
    """The distinct cases of prepared edges; copies merge on the map side."""
    return prepared.select("case_id", *CASE_COLUMNS).distinct()
