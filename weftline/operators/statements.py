"""From SQL files to a catalog of statements. Narrow work only: one scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DIM_COLUMNS, Profile, get_profile
from ..functions.names import bare_table, strip
from ..functions.shape import (
    IDENT,
    INNER,
    MERGE_WHEN,
    NAME,
    SELECT,
    cut,
    fold,
    from_first_select,
    is_balanced,
    until,
    unwrap,
)
from .spread import computed_once

# Comments.
_BLOCK_COMMENT = r"/\*[^*]*+\*++(?:[^*/][^*]*+\*++)*+/"
_LINE_COMMENT = r"--[^\n]*"
# Statements that define or maintain objects and carry no lineage.
_OTHER_VERBS = [
    "DROP", "ALTER", "COLLECT", "GRANT", "REVOKE", "CALL", "EXPLAIN", "SHOW", "HELP", "RENAME",
    "DATABASE", "COMMENT", "SET", "BT", "ET", "BEGIN", "END", "COMMIT", "EXEC", "EXECUTE",
]
_WRITES = "INSERT|INS|UPDATE|UPD|MERGE|DELETE|DEL"
_ONE_MODIFIER = ["", "MULTISET", "VOLATILE", "GLOBAL TEMPORARY"]
_DDL_OBJECTS = ["DROP TABLE", "ALTER TABLE", "ALTER COLUMN", "COLLECT STATISTICS"]


def strip_comments(sql: Column, profile: str | Profile = "rows") -> Column:
    """``rows``: block comments first, then line comments, a blank instead of each.
    ``concat``: line comments first, then block comments, nothing instead."""
    if get_profile(profile).multi_row:
        return F.regexp_replace(F.regexp_replace(sql, _BLOCK_COMMENT, " "), _LINE_COMMENT, " ")
    return F.regexp_replace(F.regexp_replace(sql, _LINE_COMMENT, ""), _BLOCK_COMMENT, "")


def split_statements(sql: Column, profile: str | Profile = "rows") -> Column:
    """Trimmed, non-empty statements between semicolons (also inside quotes)."""
    parts = F.split(strip_comments(sql, profile), ";")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def shell_variables(sql: Column, profile: str | Profile = "rows") -> Column:
    """Shell variable tokens in text order: ``$V``/``${V}`` for ``rows``, with the
    dotted name behind them for ``concat``."""
    name = r"[A-Za-z_][A-Za-z0-9_]*"
    pattern = rf"\$\{{?{name}\}}?" + ("" if get_profile(profile).multi_row else rf"\.{name}")
    return F.regexp_extract_all(sql, F.lit(pattern), F.lit(0))


def statement_id(parent: Column, stmt_no: Column, stmt: Column) -> Column:
    """Deterministic id, equal after any re-evaluation."""
    return F.md5(F.concat_ws("|", parent, stmt_no.cast("string"), stmt))


def placeholder_id(parent: Column) -> Column:
    """Id of the catalog row that stands for a file without statements."""
    return statement_id(parent, F.lit(0), F.lit(""))


def leading_words(stmt: Column) -> Column:
    """The words a statement starts with, upper case with single blanks, however many."""
    words = F.regexp_extract(strip(stmt), r"\A[\s(]*+((?:[A-Za-z_]\w*+(?:\s++|\b))*+)", 1)
    return F.upper(strip(F.regexp_replace(words, r"\s+", " ")))


def is_pure_ddl(stmt: Column) -> Column:
    return _pure_ddl(F.upper(stmt), leading_words(stmt))


def _pure_ddl(upper_sql: Column, head: Column) -> Column:
    """Maintenance of an object, or CREATE TABLE that takes no rows from a SELECT."""
    verb_object = F.substring_index(head, " ", 2)
    modifier = F.regexp_extract(head, r"\ACREATE (?:(.*?) )?TABLE\b", 1)
    makes_table = head.rlike(r"\ACREATE (?:.* )?TABLE\b") & modifier.isin(_ONE_MODIFIER)
    return verb_object.isin(_DDL_OBJECTS) | (
        makes_table & ~upper_sql.rlike(r"\bAS\b[\s(]*SELECT\b")
    )


def _created(head: Column) -> Column:
    """TABLE or VIEW, whichever follows CREATE or REPLACE first behind any modifiers."""
    return F.regexp_extract(head, r"\A(?:CREATE|REPLACE)(?: (?!TABLE\b|VIEW\b)\w+)*+ (TABLE|VIEW)\b", 1)


def behind_with(stmt: Column) -> Column:
    """The INSERT, UPDATE, MERGE or DELETE behind a leading WITH list, else empty."""
    return cut(stmt, rf"\A\s*WITH\b{until(f'{_WRITES}|{SELECT}')}(\b(?:{_WRITES})\b.*)\z")


def statement_kind(stmt: Column) -> Column:
    """Kind of a statement; that of the write behind a leading WITH list."""
    write = behind_with(stmt)
    return _kind(leading_words(F.when(write != "", write).otherwise(stmt)))


def _kind(s: Column) -> Column:
    """Kind of a statement from its :func:`leading_words`."""
    verb = F.substring_index(s, " ", 1)
    create = verb.isin("CREATE", "REPLACE")
    return (
        F.when(verb == "MERGE", "MERGE")
        .when(verb.isin("UPDATE", "UPD"), "UPDATE")
        .when(verb.isin("INSERT", "INS"), "INSERT")
        .when(verb.isin("DELETE", "DEL"), "DELETE")
        .when(verb.isin("SELECT", "SEL", "WITH"), "SELECT")
        .when(create & (_created(s) == "VIEW"), "VIEW")
        .when(create & (_created(s) == "TABLE"), "CTAS")
        .when(create, "CREATE")
        .when(verb.isin(_OTHER_VERBS), "DDL")
        .otherwise("OTHER")
    )


def select_body(stmt: Column) -> Column:
    """SELECT text of a CREATE or REPLACE statement, empty when there is none.

    The balanced text behind the header's AS if it holds a SELECT, else the tail
    from the first SELECT without a closing WITH [NO] DATA part.
    """
    body = cut(stmt, rf"\A{until('AS')}\bAS\b(.*)\z")
    wrapped = cut(body, rf"\A\(({INNER})\)")
    bare = strip(F.regexp_replace(body, r"(?is)\bWITH\s+(?:NO\s+)?DATA\b.*\z", ""))
    has_select = rf"(?i)\b{SELECT}\b"
    return (
        F.when(wrapped.rlike(has_select), wrapped)
        .when(bare.rlike(has_select), bare)
        .otherwise("")
    )


def strip_create_prefix(stmt: Column) -> Column:
    """Take off a CREATE … AS / REPLACE … AS head that a SELECT follows directly."""
    head = rf"(?is)\A\s*(?:CREATE|REPLACE)\b{until('AS')}\bAS\s+(?=SELECT\b)"
    return strip(F.regexp_replace(stmt, head, ""))


def write_target(stmt: Column, kind: Column) -> Column:
    """Bare name of the table or view a statement writes, else empty."""
    insert = cut(stmt, rf"\AINS(?:ERT)?\b\s*(?:INTO\b\s*)?({NAME})")
    update = cut(stmt, rf"\AUPD(?:ATE)?\b\s*({NAME})")
    merge = cut(stmt, rf"\AMERGE\b\s*(?:INTO\b\s*)?({NAME})")
    create = cut(stmt, rf"\A(?:CREATE|REPLACE)\s+(?:\w+\s+)*?(?:TABLE|VIEW)\s+({NAME})")
    return bare_table(
        F.when(kind == "INSERT", insert)
        .when(kind == "UPDATE", update)
        .when(kind == "MERGE", merge)
        .when(kind.isin("CTAS", "VIEW"), create)
        .otherwise("")
    )


def insert_parts(stmt: Column) -> tuple[Column, Column]:
    """``(column list, rest)`` of an INSERT; the rest is VALUES … or a SELECT."""
    columns = rf"(?:\((?!\s*(?:{SELECT}|WITH)\b)({INNER})\)\s*(?=VALUES\b|{SELECT}\b|WITH\b|\())?"
    head = rf"\AINS(?:ERT)?\b\s*(?:INTO\b\s*)?{NAME}\s*{columns}(.*)\z"
    return cut(stmt, head, 1), unwrap(cut(stmt, head, 2))


def _has_anchor(stmt: Column, body: Column, kind: Column) -> Column:
    depth0 = rf"(?is)\A{until('SET')}\bSET\b"
    _, rest = insert_parts(stmt)
    insert = rest.rlike(r"(?i)\A(?:VALUES)\s*\(") | (from_first_select(rest) != "")
    return (
        F.when(kind == "UPDATE", stmt.rlike(depth0))
        .when(kind == "INSERT", insert)
        .when(kind == "MERGE", stmt.rlike(rf"(?is)\b{MERGE_WHEN}\b"))
        .when(kind == "DELETE", stmt.rlike(rf"(?is)\A\w+\s+(?:FROM\s+|ALL\s+)*{IDENT}"))
        .when(kind.isin("SELECT", "CTAS", "VIEW"), from_first_select(unwrap(body)) != "")
        .otherwise(False)
    )


def statement_catalog(sql_files: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """One row per statement: id, text, kind, body, write target and parse status.

    A leading WITH list of a write is put aside as ``with_text``; ``sql`` is the rest.

    A file without statements keeps one placeholder row. ``sql`` is the text with its deepest
    groups folded, ``deep_selects`` has the bodies of SELECTs among them.
    """
    profile = get_profile(profile)
    exploded = sql_files.select(
        "parent",
        F.posexplode_outer(split_statements(F.col("sql_text"), profile)).alias("stmt_no", "stmt"),
    ).select(
        "parent",
        F.coalesce("stmt_no", F.lit(0)).alias("stmt_no"),
        F.coalesce("stmt", F.lit("")).alias("sql_query"),
    )
    full = F.col("sql_query")
    folded, deep_selects = fold(full)
    # Texts used by many tests are computed once, in a projection of their own.
    sized = exploded.select(
        statement_id(F.col("parent"), F.col("stmt_no"), full).alias("query_id"),
        "*",
        folded.alias("sql"),
        deep_selects.alias("deep_selects"),
        F.upper(full).alias("upper_sql"),
        leading_words(full).alias("head"),
    )
    sql = F.col("sql")
    write = F.when(F.col("head").rlike(r"\AWITH\b"), behind_with(sql)).otherwise("")
    is_write = F.col("write") != ""
    before = F.substr(sql, F.lit(1), F.length(sql) - F.length("write"))
    parted = sized.withColumns({"folded": sql, "write": write}).withColumns(
        {
            "with_text": F.when(is_write, before).otherwise(""),
            "sql": F.when(is_write, F.col("write")).otherwise(sql),
            "head": F.when(is_write, leading_words(F.col("write"))).otherwise(F.col("head")),
        }
    )
    typed = parted.withColumn("kind", _kind(F.col("head")))
    kind = F.col("kind")
    creates = kind.isin("CTAS", "VIEW", "CREATE")
    body = typed.withColumn(
        "body", F.when(creates, select_body(sql)).otherwise(sql)
    ).withColumn("anchored", _has_anchor(sql, F.col("body"), kind))
    code = (
        F.when(full == "", "NO_STATEMENTS")
        .when(_pure_ddl(F.col("upper_sql"), F.col("head")), "PURE_DDL_SKIPPED")
        .when(kind == "DDL", "DDL_NODE_SKIPPED")
        .when(creates & (F.col("body") == ""), "CREATE_NO_SELECT_SKIPPED")
        .when(~is_balanced(F.col("folded")), "UNBALANCED")
        .when(~F.col("anchored"), "UNSUPPORTED_STATEMENT")
        .otherwise("")
    )
    catalog = body.withColumn("parse_error", code).select(
        "query_id",
        "parent",
        "stmt_no",
        "sql_query",
        "sql",
        "with_text",
        "deep_selects",
        "body",
        "kind",
        F.when(F.col("parse_error") == "", write_target(sql, kind))
        .otherwise("")
        .alias("target_table"),
        F.when(F.col("parse_error") == "", "OK").otherwise("PARSE_FAILED").alias("parse_status"),
        "parse_error",
    )
    return computed_once(catalog)


def file_info(statements: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """Per file: default statement, first failed statement, first INSERT … VALUES.

    ``min_by`` combines on the map side, so a file costs one small row per task.
    """
    real = F.lit(True) if get_profile(profile).multi_row else F.col("sql_query") != ""
    ok = F.col("parse_status") == "OK"
    order = F.when(real, F.struct((~ok).alias("failed"), "stmt_no"))
    is_values = ok & F.col("sql_query").rlike(r"(?is)\AINS(?:ERT)?\b.*\bVALUES\s*\(")
    return statements.groupBy("parent").agg(
        F.min_by("query_id", order).alias("default_id"),
        F.min_by("query_id", F.when(real & ~ok, F.col("stmt_no"))).alias("failed_id"),
        F.min_by("query_id", F.when(is_values, F.col("stmt_no"))).alias("first_values_id"),
    )


def dim_rows(statements: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """Catalog rows in the output schema of the statement dimension."""
    profile = get_profile(profile)
    kept = statements if profile.multi_row else statements.where("sql_query <> ''")
    return kept.select(
        F.col("query_id").alias("query_uuid"),
        "sql_query",
        F.col("parent").alias("file_path"),
        "parse_status",
        "parse_error",
    )


def dedup_dim(dim: DataFrame) -> DataFrame:
    """One row per statement id. Not needed for :func:`statement_catalog`, whose ids
    are distinct as long as a file comes once; needed for several runs put together."""
    return dim.dropDuplicates(["query_uuid"])


def missing_files(edges: DataFrame, sql_files: DataFrame) -> DataFrame:
    """Distinct non-empty parents of the edges that have no SQL file."""
    return (
        edges.select("parent")
        .where(F.coalesce("parent", F.lit("")) != "")
        .distinct()
        .join(sql_files.select("parent"), "parent", "left_anti")
    )


def missing_dim_rows(missing: DataFrame) -> DataFrame:
    """Placeholder catalog rows for missing files."""
    return missing.select(
        placeholder_id(F.col("parent")).alias("query_uuid"),
        F.lit("").alias("sql_query"),
        F.col("parent").alias("file_path"),
        F.lit("PARSE_FAILED").alias("parse_status"),
        F.lit("FILE_NOT_FOUND").alias("parse_error"),
    ).select(*DIM_COLUMNS)
