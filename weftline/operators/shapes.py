"""From statements to their contents: tables, assignments and read contexts.

Every relation here comes from its statement row alone (explode, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import names as N
from ..functions import shape as S
from .spread import computed_once
from .statements import insert_parts

SET, MERGE_SET, MERGE_INSERT, INSERT_SELECT, VALUES, SELECT = (
    "set",
    "merge_set",
    "merge_insert",
    "insert_select",
    "values",
    "select",
)
FAILED = "FAILED"
_SELECT_KINDS = ["SELECT", "CTAS", "VIEW"]
# Words of expressions that are never column names.
_EXPRESSION_WORDS = [
    "ALL", "AND", "ASC", "BETWEEN", "CASE", "DESC", "DISTINCT", "ELSE", "END", "ESCAPE", "EXISTS",
    "FROM", "GROUP", "IN", "IS", "JOIN", "LIKE", "NOT", "NULL", "ON", "OR", "ORDER", "OVER",
    "PARTITION", "SELECT", "THEN", "WHEN", "WHERE",
]
# Literals with a word before or behind the quotes.
_LITERAL = (
    rf"(?i:\b(?:DATE|TIME|TIMESTAMP)\s*(?={S.QUOTED}))"
    rf"|(?i:\bINTERVAL\s*(?:{S.QUOTED})\s*\w+(?:\s*\(\d+\))?(?:\s+TO\s+\w+)?)"
)
# Places whose words name no column: units, types and aliases behind AS, constants, frames.
_NOT_COLUMNS = [
    r"\bEXTRACT\s*\(\s*\w+(?=\s+FROM\b)",
    rf"\bAS\s+{S.IDENT}(?:\s*\([\d\s,]*\))?(?:\s+CHARACTER\s+SET\s+\w+|\s+(?:NOT\s+)?(?:CASESPECIFIC|CS)\b"
    r"|\s+(?:TO\s+\w+|WITH\s+TIME\s+ZONE|PRECISION|VARYING)\b|\s+FORMAT\b)*+",
    r"\bCHARACTER\s+SET\s+\w+",
    r"\bCURRENT_(?:DATE|TIME|TIMESTAMP|USER|ROLE)\b",
    r"\b(?:LEADING|TRAILING|BOTH)\b(?=[^,()]*\bFROM\b)",
    r"\bNULLS\s+(?:FIRST|LAST)\b",
    r"\bAT\s+(?:LOCAL\b|TIME\s+ZONE\b)",
    r"\b(?:ROWS|RANGE)\b(?=\s+(?:BETWEEN|UNBOUNDED|CURRENT|\d))",
    r"\b(?:UNBOUNDED|\d+)\s+(?:PRECEDING|FOLLOWING)\b",
    r"\bCURRENT\s+ROW\b",
]
_UNIT = "struct<clause:string,branch_no:int,cols:string,items:string>"
_CTX = "struct<rank:int,top_level:boolean,text:string,match:string,shown:string,shown_named:string>"


def _unit(clause: str | Column, branch_no: Column, cols: Column, items: Column) -> Column:
    clause = F.lit(clause) if isinstance(clause, str) else clause
    return F.struct(
        clause.alias("clause"),
        branch_no.cast("int").alias("branch_no"),
        cols.cast("string").alias("cols"),
        items.alias("items"),
    )


def _array(condition: Column, value: Column, element: str) -> Column:
    return F.when(condition, value).otherwise(F.array().cast(f"array<{element}>"))


def parse_statements(statements: DataFrame) -> DataFrame:
    """Add the arrays ``tables``, ``units``, ``contexts`` and ``inputs`` to the catalog.

    ``units`` are the comma lists that assign columns, ``contexts`` the clauses
    that read columns, ``inputs`` other texts that name columns. The arrays of a
    failed statement are empty.
    """
    kind, sql = F.col("kind"), F.col("sql")
    ok = F.col("parse_status") == "OK"
    cols, rest = insert_parts(sql)
    sources = statements.withColumn("kind", F.when(ok, kind).otherwise(FAILED)).select(
        "*",
        F.when(kind == "INSERT", cols).otherwise("").alias("insert_cols"),
        F.when(kind == "INSERT", rest)
        .when(kind.isin(_SELECT_KINDS), S.unwrap(F.col("body")))
        .when(ok, sql)
        .otherwise("")
        .alias("source"),
    ).withColumn(
        "source",
        F.when(kind.isin(_SELECT_KINDS + ["INSERT"]), S.without_wrappers(F.col("source"))).otherwise(
            F.col("source")
        ),
    )
    has_top = kind.isin(_SELECT_KINDS + ["INSERT"])
    bodies = sources.withColumn(
        "bodies",
        F.concat(
            F.array(F.when(has_top, S.from_first_select(F.col("source"))).otherwise("")),
            S.nested_selects(F.when(ok, F.concat("with_text", "source")).otherwise("")),
            F.when(ok, F.col("deep_selects")).otherwise(F.array().cast("array<string>")),
        ),
    )
    branches = bodies.withColumn(
        "branches",
        F.flatten(
            F.transform(
                "bodies",
                lambda body, i: F.transform(
                    S.union_branches(body),
                    lambda b, j: F.struct(i.alias("body_no"), j.alias("branch_no"), b.alias("text")),
                ),
            )
        ),
    ).drop("bodies")
    stop = S.CLAUSES
    parts = branches.withColumn(
        "parts",
        F.transform(
            "branches",
            lambda b: F.struct(
                b["body_no"].alias("body_no"),
                b["branch_no"].alias("branch_no"),
                S.select_list(b["text"]).alias("list"),
                S.from_clause(b["text"]).alias("from"),
                S.clause(b["text"], "WHERE", stop).alias("where"),
                S.clause(b["text"], r"GROUP\s+BY", stop).alias("group"),
                S.clause(b["text"], "HAVING", stop).alias("having"),
                S.clause(b["text"], "QUALIFY", stop).alias("qualify"),
                S.clause(b["text"], r"ORDER\s+BY", stop).alias("order"),
            ),
        ),
    ).drop("branches")

    is_merge, is_update = kind == "MERGE", kind == "UPDATE"
    writes = kind.isin("INSERT", "UPDATE", "MERGE", "DELETE")
    whens = parts.select(
        "*",
        _array(
            is_merge,
            F.filter(
                S.cut_all(
                    sql,
                    rf"{S.QUOTED}|{S.GROUP}|\b({S.MERGE_WHEN}\b{S.until(S.MERGE_WHEN)})",
                ),
                lambda w: w != "",
            ),
            "string",
        ).alias("whens"),
        F.when(is_merge, S.clause(sql, "ON", S.MERGE_WHEN)).otherwise("").alias("merge_on"),
        F.when(is_update, S.clause(sql, "SET", r"WHERE|FROM|ELSE\s+INSERT"))
        .otherwise("")
        .alias("set_items"),
        F.when(kind.isin("UPDATE", "DELETE"), S.clause(sql, "WHERE", r"ELSE\s+INSERT|SET"))
        .otherwise("")
        .alias("own_where"),
        F.when(is_update, S.clause(sql, "FROM", r"SET|WHERE")).otherwise("").alias("own_from"),
    )
    none = F.lit(None)
    ins_pattern = rf"\bINSERT\s*\(({S.INNER})\)\s*VALUES\s*\(({S.INNER})\)"
    merge_units = F.flatten(
        F.transform(
            "whens",
            lambda w, i: F.filter(
                F.array(
                    _unit(MERGE_SET, i, none, S.clause(w, "SET", "WHERE|DELETE")),
                    _unit(MERGE_INSERT, i, S.cut(w, ins_pattern, 1), S.cut(w, ins_pattern, 2)),
                ),
                lambda u: u["items"] != "",
            ),
        )
    )
    is_values = F.col("source").rlike(r"(?i)\AVALUES\b") & (kind == "INSERT")
    tuples = F.filter(
        S.cut_all(F.col("source"), rf"{S.QUOTED}|\(({S.INNER})\)"), lambda t: t != ""
    )
    value_units = F.transform(tuples, lambda t, i: _unit(VALUES, i, F.col("insert_cols"), t))
    positional = (kind == "INSERT") & (F.col("insert_cols") != "")
    select_units = F.transform(
        "parts",
        lambda p: _unit(
            F.when(positional & (p["body_no"] == 0), INSERT_SELECT).otherwise(SELECT),
            p["branch_no"],
            F.when(positional & (p["body_no"] == 0), F.col("insert_cols")),
            p["list"],
        ),
    )
    units = F.concat(
        _array(
            F.col("set_items") != "",
            F.array(_unit(SET, F.lit(0), none, F.col("set_items"))),
            _UNIT,
        ),
        _array(is_merge, merge_units, _UNIT),
        _array(is_values, value_units, _UNIT),
        select_units,
    )

    top_branches = F.size(F.filter("parts", lambda p: p["body_no"] == 0))

    def tidied(texts: Column) -> Column:
        # Steps of their own: a lambda computes its argument once.
        return F.transform(F.transform(texts, S.unfold), N.collapse_spaces)

    def context(rank: int, tidy: Column, top: Column, word: str = "") -> Column:
        shown = {2: K.READ_JOIN, 3: K.READ_WHERE}.get(rank)
        fixed = {4: K.READ_GROUP_BY, 5: K.READ_ORDER_BY}.get(rank)
        return F.struct(
            F.lit(rank).alias("rank"),
            top.alias("top_level"),
            tidy.alias("text"),
            F.concat(F.lit(word), tidy).alias("match"),
            (F.lit(fixed) if fixed else F.concat(F.lit(shown + word), tidy)).alias("shown"),
            (F.lit(fixed) if fixed else F.concat(F.lit(shown), tidy)).alias("shown_named"),
        )

    top = kind.isin(_SELECT_KINDS)

    def per_branch(field: str, rank: int, word: str, single: bool) -> Column:
        with_text = F.filter("parts", lambda p: p[field] != "")
        numbers = F.transform(with_text, lambda p: p["body_no"])
        return F.zip_with(
            tidied(F.transform(with_text, lambda p: p[field])),
            numbers,
            lambda text, body_no: context(
                rank,
                text,
                top & (body_no == 0) & ((top_branches == 1) if single else F.lit(True)),
                word,
            ),
        )

    joins = F.flatten(F.transform("parts", lambda p: S.join_conditions(p["from"])))
    own_joins = S.join_conditions(F.col("own_from"))
    contexts = F.concat(
        F.transform(tidied(F.concat(joins, own_joins)), lambda c: context(2, c, F.lit(True))),
        _array(
            F.col("own_where") != "",
            F.transform(
                tidied(F.array("own_where")), lambda c: context(3, c, F.lit(True), "WHERE ")
            ),
            _CTX,
        ),
        per_branch("where", 3, "WHERE ", True),
        per_branch("group", 4, "GROUP BY ", True),
        per_branch("order", 5, "ORDER BY ", False),
    )
    inputs = F.concat(
        F.array("merge_on"),
        F.transform("parts", lambda p: p["having"]),
        F.transform("parts", lambda p: p["qualify"]),
        F.transform(
            F.filter("units", lambda u: u["clause"].isin(SET, MERGE_SET, MERGE_INSERT, VALUES)),
            lambda u: u["items"],
        ),
    )
    # UPDATE names further tables in a FROM of its own, before or behind SET.
    heads = _array(writes, S.head_tables(sql), "struct<name:string,alias:string>")
    tables = F.concat(
        heads,
        F.array_except(S.from_tables(F.col("own_from")), heads),
        F.flatten(F.transform("parts", lambda p: S.from_tables(p["from"]))),
    )
    inputs = F.transform(inputs, S.unfold)
    return computed_once(
        whens.withColumn("units", units)
        .withColumn("tables", tables)
        .withColumn("contexts", contexts)
        .withColumn("inputs", inputs)
        .select(*statements.drop("body", "sql", "with_text", "deep_selects").columns, "tables", "units", "contexts", "inputs")
    )


def statement_tables(parsed: DataFrame) -> DataFrame:
    """One row per table reference: position, bare name, alias."""
    return parsed.select(
        "query_id", "parent", "stmt_no", F.posexplode("tables").alias("ref_no", "t")
    ).select("query_id", "parent", "stmt_no", "ref_no", "t.name", "t.alias")


def assignments(parsed: DataFrame) -> DataFrame:
    """One row per list item: which expression goes to which column.

    ``target_col`` is empty for a select item without a name; such items still
    count as reads. Positional items take the name from the column list.
    """
    units = parsed.select(
        "query_id",
        "parent",
        "stmt_no",
        "kind",
        "target_table",
        "tables",
        F.posexplode("units").alias("unit_no", "u"),
    ).select(
        "*",
        F.col("u.clause").alias("clause"),
        F.col("u.branch_no").alias("branch_no"),
        S.split_top(F.coalesce("u.cols", F.lit(""))).alias("cols"),
        S.split_top(F.col("u.items")).alias("items"),
    )
    items = units.select(
        "query_id",
        "parent",
        "stmt_no",
        "kind",
        "target_table",
        "tables",
        "clause",
        "unit_no",
        "branch_no",
        "cols",
        F.posexplode_outer("items").alias("ord", "item"),
    )
    item, clause = F.col("item"), F.col("clause")
    is_set = clause.isin(SET, MERGE_SET)
    is_select = clause.isin(SELECT, INSERT_SELECT)
    items = S.with_alias_parts(items, is_select)
    lhs, rhs = S.split_assignment(item)
    select_expr, select_name, aliased = map(F.col, ("select_expr", "select_name", "has_alias"))
    listed = F.exists("cols", lambda c: N.last_part(c) == select_name)
    raw = items.select(
        "*",
        ((clause == INSERT_SELECT) & aliased & ~listed).alias("second"),
        F.when(is_set, rhs).when(is_select, select_expr).otherwise(item).alias("raw_expr"),
        F.when(is_set, N.last_part(lhs))
        .when(clause == SELECT, select_name)
        .otherwise(N.last_part(F.get("cols", F.col("ord"))))
        .alias("target_col"),
        (is_select & aliased).alias("aliased"),
        F.when(is_select & aliased, select_name).otherwise("").alias("alias_name"),
    )
    plain = raw.withColumns(
        {"raw_expr": S.unfold(F.col("raw_expr")), "item": S.unfold(F.col("item"))}
    )
    tidy = plain.select("*", N.collapse_spaces(F.col("raw_expr")).alias("expr"))
    result = tidy.select(
        "query_id",
        "parent",
        "stmt_no",
        "kind",
        "target_table",
        "tables",
        "clause",
        "unit_no",
        "branch_no",
        "ord",
        F.coalesce("target_col", F.lit("")).alias("target_col"),
        "expr",
        "aliased",
        "alias_name",
        N.collapse_spaces(item).alias("item"),
        "second",
    )
    facts = computed_once(result).where("expr <> ''")
    expr = F.col("expr")
    return facts.select(
        "*",
        N.is_literal(expr).alias("is_literal"),
        N.is_literal_wide(expr).alias("is_literal_wide"),
        N.dotted_tail(expr).alias("tail"),
        N.qualified_refs(expr).alias("refs"),
        N.words(expr).alias("words"),
    )


def with_alias_targets(assigned: DataFrame) -> DataFrame:
    """Assignments and, marked ``extra``, those to an alias that the column list of its
    INSERT does not name."""
    both = F.array(F.lit(False), F.lit(True))
    rows = assigned.withColumn(
        "extra", F.explode(F.when(F.col("second"), both).otherwise(F.array(F.lit(False))))
    )
    return rows.withColumns(
        {
            "target_col": F.when(F.col("extra"), F.col("alias_name")).otherwise(F.col("target_col")),
            "clause": F.when(F.col("extra"), SELECT).otherwise(F.col("clause")),
        }
    )


def select_items(assigned: DataFrame) -> DataFrame:
    kept = ~F.col("extra") if "extra" in assigned.columns else F.lit(True)
    return assigned.where(F.col("clause").isin(SELECT, INSERT_SELECT) & kept)


def read_contexts(parsed: DataFrame, assigned: DataFrame) -> DataFrame:
    """Every place a statement reads columns: select items, ON, WHERE, GROUP BY, ORDER BY.

    ``shown``/``shown_named`` are the texts of the two rule sets, ``match`` is
    what a column name is looked for in.
    """
    projections = select_items(assigned).select(
        "query_id",
        "parent",
        "stmt_no",
        F.lit(1).alias("rank"),
        F.struct("unit_no", "ord").alias("pos"),
        F.lit(True).alias("top_level"),
        F.col("item").alias("match"),
        F.concat(F.lit(K.READ_PROJECTION), F.col("item")).alias("shown"),
        F.when(
            F.col("aliased"),
            F.concat(
                F.lit(K.READ_NAMED_PROJECTION),
                F.col("alias_name"),
                F.lit("): "),
                F.col("expr"),
            ),
        )
        .otherwise(F.concat(F.lit(K.READ_PROJECTION), F.col("item")))
        .alias("shown_named"),
        "expr",
    )
    clauses = parsed.select(
        "query_id", "parent", "stmt_no", F.posexplode("contexts").alias("pos", "c")
    ).select(
        "query_id",
        "parent",
        "stmt_no",
        "c.rank",
        F.struct(F.col("pos").alias("unit_no"), F.lit(0).alias("ord")).alias("pos"),
        "c.top_level",
        "c.match",
        "c.shown",
        "c.shown_named",
        F.col("c.text").alias("expr"),
    )
    return projections.unionByName(clauses)


def column_tokens(text: Column) -> Column:
    """Names used as columns: last part of dotted names, no functions, strings or aliases."""
    pattern = (
        rf"{_LITERAL}|{S.QUOTED}|(?i:{'|'.join(_NOT_COLUMNS)})"
        rf"|(?:\b\w+\s*\.\s*)*+\b([A-Za-z_]\w*+)(?!\s*[(.])"
    )
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.upper)
    return F.array_except(found, F.array(*map(F.lit, ["", *_EXPRESSION_WORDS])))


def column_reads(parsed: DataFrame, assigned: DataFrame) -> DataFrame:
    """``(parent, column, place)`` for every column named in a read place.

    Places no special text covers (rank 6) read ``Read as input column``.
    """
    named = read_contexts(parsed, assigned).select(
        "query_id",
        "parent",
        "stmt_no",
        "rank",
        "pos",
        F.col("shown_named").alias("shown"),
        F.explode_outer(column_tokens(F.col("expr"))).alias("column_name"),
    )
    inputs = parsed.select(
        "query_id", "parent", "stmt_no", F.posexplode("inputs").alias("pos", "text")
    ).select(
        "query_id",
        "parent",
        "stmt_no",
        F.lit(6).alias("rank"),
        F.struct(F.col("pos").alias("unit_no"), F.lit(0).alias("ord")).alias("pos"),
        F.lit(K.READ_INPUT).alias("shown"),
        F.explode_outer(column_tokens(F.col("text"))).alias("column_name"),
    )
    return named.unionByName(inputs).where("column_name IS NOT NULL")


def wildcards(parsed: DataFrame, assigned: DataFrame) -> DataFrame:
    """Description of the first ``*`` item, or of a DELETE, per statement."""
    stars = (
        select_items(assigned)
        .where(F.col("item").rlike(r"\A(?:[\w$#@\"{}.]+\.)?\*\z"))
        .groupBy("query_id", "parent", "stmt_no", "target_table")
        .agg(F.min_by("item", F.struct("unit_no", "ord")).alias("item"))
    )
    table = F.regexp_extract("item", r"([^.\"]+)\"?\.\*\z", 1)
    described = stars.select(
        "query_id",
        "parent",
        "stmt_no",
        "target_table",
        F.lit(0).alias("prio"),
        F.when(F.col("item") == "*", K.WILDCARD_ALL)
        .otherwise(
            F.concat(
                F.lit("Wildcard SELECT "), table, F.lit(".* — all columns from "), table
            )
        )
        .alias("description"),
    )
    deletes = parsed.where(F.col("kind") == "DELETE").select(
        "query_id",
        "parent",
        "stmt_no",
        "target_table",
        F.lit(1).alias("prio"),
        F.lit(K.WILDCARD_DELETE).alias("description"),
    )
    return described.unionByName(deletes)
