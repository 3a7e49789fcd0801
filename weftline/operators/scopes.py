"""Scopes of statements: common table expressions, derived tables and nested SELECTs.

A scope is the text of one query inside a statement. :func:`scopes` cuts them out level by
level; :func:`scope_sources` follows the names that a scope reads, through the scopes that they
stand for, to stored tables. Both grow by joins and narrow steps alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import shape as S
from .spread import computed_once, materialize
from .statements import insert_parts

STATEMENT, CTE, NAMED, NESTED = "statement", "cte", "named", "nested"
_SCOPE = ["query_id", "scope", "outer", "kind", "name", "columns", "body"]
# A parenthesised query with the name before it (CTE) or behind it (derived table).
_BEFORE = rf"(?:(?<![\w$#@.\"])({S.IDENT})\s*(?:\(({S.INNER})\)\s*)?\bAS\s*)?"
_RECURSIVE = r"(?i)\A\s*WITH\s+RECURSIVE\b"
_INSIDE = rf"\((?=\s*(?:\(\s*)*(?:{S.SELECT}|WITH)\b)({S.INNER})\)"


def _child_scopes(body: Column) -> Column:
    """Queries right inside a query's text, in text order, at any depth of other parentheses."""
    pattern = rf"{_BEFORE}{_INSIDE}{S.QUERY_ALIAS}|{S.QUOTED}"
    before, columns, inner, behind = (S.cut_all(body, pattern, k) for k in (1, 2, 3, 4))
    found = F.transform(
        F.arrays_zip(
            before.alias("before"), columns.alias("columns"), inner.alias("inner"), behind.alias("behind")
        ),
        lambda x: F.struct(
            F.when(x["before"] != "", CTE).when(x["behind"] != "", NAMED).otherwise(NESTED).alias("kind"),
            F.upper(
                F.replace(
                    F.when(x["before"] != "", x["before"]).otherwise(x["behind"]), F.lit('"'), F.lit("")
                )
            ).alias("name"),
            x["columns"].alias("columns"),
            S.unwrap(N.strip(x["inner"])).alias("body"),
        ),
    )
    return F.filter(found, lambda x: x["body"] != "")


def scopes(catalog: DataFrame, work_dir: str | None = None) -> DataFrame:
    """One row per scope of the parsed statements: ``query_id, scope, outer, kind, name,
    columns, body``.

    ``scope`` is the place in the tree (``0``, ``0.2``, …) and ``outer`` that of the scope
    around it (null for the statement). ``columns`` is the column list behind a CTE's name.
    Each level of nesting is one narrow step; statements nested deeper than the patterns give
    the queries below that as scopes of the statement.
    """
    kind, sql = F.col("kind"), F.col("sql")
    _, rest = insert_parts(sql)
    text = F.when(kind == "INSERT", rest).when(kind.isin("CTAS", "VIEW"), F.col("body")).otherwise(sql)
    roots = catalog.where("parse_status = 'OK'").select(
        "query_id",
        F.lit("0").alias("scope"),
        F.lit(None).cast("string").alias("outer"),
        F.lit(STATEMENT).alias("kind"),
        F.lit("").alias("name"),
        F.lit("").alias("columns"),
        F.concat("with_text", text).alias("body"),
        F.transform(
            "deep_selects",
            lambda b: F.struct(
                F.lit(NESTED).alias("kind"), F.lit("").alias("name"), F.lit("").alias("columns"), b.alias("body")
            ),
        ).alias("more"),
    )
    level = materialize(computed_once(roots), "scopes", work_dir)
    found = level.select(*_SCOPE)
    inside = F.concat(_child_scopes(F.col("body")), "more")
    while True:
        below = level.select(
            "query_id", F.col("scope").alias("outer"), F.posexplode_outer(inside).alias("at", "s")
        ).where("s IS NOT NULL")
        below = below.select(
            "query_id",
            F.concat("outer", F.lit("."), F.col("at").cast("string")).alias("scope"),
            "outer",
            "s.kind",
            "s.name",
            "s.columns",
            "s.body",
        )
        below = materialize(below, "scopes", work_dir)
        if not below.head(1):
            return found
        found = found.unionByName(below)
        level, inside = below, _child_scopes(F.col("body"))


def scope_reads(found: DataFrame) -> DataFrame:
    """``(query_id, scope, name)``: tables and common table expressions that a scope's own
    FROM, USING or UPDATE … FROM names."""
    body = F.col("body")
    branches = S.union_branches(S.without_wrappers(S.from_first_select(body)))
    selected = F.flatten(F.transform(branches, lambda b: S.from_tables(S.from_clause(b))))
    verbs = "INSERT|INS|UPDATE|UPD|MERGE|DELETE|DEL"
    write = S.cut(body, rf"\A{S.until(verbs)}(\b(?:{verbs})\b.*)\z")
    own = S.from_tables(S.clause(write, "FROM", "SET|WHERE"))
    using = S.from_tables(S.clause(write, "USING", "ON"))
    is_write = write.rlike(r"(?i)\A(?:UPD|MERGE)")
    tables = F.concat(selected, F.when(is_write, F.concat(own, using)).otherwise(F.slice(own, 1, 0)))
    names = F.array_distinct(F.transform(tables, lambda t: t["name"]))
    reads = found.select("query_id", "scope", F.explode_outer(names).alias("name"))
    return reads.where("name IS NOT NULL")


def _steps(
    found: DataFrame, reads: DataFrame, work_dir: str | None
) -> tuple[DataFrame, DataFrame]:
    """Reads that end at a table, and those that lead to another scope."""
    ctes = found.where(F.col("kind") == CTE).select(
        "query_id", "name", F.col("scope").alias("to"), F.col("outer").alias("home")
    )
    homes = found.select(
        "query_id", F.col("scope").alias("home"), F.col("body").rlike(_RECURSIVE).alias("recursive")
    )
    ctes = ctes.join(homes, ["query_id", "home"])
    met = reads.join(ctes, ["query_id", "name"])
    # A name is known in the scope that defines it and in all scopes inside; the nearest counts.
    known = (F.col("scope") == F.col("home")) | F.col("scope").startswith(F.concat("home", F.lit(".")))
    itself = (F.col("scope") == F.col("to")) | F.col("scope").startswith(F.concat("to", F.lit(".")))
    nearest = F.max_by(F.struct("to", itself.alias("itself")), F.struct(F.length("home"), "to"))
    met = met.where(known & (~itself | F.col("recursive")))
    resolved = met.groupBy("query_id", "scope", "name").agg(nearest.alias("n"))
    resolved = materialize(resolved, "scope-names", work_dir)
    tables = reads.join(resolved, ["query_id", "scope", "name"], "left_anti")
    # A recursive expression reads itself, which adds no table; else its own name is a table's.
    onward = resolved.where("NOT n.itself").select("query_id", "scope", "n.to")
    inside = found.where(F.col("kind").isin(NAMED, NESTED)).select(
        "query_id", F.col("outer").alias("scope"), F.col("scope").alias("to")
    )
    return tables.withColumnRenamed("name", "table"), onward.union(inside)


def scope_sources(found: DataFrame, work_dir: str | None = None) -> DataFrame:
    """``(query_id, scope, kind, name, table)``: stored tables that a scope reads by itself or
    through other scopes.

    A fixed point: each pass carries the tables found last one scope further, until no pass
    finds a new one. Passes are as many as names that stand for names, not as rows.
    """
    found = materialize(found, "scopes", work_dir)
    # Three joins read these; cutting them out of the texts is the costly part.
    reads = materialize(scope_reads(found), "scope-reads", work_dir)
    tables, onward = _steps(found, reads, work_dir)
    onward = materialize(onward.distinct(), "scope-steps", work_dir)
    key = ["query_id", "scope", "table"]
    fresh = materialize(tables.select(*key).distinct(), "scope-tables", work_dir)
    known = fresh
    while True:
        carried = fresh.withColumnRenamed("scope", "to").join(onward, ["query_id", "to"])
        fresh = carried.select(*key).distinct().join(known, key, "left_anti")
        fresh = materialize(fresh, "scope-tables", work_dir)
        if not fresh.head(1):
            break
        known = known.union(fresh)
    return found.select("query_id", "scope", "kind", "name").join(known, ["query_id", "scope"])
