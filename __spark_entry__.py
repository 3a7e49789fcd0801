
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
import workload  # noqa: E402
from weftline.constants import FACT_COLUMNS  # noqa: E402
from weftline.functions import names as N  # noqa: E402
from weftline.functions import shape as S  # noqa: E402
from weftline.operators import candidates as C  # noqa: E402
from weftline.operators import edges as E  # noqa: E402
from weftline.operators import scopes as SC  # noqa: E402
from weftline.operators import shapes as SH  # noqa: E402
from weftline.operators import statements as ST  # noqa: E402
from weftline.operators.spread import spread_work  # noqa: E402
from weftline.plans import lineage as L  # noqa: E402
from weftline.plans import publish as P  # noqa: E402
from weftline.plans import reports as R  # noqa: E402
from weftline.sources.files import read_edges  # noqa: E402

try:
    import weftline.llm.queries as corpus  # noqa: E402
except ImportError:
    corpus = None
try:
    import corpus_pipeline  # noqa: E402
except ImportError:
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return workload.edges(spark, sf)


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return workload.sql_files(spark, sf)


def _catalog(spark: SparkSession, sf: str, profile: str = "rows") -> DataFrame:
    return ST.statement_catalog(spread_work(_files(spark, sf), "parent"), profile)


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return SH.parse_statements(_catalog(spark, sf))


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return SH.assignments(_parsed(spark, sf))


def _lineage(spark: SparkSession, sf: str, profile: str = "rows") -> L.Lineage:
    return L.extract_lineage(_edges(spark, sf), _files(spark, sf), profile)


def _fact(profile: str) -> Query:
    return lambda spark, sf: _lineage(spark, sf, profile).fact.select(*FACT_COLUMNS)


def _candidates(profile: str) -> Query:
    return lambda spark, sf: L.candidates(_edges(spark, sf), _files(spark, sf), profile)


def _gate(profile: str, *gates: str) -> Query:
    """Outcome of the edges that take one of the gates."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        job = L.prepare(_edges(spark, sf), _files(spark, sf), profile, gates)
        return L.resolve(job).select("row_id", "transformation_logic", "query_uuid")

    return run


def _assign(test: Callable[[], Column]) -> Query:
    return lambda spark, sf: (
        _assigned(spark, sf)
        .where(test())
        .select("query_id", "clause", "unit_no", "branch_no", "ord", "target_col", "expr")
    )


def edges_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return E.normalize_edges(E.sanitize_edges(_edges(spark, sf)), "rows").select(
        "row_id", "src_name", "tgt_name", "src_col", "tgt_col", "src_tbl", "tgt_tbl", "is_static"
    )


def name_bare_table(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    forms = ["$DWDB.TGT_", "${DWDB}.Tgt_", 'DB."tgt_', "db.schema.TGT_", "  tgt_", "TGT_"]
    ref = F.lit(forms[5])
    for i in range(5):
        ref = F.when(key % 6 == i, forms[i]).otherwise(ref)
    end = F.when(key % 6 == 2, '"').when(key % 6 == 4, "  ").otherwise("")
    ref = F.concat(ref, size, end)
    other = F.when(key % 6 == 5, "").otherwise(F.concat(F.lit("tgt_"), size))
    return workload.table(spark, sf, "part").select(
        key.alias("k"),
        N.bare_table(ref).alias("bare"),
        N.bare_table_ident(ref).alias("bare_ident"),
        N.tables_match(ref, other).alias("same_table"),
    )


def literal_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select(
        "query_id", "unit_no", "ord", "expr", "is_literal", "is_literal_wide"
    )


def passthrough_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Both pass-through tests, without and with the alias of the edge's source table."""
    key = F.col("row_id")
    edges = _edges(spark, sf).select(
        "row_id",
        "parent",
        F.concat(F.lit("SRC_"), (key % 4).cast("string")).alias("src_tbl"),
        F.element_at(F.array(*map(F.lit, ["XA", "XB", "XC"])), (key % 3 + 1).cast("int")).alias(
            "src_col"
        ),
    )
    joined = edges.join(_assigned(spark, sf), "parent")
    src, alias = F.col("src_col"), C.source_alias(F.col("tables"), F.col("src_tbl"))
    known = F.when(alias == "", F.lit("?")).otherwise(alias)
    return joined.select(
        "row_id",
        "query_id",
        "unit_no",
        "ord",
        N.is_passthrough_ident(F.col("expr"), src, F.lit("")).alias("direct"),
        N.is_passthrough(F.col("expr"), src, known).alias("direct_aliased"),
    )


def clean_logic(spark: SparkSession, sf: str) -> DataFrame:
    expr, target = F.col("expr"), F.lit("t.OUT_COL")
    messy = F.concat(
        F.lit("(  "), expr, F.lit(" ,\n"), expr, F.lit("\t)  As  \"out_col\"")
    )
    return _assigned(spark, sf).select(
        "query_id",
        "unit_no",
        "ord",
        N.clean_logic(messy, target).alias("cleaned"),
        N.clean_logic(F.concat(expr, F.lit("  AS other")), target).alias("other_alias"),
    )


def qualified_refs(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select(
        "query_id", "unit_no", "ord", F.inline(N.qualified_refs(F.col("expr")))
    )


def comment_strip(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select(
        "parent",
        ST.strip_comments(F.col("sql_text"), "rows").alias("block_first"),
        ST.strip_comments(F.col("sql_text"), "concat").alias("line_first"),
    )


def statement_split(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select(
        "parent", F.posexplode(ST.split_statements(F.col("sql_text"))).alias("stmt_no", "stmt")
    )


def shell_var_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _catalog(spark, sf).select(
        "query_id", F.posexplode(ST.shell_variables(F.col("sql_query"))).alias("pos", "token")
    )


def statement_kind(spark: SparkSession, sf: str) -> DataFrame:
    sql = F.col("sql_query")
    return _catalog(spark, sf).select(
        "query_id", ST.statement_kind(sql).alias("kind"), ST.is_pure_ddl(sql).alias("pure_ddl")
    )


def ctas_body(spark: SparkSession, sf: str) -> DataFrame:
    creates = _catalog(spark, sf).where("kind IN ('CTAS', 'VIEW') AND parse_status = 'OK'")
    sql = F.col("sql_query")
    return creates.select(
        "query_id",
        ST.select_body(sql).alias("body"),
        ST.strip_create_prefix(sql).alias("stripped"),
    )


def statement_tables(spark: SparkSession, sf: str) -> DataFrame:
    return SH.statement_tables(_parsed(spark, sf)).select("query_id", "ref_no", "name", "alias")


def other_table_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Names and aliases of the tables that are not the statement's source table."""
    key = F.col("k")
    sources = workload.statements(spark, sf).select(
        F.concat(F.lit("jobs/f"), F.col("file_no").cast("string"), F.lit(".sql")).alias("parent"),
        "stmt_no",
        F.concat(F.lit("SRC_"), (key % 4).cast("string")).alias("source"),
    )
    joined = _parsed(spark, sf).join(sources, ["parent", "stmt_no"])
    names = C.other_names(F.col("tables"), F.col("source"))
    reads_source = F.exists("tables", lambda t: t["name"] == F.col("source"))
    return joined.where(reads_source).select("query_id", F.explode(names).alias("other_alias"))


def failed_statement(spark: SparkSession, sf: str) -> DataFrame:
    info = ST.file_info(_catalog(spark, sf))
    return info.select("parent", "failed_id").where("failed_id IS NOT NULL")


def split_top(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(
        "p_name", F.lit(", f("), "p_type", F.lit(", ("), "p_brand", F.lit(", 'a,b(')), x")
    )
    return workload.table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), F.posexplode(S.split_top(text)).alias("pos", "item")
    )


def read_contexts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parsed(spark, sf)
    reads = SH.read_contexts(parsed, SH.assignments(parsed)).where("rank <= 2 OR top_level")
    return reads.select("query_id", "rank", "match", "shown")


def column_reads(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parsed(spark, sf)
    reads = SH.column_reads(parsed, SH.assignments(parsed))
    return reads.select("query_id", "rank", "column_name", "shown").distinct()


def wildcard_contexts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parsed(spark, sf)
    return SH.wildcards(parsed, SH.assignments(parsed)).select("query_id", "description")


def best_tier(spark: SparkSession, sf: str) -> DataFrame:
    best = L.best_candidates(_edges(spark, sf), _files(spark, sf), "rows")
    return best.select("row_id", "query_id", "logic", "score")


def _wide(profile: str) -> Query:
    """Outcomes of the statements that the usual templates lack."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        edges, files = workload.wide_edges(spark, sf), workload.wide_files(spark, sf)
        fact = L.extract_lineage(edges, files, profile).fact
        return fact.select("row_id", "transformation_logic")

    return run


def scope_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Stored tables that each statement and each of its named scopes reads."""
    catalog = ST.statement_catalog(spread_work(workload.scope_files(spark, sf), "parent"))
    found = SC.scope_sources(SC.scopes(catalog))
    parents = catalog.select("query_id", "parent")
    return (
        found.where("kind <> 'nested'")
        .join(parents, "query_id")
        .select(F.col("parent").cast("bigint").alias("k"), "kind", "name", F.col("table").alias("base_table"))
    )


def extract_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes of all edges of CSV files that hold broken records."""
    edges = read_edges(spark, workload.broken_edges(spark, sf))
    return L.extract_lineage(edges, _files(spark, sf)).fact.select(*FACT_COLUMNS)


def _published(profile: str, part: str) -> Query:
    """One of the outputs as published, read back after a second run that finds it complete."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        edges, files = _edges(spark, sf), _files(spark, sf)
        folder = workload.new_folder(spark, "published")
        P.publish_lineage(edges, files, folder, profile)
        paths = P.publish_lineage(edges, files, folder, profile)
        return spark.read.parquet(getattr(paths, part))

    return run


def row_class(spark: SparkSession, sf: str) -> DataFrame:
    return R.class_counts(_lineage(spark, sf).fact)


def dim_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the catalog put together have one row per statement again."""
    dims = [ST.dim_rows(_catalog(spark, sf, p), p) for p in ("rows", "concat")]
    return ST.dedup_dim(dims[0].unionByName(dims[1])).select("query_uuid", "file_path")


def fact_dim_join(spark: SparkSession, sf: str) -> DataFrame:
    result = _lineage(spark, sf)
    return (
        result.fact.join(result.dim, "query_uuid")
        .groupBy("parse_status", "parse_error")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the fact table over the smallest data."""
    return queries()["fact_rows"](spark, "/root/testdata/sf0.001")


def _corpus_queries() -> dict[str, Query]:
    found = dict(corpus.QUERIES) if corpus else {}
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def queries() -> dict[str, Query]:
    return {
        "edges_normalized": edges_normalized,
        "edges_dedup": lambda s, d: E.dedup_edges(E.sanitize_edges(_edges(s, d))),
        "name_bare_table": name_bare_table,
        "literal_flags": literal_flags,
        "passthrough_flags": passthrough_flags,
        "clean_logic": clean_logic,
        "qualified_refs": qualified_refs,
        "comment_strip": comment_strip,
        "statement_split": statement_split,
        "shell_var_tokens": shell_var_tokens,
        "statement_kind": statement_kind,
        "ctas_body": ctas_body,
        "statement_target": lambda s, d: _catalog(s, d).select("query_id", "target_table"),
        "statement_catalog": lambda s, d: _catalog(s, d).select(
            "query_id", "parent", "stmt_no", "sql_query", "parse_status", "parse_error"
        ),
        "statement_tables": statement_tables,
        "other_table_aliases": other_table_aliases,
        "default_statement": lambda s, d: ST.file_info(_catalog(s, d)).select(
            "parent", "default_id"
        ),
        "failed_statement": failed_statement,
        "missing_files": lambda s, d: ST.missing_files(_edges(s, d), _files(s, d)),
        "missing_file_count": lambda s, d: R.missing_file_report(_edges(s, d), _files(s, d))[0],
        "split_top": split_top,
        "assign_insert_select": _assign(
            lambda: F.col("clause") == SH.INSERT_SELECT
        ),
        "assign_values": _assign(lambda: F.col("clause") == SH.VALUES),
        "assign_update": _assign(lambda: F.col("clause") == SH.SET),
        "assign_merge": _assign(lambda: F.col("clause").isin(SH.MERGE_SET, SH.MERGE_INSERT)),
        "assign_select": _assign(lambda: F.col("clause") == SH.SELECT),
        "assign_union": lambda s, d: (
            _assign(lambda: F.col("clause") == SH.INSERT_SELECT)(s, d).join(
                _assigned(s, d).where("branch_no = 1").select("query_id").distinct(),
                "query_id",
                "left_semi",
            )
        ),
        "static_values": _gate("rows", "static"),
        "read_contexts": read_contexts,
        "column_reads": column_reads,
        "wildcard_contexts": wildcard_contexts,
        "candidates_scored_a": _candidates("concat"),
        "candidates_scored_b": _candidates("rows"),
        "candidates_alias_checked": _candidates("patched"),
        "best_tier": best_tier,
        "fact_rows": _fact("rows"),
        "fact_concat": _fact("concat"),
        "fact_patched": _fact("patched"),
        "wide_rows": _wide("rows"),
        "wide_concat": _wide("concat"),
        "extract_errors": extract_errors,
        "scope_sources": scope_sources,
        "null_gate": _gate("rows", "null"),
        "wildcard_gate": _gate("concat", "wildcard"),
        "read_gate": _gate("concat", "read"),
        "missing_gate": _gate("rows", "missing_both", "missing_source", "missing_target"),
        "summary_metrics": lambda s, d: _lineage(s, d, "concat").summary,
        "logic_counts": lambda s, d: _lineage(s, d).summary,
        "published_fact": _published("rows", "fact"),
        "published_summary": _published("concat", "summary"),
        "row_class": row_class,
        "parse_status_counts": lambda s, d: R.parse_status_counts(
            L.statement_dim(_edges(s, d), _files(s, d))
        ),
        "dim_rows": lambda s, d: L.statement_dim(_edges(s, d), _files(s, d)),
        "dim_dedup": dim_dedup,
        "edges_per_file": lambda s, d: R.edges_per_file(_edges(s, d)),
        "fact_dim_join": fact_dim_join,
        "warnings": lambda s, d: _lineage(s, d).warnings,
        **_corpus_queries(),
    }


def oracle_sql() -> dict[str, str]:
    found = dict(oracles.ORACLES) | (corpus.SQL if corpus else {})
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
