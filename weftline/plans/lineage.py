"""The whole job: edges and SQL files in, fact, dimension, summary and warnings out."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import DIM_COLUMNS, EDGE_COLUMNS, FACT_COLUMNS, Profile, get_profile
from ..functions import names as N
from ..operators import candidates as C
from ..operators import edges as E
from ..operators import shapes as SH
from ..operators import statements as ST
from ..operators.spread import computed_once, materialize, release, spread_work
from . import reports as R


class Lineage(NamedTuple):
    """``shared`` are the results that several outputs read; :meth:`release` gives up those
    that are persisted and not written to a work folder."""

    fact: DataFrame
    dim: DataFrame
    summary: DataFrame
    warnings: DataFrame
    shared: tuple[DataFrame, ...] = ()
    profile: str | Profile = "rows"

    def release(self) -> None:
        release(*self.shared)


class Corpus(NamedTuple):
    """Statement relations of the files some edge names, computed once."""

    parsed: DataFrame
    assigned: DataFrame


class Job(NamedTuple):
    """Prepared edges, their distinct cases and the statements they ask about."""

    edges: DataFrame
    cases: DataFrame
    corpus: Corpus
    profile: Profile
    work_dir: str | None


def clean_edges(edges: DataFrame, profile: Profile) -> DataFrame:
    """``rows`` works on sanitized values, ``concat`` on the values as given."""
    return E.sanitize_edges(edges) if profile.multi_row else edges


def prepare_edges(edges: DataFrame, profile: Profile) -> DataFrame:
    """Edges in normal form with gate and case; ``rows`` also drops repeated edges."""
    raw = clean_edges(edges, profile)
    if profile.multi_row:
        raw = E.dedup_edges(raw)
    gated = computed_once(E.with_gate(E.normalize_edges(raw, profile), profile))
    if not profile.multi_row:  # these rules skip such rows, with a warning
        gated = gated.where("gate <> 'row_error'")
    kept = ["row_id", *EDGE_COLUMNS, "parent_given", "case_id"]
    return E.with_case(gated, profile).select(
        *kept, *[c for c in E.CASE_COLUMNS if c not in EDGE_COLUMNS]
    )


def prepare(
    edges: DataFrame,
    sql_files: DataFrame,
    profile: str | Profile,
    gates: Sequence[str] = (),
    work_dir: str | None = None,
) -> Job:
    """Read the edges once, then only the files that they name; all else derives from these.

    ``gates`` restricts the job to the edges that take one of them.
    """
    profile = get_profile(profile)
    prepared = prepare_edges(E.with_file_key(edges), profile)
    if gates:
        prepared = prepared.where(F.col("gate").isin(list(gates)))
    prepared = materialize(prepared, "edges", work_dir)
    asked = materialize(E.cases(prepared), "cases", work_dir)
    parents = materialize(asked.select("parent").distinct(), "parents", work_dir)
    # The list of files is small beside their texts: unnamed files go before any shuffle.
    named = spread_work(sql_files.join(parents, "parent", "left_semi"), "parent")
    catalog = ST.statement_catalog(named, profile)
    parsed = materialize(SH.parse_statements(catalog), "statements", work_dir)
    assigned = materialize(
        SH.with_alias_targets(SH.assignments(parsed)), "assignments", work_dir
    )
    return Job(prepared, asked, Corpus(parsed, assigned), profile, work_dir)


def _mentions(job: Job) -> DataFrame:
    """Hits of the source names that some case looks for in texts."""
    look = F.col("gate").isin("normal", "static", "read") & (F.col("src_col") != "")
    kind = F.when(F.col("gate") == "read", C.CONTEXT).otherwise(C.MENTIONED)
    names = job.cases.where(look).select("parent", kind.alias("kind"), F.col("src_col").alias("source"))
    hits = C.find_mentions(names.distinct(), C.searched_texts(*job.corpus), job.work_dir)
    return materialize(hits, "mentions", job.work_dir)


def _logic(job: Job) -> DataFrame:
    """``concat``: what each statement offers per column, computed once for its readers."""
    logic = C.statement_logic(job.corpus.assigned, job.profile)
    return materialize(logic, "logic", job.work_dir)


def scored_cases(
    job: Job, mentions: DataFrame | None = None, logic: DataFrame | None = None
) -> DataFrame:
    """Every candidate of the cases that scan statements (columns ``C.CANDIDATE``), computed
    once."""
    scans = job.cases.where(F.col("gate").isin("normal", "static"))
    if job.profile.multi_row:
        mentions = _mentions(job) if mentions is None else mentions
        scored = C.candidates_rows(scans, job.corpus.assigned, mentions, job.profile, job.work_dir)
    else:
        logic = _logic(job) if logic is None else logic
        scored = C.candidates_concat(scans, logic, job.profile, job.work_dir)
    return materialize(scored, "candidates", job.work_dir)


def _found_rows(job: Job) -> DataFrame:
    """``rows``: what the statements answer, one row per case and distinct outcome."""
    parsed, assigned = job.corpus
    mentions = _mentions(job)
    contexts = C.searched_texts(parsed, assigned).where(F.col("kind") == C.CONTEXT)
    shown = mentions.where(F.col("kind") == C.CONTEXT).join(
        contexts.select("parent", "tid", "shown"), ["parent", "tid"]
    )
    reads = (
        job.cases.where("gate = 'read'")
        .select("case_id", "parent", F.col("src_col").alias("source"))
        .join(shown, ["parent", "source"])
        .select("case_id", F.col("shown").alias("logic"), "tid.query_id")
    )
    static = job.cases.where("gate = 'static'")
    entries = C.entries_rows(assigned).select("parent", "key", "expr", "query_id", "is_literal")
    constants = (
        static.select("case_id", "parent", "key")
        .join(entries, ["parent", "key"])
        .select("case_id", F.col("expr").alias("logic"), "query_id", "is_literal")
    )
    constants = materialize(C.distinct_logic(constants), "constants", job.work_dir)
    tier = C.best_tier(scored_cases(job, mentions))
    tier = tier.join(constants.select("case_id").distinct(), "case_id", "left_anti")
    names = ["case_id", "logic", "query_id"]
    constants = C.literals_or_all(constants, static).select(names)
    found = C.distinct_logic(reads).select(names).union(constants)
    return materialize(found.union(C.distinct_logic(tier).select(names)), "found", job.work_dir)


def _with_file_facts(job: Job, asked: DataFrame, firsts: DataFrame) -> DataFrame:
    """Cases with the facts of their file and the first statement for their key."""
    info = ST.file_info(job.corpus.parsed, job.profile).withColumn("has_file", F.lit(True))
    if not job.profile.multi_row:
        stars = SH.wildcards(*job.corpus).groupBy("parent").agg(
            F.min(F.struct("stmt_no", "prio", "query_id", "description")).alias("first_star")
        )
        info = info.join(stars, "parent", "left")
    return asked.join(info, "parent", "left").join(firsts, C.PLACE, "left")


def _outcomes_rows(job: Job) -> DataFrame:
    found = _found_rows(job)
    rest = job.cases.join(found.select("case_id").distinct(), "case_id", "left_anti")
    facts = _with_file_facts(job, rest, C.firsts_rows(*job.corpus))
    gate = F.col("gate")
    missing_id = ST.placeholder_id(F.col("parent"))
    default = F.coalesce("default_id", missing_id)
    failed = F.when(F.col("has_file"), F.col("failed_id")).otherwise(missing_id)
    first_id = F.col("first.query_id")
    named = F.coalesce("parent", F.lit("")) != ""
    null_id = F.when(
        F.col("tgt_name") == "", F.coalesce("first_values_id", default)
    ).otherwise(F.coalesce(first_id, default))
    outcome = (
        F.when(gate == "row_error", _one(K.EXTRACT_ERROR, F.when(named, default).otherwise("")))
        .when(gate == "file_error", _one(K.PROCESSING_ERROR, ""))
        .when(gate == "null", _one(K.NULL_LITERAL, null_id))
        .when(gate == "wildcard", _one(K.WILDCARD_ROWS, F.coalesce(first_id, default)))
        .when(gate == "missing_both", _one(K.MISSING_BOTH, default))
        .when(gate == "missing_source", _one(K.MISSING_SOURCE, default))
        .when(gate.isin("missing_target", "read"), _one(K.MISSING_TARGET, default))
        .when(gate == "static", _one(job.profile.static_fallback, default))
        .when(failed.isNotNull(), _one(K.PARSE_FAILED, failed))
        .otherwise(_one(K.NOT_FOUND, default))
    )
    return found.union(facts.select("case_id", outcome.alias("o")).select("case_id", "o.*"))


def _one(logic: Column | str, query_id: Column | str) -> Column:
    logic = F.lit(logic) if isinstance(logic, str) else logic
    query_id = F.lit(query_id) if isinstance(query_id, str) else query_id
    return F.struct(logic.alias("logic"), query_id.alias("query_id"))


def _tiers_concat(job: Job, logic: DataFrame) -> DataFrame:
    """``concat``: per case the distinct expressions of the best tier in statement order."""
    static = job.cases.where("gate = 'static'")
    tier = C.best_tier(scored_cases(job, logic=logic), static)
    at = F.min(F.struct("ord", "seq", "query_id")).alias("at")
    each = tier.groupBy("case_id", "logic").agg(at)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("at", "logic"))), lambda x: x["logic"])
    return each.groupBy("case_id").agg(
        F.array_join(texts, " | ").alias("tier_logic"), F.min("at").alias("tier_at")
    )


def _outcomes_concat(job: Job) -> DataFrame:
    logic = _logic(job)
    facts = _with_file_facts(job, job.cases, C.firsts_concat(*job.corpus, logic))
    facts = facts.join(_tiers_concat(job, logic), "case_id", "left")
    gate = F.col("gate")
    default = F.coalesce("default_id", F.lit(""))
    first_id, first_text = F.col("first.query_id"), F.col("first.text")
    star_text = F.concat(
        F.lit("Wildcard ("),
        F.when(F.coalesce("shown_column", F.lit("")) != "", F.col("shown_column")).otherwise(
            F.coalesce("shown_target", F.lit(""))
        ),
        F.lit(") — all columns from "),
        F.when(F.coalesce("shown_table", F.lit("")) != "", F.col("shown_table")).otherwise(
            F.coalesce("shown_target_table", F.lit(""))
        ),
    )
    star = (
        F.when(first_text.isNotNull(), _one(first_text, first_id))
        .when(
            F.col("first_star").isNotNull(),
            _one(F.col("first_star.description"), F.col("first_star.query_id")),
        )
        .otherwise(_one(star_text, default))
    )
    no_context = F.concat(
        F.lit("Read column '"), F.col("shown_column"), F.lit("' (context not extracted)")
    )
    outcome = (
        F.when((gate == "file_error") | F.col("has_file").isNull(), _one(K.NOT_FOUND, ""))
        .when(gate == "null", _one(K.NULL_LITERAL, F.coalesce(first_id, default)))
        .when(gate == "wildcard", star)
        .when(
            gate == "read", _one(F.coalesce(first_text, no_context), F.coalesce(first_id, default))
        )
        .when(gate == "missing_both", _one(K.MISSING_BOTH, default))
        .when(gate == "missing_source", _one(K.MISSING_SOURCE, default))
        .when(gate == "missing_target", _one(K.MISSING_TARGET, default))
        .when(
            F.col("tier_logic").isNotNull(), _one(F.col("tier_logic"), F.col("tier_at.query_id"))
        )
        .when(gate == "static", _one(job.profile.static_fallback, default))
        .when(F.col("failed_id").isNotNull(), _one(K.PARSE_FAILED, F.col("failed_id")))
        .otherwise(_one(K.NOT_FOUND, default))
    )
    return facts.select("case_id", outcome.alias("o")).select("case_id", "o.*")


def resolve(job: Job) -> DataFrame:
    """Fact rows (with ``row_id``): each edge with the outcomes of its case."""
    outcomes = _outcomes_rows(job) if job.profile.multi_row else _outcomes_concat(job)
    outcomes = materialize(outcomes, "outcomes", job.work_dir)
    source = {c: "parent_given" if c == "parent" else c for c in EDGE_COLUMNS}
    given = [F.coalesce(source[c], F.lit("")).alias(c) for c in EDGE_COLUMNS]
    return job.edges.join(outcomes, "case_id").select(
        "row_id",
        *given,
        F.col("logic").alias("transformation_logic"),
        F.col("query_id").alias("query_uuid"),
    )


def candidates(edges: DataFrame, sql_files: DataFrame, profile: str | Profile) -> DataFrame:
    """One row per scored candidate of an edge."""
    job = prepare(edges, sql_files, profile)
    return _of_edges(job, scored_cases(job))


def best_candidates(edges: DataFrame, sql_files: DataFrame, profile: str | Profile) -> DataFrame:
    """One row per candidate with the highest score of its edge."""
    job = prepare(edges, sql_files, profile)
    return _of_edges(job, C.best_tier(scored_cases(job)))


def _of_edges(job: Job, scored: DataFrame) -> DataFrame:
    rows = job.edges.select("row_id", "case_id").join(scored, "case_id")
    return rows.select("row_id", "query_id", "logic", "score", "is_literal", "ord")


def dim_table(
    edges: DataFrame, sql_files: DataFrame, statements: DataFrame, profile: Profile
) -> DataFrame:
    """The statement dimension; ``rows`` adds placeholders for missing and unreadable files."""
    dim = ST.dim_rows(statements, profile)
    if profile.multi_row:
        dim = dim.unionByName(ST.missing_dim_rows(ST.missing_files(edges, sql_files)))
        unnamed = (
            edges.where(F.coalesce("parent", F.lit("")) == "")
            .select(F.lit("").alias("parent"))
            .distinct()
        )
        dim = dim.unionByName(
            ST.missing_dim_rows(unnamed).withColumn(
                "parse_error", F.lit("WORKER_EXCEPTION: no file name")
            )
        )
    return dim.select(*[N.sanitize(F.col(c)).alias(c) for c in DIM_COLUMNS])


def extract_lineage(
    edges: DataFrame,
    sql_files: DataFrame,
    profile: str | Profile = "rows",
    work_dir: str | None = None,
) -> Lineage:
    """Explain every edge by the expression that fills its target column.

    ``edges`` has the seven input columns and optionally a unique ``row_id``;
    ``sql_files`` has ``parent`` and ``sql_text``, one row per file. Where the
    edges write paths in other ways, a column ``parent_key`` names the file.
    Shared results are written below ``work_dir`` or the session's
    ``spark.checkpoint.dir`` while this runs, and persisted where neither is set.
    """
    job = prepare(edges, sql_files, profile, work_dir=work_dir)
    fact = resolve(job).select("row_id", *FACT_COLUMNS)
    dim = dim_table(job.cases, sql_files, job.corpus.parsed, job.profile)
    warnings = R.warnings(job.cases, sql_files, job.corpus.parsed)
    if K.ROW_ERROR in edges.columns:
        warnings = warnings.unionByName(R.row_warnings(edges))
    shared = (job.edges, job.cases, *job.corpus)
    return Lineage(fact, dim, R.summarize(fact, job.profile), warnings, shared, job.profile)


def statement_dim(edges: DataFrame, sql_files: DataFrame, profile: str | Profile = "rows") -> DataFrame:
    """The dimension alone: the catalog of the named files, without their assignments."""
    profile = get_profile(profile)
    parents = E.with_file_key(edges).select("parent").distinct()
    named = spread_work(sql_files.join(parents, "parent", "left_semi"), "parent")
    return dim_table(parents, sql_files, ST.statement_catalog(named, profile), profile)
