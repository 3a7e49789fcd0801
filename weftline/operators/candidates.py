"""Matching edges with assignments: what statements offer, scores and the best tier.

What is scored are *cases*, the distinct combinations of file, names and tables that
edges ask about (:func:`weftline.operators.edges.cases`). A case and an assignment that may
answer it are one row, so work is split by pairs and no array grows with a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import Profile
from ..functions import names as N
from . import shapes as SH
from .spread import computed_once, materialize, spread_join

PLACE = ["parent", "kind", "key"]
ASSIGNED, TARGET_TABLE, READ_COLUMN = "T", "W", "R"
MENTIONED, CONTEXT = "S", "C"


# --- statement facts seen from one edge -----------------------------------------------------


def source_alias(tables: Column, source_table: Column) -> Column:
    """Alias of the first reference to the source table; its name when it has none."""
    hit = F.get(F.filter(tables, lambda t: t["name"] == source_table), 0)
    return (
        F.when(hit.isNull() | (source_table == ""), "")
        .when(hit["alias"] != "", hit["alias"])
        .otherwise(source_table)
    )


def other_names(tables: Column, source_table: Column) -> Column:
    """Names and aliases of the tables that are not the source table."""
    others = F.filter(tables, lambda t: t["name"] != source_table)
    named = F.flatten(F.transform(others, lambda t: F.array(t["name"], t["alias"])))
    return F.array_distinct(F.array_remove(named, ""))


def names_other_table(tables: Column, source_table: Column, qualifier: Column) -> Column:
    return F.array_contains(other_names(tables, source_table), qualifier)


# --- scores ---------------------------------------------------------------------------------


def refers_to_source(
    expr: Column, source_table: Column, alias: Column, is_static: Column
) -> Column:
    """``concat`` rule: a literal only fits a static edge; qualifiers must include the source."""
    quals = N.qualifier_set(expr)
    return (
        F.when(source_table == "", True)
        .when(N.is_literal_wide(expr), is_static)
        .otherwise(
            (F.size(quals) == 0)
            | F.array_contains(quals, source_table)
            | ((alias != "") & F.array_contains(quals, alias))
        )
    )


def score_concat(target_fits: Column, source_fits: Column) -> Column:
    return F.when(target_fits & source_fits, 3).when(target_fits, 2).otherwise(1)


def target_fits_loosely(edge_table: Column, stmt_table: Column) -> Column:
    return (edge_table == "") | (stmt_table == "") | (edge_table == stmt_table)


def target_fits_exactly(edge_table: Column, stmt_table: Column) -> Column:
    return (edge_table != "") & (edge_table == stmt_table)


def score_rows(
    target_fits: Column,
    expr: Column,
    refs: Column,
    words: Column,
    tables: Column,
    alias: Column,
    source_table: Column,
    source_col: Column,
    plain_source: Column | None = None,
) -> Column:
    """``rows`` rule: qualifiers on the source column decide; 0 means another table's column."""

    def mine(r: Column) -> Column:
        return (r["q"] == source_table) | ((alias != "") & (r["q"] == alias))

    on_source = F.filter(refs, lambda r: (source_col == "") | (r["c"] == source_col))
    foreign = F.exists(
        on_source,
        lambda r: names_other_table(tables, source_table, r["q"]) & ((alias == "") | ~mine(r)),
    )
    confirmed = F.exists(on_source, mine)
    open_ref = (alias == "") & F.exists(on_source, lambda r: r["q"] != source_table)
    names_table = (
        (source_table != "")
        & ~((source_col != "") & N.has_word(words, expr, source_col, plain_source))
        & N.has_word(words, expr, source_table)
    )
    qualified = F.size(refs) > 0
    verified = F.when(qualified, confirmed).otherwise(names_table)
    unverified = F.when(qualified, open_ref).otherwise(~names_table)
    return (
        F.when(qualified & foreign, 0)
        .when(target_fits & verified, 3)
        .when(target_fits & unverified, 2)
        .when(verified | unverified, 1)
        .otherwise(0)
    )


def leading_alias_fits(
    expr: Column, tables: Column, alias: Column, source_table: Column
) -> Column:
    """The leading qualifier is the source's, or unknown and no other table's."""
    lead = N.leading_qualifier(expr)
    return (
        (lead == "")
        | ((alias != "") & (lead == alias))
        | ((source_table != "") & (lead == source_table))
        | ((alias == "") & ~names_other_table(tables, source_table, lead))
    )


# --- what statements offer ------------------------------------------------------------------

ENTRY = ["query_id", "stmt_no", "expr", "target_table", "is_literal", "tail", "refs", "words", "tables"]


def _can_assign(kind: Column, clause: Column) -> Column:
    """A SELECT inside UPDATE, MERGE or DELETE does not assign the target's columns."""
    return ~((clause == SH.SELECT) & kind.isin("UPDATE", "MERGE", "DELETE"))


def entries_rows(assigned: DataFrame) -> DataFrame:
    """``rows``: every assignment by file and target column."""
    return assigned.where("target_col <> ''").select(
        "parent",
        F.col("target_col").alias("key"),
        *ENTRY,
        _can_assign(F.col("kind"), F.col("clause")).alias("usable"),
    )


def firsts_rows(parsed: DataFrame, assigned: DataFrame) -> DataFrame:
    """``rows``: the first statement per assigned column and per written table."""
    by_column = assigned.where("target_col <> ''").select(
        "parent", F.lit(ASSIGNED).alias("kind"), F.col("target_col").alias("key"), "stmt_no", "query_id"
    )
    by_table = parsed.where("target_table <> ''").select(
        "parent", F.lit(TARGET_TABLE).alias("kind"), F.col("target_table").alias("key"), "stmt_no", "query_id"
    )
    return by_column.union(by_table).groupBy(*PLACE).agg(
        F.min(F.struct("stmt_no", "query_id")).alias("first")
    )


def statement_logic(assigned: DataFrame, profile: Profile) -> DataFrame:
    """``concat``: per statement and target column the expressions that count.

    ``normal``: all MERGE branches, else the first hit; ``static``: the first hit
    of the static order. With ``all_hits`` every hit of the winning clause stays.
    """
    clause, branch = F.col("clause"), F.col("branch_no")
    first_branch = F.lit(True) if profile.all_hits else branch == 0
    rank_n = (
        F.when(clause.isin(SH.SET, SH.MERGE_SET, SH.MERGE_INSERT), 1)
        .when((clause == SH.INSERT_SELECT) & first_branch, 1)
        .when(clause == SH.SELECT, 2)
    )
    rank_s = (
        F.when(clause.isin(SH.SET, SH.MERGE_SET), 1)
        .when((clause == SH.INSERT_SELECT) & first_branch, 2)
        .when((clause == SH.VALUES) & (branch == 0), 3)
        .when(clause == SH.MERGE_INSERT, 4)
        .when((clause == SH.SELECT) & F.col("aliased"), 5)
    )

    def hits(rank: str) -> Column:
        return F.array_sort(
            F.collect_list(F.when(F.col(rank).isNotNull(), F.struct(rank, "unit_no", "ord", "expr")))
        )

    def best(arr: str, rank: str, keep_all: Column) -> Column:
        top = F.filter(arr, lambda x: x[rank] == F.get(F.col(arr), 0)[rank])
        top = F.when(keep_all, top).otherwise(F.slice(arr, 1, 1))
        return F.array_distinct(F.transform(top, lambda x: x["expr"]))

    every = F.lit(profile.all_hits)
    merge_hits = (F.col("stmt_kind") == "MERGE") & (F.get("n", 0)["rank_n"] == 1)
    return (
        assigned.where("target_col <> ''")
        .select(
            "*",
            rank_n.alias("rank_n"),
            rank_s.alias("rank_s"),
        )
        .groupBy("parent", "target_col", "stmt_no", "query_id")
        .agg(
            F.first("kind").alias("stmt_kind"),
            F.first("target_table").alias("target_table"),
            F.first("tables").alias("tables"),
            hits("rank_n").alias("n"),
            hits("rank_s").alias("s"),
        )
        .select(
            "parent",
            "target_col",
            "stmt_no",
            "query_id",
            "target_table",
            "tables",
            (F.lit(not profile.all_hits) & merge_hits).alias("join_hits"),
            best("n", "rank_n", every | F.coalesce(merge_hits, F.lit(False))).alias("normal"),
            F.when(every, F.array_distinct(F.transform("s", lambda x: x["expr"])))
            .otherwise(best("s", "rank_s", F.lit(False)))
            .alias("static"),
        )
    )


def firsts_concat(parsed: DataFrame, assigned: DataFrame, logic: DataFrame) -> DataFrame:
    """``concat``: first statement that assigns a column, first read, first wildcard."""
    nowhere = F.struct(F.lit(0).alias("unit_no"), F.lit(0).alias("ord"))

    def first(rank: Column, pos: Column, text: Column) -> Column:
        return F.struct(
            "stmt_no", rank.cast("int").alias("rank"), pos.alias("pos"), "query_id", text.alias("text")
        )

    by_column = logic.where(F.size("static") > 0).select(
        "parent",
        F.lit(ASSIGNED).alias("kind"),
        F.col("target_col").alias("key"),
        first(F.lit(0), nowhere, F.lit("")).alias("first"),
    )
    by_read = SH.column_reads(parsed, assigned).select(
        "parent",
        F.lit(READ_COLUMN).alias("kind"),
        F.col("column_name").alias("key"),
        first(F.col("rank"), F.col("pos"), F.col("shown")).alias("first"),
    )
    by_table = SH.wildcards(parsed, assigned).where("target_table <> ''").select(
        "parent",
        F.lit(TARGET_TABLE).alias("kind"),
        F.col("target_table").alias("key"),
        first(F.col("prio"), nowhere, F.col("description")).alias("first"),
    )
    rows = by_column.union(by_read).union(by_table)
    return rows.groupBy(*PLACE).agg(F.min("first").alias("first"))


# --- columns mentioned anywhere in a text ----------------------------------------------------

# Words of a file with one piece in common that are searched together, about.
TOKENS_PER_SPLIT = 10_000
# Characters of a file that are searched name by name, about; above that names meet pieces.
DIRECT_CHARS = 4_000_000
# A pair of a name and a text costs about as much as searching so many characters.
_CHARS_PER_PAIR = 64
_RUN = r"(?:[^\s\p{Punct}]|_)+"


def text_tokens(text: Column) -> Column:
    """Distinct words of a text, and the empty token that stands for any text."""
    found = F.regexp_extract_all(F.upper(text), F.lit(f"({_RUN})"), F.lit(1))
    return F.array_distinct(F.concat(F.array(F.lit("")), found))


def token_grams(token: Column, size: Column) -> Column:
    """Every piece of ``size`` characters of a token; the empty token has itself."""
    pieces = F.transform(
        F.sequence(F.lit(1), F.length(token) - size + 1), lambda i: F.substr(token, i, size)
    )
    return (
        F.when((token == "") & (size == 0), F.array(F.lit("")))
        .when((size > 0) & (F.length(token) >= size), F.array_distinct(pieces))
        .otherwise(F.array().cast("array<string>"))
    )


def _place_in_text(rank: Column, unit_no: Column, ord_: Column) -> Column:
    return F.struct(
        "query_id", rank.cast("int").alias("rank"), unit_no.alias("unit_no"), ord_.alias("ord")
    ).alias("tid")


def searched_texts(parsed: DataFrame, assigned: DataFrame) -> DataFrame:
    """Texts a source column may be mentioned in: ``parent, kind, tid, match`` and, for
    contexts, ``shown``."""
    selected = mentionable(assigned).select(
        "parent", F.lit(MENTIONED).alias("kind"), "tid", F.col("item").alias("match"),
        F.lit(None).cast("string").alias("shown"),
    )
    contexts = (
        SH.read_contexts(parsed, assigned)
        .where("rank <= 2 OR top_level")
        .select(
            "parent",
            F.lit(CONTEXT).alias("kind"),
            _place_in_text(F.col("rank"), F.col("pos.unit_no"), F.col("pos.ord")),
            "match",
            "shown",
        )
    )
    return selected.union(contexts)


def mentionable(assigned: DataFrame) -> DataFrame:
    """Select items that count for a column they mention, with their ``tid``."""
    items = SH.select_items(assigned).where(_can_assign(F.col("kind"), F.col("clause")))
    return items.withColumn("tid", _place_in_text(F.lit(1), F.col("unit_no"), F.col("ord")))


def find_mentions(names: DataFrame, texts: DataFrame, work_dir: str | None = None) -> DataFrame:
    """``(parent, kind, source, tid)`` of the texts that contain a name of their file.

    Where a file's names times its characters are few, each name is looked for in each text.
    In the other files names meet words by their pieces (:func:`mentions_by_pieces`); both
    ways find the same.
    """
    place = ["parent", "kind"]
    asked = names.groupBy(*place).agg(F.count(F.lit(1)).alias("names"))
    chars = F.sum(F.length("match") + _CHARS_PER_PAIR).alias("chars")
    large = (
        texts.groupBy(*place)
        .agg(chars)
        .join(asked, place)
        .where(F.col("chars") * F.col("names") > DIRECT_CHARS)
        .select(*place)
    )
    large = materialize(large, "large-files", work_dir)
    if not large.head(1):
        return _mentions_by_names(names, texts)
    small = _mentions_by_names(
        names.join(large, place, "left_anti"), texts.join(large, place, "left_anti")
    )
    return small.union(
        mentions_by_pieces(
            names.join(large, place, "left_semi"), texts.join(large, place, "left_semi"), work_dir
        )
    )


def _mentions_by_names(names: DataFrame, texts: DataFrame) -> DataFrame:
    upper = texts.select("parent", "kind", "tid", F.upper("match").alias("upper"))
    return (
        names.select("parent", "kind", "source")
        .join(upper, ["parent", "kind"])
        .where(F.col("upper").contains(F.col("source")))
        .select("parent", "kind", "source", "tid")
    )


def mentions_by_pieces(
    names: DataFrame, texts: DataFrame, work_dir: str | None = None
) -> DataFrame:
    """:func:`find_mentions` for files with many names and texts.

    Substring search as equi-joins: a name's first word sits inside one word of the text, so
    both meet by a common piece of up to 3 characters, for each name the one that the fewest
    words of its file have. Only files with names take part, only pieces of the sizes their
    names have are made, and texts travel by their ids until real hits are tested. The words
    that share a piece are dealt over splits, which each name visits, and words that make many
    pairs are split by names.
    """
    probe = names.withColumn("run", F.regexp_extract("source", f"({_RUN})", 1)).withColumn(
        "size", F.least(F.length("run"), F.lit(3))
    )
    sizes = probe.select("parent", "kind", "size").distinct()
    wanted = texts.join(names.select("parent", "kind").distinct(), ["parent", "kind"], "left_semi")
    tokens = wanted.select(
        "parent", "kind", "tid", F.explode_outer(text_tokens(F.col("match"))).alias("token")
    )
    tokens = materialize(tokens, "tokens", work_dir)
    grams = (
        tokens.select("parent", "kind", "token")
        .distinct()
        .join(sizes, ["parent", "kind"])
        .withColumn("gram", F.explode_outer(token_grams(F.col("token"), F.col("size"))))
        .where("gram IS NOT NULL")
        .drop("size")
    )
    grams = materialize(grams, "grams", work_dir)
    often = grams.groupBy("parent", "kind", "gram").agg(F.count(F.lit(1)).alias("n"))
    splits = F.ceil(F.col("n") / TOKENS_PER_SPLIT).cast("int")
    dealt = grams.join(often, ["parent", "kind", "gram"]).withColumn(
        "split", F.pmod(F.xxhash64("token"), splits).cast("int")
    )
    asked = rarest_pieces(probe, often).withColumn(
        "split", F.explode_outer(F.sequence(F.lit(0), splits - 1))
    )
    words = (
        asked.drop("n")
        .join(dealt.drop("n"), ["parent", "kind", "gram", "split"])
        .where(F.col("token").contains(F.col("run")))
        .select("parent", "kind", "source", "token")
    )
    words = materialize(words, "words", work_dir)
    near = spread_join(words, tokens, ["parent", "kind", "token"], "source", work_dir)
    return (
        near.select("parent", "kind", "source", "tid")
        .distinct()
        .join(wanted.select("parent", "kind", "tid", "match"), ["parent", "kind", "tid"])
        .where(F.upper("match").contains(F.col("source")))
        .select("parent", "kind", "source", "tid")
    )


def rarest_pieces(probe: DataFrame, often: DataFrame) -> DataFrame:
    """``(parent, kind, source, run, gram, n)``: of each name's pieces the one that the fewest
    words of its file have, by the counts ``often``. A name with a piece that no word has is
    left out: it has no hit."""
    pieces = probe.withColumn("gram", F.explode_outer(token_grams(F.col("run"), F.col("size"))))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")
    return (
        pieces.join(often, ["parent", "kind", "gram"], "left")
        .groupBy("parent", "kind", "source", "run")
        .agg(F.min(rank).alias("least"))
        .where("least.n > 0")
        .select("parent", "kind", "source", "run", "least.gram", "least.n")
    )


# --- candidates ------------------------------------------------------------------------------

CANDIDATE = ["case_id", "query_id", "logic", "score", "is_literal", "ord", "seq"]


def candidates_rows(
    scans: DataFrame, assigned: DataFrame, mentions: DataFrame, profile: Profile, work_dir: str | None
) -> DataFrame:
    """Scored candidates of ``rows`` cases, each once; score 0 is dropped.

    An assignment is one by its target column, or by a text that mentions the source.
    """
    asked = scans.select("case_id", "parent", "src_tbl", "tgt_tbl", "src_col", F.col("tgt_col").alias("key"))
    by_target = spread_join(
        asked, entries_rows(assigned).where("usable").drop("usable"), ["parent", "key"], "case_id", work_dir
    )
    hits = mentions.where(F.col("kind") == MENTIONED).select("parent", F.col("source").alias("src_col"), "tid")
    texts = mentionable(assigned).select("parent", "tid", *ENTRY)
    # Read twice: to count the pairs of a name, and to make them.
    mentioned = materialize(hits.join(texts, ["parent", "tid"]), "mentioned", work_dir)
    by_mention = spread_join(asked.drop("key"), mentioned, ["parent", "src_col"], "case_id", work_dir)
    names = ["case_id", "src_tbl", "tgt_tbl", "src_col", *ENTRY]
    pairs = by_target.select(names).union(by_mention.select(names))
    aliased = pairs.withColumn("alias", source_alias(F.col("tables"), F.col("src_tbl")))
    score = score_rows(
        target_fits_exactly(F.col("tgt_tbl"), F.col("target_table")),
        F.col("expr"),
        F.col("refs"),
        F.col("words"),
        F.col("tables"),
        F.col("alias"),
        F.col("src_tbl"),
        F.col("src_col"),
        N.is_plain_word(F.col("src_col")),
    )
    logic = F.when(
        N.tail_is_source(F.col("tail"), F.col("src_col"), F.col("alias")), profile.passthrough
    ).otherwise(F.col("expr"))
    scored = aliased.select(
        "case_id",
        "query_id",
        logic.alias("logic"),
        score.cast("int").alias("score"),
        "is_literal",
        F.col("stmt_no").alias("ord"),
        F.lit(0).alias("seq"),
    )
    return distinct_logic(computed_once(scored).where("score > 0"), "score")


def distinct_logic(rows: DataFrame, *also: str) -> DataFrame:
    """One row per case, statement and outcome text (and the columns ``also``).

    Copies merge before they move, in a hash table: all other columns have a fixed width, while
    a text beside the key would make the aggregate sort its rows.
    """
    key = ["case_id", "query_id", *also, "logic"]
    others = [F.min(c).alias(c) for c in rows.columns if c not in key]
    merged = rows.groupBy(*key).agg(*others) if others else rows.select(*key).distinct()
    return merged.select(rows.columns)


def candidates_concat(scans: DataFrame, logic: DataFrame, profile: Profile, work_dir: str | None) -> DataFrame:
    """Scored candidates of ``concat`` cases, one row per statement and expression."""
    asked = scans.select(
        "case_id", "parent", "gate", "src_tbl", "tgt_tbl", "src_col", F.col("tgt_col").alias("key")
    )
    offered = logic.withColumnRenamed("target_col", "key")
    pairs = spread_join(asked, offered, ["parent", "key"], "case_id", work_dir)
    is_static = F.col("gate") == "static"
    alias, src = F.col("alias"), F.col("src_col")
    normal = F.array_distinct(
        F.transform(
            "normal",
            lambda x: F.when(N.is_passthrough_ident(x, src, alias), profile.passthrough).otherwise(x),
        )
    )
    joined = F.when(F.col("join_hits"), F.array(F.array_join(normal, " | "))).otherwise(normal)
    found = F.when(is_static, F.col("static")).otherwise(joined)
    if profile.check_leading_alias:
        found = F.filter(
            found,
            lambda x: (x == profile.passthrough)
            | leading_alias_fits(x, F.col("tables"), alias, F.col("src_tbl")),
        )
    with_logic = pairs.withColumn(
        "alias", source_alias(F.col("tables"), F.col("src_tbl"))
    ).withColumn("found", found)
    fits = target_fits_loosely(F.col("tgt_tbl"), F.col("target_table"))
    source = F.forall(
        "found", lambda x: refers_to_source(x, F.col("src_tbl"), alias, is_static)
    )
    scored = with_logic.select(
        "case_id",
        "query_id",
        "stmt_no",
        score_concat(fits, source).cast("int").alias("score"),
        F.posexplode("found").alias("seq", "logic"),
    )
    return scored.select(
        "case_id",
        "query_id",
        "logic",
        "score",
        N.is_literal_wide(F.col("logic")).alias("is_literal"),
        F.col("stmt_no").alias("ord"),
        "seq",
    )


def best_tier(candidates: DataFrame, static_cases: DataFrame | None = None) -> DataFrame:
    """Candidates with their case's highest score; of the ``static_cases`` only the literals,
    if there are any. ``candidates`` is read twice or more and should be a stored table.

    What a case keeps is an aggregate, which combines on the map side and moves no text; the
    candidates then meet one row per case, and a hot case is split as any skewed join is.
    """
    best = candidates.groupBy("case_id").agg(F.max("score").alias("score"))
    top = candidates.join(best, ["case_id", "score"]).select(candidates.columns)
    return top if static_cases is None else literals_or_all(top, static_cases)


def literals_or_all(rows: DataFrame, cases: DataFrame) -> DataFrame:
    """Rows without those that are no literals in the ``cases`` that have a literal."""
    has = rows.where("is_literal").select("case_id").distinct()
    only = has.join(cases.select("case_id"), "case_id", "left_semi").withColumn("only", F.lit(True))
    return rows.join(only, "case_id", "left").where("is_literal OR only IS NULL").drop("only")
