"""Cutting statement text at depth 0 with regular expressions.

Parentheses are matched by a pattern nested ``MAX_DEPTH`` times. All repeats
are possessive, so a match is linear in the text, needs no stack for long
texts and stays one native call per cut. Quoted text is one unit everywhere.
A statement nested deeper is folded first (:func:`fold`): its innermost groups
become plain text, level by level, until the pattern closes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import bare_table, strip

MAX_DEPTH = 32

# Word characters one by one: a class of single characters is a table lookup in
# the regex engine, a class of ranges is a chain of tests.
WORD = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"

QUOTED = r"""'(?:[^']++|'')*+'|"[^"]*+\""""


def _nested(depth: int) -> str:
    inner = rf"""[^()'"]++|{QUOTED}"""
    pattern = rf"\((?:{inner})*+\)"
    for _ in range(depth - 1):
        pattern = rf"\((?:{inner}|{pattern})*+\)"
    return pattern


GROUP = _nested(MAX_DEPTH)
# The text between two matching parentheses.
INNER = rf"""(?:[^()'"]++|{QUOTED}|{GROUP})*+"""

IDENT = r'(?:"[^"]+"|\$\{\w+\}|[\w$#@]+)'
NAME = rf"{IDENT}(?:\s*\.\s*{IDENT})*+"
SELECT = r"(?:SELECT|SEL)"
CLAUSES = r"WHERE|GROUP\s+BY|HAVING|QUALIFY|ORDER\s+BY|SAMPLE|WINDOW|LIMIT"
SET_OPS = r"UNION|INTERSECT|EXCEPT|MINUS"
MERGE_WHEN = r"WHEN\s+(?:NOT\s+)?MATCHED"

# Words that can follow a table name but are never its alias.
_NOT_ALIAS = (
    r"AS|ON|LEFT|RIGHT|FULL|INNER|OUTER|CROSS|NATURAL|JOIN|WHERE|GROUP|ORDER|HAVING|QUALIFY|"
    r"UNION|INTERSECT|EXCEPT|MINUS|USING|SET|FROM|WHEN|VALUES|SAMPLE|LIMIT|WITH|SELECT|SEL|FOR"
)
_ALIAS = rf"(?:\s+(?:AS\s+)?(?!(?:{_NOT_ALIAS})\b)({IDENT}))?"

# The alias behind a parenthesised query, which may also stand in an expression.
QUERY_ALIAS = (
    rf"(?:\s*+(?:AS\s+)?(?!(?:{_NOT_ALIAS}|AND|OR|NOT|THEN|ELSE|END|IS|IN|LIKE|BETWEEN|ASC|DESC|"
    rf"INSERT|INS|UPDATE|UPD|MERGE|DELETE|DEL)\b)({IDENT}))?"
)

# Trailing words that are part of an expression, not a column alias.
_NOT_COLUMN_ALIAS = ["END", "NULL", "DAY", "MONTH", "YEAR", "HOUR", "MINUTE", "SECOND"]
_NOT_BEFORE_ALIAS = [
    "AND", "OR", "NOT", "LIKE", "IN", "IS", "BETWEEN", "WHEN", "THEN", "ELSE", "CASE", "MOD",
    "DISTINCT", "ALL", "AS", "AT", "INTERVAL", "DATE", "TIME", "TIMESTAMP",
]


def until(stop: str, also: str = "") -> str:
    """Pattern for depth-0 text that does not run over one of the ``stop`` words.

    ``also`` adds single characters that end the text as well.
    """
    return (
        rf"""(?:[^{WORD}()'"{also}]++|\b(?!(?:{stop})\b)[{WORD}]++|{QUOTED}|{GROUP})*+"""
    )


def cut(text: Column, pattern: str, group: int = 1) -> Column:
    return strip(F.regexp_extract(text, "(?is)" + pattern, group))


def cut_all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit("(?is)" + pattern), F.lit(group))


def _non_empty(arr: Column) -> Column:
    return F.filter(F.transform(arr, strip), lambda x: x != "")


# Signs for folded parentheses, for parentheses inside quotes of a folded text, and for those
# of groups that were looked at already.
_FOLDED = "\ue000\ue001\ue002\ue003\ue004\ue005"


def nesting(text: Column) -> Column:
    """Depth of the deepest parenthesis outside quotes, however deep."""
    marks = F.regexp_extract_all(F.regexp_replace(text, QUOTED, ""), F.lit("([()])"), F.lit(1))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, mark: Column) -> Column:
        now = acc["now"] + F.when(mark == "(", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(marks, start, step, lambda acc: acc["most"])


def _interleave(between: Column, marks: Column) -> Column:
    # Both arrays are arguments: inside the lambda they would be computed again for each item.
    pairs = F.zip_with(between, marks, lambda b, m: F.concat(b, F.coalesce(m, F.lit(""))))
    return F.array_join(pairs, "")


def fold(text: Column) -> tuple[Column, Column]:
    """``(folded text, bodies of the SELECTs that were folded)`` of a text that nests deeper
    than the patterns, by a depth counter; any other text stays as it is.

    Parentheses beyond the patterns' depth become plain signs.
    """
    quotes = F.transform(
        F.regexp_extract_all(text, F.lit(f"({QUOTED})"), F.lit(1)),
        lambda q: F.translate(q, "()", _FOLDED[2:4]),
    )
    plain = _interleave(F.split(text, QUOTED), quotes)
    marks = F.regexp_extract_all(plain, F.lit("([()])"), F.lit(1))
    counted = "struct<now:int,marks:array<string>>"

    def step(acc: Column, mark: Column) -> Column:
        opens = mark == "("
        now = acc["now"] + F.when(opens, 1).otherwise(-1)
        level = F.when(opens, now).otherwise(acc["now"])
        sign = F.when(level > MAX_DEPTH, F.translate(mark, "()", _FOLDED[:2])).otherwise(mark)
        return F.struct(now, F.concat(acc["marks"], F.array(sign))).cast(counted)

    start = F.struct(F.lit(0), F.array().cast("array<string>")).cast(counted)
    folded = _interleave(F.split(plain, "[()]"), F.aggregate(marks, start, step)["marks"])

    # Innermost folded groups first: each pass takes the bodies of one level.
    o, c = _FOLDED[:2]
    found = "struct<text:string,bodies:array<string>>"

    def level(acc: Column, _: Column) -> Column:
        inner = rf"(?i){o}(\s*(?:{SELECT}|WITH)\b[^{o}{c}]*+){c}"
        bodies = F.regexp_extract_all(acc["text"], F.lit(inner), F.lit(1))
        rest = F.regexp_replace(acc["text"], f"{o}([^{o}{c}]*+){c}", f"{_FOLDED[4]}$1{_FOLDED[5]}")
        return F.struct(rest, F.concat(acc["bodies"], bodies)).cast(found)

    passes = F.sequence(F.lit(1), F.greatest(nesting(text) - MAX_DEPTH, F.lit(1)))
    start = F.struct(folded, F.array().cast("array<string>")).cast(found)
    bodies = F.aggregate(passes, start, level)["bodies"]
    shown = F.transform(bodies, lambda b: strip(F.translate(b, _FOLDED[4:], "()")))
    # Most texts have too few parentheses to be deep, which is cheap to see.
    some = F.length(text) - F.length(F.replace(text, F.lit("("), F.lit(""))) > MAX_DEPTH
    deep = F.when(some, nesting(text) > MAX_DEPTH).otherwise(False)
    return (
        F.when(deep, folded).otherwise(text),
        F.when(deep, shown).otherwise(F.array().cast("array<string>")),
    )


def unfold(text: Column) -> Column:
    """The text with its own parentheses again."""
    signs = F.lit(False)
    for sign in _FOLDED:
        signs = signs | text.contains(sign)
    return F.when(signs, F.translate(text, _FOLDED, "()()()")).otherwise(text)


def is_balanced(text: Column) -> Column:
    """Parentheses and quotes all close."""
    return text.rlike(rf"\A{INNER}\z")


def clause(text: Column, word: str, stop: str) -> Column:
    """Depth-0 text after the first ``word`` up to one of the ``stop`` words."""
    found = cut(text, rf"\A{until(word)}\b(?:{word})\b({until(stop)})")
    first = word.split("\\")[0]
    return F.when(F.upper(text).contains(first), found).otherwise("")


def split_top(text: Column) -> Column:
    """Items between depth-0 commas, trimmed; an empty text has no items."""
    items = F.transform(
        cut_all(F.concat(F.lit(","), text), rf""",((?:[^(),'"]++|{QUOTED}|{GROUP})*+)"""), strip
    )
    return F.when(strip(text) == "", F.array().cast("array<string>")).otherwise(items)


def unwrap(text: Column) -> Column:
    """Take off one pair of parentheses around the whole text."""
    inner = cut(text, rf"\A\s*\(({INNER})\)\s*\z")
    return F.when(inner != "", inner).otherwise(text)


_WRAPPED_SELECT = rf"(?i)\A\s*\((?:\s*\()*\s*{SELECT}\b"


def from_first_select(text: Column) -> Column:
    """Tail that starts at the first depth-0 SELECT; the whole text if it starts with a
    parenthesised one."""
    tail = cut(text, rf"\A{until(SELECT)}(\b{SELECT}\b.*)\z")
    return F.when(text.rlike(_WRAPPED_SELECT), strip(text)).otherwise(tail)


def without_wrappers(text: Column) -> Column:
    """Operands of set operators without the parentheses around them."""
    plain = F.array_join(union_branches(text), " UNION ALL ")
    return F.when(text.rlike(_WRAPPED_SELECT), plain).otherwise(text)


def nested_selects(text: Column) -> Column:
    """Bodies of every parenthesised SELECT, at any depth, in text order."""
    body = rf"{QUOTED}|\((?=\s*((?:{SELECT}|WITH)\b{INNER})\))"
    return F.transform(
        _non_empty(cut_all(text, body)),
        lambda b: F.when(b.rlike(r"(?i)\AWITH\b"), from_first_select(b)).otherwise(b),
    )


def union_branches(text: Column) -> Column:
    """SELECT texts between depth-0 set operators."""
    run = rf"""[^{WORD}()'"]++|\b(?!(?:{SET_OPS})\b)[{WORD}]++|{QUOTED}|{GROUP}"""
    pieces = cut_all(text, f"((?:{run})++)")
    # One step each: a lambda computes its argument once, a text inside others again each time.
    heads = F.transform(
        pieces, lambda p: strip(F.regexp_replace(strip(p), r"(?i)\A(?:ALL|DISTINCT)\b", ""))
    )
    heads = F.transform(F.transform(heads, unwrap), unwrap)
    return F.filter(heads, lambda p: p.rlike(rf"(?i)\A{SELECT}\b"))


def select_list(branch: Column) -> Column:
    return cut(
        branch,
        rf"\A{SELECT}\b\s*(?:(?:DISTINCT|ALL)\b\s*)?"
        rf"(?:TOP\s+[\d.]+\s+(?:PERCENT\b\s*)?(?:WITH\s+TIES\b\s*)?)?({until('FROM|' + CLAUSES)})",
    )


def from_clause(branch: Column) -> Column:
    return clause(branch, "FROM", CLAUSES)


def flat_joins(from_text: Column) -> Column:
    """A FROM clause without the parentheses around joined tables; subqueries keep theirs."""
    group = rf"(?i)(\A|,|\bJOIN\b)\s*(?:\(\s*)+(?!\s*(?:{SELECT}|WITH)\b)(?=[\w$\"])"
    return F.regexp_replace(from_text, group, "$1 ")


def join_conditions(from_text: Column) -> Column:
    stop = r"ON|JOIN|LEFT|RIGHT|INNER|FULL|CROSS|NATURAL"
    found = cut_all(flat_joins(from_text), rf"{QUOTED}|{GROUP}|\bON\b({until(stop, ',')})")
    return F.when(F.upper(from_text).contains("ON"), _non_empty(found)).otherwise(
        F.when(from_text.isNotNull(), F.array().cast("array<string>"))
    )


def _table_structs(names: Column, aliases: Column) -> Column:
    pairs = F.zip_with(
        names,
        aliases,
        lambda n, a: F.struct(
            bare_table(n).alias("name"),
            F.upper(F.replace(a, F.lit('"'), F.lit(""))).alias("alias"),
        ),
    )
    return F.filter(pairs, lambda t: t["name"] != "")


def from_tables(from_text: Column) -> Column:
    """Tables of one FROM clause as ``array<struct<name, alias>>``."""
    text = F.concat(F.lit(","), flat_joins(from_text))
    pattern = rf"{QUOTED}|{GROUP}|(?:,|\bJOIN\b)\s*+({NAME}){_ALIAS}"
    return _table_structs(cut_all(text, pattern, 1), cut_all(text, pattern, 2))


def head_tables(statement: Column) -> Column:
    """Tables named before SET, VALUES, WHEN or the first SELECT of a write statement."""
    head = cut(statement, rf"\A({until('SET|VALUES|WHEN|WHERE|ON|' + SELECT)})")
    verbs = r"INSERT|INS|MERGE|UPDATE|UPD|DELETE|DEL|INTO|USING|FROM"
    pattern = rf"{QUOTED}|{GROUP}|(?:,|\b(?:{verbs})\s+)(?!(?:INTO|FROM|ALL)\b)\s*+({NAME}){_ALIAS}"
    return _table_structs(cut_all(head, pattern, 1), cut_all(head, pattern, 2))


def split_assignment(item: Column) -> tuple[Column, Column]:
    """``lhs = rhs`` at the first depth-0 equals sign."""
    pattern = rf"""\A((?:[^=()'"]++|{QUOTED}|{GROUP})*+)=(.*)\z"""
    return cut(item, pattern, 1), cut(item, pattern, 2)


_NAMED = rf"\A(.*\S)\s+AS\s+({IDENT})\z"
_LOOSE = r"\A(.*[\w)'\"])\s+(\"[^\"]+\"|[A-Za-z_]\w*)\z"


def with_alias_parts(items: DataFrame, needed: Column) -> DataFrame:
    """Add ``select_expr, select_name, has_alias`` of the select items in ``item``, null where
    they are not ``needed``.

    The name is the alias, or the last part of a plain column reference, or empty. Each match
    is a column of its own, as the outcome needs it several times.
    """
    item, named, loose = F.col("item"), F.col("_named"), F.col("_loose")
    matched = items.withColumn("_named", F.when(needed, cut(item, _NAMED, 2)))
    matched = matched.withColumn("_loose", F.when(named == "", cut(item, _LOOSE, 2)))
    matched = matched.withColumn("_before", F.when(loose != "", cut(item, _LOOSE, 1)))
    word_before = F.upper(F.regexp_extract("_before", r"(\w+)\z", 1))
    implicit = (
        (loose != "")
        & ~F.upper(loose).isin(_NOT_COLUMN_ALIAS)
        & ~word_before.isin(_NOT_BEFORE_ALIAS)
    )
    explicit, implicit = named != "", F.coalesce(implicit, F.lit(False))
    matched = matched.withColumn("_implicit", F.when(needed, implicit))
    implicit = F.col("_implicit")
    plain = item.rlike(rf"(?is)\A{NAME}\z")
    name = (
        F.when(explicit, F.upper(named))
        .when(implicit, F.upper(loose))
        .when(plain & ~item.rlike(r"\A\d"), F.upper(cut(item, rf"({IDENT})\z")))
        .otherwise("")
    )
    expr = F.when(explicit, cut(item, _NAMED, 1)).when(implicit, F.col("_before")).otherwise(item)
    return matched.withColumns(
        {
            "select_expr": F.when(needed, expr),
            "select_name": F.when(needed, F.replace(name, F.lit('"'), F.lit(""))),
            "has_alias": explicit | implicit,
        }
    ).drop("_named", "_loose", "_before", "_implicit")
