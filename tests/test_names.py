"""Name and value functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from weftline.functions import names as N


def apply(spark, fn, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(fn(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


def column_of(spark, fn, cases):
    """Apply ``fn`` to the first items of the cases in one job; compare with the last."""
    width = len(cases[0]) - 1
    rows = [(i, *case[:-1]) for i, case in enumerate(cases)]
    schema = "i int, " + ", ".join(f"c{k} string" for k in range(width))
    df = spark.createDataFrame(rows, schema)
    out = df.select("i", fn(*[F.col(f"c{k}") for k in range(width)]).alias("x")).collect()
    got = {r["i"]: r["x"] for r in out}
    for i, case in enumerate(cases):
        assert got[i] == case[-1], case


def test_sanitize_and_normalize(spark):
    column_of(
        spark,
        N.sanitize,
        [(None, ""), ("NaN", ""), ("a\x00b\x0bc\x1f", "abc"), ("a\tb\nc\rd", "a\tb\nc\rd"), ("", "")],
    )
    column_of(spark, N.normalize, [(" \tab\n", "AB"), (None, ""), ("nan", "")])


def test_normalize_column_keeps_null_text(spark):
    column_of(
        spark,
        N.normalize_column,
        [(w, "") for w in [None, "", "  ", "NaN", "none", "NA", "n/a", "#N/A"]]
        + [("null", "NULL"), (" customer_id ", "CUSTOMER_ID"), ("*", "*")],
    )


def test_unqualified(spark):
    column_of(
        spark,
        N.unqualified,
        [
            ("customer_id", "customer_id"),
            ("t.customer_id", "customer_id"),
            ("schema.t.customer_id", "customer_id"),
            ("db.schema.t.customer_id", "customer_id"),
            (" t.a + b ", "a + b"),
        ],
    )


@pytest.mark.parametrize("fn", [N.bare_table, N.bare_table_ident])
def test_bare_table(spark, fn):
    column_of(
        spark,
        fn,
        [
            ("$CSMIDB.P4451_CMR_MARKER", "P4451_CMR_MARKER"),
            ("${CSMIDB}.P4451_CMR_MARKER", "P4451_CMR_MARKER"),
            ("$DWDB.fact_orders", "FACT_ORDERS"),
            ("fact_orders", "FACT_ORDERS"),
            ("db.schema.fact_orders", "FACT_ORDERS"),
            ('"DWDB"."fact_orders"', "FACT_ORDERS"),
            ("  P4451_CMR_MARKER  ", "P4451_CMR_MARKER"),
            ("", ""),
            (None, ""),
        ],
    )


def test_last_part(spark):
    column_of(
        spark,
        N.last_part,
        [("a.b", "B"), ("a.b.", "B"), ('"a"."b c"', "B C"), ("...", ""), ("", ""), ("a..b", "B")],
    )


def test_tables_match(spark):
    column_of(
        spark,
        N.tables_match,
        [
            ("$CSMIDB.P4451_CMR_MARKER", "P4451_CMR_MARKER", True),
            ("DWDB.fact_orders", "fact_orders", True),
            ('"fact_orders"', "fact_orders", True),
            ("", "fact_orders", False),
            ("", "", False),
            ("a.x", "a.y", False),
        ],
    )


def test_literals(spark):
    both = [
        ("'NO'", True),
        ("99", True),
        ("-1.5", True),
        ("current_date", True),
        ("NULL", True),
        ("a", False),
        ("t.a", False),
        ("'a' || x || 'b'", True),
        ("f('a')", False),
    ]
    column_of(spark, N.is_literal, both + [("+5", True), ("DATE", False), ("CAST('x' AS DATE)", False)])
    column_of(
        spark, N.is_literal_wide, both + [("+5", False), ("DATE", True), ("CAST('x' AS DATE)", True)]
    )


def test_passthrough(spark):
    column_of(
        spark,
        N.is_passthrough,
        [
            ("t.a", "A", "T", True),
            ("t.a", "A", "S", False),
            ("a", "A", "S", True),
            ("t.a", "A", "", True),
            ("db.t.a", "s.A", "T", True),
            ("t.a + 1", "A", "T", False),
        ],
    )
    column_of(
        spark,
        N.is_passthrough_ident,
        [
            ("t.customer_Id", "CUSTOMER_ID", "T", True),
            ("s.customer_id", "CUSTOMER_ID", "T", False),
            ("customer_id", "CUSTOMER_ID", "T", True),
            ("s.customer_id", "CUSTOMER_ID", "", True),
            ("customer_id + 0", "CUSTOMER_ID", "", False),
        ],
    )


def test_clean_logic(spark):
    column_of(
        spark,
        N.clean_logic,
        [
            ("COALESCE( a ,b )  AS  out", "t.OUT", "COALESCE(a, b)"),
            ("a\n +  b", "x", "a + b"),
            ("a AS other", "x", "a AS other"),
            ('a AS "x"', "x", "a"),
            ("TRANSFORM_NOT_FOUND", "x", "TRANSFORM_NOT_FOUND"),
            ("CAST(a AS x)", "x", "CAST(a AS x)"),
            (None, "x", ""),
        ],
    )


def test_references(spark):
    refs = apply(spark, N.qualified_refs, 'COALESCE(db.t.a, "s" . b, c)')
    assert [(r["q"], r["c"]) for r in refs] == [("T", "A"), ("S", "B")]
    assert apply(spark, N.qualifier_set, "f(db.t.a, t.b, 1.5)") == ["DB", "T"]
    assert apply(spark, N.leading_qualifier, " t.a + s.b") == "T"
    assert apply(spark, N.leading_qualifier, "f(t.a)") == ""


def test_has_word(spark):
    column_of(
        spark,
        lambda text, word: N.has_word(N.words(text), text, word),
        [
            ("customer_id + 1", "ID", False),
            ("id + 1", "ID", True),
            ("f(a$b)", "A$B", True),
            ("my col", "MY COL", True),
            ("x", "Y", False),
        ],
    )
