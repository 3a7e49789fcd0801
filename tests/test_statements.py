"""Comments, splitting, catalog and statement contents."""

from pyspark.sql import functions as F

from weftline.constants import ROWS
from weftline.functions import shape as S
from weftline.operators import scopes as SC
from weftline.operators import shapes as SH
from weftline.operators import statements as ST


def files(spark, *texts):
    return spark.createDataFrame(
        [(f"f{i}.sql", t) for i, t in enumerate(texts)], "parent string, sql_text string"
    )


def catalog(spark, *texts, profile="rows"):
    rows = ST.statement_catalog(files(spark, *texts), profile).orderBy("parent", "stmt_no")
    return rows.collect()


def parsed(spark, *texts):
    return SH.parse_statements(ST.statement_catalog(files(spark, *texts)))


def assigned(spark, text):
    rows = SH.assignments(parsed(spark, text)).orderBy("stmt_no", "unit_no", "ord").collect()
    return [(r["clause"], r["branch_no"], r["target_col"], r["expr"]) for r in rows]


def test_comment_order_and_filler(spark):
    df = files(spark, "a /* -- */ b", "x--/*\ny*/z", "p/* ** / */q")
    rows = df.select(
        ST.strip_comments(F.col("sql_text"), "rows").alias("r"),
        ST.strip_comments(F.col("sql_text"), "concat").alias("c"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("a   b", "a /* "),
        ("x ", "x\ny*/z"),
        ("p q", "pq"),
    ]


def test_long_comment_and_unclosed_comment(spark):
    body = "/*" + " * x" * 60_000 + " */ SELECT a FROM t"
    rows = catalog(spark, body, "SELECT a /* open")
    assert rows[0]["sql_query"] == "SELECT a FROM t"
    assert rows[1]["sql_query"] == "SELECT a /* open"


def test_semicolon_in_quotes_still_splits(spark):
    rows = catalog(spark, "SELECT 'a;b' AS x FROM t; ;; SELECT 1 AS y FROM u;")
    assert [(r["stmt_no"], r["parse_error"]) for r in rows] == [
        (0, "UNBALANCED"),
        (1, "UNBALANCED"),
        (2, ""),
    ]


def test_all_statements_of_any_size(spark):
    many = ";".join(f"SELECT {i} AS a FROM t" for i in range(700))
    wide = "SELECT " + ", ".join(f"f(x{i}, 'a,b') AS c{i}" for i in range(16_000)) + " FROM t"
    rows = catalog(spark, many, "SELECT '" + "x" * 300_000 + "' AS a FROM t", wide)
    assert sum(r["parent"] == "f0.sql" for r in rows) == 700
    assert len(wide) > 300_000 and {r["parse_status"] for r in rows} == {"OK"}


def test_any_depth(spark):
    calls = "SELECT " + "f(" * 100 + "a, '()'" + ")" * 100 + " AS c FROM t"
    selects = "SELECT c FROM (" * 40 + "SELECT g(x, '(') AS deepest FROM t" + ") q" * 40
    rows = SH.assignments(SH.parse_statements(ST.statement_catalog(files(spark, calls, selects)))).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["parent"], []).append((r["target_col"], r["expr"]))
    assert by_file["f0.sql"] == [("C", "f(" * 100 + "a, '()'" + ")" * 100)]
    assert ("DEEPEST", "g(x, '(')") in by_file["f1.sql"]
    assert len(by_file["f1.sql"]) == 41


def test_long_heads(spark):
    gap = " " * 1_000
    rows = catalog(
        spark,
        f"CREATE{gap}MULTISET{gap}VOLATILE TABLE x AS (SELECT 1 AS a) WITH DATA",
        f"{gap}MERGE{gap}INTO t USING s ON t.a = s.a WHEN MATCHED THEN UPDATE SET b = 1",
        "CREATE SET GLOBAL TEMPORARY TRACE MULTISET VOLATILE TABLE x (a INT)",
    )
    assert [r["kind"] for r in rows] == ["CTAS", "MERGE", "CTAS"]
    assert [r["parse_error"] for r in rows] == ["", "", "CREATE_NO_SELECT_SKIPPED"]


def test_empty_file_keeps_a_placeholder(spark):
    rows = catalog(spark, " -- nothing\n", "")
    assert [r["parse_error"] for r in rows] == ["NO_STATEMENTS"] * 2


def test_status_codes(spark):
    cases = [
        ("DROP TABLE x", "PURE_DDL_SKIPPED"),
        ("ALTER TABLE x ADD y INT", "PURE_DDL_SKIPPED"),
        ("COLLECT STATISTICS ON x", "PURE_DDL_SKIPPED"),
        ("CREATE MULTISET TABLE x (a INT)", "PURE_DDL_SKIPPED"),
        ("CREATE MULTISET VOLATILE TABLE x (a INT)", "CREATE_NO_SELECT_SKIPPED"),
        ("DROP VIEW x", "DDL_NODE_SKIPPED"),
        ("GRANT SELECT ON x TO y", "DDL_NODE_SKIPPED"),
        ("CREATE TABLE x AS (SELECT a FROM t) WITH DATA", ""),
        ("CREATE INDEX i ON x (a)", "CREATE_NO_SELECT_SKIPPED"),
        ("SELECT (a FROM t", "UNBALANCED"),
        ("SELECT a) FROM t", "UNBALANCED"),
        ("UPDATE t WHERE a = 1", "UNSUPPORTED_STATEMENT"),
        ("INSERT INTO t (1, 2)", "UNSUPPORTED_STATEMENT"),
        ("HELLO WORLD", "UNSUPPORTED_STATEMENT"),
        ("DELETE FROM t WHERE a = 1", ""),
        ("WITH c AS (SELECT a FROM t) SELECT a FROM c", ""),
        ("MERGE INTO t USING s ON t.a = s.a", "UNSUPPORTED_STATEMENT"),
    ]
    rows = catalog(spark, ";\n".join(sql for sql, _ in cases))
    assert [(r["sql_query"], r["parse_error"]) for r in rows] == cases


def test_shell_variables(spark):
    df = files(spark, "INSERT INTO $A.t SELECT x FROM ${B}.u, $C")
    row = df.select(
        ST.shell_variables(F.col("sql_text"), "rows").alias("r"),
        ST.shell_variables(F.col("sql_text"), "concat").alias("c"),
    ).first()
    assert row["r"] == ["$A", "${B}", "$C"]
    assert row["c"] == ["$A.t", "${B}.u"]


def test_bodies(spark):
    df = files(
        spark,
        "CREATE VOLATILE TABLE x AS ( SELECT f(a) AS b FROM t ) WITH DATA ON COMMIT PRESERVE ROWS",
        "REPLACE VIEW v AS SELECT a FROM (SELECT 1 AS a) q",
        "CREATE TABLE x AS SELECT a FROM t WITH NO DATA",
        "CREATE VIEW v AS WITH c AS (SELECT a FROM t) SELECT a FROM c",
        "CREATE TABLE x (a INT)",
    )
    sql = F.col("sql_text")
    rows = df.select(ST.select_body(sql).alias("b"), ST.strip_create_prefix(sql).alias("s")).collect()
    assert [r["b"] for r in rows] == [
        "SELECT f(a) AS b FROM t",
        "SELECT a FROM (SELECT 1 AS a) q",
        "SELECT a FROM t",
        "WITH c AS (SELECT a FROM t) SELECT a FROM c",
        "",
    ]
    assert rows[1]["s"] == "SELECT a FROM (SELECT 1 AS a) q"
    assert rows[2]["s"] == "SELECT a FROM t WITH NO DATA"
    assert rows[0]["s"].startswith("CREATE VOLATILE TABLE x AS (")


def test_split_top(spark):
    df = files(spark, "a, f(b, (c, d)), 'x,y', \"q,r\"", "", "a,,b", "it('('), 'it''s, ok'")
    got = [r["x"] for r in df.select(S.split_top(F.col("sql_text")).alias("x")).collect()]
    assert got == [
        ["a", "f(b, (c, d))", "'x,y'", '"q,r"'],
        [],
        ["a", "", "b"],
        ["it('(')", "'it''s, ok'"],
    ]


def test_split_top_long_and_deep(spark):
    deep = "(" * S.MAX_DEPTH + "a,b" + ")" * S.MAX_DEPTH
    long = ", ".join(f"f(a{i}, 'x,y')" for i in range(10_000))
    df = files(spark, deep + ",c", long, deep.replace("a,b", "(a,b)"))
    rows = df.select(
        F.size(S.split_top(F.col("sql_text"))).alias("n"), S.is_balanced(F.col("sql_text")).alias("ok")
    ).collect()
    assert [(r["n"], r["ok"]) for r in rows[:2]] == [(2, True), (10_000, True)]
    assert rows[2]["ok"] is False


def test_insert_select_positions(spark):
    got = assigned(
        spark,
        "INSERT INTO $D.t (a, b) SELECT DISTINCT s.x, CASE WHEN s.y IN (1, 2) THEN 'FROM, x' ELSE s.z END AS q"
        " FROM u s WHERE s.k = (SELECT MAX(k) AS m FROM u)",
    )
    assert got == [
        ("insert_select", 0, "A", "s.x"),
        ("insert_select", 0, "B", "CASE WHEN s.y IN (1, 2) THEN 'FROM, x' ELSE s.z END"),
        ("select", 0, "M", "MAX(k)"),
    ]


def test_insert_without_columns_and_values(spark):
    assert assigned(spark, "INSERT INTO t SELECT x AS a, y FROM u") == [
        ("select", 0, "A", "x"),
        ("select", 0, "Y", "y"),
    ]
    assert assigned(spark, "INSERT INTO t (a, b) VALUES (1, 'N, A'), (f(2, 3), 'it''s')") == [
        ("values", 0, "A", "1"),
        ("values", 0, "B", "'N, A'"),
        ("values", 1, "A", "f(2, 3)"),
        ("values", 1, "B", "'it''s'"),
    ]


def test_update_takes_set_only(spark):
    got = assigned(spark, "UPDATE t FROM s SET a = s.x + 1, t.b = CASE WHEN c = 1 THEN 2 ELSE 3 END WHERE d = 5")
    assert got == [
        ("set", 0, "A", "s.x + 1"),
        ("set", 0, "B", "CASE WHEN c = 1 THEN 2 ELSE 3 END"),
    ]


def test_merge_branches(spark):
    got = assigned(
        spark,
        "MERGE INTO t USING (SELECT x AS k FROM s) q ON t.k = q.k"
        " WHEN MATCHED THEN UPDATE SET a = CASE WHEN q.z = 1 THEN 0 ELSE q.k END, b = 2"
        " WHEN NOT MATCHED THEN INSERT (a, b) VALUES (q.k, f(1, 2))",
    )
    assert got == [
        ("merge_set", 0, "A", "CASE WHEN q.z = 1 THEN 0 ELSE q.k END"),
        ("merge_set", 0, "B", "2"),
        ("merge_insert", 1, "A", "q.k"),
        ("merge_insert", 1, "B", "f(1, 2)"),
        ("select", 0, "K", "x"),
    ]


def test_unions_and_nested_selects(spark):
    got = assigned(
        spark,
        "CREATE TABLE z AS (SELECT a AS x FROM (SELECT b AS y FROM (SELECT c w FROM t) i) o"
        " UNION ALL SELECT d FROM u) WITH DATA",
    )
    assert got == [
        ("select", 0, "X", "a"),
        ("select", 1, "D", "d"),
        ("select", 0, "Y", "b"),
        ("select", 0, "W", "c"),
    ]


def test_aliases_of_items(spark):
    got = assigned(
        spark,
        "SELECT a, t.b, \"c d\", e AS f, g h, CASE WHEN i = 1 THEN 2 END, j IS NULL, k AND l, *, t.*, 'x' y,"
        " CAST(m AS INT), SUM(n) OVER (ORDER BY o) p FROM t",
    )
    assert [(t, e) for _, _, t, e in got] == [
        ("A", "a"),
        ("B", "t.b"),
        ("C D", '"c d"'),
        ("F", "e"),
        ("H", "g"),
        ("", "CASE WHEN i = 1 THEN 2 END"),
        ("", "j IS NULL"),
        ("", "k AND l"),
        ("", "*"),
        ("", "t.*"),
        ("Y", "'x'"),
        ("", "CAST(m AS INT)"),
        ("P", "SUM(n) OVER (ORDER BY o)"),
    ]


def test_tables(spark):
    rows = SH.statement_tables(
        parsed(
            spark,
            "INSERT INTO $D.t (a) SELECT 1 FROM db.u AS x, v LEFT JOIN \"W\" y ON f(x.a, v.b) = y.c"
            " JOIN (SELECT 2 FROM z zz) q ON q.a = 1 WHERE x.b IN (SELECT b FROM k)",
        )
    ).orderBy("ref_no")
    assert [(r["name"], r["alias"]) for r in rows.collect()] == [
        ("T", ""),
        ("U", "X"),
        ("V", ""),
        ("W", "Y"),
        ("Z", "ZZ"),
        ("K", ""),
    ]


def test_reads(spark):
    p = parsed(
        spark,
        "SELECT a AS x, f(b) FROM t JOIN u ON t.c = u.d WHERE e = 'GROUP BY' AND g IN (1, 2)"
        " GROUP BY h HAVING COUNT(*) > i ORDER BY j",
    )
    rows = SH.column_reads(p, SH.assignments(p)).collect()
    assert {(r["column_name"], r["shown"]) for r in rows} == {
        ("A", "Read in SELECT (aliased as X): a"),
        ("B", "Read in SELECT projection: f(b)"),
        ("C", "Read in JOIN ON condition: t.c = u.d"),
        ("D", "Read in JOIN ON condition: t.c = u.d"),
        ("E", "Read in WHERE filter: e = 'GROUP BY' AND g IN (1, 2)"),
        ("G", "Read in WHERE filter: e = 'GROUP BY' AND g IN (1, 2)"),
        ("H", "Read in GROUP BY clause"),
        ("I", "Read as input column"),
        ("J", "Read in ORDER BY clause"),
    }


def test_wildcards(spark):
    p = parsed(spark, "SELECT a, t.* FROM t; SELECT * FROM u; DELETE FROM v; SELECT COUNT(*) FROM w")
    rows = SH.wildcards(p, SH.assignments(p)).orderBy("stmt_no").collect()
    assert [r["description"] for r in rows] == [
        "Wildcard SELECT t.* — all columns from t",
        "Wildcard SELECT * — all source columns",
        "Wildcard DELETE — affects all rows",
    ]


def test_ids_are_stable_and_distinct(spark):
    text = "SELECT 1 AS a FROM t; SELECT 1 AS a FROM t"
    first, second = catalog(spark, text), catalog(spark, text, profile=ROWS)
    assert [r["query_id"] for r in first] == [r["query_id"] for r in second]
    assert len({r["query_id"] for r in first}) == 2


def test_writes_behind_with(spark):
    """Kind, target and contents are those of the write; its WITH list still counts as read."""
    with_list = "WITH a AS (SELECT 'INSERT INTO x' i FROM t), b (c) AS (SELECT i FROM a) "
    cases = [
        ("INSERT INTO db.q (k) SELECT c FROM b", "INSERT", "Q"),
        ("INS q SELECT c FROM b", "INSERT", "Q"),
        ("UPDATE q SET k = b.c FROM b", "UPDATE", "Q"),
        ("MERGE INTO q USING b ON q.k = b.c WHEN MATCHED THEN UPDATE SET k = 1", "MERGE", "Q"),
        ("DELETE FROM q WHERE k IN (SELECT c FROM b)", "DELETE", ""),
        ("SELECT c FROM b", "SELECT", ""),
    ]
    df = files(spark, ";".join(with_list + sql for sql, _, _ in cases))
    parsed = SH.parse_statements(ST.statement_catalog(df)).orderBy("stmt_no").collect()
    assert [(r["kind"], r["target_table"], r["parse_error"]) for r in parsed] == [(k, t, "") for _, k, t in cases]
    for r in parsed:
        assert {"T", "A"} <= {t["name"] for t in r["tables"]}
        assert r["sql_query"].startswith("WITH a AS")
    kinds = df.select(F.explode(F.split("sql_text", ";")).alias("q")).select(ST.statement_kind(F.col("q")))
    assert [k for (k,) in kinds.collect()] == [k for _, k, _ in cases]
    assert catalog(spark, "WITH a AS (SELECT 1) INSERT")[0]["parse_error"] == "UNSUPPORTED_STATEMENT"
    assert catalog(spark, "WITH a AS (SELECT 1")[0]["parse_error"] == "UNBALANCED"


def test_scopes(spark):
    deep = "SELECT x FROM (" * 40 + "SELECT x FROM bottom" + ") z" * 40
    df = spark.createDataFrame(
        [
            ("a", "SELECT a.x, (SELECT max(y) FROM m) AS top, f('(SELECT 1 FROM no)') FROM (t1 a JOIN"
                  " (SELECT x FROM t2) b ON a.x = b.x) WHERE EXISTS (SELECT 1 FROM t3) AND a.z IN (1, 2)"),
            ("b", deep),
            ("c", "WITH \"q q\" AS (SELECT 1 one), p AS (SELECT x FROM d.p) SELECT x FROM p, \"q q\""),
            ("d", "HELLO (SELECT 1 FROM t)"),
            ("e", None),
        ],
        "parent string, sql_text string",
    )
    found = SC.scopes(ST.statement_catalog(df))
    ids = {r["query_id"]: r["parent"] for r in ST.statement_catalog(df).collect()}
    rows = {(ids[r["query_id"]], r["scope"]): (r["kind"], r["name"], r["body"]) for r in found.collect()}
    assert {k: v[:2] for k, v in rows.items() if k[0] == "a"} == {
        ("a", "0"): ("statement", ""), ("a", "0.0"): ("named", "TOP"),
        ("a", "0.1"): ("named", "B"), ("a", "0.2"): ("nested", ""),
    }
    assert rows["a", "0.2"][2] == "SELECT 1 FROM t3"
    assert {k[0] for k in rows} == {"a", "b", "c"}
    tables = {}
    for r in SC.scope_sources(found).collect():
        tables.setdefault((ids[r["query_id"]], r["scope"]), set()).add(r["table"])
    assert tables["a", "0"] == {"M", "T1", "T2", "T3"} and tables["a", "0.1"] == {"T2"}
    assert tables["b", "0"] == {"BOTTOM"}
    # An expression that reads a table of its own name.
    assert tables["c", "0"] == {"P"} and tables["c", "0.1"] == {"P"}
    assert SC.scope_sources(found.limit(0)).count() == 0
