"""Test inputs derived from the given tables: SQL statements from ``part``, edges from ``orders``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(template: str, **parts: Column) -> Column:
    """Fill ``{X}`` places of a template with columns."""
    pieces, rest = [], template
    while rest:
        places = [(rest.find("{" + k + "}"), k) for k in parts if "{" + k + "}" in rest]
        if not places:
            pieces.append(F.lit(rest))
            break
        at, key = min(places)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(parts[key])
        rest = rest[at + len(key) + 2 :]
    return F.concat(*pieces)


TEMPLATES = [
    "INSERT INTO $DWDB.TGT_{T} (CA, CB, CC) SELECT s.XA, COALESCE(s.XB, {N}), TRIM(s.XC)"
    " FROM $STG.SRC_{S} s WHERE s.XD = {N}",
    "INSERT INTO $DWDB.TGT_{T} (CA, CB, CC) VALUES ({N}, 'N, A', CURRENT_DATE)",
    "UPDATE ${DWDB}.TGT_{T} SET CA = {N}, CB = TRIM(XB) WHERE CC = 'Y'",
    "MERGE INTO $DWDB.TGT_{T} t USING $STG.SRC_{S} s ON t.CA = s.XA"
    " WHEN MATCHED THEN UPDATE SET CB = s.XB"
    " WHEN NOT MATCHED THEN INSERT (CA, CB) VALUES (s.XA, s.XB)",
    "CREATE VOLATILE TABLE TGT_{T} AS (SELECT s.XA AS CA, SUM(s.XB) AS CB"
    " FROM $STG.SRC_{S} s GROUP BY s.XA) WITH DATA",
    "REPLACE VIEW $DWDB.TGT_{T} AS SELECT XA AS CA, XB + {N} AS CB FROM SRC_{S}",
    "DROP TABLE $DWDB.TGT_{T}",
    "SELECT s.* FROM $STG.SRC_{S} s JOIN $DWDB.TGT_{T} t ON s.XA = t.CA ORDER BY s.XB",
    "INSERT INTO $DWDB.TGT_{T} (CA, CB) SELECT XA, 'Y' FROM SRC_{S}"
    " UNION ALL SELECT XC, 'N' FROM SRC_{S}",
    "SELECT (XA FROM SRC_{S}",
]


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statement per part, five to a file."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    fill = {
        "N": F.col("p_size").cast("string"),
        "T": (key % 3).cast("string"),
        "S": (key % 4).cast("string"),
    }
    body = _text(TEMPLATES[-1], **fill)
    for number in range(len(TEMPLATES) - 2, -1, -1):
        body = F.when(key % 10 == number, _text(TEMPLATES[number], **fill)).otherwise(body)
    return part.select(
        key.alias("k"),
        ((key - key % 5) / 5).cast("bigint").alias("file_no"),
        (key % 5).cast("int").alias("stmt_no"),
        F.concat(
            F.lit("/* "),
            F.col("p_name"),
            F.lit("; "),
            F.col("p_type"),
            F.lit(" */ "),
            body,
            F.lit(" -- "),
            F.col("p_brand"),
        ).alias("stmt"),
    )


def sql_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(parent, sql_text)``: a file is its five statements in order.

    The separator starts on its own line, else the line comment would swallow it.
    """
    ordered = F.array_sort(F.collect_list(F.struct("stmt_no", "stmt")))
    return (
        statements(spark, sf_dir)
        .groupBy("file_no")
        .agg(F.array_join(F.transform(ordered, lambda x: x["stmt"]), "\n;\n").alias("sql_text"))
        .select(
            F.concat(F.lit("jobs/f"), F.col("file_no").cast("string"), F.lit(".sql")).alias(
                "parent"
            ),
            "sql_text",
        )
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def pick(modulus: int, values: list[str]) -> Column:
        column = F.lit(values[-1])
        for number in range(len(values) - 2, -1, -1):
            column = F.when(key % modulus == number, values[number]).otherwise(column)
        return column

    return orders.select(
        key.alias("row_id"),
        F.concat(F.lit("DB.SRC_"), (key % 4).cast("string")).alias("source_table"),
        pick(
            11, ["XA", "XB", "s.XC", "XD", "xa", "NULL", "", "STATIC VALUE", "*", "n/a", "XB"]
        ).alias("source_column"),
        F.concat(F.lit("$DWDB.TGT_"), (key % 3).cast("string")).alias("target_table"),
        pick(
            13, ["CA", "CB", "CC", "ca", "", "NULL", "*", "CD", "CA", "CB", "", "CB"]
        ).alias("target_column"),
        F.when(F.col("o_orderstatus") == "F", "READ").otherwise("WRITE").alias("relation"),
        F.concat(
            F.lit("jobs/f"), ((cust - cust % 3) / 3).cast("bigint").cast("string"), F.lit(".sql")
        ).alias("parent"),
        F.lit("FILE").alias("parent_type"),
    )


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared one; a local master may have none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.conf.get("spark.master", "local").startswith("local"):
        folder = tempfile.mkdtemp(prefix="weftline-input-")
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broken_edges(spark: SparkSession, sf_dir: str) -> str:
    """Folder of CSV files with all edges in order and, between them, records that have a cell
    too many, and records that end early."""
    edge, key = edges(spark, sf_dir), F.col("row_id")
    cells = [c for c in edge.columns if c != "row_id"]
    whole = F.concat_ws(",", *cells)
    more = F.when(key % 16 == 5, F.concat_ws(",", whole, key.cast("string"))).when(
        key % 16 == 9, F.concat_ws(",", *cells[:4])
    )
    lines = F.array_compact(F.array(more, whole))
    # A writer with one column and no quotes gives lines as they are, each file with a header.
    rows = edge.orderBy("row_id").select(F.explode(lines).alias(",".join(cells)))
    path = new_folder(spark, "broken-edges")
    rows.write.csv(path, header=True, sep="\u0001", quote="\u0000")
    return path


# Statements that the ten templates above lack: (SQL, edge, outcomes of the ``rows`` rules,
# outcome of the ``concat`` rules). An edge is (source table, source column, target table,
# target column, relation); the SQL None stands for an edge without a file name.
_DEEP = "f(" * 100 + "s.XA" + ")" * 100
_SRC = ("SRC", "XA", "TGT", "CA", "WRITE")
WIDE = [
    ("UPDATE TGT SET CA = o.XA FROM SRC s, OTHER o", _SRC, ["TRANSFORM_NOT_FOUND"], "o.XA"),
    ("UPDATE TGT SET CA = s.XA + {N} FROM SRC s", _SRC, ["s.XA + {N}"], "s.XA + {N}"),
    (
        "INSERT INTO TGT (CA) SELECT o.XA FROM (SRC s JOIN OTHER o ON s.K = o.K)",
        _SRC, ["TRANSFORM_NOT_FOUND"], "o.XA",
    ),
    (
        "INSERT INTO TGT (CA) SELECT s.XA AS CB FROM SRC s",
        ("SRC", "XA", "TGT", "CB", "WRITE"), ["DIRECT_PASS_THROUGH"], "Direct pass through",
    ),
    (
        "INSERT INTO TGT (CA) (SELECT s.XA FROM SRC s) UNION ALL (SELECT s.XA * {N} FROM SRC s)",
        _SRC, ["DIRECT_PASS_THROUGH", "s.XA * {N}"], "Direct pass through",
    ),
    (f"INSERT INTO TGT (CA) SELECT {_DEEP} FROM SRC s", _SRC, [_DEEP], _DEEP),
    (
        "CREATE" + " " * 210 + "MULTISET VOLATILE TABLE TGT AS (SELECT s.XA + {N} AS CA FROM SRC s) WITH DATA",
        _SRC, ["s.XA + {N}"], "s.XA + {N}",
    ),
    (
        "INSERT INTO TGT (CA) VALUES ('a'), ('b')",
        ("SRC", "STATIC VALUE", "TGT", "CA", "WRITE"), ["'a'", "'b'"], "'a'",
    ),
    (
        "DELETE FROM TGT WHERE CA = {N}",
        ("SRC", "*", "TGT", "CA", "WRITE"),
        ["Wildcard SELECT * - all source columns"], "Wildcard DELETE — affects all rows",
    ),
    (
        "SELECT * FROM SRC",
        ("SRC", "*", "TGT", "CA", "WRITE"),
        ["Wildcard SELECT * - all source columns"], "Wildcard SELECT * — all source columns",
    ),
    (
        "SELECT s.XA FROM SRC s WHERE s.XB > CURRENT_DATE",
        ("SRC", "CURRENT_DATE", "TGT", "", "READ"),
        ["Read in WHERE filter: WHERE s.XB > CURRENT_DATE"],
        "Read column 'CURRENT_DATE' (context not extracted)",
    ),
    ("GRANT SELECT ON TGT TO PUBLIC", _SRC, ["PARSE_FAILED"], "PARSE_FAILED"),
    (
        "UPDATE TGT SET CB = {N};\n" * 510 + "UPDATE TGT SET CA = s.XA - {N} FROM SRC s",
        _SRC, ["s.XA - {N}"], "s.XA - {N}",
    ),
    (
        "WITH c AS (SELECT s.XA AS Y FROM SRC s) INSERT INTO TGT (CA) SELECT c.Y FROM c",
        _SRC, ["DIRECT_PASS_THROUGH"], "c.Y",
    ),
    (
        "WITH c AS (SELECT s.XA + {N} AS Y FROM SRC s) UPDATE TGT SET CA = c.Y FROM c",
        _SRC, ["TRANSFORM_NOT_FOUND"], "c.Y",
    ),
    (
        "WITH b AS (SELECT s.K FROM SRC s), c (Y) AS (SELECT b.K * {N} FROM b)"
        " MERGE INTO TGT t USING c ON t.K = c.Y WHEN MATCHED THEN UPDATE SET CA = c.Y",
        _SRC, ["TRANSFORM_NOT_FOUND"], "c.Y",
    ),
    (
        "INSERT INTO TGT (CA) WITH c AS (SELECT s.XA AS Y FROM SRC s) SELECT c.Y FROM c",
        _SRC, ["DIRECT_PASS_THROUGH"], "c.Y",
    ),
    (
        "INSERT INTO TGT (CA) SELECT d.Y FROM (SELECT s.XA * {N} AS Y FROM SRC s) d",
        _SRC, ["s.XA * {N}"], "d.Y",
    ),
    (
        "CREATE VOLATILE TABLE TGT AS (SELECT d.Y AS CA FROM (SELECT e.Z AS Y FROM"
        " (SELECT s.XA AS Z FROM SRC s) e) d) WITH DATA",
        _SRC, ["DIRECT_PASS_THROUGH"], "d.Y",
    ),
    (None, ("SRC", "XA", "TGT{K}", "CA", "WRITE"), ["PROCESSING_ERROR"], "TRANSFORM_NOT_FOUND"),
]


# Statements with scopes: (SQL, the tables that each named scope and the statement read).
SCOPES = [
    (
        "WITH a AS (SELECT x FROM DB.T1), b AS (SELECT x FROM a JOIN T{N} z ON a.x = z.x)"
        " INSERT INTO TGT (CA) SELECT x FROM b UNION ALL SELECT y FROM T3",
        {"A": ["T1"], "B": ["T1", "T{N}"], "": ["T1", "T{N}", "T3"]},
    ),
    (
        "INSERT INTO TGT (CA) WITH RECURSIVE r (n) AS (SELECT n FROM SEED{N} UNION ALL SELECT r.n + 1"
        " FROM r, STEPS) SELECT n FROM r WHERE n IN (SELECT k FROM KEYS k)",
        {"R": ["SEED{N}", "STEPS"], "": ["SEED{N}", "STEPS", "KEYS"]},
    ),
    (
        "CREATE TABLE TGT AS (SELECT d.v FROM (SELECT max(e.v) v FROM (SELECT v FROM DEEP{N}) AS e) d"
        " LEFT JOIN SIDE s ON d.v = s.v) WITH DATA",
        {"E": ["DEEP{N}"], "D": ["DEEP{N}"], "": ["DEEP{N}", "SIDE"]},
    ),
    (
        # The inner name hides the outer one of the same name.
        "SELECT * FROM c, (WITH c AS (SELECT v FROM IN{N}) SELECT v FROM c) q",
        {"C": ["IN{N}"], "Q": ["IN{N}"], "": ["C", "IN{N}"]},
    ),
    (
        "WITH c AS (SELECT s.k FROM SRC{N} s) MERGE INTO TGT t USING c ON t.k = c.k"
        " WHEN MATCHED THEN UPDATE SET CA = (SELECT min(v) FROM MINS)",
        {"C": ["SRC{N}"], "": ["SRC{N}", "MINS"]},
    ),
    ("UPDATE TGT SET CA = s.v FROM (SELECT v FROM U{N} WHERE note = '(SELECT 1 FROM no)') s", {"S": ["U{N}"], "": ["U{N}"]}),
    ("DELETE FROM TGT WHERE k = {N}", {}),
]


def scope_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per part, a statement of ``SCOPES`` each."""
    part = table(spark, sf_dir, "part")
    sql = F.lit("")
    for number, (text, _) in enumerate(SCOPES):
        filled = _text(text, N=F.col("p_size").cast("string"))
        sql = F.when(F.col("p_partkey") % len(SCOPES) == number, filled).otherwise(sql)
    return part.select(F.col("p_partkey").cast("string").alias("parent"), sql.alias("sql_text"))


def _wide(spark: SparkSession, sf_dir: str, value) -> tuple[DataFrame, Column]:
    """Parts, and a column with ``value(case)`` of each part's case."""
    part = table(spark, sf_dir, "part")
    column = F.lit(None).cast("string")
    for number, case in enumerate(WIDE):
        text = value(case)
        if text is not None:
            fill = {"N": F.col("p_size").cast("string"), "K": F.col("p_partkey").cast("string")}
            filled = _text(text, **fill) if text else F.lit("")
            column = F.when(F.col("p_partkey") % len(WIDE) == number, filled).otherwise(column)
    return part, column


def _wide_parent() -> Column:
    return F.concat(F.lit("wide/f"), F.col("p_partkey").cast("string"), F.lit(".sql"))


def wide_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, sql = _wide(spark, sf_dir, lambda case: case[0])
    files = part.select(_wide_parent().alias("parent"), sql.alias("sql_text"))
    return files.where("sql_text IS NOT NULL")


def wide_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["source_table", "source_column", "target_table", "target_column", "relation"]
    columns = []
    for k, name in enumerate(names):
        part, column = _wide(spark, sf_dir, lambda case, k=k: case[1][k])
        columns.append(column.alias(name))
    _, sql = _wide(spark, sf_dir, lambda case: case[0])
    parent = F.when(sql.isNotNull(), _wide_parent()).otherwise("")
    return part.select(
        F.col("p_partkey").alias("row_id"),
        *columns,
        parent.alias("parent"),
        F.lit("FILE").alias("parent_type"),
    )
