"""Reading lineage CSVs and SQL files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CSV_NA_VALUES, EDGE_COLUMNS, ROW_ERROR, Profile, get_profile
from ..operators.edges import check_columns


_QUOTED_CELL = r'"(?:[^"]|"")*+"'
_RECORD = "_edge_record"


def needs_multi_line(spark: SparkSession, path: str) -> bool:
    """Whether some quoted cell of the CSV files goes on over a line's end.

    Then, and only then, a line has an odd number of quotes. Stops at the first one found.
    """
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).where(quotes % 2 == 1).head(1))


def record_error(record: Column, width: int) -> Column:
    """Why a CSV record is no edge, else null: it has more cells than the header's ``width``,
    or a quote that never closes.

    ``record`` is the text of a record that does not have the header's cells. Missing cells at
    its end are empty cells and no error.
    """
    plain = F.regexp_replace(record, _QUOTED_CELL, "")
    commas = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    code = F.when(plain.contains('"'), "OPEN_QUOTE").when(commas >= width, "TOO_MANY_CELLS")
    return F.when(code.isNotNull(), F.concat(code, F.lit(": "), F.make_valid_utf8(record)))


def read_edges(
    spark: SparkSession,
    path: str,
    profile: str | Profile = "rows",
    multi_line: bool | None = None,
) -> DataFrame:
    """Lineage edges from CSV: the seven columns as strings, the text ``NULL`` kept,
    ``row_id``, which sorts as the rows stand in the files, and ``row_error``.

    For ``concat`` the NA words become null. A record that cannot be read keeps the cells
    that it has and says why in ``row_error`` (:func:`record_error`). ``multi_line`` allows
    line breaks in quoted cells, for which a file is one task; by default that is so only for
    files that have some, and other files are split among tasks.
    """
    if multi_line is None:
        multi_line = needs_multi_line(spark, path)
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    names = check_columns(spark.read.csv(path, inferSchema=False, **options)).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, _RECORD])
    # A reader that prunes columns does not see how many cells a record has.
    reader = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", _RECORD)
    raw = reader.csv(path, schema=schema, mode="PERMISSIVE", **options)
    # Rows of one split are numbered in order; the split's file and start come first.
    number = F.monotonically_increasing_id().cast("string")
    row_id = F.concat_ws(
        "|",
        F.col("_metadata.file_path"),
        F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
        F.lpad(number, 20, "0"),
    )
    error = record_error(F.col(_RECORD), len(names)).alias(ROW_ERROR)
    edges = raw.select(row_id.alias("row_id"), *EDGE_COLUMNS, error)
    if get_profile(profile).multi_row:
        return edges
    kept = {c: F.when(~F.col(c).isin(CSV_NA_VALUES), F.col(c)) for c in EDGE_COLUMNS}
    return edges.withColumns(kept)


def _local_path(uri: Column) -> Column:
    """Path part of a file URI, decoded; a plus sign is not an escaped blank here."""
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def base_prefix(base_dir: str) -> str:
    path = base_dir
    if "://" in path:
        path = "/" + path.split("://", 1)[1].partition("/")[2]
    elif path.startswith("file:"):
        path = path[len("file:") :]
    return path.rstrip("/") + "/"


def tidy_path(path: Column) -> Column:
    """A path without ``//``, ``.`` and ``..`` parts, as far as these can be resolved."""
    plain = F.regexp_replace(F.regexp_replace(path, r"/(?:\./)+", "/"), r"^(?:\./)+", "")
    plain = F.regexp_replace(plain, r"(?<!^)//+", "/")
    ups = F.size(F.regexp_extract_all(plain, F.lit(r"(\.\.)"), F.lit(1)))
    up_one = r"(?<=^|/)(?!\.\./)[^/]+/\.\.(?:/|$)"
    resolved = F.aggregate(
        F.sequence(F.lit(1), F.greatest(ups, F.lit(1))),
        plain,
        lambda acc, _: F.regexp_replace(F.regexp_replace(acc, up_one, ""), r"^(?:/\.\.)+(?=/)", ""),
    )
    return F.when(plain.contains(".."), resolved).otherwise(plain)


def resolve_parent(parent: Column, base_dir: str) -> Column:
    """Key of a parent's file: its path below the base directory, or its absolute path if it
    lies elsewhere. Relative paths start at the base directory."""
    prefix = base_prefix(base_dir)
    relative = ~parent.startswith("/") & (parent != "")
    path = tidy_path(F.when(relative, F.concat(F.lit(prefix), parent)).otherwise(parent))
    inside = F.substring(path, len(prefix) + 1, 2_147_483_647)
    return F.when(path.startswith(prefix), inside).otherwise(path)


def _texts(files: DataFrame, base_dir: str, drop_bad_utf8: bool) -> DataFrame:
    text = F.make_valid_utf8("value")
    if drop_bad_utf8:
        text = F.replace(text, F.lit("\ufffd"), F.lit(""))
    return files.select(
        resolve_parent(_local_path(F.col("_metadata.file_path")), base_dir).alias("parent"),
        text.alias("sql_text"),
    )


def read_sql_files(spark: SparkSession, base_dir: str, drop_bad_utf8: bool = True) -> DataFrame:
    """``(parent, sql_text)``, one row per file below ``base_dir``, whole text.

    Bytes that are not UTF-8 are dropped, or kept as U+FFFD.
    """
    files = spark.read.text(base_dir, wholetext=True, recursiveFileLookup=True)
    return _texts(files, base_dir, drop_bad_utf8)


def read_named_sql_files(
    spark: SparkSession, keys: DataFrame, base_dir: str, drop_bad_utf8: bool = True
) -> DataFrame:
    """As :func:`read_sql_files`, but only the files whose key (:func:`resolve_parent`) is in
    ``keys`` (one column ``parent``), also those outside the base directory.

    Files are listed without their contents, and the names of the wanted ones go to Spark's
    own file index, which holds the names of all files that it reads in any case.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base_dir)
        .select("path", resolve_parent(_local_path(F.col("path")), base_dir).alias("parent"))
    )
    wanted = keys.where("parent <> ''").distinct()
    paths = [r["path"] for r in listing.join(wanted, "parent", "left_semi").select("path").toLocalIterator()]
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind, marked, rest = base_dir.partition("://")
    scheme = f"{kind}://{rest.partition('/')[0]}" if marked else "file://"
    for row in wanted.where("startswith(parent, '/')").toLocalIterator():
        path = hadoop.Path(scheme + row["parent"])
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(path) and system.getFileStatus(path).isFile():
            paths.append(path.toString())
    if not paths:
        return spark.createDataFrame([], "parent string, sql_text string")
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    return _texts(spark.read.text(literal, wholetext=True), base_dir, drop_bad_utf8)
