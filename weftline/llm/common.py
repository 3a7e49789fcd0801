"""Helpers shared by the corpus operators: tables, the shared work folder, row identity."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder and a cluster a
    folder in its warehouse, which all executors share too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.conf.get("spark.master", "local").startswith("local"):
            folder = tempfile.mkdtemp(prefix="weftline-work-")
        else:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_weftline_work"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str = "rows") -> DataFrame:
    """Columns ``doc`` (all input columns, so that no name clashes), ``row_file`` and
    ``row_no``; the last two identify a row of a stored table."""
    columns = [
        F.struct("*").alias("doc"),
        F.xxhash64(F.col("_metadata.file_path")).alias("row_file"),
        F.col("_metadata.row_index").alias("row_no"),
    ]
    if df.inputFiles():
        try:
            return df.select(columns)
        except AnalysisException:  # more than one table
            pass
    return stored(df, name).select(columns)


#: Tables below this size are broadcast to documents, which then need no shuffle.
BROADCAST_BYTES = 48 << 20


def beside(docs: DataFrame, rows: DataFrame, size: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` of about ``size`` bytes to documents by row: broadcast if that is small,
    else by a shuffle."""
    if size <= BROADCAST_BYTES:
        rows = F.broadcast(rows)
    return docs.join(rows, ["row_file", "row_no"], how)


def marked(rows: DataFrame) -> DataFrame:
    """Rows (row_file, row_no) as words of 64 marks: (row_file, row_word, marks)."""
    mark = F.expr("shiftleft(1L, cast(row_no & 63 AS int))")
    word = F.shiftright("row_no", 6).alias("row_word")
    return rows.groupBy("row_file", word).agg(F.bit_or(mark).alias("marks"))


def only(docs: DataFrame, rows: DataFrame, name: str = "marks", shuffle: bool = True) -> DataFrame:
    """The documents whose row is one of ``rows``, with their columns. The rows are broadcast as
    marks, at most one word of 64 for each 64 rows of a file. Where even that is too large,
    documents meet the rows by a shuffle, or, without ``shuffle``, all stay."""
    words = stored(marked(rows), name)
    if 40 * words.count() > BROADCAST_BYTES:
        moved = docs.join(rows, ["row_file", "row_no"], "left_semi").select(*docs.columns)
        return moved if shuffle else docs
    found = docs.withColumn("row_word", F.shiftright("row_no", 6)).join(
        F.broadcast(words), ["row_file", "row_word"]
    )
    marked_here = F.expr("shiftrightunsigned(marks, cast(row_no & 63 AS int)) & 1L = 1L")
    return found.where(marked_here).select(*docs.columns)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    pieces = F.array_remove(F.split(text, BLANKS), "")
    return F.coalesce(F.size(pieces), F.lit(0)).cast("long")


def ship(module: str) -> None:
    """Send the module's functions to Python workers by value, so that executors need no copy
    of this package on their path."""
    register_pickle_by_value(sys.modules[module])


ship(__name__)
