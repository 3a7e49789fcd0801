"""Writing the outputs, and their names."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import CONCAT_OUTPUTS, DIM_COLUMNS, FACT_COLUMNS, Profile, get_profile
from ..plans.lineage import Lineage
from ..plans.reports import labelled_counts, summarize


class OutputPaths(NamedTuple):
    fact: str
    dim: str
    summary: str
    warnings: str


def output_paths(input_csv: str, output_dir: str, profile: str | Profile = "rows") -> OutputPaths:
    """``rows`` names the outputs after the input, ``concat`` has fixed names."""
    root = output_dir.rstrip("/")
    if get_profile(profile).multi_row:
        stem = input_csv.rstrip("/").rsplit("/", 1)[-1]
        stem = stem.rsplit(".", 1)[0] if "." in stem[1:] else stem
        names = [f"{stem}_{x}" for x in ("transformation_extract", "queries_info", "summary", "logs")]
    else:
        names = CONCAT_OUTPUTS
    return OutputPaths(*[f"{root}/{n}" for n in names])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        # An empty cell and a quoted empty text are the same here; nulls do not occur.
        writer.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_fact(
    fact: DataFrame,
    path: str,
    fmt: str = "parquet",
    ordered: bool = False,
    counted: Observation | None = None,
    **kw,
) -> None:
    """Nine string columns; ``ordered`` sorts all rows back into input order. ``counted``
    gets the labelled counts of the rows while they are written."""
    rows = fact.orderBy("row_id") if ordered else fact
    rows = rows.select(*[F.col(c).cast("string") for c in FACT_COLUMNS])
    if counted is not None:
        # On top, in the tasks that write: each of them counts once, even if it is repeated.
        rows = rows.observe(counted, *labelled_counts())
    write_table(rows, path, fmt, **kw)


def write_dim(dim: DataFrame, path: str, fmt: str = "parquet", **kw) -> None:
    write_table(dim.select(*[F.col(c).cast("string") for c in DIM_COLUMNS]), path, fmt, **kw)


def write_lineage(
    result: Lineage, paths: OutputPaths, fmt: str = "parquet", ordered: bool = False, **kw
) -> None:
    """Write the four tables. The labelled counts of ``concat`` are gathered while the fact is
    written; the outcomes of ``rows``, which can be many, are summed up from what was written.
    """
    spark = result.fact.sparkSession
    if get_profile(result.profile).multi_row:
        write_fact(result.fact, paths.fact, fmt, ordered, **kw)
        if fmt == "csv":
            written = spark.read.csv(paths.fact, header=True, escape='"', multiLine=True)
        else:
            written = spark.read.format(fmt).load(paths.fact)
        summary = summarize(written.fillna("", ["transformation_logic"]), result.profile)
    else:
        counted = Observation()
        write_fact(result.fact, paths.fact, fmt, ordered, counted, **kw)
        summary = spark.createDataFrame(list(counted.get.items()), "category string, n bigint")
    write_dim(result.dim, paths.dim, fmt, **kw)
    write_table(summary, paths.summary, fmt, **kw)
    write_table(result.warnings, paths.warnings, fmt, **kw)
