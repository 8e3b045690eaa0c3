"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import bounded, materialize

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def located(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """``docs`` with its content locator: the file and the row number in it.

    The locator is stable over recomputation and unique even for repeated
    rows. ``docs`` is a table read from parquet files, or columns or filters
    over one; anything else is written to the shared folder once.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta.getField("row_index"))
    except AnalysisException:
        docs = materialize(docs, "located")
        meta = docs.metadataColumn("_metadata")
    return docs, meta.getField("file_path"), meta.getField("row_index")


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written under a shared run folder and read back. A join of two
    such tables shuffles both sides, so Spark can split its hot keys."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_rows(docs: DataFrame, file: Column, row: Column, dropped: DataFrame) -> DataFrame:
    """``docs`` (from ``located``) without the rows whose (file, row) ``dropped`` lists; all columns stay.
    The list is written first, so it is computed once though it is counted and joined."""
    f, r = fresh(docs, "at_file"), fresh(docs, "at_row")
    gone = bounded(materialize(dropped.select(F.col("file").alias(f), F.col("row").alias(r)), "dropped"))
    return (docs.select("*", file.alias(f), row.alias(r))
            .join(gone, [f, r], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]))


def map_texts(df: DataFrame, make: Callable[[], Callable[..., list[list]]], schema: str,
              text_col: str = "text", state: tuple[str, ...] = (), keep_text: bool = False,
              slice_rows: int = 256) -> DataFrame:
    """All columns of ``df`` but ``text_col`` (unless ``keep_text``) and
    ``state``, and those of ``schema``, computed per text in Arrow batches;
    a column of ``df`` with a name of ``schema`` (in any letter case) gives way to the computed one.
    ``make()`` runs once per task and returns a function from some texts
    (strings; null gives None) and their ``state`` columns to a list of
    columns; its attribute ``close``, if any, is called at the task's end.
    Texts are handled ``slice_rows`` at a time, so Python holds only
    those.
    """
    text = F.col(f"`{text_col}`").cast("string").alias(text_col)
    added = _parse_datatype_string(schema)
    taken = {f.name.lower() for f in added}
    carried = [c for c in df.columns if c != text_col and c not in state and c.lower() not in taken]
    df = df.select(*[F.col(f"`{c}`") for c in carried], text, *state)
    keep = len(carried) + keep_text
    out = StructType(df.schema.fields[:keep] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        types = to_arrow_schema(added)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                columns = fn(*[part.column(i).to_pylist() for i in range(len(carried), part.num_columns)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(keep)]
                    + [pa.array(c, type=f.type) for c, f in zip(columns, types)],
                    names=[f.name for f in out.fields])
        if hasattr(fn, "close"):
            fn.close()

    return df.mapInArrow(run, out)
