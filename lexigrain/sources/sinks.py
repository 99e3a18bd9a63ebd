"""Writing result tables, frames and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat(frame: DataFrame) -> DataFrame:
    """CSV holds no nested values; they are written as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return frame.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def write_table(frame: DataFrame, path: str, fmt: str = "csv", compression: str | None = None) -> None:
    """Write a result in parallel, one file per partition."""
    writer = (_flat(frame) if fmt == "csv" else frame).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer = writer.option("header", True).option("quoteAll", False).option("escape", '"')
    writer.format(fmt).save(path)


def write_frame(frame: DataFrame, path: str) -> None:
    """Wide frames (features, predictions) go out as gzip-compressed CSV."""
    write_table(frame, path, compression="gzip")


def write_json_row(frame: DataFrame, path: str) -> None:
    frame.coalesce(1).write.mode("overwrite").text(path)
