"""CSV exports with a fixed column order and a header."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import schemas as S


def export_csv(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Overwrite ``path`` with the columns in order; array columns become JSON text.

    NULL and the empty text stay apart: the first is an empty field, the second ``""``. Quotes
    inside a field are doubled.
    """
    shown = [
        F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, ArrayType) else F.col(c)
        for c in columns
    ]
    (
        df.select(*shown)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssXXX")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_path(folder: str, input_file: str, layer: str) -> str:
    """``<folder>/<input stem>_<layer>``."""
    return f"{folder.rstrip('/')}/{PurePosixPath(input_file).stem}_{layer}"


def export_raw(df: DataFrame, folder: str, input_file: str) -> str:
    path = export_path(folder, input_file, "raw")
    export_csv(df, S.RAW_SCHEMA.names, path)
    return path


def export_validated(df: DataFrame, folder: str, input_file: str) -> str:
    path = export_path(folder, input_file, "validated")
    export_csv(df, S.VALIDATED_SCHEMA.names, path)
    return path


def export_kpi(df: DataFrame, folder: str, input_file: str) -> str:
    path = export_path(folder, input_file, "kpi")
    export_csv(df, S.KPI_SCHEMA.names, path)
    return path
