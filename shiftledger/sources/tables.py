"""Names of the stored tables and readers for them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LAYERS = (
    "raw", "validated", "kpi", "validated_dedup", "batches",
    "latest", "kpi_partials", "metric_counts", "reason_counts", "upkeep",
)
# the view on top of the stored tables lives in the dataset of the build target
_TARGET_LAYERS = ("validated_dedup",)


@dataclass(frozen=True)
class TableNames:
    """Table identifiers ``<base>.<prefix>_<layer>`` or paths ``<base>/<prefix>_<layer>``.

    ``base`` holding a slash is a folder, otherwise ``catalog.schema`` or ``schema``.
    ``targets`` may give another base per build target for the deduplicated view.
    """

    base: str
    prefix: str = "shift_log"
    target: str = "dev"
    targets: tuple[tuple[str, str], ...] = ()

    def _base_of(self, layer: str) -> str:
        if layer in _TARGET_LAYERS and self.targets:
            bases = dict(self.targets)
            if self.target not in bases:
                raise ValueError(f"unknown build target: {self.target}")
            return bases[self.target]
        return self.base

    def of(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        base = self._base_of(layer)
        separator = "/" if "/" in base else "."
        return f"{base.rstrip('/')}{separator}{self.prefix}_{layer}"

    @property
    def raw(self) -> str:
        return self.of("raw")

    @property
    def validated(self) -> str:
        return self.of("validated")

    @property
    def batches(self) -> str:
        return self.of("batches")

    @property
    def kpi(self) -> str:
        return self.of("kpi")

    @property
    def validated_dedup(self) -> str:
        return self.of("validated_dedup")


def is_path(table: str) -> bool:
    return "/" in table


def table_exists(spark: SparkSession, table: str) -> bool:
    if not is_path(table):
        return spark.catalog.tableExists(table)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_table(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """Read a stored table by path or by catalog name.

    With a schema its columns come in that order, and a partition column keeps the declared
    type: without one, Spark takes run ids that look like numbers for numbers.
    """
    if not is_path(table):
        df = spark.read.table(table)
    elif schema is None:
        return spark.read.parquet(table)
    else:
        df = spark.read.schema(schema).parquet(table)
    return df if schema is None else df.select(*schema.names)
