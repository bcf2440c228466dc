"""Tables of an engine: canonical Parquet folders, or frames given by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeloom.sources.schemas import SCHEMAS


class Tables:
    """Canonical tables by name, each read once when first asked for."""

    def __init__(self, spark: SparkSession, root: str | None = None, frames: dict[str, DataFrame] | None = None):
        self.spark, self.root, self.frames = spark, root, dict(frames or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            if name not in SCHEMAS:
                raise KeyError(f"no table {name!r}")
            if self.root is None:
                self.frames[name] = self.spark.createDataFrame([], SCHEMAS[name])
            else:
                self.frames[name] = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")
        return self.frames[name]

    def register(self, prefix: str = "") -> None:
        """Temporary views of all tables, for SQL."""
        for name in {*SCHEMAS, *self.frames}:
            self[name].createOrReplaceTempView(prefix + name)


def read_json(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Records of an entity from JSON lines, under its canonical schema."""
    return spark.read.schema(SCHEMAS[table]).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; text other than ASCII stays as it is, nulls are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_tables(tables: Tables, root: str, names: list[str] | None = None) -> None:
    """Canonical Parquet folders; bridges are laid out by the key that they are asked for."""
    for name in names or list(SCHEMAS):
        df = tables[name]
        first = df.columns[0]
        df.sortWithinPartitions(first).write.mode("overwrite").parquet(f"{root}/{name}")
