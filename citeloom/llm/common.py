"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows up to which a narrow side may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000

#: ASCII white space that separates words.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder. Without one, a local master gets a folder of its own and a cluster is refused."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{tempfile.gettempdir()}/checkpoints/{uuid.uuid4().hex}"
    sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialise a narrow frame in the shared checkpoint folder and drop its lineage."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder."""
    ensure_checkpoints(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def written(df: DataFrame) -> DataFrame:
    """A wide frame as a Parquet table in the shared checkpoint folder: readers take the columns that they need. Removed when the program ends."""
    spark = df.sparkSession
    path = shared_folder(spark, "table")
    df.write.parquet(path)

    def clean() -> None:
        with contextlib.suppress(Exception):  # the context may be gone
            remove(spark, path)

    atexit.register(clean)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    path = os.path.join(tempfile.mkdtemp(), f"{name}.zip")
    with open(path, "wb") as out:
        out.write(buffer.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def maybe_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint where the counted rows are within the bound."""
    return F.broadcast(df) if rows <= bound else df


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of one's own that `df` has not: the given ones, with underscores before them as needed."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and bind it in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the byte-wise path of lower()."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def trim() -> None:
    """Give memory that is free back to the system: workers live on and share an executor with its JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of text to a portion, so that a run of long texts is not worked on at once.
PORTION = 8_000_000


def portions(batch: pa.RecordBatch, rows: int, most: int = PORTION):
    """Slices of at most `rows` rows and, but for single rows, `most` bytes of the text columns."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + most, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, rows: int = 1000) -> DataFrame:
    """mapInArrow over portions of at most `rows` rows, one output batch for each."""
    ship(df.sparkSession)

    def run(batches):
        try:
            for batch in batches:
                for part in portions(batch, rows):
                    yield fn(part)
        finally:
            trim()

    return df.mapInArrow(run, schema)
