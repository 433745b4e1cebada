"""Shared plumbing: tables, folds, durable intermediate tables and Arrow text buffers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Upper bounds of one Arrow batch sent to a Python worker; a batch holds at least one row.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20
#: Operators work through a batch in slices of about so many bytes (at least one whole text).
SLICE_BYTES = 1 << 20

#: Tables of at most so many narrow rows (ids, digests) are broadcast.
FEW = 200_000
#: A key of more than this share of a table's rows, and of more than ``COLD`` rows, is met where its rows are read; there are
#: at most the inverse of such keys.
HOT, COLD = 1 / 512, 10_000

_own_dir: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, k: int) -> Column:
    """crc32 of the id as text, modulo k."""
    return F.crc32(F.col(doc_id).cast("string")) % F.lit(k)


def few(df: DataFrame, limit: int = FEW) -> bool:
    """Whether a written table is short enough to be broadcast."""
    return df.limit(limit + 1).count() <= limit


def unique_join(rows: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` (a written table, ``key`` never null) joined to a written table that has each key once.

    Rows of hot keys are not dealt by their key: what they meet, at most one row for each hot key, is broadcast.
    """
    counts = rows.groupBy(key).count()
    hot = [x[0] for x in counts.where(F.col("count") > F.lit(max(rows.count() * HOT, COLD))).select(key).collect()]
    if not hot:
        return rows.join(unique, key, how)
    is_hot = F.col(key).isin(hot)
    return rows.where(~is_hot).join(unique.where(~is_hot), key, how).unionByName(rows.where(is_hot).join(F.broadcast(unique.where(is_hot)), key, how))


def free_name(df: DataFrame, label: str) -> str:
    """A column name that the table does not have."""
    name, taken = f"__{label}", {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's argument is not worked out anew at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where the setting is absent and the master is local (tests), a temporary folder stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_dir.setdefault("dir", tempfile.mkdtemp(prefix="lodestone-"))


_watched: list[list[Durable]] = []


@contextlib.contextmanager
def temporary():
    """Removes the tables that operators write within, once what was made of them has been written elsewhere."""
    _watched.append([])
    try:
        yield
    finally:
        for store in _watched.pop():
            store.clear()


class Durable:
    """Tables written to the shared folder, so that lineage ends there and a lost executor costs no recomputation."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/lodestone/{label}-{uuid.uuid4().hex}"
        self.n = 0
        for stores in _watched[-1:]:
            stores.append(self)

    def clear(self) -> None:
        """Removes all its tables."""
        self._delete(self.root)

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._durable_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Removes a table that ``write`` returned and nothing reads any more."""
        self._delete(df._durable_path)

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded_batches(spark: SparkSession) -> None:
    """Readies the session for Python stages.

    Bounds Arrow batches by rows and bytes, so that very long texts do not fill a worker's memory, and sends this
    package to the executors, once for each application.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_held: dict = {}


def held(key, make):
    """A large helper of a Python worker, over all its tasks; a worker holds one at most."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Frees what a worker holds from the tasks of another operator."""
    _held.clear()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without a copy; null texts are empty."""
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges (i, j) of whole texts with about ``limit`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def one_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
