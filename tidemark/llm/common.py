"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Digits, ASCII letters and every byte of a non-ASCII character make words; ASCII capitals are lower-cased.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only where that is unset (tests on one machine) a temporary folder is taken and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.environ.get("TIDEMARK_LOCAL_CHECKPOINT") or tempfile.mkdtemp(prefix="tidemark-")
        os.environ["TIDEMARK_LOCAL_CHECKPOINT"] = root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a written table: lineage ends here and a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[..., dict], schema: str, slice_rows: int = 256) -> DataFrame:
    """``mapInArrow`` in slices: ``fn(columns as lists by name) -> columns as lists``."""
    out_schema = pa_schema(schema)
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_held()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                cols = fn(**batch.slice(at, slice_rows).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in out_schema], schema=out_schema)
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give freed memory back, so that an idle Python worker leaves room for the JVM beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]):
    """The one large thing that a worker process keeps between tasks; another key's takes its place."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def drop_held() -> None:
    _held.clear()


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Arrow batches of at most ``rows`` rows and about ``size``, where the session has Spark's defaults for them."""
    for key, default, own in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", str(rows)), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", size)):
        if spark.conf.get(key) == default:
            spark.conf.set(key, own)


ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()),
}


def pa_schema(ddl: str) -> pa.Schema:
    return pa.schema([pa.field(n, ARROW[t]) for n, t in (x.strip().split(" ", 1) for x in ddl.split(","))])


class TokenHashes(dict):
    """64-bit hashes of words, kept for repeated words up to a bounded number."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def crc_mod(column: str, mod: int):
    """crc32 of an integer id's decimal text, modulo ``mod``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod
