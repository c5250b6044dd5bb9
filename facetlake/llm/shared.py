"""What the operators share: written intermediate tables, packed results, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: texts may be long, and a batch stands in memory at both ends.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def bounded(spark: SparkSession) -> None:
    """See that the session hands Python batches of BATCH_ROWS rows and about BATCH_BYTES at most; lower bounds stay.

    Plans read these settings when they run, which may be long after an operator returned, so they are not set back.
    """
    for name, most in (("Records", BATCH_ROWS), ("Bytes", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.max{name}PerBatch"
        now = spark.conf.get(name)
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, most)


def scratch(spark: SparkSession) -> str:
    """The folder that all executors share, spark.checkpoint.dir.

    Where that is unset, a local session, whose executors are this machine, takes a folder of its own; on a cluster
    there is no such folder, and an error says so.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/facetlake-scratch"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder, so that no later job computes them again."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    if _MADE:
        _MADE[-1].append(path)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def squeezed(x: np.ndarray) -> bytes:
    """An array's bytes behind their number, compressed where there are enough of them."""
    data = x.tobytes()
    head = len(data).to_bytes(8, "little")
    return head + (pa.Codec("zstd", 1).compress(data, asbytes=True) if len(data) > 128 else data)


def expanded(data: bytes, dtype) -> np.ndarray:
    """The array of squeezed()."""
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size > 128 else data[8:], dtype)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dropped(df: DataFrame) -> None:
    """Delete a table that written() made and nothing reads any more."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rsplit("/", 1)[0])


#: Folders that written() made, of each kept() that is under way, the innermost last.
_MADE: list[list[str]] = []


def kept(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows of make(), written; the tables that were written on the way there are deleted, also after a failure."""
    _MADE.append([])
    try:
        out = written(make(), name)
        own = _MADE[-1].pop()
    finally:
        for folder in _MADE.pop():
            _delete(spark, folder)
    if _MADE:
        _MADE[-1].append(own)
    return out


#: Ids, at most, that a join broadcasts (about 24 bytes each); more are shuffled.
MOST_IDS = 2_000_000


def few(ids: DataFrame) -> DataFrame:
    """Distinct ids, written, with a hint to broadcast them if they are no more than MOST_IDS."""
    ids = written(ids.distinct(), "ids")
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is not among ids (_gone); those of a null doc_id stay."""
    gone = few(ids)
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


#: Rows of one key beyond which they are spread over several tasks; and how many such keys there may be, so that their list can be broadcast.
BIG, MOST_BIG = 10_000, 50_000


def big(total: int) -> int:
    """Rows that make a key a big one: no more than MOST_BIG keys can have so many of all rows."""
    return max(BIG, total // MOST_BIG)


def salted(rows: DataFrame, sizes: DataFrame, keys: tuple[str, ...], names: tuple[str, ...], by: str, total: int) -> tuple[DataFrame, DataFrame]:
    """rows, and sizes with n, the number of rows of each key, with a column _salt to join on beside the key.

    Key columns are `keys` in rows and `names` in sizes. Rows of a big key are dealt by a hash of `by` to parts of
    their own, and its row of sizes stands in each.
    """
    parts = F.ceil(F.col("n") / big(total)).cast("int")
    heavy = sizes.filter(F.col("n") > big(total)).select(*[F.col(n).alias(f"_big{i}") for i, n in enumerate(names)], parts.alias("_parts"))
    on = [F.col(k) == F.col(f"_big{i}") for i, k in enumerate(keys)]
    rows = rows.join(F.broadcast(heavy), on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")), F.lit(0)))
    return rows.drop("_parts", *[f"_big{i}" for i in range(len(keys))]), sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int):
    """Row ranges of about `limit` bytes; a longer row stands alone."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), last)
        yield row, end
        row = end


def text_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; others, whatever their names, stay out of the operator's way."""
    bounded(docs.sparkSession)
    return docs.select(*[docs[n] for n in names])
