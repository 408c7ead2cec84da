"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import checkpoint_dir, configure

# Bytes of a text as bytes of its words: A-Z lower-cased, 0-9, a-z and every
# byte of a non-ASCII character kept, all other bytes turned into a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Rows, and bytes (about), in one Arrow batch handed to Python: whichever comes first.
ARROW_ROWS, ARROW_BYTES = 1024, 2 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: those of the library, and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def give_back() -> None:
    """Return the memory that Arrow keeps in reserve. A Python worker outlives its tasks, and what it
    holds between them counts against its executor."""
    pa.default_memory_pool().release_unused()


#: Folders made inside the open ``collected`` blocks, the innermost last.
_COLLECTED: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a table or files of one run, below the shared ``spark.checkpoint.dir``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    for folders in _COLLECTED:
        folders.append(path)
    return path


@contextmanager
def collected() -> Iterator[list[str]]:
    """The scratch folders that are made inside the block, for ``remove`` once nothing reads them any more."""
    folders: list[str] = []
    _COLLECTED.append(folders)
    try:
        yield folders
    finally:
        _COLLECTED.pop()  # blocks end in the order in which they are nested


def remove(spark: SparkSession, folders: list[str], but: list[str] | None = None) -> None:
    """Delete scratch folders, except those under ``but``."""
    for folder in folders:
        if folder not in (but or []):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: what follows does not compute it again,
    and an executor that is lost takes nothing of it along."""
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``cut``, with the folder of the table."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text; none for null."""
    return text.translate(WORD_BYTES).split() if text else []


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding them."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def annotate(df: DataFrame, text: str | Column, fn, schema: str) -> DataFrame:
    """Run ``fn(batches of texts) -> batches of results`` beside the rows of ``df``.

    ``fn`` gets an iterator of Arrow batches with the one column ``text`` and
    yields a batch of as many rows with the columns of ``schema``. The result
    has the columns ``row`` (the whole input row, whatever its column names)
    and those of ``schema``.
    """
    import pyspark.sql.types as T
    rows = df.select(F.struct("*").alias("row"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    out = T.StructType([rows.schema["row"], *T._parse_datatype_string(schema).fields])

    def run(batches):
        kept = []

        def only_text():
            for b in batches:
                if b.num_rows:
                    kept.append(b.column("row"))
                    yield b.select(["text"])

        for r in fn(only_text()):
            row = kept.pop(0)
            yield pa.RecordBatch.from_arrays([row, *r.columns], names=["row", *r.schema.names])
        give_back()

    return rows.mapInArrow(run, out)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Sortable identity of a document row: by ``doc_id`` (null last), then by its text. Rows that agree in
    both are repeated rows, which every operator treats alike."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"),
                    F.xxhash64(F.lit(17), F.col(text)).alias("t"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of uint64 values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
