"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from appraise.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
"""What separates words: blank, tab, line feed, vertical tab, form feed, carriage return."""

SPACE_CHARS = " \t\n\x0b\x0c\r"

ROWS_AT_ONCE = 1000
"""Rows of a batch that ``map_batches`` hands to its function and returns at a time."""

BATCH_BYTES = 2 << 20
"""About so many bytes of rows go to a Python worker in one record batch (see ``small_batches``)."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts give an empty array."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The same words in Python, as UTF-8: ``bytes.split`` cuts at those six bytes alone, ``bytes.lower`` changes A-Z alone."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def split_words(text: str | None) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in byte_words(text)]


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table below ``spark.checkpoint.dir`` once and read it back.

    This cuts the lineage at a table that every executor can read, so a lost
    executor costs a re-read and not a recomputation.
    """
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null ids fall in fold 0)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)), F.lit(0)).cast("int")


def below(key: Column, share: Column | float, seed: int = 0) -> Column:
    """A repeatable sample: true for about ``share`` of the keys, decided by a hash of the key alone."""
    share = F.lit(share) if isinstance(share, float | int) else share
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the table has it (in any case)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def train_in_rounds(
    rows: DataFrame,
    step: Callable[[pd.DataFrame, list[np.ndarray]], list[np.ndarray]],
    init: list[np.ndarray],
    rounds: int,
    shards: int,
) -> list[np.ndarray]:
    """Iterative parameter mixing: every round each shard trains from the shared state, then states are averaged.

    ``rows`` is a bounded training sample with a column ``shard``. ``step`` gets the
    rows of one shard and the state (arrays of fixed size) and returns the new state.
    Only the states travel: shards x state size, independent of the corpus.
    """
    state = [np.asarray(a) for a in init]
    schema = "shard int, n long, " + ", ".join(f"a{i} binary" for i in range(len(state)))
    sc = rows.sparkSession.sparkContext

    def one_round(held):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            out = step(pdf, [a.copy() for a in held.value])
            row = {"shard": int(pdf["shard"].iloc[0]), "n": len(pdf)}
            row |= {f"a{i}": a.tobytes() for i, a in enumerate(out)}
            return pd.DataFrame([row])

        return rows.groupBy("shard").applyInPandas(run, schema).collect()

    for _ in range(rounds):
        held = sc.broadcast(state)
        got = one_round(held)
        if not got:
            break
        total = sum(r.n for r in got)
        got.sort(key=lambda r: r.shard)
        state = [
            sum(np.frombuffer(r[f"a{i}"], a.dtype).reshape(a.shape) * (r.n / total) for r in got).astype(a.dtype)
            for i, a in enumerate(state)
        ]
        held.unpersist()
    return state


def small_batches(spark: SparkSession) -> None:
    """Record batches for Python workers hold ``BATCH_BYTES``, unless the session has a size of its own.

    By default they hold 10,000 rows or 64 MB; executors and workers keep several copies of a batch outside the heap.
    """
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function from a record batch to the columns it sets or adds.

    Columns of ``schema`` that ``fn`` doesn't return are taken over from the batch, whatever their type. ``fn`` gets
    ``ROWS_AT_ONCE`` rows at most, so neither its Python objects nor what goes back grow with the session's batch size.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                made = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)
