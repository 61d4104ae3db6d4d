"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word borders of the contracts: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES, SPARKS_OWN = "2m", "67108864b"


def remainder(key: Column, divisor: int) -> Column:
    """``crc32`` of the key as text, modulo ``divisor``; null where the key is null."""
    return F.crc32(key.cast("string").cast("binary")) % divisor


def sampled(key: Column, bound: Column | int, total: Column | int) -> Column:
    """Whether a row falls into a sample of about ``bound`` of ``total`` rows, by hash of the key."""
    width = 1 << 40
    share = F.least(F.lit(1.0), F.lit(bound) / F.lit(total))
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(width)) < share * width


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands texts to Python in batches of two megabytes.

    Several copies of a batch are in memory at a time, outside the heap and in each worker, so
    Spark's own bound of 64 MB takes most of what a small executor has. A bound that the session
    names itself stays.
    """
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(name, SPARKS_OWN) == SPARKS_OWN:
        conf.set(name, BATCH_BYTES)
    return df


def map_texts(
    df: DataFrame, text_col: str, fields: T.StructType, fn: Callable[[list], Iterable[tuple]]
) -> DataFrame:
    """``df`` with the columns of ``fields``, made by ``fn`` from the texts of a batch.

    ``fn`` takes a list of texts (null: ``None``) and gives a tuple for each. A column of ``df``
    that has the name of a new one is replaced. Whole rows go through, in their order.
    """
    new = set(fields.fieldNames())
    kept = [f for f in df.schema.fields if f.name not in new]
    place, texts = [df.columns.index(f.name) for f in kept], df.columns.index(text_col)
    types = [arrow_type(f.dataType) for f in fields]
    names = [f.name for f in kept] + fields.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*fn(batch.column(texts).to_pylist()), strict=True)) or [[] for _ in types]
            arrays = [pa.array(v, t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in place] + arrays, names=names)

    return small_batches(df).mapInArrow(run, T.StructType([*kept, *fields.fields]))


def filter_texts(df: DataFrame, text_col: str, test: Callable[[list], Iterable[bool]]) -> DataFrame:
    """The rows of ``df`` whose text passes ``test``, which takes and gives a list. No column is added,
    so none can clash."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(list(test(batch.column(at).to_pylist())), pa.bool_()))

    return small_batches(df).mapInArrow(run, df.schema)


def replace_texts(df: DataFrame, text_col: str, make: Callable[[list], Iterable[str | None]]) -> DataFrame:
    """``df`` with other texts, in the same columns."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(list(make(batch.column(at).to_pylist())), batch.schema.types[at])
            yield pa.RecordBatch.from_arrays(
                [texts if i == at else column for i, column in enumerate(batch.columns)], names=batch.schema.names
            )

    return small_batches(df).mapInArrow(run, df.schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    plain = {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
        "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return plain[kind.simpleString()]


def rows_to_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    arrays = [pa.array(v, arrow_type(f.dataType)) for v, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())


def fields(listed: str) -> T.StructType:
    """A schema from ``name type, ...``; unlike Spark's own reading of it, it needs no session."""
    plain = {
        "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
        "boolean": T.BooleanType(), "binary": T.BinaryType(),
    }
    schema = T.StructType()
    for name, kind in (f.split() for f in listed.split(",")):
        inner = kind.removeprefix("array<").removesuffix(">")
        schema.add(name, plain[kind] if kind in plain else T.ArrayType(plain[inner]))
    return schema
