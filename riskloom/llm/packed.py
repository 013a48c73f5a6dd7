"""Rows of documents keyed for joins, their texts compressed for the shuffle."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import textbytes as tb

ID, TEXT_KEY, BLOB = "__id", "__tk", "__z"
KEY = [ID, TEXT_KEY]
NULL_ID = -(1 << 63)


def text_of(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def keys(id_col: str, text_col: str) -> list[Column]:
    """The id (null: the least long) and a hash of the text.

    Rows that agree in both are repeats of one document; a repeated id with
    another text stays apart.
    """
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias(ID),
            F.xxhash64(text_of(text_col)).alias(TEXT_KEY)]


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns of ``docs`` but the text, the keys, and the text's bytes under ``BLOB``."""
    rest = [c for c in docs.columns if c != text_col]
    keyed = docs.select(*[F.col(f"`{c}`") for c in rest], *keys(id_col, text_col), text_of(text_col).alias(BLOB))
    schema = T.StructType(keyed.schema.fields[:-1] + [T.StructField(BLOB, T.BinaryType())])

    def squeeze(batches):
        tb.lean()
        codec = pa.Codec("zstd", compression_level=3)
        for whole in batches:
            for b in tb.slices(whole, whole.num_columns - 1):
                texts = b.column(b.num_columns - 1).cast(pa.binary())
                blobs = [len(v).to_bytes(4, "big") + codec.compress(v, asbytes=True) for v in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(blobs, pa.binary())], names=b.schema.names)

    return keyed.mapInArrow(squeeze, schema)


def unpack(blob: bytes) -> bytes:
    """The text's bytes of a blob of ``packed``."""
    return pa.Codec("zstd").decompress(blob[4:], decompressed_size=int.from_bytes(blob[:4], "big"), asbytes=True)
