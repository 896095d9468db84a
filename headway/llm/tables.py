"""Small shared steps of the operators: keys of rows and rows by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the set that tells which texts may be wanted: 2 MB, whatever is wanted.
TEXT_BITS = 1 << 24


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that name a document by its id and its whole text; null differs from empty.

    Rows equal in both are one document listed more than once: what is decided for it holds
    for each of its rows.
    """
    return F.unhex(
        F.md5(F.concat_ws("\x00", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.coalesce(F.col(text), F.lit("\x01"))))
    )


def map_texts(
    df: DataFrame, columns: list, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply ``make`` to every Arrow batch of the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make(batch)
                if made is not None and made.num_rows:
                    yield made

    return df.select(*columns).mapInArrow(run, schema)


def spare_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_id(text: str = "text") -> Column:
    """64 bits that name a whole text; null is empty here."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def bit_set(numbers: DataFrame, bits: int) -> np.ndarray:
    """The numbers below ``bits`` of a one-column table as a bit set, put together by 64 bits a row."""
    number = F.col(numbers.columns[0])
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % 64).cast("int"))
    words = numbers.groupBy(F.floor(number / 64).alias("word")).agg(F.bit_or(one).alias("set"))
    table = np.zeros(bits // 64, np.int64)
    rows = words.toArrow()
    table[rows["word"].to_numpy()] = rows["set"].to_numpy()
    return table.view(np.uint8)


def key_bit(key: str) -> Column:
    """The first 24 bits of a binary key, as a number below ``TEXT_BITS``."""
    return F.conv(F.hex(F.substring(F.col(key), 1, 3)), 16, 10).cast("bigint")


def key_bits(keys: pa.Array) -> np.ndarray:
    """``key_bit`` of an Arrow array of keys without nulls."""
    return np.array([int.from_bytes(key[:3], "big") for key in keys.to_pylist()], np.int64)


def in_bits(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which numbers are in a bit set."""
    return (bits[numbers >> 3] >> (numbers & 7).astype(np.uint8)) & 1 == 1


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted (text_id, ...)`` with the ``text`` of each id.

    A bit set of fixed size drops most other texts before the shuffle; the join is exact.
    """
    bits = docs.sparkSession.sparkContext.broadcast(
        bit_set(wanted.select(F.pmod("text_id", F.lit(TEXT_BITS)).alias("bit")), TEXT_BITS)
    )

    @F.pandas_udf("boolean")
    def maybe_wanted(ids: pd.Series) -> pd.Series:
        return pd.Series(in_bits(bits.value, ids.to_numpy() % TEXT_BITS))

    # Else the join would ask the wanted ids as well.
    maybe_wanted = maybe_wanted.asNondeterministic()
    texts = docs.select(text_id().alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.filter(maybe_wanted("text_id")).join(wanted, "text_id")
    kept = [F.first(c).alias(c) for c in ("text", *wanted.columns) if c != "text_id"]
    return texts.groupBy("text_id").agg(*kept)


def repeated_places(rows: DataFrame) -> DataFrame:
    """The distinct ``(text_id, place)`` of ``rows (hash, text_id, place)`` whose hash has another one.

    Hashes are aggregated by least and greatest, so a very common one is combined before the
    shuffle; the join back is one that Spark can split.
    """
    repeated = rows.groupBy("hash").agg(
        F.min("text_id").alias("_a"), F.max("text_id").alias("_b"), F.min("place").alias("_c"), F.max("place").alias("_d")
    )
    repeated = repeated.filter("_a <> _b or _c <> _d").select("hash")
    return rows.join(repeated, "hash").select("text_id", "place")
