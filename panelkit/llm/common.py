"""What the operators of this folder share: reading, word rules, and batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the words of a text are the longest runs of characters other than these six.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task works on at a time; a longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key's text, modulo `divisor`; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of `column`, and one row at least.

    Memory of a task is then bounded by that and the longest text, not by rows times text size.
    """
    for batch in batches:
        start, held = 0, 0
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
