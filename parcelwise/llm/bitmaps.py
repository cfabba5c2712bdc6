"""Bitmaps of fixed size that let tasks pass over most rows a join would drop anyway.

A bitmap has 2**BITS bits (8 MB) however much is marked in it, and is made by Spark's bitmap aggregate. It never hides a
marked value; what it lets through besides is left to the join that follows. The fuller it is, the more that is.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.sent import send

BITS = 26


def place(value: Column) -> Column:
    """The bit of a value, from 0."""
    return F.shiftrightunsigned(F.xxhash64(value), 64 - BITS)


def build(bits: DataFrame) -> Broadcast:
    """Marks the bits in the one column of a table; at most 2,048 rows of 4 KB reach the driver."""
    bit = bits.toDF("bit").select((F.col("bit") + 1).alias("bit"))
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("part")
    )
    found = np.zeros(1 << (BITS - 3), np.uint8)
    for row in parts.toLocalIterator():
        found[(row.k - 1) * 4096 : row.k * 4096] = np.frombuffer(row.part, np.uint8)
    return send(bits.sparkSession.sparkContext, found)


def marked(found: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (found[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1
