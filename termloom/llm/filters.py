"""Bloom filters over 64-bit hashes, built by executors and of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.tokens import U, mix

#: bounds of a filter's size in bits; between them it has 16 bits a hash
LEAST_BITS, MOST_BITS, PAGE = 1 << 20, 1 << 29, 1 << 16
#: groups of tasks whose pages are merged first
FAN = 256


def merged_pages(pages: DataFrame, column: str, merge: Callable[[pd.Series], bytes]) -> DataFrame:
    """pages (page, column binary) with one row a page: those of a few tasks are merged first, then what these gave."""

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"page": [key[0]], column: [merge(frame[column])]})

    schema = f"page long, {column} binary"
    some = pages.withColumn("tasks", F.spark_partition_id() % FAN).groupBy("page", "tasks").applyInPandas(one, schema)
    return some.groupBy("page").applyInPandas(one, schema)


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = U(bits - 1)
    return h & m, mix(h ^ U(0xA5A5A5A5A5A5A5A5)) & m


def bloom(spark: SparkSession, rows: DataFrame, least: int = LEAST_BITS) -> tuple[np.ndarray, int]:
    """The filter's bytes for the column hash of rows, and its size in bits: at most MOST_BITS / 8 bytes reach the driver."""
    n = rows.count()
    bits = int(min(MOST_BITS, max(least, 1 << int(16 * max(n, 1)).bit_length())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for b in batches:
            h = b.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(_slots(h, bits)).astype(np.int64)
            at.sort()
            pages, first = np.unique(at // PAGE, return_index=True)
            for p, x in zip(pages.tolist(), np.split(at, first[1:]), strict=True):
                flags = np.zeros(PAGE, dtype=bool)
                flags[x - p * PAGE] = True
                packed = np.packbits(flags, bitorder="little")
                kept[p] = kept[p] | packed if p in kept else packed
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int64()), pa.array([v.tobytes() for v in kept.values()], pa.binary())], ["page", "flags"])

    def merge(values: pd.Series) -> bytes:
        out = np.zeros(PAGE // 8, dtype=np.uint8)
        for x in values:
            out |= np.frombuffer(x, dtype=np.uint8)
        return out.tobytes()

    pages = merged_pages(rows.select("hash").mapInArrow(run, "page long, flags binary"), "flags", merge)
    flags = np.zeros(bits // 8, dtype=np.uint8)
    for r in pages.collect():
        flags[r["page"] * (PAGE // 8) : (r["page"] + 1) * (PAGE // 8)] = np.frombuffer(r["flags"], dtype=np.uint8)
    return flags, bits


def held(flags: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter; all that are in it."""
    a, b = _slots(h, bits)
    bit = lambda s: (flags[(s >> U(3)).astype(np.int64)] >> (s & U(7)).astype(np.uint8)) & 1
    out = bit(a).astype(bool)
    out[out] = bit(b[out]).astype(bool)
    return out
