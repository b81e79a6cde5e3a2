"""Helpers the operators share: scratch tables, byte-level words and their fingerprints."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.session import shared_folder

WHITE = b" \t\n\x0b\x0c\r"  # what ends a word: [\x20\x09-\x0D]
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_LANE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_WHITE = np.zeros(256, bool)
IS_WHITE[list(WHITE)] = True


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, its lineage cut, and safe from lost executors."""
    path = shared_folder(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fingerprint_filter(frame: DataFrame, key: Column, bits: int = 21) -> Callable[[Column], Column]:
    """A test of whether a key may be among those of `frame`: never false for one that is.

    A bit map of fixed size, whatever the input, so that rows which cannot match need not be shuffled.
    """
    place = lambda key: F.pmod(F.crc32(key), F.lit(1 << bits))
    marked = np.zeros(1 << bits, bool)
    marked[frame.select(place(key).cast("int").alias("at")).distinct().toPandas()["at"].to_numpy()] = True
    packed = bytearray(np.packbits(marked, bitorder="little").tobytes())
    # As a scalar, not a literal: a literal is spelt out in every description of a plan that has it, and the driver keeps those.
    packed = written(frame.sparkSession.range(1, numPartitions=1).select(F.lit(packed).alias("packed")), "filter").scalar()

    def test(key: Column) -> Column:
        at = place(key)
        byte = F.conv(F.hex(F.substring(packed, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1

    return test


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores until no column has it, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shelved(keep: list[str]) -> Column:
    """The columns to keep as one struct, so that their names clash with none that an operator uses inside."""
    return F.struct(F.lit(None).cast("int").alias("none"), *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)))


def unshelved(shelf: str, keep: list[str], new: list[str]) -> list[Column]:
    """The kept columns again; one that is named like a new column, in any case, gives way to it."""
    taken = {name.lower() for name in new}
    return [F.col(f"{shelf}.k{i}").alias(c) for i, c in enumerate(keep) if c.lower() not in taken]


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text mod `folds`; -1 for a null id, which so belongs to no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def drawn(ids: DataFrame, sample: int, *salt: int) -> DataFrame:
    """At most `sample` different values of the one column of `ids`, by a hash of them, alike at every run.

    A threshold on the hash, from an estimate of how many there are, leaves few rows to sort, however large the input.
    """
    name = ids.columns[0]
    count = ids.agg(F.approx_count_distinct(name)).first()[0]
    # Signed hashes from the least one on; four times what is wanted is more than the estimate errs by.
    edge = min(-(1 << 63) + (1 << 64) * 4 * sample // max(count, 1), (1 << 63) - 1)
    hashed = F.xxhash64(name, *(F.lit(x) for x in salt))
    return ids.where(hashed <= edge).distinct().orderBy(hashed, name).limit(sample)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, and after them the memory they took: workers are used again, and would keep it beside the next task's."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def per_row(
    frame: DataFrame, schema: str, keep: list[str], text: str, of: Callable[[bytes], tuple]
) -> DataFrame:
    """The kept columns and what `of` makes of the bytes of each text (null: empty), a batch at a time.

    schema names the new columns in the order of of()'s values. Kept columns named like one of them, in any case, give
    way to it. Nothing is shuffled.
    """
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    keep = [c for c in keep if c.lower() not in {n.lower() for n in names}]
    # A text that is kept goes to the worker once.
    same = [i for i, c in enumerate(keep) if c == text and frame.schema[c].dataType == T.StringType()]
    at = same[0] if same else len(keep)
    texts = [] if same else [F.col(text).cast("string").alias("text")]
    rows = frame.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), *texts)
    plain = [f"k{i}" for i in range(len(keep))] + [f"v{i}" for i in range(len(names))]  # names may hold any sign

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _types(schema)
        for batch in batches:
            column = batch.column(at).cast(pa.binary())
            for part in range(0, batch.num_rows, 1000):
                values = [of(x or b"") for x in column.slice(part, 1000).to_pylist()]
                made = [pa.array(x, t) for x, t in zip(zip(*values), kinds, strict=True)]
                kept = [batch.column(i).slice(part, 1000) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *made], plain)

    kept = [f"k{i} {field.dataType.simpleString()}" for i, field in enumerate(rows.schema.fields[: len(keep)])]
    made = [f"v{i} {part.strip().split(' ', 1)[1]}" for i, part in enumerate(schema.split(","))]
    return rows.mapInArrow(lambda batches: released(run(batches)), ", ".join([*kept, *made])).toDF(*keep, *names)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64()),
    "array<float>": pa.list_(pa.float32()), "array<array<double>>": pa.list_(pa.list_(pa.float64())), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
}


def _types(schema: str) -> list[pa.DataType]:
    return [_ARROW[part.strip().split(" ")[1]] for part in schema.split(",")]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in these bytes."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~IS_WHITE[raw]
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_prints(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each word: a sum over its bytes, weighted by their places, mixed with its length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.full(int(sizes.max()), _STEP, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    total = np.add.reduceat(mixed_bytes(raw)[place + np.repeat(starts, sizes)] * powers[place], first)
    return mixed(total + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mixed_bytes(raw: np.ndarray) -> np.ndarray:
    return _BYTE[raw]


def window_prints(words: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of `width` words (up to 64)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += words[j : j + n] * _LANE[j]
    return mixed(total + np.uint64(width))
