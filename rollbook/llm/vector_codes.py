"""Compressed vectors: codes of eight parts, assigned exactly in the domain of the Walsh-Hadamard transform.

Method. Components become whole numbers, floor(scale * x); a part and the entries of its codebook are padded with zeros to
a power of two, P, and transformed by sums and differences (no multiplication, no fraction). The transform is orthogonal
but for a factor: squared differences of transformed components add up to P times those of the components. They are
summed in sequency order, slow waves first, which hold most of the difference between smooth parts, as follows.

1. The first quarter of the components is summed for all entries. The entry that is ahead is measured whole.
2. The others go on component by component and leave once their sum is above that measure, or equal to it with a higher
   index: sums only grow, so none that leaves can be nearest. What is left at the end has whole sums.

So `nearest` gives the index and distance of a plain search, ties to the lower index, in whole numbers throughout.

A codebook starts as the parts of the vectors with the least ids. A round is one job over the table of whole numbers: tasks
assign, and send one sum per entry and component; the driver gets these sums, whose number depends on the dimension
alone. Nothing else is collected, and no vector is shuffled but by the join that attaches the sums of labels, which is
salted, as one label may hold a third of the vectors.

Defined cases. Vectors that are null or hold a null, NaN or infinite component are dropped. The dimension is that of the
longest vector, raised to a multiple of the parts; shorter vectors count as padded with zeros. Without 16 vectors a codebook
has as many entries as there are. Ids may repeat, each row being a vector; of equal ids, those with lower bytes start
first, and null ids come last. Empty tables give no rows. Further columns are not read. Sums are 64-bit numbers where the
components allow it and unbounded ones otherwise; a component beyond 2^62 is read as 2^62, and an error beyond 2^63 - 1
as that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SALTS = 8
_MOST = 1 << 62
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """Entries as whole numbers: one array (entry, component) per part, of 64-bit or unbounded numbers."""

    books: tuple[np.ndarray, ...]
    dimension: int
    peak: int  # the largest absolute component of the vectors

    def digest(self) -> str:
        """sha256 of all entries' components, by part, entry and place, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel()).encode()).hexdigest()


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """The kept vectors: vec_id, label, size, peak (largest absolute component) and `whole`, 64-bit numbers as bytes."""
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    )
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, peaks, made = [], [], [], []
            for i, one in enumerate(batch.column(2)):
                if not one.is_valid or one.values.null_count:
                    continue
                x = one.values.to_numpy(zero_copy_only=False)
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale)
                x = np.where(x >= _MOST, _MOST, np.where(x <= -_MOST, -_MOST, np.clip(x, -(2.0**61), 2.0**61).astype(np.int64)))
                kept.append(i)
                sizes.append(len(x))
                peaks.append(int(np.abs(x).max(initial=0)))
                made.append(x.astype("<i8").tobytes())
            place = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(place), batch.column(1).take(place), pa.array(sizes, pa.int32()), pa.array(peaks, pa.int64()), pa.array(made, pa.binary())],
                ["vec_id", "label", "size", "peak", "whole"],
            )

    return rows.mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, size int, peak long, whole binary")


def learn(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of a written table of whole numbers, after `rounds` of assigning and averaging."""
    size, peak = table.agg(F.max("size"), F.max("peak")).first()
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).select("whole").collect()
    width = -(-(size or 0) // parts)
    # Averages rounded down lie within the components or one below them.
    kind = np.int64 if _fits(width, (peak or 0) + 1) else object
    start = _matrix([bytes(r.whole) for r in first], width * parts, kind)
    model = Codebooks(tuple(start[:, p * width : (p + 1) * width] for p in range(parts)), width * parts, peak or 0)
    for _ in range(rounds if first and width else 0):
        summed = table.select("whole").mapInArrow(_summing(model), "part int, entry int, place int, total decimal(38,0), n long")
        books = [book.copy() for book in model.books]
        # One row per entry and component.
        for r in summed.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books[r.part][r.entry, r.place] = int(r.total) // r.n
        model = Codebooks(tuple(books), model.dimension, model.peak)
    return model


def encode(table: DataFrame, model: Codebooks) -> DataFrame:
    """vec_id, label, code (one number per part) and error (squared distance to what the code stands for)."""
    kind = {f.name: f.dataType.simpleString() for f in table.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(model)
        for batch in batches:
            _, index, distance = assign(batch.column(2))
            error = np.minimum(distance.sum(1, dtype=distance.dtype), _LONG).astype(np.int64) if len(model.books) else np.zeros(batch.num_rows, np.int64)
            code = pa.FixedSizeListArray.from_arrays(pa.array(index.astype(np.int32).ravel()), index.shape[1]).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, pa.array(error)], ["vec_id", "label", "code", "error"])

    return table.select("vec_id", "label", "whole").mapInArrow(
        run, f"vec_id {kind['vec_id']}, label {kind['label']}, code array<int>, error long"
    )


def with_label_errors(encoded: DataFrame) -> DataFrame:
    """`encoded`, a written table, with the sum of error over the rows of the same label; null labels are one."""
    summed = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    totals = encoded.groupBy(F.col("label").alias("of")).agg(summed.alias("label_error"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    totals = totals.withColumn("salt_of", salts)
    rows = encoded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "error", "code"), F.lit(SALTS)))
    match = rows["label"].eqNullSafe(totals["of"]) & (rows["salt"] == totals["salt_of"])
    return rows.join(totals, match).drop("of", "salt", "salt_of")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks]:
    """Codes and errors of the kept vectors, and the codebooks they refer to."""
    table = written(whole_numbers(vectors, vec_id, vector, label), "vector-whole")
    model = learn(table)
    return with_label_errors(written(encode(table, model), "vector-codes")), model


# --- assigning ---


def sequency_order(size: int) -> np.ndarray:
    """Where the wave of s sign changes is among the results of `transformed` (size: a power of two)."""
    bits = size.bit_length() - 1
    wave = np.arange(size)
    gray = wave ^ (wave >> 1)
    return sum((((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)), np.zeros(size, np.int64))


def transformed(x: np.ndarray, size: int) -> np.ndarray:
    """The rows, padded with zeros to `size` components, as sums over Walsh functions in sequency order."""
    out = np.zeros((len(x), size), x.dtype)
    out[:, : x.shape[1]] = x
    step = 1
    while step < size:
        pair = out.reshape(len(x), size // (2 * step), 2, step)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(x), size)
        step *= 2
    return out[:, sequency_order(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and entries, both transformed: the nearest entry of each row and its squared distance.

    Distances are those of the rows before the transform; of equal ones the lower index counts.
    """
    size, rows, index = x.shape[1], np.arange(len(x)), np.arange(len(entries))
    lead = max(1, size // 4)
    so_far = np.zeros((len(x), len(entries)), x.dtype)
    for j in range(lead):
        d = x[:, j, None] - entries[None, :, j]
        so_far += d * d
    ahead = so_far.argmin(1)
    d = x[:, lead:] - entries[ahead, lead:]
    bound = so_far[rows, ahead] + (d * d).sum(1, dtype=x.dtype)

    def in_the_race(total: np.ndarray, limit: np.ndarray, entry: np.ndarray, first: np.ndarray) -> np.ndarray:
        return ((total < limit) | ((total == limit) & (entry < first))).astype(bool)

    left = in_the_race(so_far, bound[:, None], index[None, :], ahead[:, None])
    left[rows, ahead] = False
    row, entry = np.nonzero(left)
    total = so_far[row, entry]
    for j in range(lead, size):
        if not len(row):
            break
        d = x[row, j] - entries[entry, j]
        total = total + d * d
        go_on = in_the_race(total, bound[row], entry, ahead[row])
        row, entry, total = row[go_on], entry[go_on], total[go_on]
    if len(row):
        # All of these are nearer than the one that was ahead, or as near with a lower index.
        rank = np.unique(total, return_inverse=True)[1]
        order = np.lexsort((entry, rank, row))
        best = order[np.concatenate(([True], np.diff(row[order]) > 0))]
        ahead[row[best]], bound[row[best]] = entry[best], total[best]
    return ahead, bound // size


def _padded(width: int) -> int:
    return 1 << max(0, (width - 1).bit_length())


def _fits(width: int, peak: int) -> bool:
    """Whether sums of squared differences of transformed parts stay within 64 bits."""
    size = _padded(max(width, 1))
    return size * max(width, 1) * (2 * peak) ** 2 < 1 << 63


def _matrix(rows: list[bytes], dimension: int, kind: type) -> np.ndarray:
    out = np.zeros((len(rows), dimension), np.int64)
    for i, row in enumerate(rows):
        x = np.frombuffer(row, "<i8")
        out[i, : len(x)] = x
    return out.astype(kind)


def _assigner(model: Codebooks) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A function of a batch of whole numbers: the matrix, the nearest entries and their distances by part."""
    parts = len(model.books)
    width = model.dimension // parts
    size = _padded(width) if width else 1
    kind = model.books[0].dtype
    waves = [transformed(book, size) for book in model.books]

    def assign(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = _matrix(column.to_pylist(), model.dimension, kind)
        index, distance = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), kind)
        for p in range(parts if len(x) else 0):
            index[:, p], distance[:, p] = nearest(transformed(x[:, p * width : (p + 1) * width], size), waves[p])
        return x, index, distance

    return assign


def _summing(model: Codebooks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, count = len(model.books), len(model.books[0])
    width = model.dimension // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(model)
        totals, n = np.zeros((parts, count, width), object), np.zeros((parts, count), np.int64)
        for batch in batches:
            x, index, _ = assign(batch.column(0))
            # Within a batch 64 bits hold the sums if they hold the squares of differences.
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                for e in np.unique(index[:, p]):
                    mine = index[:, p] == e
                    totals[p, e] += part[mine].sum(0, dtype=part.dtype).astype(object)
                    n[p, e] += int(mine.sum())
        p, e = np.nonzero(n)
        place = np.tile(np.arange(width), len(p))
        sums = pa.array([Decimal(int(v)) for v in totals[p, e].ravel()], pa.decimal128(38, 0))
        columns = [np.repeat(p, width), np.repeat(e, width), place]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c.astype(np.int32)) for c in columns), sums, pa.array(np.repeat(n[p, e], width))],
            ["part", "entry", "place", "total", "n"],
        )

    return run
