"""Removal of byte strings that occur twice, by suffix arrays built with two-stage sorting.

Every byte covered by a `WIDTH`-byte string that also starts elsewhere, in any text or the same one, is removed.

1. Equal texts become one; if copies exist, all of a text that is long enough is repeated.
2. Each start of a WIDTH-byte string is assigned to the least GRAM-byte gram inside the string, by fingerprint: equal
   strings have equal grams, at the same place. Starts of one gram are neighbours, so a text falls into pieces: a run of
   starts, and the bytes that their strings cover. Grams that occur once in the corpus are dropped with their pieces.
3. Pieces meet by gram (equal ones first become one, with a number of occurrences). A suffix array over the pieces of
   whole grams, a few megabytes at a time, brings equal strings side by side. Only suffixes smaller than their
   successors are sorted directly; the others are induced by scanning the buckets in the order of their first byte.
   Neighbours that agree in WIDTH bytes are repeated.
4. The repeated starts go back to the texts, where their strings are united.

Pieces of a gram beyond `group_bytes` (a passage that a large part of all texts share) never meet in one task: their
starts are counted by 128-bit fingerprints of whole strings, with partial sums. What is broadcast are bit maps of fixed
size, which only spare work.

Defined cases: a null or empty text has no bytes and loses none; a text shorter than WIDTH loses nothing, even if it
has copies; repeated rows are copies; an empty table gives no rows; rows are known by their texts, so ids may repeat or
be missing; further columns are ignored unless kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import fingerprint_filter, mixed, mixed_bytes, released, shelved, unshelved, unused, written

WIDTH = 400
GRAM = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = np.uint64((1 << 20) - 1)
_SEGMENT = 1 << 19
_BITS = 21
BATCH_BYTES = 1_500_000


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_STEP, _SEGMENT + WIDTH + 1), _powers(_BACK, _SEGMENT + WIDTH + 1)


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of each run of `size` bytes (up to a segment's)."""
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed_bytes(codes) * _UP[:n], out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * _DOWN[: n + 1 - size])


def least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring keys, by minima from both ends of blocks of that width."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def pieces(raw: bytes, width: int = WIDTH, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """(gram's fingerprint, first start, past the last start) for all starts of a text, in order."""
    whole = np.frombuffer(raw, np.uint8)
    for base in range(0, max(0, len(whole) - width + 1), _SEGMENT):
        codes = whole[base : base + _SEGMENT + width - 1]
        prints = grams(codes, gram)
        keys = (prints & ~_PLACE) | np.arange(len(prints), dtype=np.uint64)  # ties: the first
        chosen = (least(keys, width - gram + 1) & _PLACE).astype(np.int64)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(chosen)) + 1, [len(chosen)]))
        for first, past in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(prints[chosen[first]].view(np.int64)), base + first, base + past


def two_stage(raw: bytes, wanted: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """The wanted positions (ascending) in the order of their suffixes' first `depth` bytes."""
    codes = np.frombuffer(raw, np.uint8)
    n = len(codes)
    if not len(wanted):
        return wanted
    # A suffix is small if it is less than its successor: the next different byte is greater.
    turns = np.flatnonzero(codes[1:] != codes[:-1]).astype(np.int32)
    ends = np.append(turns + 1, n).astype(np.int32)
    sizes = np.diff(ends, prepend=0)
    rising = np.append(codes[turns + 1] > codes[turns], False)
    small = np.repeat(rising, sizes)
    run_end = np.repeat(ends, sizes)
    del turns, ends, sizes, rising
    # A large suffix is induced from its successor, so all positions up to the next small one take part.
    starts = np.flatnonzero(small).astype(np.int32)
    stop = np.append(starts, n - 1)[np.searchsorted(starts, wanted)]
    del starts
    mark = np.zeros(n + 1, np.int32)
    mark[wanted] = 1
    np.subtract.at(mark, stop + 1, 1)
    used = np.cumsum(mark, out=mark)[:n] > 0
    del mark, stop

    direct = np.flatnonzero(used & small)
    direct = direct[np.argsort(_words(codes, direct), kind="stable")]
    heads = _words(codes, direct)
    edges = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1], [True]))) if len(direct) else np.zeros(1, int)
    tied = np.flatnonzero(np.diff(edges) > 1)
    for a, b in zip(edges[tied].tolist(), edges[tied + 1].tolist()):
        direct[a:b] = sorted(direct[a:b].tolist(), key=lambda p: raw[p + 8 : p + depth + 1])

    induced = np.flatnonzero(used & ~small)
    rank = np.full(n + 1, -1, np.int32)  # past the end: the least
    del used, small
    order, at = [], 0
    direct_heads, induced_heads = codes[direct], codes[induced]
    induced = induced[np.argsort(induced_heads, kind="stable")]
    counts_l = np.concatenate(([0], np.cumsum(np.bincount(induced_heads, minlength=256))))
    counts_s = np.concatenate(([0], np.cumsum(np.bincount(direct_heads, minlength=256))))
    for byte in range(256):
        large = induced[counts_l[byte] : counts_l[byte + 1]]
        if len(large):
            after = run_end[large]  # begins with a smaller byte: its bucket is done
            large = large[np.lexsort((rank[after], after - large))]
        bucket = np.concatenate((large, direct[counts_s[byte] : counts_s[byte + 1]]))
        if len(bucket):
            rank[bucket] = np.arange(at, at + len(bucket))
            at += len(bucket)
            order.append(bucket)
    order = np.concatenate(order)
    asked = np.zeros(n, bool)
    asked[wanted] = True
    return order[asked[order]]


def _words(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as a number that sorts like them; zeros past the end."""
    padded = np.concatenate((codes, np.zeros(8, np.uint8)))
    out = np.zeros(len(at), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[at + i].astype(np.uint64)
    return out


def repeated(texts: list[bytes], times: list[int], width: int = WIDTH) -> list[np.ndarray]:
    """For each text, whether its starts of `width`-byte strings are repeated; times: occurrences of the text."""
    raw = b"".join(texts)
    sizes = np.array([len(x) for x in texts])
    base = np.concatenate(([0], np.cumsum(sizes)))
    n_starts = np.maximum(sizes - width + 1, 0)
    first = np.concatenate(([0], np.cumsum(n_starts)))
    owner = np.repeat(np.arange(len(texts)), n_starts)
    wanted = base[owner] + np.arange(first[-1]) - first[owner]
    order = two_stage(raw, wanted, width)
    flags = np.zeros(len(raw), bool)
    if len(order):
        at = order.tolist()
        same = np.fromiter((raw[a : a + width] == raw[b : b + width] for a, b in zip(at, at[1:])), bool, len(at) - 1)
        group = np.concatenate(([0], np.cumsum(~same)))
        weight = np.array(times)[np.searchsorted(base, order, side="right") - 1]
        flags[order] = np.bincount(group, weight)[group] > 1
    return [flags[base[i] : base[i] + n_starts[i]] for i in range(len(texts))]


def _stretches(flags: np.ndarray) -> list[int]:
    """first, past, first, past, ... of the runs of true."""
    turns = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.stack((np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)), 1).ravel().tolist()


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, name, times) of each text in batches of (name, text)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            found: list[tuple[int, bytes, int]] = []
            for name, raw in zip(
                batch.column(0).slice(at, 200).to_pylist(), batch.column(1).slice(at, 200).cast(pa.binary()).to_pylist(), strict=True
            ):
                times: dict[int, int] = {}
                for gram, _, _ in pieces(raw):
                    times[gram] = times.get(gram, 0) + 1
                found += [(gram, name, n) for gram, n in times.items()]
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array([x[0] for x in found], pa.int64()),
                    "name": pa.array([x[1] for x in found], pa.binary()),
                    "times": pa.array([x[2] for x in found], pa.int64()),
                }
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int, bytes]]:
    """(name, gram, first start, bytes) of the pieces with repeated grams; batches of (name, text, grams)."""
    for batch in batches:
        for row in range(batch.num_rows):
            name, raw = batch.column(0)[row].as_py(), batch.column(1)[row].cast(pa.binary()).as_py()
            among = set(batch.column(2)[row].as_py())
            for gram, first, past in pieces(raw):
                if gram in among:
                    yield name, gram, first, raw[first : past + WIDTH - 1]


def _freed(run):
    """The pass, its worker's memory given back at the end of the task."""
    return lambda batches: released(run(batches))


def _piece_name(gram: int, piece: bytes) -> bytes:
    return md5(gram.to_bytes(8, "little", signed=True) + piece, usedforsecurity=False).digest()


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, piece, times), equal pieces of a task made one where they are near."""
    held: dict[tuple[int, bytes], int] = {}
    size = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "gram": pa.array([g for g, _ in held], pa.int64()),
                "piece": pa.array([x for _, x in held], pa.binary()),
                "times": pa.array(held.values(), pa.int64()),
            }
        )

    for _, gram, _, piece in _cut(batches):
        key = (gram, piece)
        if key not in held:
            size += len(piece)
            held[key] = 0
        held[key] += 1
        if size > 4 * BATCH_BYTES:
            yield out()
            held, size = {}, 0
    yield out()


def _places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece's name, text's name, first start)."""
    rows: list[tuple[bytes, bytes, int]] = []

    def out() -> pa.RecordBatch:
        kinds = (pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "name", "first"])

    for name, gram, first, piece in _cut(batches):
        rows.append((_piece_name(gram, piece), name, first))
        if len(rows) == 20000:
            yield out()
            rows = []
    yield out()


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, stretches) from (gram, piece, times) sorted by gram: suffix arrays over whole grams."""
    held: dict[tuple[int, bytes], int] = {}
    own: dict[tuple[int, bytes], int] = {}  # of the gram being read
    size, own_size, last = 0, 0, None

    def out() -> pa.RecordBatch:
        flags = repeated([x for _, x in held], list(held.values()))
        found = [(_piece_name(*key), _stretches(f)) for key, f in zip(held, flags, strict=True) if f.any()]
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.list_(pa.int64()))],
            ["part", "stretches"],
        )

    for batch in batches:
        for gram, piece, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if gram != last:
                if held and size + own_size > BATCH_BYTES:  # a large gram comes alone
                    yield out()
                    held, size = {}, 0
                held |= own
                size += own_size
                own, own_size, last = {}, 0, gram
            key = (gram, piece)
            if key not in own:
                own_size += len(piece)
                own[key] = 0
            own[key] += times
    if held and size + own_size > BATCH_BYTES:
        yield out()
        held = {}
    held |= own
    yield out()


def _bit_map(prints: DataFrame):
    """A broadcast, packed map of fixed size of the crc32 of prints, modulo its length."""
    bits = np.zeros(1 << _BITS, bool)
    at = prints.select(F.pmod(F.crc32("print"), F.lit(1 << _BITS)).cast("int").alias("at")).distinct().toPandas()
    bits[at["at"].to_numpy()] = True
    return prints.sparkSession.sparkContext.broadcast(np.packbits(bits))


def _strings_of(shared=None):
    """(print, part, at, times) of each start of pieces (gram, piece, times); shared: a map of the prints wanted."""
    names = ["print", "part", "at", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.unpackbits(shared.value)
        for batch in batches:
            for gram, piece, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(piece) - WIDTH + 1
                found = [(i, md5(piece[i : i + WIDTH], usedforsecurity=False).digest()) for i in range(n)]
                if bits is not None:
                    found = [x for x in found if bits[zlib.crc32(x[1]) % (1 << _BITS)]]
                part = _piece_name(gram, piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x for _, x in found], pa.binary()), pa.array([part] * len(found), pa.binary()),
                        pa.array([i for i, _ in found], pa.int64()), pa.array([times] * len(found), pa.int64()),
                    ],
                    names,
                )

    return run


def _repeated_parts(cut: DataFrame, group_bytes: int) -> DataFrame:
    """(part, stretches): the repeated starts of pieces, from candidates (name, text, grams)."""
    found = cut.mapInArrow(_freed(_pieces_of), "gram long, piece binary, times long")
    hot = written(
        found.groupBy("gram").agg(F.sum(F.length("piece")).alias("size")).where(F.col("size") > group_bytes).select("gram"),
        "hot-grams",
    )
    calm = found if hot.limit(1).count() == 0 else found.join(hot, "gram", "left_anti")
    sorted_ = calm.repartition("gram").sortWithinPartitions("gram")
    parts = sorted_.mapInArrow(_freed(_sorted_groups), "part binary, stretches array<long>")
    if calm is found:
        return parts
    shape = "print binary, part binary, at long, times long"
    large = found.join(hot, "gram", "left_semi")
    counts = large.mapInArrow(_freed(_strings_of()), shape).groupBy("print").agg(F.sum("times").alias("n"))
    often = written(counts.where("n > 1").select("print"), "often-strings")
    strings = large.mapInArrow(_freed(_strings_of(_bit_map(often))), shape)
    starts = strings.join(often, "print", "left_semi").groupBy("part").agg(F.collect_set("at").alias("at"))
    split = F.flatten(F.transform("at", lambda x: F.array(x, x + 1)))  # a piece has few starts
    return parts.unionByName(starts.select("part", split.alias("stretches")))


def _united(starts: list[list[int]]) -> list[tuple[int, int]]:
    """Runs of bytes under strings that start in these stretches (first, stretches...)."""
    edges = sorted((row[0] + row[i], row[0] + row[i + 1] - 1 + WIDTH) for row in starts for i in range(1, len(row), 2))
    runs: list[tuple[int, int]] = []
    for first, past in edges:
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(past, runs[-1][1]))
        else:
            runs.append((first, past))
    return runs


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, runs, kept) from (name, text, starts)."""
    names = ["name", "runs", "kept"]
    for batch in (whole.slice(at, 200) for whole in batches for at in range(0, whole.num_rows, 200)):
        rows = []
        for row in range(batch.num_rows):
            raw = batch.column(1)[row].cast(pa.binary()).as_py()
            runs = _united(batch.column(2)[row].as_py())
            out, at = [], 0
            for first, past in runs:
                out.append(raw[at:first])
                at = past
            rows.append((batch.column(0)[row].as_py(), [x for run in runs for x in run], b"".join([*out, raw[at:]])))
        kinds = (pa.binary(), pa.list_(pa.int64()), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def find(documents: DataFrame, keep: list[str], group_bytes: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """Two tables: the kept columns with name (of the text), n_bytes, sha256 and copies (rows of the text); and of
    each text that loses bytes without having copies: name, runs (first, past, ...) and kept (the remaining bytes).

    A text of copies > 1 and n_bytes >= WIDTH is repeated as a whole.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.unhex(F.md5(text.cast("binary")))
    base = written(
        documents.select(shelved(keep).alias("kept"), name.alias("name"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha256")),
        "substring-base",
    )
    copies = written(base.groupBy("name").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "substring-copies")
    long = documents.select(name.alias("name"), text.alias("text")).where(F.octet_length("text") >= WIDTH)
    # Texts without copies are not shuffled: bit maps of fixed size tell most of them, and the rest become one anyway.
    copied = fingerprint_filter(copies, F.col("name"), _BITS)
    once = long.where(copied(F.col("name"))).groupBy("name").agg(F.first("text").alias("text"))
    texts = long.where(~copied(F.col("name"))).unionByName(written(once, "substring-once"))

    # One pass over the texts, whose grams are counted first and then chosen.
    anchors = written(texts.mapInArrow(_freed(_grams_of), "gram long, name binary, times long"), "substring-anchors")
    often = anchors.groupBy("gram").agg(F.sum("times").alias("n")).where("n > 1").select("gram")
    wanted = written(
        anchors.select("gram", "name").join(often, "gram").groupBy("name").agg(F.collect_list("gram").alias("grams")),
        "substring-grams",
    )
    some = texts.where(fingerprint_filter(wanted, F.col("name"), _BITS)(F.col("name")))
    cut = written(some.join(wanted, "name").select("name", "text", "grams"), "substring-cut")

    parts = written(_repeated_parts(cut, group_bytes), "substring-parts")
    places = cut.mapInArrow(_freed(_places_of), "part binary, name binary, first long")
    starts = (
        places.join(parts, "part")
        .groupBy("name").agg(F.collect_list(F.concat(F.array("first"), "stretches")).alias("starts"))
    )
    kept = cut.select("name", "text").join(starts, "name").select("name", "text", "starts")
    kept = kept.mapInArrow(_freed(_kept), "name binary, runs array<long>, kept binary")
    found = base.join(copies, "name", "left")
    new = ["name", "n_bytes", "sha256", "copies"]
    return found.select(*unshelved("kept", keep, new), *new[:3], F.coalesce("copies", F.lit(1)).alias("copies")), kept


def digest(base: DataFrame, kept: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of the registered query."""
    runs = F.expr("aggregate(sequence(0, cast(size(runs) / 2 as int) - 1), 0L, (n, i) -> n + runs[2 * i + 1] - runs[2 * i])")
    of = lambda name: unused(name, base.columns)
    lost = kept.select("name", runs.alias(of("n")), (F.size("runs") / 2).cast("long").alias(of("k")), F.sha2("kept", 256).alias(of("sha")))
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "name", "sha256", "copies"]
    keep = [c for c in keep if c.lower() not in new]
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= WIDTH)
    pick = lambda all_, some, none: F.when(whole, all_).otherwise(F.coalesce(F.col(some), none))
    return base.join(lost, "name", "left").select(
        *(F.col(f"`{c}`") for c in keep), "n_bytes",
        pick(F.col("n_bytes"), of("n"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), of("k"), F.lit(0)).cast("long").alias("n_spans"),
        pick(F.lit(sha256(b"").hexdigest()), of("sha"), F.col("sha256")).alias("kept_sha256"),
    )
