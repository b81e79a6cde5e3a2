"""Phrase collocations by top-order marginalisation.

Method. Only the longest windows are counted: each word with the two that follow it in its piece, as lead columns, padded
with '' where the piece ends. The counts of all shorter phrases are sums over them: a phrase of one or two words is the
prefix of the windows that begin with it, so Spark's ROLLUP over (lang, first, second, third) gives every one of them, and
the number of a language's words, from the counts of windows alone. No n-gram of another length is ever extracted.

1. `windows` counts the windows of chunks of documents inside tasks, words as they are (no fingerprint decides anything).
   A chunk's counts travel as blocks, one per bucket and language: the words once, the windows as numbers. The number of
   buckets follows the bytes of the texts.
2. The bucket of a window is a hash of its first two words, where the blocks of all chunks are added up. There a window
   that occurs less than `least` times is folded into its pair, and a pair that does into its word, since no candidate
   and no part of one is lost with it; sums over prefixes stay what they were, and few rows are left to roll up.
3. A pair that holds a 64th of a chunk is scattered instead, by a hash of all three words. Its own bucket gets a mark for
   it, and neither place folds it. So a pair may hold a third of all words; a window that does is one number per chunk.
4. `phrases` rolls the windows up and keeps what occurs `least` times, the parts of a candidate being as frequent as it.
5. `collocations` looks the parts of every candidate up (one join, the phrases looked up salted, since a frequent word is
   part of many), takes its lowest cut, and drops candidates that a longer one covers. Products are decimals of 38 digits,
   exact up to counts of 10^16.

Defined cases. A null text is empty, a null lang is `und`, as is the lang `und` itself. Texts without words, and empty
tables, give no rows. Repeated rows and repeated or null ids count as often as they occur: ids play no part. Texts of any
length are taken whole: a chunk ends at the first document beyond `chunk_bytes`. Other columns are not read. Ties in score
and count are in byte order of the phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import mixed, word_prints, written

LEAST = 10  # occurrences of a candidate
COVERED = 50  # percent of its occurrences in a longer candidate that drop it
TOP = 2000
SALTS = 4
#: A pair with more than this share of a chunk's windows, and more of them than this, is scattered.
HOT_SHARE, HOT_COUNT = 1 / 64, 1000

_SPACE, _STOP = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _SPACE
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = _STOP
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TURN = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
) -> DataFrame:
    """The `top` phrases of two and three words of every language, with rank, counts and score."""
    found = written(phrases(windows(documents, least, text, lang), least), "phrases")
    candidates = found.where("second <> ''").select(
        "lang", _joined("first", "second", "third").alias("phrase"), "first", "second", "third", "a"
    )
    totals = found.where("first is not null").select("lang", _joined("first", "second", "third").alias("part"), F.col("a").alias("f"))
    triples = candidates.where("third <> ''")
    # Each cut of a candidate asks for the counts of its two parts.
    part = lambda name, *words: F.struct(F.lit(name).alias("as"), _joined(*words).alias("part"))
    two = F.array(part("l1", "first"), part("r1", "second"))
    three = F.array(part("l1", "first"), part("r1", "second", "third"), part("l2", "first", "second"), part("r2", "third"))
    asked = candidates.select(
        "lang", "phrase", "a", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"),
        F.inline(F.when(F.col("third") == "", two).otherwise(three)),
    )
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    answered = asked.join(salted, ["lang", "part", "salt"]).select("lang", "phrase", "a", "as", "f")
    covers = triples.select(
        "lang", F.explode(F.array(_joined("first", "second"), _joined("second", "third"))).alias("phrase"), F.col("a").alias("longer")
    )
    of = lambda name: F.max(F.when(F.col("as") == name, F.col("f"))).alias(name)
    cuts = (
        answered.unionByName(covers, allowMissingColumns=True)
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("a"), F.max("longer").alias("longer"), *(of(name) for name in ("l1", "r1", "l2", "r2")))
        .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
        .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    )
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    scored = cuts.select(
        "lang", "phrase", "a",
        F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First within parts of a language, so that one task gets at most SALTS times `top` rows of it.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    for keys in (["lang", salt], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(*best)
        scored = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = found.where("first is null").select("lang", F.col("a").alias("n"))
    return scored.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _joined(*words: str) -> Column:
    """The words, space-joined, without the padding."""
    return F.rtrim(F.concat_ws(" ", *words))


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    big = lambda name: f"cast({name} as decimal(38, 0))"
    return F.expr(f"({big(a)} * {big(a)} * 1000000) div ({big(l)} * {big(r)})").cast("long")


def phrases(counted: DataFrame, least: int = LEAST) -> DataFrame:
    """Phrases of one to three words with at least `least` occurrences `a`; absent words are ''.

    The row of a language without a first word holds the number of all its words.
    """
    rolled = counted.rollup("lang", "first", "second", "third").agg(
        F.sum("n").cast("long").alias("a"), F.grouping_id().alias("level")
    )
    # Levels are 0 (three words), 1 (two), 3 (one) and 7 (the language); with padding it is a shorter phrase again.
    level, frequent = F.col("level"), F.col("a") >= least
    return rolled.where(
        (level == 7)
        | ((level == 3) & frequent)
        | ((level == 1) & frequent & (F.col("second") != ""))
        | ((level == 0) & frequent & (F.col("third") != ""))
    ).select("lang", "first", *(F.coalesce(c, F.lit("")).alias(c) for c in ("second", "third")), "a")


def windows(
    documents: DataFrame,
    least: int = LEAST,
    text: str = "text",
    lang: str = "lang",
    chunk_bytes: int = 8_000_000,
    bucket_bytes: int = 8_000_000,
) -> DataFrame:
    """How often (`n`) each word `first` is followed by `second` and `third` in a piece, per `lang`.

    A window may come in several rows. What occurs less than `least` times is folded into a shorter one.
    """
    rows = documents.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, math.ceil(size / bucket_bytes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        langs: list[str] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for name, one in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    langs.append(name)
                    texts.append(one)
                    held += len(one)
                    if held >= chunk_bytes:
                        yield from _blocks(texts, langs, buckets)
                        texts, langs, held = [], [], 0
        if texts:
            yield from _blocks(texts, langs, buckets)
        pa.default_memory_pool().release_unused()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["bucket"], row["lang"], row["scattered"]) != key:
                    yield from _added(key, held, least)
                    key, held = (row["bucket"], row["lang"], row["scattered"]), []
                held.append(row)
        yield from _added(key, held, least)
        pa.default_memory_pool().release_unused()

    blocks = rows.mapInArrow(count, _BLOCKS)
    summed = (
        blocks.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "lang", "scattered")
        .mapInArrow(add, "lang string, first binary, second binary, third binary, n long")
    )
    return summed.select("lang", *(F.col(c).cast("string").alias(c) for c in ("first", "second", "third")), "n")


def _words(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a text, lower-cased, with the number of the piece each is in and the place it starts at."""
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    kind = _CLASS[raw]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = kind == 0
    turn = np.diff(inside)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    del inside, turn
    piece = np.searchsorted(np.flatnonzero(kind == _STOP), starts).astype(np.int32)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    kept = raw[kind == 0]
    del raw, kind
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return words, piece, starts


def _blocks(texts: list[bytes], langs: list[str], buckets: int) -> Iterator[pa.RecordBatch]:
    """The counted windows of these texts: one row per bucket and language."""
    words, piece, starts = _words(b"\n".join(texts))
    if not len(words):
        return
    coded = words.dictionary_encode()
    known = coded.dictionary
    first = coded.indices.to_numpy(zero_copy_only=False) + np.int32(1)  # 0 is the padding
    del words, coded
    # The lead columns: the next word and the one after it, while the piece lasts.
    second, third = np.zeros_like(first), np.zeros_like(first)
    second[:-1] = np.where(piece[1:] == piece[:-1], first[1:], 0)
    third[:-2] = np.where(piece[2:] == piece[:-2], first[2:], 0)
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    ends = np.cumsum([len(x) + 1 for x in texts])
    of_text = np.array([number[name] for name in langs], np.int32)
    spoken = of_text[np.searchsorted(ends, starts, side="right")]
    del piece, starts
    prints = np.concatenate(([np.uint64(0)], word_prints(*_bytes(known))))
    limit = max(HOT_COUNT, len(first) * HOT_SHARE)
    for i, name in enumerate(names):
        mine = spoken == i
        if not mine.any():
            continue
        a, b, c, n = _counted(first[mine], second[mine], third[mine], len(known) + 1)
        pair = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        hot = (np.add.reduceat(n, pair) > limit) & (b[pair] > 0)
        home = mixed(prints[a[pair]] * _TURN[0] + prints[b[pair]] * _TURN[1])
        size = np.diff(pair, append=len(n))
        far = np.repeat(hot, size)
        # Marks for the pairs that are scattered: a word beyond all others.
        marks = (a[pair][hot], b[pair][hot], np.full(int(hot.sum()), len(known) + 1), np.ones(int(hot.sum()), np.int64))
        near = tuple(np.concatenate([x[~far], y]) for x, y in zip((a, b, c, n), marks, strict=True))
        yield from _dealt(np.concatenate([np.repeat(home, size)[~far], home[hot]]), buckets, name, False, known, near)
        if hot.any():
            spread = mixed(np.repeat(home, size)[far] + prints[c[far]] * _TURN[2])
            yield from _dealt(spread, buckets, name, True, known, tuple(x[far] for x in (a, b, c, n)))


def _dealt(
    hashed: np.ndarray, buckets: int, lang: str, scattered: bool, known: pa.Array, counts: tuple[np.ndarray, ...]
) -> Iterator[pa.RecordBatch]:
    bucket = (hashed % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in range(buckets):
        at = order[edges[k] : edges[k + 1]]
        if len(at):
            yield _packed(k, lang, scattered, known, np.stack([x[at] for x in counts[:3]]), counts[3][at])


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of these words, and where each starts and ends."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(words.buffers()[2] or b"", np.uint8), offsets[:-1], offsets[1:]


def _counted(a: np.ndarray, b: np.ndarray, c: np.ndarray, size: int, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The different triples of numbers below `size`, in order, and how often each occurs (n: the count of each given one)."""
    base, pairs = np.int64(size), None
    key = a.astype(np.int64) * base + b
    if size >= 1 << 21:  # three numbers do not fit into one: the pairs that occur are numbered first
        pairs, key = np.unique(key, return_inverse=True)
    key = key * base + c
    if n is None:
        key.sort()
    else:
        order = np.argsort(key)
        key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(first, append=len(key)) if n is None else np.add.reduceat(n, first)
    key, c = np.divmod(key[first], base)
    a, b = np.divmod(key if pairs is None else pairs[key], base)
    return a, b, c, n


def _folded(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray, kept: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Windows below `least` as their pairs, pairs below it as their words; those in `kept` as they are."""
    c = np.where((n < least) & ~kept, 0, c)
    pair = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    rare = np.repeat(np.add.reduceat(n, pair) < least, np.diff(pair, append=len(n))) & ~kept
    b = np.where(rare, 0, b)
    # Folded windows of one pair, or word, are not always neighbours now; Spark adds up what is left.
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1]))))
    return a[first], b[first], c[first], np.add.reduceat(n, first)


def _planes(numbers: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, the low bytes of all first, packed."""
    wide = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(wide.tobytes(), codec="zstd", asbytes=True)


def _numbers(packed: bytes, size: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(packed, decompressed_size=4 * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, size).T).view("<u4").reshape(size).astype(np.int64)


_BLOCKS = "bucket int, lang string, scattered boolean, n_words int, n_windows int, sizes binary, words binary, windows binary"


def _packed(bucket: int, lang: str, scattered: bool, known: pa.Array, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One block: the words its windows use, and the windows, with the first word as a difference.

    Numbers are 0 for the padding, then the words, and the one after them for the mark of a scattered pair.
    """
    used, place = np.unique(codes.astype(np.int32), return_inverse=True)
    at = used[(used > 0) & (used <= len(known))] - 1
    # Places in `used`, which may lack the padding, become numbers of this block.
    codes = place.reshape(3, -1) + (used[0] > 0)
    order = np.argsort(codes[0], kind="stable")
    codes, n = codes[:, order], n[order]
    raw, starts, ends = _bytes(known.take(pa.array(at)))
    windows = _planes(np.concatenate([np.diff(codes[0], prepend=0), codes[1], codes[2], n]))
    words = pa.compress(raw[: int(ends[-1]) if len(ends) else 0].tobytes(), codec="zstd", asbytes=True)
    row = [bucket, lang, scattered, len(at), len(n), _planes(ends - starts), words, windows]
    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names)


def _added(key: tuple[int, str, bool] | None, blocks: list[dict], least: int) -> Iterator[pa.RecordBatch]:
    """The windows of one bucket and language, added up over its blocks, and folded."""
    if key is None:
        return
    lists = []
    for row in blocks:
        ends = np.concatenate(([0], np.cumsum(_numbers(row["sizes"], row["n_words"])))).astype(np.int32)
        raw = pa.decompress(row["words"], decompressed_size=int(ends[-1]), codec="zstd")
        lists.append(pa.Array.from_buffers(pa.binary(), row["n_words"], [None, pa.py_buffer(ends), raw]))
    coded = pa.concat_arrays(lists).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False) + np.int32(1)
    mark, at, parts = len(coded.dictionary) + 1, 0, []
    del lists
    for row in blocks:
        place = np.concatenate(([0], numbers[at : at + row["n_words"]], [mark])).astype(np.int32)
        at += row["n_words"]
        steps, b, c, n = _numbers(row.pop("windows"), 4 * row["n_windows"]).reshape(4, -1)
        parts.append((place[np.cumsum(steps)], place[b], place[c], n))
    a, b, c, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    a, b, c, n = _counted(a, b, c, mark + 1, n)
    kept = np.full(len(n), key[2])
    if not key[2]:
        marked = c == mark
        pair = np.cumsum(np.concatenate(([False], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        kept = np.isin(pair, pair[marked])
        a, b, c, n, kept = (x[~marked] for x in (a, b, c, n, kept))
    if not len(n):
        return
    a, b, c, n = _folded(a, b, c, n, kept, least)
    words = pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary])
    for i in range(0, len(n), 50_000):
        cut = slice(i, i + 50_000)
        strings = [words.take(pa.array(x[cut])) for x in (a, b, c)]
        lang = pa.array([key[1]], pa.string()).take(pa.array(np.zeros(len(n[cut]), np.int64)))
        yield pa.RecordBatch.from_arrays([lang, *strings, pa.array(n[cut], pa.int64())], ["lang", "first", "second", "third", "n"])
