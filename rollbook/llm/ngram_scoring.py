"""Scores of texts under a three-word model kept as Elias-Fano tries.

The corpus is cut into blocks of about two million tokens, written once: each token as its place in the block's sorted
vocabulary. What blocks need from each other travels packed, and every text is judged where its contexts are:

1. Vocabulary: each block sends its distinct words, with their training counts, to the part of the fingerprint range
   they belong to. A part adds the counts, numbers its words and answers each block.
2. Contexts: each block sends its distinct sequences of three words, with their training counts, to the part of the word
   in the middle. A part builds a trie of the training sequences it has received, and looks up all sequences in it.
3. Parts answer each block with one sum per text, in single precision, and with one value for each sequence that the block
   holds often, whose texts the block has kept; they are added in double.

The log10 of a probability is a sum of two values (see elias_fano.Trie): one needs what was seen of u w, the other what
was seen of v u, and each is told where that pair is. A word that precedes more tokens than a part should hold can
therefore be split by the word after it, and a score does not depend on parts, blocks or memory settings, but for the
rounding of sums. A sequence that many texts hold, such as a first word that all share or one word repeated, is one row
for each block. What stays together is a pair of words, with a row for each word before it and block. Part numbers come
from the corpus' size; no n-gram is pruned.

Words are 64-bit fingerprints. Two words of one corpus share one with a probability of about n * n / 2 ** 65 for n
distinct words: one in two hundred at 400 million.

Defined cases: a null or empty text is its end alone; rows of one id are scored each by itself; rows without an id are
scored and not learned from; an empty table gives no rows; without training tokens every probability is that of an
unknown word, 0.5 / 0.5 = 1; further columns are ignored. Sums are made in a fixed order.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import mixed, released, word_bounds, word_prints, written
from rollbook.llm.elias_fano import Mapped, Sequence, Trie, _starts, encode

BLOCK_TOKENS = 2_000_000
PART_TOKENS = 1_000_000
PART_WORDS = 1_000_000
WEIGHT = (2000.0, 5.0)  # of the probabilities of single words in those after one, and of these in those after two
OFTEN = 8  # tokens of a sequence in a block beyond which its texts stay in the block
CHUNK = 2_000_000  # bytes of text handled at once
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
END = np.uint64(0x5E4D5E4D5E4D5E4D)  # the end of a text, a token like any word
_NONE, _BEGIN, _FIRST = 0, 1, 2  # numbers before those of words


def _pack(x: np.ndarray) -> bytes:
    """Compressed by byte planes, as neighbours share their high bytes."""
    if x.dtype.itemsize > 4 and x.dtype.kind in "ui" and (not len(x) or int(x.max()) < 2**32):
        x = x.astype(np.uint32)
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()
    head = f"{x.dtype.str},{len(x)};".encode()
    return head + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unpack(data: bytes) -> np.ndarray:
    head, _, body = data.partition(b";")
    kind, n = head.decode().split(",")
    dtype, n = np.dtype(kind), int(n)
    if not n:
        return np.zeros(0, dtype)
    raw = np.frombuffer(pa.decompress(body, n * dtype.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(dtype.itemsize, n).T).view(dtype).ravel()


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all tokens, each text's end included, and the number of tokens of each text."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    starts, ends = word_bounds(raw)
    breaks = np.cumsum([len(x) + 1 for x in texts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, breaks))))
    prints = np.full(len(starts) + len(texts), END, np.uint64)
    places = np.arange(len(starts)) + np.repeat(np.arange(len(texts)), counts)
    prints[places] = word_prints(raw, starts, ends)
    return prints, counts + 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, train, prints, sizes, total = [], [], [], [], 0
    kind = None

    def out() -> pa.RecordBatch:
        own = np.concatenate(sizes)
        vocabulary, tokens = np.unique(np.concatenate(prints), return_inverse=True)
        learned = np.repeat(np.array(train, bool), own)
        counts = np.bincount(tokens[learned], minlength=len(vocabulary))
        row = {
            "block": pa.array([uuid.uuid4().hex]),
            "ids": pa.array([ids], pa.list_(kind)),
            "n_words": pa.array([len(vocabulary)], pa.int64()),
            "n_tokens": pa.array([int(learned.sum())], pa.int64()),
            "n_texts": pa.array([int(sum(train))], pa.int64()),
        } | {
            k: pa.array([_pack(x)], pa.binary())
            for k, x in (
                ("train", np.array(train, np.uint8)), ("sizes", own.astype(np.uint32)),
                ("vocabulary", np.diff(vocabulary, prepend=np.uint64(0))),
                ("counts", counts), ("tokens", tokens.astype(np.uint32)),
            )
        }
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        kind = batch.column(0).type
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        names, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or b"")
            if size >= CHUNK or i + 1 == len(texts):
                got, count = tokens_of([x or b"" for x in texts[first : i + 1]])
                ids += names[first : i + 1]
                train += marks[first : i + 1]
                prints.append(got)
                sizes.append(count)
                total += len(got)
                first, size = i + 1, 0
                if total >= BLOCK_TOKENS:
                    yield out()
                    ids, train, prints, sizes, total = [], [], [], [], 0
    if ids:
        yield out()


def _shares(parts: int):
    """(part, block, vocabulary, counts): each block's words by ranges of their fingerprints."""
    step = 2**64 // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, words, counts = (c[row].as_py() for c in batch.columns)
                words, counts = np.cumsum(_unpack(words).astype(np.uint64)), _unpack(counts)
                edges = np.searchsorted(words, np.array([i * step for i in range(parts)], np.uint64)).tolist() + [len(words)]
                rows = [i for i in range(parts) if edges[i] < edges[i + 1]]
                cuts = [slice(edges[i], edges[i + 1]) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows, pa.int64()), pa.array([block] * len(rows)),
                        pa.array([_pack(np.diff(words[x], prepend=np.uint64(0))) for x in cuts], pa.binary()),
                        pa.array([_pack(counts[x]) for x in cuts], pa.binary()),
                    ],
                    ["part", "block", "vocabulary", "counts"],
                )

    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """Each part with its rows, from batches sorted by part."""
    part, rows = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in batch.columns)
            if row[0] != part:
                if rows:
                    yield part, rows
                part, rows = row[0], []
            rows.append(row[1:])
    if rows:
        yield part, rows


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, block, places, counts), and for each part a row without a block whose counts are (words, known words)."""
    for part, rows in _by_part(batches):
        words = [np.cumsum(_unpack(x).astype(np.uint64)) for _, x, _ in rows]
        merged, where = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(where, np.concatenate([_unpack(x) for _, _, x in rows])).astype(np.int64)
        level = Sequence(Mapped(encode("words", merged, 2**64 - 1)).arrays, "words")
        known = int((totals > 0).sum())
        out = [(part, None, b"", _pack(np.array([len(merged), known], np.uint64)))]
        for (block, _, _), own in zip(rows, words, strict=True):
            places = level.find(own)
            out.append((part, block, _pack(places), _pack(totals[places])))
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["part", "block", "places", "counts"]
        )


def _sequences(parts: int, offsets: dict[int, int], n: int, v: int, texts: int, share: int, ids_type: pa.DataType):
    """(part, block, docs, data, ids, base): sequences by part, and a row of each block's own with negative part."""
    names = ["part", "block", "docs", "data", "ids"]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(ids_type))
    whole = n + 0.5 * (v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, ids, train, sizes, tokens, answers = (c[row].as_py() for c in batch.columns)
                train, sizes, tokens = _unpack(train), _unpack(sizes).astype(np.int64), _unpack(tokens).astype(np.int32)
                answers = sorted((a["part"], a["places"], a["counts"]) for a in answers)
                number = np.concatenate([_unpack(p).astype(np.int64) + offsets[k] for k, p, _ in answers]) + _FIRST
                count = np.concatenate([_unpack(c).astype(np.int64) for _, _, c in answers])
                w, c = number[tokens], count[tokens]
                doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                base = np.bincount(doc, np.log10((c + 0.5) / whole), len(sizes))
                own = np.stack((sizes.astype(float), np.bincount(doc, c > 0, len(sizes)), base, train.astype(float)))
                end = w[-1]  # the last of every text

                u = np.concatenate(([_BEGIN], w[:-1]))
                u[first] = _BEGIN
                before = np.concatenate(([texts], c[:-1]))
                before[first] = texts
                del c, answers
                bucket = mixed(w.astype(np.uint64))
                del w
                bucket %= (1 + before // share).astype(np.uint64)
                del before
                bucket += u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                del u
                part = (mixed(bucket) % np.uint64(parts)).astype(np.int32)
                del bucket
                # From here on words are known by their places in the block, after the two that begin a text.
                number = np.concatenate(([_NONE, _BEGIN], number))
                count = np.concatenate(([0, texts], count))
                w = tokens + np.int32(2)
                del tokens
                u = np.concatenate(([1], w[:-1])).astype(np.int32)
                u[first] = 1
                x = np.concatenate(([0], u[:-1])).astype(np.int32)
                x[first] = 0
                bits = int(len(number)).bit_length()
                key = (u.astype(np.int64) << bits) | w
                if parts.bit_length() + 2 * bits <= 63:
                    key |= part.astype(np.int64) << (2 * bits)
                    order = np.lexsort((x, key))
                else:
                    order = np.lexsort((x, key, part))
                del key
                order = order.astype(np.int32)
                u, w, x, doc, part = u[order], w[order], x[order], doc[order], part[order]
                del order
                # Distinct sequences, sorted by part, u, w, x, and the texts of each.
                at = _starts(part, u, w, x)
                tokens_of_each = np.diff(np.append(at, len(u)))
                seen = np.add.reduceat(train[doc], at, dtype=np.int32)
                often = tokens_of_each > OFTEN
                kept = np.repeat(often, tokens_of_each)
                held = [doc[kept], tokens_of_each[often]]
                doc, own_part = doc[~kept], part[~kept]
                u, w, x, part = u[at], w[at], x[at], part[at]
                del kept, at
                edges = np.searchsorted(part, np.arange(parts + 1))
                doc_edges = np.searchsorted(own_part, np.arange(parts + 1))
                body = _packed([own.ravel(), *held])
                rows = [(-1 - int(block[:8], 16) % parts, block, len(sizes), body, ids)]
                marked = np.zeros(len(number), bool)
                place = np.zeros(len(number), np.uint32)
                for i in np.flatnonzero(np.diff(edges)):
                    cut = slice(edges[i], edges[i + 1])
                    own = [y[cut] for y in (u, w, x)]
                    for y in own:
                        marked[y] = True
                    used = np.flatnonzero(marked)
                    marked[used] = False
                    place[used] = np.arange(len(used))
                    small = np.uint16 if len(used) < 2**16 else np.uint32
                    columns = [np.diff(number[used], prepend=0), count[used], *_steps(*(place[y].astype(small) for y in own))]
                    columns += [seen[cut], np.where(often[cut], 0, tokens_of_each[cut]).astype(np.uint8)]
                    columns += [doc[doc_edges[i] : doc_edges[i + 1]].astype(np.uint16 if len(sizes) < 2**16 else np.uint32)]
                    rows.append((int(i), block, len(sizes), _packed([*columns, np.array([end])]), None))
                for at in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[j] for r in rows[at : at + 64]], k) for j, k in enumerate(kinds)], names
                    )

    return run


def _steps(u: np.ndarray, w: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted u as steps, w as steps within equal u; they compress better."""
    step = np.diff(u, prepend=u.dtype.type(0))
    same = np.flatnonzero(step[1:] == 0) + 1
    out = w.copy()
    out[same] -= w[same - 1]
    return step, out, x


def _values(step: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of _steps."""
    u = np.cumsum(step, dtype=np.int64)
    total = np.cumsum(w, dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], step[1:] > 0))) if len(u) else np.zeros(0, np.int64)
    before = np.repeat(total[first] - w[first], np.diff(np.append(first, len(u))))
    return u, total - before


def _packed(columns: list[np.ndarray]) -> bytes:
    packed = [_pack(x) for x in columns]
    return ",".join(str(len(x)) for x in packed).encode() + b"\n" + b"".join(packed)


def _columns(body: bytes) -> list[np.ndarray]:
    """The inverse of _packed."""
    head, _, rest = body.partition(b"\n")
    out, at = [], 0
    for size in map(int, head.split(b",")):
        out.append(_unpack(rest[at : at + size]))
        at += size
    return out


def judged(u, w, x, times, count, whole: float, end: int, weight: tuple[float, float]) -> np.ndarray:
    """What each sequence x u w adds to the log10 of its text's probability, under the trie of those with times.

    Words are numbers below len(count), their training counts; end is the number of the end of a text. Rows of one
    sequence add their times. Added is the sequence's own value and, but for the end, that of u w as a context.
    """
    bits = max(1, int(len(count)).bit_length())
    head, above = (u.astype(np.uint64) << np.uint64(bits)) | x.astype(np.uint64), bits
    if 3 * bits > 64:  # pairs are numbered first
        pairs, head = np.unique(head, return_inverse=True)
        head, above = head.astype(np.uint64), 0
    key = (head << np.uint64(bits)) | w.astype(np.uint64)
    del head
    order = np.argsort(key)
    key = key[order]
    at = _starts(key)
    key = key[at]
    times = np.add.reduceat(times[order].astype(np.int64), at)
    mask = np.uint64((1 << bits) - 1)
    w, head = (key & mask).astype(np.int64), key >> np.uint64(bits)
    if not above:
        head = pairs[head.astype(np.int64)]
    u, x = (head >> np.uint64(bits)).astype(np.int64), (head & mask).astype(np.int64)
    del head, key
    single, total = (count[w] + 0.5) / whole, count[u]
    seen = np.flatnonzero(times)
    trie = Trie(x[seen], u[seen], w[seen], single[seen], times[seen], total[seen], weight)
    found, left = trie.log10(x, u, w, single, total)
    found += np.where(w == end, 0.0, left)
    # The context that begins a text is no token of it.
    found += np.where(x == _NONE, np.log10(weight[1] / (total + weight[1])), 0.0)
    out = np.empty(len(order))
    out[order] = np.repeat(found, np.diff(np.append(at, len(order))))
    return out


def _together(each: list[list[np.ndarray]]) -> tuple:
    """u, w, x, counts of training and counts of all blocks' columns, and the end, words numbered in one order."""
    # The two that begin a text are in all parts, so that their numbers stay what they are.
    begin = np.array([_NONE, _BEGIN], np.int64)
    numbers = [np.cumsum(e[0].astype(np.int64)) for e in each]
    merged, first = np.unique(np.concatenate([begin, *numbers]), return_index=True)
    texts = max([int(e[1][n == _BEGIN].max(initial=0)) for e, n in zip(each, numbers, strict=True)])
    count = np.concatenate([np.array([0, texts]), *(e[1] for e in each)]).astype(np.int64)[first]
    places = [np.searchsorted(merged, x).astype(np.int32) for x in numbers]
    values = [(*_values(e[2], e[3]), e[4]) for e in each]
    u, w, x = (np.concatenate([p[v[i]] for v, p in zip(values, places, strict=True)]) for i in range(3))
    times = np.concatenate([e[5] for e in each])
    end = int(each[0][8][0])
    at = int(np.searchsorted(merged, end))
    return u, w, x, times, count, at if at < len(merged) and merged[at] == end else -1


def _judgements(whole: float, ids_type: pa.DataType, weight: tuple[float, float]):
    names = ["block", "part", "data", "ids"]
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.list_(ids_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            if part < 0:
                out = [(block, part, data, ids) for block, _, data, ids in rows]
            else:
                each = [_columns(data) for _, _, data, _ in rows]
                u, w, x, times, count, end = _together(each)
                texts = [(e[6], e[7]) for e in each]
                del each
                values = judged(u, w, x, times, count, whole, end, weight)
                out, at = [], 0
                for (block, docs, _, _), (tokens, doc) in zip(rows, texts, strict=True):
                    own = values[at : at + len(tokens)]
                    at += len(tokens)
                    sums = np.bincount(doc, np.repeat(own, tokens), docs)
                    some = np.flatnonzero(sums)
                    body = [some.astype(np.uint32), sums[some].astype(np.float32), own[tokens == 0].astype(np.float32)]
                    out.append((block, part, _packed(body), None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return run


def _sums(ids_type: pa.DataType):
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score", "learned"]
    kinds = (ids_type, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_part(batches):
            part, data, ids = rows[0]
            assert part < 0, "a block's own row comes first"
            own, doc, tokens = _columns(data)
            sizes, known, base, train = own.reshape(4, -1)
            score, often = np.zeros(len(sizes)), []
            for _, data, _ in rows[1:]:
                some, sums, values = _columns(data)
                score[some] += sums
                often.append(values)
            if len(doc):  # parts come in the order in which the block keeps its own
                score += np.bincount(doc, np.repeat(np.concatenate(often).astype(float), tokens), len(sizes))
            values = (ids, sizes.astype(np.int64), known.astype(np.int64), base, score, train > 0)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(values, kinds, strict=True)], names)

    return run


def _schema(**fields: str) -> str:
    return ", ".join(f"{k} {v}" for k, v in fields.items())


def _tasks(n: float, each: int) -> int:
    return max(1, math.ceil(n / each))


def _mapped(frame: DataFrame, run, schema: str) -> DataFrame:
    return frame.mapInArrow(lambda batches: released(run(batches)), schema)


def scores(
    documents: DataFrame, train, part_tokens: int = PART_TOKENS, part_words: int = PART_WORDS,
    weight: tuple[float, float] = WEIGHT,
) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, learned and train_tokens of every text.

    documents: doc_id, text. train: a condition on doc_id; the model learns from the rows that meet it. weight: of shorter
    contexts in longer ones, as so many tokens. The sizes of parts set what a task holds and leave scores as they are.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    arrow = pa.from_numpy_dtype(np.int64) if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    rows = documents.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), F.col("text").cast("string").alias("text"))
    if arrow == pa.string():
        rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
        kind = "string"
    block = _schema(
        block="string", ids=f"array<{kind}>", n_words="long", n_tokens="long", n_texts="long", train="binary",
        sizes="binary", vocabulary="binary", counts="binary", tokens="binary",
    )
    blocks = written(_mapped(rows, _blocks, block), "lm-blocks")
    size = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_texts")).first()
    n_words, n_tokens, n_texts = (x or 0 for x in size)

    parts = _tasks(n_words, part_words)
    shares = _mapped(
        blocks.select("block", "vocabulary", "counts"), _shares(parts),
        _schema(part="long", block="string", vocabulary="binary", counts="binary"),
    )
    shares = shares.repartition(_tasks(n_words, PART_WORDS), "part").sortWithinPartitions("part", "block")
    answers = written(
        _mapped(shares, _answers, _schema(part="long", block="string", places="binary", counts="binary")), "lm-words"
    )
    offsets, at, known = {}, 0, 0
    for row in answers.where("block is null").select("part", "counts").orderBy("part").toLocalIterator():
        own, seen = _unpack(bytes(row["counts"])).tolist()  # a row for each part of a million words
        offsets[row["part"]] = at
        at, known = at + own, known + seen
    answered = answers.where("block is not null").groupBy("block").agg(
        F.collect_list(F.struct("part", "places", "counts")).alias("answers")
    )

    whole = n_tokens + 0.5 * (known + 1)
    parts = _tasks(n_tokens * 1.25, part_tokens)
    sequences = blocks.join(answered, "block").select("block", "ids", "train", "sizes", "tokens", "answers")
    sequences = _mapped(
        sequences,
        _sequences(parts, offsets, n_tokens, known, n_texts, max(1, part_tokens // 4), arrow),
        _schema(part="long", block="string", docs="long", data="binary", ids=f"array<{kind}>"),
    )
    sequences = sequences.repartition(_tasks(n_tokens * 1.25, PART_TOKENS), "part").sortWithinPartitions("part", "block")
    judgements = _mapped(
        sequences, _judgements(whole, arrow, weight), _schema(block="string", part="long", data="binary", ids=f"array<{kind}>")
    )
    summed = _mapped(
        judgements.repartition("block").sortWithinPartitions("block", "part"),
        _sums(arrow),
        _schema(doc_id=kind, n_tokens="long", n_known="long", base_score="double", score="double", learned="boolean"),
    )
    return summed.withColumn("train_tokens", F.lit(n_tokens).cast("long"))


