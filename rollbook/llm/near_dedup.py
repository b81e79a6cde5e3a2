"""Near-duplicate groups by a chosen-path similarity join.

A document's set is its distinct 5-word shingles, as 64-bit fingerprints; a signature holds its minwise token under each
of 96 random orders. Every tree starts with one node that holds all sets. A node chooses, by its own hash, minwise
tokens (four thirds on average, the inverse of the threshold) and sends each set to a child for the value of each
chosen token. Sets that are similar enough keep meeting in at least one child; others part. Small nodes are compared
exhaustively by signatures, large ones branch again, with two tokens each, so that the pairs which have met so far
mostly go on to; independent trees repeat this until a pair at the threshold is met with a probability
of about 0.9999 in nodes that need no further branching, and of at least 0.99 in nodes that branch however far.

1. Sets are computed per document, equal sets become one (copies, however many, are one from here on).
2. The trees' nodes yield, for each cluster of likely links, links to its least member: never all pairs.
3. Connected components of these links say which sets must be compared. Each set travels once, to its component, and
   every likely link between parts not yet joined is confirmed on the full sets. What is confirmed joins.
4. Connected components of the confirmed links are the result.

Hot nodes and components are split before their rows meet: while a node has more than `node_limit` sets, its sets
branch on; a component of more than `group_limit` sets is split by the trees' nodes in the same way. Sets that stay
together through all levels agree in nearly every token, and are dealt to parts that share a common member; those that
the parts have not joined with most of the node then meet all of the node, part by part, so that no pair is left out. What is
broadcast is a bit map of fixed size, which only spares texts that cannot be members.

Defined cases: a null or empty text, or one without words, has the empty set and is linked with nothing; with fewer
than five words the whole sequence is one shingle; equal rows are linked; rows of one id are told apart by their sets,
each row is returned; a component's id is its least doc_id, rows without an id count in groups but name none; an empty
table gives no rows; further columns are ignored unless kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import mixed, per_row, released, shelved, unshelved, window_prints, word_bounds, word_prints, written
from rollbook.llm.components import components

WIDTH = 5
ORDERS = 96  # minwise tokens of a signature
CLOSER = 256  # of the signatures that are compared before full sets are
TREES = 10
DEPTH = 3  # levels before nodes are looked at
FURTHER = 3  # thirds of the nodes with two tokens below that, so that depth costs no pairs
MOST_LEVELS = 9
NUM, DEN = 75, 100  # the similarity from which sets are linked
LIKELY = 0.55  # of signatures: 4.5 standard errors below the threshold
LIKELY_CLOSER = 0.64  # 4 standard errors
_RNG = np.random.default_rng(75)
_SEEDS = _RNG.integers(0, 2**32, CLOSER, dtype=np.uint32)
_MULTS = _RNG.integers(0, 2**31, CLOSER, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BITS = 21


def shingles(raw: bytes) -> np.ndarray:
    """The sorted fingerprints of a text's set."""
    codes = _LOWER[np.frombuffer(raw, np.uint8)]
    words = word_prints(codes, *word_bounds(codes))
    return np.unique(window_prints(words, min(WIDTH, len(words)))) if len(words) else words


def signature(own: np.ndarray, orders: int = ORDERS) -> np.ndarray:
    """The lowest 16 bits of the minwise token under each order."""
    out = np.full(orders, 2**32 - 1, np.uint32)
    low = own.astype(np.uint32)
    for at in range(0, len(low), 8192):
        part = (low[at : at + 8192] ^ _SEEDS[:orders, None]) * _MULTS[:orders, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out.astype(np.uint16)


def name_of(own: np.ndarray) -> bytes:
    return md5(own.tobytes(), usedforsecurity=False).digest()


def branch(nodes: np.ndarray, sets: np.ndarray, tokens: np.ndarray, thirds: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """One level: the children (node, set) of the given (node, set), by the tokens that each node chooses.

    So many thirds of the nodes choose two tokens, the others one. With one third a pair at the threshold has one child
    in common on average, and fewer and fewer pairs have one the deeper they go; with three thirds 1.5, and eight of nine
    pairs always will.
    """
    n = tokens.shape[1]
    first = (mixed(nodes ^ np.uint64(0xA5A5)) % np.uint64(n)).astype(np.int64)
    second = (mixed(nodes ^ np.uint64(0x5A5A)) % np.uint64(n)).astype(np.int64)
    twice = (mixed(nodes ^ np.uint64(0x3C3C)) % np.uint64(3) < thirds) & (first != second)

    def child(at: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        value = tokens[sets[at], chosen[at]].astype(np.uint64)
        return mixed(nodes[at] + (value * np.uint64(n) + chosen[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))

    every, some = np.arange(len(nodes)), np.flatnonzero(twice)
    return np.concatenate((child(every, first), child(some, second))), np.concatenate((sets, sets[some]))


def paths(tokens: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(node, set) at a depth of all trees."""
    n = len(tokens)
    nodes = np.repeat(mixed(np.arange(1, trees + 1, dtype=np.uint64)), n)
    sets = np.tile(np.arange(n), trees)
    for _ in range(depth):
        nodes, sets = branch(nodes, sets, tokens)
    return nodes, sets


def _near(tokens: np.ndarray, rows: np.ndarray, at: int, likely: float) -> np.ndarray:
    return (tokens[rows] == tokens[at]).mean(axis=1) >= likely


def _absorb(tokens: np.ndarray, left: np.ndarray, first: int, likely: float) -> tuple[np.ndarray, np.ndarray]:
    """All rows that likely links reach from left[first], and the rest."""
    todo, left, group = [left[first]], np.delete(left, first), []
    while todo:
        at = todo.pop()
        group.append(at)
        if len(left):
            near = _near(tokens, left, at, likely)
            todo += left[near].tolist()
            left = left[~near]
    return np.array(group), left


def clusters(tokens: np.ndarray, likely: float = LIKELY, most: int = 2048, level: int = 0) -> Iterator[np.ndarray]:
    """Groups (of two or more) of the rows of a node that likely links hold together; a row may be in several.

    Clusters that hold a tenth of a large node are taken out whole: their rows would stay together through any branching.
    If what is left is still large, it branches on.
    """
    left, tried = np.arange(len(tokens)), 0
    while len(left) > most and tried < 8 and level < MOST_LEVELS:
        if _near(tokens, left, left[tried], likely).mean() < 0.1:
            tried += 1
            continue
        group, left = _absorb(tokens, left, tried, likely)
        tried = 0
        yield group
    if len(left) > most and level < MOST_LEVELS:
        nodes, sets = branch(np.full(len(left), np.uint64(level * 7919 + len(left))), np.arange(len(left)), tokens[left], FURTHER)
        order = np.argsort(nodes, kind="stable")
        edges = np.flatnonzero(np.diff(nodes[order])) + 1
        for part in np.split(left[sets[order]], edges):
            if len(part) > 1:
                for group in clusters(tokens[part], likely, most, level + 1):
                    yield part[group]
        return
    while len(left):
        group, left = _absorb(tokens, left, 0, likely)
        if len(group) > 1:
            yield group


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    if DEN * small < NUM * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (small + large - both)


def confirmed(sets: list[np.ndarray]) -> np.ndarray:
    """A component's number for each set: likely links, the likeliest first, are confirmed on the full sets.

    Sets already in one component are not compared again.
    """
    n = len(sets)
    part = np.arange(n)
    if n == 2:
        return np.zeros(2, int) if _linked(*sets) else part
    tokens = np.array([signature(x, CLOSER) for x in sets]).astype(np.uint8)
    for high, low in ((2.0, 0.85), (0.85, 0.75), (0.75, LIKELY_CLOSER)):
        for i in range(n - 1):
            others = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1
            if not len(others):
                continue
            alike = (tokens[others] == tokens[i]).mean(axis=1)
            near = (alike >= low) & (alike < high)
            for j in others[near][np.argsort(-alike[near], kind="stable")]:
                if part[i] != part[j] and _linked(sets[i], sets[j]):
                    part[part == part[j]] = part[i]
    return part


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """The rows of equal first column, from batches sorted by it, as a list of the other columns' values."""
    key, held = None, None
    for batch in batches:
        names = batch.column(0).to_pylist()
        columns = [c.to_pylist() for c in batch.columns[1:]]
        start = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[start]:
                rows = [c[start:i] for c in columns]
                if held is not None and key == names[start]:
                    held = [a + b for a, b in zip(held, rows, strict=True)]
                else:
                    if held is not None:
                        yield held
                    key, held = names[start], rows
                start = i
    if held is not None:
        yield held


def _pairs(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"a": pa.array([x for x, _ in rows], pa.binary()), "b": pa.array([x for _, x in rows], pa.binary())}
    )


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            tokens = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, ORDERS)
            yield from _dealt(*paths(tokens), batch.column(0), tokens)


def _dealt(nodes, sets, names: pa.Array, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = tokens.shape[1]
    short = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(tokens), [None, pa.py_buffer(np.ascontiguousarray(tokens.astype(np.uint8)))]
    ).cast(pa.binary())
    for at in range(0, len(nodes), 20000):
        rows = pa.array(sets[at : at + 20000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[at : at + 20000].view(np.int64)), names.take(rows), short.take(rows)], ["node", "name", "tokens"]
        )


def _further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            nodes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield from _dealt(*branch(nodes, np.arange(len(nodes)), tokens, FURTHER), batch.column(1), tokens)


_ENTRY = "node long, name binary, tokens binary"
_LINK = "a binary, b binary"


def _split(entries: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The entries, those of nodes with more than `limit` sets branched until no node has more.

    At most a `limit`-th of the entries' number can be such nodes. What stays together to the last level is dealt to
    parts at random, each with the node's least member; it is returned, too, with its part, since sets of two parts
    have not met (see `_rest`).
    """
    done = dealt = None
    for level in range(MOST_LEVELS + 1):
        hot = written(entries.groupBy("node").count().where(F.col("count") > limit), "hot")
        if hot.limit(1).count() == 0:
            break
        calm = entries.join(hot, "node", "left_anti")
        done = calm if done is None else done.unionByName(calm)
        entries = entries.join(hot.select("node"), "node").select("node", "name", "tokens")
        if level < MOST_LEVELS:
            entries = written(entries.mapInArrow(_further, _ENTRY), "branched")
        else:
            parts = entries.join(hot, "node").withColumn(
                "part", F.pmod(F.xxhash64("name"), F.ceil(2 * F.col("count") / limit).cast("long"))
            )
            dealt = parts = written(parts.select("node", "part", "name", "tokens"), "dealt")
            least = parts.groupBy("node").agg(F.min(F.struct("name", "tokens")).alias("x"))
            shared = parts.select("node", "part").distinct().join(least, "node").select("node", "part", "x.name", "x.tokens")
            entries = (
                parts.unionByName(shared)
                .select(F.xxhash64("node", "part").alias("node"), "name", "tokens").distinct()
            )
            break
    return (entries if done is None else done.unionByName(entries)), dealt


def _rest(dealt: DataFrame, links: DataFrame, limit: int) -> DataFrame | None:
    """Entries in which every pair of a dealt node meets, but for pairs that `links` have joined; None if there are none.

    Most sets of such a node are joined with each other. Each of the others meets the whole node, so many at a time that
    about `limit` sets meet: where the node holds together that is once more what it holds, and else all pairs of parts.
    """
    joined = components(links).withColumnRenamed("node", "name")
    members = dealt.join(joined, "name", "left").withColumn("root", F.coalesce("root", "name"))
    sizes = members.groupBy("node", "root").agg(F.countDistinct("name").alias("n"))
    main = sizes.groupBy("node").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"))
    others = F.col("all") - F.col("most.n")
    main = main.where(others > 0).select(
        "node", F.col("most.root").alias("main"), F.ceil(2 * others / limit).cast("long").alias("chunks")
    )
    members = members.join(main, "node")
    chunk = F.pmod(F.xxhash64("name", F.lit(1)), F.col("chunks"))
    members = written(members.select("node", "part", "name", "tokens", "chunks", chunk.alias("chunk"), (F.col("root") != F.col("main")).alias("other")), "rest")
    if members.limit(1).count() == 0:
        return None
    all_ = members.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    parts = members.select("node", "part").distinct()
    others = members.where("other").drop("part").join(parts, "node")
    columns = [F.xxhash64("node", "part", "chunk").alias("node"), "name", "tokens"]
    return all_.select(*columns).unionByName(others.select(*columns)).distinct()


def _likely(batches: Iterator[pa.RecordBatch], most: int = 2048) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[bytes, bytes]] = []
    for names, tokens in _runs(batches):
        if len(names) < 2:
            continue
        for group in clusters(np.frombuffer(b"".join(tokens), np.uint8).reshape(len(names), -1), most=most):
            least = min(names[i] for i in group)
            rows += [(least, names[i]) for i in group if names[i] != least]
        if len(rows) > 20000:
            yield _pairs(rows)
            rows = []
    yield _pairs(rows)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[bytes, bytes]] = []
    for names, sets in _runs(batches):
        if len(names) < 2:
            continue
        part = confirmed([np.frombuffer(x, np.uint64) for x in sets])
        for number in np.unique(part):
            group = [names[i] for i in np.flatnonzero(part == number)]
            least = min(group)
            rows += [(least, x) for x in group if x != least]
        if len(rows) > 20000:
            yield _pairs(rows)
            rows = []
    yield _pairs(rows)


def _met(entries: DataFrame, by: str) -> DataFrame:
    """Rows of one key in one task, one after the other."""
    return entries.repartition(by).sortWithinPartitions(by)


def _described(raw: bytes) -> tuple[int, bytes, bytes]:
    own = shingles(raw)
    return len(own), name_of(own), signature(own).tobytes()


def groups(
    documents: DataFrame, keep: list[str], node_limit: int = 50_000, group_limit: int = 8_000, group: str | None = None
) -> DataFrame:
    """The kept columns of each document, n_shingles, and component_id, the least doc_id of its component.

    `group` names a further column that tells components apart where they have the same least id, or none.
    """
    columns = list(dict.fromkeys(["doc_id", *keep]))
    rows = documents.select(shelved(columns).alias("kept"), "text")
    base = per_row(rows, "n_shingles long, name binary, tokens binary", ["kept"], "text", _described)
    base = written(base, "near-sets")  # narrow, unless wide columns are kept
    sets = written(
        base.where("n_shingles > 0").groupBy("name")
        .agg(F.min("kept.k0").alias("doc_id"), F.first("tokens").alias("tokens")),
        "near-distinct",
    )
    entries = sets.select("name", "tokens").mapInArrow(lambda x: released(_entries(x)), _ENTRY)
    entries, dealt = _split(entries, node_limit)
    links = _met(entries, "node").mapInArrow(lambda x: released(_likely(x)), _LINK)
    if dealt is not None:
        links = written(links, "near-met")
        rest = _rest(dealt, links, node_limit)
        if rest is not None:  # compared exhaustively: nothing branches on
            rest = _met(rest, "node").mapInArrow(lambda x: released(_likely(x, 1 << 62)), _LINK)
            links = links.unionByName(rest)
    likely = components(links)
    likely = written(likely.join(sets.select(F.col("name").alias("node"), "doc_id"), "node"), "near-likely")
    sets_of, dealt, found = _sets_of(documents, likely, group_limit)
    links = _met(sets_of, "root").mapInArrow(lambda x: released(_confirm(x)), _LINK)
    if dealt is not None:
        links = written(links, "near-confirmed")
        rest = _rest(dealt, links, group_limit)
        if rest is not None:
            links = links.unionByName(_met(_of_nodes(rest, found), "root").mapInArrow(lambda x: released(_confirm(x)), _LINK))
    root = components(links).select(F.col("node").alias("name"), "root")
    named = written(root.join(sets.select("name", "doc_id"), "name"), "near-roots")
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    linked = named.join(least, "root").select("name", F.col("least").alias("component"), "root")
    # Copies of one set: its least id, found before, is theirs too.
    alone = sets.select("name", F.col("doc_id").alias("own"))
    whole = alone.join(linked, "name", "left").select(
        "name", F.coalesce("component", "own").alias("component_id"), F.coalesce("root", "name").alias("root")
    )
    told = [] if group is None else [F.col("root").alias(group)]
    new = ["n_shingles", "component_id", *([] if group is None else [group])]
    return base.join(whole, "name", "left").select(
        *unshelved("kept", columns, new), "n_shingles", F.coalesce("component_id", "kept.k0").alias("component_id"), *told
    )


def _of_nodes(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(root, name, shingles) of the sets of nodes, which stand for components."""
    nodes = entries.select(F.col("node").cast("string").cast("binary").alias("root"), "name").distinct()
    return nodes.join(found.select("name", "shingles"), "name").select("root", "name", "shingles")


def _sets_of(documents: DataFrame, likely: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(root, name, shingles) of the sets of the likely components, each set once, from one document that has it.

    Then what `_split` has dealt to parts, and the sets that it can be looked up in.
    """
    place = F.crc32(F.concat("node", F.coalesce(F.col("doc_id").cast("string").cast("binary"), F.lit(b"")))) % (1 << _BITS)
    bits = np.zeros(1 << _BITS, bool)  # its size is fixed; a full map spares nothing and loses nothing
    wanted = likely.select(place.cast("int").alias("at")).distinct().toPandas()
    bits[wanted["at"].to_numpy()] = True
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = []
                for doc, raw in zip(
                    batch.column(0).slice(at, 1000).to_pylist(),
                    batch.column(1).slice(at, 1000).cast(pa.binary()).to_pylist(), strict=True,
                ):
                    own = shingles(raw or b"")
                    name = name_of(own)
                    if bits[zlib.crc32(name + (doc or "").encode()) % (1 << _BITS)]:
                        rows.append((name, own.tobytes()))
                yield _pairs(rows).rename_columns(["name", "shingles"])

    texts = documents.select(F.col("doc_id").cast("string").alias("doc"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(lambda x: released(run(x)), "name binary, shingles binary")
    roots = likely.select(F.col("node").alias("name"), "root")
    found = found.join(roots, "name").dropDuplicates(["name"]).select("root", "name", "shingles")
    hot = written(roots.groupBy("root").count().where(F.col("count") > limit), "near-hot")
    if hot.limit(1).count() == 0:
        return found, None, found

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tokens = np.array([signature(np.frombuffer(x, np.uint64)) for x in batch.column(1).to_pylist()])
                yield from _dealt(*paths(tokens), batch.column(0), tokens)

    found = written(found, "near-found")
    entries, dealt = _split(found.join(hot, "root", "left_semi").select("name", "shingles").mapInArrow(deal, _ENTRY), limit)
    return found.join(hot, "root", "left_anti").unionByName(_of_nodes(entries, found)), dealt, found
