"""Language of a text by hierarchical discrimination: the family first, then the language within it.

Method. A text is lower-cased, everything but letters becomes one space, and runs of two, three and four bytes are hashed
into `WIDTH` places; the features are the square roots of their shares, a vector of length one. Languages whose mean
vectors are alike are a family (average linkage, down to the mean likeness of all pairs of languages). One-versus-one
linear support vector machines tell the families apart, and within each family its languages; a class wins by votes, ties
by the sum of its margins. A text meets the machines of the families and those of one family only.

Each machine is fitted (dual coordinate descent of the hinge loss, rows in the order of their hashes) by one task on at most
`2 * PER_CLASS` texts: for each language, PER_CLASS different texts by hash, found in two narrow passes. The driver gets the
counts of languages, their mean vectors and the weights, all bounded by `LANGUAGES`. Predicting is one pass without shuffle.

Defined cases. A text that is null or has no letter is `und` with score 0, and nothing is learned from it. A null lang is
not learned from; any other value, `und` too, is a language like others. Where nothing is learned, every text is `und`; where
one language is, every text with a letter is that one, with score 1. Repeated rows and ids are predicted each; equal texts of
one language are one text to learn from. Texts are read whole, in blocks of `_BLOCK` bytes. Beyond LANGUAGES languages the most
frequent ones are learned, ties by name. Columns to keep may have any name that differs from the new ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import per_row, written

UNKNOWN = "und"
WIDTH = 1 << 14
PER_CLASS = 400
LANGUAGES = 100
FAMILY = 12  # languages of a family at most
COST, EPOCHS = 10.0, 30
_BLOCK = 4_000_000
_PLACE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
# Bytes of ASCII letters and of all other scripts stay; the rest is space.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Node:
    """Classes told apart by one machine per pair: weights has a row for each, the bias last."""

    classes: tuple[str, ...]
    pairs: tuple[tuple[int, int], ...]
    weights: np.ndarray

    def decide(self, x: np.ndarray) -> tuple[int, float]:
        """The winning class, and its least margin over another."""
        if len(self.classes) == 1:
            return 0, np.inf
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        votes, sums = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        least = np.full(len(self.classes), np.inf)
        for (a, b), m in zip(self.pairs, margins, strict=True):
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
            least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(range(len(votes)), key=lambda i: (votes[i], sums[i], -i))
        return best, float(least[best])


@dataclass(frozen=True)
class Model:
    families: tuple[tuple[str, ...], ...]
    root: Node | None
    within: tuple[Node, ...]

    def predict(self, text: str | None) -> tuple[str, float]:
        if self.root is None or not text or not has_letter(text):
            return UNKNOWN, 0.0
        x = features(text)
        family, outer = self.root.decide(x)
        language, inner = self.within[family].decide(x)
        margin = min(outer, inner)
        # Margins beyond one are as sure as can be; zero is undecided.
        score = 1.0 if margin == np.inf else float(1 / (1 + np.exp(-4 * margin)))
        return self.families[family][language], score


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte runs."""
    raw = _LETTERS[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8)]
    space = raw == 0x20
    raw = raw[~(space & np.concatenate(([False], space[:-1])))]
    counts = np.zeros(WIDTH, np.int64)
    for start in range(0, max(1, len(raw) - 1), _BLOCK):
        block = raw[start : start + _BLOCK + 3].astype(np.uint64)  # runs that begin in this block
        for width, factor in zip((2, 3, 4), _PLACE, strict=True):
            n = min(_BLOCK, len(block) - width + 1)
            if n <= 0:
                continue
            code = np.full(n, np.uint64(width))
            for j in range(width):
                code = (code << np.uint64(8)) | block[j : j + n]
            place = (code * factor) >> np.uint64(50)  # WIDTH has 14 bits
            counts += np.bincount(place.astype(np.int64), minlength=WIDTH)
    total = counts.sum()
    return np.sqrt(counts / max(total, 1)).astype(np.float32)


# --- learning ---


def train(documents: DataFrame, learned: Column, text: str = "text", lang: str = "lang", per_class: int = PER_CLASS) -> Model:
    """A model of the languages of the documents that `learned` holds for."""
    rows = documents.where(learned & F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")
    )
    # A text with a letter, by Java's classes; has_letter decides once texts are read.
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    counts = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).collect()
    if not counts:
        return Model((), None, ())
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(1.0, 4.0 * per_class / r["count"]))))
    # Texts by a threshold on their hash first, so that few rows move, then exactly per_class of them at most.
    drawn = rows.where(F.pmod(F.xxhash64("hash"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).select("lang", "hash").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("hash"), "hash")
    drawn = drawn.withColumn("number", F.row_number().over(order)).where(F.col("number") <= per_class)
    texts = rows.join(F.broadcast(drawn), ["lang", "hash"]).groupBy("lang", "hash", "number").agg(F.first("text").alias("text"))
    sample = written(texts.mapInArrow(_featured, "lang string, hash long, number int, places binary, shares binary"), "language-sample")
    means = {r["lang"]: np.frombuffer(r["mean"], np.float32) for r in sample.groupBy("lang").applyInPandas(_mean, "lang string, mean binary").collect()}
    families = tuple(tuple(f) for f in _families(means))
    return _fitted(sample, families, per_class)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [features(text) for text in batch.column(3).to_pylist()]
        places = [np.flatnonzero(x).astype("<i4") for x in vectors]
        columns = [pa.array([p.tobytes() for p in places], pa.binary())]
        columns.append(pa.array([x[p].astype("<f4").tobytes() for x, p in zip(vectors, places, strict=True)], pa.binary()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["lang", "hash", "number", "places", "shares"])


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(WIDTH)
    for places, shares in zip(rows["places"], rows["shares"], strict=True):
        total[np.frombuffer(places, "<i4")] += np.frombuffer(shares, "<f4")
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "mean": [(total / len(rows)).astype(np.float32).tobytes()]})


def _families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages joined while the likeness of two groups is at least the mean likeness of all pairs of languages."""
    names = sorted(means)
    if not names:
        return []
    unit = np.stack([means[x] / max(np.linalg.norm(means[x]), 1e-9) for x in names]).astype(np.float64)
    alike = unit @ unit.T
    least = alike[np.triu_indices(len(names), 1)].mean() if len(names) > 1 else 0.0
    groups = [[i] for i in range(len(names))]
    while True:
        pairs = [
            (alike[np.ix_(groups[a], groups[b])].mean(), -a, -b)
            for a in range(len(groups))
            for b in range(a + 1, len(groups))
            if len(groups[a]) + len(groups[b]) <= FAMILY
        ]
        if not pairs or max(pairs)[0] < least - 1e-12:
            return [[names[i] for i in group] for group in groups]
        _, a, b = max(pairs)
        groups[-a] = sorted(groups[-a] + groups[-b])
        del groups[-b]


def _fitted(sample: DataFrame, families: tuple[tuple[str, ...], ...], per_class: int) -> Model:
    """One machine per pair of families, and per pair of languages of a family, each by a task of its own."""
    nodes = [[f"{i}" for i in range(len(families))], *families]
    members = [{f"{i}": family for i, family in enumerate(families)}, *({x: (x,) for x in family} for family in families)]
    problems = []
    for node, (classes, of) in enumerate(zip(nodes, members, strict=True)):
        for a in range(len(classes)):
            for b in range(a + 1, len(classes)):
                for side, name in ((1, classes[a]), (-1, classes[b])):
                    share = -(-per_class // len(of[name]))  # of each language of the class
                    problems += [(node, a, b, side, x, share) for x in of[name]]
    weights: dict[tuple[int, int, int], np.ndarray] = {}
    if problems:
        asked = sample.sparkSession.createDataFrame(problems, "node int, a int, b int, side int, lang string, share int")
        rows = sample.join(F.broadcast(asked), "lang").where(F.col("number") <= F.col("share"))
        fitted = rows.groupBy("node", "a", "b").applyInPandas(_machine, "node int, a int, b int, weights binary")
        weights = {(r.node, r.a, r.b): np.frombuffer(r.weights, np.float32) for r in fitted.collect()}

    def made(node: int, classes: list[str] | tuple[str, ...]) -> Node:
        pairs = tuple((a, b) for a in range(len(classes)) for b in range(a + 1, len(classes)))
        rows = [weights[node, a, b] for a, b in pairs]
        return Node(tuple(classes), pairs, np.stack(rows) if rows else np.zeros((0, WIDTH + 1), np.float32))

    return Model(families, made(0, nodes[0]), tuple(made(i + 1, family) for i, family in enumerate(families)))


def _machine(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["hash", "lang"])
    vectors = [(np.frombuffer(p, "<i4"), np.frombuffer(s, "<f4").astype(np.float64)) for p, s in zip(rows["places"], rows["shares"], strict=True)]
    weights = machine(vectors, rows["side"].to_numpy())
    first = rows.iloc[0]
    return pd.DataFrame({"node": [first["node"]], "a": [first["a"]], "b": [first["b"]], "weights": [weights.astype(np.float32).tobytes()]})


def machine(vectors: list[tuple[np.ndarray, np.ndarray]], sides: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights and bias of a linear support vector machine, by dual coordinate descent; classes weigh the same."""
    rng = np.random.default_rng(20240311)
    w = np.zeros(WIDTH + 1)
    alpha = np.zeros(len(vectors))
    share = {side: np.mean(sides == side) for side in (1, -1)}
    limit = np.array([cost * 0.5 / max(share[int(s)], 1e-9) for s in sides])
    norm = [float(s @ s) + 1.0 for _, s in vectors]
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(vectors)):
            place, value = vectors[i]
            y = float(sides[i])
            slope = y * (w[place] @ value + w[-1]) - 1.0
            to = min(max(alpha[i] - slope / norm[i], 0.0), limit[i])
            step = to - alpha[i]
            if step:
                alpha[i] = to
                w[place] += step * y * value
                w[-1] += step * y
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w


# --- predicting ---


def predict(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns with lang_pred and score."""
    def of(raw: bytes) -> tuple[str, float]:
        return model.predict(raw.decode("utf-8", "replace"))

    return per_row(documents, "lang_pred string, score double", keep, text, of)
