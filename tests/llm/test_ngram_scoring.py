import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollbook.llm import ngram_scoring as lm
from rollbook.llm.elias_fano import STEP, Mapped, Sequence, Trie, encode, quantise


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), max_size=200), st.integers(0, 62), st.lists(st.integers(0, 2**63 - 1), max_size=30))
def test_sequences(values, shift, others):
    x = np.sort(np.array(values, np.uint64) >> np.uint64(shift))
    own = Sequence(Mapped(encode("s", x, int(x[-1]) + 1 if len(x) else 1)).arrays, "s")
    assert (own.get(np.arange(len(x))) == x).all()
    asked = np.concatenate((x, np.array(others, np.uint64) >> np.uint64(shift)))
    assert (own.successor(asked) == np.searchsorted(x, asked)).all()
    found = own.find(asked)
    assert ((found >= 0) == np.isin(asked, x)).all() and (x[found[found >= 0]] == asked[found >= 0]).all()


def test_sequences_are_small():
    x = np.sort(np.random.default_rng(0).integers(0, 2**40, 100_000, dtype=np.uint64))
    arrays = encode("s", x, 2**40)
    bits = 8 * (arrays["s.high"].nbytes + arrays["s.low"].nbytes + arrays["s.ones"].nbytes) / len(x)
    assert bits < 2 + math.log2(2**40 / len(x)) + 3


def test_quantised_values_are_near():
    x = np.random.default_rng(0).normal(size=5000) * 5
    codes = quantise(x)
    assert codes.itemsize == 2 and np.abs(codes * STEP - x).max() <= STEP / 2
    assert (quantise(x[:10]) == codes[:10]).all()  # whatever else is there


def grams(tokens):
    v, u, w = tokens[:-2], tokens[1:-1], tokens[2:]
    rows, times = np.unique(np.stack((u, v, w), 1), axis=0, return_counts=True)
    return rows[:, 1], rows[:, 0], rows[:, 2], times


def test_trie_against_a_plain_model():
    rng = np.random.default_rng(1)
    tokens = rng.zipf(1.5, 6000) % 40
    seen = tokens[:4500]
    counts = Counter(seen.tolist())
    single = np.array([(counts.get(i, 0) + 0.5) / (len(seen) + 0.5 * 41) for i in range(60)])
    v, u, w, times = grams(seen)
    # A pair is known in full: the first two tokens are no third word of a sequence.
    total = np.bincount(u, times, 60)
    trie = Trie(v, u, w, single[w], times, total[u], (4.0, 2.0))
    two = Counter(zip(seen[1:-1].tolist(), seen[2:].tolist()))
    three = Counter(zip(seen[:-2].tolist(), seen[1:-1].tolist(), seen[2:].tolist()))

    def plain(a, b, c):
        p = (two[b, c] + 4 * single[c]) / (total[b] + 4)
        return math.log10((three[a, b, c] + 2 * p) / 2), math.log10(2 / (two[b, c] + 2))

    v, u, w, _ = grams(np.append(tokens, [50, 55, 1]))
    got = np.stack(trie.log10(v, u, w, single[w], total[u]), 1)
    want = np.array([plain(*x) for x in zip(v.tolist(), u.tolist(), w.tolist())])
    assert np.abs(got - want).max() <= STEP / 2 + 1e-9


def test_packing():
    for x in (np.zeros(0, np.uint64), np.array([2**63, 1], np.uint64), np.arange(1000, dtype=np.uint32), np.array([0.5, -1.0])):
        assert (lm._unpack(lm._pack(x)) == x).all()
    u = np.array([0, 0, 0, 3, 3, 9], np.uint16)
    w = np.array([5, 7, 7, 1, 4, 0], np.uint16)
    steps = lm._steps(u, w, w)
    assert [x.tolist() for x in lm._values(*steps[:2])] == [u.tolist(), w.tolist()]


def plain_base(rows, learned):
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in enumerate(t for _, t in rows)}
    counts = Counter(x for i, w in tokens.items() if learned[i] for x in w)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens[i]) for i in tokens]
    return n, [(len(tokens[i]), sum(counts[x] > 0 for x in tokens[i]), b) for i, b in enumerate(base)]


def plain_scores(rows, learned, weight=lm.WEIGHT):
    """Base and score of every text under the model of the whole corpus, without parts, tries or rounding."""
    n, base = plain_base(rows, learned)
    tokens = [["<none>", "<begin>", *(t or "").encode().lower().split(), None] for _, t in rows]
    seen = [x for x, known in zip(tokens, learned, strict=True) if known]
    one, two, three = (Counter(tuple(x[i - k : i + 1]) for x in seen for i in range(2, len(x))) for k in range(3))
    after = Counter(x[i] for x in seen for i in range(1, len(x) - 1))
    after_two = Counter(tuple(x[i - 1 : i + 1]) for x in seen for i in range(1, len(x) - 1))
    v = len(one)
    out = []
    for x in tokens:
        total = 0.0
        for i in range(2, len(x)):
            p = (one[(x[i],)] + 0.5) / (n + 0.5 * (v + 1))
            p = (two[tuple(x[i - 1 : i + 1])] + weight[0] * p) / (after[x[i - 1]] + weight[0])
            p = (three[tuple(x[i - 2 : i + 1])] + weight[1] * p) / (after_two[tuple(x[i - 2 : i])] + weight[1])
            total += math.log10(p)
        out.append(total)
    return n, [(*b, s) for b, s in zip(base, out, strict=True)]


#: Of parts that hold all, and of so small ones that nearly all words are split.
SIZES = [{}, {"part_tokens": 500, "part_words": 300}, {"part_tokens": 40, "part_words": 100}]


@pytest.mark.parametrize("sizes", SIZES)
def test_against_a_plain_model(spark, odd, sizes):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    learned = [i is not None and i % 3 != 0 for i, _ in rows]
    n, want = plain_scores(rows, learned)
    got = lm.scores(odd, F.col("doc_id") % 3 != 0, **sizes).collect()
    assert all(r.train_tokens == n for r in got)
    known = lambda x: (str(x[0]), x[1], x[2], x[3], x[4])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=known)
    want = sorted(((i, *x) for (i, _), x in zip(rows, want)), key=known)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    for g, w in zip(got, want):
        assert abs(g[3] - w[3]) < 1e-6 * max(1, abs(w[3]))
        assert abs(g[4] - w[4]) < STEP * g[1]  # two roundings to half a step for each token


def test_texts_that_begin_alike_and_repeat(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "same start " + " ".join(f"w{j}" for j in rng.integers(0, 60, 12)) + " 0" * 30) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    _, want = plain_scores(rows, [i % 4 != 0 for i, _ in rows])
    each = []
    for sizes in SIZES:
        got = {r.doc_id: r.score for r in lm.scores(docs, F.col("doc_id") % 4 != 0, **sizes).collect()}
        assert all(abs(got[i] - w[3]) < STEP * w[0] for (i, _), w in zip(rows, want))
        each.append(got)
    assert all(abs(each[0][i] - x[i]) < 0.001 for x in each[1:] for i in x)


def test_a_sequence_is_one_row_of_a_block():
    """What goes to a part grows with a block's different sequences, not with the texts that begin alike."""
    sent = []
    for texts in (100, 3000):
        blocks = next(lm._blocks(iter([pa.RecordBatch.from_pydict({
            "id": pa.array(range(texts)), "train": pa.array([True] * texts), "text": pa.array(["a b c c c c"] * texts)})])))
        block = {k: blocks.column(i)[0].as_py() for i, k in enumerate(blocks.schema.names)}
        n = block["n_words"]
        answer = {"part": 0, "places": lm._pack(np.arange(n)), "counts": block["counts"]}
        row = pa.RecordBatch.from_pydict({
            "block": pa.array([block["block"]]), "ids": pa.array([block["ids"]]), "train": pa.array([block["train"]]),
            "sizes": pa.array([block["sizes"]]), "tokens": pa.array([block["tokens"]]), "answers": pa.array([[answer]])})
        out = lm._sequences(4, {0: 0}, texts * 7, n, texts, 100, pa.int64())(iter([row]))
        sent.append([r["data"] for batch in out for r in batch.to_pylist() if r["part"] >= 0])
    assert sum(len(lm._columns(x)[5]) for x in sent[0]) == sum(len(lm._columns(x)[5]) for x in sent[1]) == 7 - 1
    assert all(not len(lm._columns(x)[7]) for x in sent[1])


def test_scores_do_not_depend_on_parts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    runs = []
    for size in (1_000_000, 50_000, 5_000):
        scored = lm.scores(documents, F.col("doc_id") % 5 != 1, part_tokens=size).collect()
        runs.append(sorted((r.doc_id, r.n_tokens, r.score) for r in scored))
    for run in runs[1:]:
        assert all(abs(a[2] - b[2]) <= 1e-6 * max(1000, abs(a[2])) for a, b in zip(runs[0], run, strict=True))


def test_empty_tables_and_reruns(spark, odd, none):
    assert lm.scores(none, F.col("doc_id") > 0).count() == 0
    nothing = lm.scores(odd, F.lit(False)).collect()
    assert len(nothing) == odd.count() and all(r.score == r.base_score == 0 and r.n_known == 0 for r in nothing)
    runs = [sorted(map(repr, lm.scores(odd, F.col("doc_id") > 3, part_tokens=5000).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_held_out_texts_gain(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = lm.scores(documents, F.col("doc_id") % 5 != 1).where("not learned")
    r = scored.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.avg((F.col("score") > F.col("base_score")).cast("int")).alias("better")).first()
    assert r.s > 0.9 * r.b and r.better > 0.8
