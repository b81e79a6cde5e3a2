"""Quality classifier and quality rules."""

import zlib

import numpy as np
import pytest

from rollbook.llm import quality_classifier as qc
from rollbook.llm import quality_rules as qr


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    positive, negative = rng.normal(2, 1, 4000), rng.normal(-2, 1, 2000)
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        mixed = np.concatenate((rng.normal(2, 1, n), negative[: 4000 - n]))
        assert abs(qc.estimate_prior(positive, mixed) - share) < 0.08


def test_learns_without_negative_labels():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (1500, 5)), rng.normal(-2, 1, (300, 5))
    model = qc.fit(good[:700], np.vstack((good[700:], bad)))
    assert np.mean(model.score(good) >= 0.3) > 0.97
    assert np.mean(model.score(bad) < 0.3) > 0.9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scores = dict(map(tuple, qc.score(documents, qc.train(documents, labels), ["doc_id"]).collect()))
    quality = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    good = np.array([scores[i] for i, q in quality.items() if q])
    bad = np.array([scores[i] for i, q in quality.items() if not q])
    assert (good[:, None] > bad).mean() > 0.99
    assert (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.85


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 1), (5, 0), (None, 1), (7, None), (8, 1)], "doc_id long, quality int")
    for frame in (odd, none):
        for marks in (labels, labels.limit(0)):
            rows = qc.score(frame, qc.train(frame, marks), ["doc_id"]).collect()
            assert len(rows) == frame.count()
            assert all(0 <= r.score <= 1 for r in rows)
    assert qc.score(odd, qc.train(odd, labels.limit(0)), ["doc_id"]).first().score == 0.5


def plain_measures(text):
    """By the definitions, on text."""
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
        len(inside), sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words),
    )


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", "a b c d e a b c d e", "x|y #1\n\n \nx|y #1\nä ö 12 34", "é b\x0bc\x1cd", "a a a a a a a", "l\r\nl\r\nl"],
)
def test_measures(text):
    assert qr.measure(text.encode()) == plain_measures(text)


def test_ledger_policies_and_ablations(spark, odd, none):
    rows = qr.apply_policies(qr.ledger(odd, ["doc_id"])).collect()
    assert len(rows) == odd.count()
    full = next(p for p in qr.POLICIES if p.version == "full")
    assert all(r.kept_full == (r.failures & full.mask == 0) for r in rows)
    for r in qr.ablations(qr.ledger(odd, ["doc_id"])).collect():
        policy = next(p for p in qr.POLICIES if p.version == r.version)
        bits = [x.failures & policy.mask for x in rows]
        bit = qr.BITS[r.rule]
        assert r.n_rows == len(rows) and r.n_kept == sum(b == 0 for b in bits)
        assert r.n_fail == sum(bool(b & bit) for b in bits) and r.n_only == sum(b == bit for b in bits)
        assert r.n_kept_without == sum(b & ~bit == 0 for b in bits)
    assert qr.ledger(none, ["doc_id"]).count() == 0 and qr.ablations(qr.ledger(none, [])).count() == 0
    assert qr.ledger(odd, odd.columns).columns[: len(odd.columns)] == odd.columns


def test_an_id_with_most_rows_sends_no_more_than_others(spark, monkeypatch):
    """One row of each drawn id comes to the driver, however many rows it has."""
    from pyspark.sql import DataFrame

    from rollbook.llm import quality_classifier as qc

    hot = spark.range(30_000).selectExpr("2L as doc_id", "concat('text ', id) as text")
    rest = spark.range(100, 400).selectExpr("id as doc_id", "concat('other words ', id) as text")
    labels = spark.range(0, 400).selectExpr("id as doc_id", "cast(id % 3 > 0 as int) as quality")
    seen, collect = [], DataFrame.toPandas
    monkeypatch.setattr(DataFrame, "toPandas", lambda frame: seen.append(collect(frame)) or seen[-1])
    qc.train(hot.unionByName(rest), labels, sample=50)
    assert sum(map(len, seen)) <= 100
    assert all(frame.groupby(["kind", "doc_id"]).size().max() == 1 for frame in seen)
