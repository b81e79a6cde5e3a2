import hashlib
import random
from collections import defaultdict
from math import floor, isfinite

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import oracles, vector_codes
from rollbook.llm.queries import op12_vector_codes


def plain(rows, parts=8, entries=16, rounds=6):
    """The contract in Python's own numbers: (vec_id, code, error, label_error), and the books' digest."""
    kept = [(i, [floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    d = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [[(v + [0] * (d * parts - len(v)))[p * d : p * d + d] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    distance = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    assign = lambda p, x: min((distance(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[assign(p, c[p])[1]].append(c[p])
            for k, xs in members.items():
                books[p][k] = [sum(x) // len(xs) for x in zip(*xs, strict=True)]
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        best = [assign(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(x for x, _ in best), label))
    totals = defaultdict(int)
    for _, _, error, label in out:
        totals[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, totals[label]) for i, code, error, label in out), key=str), digest


def found(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    coded, model = vector_codes.compress(frame)
    code = F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    return sorted((tuple(r) for r in coded.select("vec_id", code, "error", "label_error").collect()), key=str), model.digest()


@pytest.mark.parametrize("size, width", [(300, 16), (200, 40), (30, 5), (7, 24), (1, 8)])
def test_against_plain_search(spark, size, width):
    rng = random.Random(size)
    # Few distinct values, so that distances tie.
    rows = [(i, [rng.choice((-1.5, 0.0001, 0.25, 0.3, 2.0)) for _ in range(width)], rng.choice((None, 1, 1, 2))) for i in range(size)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i // 2, [rng.gauss(0, 1) for _ in range(8)], 1) for i in range(0, 40, 2)]
    rows += [(50, None, 1), (51, [1.0] * 7 + [None], 1), (52, [1.0] * 7 + [float("nan")], 2), (53, [float("inf")] + [0.0] * 7, 2)]
    rows += [(None, [0.5] * 8, None), (None, [0.5] * 8, None), (60, [], 3), (61, [0.125] * 3, 3), (19, [9.0] * 8, 1), (19, [9.0] * 8, 1)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == plain([])
    assert found(spark, rows[20:24]) == plain([])


def test_numbers_beyond_64_bits(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice((1, -1)) * rng.random() * 2.0 ** rng.randrange(1, 34) for _ in range(16)], i % 2) for i in range(60)]
    assert not vector_codes._fits(2, floor(4096 * 2.0**34))
    rows_found, digest = found(spark, rows)
    rows_wanted, wanted = plain(rows)
    assert digest == wanted and [r[:2] for r in rows_found] == [r[:2] for r in rows_wanted]
    most = (1 << 63) - 1
    assert [r[2:] for r in rows_found] == [(min(r[2], most), min(r[3], most)) for r in rows_wanted]


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_waves_are_in_sequency_order(size):
    waves = vector_codes.transformed(np.eye(size, dtype=np.int64), size).T
    assert (np.abs(np.diff(waves)) > 0).sum(1).tolist() == list(range(size))
    assert (waves @ waves.T == size * np.eye(size)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_is_that_of_a_plain_search(kind):
    rng = np.random.default_rng(1)
    x, e = rng.integers(-3, 4, (500, 6)), rng.integers(-3, 4, (16, 6))
    e[7], e[11] = e[2], e[2]
    d = ((x[:, None] - e[None]) ** 2).sum(2)
    at, distance = vector_codes.nearest(vector_codes.transformed(x.astype(kind), 8), vector_codes.transformed(e.astype(kind), 8))
    assert at.tolist() == d.argmin(1).tolist() and distance.tolist() == d.min(1).tolist()


def test_registered_query_and_its_sql(spark, sf):
    rows = op12_vector_codes(spark, sf)
    assert rows.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
        wanted = db.execute(oracles.OP12).fetchall()
    assert sorted(tuple(r) for r in rows.collect()) == sorted(wanted) and wanted
