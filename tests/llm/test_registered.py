"""Every registered query of the package, run as it is, against its SQL or a plain version of its contract."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from rollbook.llm import language_id, queries


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def fold(doc_id, n=5):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_their_sql(spark, sf, name):
    found = queries.QUERIES[name](spark, sf)
    with duckdb.connect() as db:
        for table in ("documents", "embeddings", "benchmark", "labels", "pages"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
        result = db.execute(queries.ORACLES[name])
        columns = [c[0] for c in result.description]
        wanted = [tuple(r[columns.index(c)] for c in sorted(columns)) for r in result.fetchall()]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in sorted(columns)) for r in found.collect()))) == sorted(map(repr, wanted))


def test_op1(spark, sf, documents):
    rows = queries.op1_quality_classifier(spark, sf).collect()
    assert {r.doc_id for r in rows} == documents.keys() and len(rows) == len(documents)
    for r in rows:
        assert r.held_out == (fold(r.doc_id) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op2(spark, sf, documents):
    tokens = {}
    for i, r in documents.items():
        low = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        tokens[i] = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", low) if w] + [None]
    c = Counter(t for i, own in tokens.items() if fold(i) != 1 for t in own)
    n, v = sum(c.values()), len(c)
    rows = queries.op2_lm_scoring(spark, sf).collect()
    assert len(rows) == len(documents)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id) == 1, len(own), sum(c[t] > 0 for t in own), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score <= 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the model is better than its base


def test_op5(spark, sf, documents):
    from test_pii import plain

    for r in queries.op5_pii(spark, sf).collect():
        base = plain(documents[r.doc_id].text or "")
        kinds = Counter(k for k, _, _ in base) if base and isinstance(base[0][0], str) else Counter(x[2] for x in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert not text or set(text.split(",")) <= set(r.spans.split(","))


def test_op7(spark, sf, documents):
    """Every 400-byte string of all texts, counted one by one."""
    raw = {i: (r.text or "").encode() for i, r in documents.items()}
    seen = Counter(hashlib.md5(x[k : k + 400]).digest() for x in raw.values() for k in range(len(x) - 399))
    rows = queries.op7_suffix_array_dedup(spark, sf).collect()
    assert len(rows) == len(raw)
    for r in rows:
        x = raw[r.doc_id]
        gone = bytearray(len(x))
        for k in range(len(x) - 399):
            if seen[hashlib.md5(x[k : k + 400]).digest()] > 1:
                gone[k : k + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(x), sum(gone), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op8(spark, sf, documents):
    sizes = {i: len([w for w in re.split(r"[ \t\n\x0b\x0c\r]+", r.text or "") if w]) for i, r in documents.items()}
    of = defaultdict(int)
    for i, r in documents.items():
        of[r.source] += sizes[i]
    names = sorted((s for s in of if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in of)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, open_ = {}, float(sum(of.values())), list(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * of[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3.0 * of[s]
            left -= target[s]
            open_.remove(s)
    taken = defaultdict(int)
    rows = queries.op8_mixing(spark, sf).collect()
    assert len(rows) == len(documents)
    for r in rows:
        source = documents[r.doc_id].source
        assert (r.size, r.source_size) == (sizes[r.doc_id], of[source]) and abs(r.target - target[source]) < 1e-6 * max(1, target[source])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    longest = max(sizes.values())
    assert all(abs(taken[s] - target[s]) <= longest for s in names)
    again = {r.doc_id: r.taken for r in queries.op8_mixing(spark, sf).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_op9_and_op10(spark, sf, documents):
    pages = queries.op9_html_extraction(spark, sf)
    assert pages.count() == spark.read.parquet(f"{sf}/pages.parquet").count()
    found = queries.op10_secret_scan(spark, sf).collect()
    assert {r.doc_id for r in found} == documents.keys()
    keys = [i for i, r in documents.items() if re.search(r"AKIA[0-9A-Z]{16}", r.text or "")]
    assert all(r.n_secrets > 0 for r in found if r.doc_id in keys) and all(r.n_secrets <= r.n_candidates for r in found)


def test_op13(spark, sf, documents):
    rows = queries.op13_language_id(spark, sf).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not language_id.has_letter(documents[r.doc_id].text or ""))
