import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from rollbook.llm import oracles, phrases
from rollbook.llm.queries import op11_phrase_mining


def plain(rows, least=10, covered=50, top=2000):
    """The contract, word by word."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if any(100 * b >= covered * a for b in longer):
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, size):
    rng = random.Random(seed)
    words = ["the", "of", "and", "New", "york", "é", "ß", "x" * 300, "a-b", "city"] + [f"w{i}" for i in range(30)]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", ";", "! "]
    out = []
    for _ in range(size):
        text = "".join(rng.choice(words[: rng.choice((4, 10, 40))]) + rng.choice(marks) for _ in range(rng.randrange(60)))
        out.append((text, rng.choice(("en", "en", "de", None, "und", ""))))
    return out + [(None, "en"), ("", None), (" .,; ", "de"), (None, None), ("New York City " * 20, "only")]


@pytest.mark.parametrize("chunk", [200, 24_000_000])
def test_against_plain_counts(spark, monkeypatch, chunk):
    rows = texts(chunk, 400)
    # Small chunks in which almost every pair is scattered, and the usual ones.
    if chunk == 200:
        monkeypatch.setattr(phrases, "HOT_COUNT", 2)
        monkeypatch.setattr(phrases, "HOT_SHARE", 0)
        of = phrases.windows
        monkeypatch.setattr(phrases, "windows", lambda d, least, t, l: of(d, least, t, l, chunk_bytes=chunk, bucket_bytes=2000))  # noqa: E741
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert rows_of(phrases.collocations(frame)) == plain(rows)
    assert rows_of(phrases.collocations(frame, least=3, covered=80, top=7)) == plain(rows, 3, 80, 7)


def test_pairs_of_a_third_of_all_words(spark):
    """One pair before ever other words, and one window everywhere."""
    rows = [(" ".join(f"hot pair z{i}x{j}" for j in range(40)), "en") for i in range(100)]
    rows += [("same old thing " * 30, "en")] * 100
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    counted = phrases.windows(frame, chunk_bytes=20_000)
    assert counted.where("first = 'hot' and second = 'pair' and third <> ''").count() == 4000  # scattered, not folded
    assert rows_of(phrases.collocations(frame)) == plain(rows)


def test_many_words_in_one_number():
    """Triples of large numbers are counted through their pairs."""
    import numpy as np

    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 5, 1000) * (1 << 30) // 4 for _ in range(3))
    small, large = phrases._counted(a >> 20, b >> 20, c >> 20, 1 << 20), phrases._counted(a, b, c, 1 << 31)
    assert [(x << 20).tolist() for x in small[:3]] == [x.tolist() for x in large[:3]]
    assert small[3].tolist() == large[3].tolist() and large[3].sum() == 1000


def test_large_counts_are_exact(spark):
    rows = [(3 * 10**15, 3 * 10**15 + 1, 9 * 10**15, 10**6 * 9 * 10**30 // ((3 * 10**15 + 1) * 9 * 10**15))]
    frame = spark.createDataFrame(rows, "a long, l long, r long, wanted long")
    assert frame.select(phrases._score("a", "l", "r").alias("s"), "wanted").where("s <> wanted").count() == 0


def test_odd_rows_and_empty_tables(odd, none):
    found = rows_of(phrases.collocations(odd))
    assert found == plain([tuple(r) for r in odd.select("text", "lang").collect()])
    assert rows_of(phrases.collocations(none)) == []


def test_registered_query_and_its_sql(spark, sf):
    found = op11_phrase_mining(spark, sf)
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "bigint", "string", *["bigint"] * 5]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        wanted = db.execute(oracles.OP11).fetchall()
    assert rows_of(found) == sorted(wanted) and wanted
    assert found.agg(F.max("rank")).first()[0] <= phrases.TOP
