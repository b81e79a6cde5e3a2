import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from rollbook.llm import substring_dedup as sd


def plain(texts, width=400):
    times = {}
    for text in texts:
        for i in range(len(text) - width + 1):
            key = text[i : i + width]
            times[key] = times.get(key, 0) + 1
    out = []
    for text in texts:
        lost = bytearray(len(text))
        for i in range(len(text) - width + 1):
            if times[text[i : i + width]] > 1:
                lost[i : i + width] = b"\1" * width
        runs = sum(lost[i] and not (i and lost[i - 1]) for i in range(len(lost)))
        kept = bytes(b for b, x in zip(text, lost) if not x)
        out.append((len(text), sum(lost), runs, sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc", bytes(range(97, 117))])
def test_two_stage_sorting(letters):
    rng = random.Random(len(letters))
    for _ in range(120):
        raw = bytes(rng.choice(letters) for _ in range(rng.randint(1, 150)))
        wanted = np.array(sorted(rng.sample(range(len(raw)), rng.randint(1, len(raw)))))
        order = sd.two_stage(raw, wanted, 30)
        suffixes = [raw[p : p + 30] for p in order]
        assert suffixes == sorted(suffixes) and sorted(order.tolist()) == wanted.tolist()


def test_pieces_cover_all_starts():
    rng = random.Random(1)
    for n in (0, 399, 400, 401, 3000):
        raw = bytes(rng.choice(b"abcd ") for _ in range(n))
        found = list(sd.pieces(raw))
        assert [x for _, a, b in found for x in range(a, b)] == list(range(max(0, n - 399)))


def test_long_texts_in_segments(monkeypatch):
    rng = random.Random(2)
    raw = bytes(rng.choice(b"abcdefgh ") for _ in range(5000))
    want = list(sd.pieces(raw))
    monkeypatch.setattr(sd, "_SEGMENT", 700)
    starts = {x: g for g, a, b in sd.pieces(raw) for x in range(a, b)}
    assert starts == {x: g for g, a, b in want for x in range(a, b)}


def test_a_large_gram_is_sorted_alone(monkeypatch):
    rng = random.Random(4)
    piece = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    rows = [(g, piece(420), 1) for g in (1, 2, 3)] + [(4, piece(450), 1) for _ in range(12)] + [(5, b"x" * 410, 2)]
    rows.insert(5, rows[4])  # equal pieces of one gram are one, with the sum of their times
    seen, whole = [], sd.repeated
    monkeypatch.setattr(sd, "BATCH_BYTES", 1500)
    monkeypatch.setattr(sd, "repeated", lambda texts, times: seen.append(sum(map(len, texts))) or whole(texts, times))
    batches = [
        pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*part), (pa.int64(), pa.binary(), pa.int64()))], ["gram", "piece", "times"])
        for part in (rows[:4], rows[4:9], rows[9:])
    ]
    found = [r["part"] for b in sd._sorted_groups(iter(batches)) for r in b.to_pylist()]
    assert seen == [3 * 420, 12 * 450, 410]
    assert sorted(found) == sorted(sd._piece_name(g, x) for g, x, _ in (rows[4], rows[-1]))


def rows_of(spark, texts, **limits):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, name string")
    out = sd.digest(*sd.find(frame, ["doc_id"], **limits), ["doc_id"])
    return [tuple(r)[1:] for r in out.orderBy("doc_id").collect()]


def test_against_all_strings(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, tail = text(120), text(60)
    texts = [text(rng.randint(1, 300)) for _ in range(12)]
    texts += [text(20) + passage + text(30) for _ in range(6)] + [tail + passage + tail, passage[:200], passage[:200]]
    texts += [texts[0], texts[0], "a" * 3000, "ab" * 700, "x" * 399, "x" * 400, None, "", " ", tail * 3, text(30) + tail[-250:] + passage[:260]]
    want = plain([(x or "").encode() for x in texts])
    assert rows_of(spark, texts) == want
    assert rows_of(spark, texts, group_bytes=2000) == want


def test_words_do_not_count_but_bytes(spark):
    rng = random.Random(5)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(57)) + "xy"
    assert len(passage.split()) > 50 and len(passage) == sd.WIDTH
    for shared, lost in ((passage, (400, 1)), (passage[:-1], (0, 0))):
        rows = rows_of(spark, [f"{i} {i * 7919}" * 20 + str(i) + shared + f"{i} {i * 104729}" * 20 for i in range(1, 5)])
        assert [(removed, spans) for _, removed, spans, _ in rows] == [lost] * 4


def test_odd_rows(odd, none):
    got = sd.digest(*sd.find(odd, ["doc_id"]), ["doc_id"]).collect()
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[14].n_removed == 5000 and by[1].n_bytes == 0 and by[4].n_removed == 0
    assert by[10].n_removed == by[10].n_bytes  # it is the start of another, and long enough
    assert sd.digest(*sd.find(none, ["doc_id"]), ["doc_id"]).count() == 0
