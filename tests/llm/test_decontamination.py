import re

from rollbook.llm import decontamination as dc


def plain(text, items, width=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, names = set(), set()
    for name, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        n = min(width, len(own))
        for at in range(len(own) - n + 1) if own else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[at : at + n]:
                    hit |= set(range(i, i + n))
                    names |= {str(name)} if name is not None else set()
    return len(words), len(hit), sorted(names)


ITEMS = [
    (1, " ".join(f"pass{i}" for i in range(20, 41))), (1, "Four FIVE"), (2, "word"), (None, "another text"), (3, None),
    (4, "..."), (5, "word"), (6, "ä-ö ü"),
]


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")


def test_against_plain_search(spark, odd, none):
    want = sorted(map(repr, [(r.doc_id, *plain(r.text, ITEMS)) for r in odd.collect()]))
    for block in (50_000_000, 40):
        found = dc.find(odd, bench(spark, ITEMS), block).collect()
        got = [(r.doc_id, r.n_words, sum(b - a for a, b in zip(r.hits[::2], r.hits[1::2])), list(r.items)) for r in found]
        assert sorted(map(repr, got)) == want
    assert dc.find(none, bench(spark, ITEMS)).count() == 0
    clean = dc.digest(dc.find(odd, bench(spark, ITEMS).limit(0))).collect()
    assert not any(r.contaminated for r in clean) and len(clean) == odd.count()


def test_places_are_code_points(spark, odd):
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in dc.find(odd.where("doc_id = 13"), bench(spark, ITEMS)).collect():
        assert [texts[13][a:b] for a, b in zip(r.places[::2], r.places[1::2])] == ["ä ö ü"] * 20


def test_contaminated_documents_leave(spark, odd):
    left = dc.without(odd, bench(spark, ITEMS))
    assert left.columns == odd.columns
    want = [r.doc_id for r in odd.collect() if not plain(r.text, ITEMS)[1]]
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(map(repr, want))


def test_an_automaton_of_a_block_is_bounded(spark):
    """A block of a large benchmark, of different words and windows, takes at most 100 MB in a worker."""
    import pickle
    import resource

    text = " ".join(f"w{i}x{i % 977}" for i in range(dc.BLOCK_CHARS // 11))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    matcher = dc.Matcher([("1", text)])
    assert len(pickle.dumps(matcher)) < 100_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # kB, to build and to pickle it
    many = bench(spark, [(i, " ".join(f"z{i}y{j}" for j in range(300))) for i in range(100)])
    blocks, n = dc._blocks(many, 20_000)
    assert n > 5 and blocks.groupBy("block").count().count() == n
