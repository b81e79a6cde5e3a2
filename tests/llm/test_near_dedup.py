import random
from itertools import combinations

import pytest

from rollbook.llm import near_dedup as nd
from rollbook.llm.components import components


def plain(rows):
    """component by row, all pairs compared."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    part = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            old, new = part[j], part[i]
            part = [new if x == old else x for x in part]
    least = {}
    for (name, _), p in zip(rows, part):
        if name is not None:
            least[p] = min(name, least.get(p, name))
    return sorted(repr((n, len(s), least.get(p, n))) for (n, _), s, p in zip(rows, sets, part))


def found(frame, **limits):
    return sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in nd.groups(frame, ["doc_id"], **limits).collect())


@pytest.fixture(scope="module")
def varied(spark):
    rng = random.Random(4)
    rows = []
    for base in range(12):
        words = [f"b{base}w{rng.randrange(400)}" for _ in range(rng.randrange(5, 150))]
        for _ in range(rng.randrange(1, 14)):
            copy = [w if rng.random() > rng.choice([0, 0.01, 0.03, 0.06]) else "new" + str(rng.random()) for w in words]
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_all_pairs_agree(varied):
    assert found(varied) == plain([tuple(r) for r in varied.collect()])


def test_hot_nodes_and_components_are_split(varied):
    want = plain([tuple(r) for r in varied.collect()])
    assert found(varied, node_limit=4, group_limit=4) == want


def test_what_never_parts_is_compared_whole(varied, monkeypatch):
    """Nodes that stay too large are dealt to parts; links between parts are found all the same."""
    monkeypatch.setattr(nd, "MOST_LEVELS", 0)
    want = plain([tuple(r) for r in varied.collect()])
    assert found(varied, node_limit=4, group_limit=3) == want


@pytest.mark.parametrize("alike", [0, 30, 37, 40])
def test_every_pair_of_a_dealt_node_meets(spark, alike):
    """Forty sets of one signature, so many of which are joined: the others meet all, in parts of bounded size."""
    name = lambda i: b"%02d" % i
    entries = spark.createDataFrame([(7, bytearray(name(i)), bytearray(96)) for i in range(40)], "node long, name binary, tokens binary")
    split, dealt = nd._split(entries, 8)
    links = spark.createDataFrame([(bytearray(name(0)), bytearray(name(i))) for i in range(1, alike)], "a binary, b binary")
    rest = nd._rest(dealt, links, 8)
    assert (rest is None) == (alike == 40)
    met = {}
    for r in split.collect() + ([] if rest is None else rest.collect()):
        met.setdefault(r.node, set()).add(int(r.name))
    together = {pair for group in met.values() for pair in combinations(sorted(group), 2)}
    assert {p for p in combinations(range(40), 2) if p[1] >= alike} <= together
    assert max(map(len, met.values())) < 25


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd) == plain(rows)
    assert found(none) == []
    assert nd.groups(odd, ["doc_id", "source"]).columns == ["doc_id", "source", "n_shingles", "component_id"]


def test_pairs_at_the_threshold_meet():
    import numpy as np

    rng = np.random.default_rng(5)
    missed = 0
    for _ in range(150):
        both = rng.integers(0, 2**63, 420, dtype=np.uint64)
        a, b = both[:368], both[52:]  # 316 of 420: 0.752
        tokens = np.array([nd.signature(np.unique(a)), nd.signature(np.unique(b))])
        nodes, sets = nd.paths(tokens)
        missed += not set(nodes[sets == 0].tolist()) & set(nodes[sets == 1].tolist())
    assert missed <= 1


@pytest.mark.parametrize("levels", [1, 4, 9, nd.MOST_LEVELS])
def test_pairs_at_the_threshold_meet_in_nodes_that_branch_on(levels):
    """Ten trees, whose nodes are all large and branch so many levels more: at least 0.99 of 1,000 pairs at 0.7525."""
    import numpy as np

    rng = np.random.default_rng(levels)
    missed = 0
    for _ in range(1000):
        a = rng.integers(0, 2**16, nd.ORDERS).astype(np.uint16)
        tokens = np.array([a, np.where(rng.random(nd.ORDERS) < 0.7525, a, rng.integers(0, 2**16, nd.ORDERS))]).astype(np.uint16)
        nodes, sets = nd.paths(tokens)
        for _ in range(levels):
            common = np.intersect1d(nodes[sets == 0], nodes[sets == 1])[:60]
            if not len(common) or len(common) == 60:
                break  # parted, or sure to meet
            at = np.repeat(common, 2)
            nodes, sets = nd.branch(at, np.tile(np.arange(2), len(common)), tokens, nd.FURTHER)
        missed += not len(np.intersect1d(nodes[sets == 0], nodes[sets == 1]))
    assert missed <= 10


def test_large_nodes_of_one_kind_and_of_many():
    """A node that is one cluster is taken whole, one of strangers branches; both in little time."""
    import time

    import numpy as np

    rng = np.random.default_rng(7)
    base = rng.integers(0, 256, 96).astype(np.uint8)
    alike = np.where(rng.random((6000, 96)) < 0.05, rng.integers(0, 256, (6000, 96)), base).astype(np.uint8)
    strangers = rng.integers(0, 256, (6000, 96)).astype(np.uint8)
    strangers[::2][:500] = strangers[1::2][:500]  # pairs of equal rows
    start = time.time()
    mixed = np.concatenate((alike, strangers))
    groups = [sorted(g.tolist()) for g in nd.clusters(mixed)]
    assert max(map(len, groups)) == 6000
    pairs = {tuple(g) for g in groups if len(g) == 2}
    assert {(6000 + 2 * i, 6001 + 2 * i) for i in range(500)} <= pairs
    assert time.time() - start < 60


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1080)]
    part = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    loops = {x for x in part if all(x not in e or e[0] == e[1] for e in edges)}
    assert got == {k: v for k, v in part.items() if k not in loops}
    assert components(frame.limit(0)).count() == 0
