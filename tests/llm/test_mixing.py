import random

from pyspark.sql import functions as F

from rollbook.llm import mixing


def test_targets_share_the_excess():
    sizes = {"sa": 100, "sb": 1000, "sc": 10, "sd": 0, "n": 1000}
    got = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)))
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6
    assert all(got[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    assert got["sa"] == 300 and got["sc"] == 30 and got["sd"] == 0
    assert mixing.cyclic_weights(list(sizes)) == {"sa": 1, "sb": 2, "sc": 3, "sd": 1, "n": 2}
    assert mixing.targets({}, {}) == {}


def cheapest(supply, member, quota):
    """By trying all whole flows."""
    best = None

    def go(p, left, cost, met):
        nonlocal best
        if p == len(supply):
            key = (-met, cost)
            best = key if best is None else min(best, key)
            return

        def share(sources, left, used):
            if not sources:
                copies = 0
                for k in range(3):
                    copies += k * max(0, min(used, supply[p] * (k + 1)) - supply[p] * k)
                go(p + 1, left, cost + copies, met + used)
                return
            s = sources[0]
            for x in range(min(left[s], 3 * supply[p] - used) + 1):
                share(sources[1:], [*left[:s], left[s] - x, *left[s + 1 :]], used + x)

        share(member[p], left, 0)

    go(0, list(quota), 0, 0)
    return best


def test_flow_is_the_largest_and_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        supply = [rng.randint(0, 2) for _ in range(rng.randint(1, 3))]
        member = [sorted(rng.sample(range(3), rng.randint(1, 2))) for _ in supply]
        quota = [rng.randint(0, 3) for _ in range(3)]
        flow = mixing.route(supply, member, quota)
        total = [sum(f.values()) for f in flow]
        assert all(set(f) <= set(m) and t <= 3 * n for f, m, t, n in zip(flow, member, total, supply))
        assert all(sum(f.get(s, 0) for f in flow) <= quota[s] for s in range(3))
        cost = sum(k * max(0, min(t, n * (k + 1)) - n * k) for t, n in zip(total, supply) for k in range(3))
        assert (-sum(total), cost) == cheapest(supply, member, quota)


def test_overlapping_sources_come_near_their_quotas(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([["a"], ["a", "b"], ["b", "c"], ["c"], ["a", "b", "c"]]), rng.randint(1, 60)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, members array<string>, size long")
    weights = lambda names: {"a": 4.0, "b": 1.0, "c": 1.0}
    got = mixing.mix(frame, "members", "size", "doc_id", weights, ["doc_id", "members", "size"]).collect()
    words = {s: sum(r["size"] for r in got for x in r["routed"] if x == s) for s in "abc"}
    total = sum(n for _, _, n in rows)
    assert abs(sum(words.values()) - total) < 200
    assert abs(words["a"] / total - 4 / 6) < 0.01 and abs(words["b"] / total - 1 / 6) < 0.01
    assert all(set(r["routed"]) <= set(r["members"]) and r["taken"] == r["copies"] * r["size"] for r in got)
    assert [sorted(map(repr, got))] == [
        sorted(map(repr, mixing.mix(frame.repartition(7), "members", "size", "doc_id", weights, ["doc_id", "members", "size"]).collect()))
    ]


def test_odd_rows(odd, none):
    rows = odd.select(
        F.struct(*(F.col(c).alias(c) for c in odd.columns)).alias("doc"), "doc_id", F.array(mixing.source_key(F.col("source"))).alias("members"),
        mixing.size_of(F.col("text")).alias("words"),
    )
    for frame in (rows, rows.limit(0), rows.where("words = 0")):
        got = mixing.mix(frame, "members", "words", "doc_id", mixing.cyclic_weights, ["doc", "words"]).collect()
        assert len(got) == frame.count()
        assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.words for r in got)
