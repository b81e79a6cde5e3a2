"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern: the set of sources they belong to. Patterns supply words, once per
repetition, and each further repetition costs more; sources demand their quotas. As only the supply arcs have costs,
and these are convex, the cheapest flow is found by augmenting paths level by level: all first copies before any second
one, flows being rerouted between sources as needed. Documents are then drawn by a seeded hash: a pattern's documents
in hash order, cyclically, are a line on which the flow to each source is a stretch, and a copy goes to the source
whose stretch covers the document's middle.

Only sums per source and pattern come to the driver (an error is raised beyond `max_patterns`), and the hash values at
which stretches end. They are found from sums per hash bucket and then within the buckets that hold an end. Documents
are never sorted or shuffled: each is judged by its own hash and its pattern's few numbers. Where the last document of
a stretch misses its end, one more or one less, of nearly the missing size, makes up for it.

Defined cases: a null text has size 0; documents of no source form a source of their own (null); an empty table gives
no rows; rows with the same id share a hash and are treated alike, so a group of copies moves the result by its whole
size; a document of size 0 may be drawn and adds nothing; columns not asked for are ignored.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm.common import shelved, unshelved, written

REPEATS = 3
_BITS = 10  # hash buckets per pattern: 2 ** _BITS


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text for any source, null included."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def targets(sizes: dict[str, int], weights: dict[str, float], repeats: int = REPEATS) -> dict[str, float]:
    """Shares of all words by weight, none above `repeats` times its source, the excess shared again by weight."""
    left, out = float(sum(sizes.values())), {}
    open_ = [s for s in sorted(sizes) if sizes[s] > 0]
    out.update({s: 0.0 for s in sizes if sizes[s] <= 0})
    while open_:
        total = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / total > repeats * sizes[s]]
        if not over:
            out.update({s: left * weights[s] / total for s in open_})
            break
        for s in over:
            out[s] = float(repeats * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def route(supply: list[int], member: list[list[int]], quota: list[int], repeats: int = REPEATS) -> list[dict[int, int]]:
    """Words from each pattern to each source: the largest flow, and among those the one of least repetition cost."""
    flow: list[dict[int, int]] = [{} for _ in supply]
    unmet = list(quota)
    back: list[set[int]] = [set() for _ in quota]  # patterns that feed a source
    for _ in range(repeats):
        spare = list(supply)
        for p in range(len(supply)):
            while spare[p]:
                # Breadth first from the pattern to a source with unmet demand, also by taking back what others gave.
                came: dict[int, int] = {}
                seen, todo, found = {p}, deque([p]), None
                via: dict[int, int] = {}
                while todo and found is None:
                    q = todo.popleft()
                    for s in member[q]:
                        if s in came:
                            continue
                        came[s] = q
                        if unmet[s]:
                            found = s
                            break
                        for other in back[s]:
                            if other not in seen:
                                seen.add(other)
                                via[other] = s
                                todo.append(other)
                if found is None:
                    break
                path, s = [], found
                while True:
                    q = came[s]
                    path.append((q, s))
                    if q == p:
                        break
                    s = via[q]
                    path.append((q, s))
                amount = min([spare[p], unmet[found], *(flow[q][s] for q, s in path[1::2])])
                for i, (q, s) in enumerate(path):
                    flow[q][s] = flow[q].get(s, 0) + (amount if i % 2 == 0 else -amount)
                    if flow[q][s]:
                        back[s].add(q)
                    else:
                        del flow[q][s]
                        back[s].discard(q)
                spare[p] -= amount
                unmet[found] -= amount
    return flow


def mix(
    documents: DataFrame, members: str, size: str, key: str, weights, keep: list[str], repeats: int = REPEATS,
    seed: int = 1, max_patterns: int = 100_000,
) -> DataFrame:
    """The kept columns with copies (0 to `repeats`), taken (words), routed (the source key of each copy).

    members: an array of source keys; a repeated or empty entry counts as one. weights: from the sorted source keys to
    a weight for each. key: the column that names a document for the draw.
    """
    rows = documents.select(
        shelved(keep).alias("_kept"),
        F.col(size).alias("_size"),
        F.array_join(F.sort_array(F.array_distinct(F.col(members))), "\x00").alias("_pattern"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1).alias("_hash"),
    ).withColumn("_bucket", F.shiftright("_hash", 63 - _BITS))
    buckets = written(rows.groupBy("_pattern", "_bucket").agg(F.sum("_size").alias("_total")), "mix-buckets")
    supply = buckets.groupBy("_pattern").agg(F.sum("_total").alias("n")).limit(max_patterns + 1).collect()
    if len(supply) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    supply = sorted((r["_pattern"], r["n"]) for r in supply)
    patterns = [p for p, _ in supply]
    names = sorted({s for p in patterns for s in p.split("\x00")})
    sizes = {s: sum(n for p, n in supply if s in p.split("\x00")) for s in names}
    quotas = targets(sizes, weights(names), repeats)
    # Overlapping sources share their words, so that the quotas are scaled to what exists.
    scale = sum(n for _, n in supply) / max(1.0, sum(quotas.values()))
    place = {s: i for i, s in enumerate(names)}
    flow = route(
        [n for _, n in supply], [[place[s] for s in p.split("\x00")] for p in patterns],
        [round(quotas[s] * min(1.0, scale)) for s in names], repeats,
    )

    ends = []  # of the stretches: pattern, number, source, whole passes before, words into the last pass
    for (pattern, n), out in zip(supply, flow, strict=True):
        at = 0
        for i, s in enumerate(sorted(out)):
            at += out[s]
            ends.append((pattern, i, names[s], at // n, at % n))
    spark = documents.sparkSession
    if not ends:
        ends = [("", 0, "", 0, 0)]
    found = spark.createDataFrame(ends, "_pattern string, _i int, _source string, _pass long, _into long")
    before = F.sum("_total").over(Window.partitionBy("_pattern").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    held = buckets.withColumn("_before", F.coalesce(before, F.lit(0))).join(F.broadcast(found), "_pattern")
    held = held.where("_into > 0 and _before <= _into and _into < _before + _total").select(
        "_pattern", "_bucket", "_before", "_i", "_into"
    )  # one row for each end
    inside = (
        rows.select("_pattern", "_bucket", "_hash", "_size")
        .join(F.broadcast(held.select("_pattern", "_bucket").distinct()), ["_pattern", "_bucket"])
        .groupBy("_pattern", "_bucket", "_hash").agg(F.sum("_size").alias("_size"))
    )
    upto = F.sum("_size").over(Window.partitionBy("_pattern", "_bucket").orderBy("_hash"))
    middle = F.col("_before") + F.col("_upto") - F.col("_size") / 2
    fits = F.max(F.when(middle <= F.col("_into"), F.struct("_hash", "_upto"))).alias("_best")
    cuts = written(
        inside.withColumn("_upto", upto).join(F.broadcast(held), ["_pattern", "_bucket"])
        .groupBy("_pattern", "_i", "_bucket", "_before", "_into").agg(fits)
        .select(
            "_pattern", "_i",
            F.coalesce("_best._hash", F.shiftleft(F.col("_bucket"), 63 - _BITS) - 1).alias("_cut"),
            (F.col("_into") - F.col("_before") - F.coalesce("_best._upto", F.lit(0))).alias("_left"),
        ),
        "mix-cuts",
    )
    # What the last document leaves open or exceeds is made up by one other of about that size.
    after = F.col("_hash") > F.col("_cut")
    off = F.abs(F.col("_size") - F.abs("_left"))
    swapped = (
        rows.select("_pattern", "_hash", "_size").join(F.broadcast(cuts), "_pattern")
        .where(((F.col("_left") > 0) & after) | ((F.col("_left") < 0) & ~after)).where(off < F.abs("_left"))
        .groupBy("_pattern", "_i").agg(F.min(F.struct(off.alias("off"), "_hash")).alias("_best"))
        .select("_pattern", "_i", F.col("_best._hash").alias("_swap"))
    )
    plan = (
        found.join(F.broadcast(cuts), ["_pattern", "_i"], "left").join(F.broadcast(swapped), ["_pattern", "_i"], "left")
        .withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("_cut", "_swap")})
        .groupBy("_pattern")
        .agg(F.sort_array(F.collect_list(F.struct("_i", "_source", "_pass", "_cut", "_swap"))).alias("_ends"))
    )
    plan = written(plan, "mix-plan")  # a row for each pattern
    passed = "_p < e._pass or (_p = e._pass and (_hash <= e._cut) <> (_hash = e._swap))"
    drawn = rows.join(F.broadcast(plan), "_pattern", "left").withColumn(
        "routed",
        F.expr(
            f"""filter(transform(sequence(0, {repeats - 1}),
                _p -> get(transform(filter(_ends, e -> {passed}), e -> e._source), 0)),
                s -> s is not null)"""
        ),
    )
    copies = F.size("routed")
    new = ["copies", "taken", "routed"]
    return drawn.select(
        *unshelved("_kept", keep, new), copies.cast("int").alias("copies"), (copies * F.col("_size")).cast("long").alias("taken"), "routed"
    )


def cyclic_weights(names: list[str]) -> dict[str, float]:
    """1, 2, 3, repeating, over the sources by code point, null last."""
    order = sorted(x for x in names if x != "n") + [x for x in names if x == "n"]
    return {name: float(i % 3 + 1) for i, name in enumerate(order)}
