"""Benchmark decontamination: one Aho-Corasick automaton over the items' word windows, run once over every text.

Texts are lower-cased (A-Z) and cut into words of digits, a-z and bytes beyond ASCII. Each window of 10 consecutive
item words is a pattern over word numbers; an item of fewer words is one pattern. A document's words, numbered by the
items' vocabulary, pass through the automaton once, and each match is mapped back to words and to code points of the
original text.

The automaton goes to the tasks as a broadcast, whose size is checked: items are dealt into blocks of at most
`block_chars` characters, each block becomes an automaton, and blocks run one after the other over all documents. A test
suite of normal size is one block. Documents are never shuffled with one block; with more, one row per document is.

Defined cases: a null text has no words; an empty table of documents gives no rows, without items nothing is hit; an
item without words matches nothing; items with equal windows are all named, an item listed twice once; an item without
an id marks words, but has no name to list; repeated documents are judged alike and all returned; clashing further
columns of either table are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import per_row, unused, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WIDTH = 10
#: Characters of a benchmark in one automaton, which takes about 50 bytes for each: some 50 MB in every worker.
BLOCK_CHARS = 1_000_000


def words(raw: bytes) -> list[bytes]:
    return WORD.findall(raw.lower())  # bytes.lower() changes A-Z only


class Matcher:
    """The automaton of a list of (item name or None, text)."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WIDTH):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str | None]] = {}
        for name, text in items:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words((text or "").encode())]
            size = min(width, len(own))
            for at in range(len(own) - size + 1 if own else 0):
                windows.setdefault(tuple(own[at : at + size]), set()).add(name)
        self.automaton = None
        if windows:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for window, names in windows.items():
                self.automaton.add_word(window, (len(window), tuple(sorted(x for x in names if x is not None))))
            self.automaton.make_automaton()

    def __call__(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """The number of words, the runs of hit words (first, past the last), and the names of items found."""
        found = words(raw)
        runs: list[tuple[int, int]] = []
        names: set[str] = set()
        if self.automaton is not None and found:
            number = self.numbers.get
            for last, (size, items) in self.automaton.iter(tuple(number(w, 0) for w in found)):
                first = last + 1 - size
                while runs and runs[-1][1] >= first:
                    first = min(first, runs.pop()[0])
                runs.append((first, last + 1))
                names.update(items)
        return len(found), runs, names


def _places(raw: bytes, runs: list[tuple[int, int]]) -> list[int]:
    """Start and end of each run of words, in code points of the text, one after the other."""
    if not runs:
        return []
    spans = [m.span() for m in WORD.finditer(raw.lower())]
    out, at, points = [], 0, 0
    for first, past in runs:
        for byte in (spans[first][0], spans[past - 1][1]):
            points += len(raw[at:byte].decode())
            at = byte
            out.append(points)
    return out


def _blocks(benchmark: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("item"))
    chars = items.agg(F.sum(F.length("item"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    return items.withColumn("block", F.pmod(F.xxhash64("name", "item"), F.lit(n)).cast("int")), n


def find(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document (doc_id): n_words, hits (first, past, ... of words), places (the same in code points), items.

    documents: doc_id, text. benchmark: item_id, text. Rows of one id stay apart.
    """
    schema = "n_words long, hits array<long>, places array<long>, items string"

    def of(rows: DataFrame, keep: list[str], shared) -> DataFrame:
        def one(raw: bytes):
            n_words, runs, names = shared.value(raw)
            return n_words, [x for run in runs for x in run], _places(raw, runs), "\n".join(sorted(names))

        part = per_row(rows, schema, keep, "text", one)
        return part.withColumn("items", F.expr("if(items = '', array(), split(items, '\\n', -1))"))

    matchers = _matchers(documents, benchmark, block_chars)
    if len(matchers) == 1:
        return of(documents, ["doc_id"], matchers[0])
    # Rows are told apart while blocks are brought together.
    rows = written(documents.select("doc_id", "text").withColumn("row", F.uuid()), "decontaminate")
    out = of(rows, ["doc_id", "row"], matchers[0])
    for shared in matchers[1:]:
        out = out.unionByName(of(rows, ["doc_id", "row"], shared))
    joined = out.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.collect_list("hits").alias("hits"), F.collect_list("places").alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    id_type = joined.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, n_words long, hits array<long>, places array<long>, items array<string>"
    return joined.select("doc_id", "n_words", "hits", "places", "items").mapInArrow(_united, shape)


def _matchers(documents: DataFrame, benchmark: DataFrame, block_chars: int) -> list:
    """A broadcast automaton for each block of items."""
    items, n = _blocks(benchmark, block_chars)
    context = documents.sparkSession.sparkContext
    of = lambda block: [(r.name, r.item) for r in items.where(F.col("block") == block).select("name", "item").collect()]
    return [context.broadcast(Matcher(of(block))) for block in range(n)]


def without(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all their columns, that hold no window of an item. Nothing is shuffled."""
    names, out = documents.columns, documents
    hit, all_ = unused("hit", names), [F.col(f"`{c}`") for c in names]
    for shared in _matchers(documents, benchmark, block_chars):
        found = per_row(out, f"{hit} boolean", names, "text", lambda raw, shared=shared: (bool(shared.value(raw)[1]),))
        out = found.where(~F.col(hit)).select(*all_)
    return out


def _merge(lists: list[list[int]]) -> list[int]:
    runs: list[list[int]] = []
    for first, past in sorted((x[i], x[i + 1]) for x in lists for i in range(0, len(x), 2)):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], past)
        else:
            runs.append([first, past])
    return [x for run in runs for x in run]


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the runs of all blocks (columns 2 and 3) as one list of runs."""
    for batch in batches:
        columns = list(batch.columns)
        for i in (2, 3):
            columns[i] = pa.array([_merge(lists) for lists in columns[i].to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query from those of find()."""
    sizes = F.expr("aggregate(sequence(0, cast(size(hits) / 2 as int) - 1), 0L, (n, i) -> n + hits[2 * i + 1] - hits[2 * i])")
    hit = F.when(F.size("hits") > 0, sizes).otherwise(F.lit(0)).cast("long")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )
