"""Quality rules as a ledger: every rule is evaluated once, its failure kept as a bit beside the measurements.

A policy is a version with a mask: a document is kept if none of the policy's bits is set. Changing a policy, comparing
versions or asking what a rule contributes reads the ledger, never the texts:

- `ledger` measures each text in one pass without a shuffle;
- `apply_policies` judges every row under every version by a bitwise and;
- `ablations` counts, per version and rule, by partial sums: rows that fail the rule, rows that only this rule rejects,
  and the rows kept if the rule were dropped. It returns a row for each version and rule, whatever the input.

Defined cases: a null text has no words and fails `few_words`, as does an empty one; identical rows are judged alike
and all returned; an empty table gives an empty ledger and no ablations; further columns are ignored unless kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import per_row, window_prints, word_bounds, word_prints

_SYMBOL = re.compile(rb"[#*$%&|<>]")
_BLANK = re.compile(rb"[\x20\x09-\x0D]+")
#: The measurements: words, code points in words, symbols, lines with a word, such lines equal to an earlier one,
#: words inside 5-word windows found twice or more, words with a letter.
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_letter_words long"
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
WIDTH = 5


def measure(raw: bytes) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    codes = np.frombuffer(raw, np.uint8)
    starts, ends = word_bounds(codes)
    n = len(starts)
    if not n:
        return 0, 0, 0, 0, 0, 0, 0
    white = int((ends - starts).sum())
    chars = white - int(((codes & 0xC0) == 0x80).sum())
    lines = [x for x in raw.split(b"\n") if not _BLANK.fullmatch(x) and x]
    windows = window_prints(word_prints(codes, starts, ends), WIDTH)
    repeated = 0
    if len(windows):
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        found = np.flatnonzero(times[which] > 1)
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, found, 1)
        np.add.at(edges, found + WIDTH, -1)
        repeated = int((np.cumsum(edges) > 0).sum())
    lettered = int((np.add.reduceat(_LETTER[codes], starts) > 0).sum())  # the gaps hold no letters
    return n, chars, len(_SYMBOL.findall(raw)), len(lines), len(lines) - len(set(lines)), repeated, lettered


@dataclass(frozen=True)
class Rule:
    """Fails where the condition on the measurements holds. Its place in RULES is its bit."""

    name: str
    fails: str


#: In the order of their bits; a new rule goes to the end, so that old ledgers stay readable.
RULES = [
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("few_letters", "100 * n_letter_words < 60 * n_words"),
]
BITS = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[name] for name in set(self.rules))


POLICIES = [
    Policy("base", ("few_words", "repeated_windows")),
    Policy("full", tuple(BITS)),
]


def ledger(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, the measurements and `failures`, a bit for each failed rule."""
    measured = per_row(documents, MEASURES, keep, "text", measure)
    bits = [F.when(F.expr(rule.fails), F.lit(BITS[rule.name])).otherwise(F.lit(0)) for rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("failures", total.cast("long"))


def passes(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """The ledger with a column kept_<version> for each policy."""
    return rows.withColumns({f"kept_{p.version}": passes(p) for p in policies})


def ablations(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """Per version and rule: n_rows, n_kept, n_fail, n_only (rejected by no other rule), n_kept_without."""
    pattern = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))  # at most 2 ** rules rows
    cells = [
        F.struct(
            F.lit(p.version).alias("version"), F.lit(name).alias("rule"),
            F.lit(p.mask).cast("long").alias("mask"), F.lit(BITS[name]).cast("long").alias("bit"),
        )
        for p in policies for name in BITS if name in p.rules
    ]
    failed = F.col("failures").bitwiseAND(F.col("cell.mask"))
    of = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return (
        pattern.select("failures", "n", F.explode(F.array(*cells)).alias("cell"))
        .groupBy(F.col("cell.version").alias("version"), F.col("cell.rule").alias("rule"))
        .agg(
            F.sum("n").alias("n_rows"),
            of(failed == 0).alias("n_kept"),
            of(failed.bitwiseAND(F.col("cell.bit")) != 0).alias("n_fail"),
            of(failed == F.col("cell.bit")).alias("n_only"),
            of(failed.bitwiseAND(F.bitwise_not(F.col("cell.bit"))) == 0).alias("n_kept_without"),
        )
    )
