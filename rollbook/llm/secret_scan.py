"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is an unbroken run of 12 or more characters of keys and tokens that is no plain word; a well-known format
wherever it stands between other signs; the password, or the token, of a login in an address (://user:password@host); or
a value of four or more signs of any kind, in quotes or up to white space, assigned to a name that means a secret. Plain
words are values of names like `password` alone, and after a colon only in quotes. The forest sees a candidate's length,
its character classes and their transitions, how it reads under letter pairs of ordinary words, how much of it a
dictionary covers, whether it looks like a path or an address, and the words and signs beside it. It is trained from
labelled findings; without a table of them, `labelled` marks the clear cases: what stands for a value (variables, calls,
marks) is negative; known formats, passwords in logins, and values with letters and digits assigned to a name that means
a secret are positive; values of such names without digits are not decided; plain numbers, parts of addresses and of
paths are negative; all others are left to the forest.

Names and logins, which give the labels, must not be what the forest goes by. So every labelled finding is also planted
between plain signs, where they are withheld, and both versions are learned: by length, transitions, dictionary and
letter pairs a value must do without its name. What is reported is the forest's choice alone, but for well-known formats
(always) and for what stands for a value (never). `held_out` holds its precision and recall on findings that it has not
seen, names withheld.

Words, letter pairs and labels are counted over all documents, in partial sums. What the model holds is bounded: the
`most` frequent words as its dictionary, and of each class all labelled findings, or `rows` of them drawn by hash. Where
a class is empty there is no forest, and the clear cases are reported. Scanning is one pass over whole texts without a
shuffle.

Defined cases: a null text is empty; an empty table gives no rows and a model of the clear cases alone; equal rows, and rows
of one id or of none, are scanned each by itself; further columns are ignored unless kept. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import per_row, released, unused, written
from rollbook.llm.trees import Forest, forest

_CANDIDATE = re.compile(rb"(?<![A-Za-z0-9_/+.\-])[A-Za-z0-9_/+.\-]{12,}+={0,2}")
_SPLIT = re.compile(rb"[A-Za-z]+")
_WHITE = re.compile(rb"\s")
_LETTERS = re.compile(rb"[a-z]{2,}")
#: Openings of well-known key formats, and names that announce a secret.
FORMATS = re.compile(
    rb"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
    rb"|sk_live_[A-Za-z0-9]{16,}|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"
)
CUES = frozenset(
    b"password passwd pwd secret token key apikey api_key auth bearer credential credentials private access".split()
)
_ASSIGN = re.compile(rb"([A-Za-z_-]+)[\"']?\s{0,3}(?::|=|=>|:=)\s{0,3}[\"']?$")
#: A format as it stands in other text.
_FORMAT = re.compile(rb"(?<![A-Za-z0-9])" + FORMATS.pattern + rb"(?![A-Za-z0-9])")
#: Of these names the last part announces a secret whatever the value, plain words and white space included.
_STRONG = frozenset(b"password passwd pwd passphrase secret token apikey credential credentials".split())
#: The end of a name that may be a cue, a sign of assignment, and perhaps a quote.
_HEAD = re.compile(
    rb"(?i:passw(?:or)?d|pwd|passphrase|secret|token|key|auth|bearer|credentials?|private|access)(?P<end>)"
    rb"[\"']?[ \t]{0,3}(?P<sign>=>|:=|=|:)[ \t]{0,3}(?P<quote>[\"']?)"
)
_CLOSE = {b'"': re.compile(rb'["\r\n]'), b"'": re.compile(rb"['\r\n]"), b"": re.compile(rb"[\s\"'<>]")}
_NAME = re.compile(rb"[A-Za-z_-]+$")
_PARTS = re.compile(rb"(?<=[a-z])(?=[A-Z])|[_-]+")
_PLAIN = re.compile(rb"[A-Za-z]?[a-z]+(?:-[a-z]+)*|[A-Z]+")
#: What stands between :// and @: user:password, up to the last @ before a path, or a token alone.
_LOGIN = re.compile(rb"://(?:[^\s/:@\"'<>]*:([^\s/\"'<>]+)|([^\s/:@\"'<>]{12,}))@")
_IN_LOGIN = re.compile(rb"://([^\s/:@\"'<>]*:)?$")
#: What stands for a value: variables, marks, and words that name the thing instead of being it; calls.
_STANDS_FOR = re.compile(
    rb"[$%#]?\{.*\}|\$[A-Z_]+|\$\(.*\)|%\w+%|%s|<.*>|\[.*\]|(.)\1*"
    rb"|(?i:null|none|nil|true|false|undefined|passw(?:or)?d|secret|token|key|change_?me|example|redacted)",
    re.DOTALL,
)
_CALL = re.compile(rb"[A-Za-z_][\w.]*[(\[](?:.*[)\]])?", re.DOTALL)
_KIND = np.full(256, 4, np.int64)
for _i, _r in enumerate((range(97, 123), range(65, 91), range(48, 58))):
    _KIND[list(_r)] = _i
_KIND[list(b"/.-_")] = 3
BEFORE, AFTER = 40, 20  # bytes beside a candidate that the forest sees
DISTINCT = 200_000  # words that a task counts before it passes partial sums on
Span = tuple[int, int]


def _cue(name: bytes) -> tuple[bool, bool]:
    """Whether a name or its last part announces a secret, and whether it does so whatever the value."""
    parts = [x.lower() for x in _PARTS.split(name) if x] or [b""]
    strong = parts[-1] in _STRONG or b"".join(parts[-2:]) == b"apikey"
    return strong or name.lower() in CUES or parts[-1] in CUES, strong


def _no_word(text: bytes) -> bool:
    kinds = {*_KIND[np.frombuffer(text, np.uint8)].tolist()}
    return 2 in kinds or 1 in kinds and 0 in kinds and not text.istitle()


def _assigned(raw: bytes) -> list[tuple[int, int, int]]:
    """Values of any signs, four at least, after a cue; 0 where quoted, else 1.

    Plain words are values of strong cues alone, and after a colon only in quotes.
    """
    heads = []
    for m in _HEAD.finditer(raw):
        name = _NAME.search(raw[max(0, m.start() - BEFORE) : m.end("end")])[0]
        cue, strong = _cue(name)
        if cue:
            heads.append((m.end("end") - len(name), m.end(), m["quote"], m["sign"] == b":", strong))
    out, done, stop = [], 0, 0
    for (at, start, quote, colon, strong), after in zip(heads, [*(h[0] for h in heads), len(raw)][1:], strict=True):
        if start <= done:  # in the quotes of the last
            continue
        m = _CLOSE[quote].search(raw, start) if quote else None
        if quoted := bool(m) and m[0] == quote:
            end = done = m.start()
        else:
            if start > stop:
                stop = m.start() if (m := _CLOSE[b""].search(raw, start)) else len(raw)
            end = max(start, min(stop, after))
        text = raw[start:end]
        if not quoted:
            if raw[max(0, at - 1) : at] in (b"?", b"&"):
                text = re.split(rb"[&#]", text, maxsplit=1)[0]  # of an address
            text = text.rstrip(b".,;:" + b")" * (b"(" not in text) + b"]" * (b"[" not in text))
        if len(text) < 4:
            continue
        if (quoted or not colon or not _PLAIN.fullmatch(text)) if strong else _no_word(text) and not _WHITE.search(text):
            out.append((start, start + len(text), int(not quoted)))
    return out


def _special(raw: bytes) -> list[Span]:
    """Logins of addresses, values after cues and known formats; of two that overlap the inner, but nothing inside quotes."""
    found = _assigned(raw)
    found += [(*m.span(m.lastindex), 2) for m in _LOGIN.finditer(raw) if m[1] or _no_word(m[2])]
    found += [(*m.span(), 3) for m in _FORMAT.finditer(raw)]
    out: list[tuple[int, int, int]] = []
    for x in sorted(found, key=lambda x: (x[0], x[2])):
        if not out or x[0] >= out[-1][1]:
            out.append(x)
        elif x[2] < 3 and out[-1][2] == 1:
            out[-1] = x
    return [x[:2] for x in out]


def candidates(raw: bytes) -> list[Span]:
    special = _special(raw)
    out, k = list(special), 0
    for m in _CANDIDATE.finditer(raw):
        start, stop = m.span()
        while k < len(special) and special[k][1] <= start:
            k += 1
        pieces, j = [], k
        while j < len(special) and special[j][0] < stop:
            pieces.append((start, special[j][0]))
            start = special[j][1]
            j += 1
        for start, end in [*pieces, (start, stop)]:
            end -= max(0, end - start) - len(raw[start:end].rstrip(b".-"))  # the end of a sentence is no part
            if end - start >= 12 and _no_word(raw[start:end]):
                out.append((start, end))
    return sorted(out)


def _in_login(raw: bytes, span: Span) -> re.Match | None:
    """Whether a span is the password, or the token, of a login in an address."""
    return _IN_LOGIN.search(raw[max(0, span[0] - 300) : span[0]]) if raw[span[1] : span[1] + 1] == b"@" else None


@dataclass
class Language:
    """What ordinary words look like: a dictionary and the log10 probabilities of letter pairs."""

    words: frozenset[bytes]
    pairs: np.ndarray

    @classmethod
    def of(cls, counts: dict[bytes, int]) -> Language:
        pairs = np.zeros((26, 26))
        for word, n in counts.items():
            codes = np.frombuffer(word, np.uint8).astype(int) - 97
            np.add.at(pairs, (codes[:-1], codes[1:]), n)
        return cls.from_pairs(counts, pairs)

    @classmethod
    def from_pairs(cls, words, pairs: np.ndarray) -> Language:
        pairs = pairs + 1
        return cls(frozenset(words), np.log10(pairs / pairs.sum(1, keepdims=True)))


def shape(raw: bytes, span: Span, language: Language) -> list[float]:
    start, end = span
    text = raw[start:end]
    kinds = _KIND[np.frombuffer(text, np.uint8)]
    n = len(text)
    classes = np.bincount(kinds, minlength=5) / n
    turns = np.zeros((5, 5))
    np.add.at(turns, (kinds[:-1], kinds[1:]), 1 / max(1, n - 1))
    parts = _SPLIT.findall(text.lower())
    known = sum(len(x) for x in parts if x in language.words) / n
    reads = [language.pairs[a - 97, b - 97] for x in parts for a, b in zip(x, x[1:])]
    times = np.bincount(np.frombuffer(text, np.uint8)) / n
    times = times[times > 0]
    before, after = raw[max(0, start - BEFORE) : start], raw[end : end + AFTER]
    near = [x.lower() for x in re.findall(rb"[A-Za-z_]+", before)[-3:]]
    m = _ASSIGN.search(before)
    login = bool(_in_login(raw, span))
    hexes = len(re.sub(rb"[^0-9a-fA-F]", b"", text)) / n
    return [
        n, hexes, float(-(times * np.log2(times)).sum()), known, float(np.mean(reads)) if reads else 0.0, len(parts) / n,
        max(map(len, parts), default=0), *classes, *turns[:3, :3].ravel(), turns[3].sum(),
        text.count(b"/"), text.count(b"."), float(bool(re.search(rb"\.[a-z]{2,4}$", text))),
        float(not login and (before[-3:] in (b"://", b"ww.") or before[-1:] == b"@" or after[:1] == b"@")), float(login),
        float(before[-1:] in b"\"'" and bool(before)), float(bool(m)), float(any(x in CUES for x in near)),
        float(bool(m) and _cue(m[1])[0]), float(not parts),
    ]


def labelled(raw: bytes, span: Span) -> int | None:
    """1: a clear finding. 0: clearly none. None: not decided by rule."""
    text, before, after = raw[slice(*span)], raw[max(0, span[0] - BEFORE) : span[0]], raw[span[1] : span[1] + 1]
    if _STANDS_FOR.fullmatch(text) or before[-1:] not in (b'"', b"'") and _CALL.fullmatch(text):
        return 0
    if _FORMAT.search(text):
        return 1
    digit, letter = re.search(rb"[0-9]", text), _SPLIT.search(text)
    if m := _in_login(raw, span):
        return 1 if m[1] else None
    m = _ASSIGN.search(before)
    if m and (cue := _cue(m[1]))[0]:
        return 1 if digit and letter and len(text) >= (8 if cue[1] else 12) and not _WHITE.search(text) else None
    if before[-1:] == b"@" or after == b"@" or before.endswith(b"://") or not letter:
        return 0
    if text.count(b"/") > 1 or re.search(rb"\.[a-z]{2,4}$", text) or not digit:
        return 0
    return None


def planted(text: bytes) -> tuple[bytes, Span]:
    """A value between plain signs, away from its name, its quotes and its address."""
    return b" . " + text + b" . ", (3, 3 + len(text))


def settled(raw: bytes, span: Span) -> bool | None:
    """True: a well-known format. False: what stands for a value. None: for the forest to say."""
    text = raw[slice(*span)]
    if _STANDS_FOR.fullmatch(text) or raw[max(0, span[0] - 1) : span[0]] not in (b'"', b"'") and _CALL.fullmatch(text):
        return False
    return True if _FORMAT.search(text) else None


@dataclass
class Model:
    forest: Forest
    language: Language
    threshold: float = 0.5
    held_out: dict[str, float] = field(default_factory=dict)  # precision, recall, findings

    def find(self, raw: bytes) -> tuple[int, list[Span]]:
        """The number of candidates, and the spans (in bytes) judged to be secrets."""
        spans = candidates(raw)
        if not spans:
            return 0, []
        if not self.forest.trees:
            return len(spans), [s for s in spans if labelled(raw, s) == 1]
        known = [settled(raw, s) for s in spans]
        asked = [i for i, x in enumerate(known) if x is None]
        if asked:
            scores = self.forest(np.array([shape(raw, spans[i], self.language) for i in asked]))
            for i, p in zip(asked, scores, strict=True):
                known[i] = bool(p >= self.threshold)
        return len(spans), [s for s, x in zip(spans, known, strict=True) if x]


def _row_of(w: list[str], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"w": pa.array(w, pa.string()), "n": pa.array(n, pa.int64())})


def language_of(documents: DataFrame, most: int = 20000) -> Language:
    """Letter pairs of all words that are in at least two rows, weighted by rows; the `most` frequent are the dictionary."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                counts.update(set(_LETTERS.findall((text or b"").lower())))
                if len(counts) >= DISTINCT:
                    yield _row_of(w=[x.decode() for x in counts], n=list(counts.values()))
                    counts.clear()
        yield _row_of(w=[x.decode() for x in counts], n=list(counts.values()))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(26 * 26, np.int64)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = np.frombuffer(word.encode(), np.uint8).astype(int) - 97
                np.add.at(total, codes[:-1] * 26 + codes[1:], n)
        yield pa.RecordBatch.from_pydict({"x": pa.array([total.tolist()], pa.list_(pa.int64()))})

    partial = documents.select(F.col("text").cast("string")).mapInArrow(lambda x: released(words(x)), "w string, n long")
    counts = written(partial.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1"), "secret-words")
    total = np.zeros(26 * 26)
    for r in counts.select("w", "n").mapInArrow(pairs, "x array<long>").toLocalIterator():  # a row for each task
        total += r.x
    frequent = counts.orderBy(F.desc("n"), "w").limit(most)
    return Language.from_pairs([r.w.encode() for r in frequent.toLocalIterator()], total.reshape(26, 26))


def train(documents: DataFrame, label=labelled, rows: int = 20000) -> Model:
    """The forest from findings of all documents that `label` decides: of each class all, or `rows` drawn by hash.

    Findings that are equal with all that the forest sees of them count once, so that copies crowd out no other.
    """
    language = language_of(documents)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: tuple[dict, dict] = ({}, {})
        most = [2**63, 2**63]  # hashes from here on are not among the `rows` least
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for span in candidates(text or b""):
                    if (mark := label(text, span)) is None:
                        continue
                    seen = text[max(0, span[0] - BEFORE) : span[1] + AFTER]
                    place = span[0] - max(0, span[0] - BEFORE)
                    key = b"%d:%d:" % (place, span[1] - span[0]) + seen
                    number = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big") >> 1
                    own = drawn[mark]
                    if number < most[mark] and number not in own:
                        apart = shape(*planted(text[slice(*span)]), language)
                        own[number] = np.array(shape(text, span, language) + apart)  # a quarter of a list's memory
                        if len(own) >= 2 * rows:
                            for k in sorted(own)[rows:]:
                                del own[k]
                            most[mark] = max(own, default=0)
        for mark, own in enumerate(drawn):
            for at in range(0, len(keys := sorted(own)[:rows]), 1000):
                part = keys[at : at + 1000]
                yield pa.RecordBatch.from_pydict(
                    {
                        "mark": pa.array([mark] * len(part), pa.int32()), "hash": pa.array(part, pa.int64()),
                        "x": pa.array([own[k] for k in part], pa.list_(pa.float64())),
                    }
                )

    found = written(documents.select(F.col("text").cast("string")).mapInArrow(lambda x: released(one(x)), "mark int, hash long, x array<double>"), "secret-found")
    classes = []
    for mark in (0, 1):
        least = found.where(F.col("mark") == mark).groupBy("hash").agg(F.min("x").alias("x")).orderBy("hash").limit(rows)
        classes.append(np.array([r.x for r in least.toLocalIterator()], float))
    if not all(map(len, classes)):
        return Model(Forest([], 0.0), language)
    x, y = np.concatenate(classes), np.repeat([0.0, 1.0], [len(c) for c in classes])
    width = x.shape[1] // 2
    own, apart = x[:, :width], x[:, width:]
    learned = lambda some: forest(np.concatenate((own[some], apart[some])), np.concatenate((y[some], y[some])))
    # Rows are in the order of their hashes: every fourth of each class is held out.
    held = np.concatenate([np.arange(len(c)) % 4 == 3 for c in classes])
    model = Model(learned(slice(None)), language)
    if held.any() and all(len(c) >= 8 for c in classes):
        chosen, wanted = learned(~held)(apart[held]) >= model.threshold, y[held] == 1
        hits = float((chosen & wanted).sum())
        model.held_out = {
            "precision": hits / max(1.0, float(chosen.sum())), "recall": hits / max(1.0, float(wanted.sum())), "findings": float(held.sum()),
        }
    return model


def scan(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns, n_candidates, n_secrets and spans (start:end of code points, comma-joined)."""

    def one(raw: bytes):
        n, spans = model.find(raw)
        if not spans:
            return n, 0, ""
        before = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        return n, len(spans), ",".join(f"{before[s]}:{before[e]}" for s, e in spans)

    return per_row(documents, "n_candidates long, n_secrets long, spans string", keep, "text", one)


def redact(documents: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by the mark and n_chars, where there is one, counted anew.

    A null text stays null.
    """

    def one(raw: bytes):
        out, at = [], 0
        for start, end in model.find(raw)[1]:
            out += [raw[at:start], mark.encode()]
            at = end
        return (b"".join([*out, raw[at:]]).decode() if out else None,)

    names = documents.columns
    new = unused("redacted", names)
    out = per_row(documents, f"{new} string", names, "text", one)
    columns = {}
    for name in names:
        columns[name] = F.col(f"`{name}`")
        if name.lower() == "text":
            columns[name] = F.coalesce(new, columns[name].cast("string"))
        elif name.lower() == "n_chars":
            columns[name] = F.when(F.col(new).isNull(), columns[name]).otherwise(F.length(new).cast(out.schema[name].dataType))
    return out.select(*(c.alias(name) for name, c in columns.items()))
