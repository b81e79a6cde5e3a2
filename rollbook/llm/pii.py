"""Personal data: generators propose spans, boosted trees judge them by format and context, thresholds select.

- The exact kinds (email, ip, card, phone) have patterns and checks of their own; what passes is always redacted.
- High-recall generators propose further, overlapping spans: spelled-out addresses, numbers in groups, bank accounts,
  long addresses of machines, number runs. The trees see length, shape and separators of a span, its checksum, and the
  words and signs around it.
- The trees learn from the corpus itself: spans of the exact kinds are positive, also rewritten in place to what the
  generators look for (addresses spelled out, long addresses, numbers without '+', account and id formats), and so are
  long addresses and bank accounts that pass their check, and ids and spelled addresses behind a cue word. Spans that
  look alike and fail a check, and other runs of digits, are negative; what a rule takes and nothing confirms is neither.
- Of the spans that overlap, the likeliest is kept. A generator's threshold is the least at which `precision` of a part
  of the sample that the trees have not seen is right, and decides alone. `held_out` has the precision and recall of every
  generator on another such part, which the thresholds have not seen either. A generator without a threshold, as in a
  corpus without spans of the exact kinds, goes by `rule` instead: checksum, valid format, marks of spelling, or a cue
  word before 9 to 15 digits.

Learning takes spans of at most `sample` documents and at most `rows` spans (parameters), drawn by hash. Finding is one
pass over whole texts without a shuffle; the model's size does not depend on the input.

Defined cases: a null text is empty and has no spans; rows of one id, and equal rows, are searched each by itself; an
empty table gives no rows and a model that goes by the rules; rows without an id are searched like others; further columns
are ignored unless kept. Offsets are code points of the original text.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import drawn, per_row
from rollbook.llm.trees import Boosted, boost

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A match starts where a run of digits starts: inside it, it would fail for the same reason.
_IP = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(rb"[0-9]")
Span = tuple[int, int, str]


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def exact(raw: bytes) -> tuple[list[Span], list[Span]]:
    """Spans (in bytes) of the exact kinds, and those of the same patterns whose check fails."""
    good: list[Span] = []
    bad: list[Span] = []
    last, at = 0, raw.find(b"@")
    while at >= 0:
        start = at
        while start > last and raw[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(raw, at + 1)):
            last = m.end()
            good.append((start, last, "email"))
        at = raw.find(b"@", max(at + 1, last))
    if _DIGIT.search(raw):
        for m in _IP.finditer(raw):
            ok = all(len(x.lstrip(b"0")) < 4 and int(x[-4:]) < 256 for x in m.group().split(b"."))
            (good if ok else bad).append((*m.span(), "ip"))
        for m in _CARD.finditer(raw):
            digits = m.group().replace(b" ", b"").replace(b"-", b"")
            ok = 12 <= len(digits) <= 19 and luhn(digits)
            if ok or len(digits) >= 4:
                (good if ok else bad).append((*m.span(), "card"))
        for m in _PHONE.finditer(raw):
            ok = 9 <= len(_DIGIT.findall(m.group())) <= 15
            (good if ok else bad).append((*m.span(), "phone"))
    return good, bad


#: Generators beyond the exact kinds. They overlap on purpose.
GENERATORS = {
    "spelled_email": re.compile(
        rb"(?i)[a-z0-9][a-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]|\{at\}| at ) ?[a-z0-9-]{1,63}"
        rb"(?:(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot |\.)[a-z0-9-]{2,63}){1,4}"
    ),
    "grouped_number": re.compile(rb"(?<![0-9+.])\(?[0-9]{2,4}\)?(?:[ ./-][0-9]{2,4}){2,5}(?![0-9])"),
    "plain_number": re.compile(rb"(?<![0-9A-Za-z.+])[0-9]{7,19}(?![0-9A-Za-z])"),
    "bank_account": re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "long_ip": re.compile(
        rb"(?<![0-9A-Za-z])(?<![0-9A-Fa-f:]:)(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"
        rb"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z])(?!:[0-9A-Fa-f:])"
    ),
    "national_id": re.compile(rb"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
#: Fixed value: words that announce personal data, in the languages at hand.
CUES = (
    b"phone tel telephone telefon mobile call fax email mail e-mail contact kontakt contacto address ip host card visa"
    b" mastercard account iban konto cuenta compte ssn passport correo numero nummer"
).split()
_NAMES = (*KINDS, *GENERATORS)


def _mod97(span: bytes) -> bool:
    text = span.replace(b" ", b"").decode()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]+", text):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


_SPELLED = re.compile(rb"(?i)[(\[{]at[)\]}]| at .* dot ")

_MARKED = re.compile(rb"(?i)[(\[{]at[)\]}].*[(\[{]dot[)\]}]")


def _ipv6(span: bytes) -> bool:
    """All eight groups, or a shortened address of three groups and a digit at least."""
    if b"::" in span and (len(re.findall(rb"[0-9A-Fa-f]+", span)) < 3 or not _DIGIT.search(span)):
        return False
    try:
        ipaddress.IPv6Address(span.decode())
    except ValueError:
        return False
    return True


def _id(span: bytes) -> bool:
    """Three, two and four digits as they are given out."""
    ok = re.fullmatch(rb"([0-9]{3})-([0-9]{2})-([0-9]{4})", span)
    return bool(ok) and ok[1] not in (b"000", b"666") and ok[1] < b"900" and ok[2] != b"00" and ok[3] != b"0000"


def _cued(raw: bytes, start: int) -> bool:
    return (re.findall(rb"[a-z-]+", raw[max(0, start - 32) : start].lower()) or [b""])[-1] in CUES


def rule(raw: bytes, start: int, end: int, name: str) -> bool:
    """Whether a proposal is taken where the trees have learned nothing about its generator."""
    span = raw[start:end]
    if name in ("plain_number", "grouped_number"):
        return 9 <= len(_DIGIT.findall(span)) <= 15 and _cued(raw, start)
    return {"spelled_email": lambda x: bool(_SPELLED.search(x)), "bank_account": _mod97, "long_ip": _ipv6, "national_id": _id}[name](span)


def shape(raw: bytes, start: int, end: int) -> list[float]:
    """Format and context of a span, without the name of its generator and without its telling sign."""
    span = raw[start:end]
    digits = _DIGIT.findall(span)
    groups = re.findall(rb"[0-9]+", span)
    before, after = raw[max(0, start - 32) : start].lower(), raw[end : end + 16].lower()
    near = re.findall(rb"[a-z-]+", before)[-3:]
    alone = float((not before or before[-1:].isspace()) and (not after or after[:1].isspace() or after[:1] in b".,;:!?"))
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in span)
    joined = b"".join(digits)
    ip = len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups)
    return [
        len(span), len(digits), letters, len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        span.count(b"."), span.count(b"-"), span.count(b" "), span.count(b"(") + span.count(b")"), span.count(b":"),
        float(12 <= len(digits) <= 19 and luhn(joined)), float(_mod97(span)), float(ip), float(joined[:1] == b"0"),
        float(any(w in CUES for w in near)), float(bool(near) and near[-1] in CUES),
        float(before.rstrip()[-1:] in b":=#" and bool(before.strip())), alone, float(b" at " in span or b"(at)" in span or b"[at]" in span),
        len(set(joined)) / max(1, len(joined)), float(bool(re.search(rb"\.[a-z]{2,}$", span))),
        float(bool(_SPELLED.search(span))), float(_ipv6(span)), float(_id(span)),
    ]


def proposals(raw: bytes) -> list[Span]:
    """Spans of the generators, in bytes; they may overlap one another and the exact kinds."""
    out: list[Span] = []
    for name, pattern in GENERATORS.items():
        if name != "spelled_email" and not _DIGIT.search(raw):
            continue
        out += [(*m.span(), name) for m in pattern.finditer(raw)]
    return out


def _rewritten(span: bytes, kind: str) -> list[tuple[str, float, bytes]]:
    """(generator, label, span): an exact span as the generators would meet it, and the like that fails a check."""
    seed = hashlib.md5(span).digest()
    digits = b"".join(_DIGIT.findall(span))
    number = b"%020d" % (int.from_bytes(seed) % 10**20)
    out: list[tuple[str, float, bytes]] = []
    if kind == "email":
        at, dot = [(b" (at) ", b" (dot) "), (b"(at)", b"(dot)"), (b" [at] ", b" [dot] "), (b" at ", b" dot "), (b" (at) ", b".")][seed[0] % 5]
        local, _, domain = span.partition(b"@")
        out.append(("spelled_email", 1.0, local + at + domain.replace(b".", dot)))
    elif kind == "ip":
        groups = [b"%x" % int.from_bytes(seed[i : i + 2]) for i in range(0, 16, 2)]
        short = b"2001:db8::" + b":".join(groups[:2])
        out += [("long_ip", 1.0, short if seed[0] % 3 == 0 else b":".join(groups)), ("long_ip", 0.0, b":".join(groups[:5]))]
    elif kind == "phone":  # the same number without its sign is what the generators must find, or without its country
        home = re.sub(rb"^\+[0-9]{1,3}[ .-]", b"", span)
        if seed[0] % 2 and home != span and len(_DIGIT.findall(home)) >= 9:
            out += [("grouped_number", 1.0, home), ("plain_number", 1.0, b"".join(_DIGIT.findall(home)))]
        else:
            out += [("grouped_number", 1.0, span[1:]), ("plain_number", 1.0, digits)]
        area = b"%03d" % (1 + int(number[:3]) % 665)
        rest = b"-%02d-%04d" % (1 + int(number[3:5]) % 99, 1 + int(number[5:9]) % 9999)
        out += [("national_id", 1.0, area + rest), ("national_id", 0.0, (b"000", b"666", b"9" + area[1:])[seed[0] % 3] + rest)]
    elif kind == "card":
        check = 98 - int(number[:18] + b"131400") % 97  # D = 13, E = 14
        for label, c in ((1.0, check), (0.0, check % 97 + 2)):
            account = b"DE%02d" % c + number[:18]
            spaced = b" ".join(account[i : i + 4] for i in range(0, 22, 4))
            out.append(("bank_account", label if _mod97(account) == bool(label) else -1.0, spaced if seed[0] % 2 else account))
    # A phone without its sign is taken as it is; all else must be what its generator proposes.
    return [x for x in out if x[1] >= 0 and (x[0] == "grouped_number" or GENERATORS[x[0]].fullmatch(x[2]))]


def _label(raw: bytes, start: int, end: int, name: str) -> float | None:
    """Of a proposal beside the exact spans: what a check or a cue word confirms, what fails it; None: neither."""
    taken, cued = rule(raw, start, end, name), _cued(raw, start)
    if name in ("long_ip", "bank_account"):
        return float(taken)
    if name in ("plain_number", "grouped_number"):
        return None if cued or _id(raw[start:end]) else 0.0
    if taken:
        return 1.0 if cued or name == "spelled_email" and _MARKED.search(raw[start:end]) else None
    return None if cued and name == "spelled_email" else 0.0


def _examples(raw: bytes) -> list[list[float]]:
    """Rows of (generator, label, shape) from one text."""
    good, bad = exact(raw)
    rows = []
    covered = lambda s, e: any(s < b and a < e for a, b, _ in good)
    for start, end, kind in good:
        rows.append([_NAMES.index(kind), 1.0, *shape(raw, start, end)])
        before, after = raw[max(0, start - 32) : start], raw[end : end + 16]
        for name, label, span in _rewritten(raw[start:end], kind):
            rows.append([_NAMES.index(name), label, *shape(before + span + after, len(before), len(before) + len(span))])
    for start, end, kind in bad:
        if not covered(start, end):
            rows.append([_NAMES.index(kind), 0.0, *shape(raw, start, end)])
    for start, end, name in proposals(raw):
        if not covered(start, end):
            label = _label(raw, start, end, name)
            if label is not None:
                rows.append([_NAMES.index(name), label, *shape(raw, start, end)])
        elif name == "plain_number" and any((a, b, k) == (start, end, "card") for a, b, k in good):
            rows.append([_NAMES.index(name), 1.0, *shape(raw, start, end)])
    return rows


@dataclass
class Model:
    trees: Boosted
    thresholds: dict[str, float | None]  # None: by rule
    held_out: dict[str, dict[str, float]] = field(default_factory=dict)  # by generator: precision, recall, spans


def fit(rows: np.ndarray, precision: float = 0.98) -> Model:
    """From rows of (generator, label, shape). Of five, one calibrates the thresholds and one is held out for the figures."""
    least: dict[str, float | None] = dict.fromkeys(GENERATORS)
    if len(rows) < 30:
        return Model(boost(np.zeros((0, 1)), np.zeros(0)), least)
    part = np.arange(len(rows)) % 5
    trees = boost(rows[part > 1, 2:], rows[part > 1, 1])
    check, unseen = rows[part == 0], rows[part == 1]
    scores, others = trees(check[:, 2:]), trees(unseen[:, 2:])
    figures = {}
    for name in GENERATORS:
        own = check[:, 0] == _NAMES.index(name)
        below = 0.0
        for cut in np.unique(scores[own]):
            chosen = own & (scores >= cut)
            if chosen.sum() >= 5 and check[chosen, 1].mean() >= precision:
                # Half way to the next score below, as spans in other contexts score a little less.
                least[name] = float(max((below + cut) / 2, 0.5))
                break
            below = cut
        own = unseen[:, 0] == _NAMES.index(name)
        if least[name] is not None and own.any():
            chosen, wanted = own & (others >= least[name]), own & (unseen[:, 1] == 1)
            hits = float((chosen & wanted).sum())
            figures[name] = {
                "precision": hits / max(1.0, float(chosen.sum())), "recall": hits / max(1.0, float(wanted.sum())), "spans": float(own.sum()),
            }
    return Model(trees, least, figures)


def train(documents: DataFrame, sample: int = 4000, rows: int = 20000, seed: int = 3) -> Model:
    """Learns from the texts of at most `sample` ids, one text of each (the least), and `rows` spans of them."""
    wanted = drawn(documents.select("doc_id").where("doc_id is not null"), sample, seed).withColumnRenamed("doc_id", "wanted")
    texts = documents.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted"))
    texts = texts.groupBy("doc_id").agg(F.min(F.col("text").cast("string")).alias("text"))
    found = per_row(texts, "x array<array<double>>", ["doc_id"], "text", lambda raw: (_examples(raw),))
    found = found.select(F.explode("x").alias("x")).orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(rows)
    return fit(np.array([r.x for r in found.toLocalIterator()], float).reshape(-1, 2 + len(shape(b"", 0, 0))))


def select(raw: bytes, model: Model) -> tuple[list[Span], list[Span]]:
    """The exact spans, and those the method adds, both in bytes. Added spans overlap neither the exact nor each other."""
    good, _ = exact(raw)
    free = [p for p in proposals(raw) if not any(p[0] < e and s < p[1] for s, e, _ in good)]
    added: list[Span] = []
    if free:
        scores = model.trees(np.array([shape(raw, s, e) for s, e, _ in free], float))
        scores = [
            float(rule(raw, *p)) if model.thresholds[p[2]] is None else float(x)
            for x, p in zip(scores, free, strict=True)
        ]
        for score, span in sorted(zip(scores, free, strict=True), key=lambda x: (-x[0], x[1][2].endswith("number"), x[1])):
            least = model.thresholds[span[2]]
            if score >= (1.0 if least is None else least) and not any(span[0] < e and s < span[1] for s, e, _ in added):
                added.append(span)
    return good, added


def _in_points(raw: bytes, spans: list[Span]) -> list[str]:
    """kind:start:end in code points, by start and then kind as listed."""
    if not spans:
        return []
    before = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    order = sorted(spans, key=lambda x: (x[0], _NAMES.index(x[2]), x[1]))
    return [f"{kind}:{before[start]}:{before[end]}" for start, end, kind in order]


def find(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns, n_<kind> of each exact kind, `exact` and `spans` (all) as comma-joined kind:start:end."""

    def one(raw: bytes):
        good, added = select(raw, model)
        counts = [sum(k == kind for _, _, k in good) for kind in KINDS]
        return *counts, ",".join(_in_points(raw, good)), ",".join(_in_points(raw, good + added))

    schema = ", ".join([*(f"n_{kind} long" for kind in KINDS), "exact string", "spans string"])
    return per_row(documents, schema, keep, "text", one)
