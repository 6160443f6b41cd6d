"""Personal data: base patterns, and further spans chosen by boosted trees.

Generators with high recall propose spans that may overlap each other and base matches: telephone
numbers without a country code, numbers that stand next to others (where a base pattern runs over
both and fails its check), written-out e-mail addresses, cards and addresses with unusual separators,
and secrets such as keys and passwords.  Boosted trees score each proposal by its format and its
context; a proposal is taken from the calibrated threshold of its kind on, best first, unless it
overlaps one already taken or lies inside base matches.  Base matches that meet their checks are
always taken.  The trees are fitted here on generated sentences (fixed seed), as the tables hold no
labelled spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, boost
from .common import prepare, texts_of, tidy
from .features import platt, sigmoid

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
#: All kinds of spans; those after the first four are the method's alone.
ALL_KINDS = (*KINDS, "secret")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits leads to the same rest as the run's first digit, so only that is tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Generators: kind, pattern, the group that is the span, and whether the text must have a digit.
MORE = (
    ("phone", re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])"), 0, True),
    ("phone", re.compile(r"(?<![0-9A-Za-z])00[0-9](?:[\x20().-]{0,2}[0-9]){7,13}(?![0-9A-Za-z])"), 0, True),
    ("phone", re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2}(?![0-9])"), 0, True),
    ("phone", re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){3}(?![0-9])"), 0, True),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9A-Za-z])"), 0, True),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])"), 0, True),
    ("card", re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])"), 0, True),
    ("ip", re.compile(r"(?<![0-9A-Za-z])[0-9]{1,3}(?:(?:\x20\.\x20|\[\.\])[0-9]{1,3}){3}(?![0-9A-Za-z])"), 0, True),
    ("email", re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]{1,40}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{2,40}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z]{2,12}){1}(?![A-Za-z])", re.I), 0, False),
    ("email", re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]{1,40}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{2,40}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z]{2,12}){2}(?![A-Za-z])", re.I), 0, False),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9])"), 0, True),
    ("secret", re.compile(r"(?<![A-Za-z])(?:password|passwd|pwd|secret|token|api[\x20_-]?key|access[\x20_-]?key)[\"']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?([^\s\"']{6,200})", re.I), 1, False),
)
CUES = {
    "email": ("mail", "contact", "write", "reach", "address"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "pay", "account", "debit"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp", "number"),
    "secret": ("token", "secret", "key", "passw", "pwd", "auth", "credential", "bearer"),
}
AGAINST = ("isbn", "version", "page", "order", "figure", "section", "invoice", "ratio", "score", "part", "serial", "range", "date", "commit", "sha", "md5", "checksum", "etag", "uuid", "revision", "digest")
CONTEXT = 24
PRECISION = 0.97


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their at signs so that long runs cost linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at  # the characters before this sign belong to no later match
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' matches that meet their checks, sorted."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 if len(p) < 5 else not p.strip("0") or int(p.lstrip("0")[:5]) <= 255 and len(p.lstrip("0")) < 4 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Overlapping spans (start, kind number, end) of the further generators."""
    found = set()
    digits = bool(DIGIT.search(text))
    lower = text.lower()
    marks = {"email": any(x in lower for x in ("at]", "at)")), "secret": any(x in lower for x in ("pass", "pwd", "secret", "token", "key"))}
    for kind, pattern, group, with_digit in MORE:
        if digits if with_digit else marks[kind]:
            found.update((m.start(group), ALL_KINDS.index(kind), m.end(group)) for m in pattern.finditer(text))
    return sorted(found)


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context features of a proposal."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    digits = "".join(c for c in span if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", span)
    lengths = [len(g) for g in groups] or [0]
    cues = CUES[ALL_KINDS[kind]]
    return [
        kind, len(span), len(digits), len(groups), max(lengths), min(lengths), lengths[-1], lengths[0], lengths[-2] if len(lengths) > 1 else 0,
        float(luhn(digits)) if 0 < len(digits) < 40 else 0.0, span.count("("), span.count("."), span.count("-"), span.count(" "), span.count("/"),
        len({c for c in span if not c.isalnum()}), len(digits) / len(span), sum(c.isupper() for c in span) / len(span),
        sum(c in "0123456789abcdefABCDEF" for c in span) / len(span), len(set(span)) / min(len(span), 40),
        sum(c in before for c in cues), sum(c in after for c in cues), sum(c in before for c in AGAINST),
        float(bool(re.search(r"[0-9][\x20.,/-]?$", before))), float(bool(re.match(r"[\x20.,/-]?[0-9]", after))), float(bool(re.match(r"[0-9a-z]", after))),
        float(bool(re.search(r"[$€£#]\s?$", before))), float(bool(re.search(r"[=:]\s?[\"']?$", before))), float(bool(re.search(r"[\"']$", before))),
        float(all(n == lengths[0] for n in lengths)), float(bool(groups) and all(int(g[:6]) <= 255 for g in groups)), float(bool(re.search(r"(19|20)[0-9]{2}", span))),
    ]


SYLLABLES = "th an er on re he in ed ti es or st en at to nt ha nd ou ea ng as is it al ar le se ción ado éau ung sch ê ñ ö".split()


def examples(count: int = 6000, seed: int = 11) -> tuple[list[tuple[str, int, int, int]], np.ndarray]:
    """Proposals from generated sentences, and whether each is exactly a piece of personal data or a secret."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(pick(SYLLABLES) for _ in range(rng.integers(1, 4)))
    name = lambda: "".join(pick(SYLLABLES[:27]) for _ in range(rng.integers(1, 4)))
    some = lambda: " ".join(word() + pick(["", "", "", ".", ",", "###"]) for _ in range(rng.integers(1, 6)))
    hexa = lambda n: "".join(pick("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))

    def card(sep: str, good: bool) -> str:
        body = pick("3456") + num(14)
        last = next(c for c in "0123456789" if luhn(body + c) == good)
        return sep.join((body + last)[i : i + 4] for i in range(0, 16, 4))

    def phone(good: bool) -> str:
        sep = pick(" .-")
        if good:
            return pick([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{sep}{num(3)}{sep}{num(4)}", f"00{pick('123456789')} {num(3)} {num(3)} {num(3)}", f"0{num(2)}/{num(4)} {num(4)}", *[f"+{pick('1234')}{num(rng.integers(0, 2))} ({num(3)}) {num(3)}-{num(4)}"] * 3, f"+{pick('1234')} {num(3)} {num(3)} {num(4)}"])
        return pick([f"{num(2)}.{num(3)}.{num(3)}", f"20{num(2)}-{num(4)}-{num(4)}", f"{num(4)} {num(4)} {num(4)}", f"{num(3)} {num(3)} {num(3)}", f"{num(2)}-{num(3)}-{num(3)}", f"00{num(9)}"])

    def secret(good: bool) -> str:
        if good:
            return pick([hexa(40), hexa(32), mixed(40), mixed(24), f"AKIA{mixed(16).upper()}", f"ghp_{mixed(36)}", f"sk-{mixed(32)}", f"{word()}{num(3)}!{mixed(4)}"])
        return pick([hexa(40), hexa(32), f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}", "-".join(word() for _ in range(6)), f"{word()}/{word()}{num(4)}/{word()}{word()}{word()}", "_" * 24 + num(2), word() * 8 + num(1)])

    out, y = [], []
    while len(out) < count:
        kind, good = pick(ALL_KINDS), rng.random() < 0.5
        cue = pick(CUES[kind]) if rng.random() < (0.6 if good else 0.05) else pick(AGAINST) if rng.random() < (0.6 if not good else 0.0) else word()
        join = pick([": ", " ", " is "])
        if kind == "phone":
            span = phone(good)
        elif kind == "card":
            span = card(pick(["._/ -"[rng.integers(5)], "", ""]), good)
        elif kind == "ip":
            parts = rng.integers(1, 255, 4) if good else rng.integers(0, 999, 4)
            span = pick([" . ", "[.]"]).join(map(str, parts))
        elif kind == "secret":
            span = secret(good)
            cue = pick(["token", "secret", "password", "api_key", "access_key", "auth token", "key"]) if good else pick([*AGAINST[-8:], word(), "token", "key"])
            join = pick([' = "', ": ", "=", ' = "', " '"]) if good else pick([" ", ": ", " is "])
            if not good and cue in ("token", "key"):
                span, join = word(), pick([": ", " = "])
        else:
            span = f"{name()}{pick(['', '.', '_'])}{name()}{pick([' [at] ', '(at)', '[at]', ' (at) '])}{name()}{pick(['.', ' [dot] ', '(dot)'])}{pick(['com', 'org', 'net', 'de'])}"
            if not good:
                span = f"{pick(['meet', 'look', 'stay', 'open'])} (at) {name()}.{name()}"
        close = join[-1] if join[-1] in "\"'" else ""
        extra = pick([" 77", "-3", "/9", ".4"]) if not good and kind != "secret" and rng.random() < 0.5 else pick(["", "", "", "%%%", f" {num(3)}.{num(2)}.{num(3)}.{num(1)}", f" {num(16)}", "."]) if kind in ("phone", "card") else ""
        lead = f"{num(pick([3, 16]))} " if kind in ("phone", "card") and rng.random() < 0.1 else ""
        text = f"{some()} {cue}{join}{lead}{span}{close}{extra} {some()}"
        at = text.index(span, text.index(cue + join) + len(cue + join) + len(lead))
        truth = (at, ALL_KINDS.index(kind), at + len(span))
        for p in proposals(text):
            if p[0] < truth[2] and at < p[2]:
                out.append((text, *p))
                y.append(float(good and p == truth))
    return out, np.array(y)


@dataclass
class SpanModel:
    trees: Boosted
    scale: float
    shift: float
    thresholds: tuple[float, ...]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * self.trees.logits(x) + self.shift)


@lru_cache(maxsize=1)
def span_model() -> SpanModel:
    """Trees on four fifths of the examples; calibration and each kind's threshold on the rest."""
    rows, y = examples()
    x = np.array([describe(*r) for r in rows])
    fold = np.arange(len(y)) % 5 == 4
    model = SpanModel(boost(x[~fold], y[~fold], trees=60, depth=4), 1.0, 0.0, (0.5,) * len(ALL_KINDS))
    model.scale, model.shift = platt(model.trees.logits(x[fold]), y[fold])
    p = model.probabilities(x[fold])
    limits = []
    for kind in range(len(ALL_KINDS)):
        own, truth = p[x[fold][:, 0] == kind], y[fold][x[fold][:, 0] == kind]
        order = np.argsort(-own)
        precise = np.cumsum(truth[order]) / np.arange(1, len(order) + 1) >= PRECISION
        limits.append(max(0.5, float(own[order][precise][-1])) if precise.any() else 1.1)
    model.thresholds = tuple(limits)
    return model


def more_spans(text: str, taken: list[tuple[int, int, int]], model: SpanModel) -> list[tuple[int, int, int]]:
    """Proposals from the threshold of their kind on, best first, that overlap none taken before and do not lie inside base spans."""
    base = joined(taken)
    starts = [s for s, _, _ in base]

    def inside(p: tuple[int, int, int]) -> bool:
        at = bisect_right(starts, p[0]) - 1
        return at >= 0 and p[2] <= base[at][2]

    found = [p for p in proposals(text) if not inside(p)]
    if not found:
        return []
    scores = model.probabilities(np.array([describe(text, *p) for p in found]))
    out: list[tuple[int, int, int]] = []  # sorted, none overlaps another
    for i in np.lexsort(([p[0] - p[2] for p in found], -scores)):
        p = found[i]
        if scores[i] >= model.thresholds[p[1]]:
            at = bisect_left(out, p)
            if (at == 0 or out[at - 1][2] <= p[0]) and (at == len(out) or p[2] <= out[at][0]):
                insort(out, p)
    return out


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def joined(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """The spans in order, those that overlap as one of the first's kind."""
    merged: list[list[int]] = []
    for s, k, e in sorted(spans):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(e, merged[-1][2])
        else:
            merged.append([s, k, e])
    return merged


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span as [KIND]; overlapping spans become one of the first's kind."""
    out, at = [], 0
    for s, k, e in joined(spans):
        out += [text[at:s], f"[{ALL_KINDS[k].upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, redacted: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of the base spans by kind, base_sha256, spans (all of personal data), secrets
    (spans of keys and passwords), n_spans (of both), and with ``redacted`` the text with every span replaced.

    Offsets count code points, ends are exclusive.  A null text is empty; no span gives an empty
    string and its digest.  Base spans of different kinds may overlap and are all reported.
    Repeated rows are searched each; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = texts_of(docs)
    send = docs.sparkSession.sparkContext.broadcast(span_model())  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = send.value
        for b in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans, secrets, sizes, cleaned = [], [], [], [], []
            for text in b.column(1).to_pylist():
                base = base_spans(text)
                for k, column in enumerate(counts):
                    column.append(sum(x[1] == k for x in base))
                every = base + more_spans(text, base, model)
                digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
                spans.append(spell([x for x in every if x[1] < len(KINDS)]))
                secrets.append(spell([x for x in every if x[1] >= len(KINDS)]))
                sizes.append(len(every))
                if redacted:
                    cleaned.append(redact(text, every))
            cols = [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(secrets, pa.string()), pa.array(sizes, pa.int64())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "secrets", "n_spans"]
            if redacted:
                cols.append(pa.array(cleaned, pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, secrets string, n_spans long" + ", text string" * redacted)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` with personal data replaced in ``text``; every other column stays.

    Null and empty texts stay as they are; repeated rows are searched each; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    send = docs.sparkSession.sparkContext.broadcast(span_model())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = send.value
        for b in batches:
            new = []
            for text in b.column(at).to_pylist():
                spans = base_spans(text) if text else []
                spans = spans + more_spans(text, spans, model) if text else []
                new.append(redact(text, spans) if spans else text)
            yield b.set_column(at, b.schema.field(at).with_type(pa.string()), pa.array(new, pa.string()))

    return docs.mapInArrow(tidy(run), docs.schema)
