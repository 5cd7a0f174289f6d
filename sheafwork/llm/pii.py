"""Personal data by weak supervision.

Patterns propose spans, strict ones and wider ones. Five labelers vote on each span for,
against or not at all: the strict pattern, a check of the form, a gazetteer, the words
before the span and its borders. Expectation-maximisation estimates, kind by kind, how
reliable each labeler is, from the counts of vote patterns over all spans. What it believes
of a span trains a logistic classifier of the votes, the span's characters and the words
around it, which decides about the wider spans. Strict spans always stay.

The classifier sees each training span twice, with its votes and without them, so that
characters and words learn to say what the votes say, and speak where votes are silent or
at odds. It is trained on at most ``SAMPLE`` spans of each kind and vote pattern, those
with the smallest hashes, which weigh as much as all spans of the pattern.

Texts are not exchanged. What is gathered are counts of vote patterns and shapes, whose
number is bounded by their kinds, 5 kinds, 3 ** 5 votes, 8 lengths and 4 digit shares, and
the sample with them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.tables import written

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE_KINDS = KINDS[:4]
LABELERS = 5
_LENGTHS = [8, 12, 16, 20, 28, 40, 64]
_CUE_WINDOW = 24
#: Share of the spans that the belief in the labelers weighs in expectation-maximisation.
_TRUST = 0.03
#: Training spans of the classifier of one kind and vote pattern.
SAMPLE = 8
#: Numbers that characters and words are hashed to.
BUCKETS = 1 << 12

# Patterns of the strict spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

# Wider patterns. Repeats are bounded, so none runs far for nothing, but for the last one of
# a secret, behind which nothing has to match.
_WIDE = {
    "email": re.compile(
        r"(?i)[a-z0-9._%+-]{1,64}(?:"
        r" ?[\[({<] ?at ?[\])}>] ?[a-z0-9-]{1,63}(?:(?:\.| ?[\[({<] ?dot ?[\])}>] ?| dot )[a-z0-9-]{1,63}){1,6}"
        r"| at [a-z0-9-]{1,63}(?: dot [a-z0-9-]{1,63}){1,6})"
    ),
    "ip": re.compile(r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"),
    "card": re.compile(r"[0-9]{4}(?:[ .-]?[0-9]){9,15}"),
    "phone": re.compile(r"\(?[0-9]{2,4}\)?(?:[ ./-][0-9]{2,4}){2,4}"),
    "secret": re.compile(
        r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)"
        r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"']{8,})"
    ),
}
_WRITTEN = re.compile(r"(?i)[\[({<] ?at ?[\])}>]| dot ")
# Gazetteers, fixed values. Every country has a top-level domain of two letters, these are
# the common ones of more.
_DOMAINS = set(
    "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post arpa "
    "app dev blog shop store online site tech cloud xyz email example test invalid local".split()
)
# First and last of the leading digits that issuers of cards have.
_ISSUERS = (
    ("4", "4"), ("51", "55"), ("2221", "2720"), ("34", "34"), ("37", "37"), ("6011", "6011"), ("644", "649"),
    ("65", "65"), ("3528", "3589"), ("300", "305"), ("36", "36"), ("38", "39"), ("62", "62"), ("50", "50"),
    ("56", "58"), ("67", "67"), ("2200", "2204"),
)
# Leading digits that no calling code has.
_UNCALLED = ("0", "28", "83", "89")
_PRIVATE = ("10.", "127.", "192.168.", "0.", "255.")
_DUMMIES = {"password", "changeme", "xxxxxxxx", "********", "undefined", "placeholder"}
_CUES = {
    "email": "mail e-mail email contact correo courriel write an",
    "ip": "ip host server address addr from login von client",
    "card": "card visa credit karte carte tarjeta payment pay",
    "phone": "phone tel call mobile fax telefon téléphone teléfono handy",
    "secret": "export config set key login env credentials",
}
_CUES = {kind: set(cues.split()) for kind, cues in _CUES.items()}
_AGAINST = set("version v ver release build isbn issn section page fig table no nr part rev".split())

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _NUMBERS.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in four):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(x for x in text if x in "0123456789")


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = _digits(found[0]) if len(found[0]) <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 8 <= sum(x in "0123456789" for x in found[0]) <= 15:
            yield found.span()


_STRICT = {"email": _emails, "ip": _addresses, "card": _cards, "phone": _phones}
_DIGIT = re.compile("[0-9]")


def strict_spans(text: str) -> list[Span]:
    """Strict spans by kind, then place; those of one kind do not overlap."""
    kinds = (["email"] if "@" in text else []) + (BASE_KINDS[1:] if _DIGIT.search(text) else [])
    return [(kind, *span) for kind in kinds for span in _STRICT[kind](text)]


def _wide_spans(text: str, strict: list[Span]) -> list[Span]:
    taken = np.zeros(0, bool)
    spans = []
    # What each pattern cannot do without.
    digits = bool(_DIGIT.search(text))
    needs = {"email": bool(_WRITTEN.search(text)), "ip": text.count(":") >= 7, "card": digits, "phone": digits}
    for kind, pattern in _WIDE.items():
        if not needs.get(kind, "=" in text or ":" in text):
            continue
        for found in pattern.finditer(text):
            start, end = found.span(1 if kind == "secret" else 0)
            if not len(taken):
                taken = np.zeros(len(text), bool)
                for _, a, b in strict:
                    taken[a:b] = True
            if not taken[start:end].any():
                taken[start:end] = True
                spans.append((kind, start, end))
    return spans


def _form(kind: str, body: str, digits: str) -> int:
    if kind == "email":
        return 1 if body[0] not in ".-" and ".." not in body else -1
    if kind == "ip":
        return -1 if any(len(x) > 1 and x[0] == "0" for x in body.split(".")) else 1
    if kind == "card":
        return 1 if luhn(digits) else -1
    if kind == "phone":
        if not 9 <= len(digits) <= 13:
            return -1
        return 1 if body[0] in "+(" or [len(x) for x in re.split("[^0-9]+", body)] == [3, 3, 4] else 0
    letters = sum(x.isalpha() for x in body)
    return 1 if digits and letters and len(set(body)) >= 6 else -1


def _listed(kind: str, body: str, digits: str) -> int:
    if kind == "email":
        last = re.split(r"[^a-z0-9-]+", body.lower())[-1]
        return 1 if last in _DOMAINS or len(last) == 2 and last.isalpha() else -1
    if kind == "ip":
        return -1 if body.startswith(_PRIVATE) else 0
    if kind == "card":
        return 1 if any(low <= digits[: len(low)] <= high for low, high in _ISSUERS) else -1
    if kind == "phone":
        return 0 if body[0] != "+" else -1 if digits.startswith(_UNCALLED) else 1
    return -1 if body.lower() in _DUMMIES else 0


def _votes(text: str, span: Span, strict: bool) -> tuple[int, ...]:
    kind, start, end = span
    body = text[start:end]
    digits = _digits(body)
    before = re.findall(r"[^\W\d_]+", text[max(0, start - _CUE_WINDOW) : start].lower())
    cue = 1 if _CUES[kind] & set(before) else -1 if _AGAINST & set(before) else 0
    left, right = text[max(0, start - 1) : start], text[end : end + 1]
    inside = left.isalnum() or right.isalnum() or left in {"+", "-", "/"} and kind != "phone"
    return (int(strict), _form(kind, body, digits), _listed(kind, body, digits), cue, -int(inside))


def context(text: str, span: Span) -> bytes:
    """Numbers of a span's character trigrams, with all digits as one, and of the words next
    to it, by kind; as sorted 16-bit integers."""
    kind, start, end = span
    body = f"^{re.sub('[0-9]', '0', text[start:end].lower())}$"
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 2 * _CUE_WINDOW) : start].lower())
    after = re.findall(r"[^\W\d_]+", text[end : end + 2 * _CUE_WINDOW].lower())
    marks = {body[k : k + 3] for k in range(len(body) - 2)}
    marks |= {f"<{word}" for word in before[-3:]} | {f">{word}" for word in after[:2]}
    own = {zlib.crc32(f"{kind} {mark}".encode("utf-8", "replace")) % BUCKETS for mark in marks}
    return np.array(sorted(own), "<u2").tobytes()


#: A span, whether it is strict, its pattern (votes, length, digits) and its context.
Proposal = tuple[Span, bool, str, bytes]


def proposals(text: str) -> list[Proposal]:
    strict = strict_spans(text)
    out = []
    wide = _wide_spans(text, strict)
    for spans, is_strict in ((strict, True), (wide, False)):
        for span in spans:
            kind, start, end = span
            votes = "".join("-0+"[vote + 1] for vote in _votes(text, span, is_strict))
            length = int(np.searchsorted(_LENGTHS, end - start, "right"))
            share = min(3, 4 * len(_digits(text[start:end])) // (end - start))
            out.append((span, is_strict, f"{votes}{length}{share}", context(text, span)))
    return out


_VOTES_AT = 1 + len(KINDS)
_SHAPE_AT = _VOTES_AT + 3 * LABELERS
_CONTEXT_AT = _SHAPE_AT + 8 + 4
_SIZE = _CONTEXT_AT + BUCKETS


def _features(kind: str, pattern: str, around: bytes, with_votes: bool = True) -> np.ndarray:
    """Which features a span has."""
    own = [0, 1 + KINDS.index(kind)]
    if with_votes:
        own += [_VOTES_AT + 3 * k + "-0+".index(vote) for k, vote in enumerate(pattern[:LABELERS])]
    own += [_SHAPE_AT + int(pattern[LABELERS]), _SHAPE_AT + 8 + int(pattern[LABELERS + 1])]
    return np.r_[own, _CONTEXT_AT + np.frombuffer(around, "<u2").astype(np.int64)]


@dataclass
class Model:
    """What was learnt: the labelers' reliabilities by kind, and the classifier."""

    prior: dict[str, float]
    reliability: dict[str, np.ndarray]
    weights: np.ndarray

    def probability(self, kind: str, pattern: str, around: bytes = b"") -> float:
        odds = self.weights[_features(kind, pattern, around)].sum()
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def _believed(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind: prior, reliability, belief in each row.

    ``reliability[y, k, v]`` is how often labeler k gives vote v to a span of class y.
    """
    # A vote against tells more at the start: most spans have a fair form.
    belief = np.clip(0.5 + 0.2 * (votes == 2).sum(1) - 0.4 * (votes == 0).sum(1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([1 - belief, belief]) * counts
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        seen = np.stack([(weight[:, :, None] * (votes == v)).sum(1) for v in range(3)], 2)
        # Labelers are taken to be right more often than not, as strongly as a share of the spans
        # says it: where a single labeler is not of one mind, counts alone cannot tell which is so.
        seen += (5 + _TRUST * counts.sum()) * np.array([[[0.5, 0.3, 0.2]], [[0.1, 0.3, 0.6]]])
        reliability = seen / seen.sum(2, keepdims=True)
        log = np.log(reliability)[:, np.arange(LABELERS), votes].sum(2)
        odds = np.log(prior) - np.log1p(-prior) + log[1] - log[0]
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return prior, reliability, belief


def _trained(features: list[np.ndarray], targets: np.ndarray, sizes: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic model with a ridge, by gradients scaled by what they were."""
    weights, seen = np.zeros(_SIZE), np.full(_SIZE, 1e-12)
    flat = np.concatenate(features)
    numbers = np.array([len(x) for x in features])
    starts = np.cumsum(numbers) - numbers
    # Characters and words are many and rare, so each may say less.
    ridge = np.where(np.arange(_SIZE) < _CONTEXT_AT, 1e-4, 1e-2)
    for _ in range(rounds):
        odds = np.add.reduceat(weights[flat], starts)
        slope = sizes * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - targets)
        slope = np.bincount(flat, np.repeat(slope, numbers), _SIZE) + ridge * weights
        seen += slope**2
        weights -= 0.3 * slope / np.sqrt(seen)
    return weights


def _fit(rows: list[tuple[str, str, int]], sample: list[tuple[str, str, bytes]] | None = None) -> Model:
    """The model for counts of ``(kind, pattern)``, the classifier trained on ``sample``."""
    sample = [(kind, pattern, b"") for kind, pattern, _ in rows] if sample is None else sample
    prior, reliability = {}, {}
    believed: dict[tuple[str, str], tuple[float, float]] = {}
    for kind in KINDS:
        own = [(pattern, count) for k, pattern, count in rows if k == kind]
        if not own:
            continue
        votes = np.array([["-0+".index(v) for v in pattern[:LABELERS]] for pattern, _ in own])
        counts = np.array([count for _, count in own], float)
        prior[kind], reliability[kind], belief = _believed(votes, counts)
        # Kinds weigh the same.
        for (pattern, _), value, part in zip(own, belief, counts / counts.sum()):
            believed[kind, pattern] = float(value), float(part)
    taken: dict[tuple[str, str], int] = {}
    for kind, pattern, _ in sample:
        taken[kind, pattern] = taken.get((kind, pattern), 0) + 1
    features, targets, sizes = [], [], []
    for kind, pattern, around in sample:
        target, part = believed[kind, pattern]
        for with_votes in (True, False):
            features.append(_features(kind, pattern, around, with_votes))
            targets.append(target), sizes.append(part / taken[kind, pattern])
    weights = _trained(features, np.array(targets), np.array(sizes)) if features else np.zeros(_SIZE)
    return Model(prior, reliability, weights)


_FOUND = (
    "doc_id long, spans array<struct<kind string, start long, end long, strict boolean, pattern string, "
    "context binary>>"
)
_FOUND_TYPE = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("strict", pa.bool_()),
            ("pattern", pa.string()),
            ("context", pa.binary()),
        ]
    )
)


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kind", "start", "end", "strict", "pattern", "context"]
    for batch in batches:
        spans = [
            [dict(zip(names, (*span, *rest))) for span, *rest in proposals(text.as_py() or "")]
            for text in batch["text"]
        ]
        yield pa.record_batch([batch["doc_id"], pa.array(spans, _FOUND_TYPE)], names=["doc_id", "spans"])


def proposed(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` with the proposed spans of each row, a null text has none."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_propose, _FOUND)


def fit(found: DataFrame) -> Model:
    """Learn from the spans of :func:`proposed`: their counts by pattern are collected, and
    the sample, whose rows each task cuts down to its own before they are exchanged."""
    spans = found.select("doc_id", F.explode("spans").alias("span")).select("doc_id", "span.*")
    counts = spans.groupBy("kind", "pattern").count()
    place = F.xxhash64("doc_id", "kind", "start", "context")
    order = Window.partitionBy("kind", "pattern").orderBy(place, "doc_id", "start", "context")
    sample = spans.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE)
    sample = sample.orderBy("kind", "pattern", "place").select("kind", "pattern", "context")
    rows = [(kind, pattern, bytes(around)) for kind, pattern, around in sample.collect()]
    return _fit([tuple(row) for row in counts.orderBy("kind", "pattern").collect()], rows)


def accepted(spans: list[Proposal], model: Model, threshold: float) -> list[Span]:
    kept = [s for s, strict, *rest in spans if strict or model.probability(s[0], *rest) > threshold]
    return sorted(kept, key=lambda span: (KINDS.index(span[0]), span[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _report(model: Model, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base_sha256", "spans", "n_secret"]
        for batch in batches:
            out = []
            for doc_id, spans in zip(batch["doc_id"].to_pylist(), batch["spans"].to_pylist()):
                found = [((s["kind"], s["start"], s["end"]), s["strict"], s["pattern"], s["context"]) for s in spans]
                base = [span for span, strict, *_ in found if strict]
                kept = accepted(found, model, threshold)
                out.append(
                    (
                        doc_id,
                        *(sum(span[0] == kind for span in base) for kind in BASE_KINDS),
                        hashlib.sha256(listed(base).encode()).hexdigest(),
                        listed(kept),
                        sum(span[0] == "secret" for span in kept),
                    )
                )
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, types)], names=names)

    return rows


def report(found: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """One row a document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans,
    n_secret``.

    Counts and digest are those of the strict spans; ``spans`` has all, strict or
    accepted, by kind, then place. Rows with the same ``doc_id`` stay apart; without
    spans the lists are empty.
    """
    return found.mapInArrow(
        _report(model, threshold),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_secret long",
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets.

    Where spans overlap, the widest reach is replaced by the kind that starts first.
    """
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redact(model: Model, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch["text"]:
                text = value.as_py()
                found = proposals(text) if text else []
                texts.append(masked(text, accepted(found, model, threshold)) if found else text)
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return rows


def redact(docs: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with personal data masked in ``text``; all other columns as they are.

    Without a model one is fitted to these documents first. Null texts stay null.
    """
    model = model or fit(written(proposed(docs)))
    return docs.mapInArrow(_redact(model, threshold), docs.schema)
