"""Personal data by weak supervision.

Strict patterns give the base spans: e-mail addresses, IP addresses, card and phone numbers.  Wider patterns give
further candidates, such as numbers without their country code or addresses written out.  Five labelers vote on every
candidate: a regex (strict shape), a checksum or length rule, a gazetteer, the words before it and the characters
beside it.  Expectation-maximisation over all candidates estimates how reliable each labeler is, and with that how
likely each candidate is personal data; a logistic span classifier, trained on those likelihoods, decides which
candidates join the base spans.

What is learned from are counts of patterns of sixteen bits per kind, summed by Spark over all documents: at most
262,144 numbers, however many documents there are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.workers import pieces

KINDS = ("email", "ip", "card", "phone")
BITS = 16
#: A candidate joins the base spans if the classifier gives it this much.
THRESHOLD = 0.8

# What the gazetteer and the context labeler know.
DOMAINS = frozenset("com org net edu gov mil int info biz io co eu uk us ca au de at ch fr be es it nl pt pl se no dk fi ie".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 86 90 91".split())
CUES = {
    "email": "mail e-mail email contact write correo courriel adresse schreib escribe",
    "ip": "ip host server client address addr adresse dirección from login",
    "card": "card visa mastercard amex credit debit carte karte kreditkarte tarjeta pan",
    "phone": "tel telephone phone call fax mobile cell handy telefon téléphone teléfono anruf appel llama whatsapp sms",
}
OTHER_CUES = frozenset("version v release section chapter fig figure table order invoice ref id no isbn issn sha token hash key build page".split())

_CUE_SETS = {kind: frozenset(words.split()) for kind, words in CUES.items()}
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: Digits with at most three other signs between them: every number pattern but the phone's lies in one such run.
_RUN = re.compile(r"[0-9]++(?:[ ./()_-]{1,3}[0-9]++)*+")
#: A run of digits is a match from its first digit or not at all.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WRITTEN_AT = ("(at)", "[at]", "{at}", "(AT)", "[AT]", "{AT}", " at ", " AT ", "@ ", " @")
_WRITTEN_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?:(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot |\.)[A-Za-z0-9-]{1,63}){1,5}", re.IGNORECASE)
_WIDE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![0-9.])")
_LONG_IP = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{0,2}[0-9]{2,6}){2,4}(?![0-9])")
_WIDE_PHONE = re.compile(r"(?<![0-9+])(?:00 ?[1-9][0-9]{0,2}[ ./-]?)?(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ ./-]{1,3}[0-9]{2,5}){1,4}(?![0-9])")
_WORD_BEFORE = re.compile(r"[^\W\d_][\w-]*", re.UNICODE)
#: A text without any of these has no candidates.
_SIGNS = re.compile(r"[0-9@]|[(\[{ ][Aa][Tt][)\]} ]")
_NOT_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    values = np.frombuffer(digits.encode(), np.uint8).astype(np.int64) - 48
    twice = values[-2::-2] * 2
    return bool((values[-1::-2].sum() + twice.sum() - 9 * (twice > 9).sum()) % 10 == 0)


def digits_of(text: str) -> str:
    return _NOT_DIGITS.sub("", text)


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[Span]:
    """From each at sign outwards: a name before it holds no other, so the leftmost match begins where its run begins."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        name = len(before) - len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if name else None
        if found:
            yield at - name, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _runs(text: str) -> list[tuple[int, int, int]]:
    """Start, end and number of digits of the runs that may hold a number of four digits or more."""
    found = ((m.start(), m.end(), len(digits_of(m.group()))) for m in _RUN.finditer(text) if m.end() - m.start() >= 4)
    return [r for r in found if r[2] >= 4]


def base_spans(text: str, runs: list[tuple[int, int, int]] | None = None) -> dict[str, list[Span]]:
    """The strict spans of each kind, leftmost and without overlaps among one kind."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    found["email"] = list(_emails(text))
    for a, b, size in _runs(text) if runs is None else runs:
        if text.find(".", a, b) >= 0:
            found["ip"] += [m.span() for m in _IP.finditer(text, a, b) if _small_parts(m.group())]
        if size >= 14:
            for m in _CARD.finditer(text, a, b):
                digits = digits_of(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
    found["phone"] = [m.span() for m in _PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return found


def _written_emails(text: str) -> Iterator[Span]:
    dots = "dot" in text or "DOT" in text
    for mark in _WRITTEN_AT:
        plain = mark in (" at ", " AT ")  # needs a written "dot", or prose would be full of candidates
        at = text.find(mark) if dots or not plain else -1
        while at >= 0:
            before = text[max(0, at - 64) : at].removesuffix(" ")
            name = len(before) - len(before.rstrip(_LOCAL))
            found = _WRITTEN_DOMAIN.match(text, at + len(mark)) if name else None
            if found and (not plain or "dot" in found.group().lower()):
                yield at - (text[at - 1] == " ") - name, found.end()
            at = text.find(mark, at + len(mark))


def _wide(text: str, runs: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    for a, b in _written_emails(text):
        yield "email", a, b
    if text.count(":") >= 7:
        for m in _LONG_IP.finditer(text):
            yield "ip", *m.span()
    for a, b, size in runs:
        a = a - 1 if a and text[a - 1] == "(" else a
        if text.find(".", a, b) >= 0:
            for m in _WIDE_IP.finditer(text, a, b):
                yield "ip", *m.span()
        for m in _WIDE_CARD.finditer(text, a, b) if size >= 13 else ():
            if 13 <= len(digits_of(m.group())) <= 19:
                yield "card", *m.span()
        for m in _WIDE_PHONE.finditer(text, a, b) if size >= 7 else ():
            if 7 <= len(digits_of(m.group())) <= 15:
                yield "phone", *m.span()


def candidates(text: str) -> tuple[dict[str, list[Span]], list[tuple[str, int, int]]]:
    """Base spans, and wider candidates that overlap none of them, in order of their start."""
    if not _SIGNS.search(text):
        return {kind: [] for kind in KINDS}, []
    runs = _runs(text)
    base = base_spans(text, runs)
    taken = sorted(s for spans in base.values() for s in spans)
    starts = np.array([s for s, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    more = []
    for kind, a, b in sorted(set(_wide(text, runs)), key=lambda c: (c[1], KINDS.index(c[0]), c[2])):
        k = int(np.searchsorted(starts, b, side="left"))  # base spans that begin before this one ends
        if not (k and reach[k - 1] > a):
            more.append((kind, a, b))
    return base, more


def features(text: str, kind: str, start: int, end: int, strict: bool) -> int:
    """Sixteen bits on a span: its shape, its checks, what stands before and beside it."""
    span = text[start:end]
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    digits = digits_of(span) if kind != "email" else ""
    if kind == "email":
        tail = re.split(r"\.|dot", span.lower())[-1].strip(" )]}")
        passes, fails = tail.isalpha() and len(tail) > 1, not tail.isalpha()
        known, unknown = tail in DOMAINS, tail not in DOMAINS
    elif kind == "ip":
        parts = re.split(r"[.:]", span)
        passes = len(parts) == 8 or all(p.strip().isdigit() and int(p) <= 255 for p in parts)
        fails, first = not passes, parts[0].strip()
        known, unknown = len(parts) == 8 or first not in ("0", "00", "000"), first in ("0", "00", "000")
    elif kind == "card":
        passes = luhn(digits)
        fails = not passes
        known, unknown = digits[0] in "3456", digits[0] not in "3456"
    else:
        passes, fails = len(digits) >= 10, len(digits) < 9
        code = digits[2:] if digits.startswith("00") else digits if span[0] == "+" else ""
        known, unknown = bool(code) and any(code[:k] in CALLING_CODES for k in (1, 2)), False
    words = [w.lower() for w in _WORD_BEFORE.findall(text[max(0, start - 40) : start])[-4:]]
    separators = set(span) & set(" .-()/_:")
    clean_left = not (left.isalnum() or left in "_=/#") if left else True
    clean_right = not (right.isalnum() or right in "_=/") if right else True
    bits = (
        strict, passes, fails, known, unknown, any(w in _CUE_SETS[kind] for w in words),
        any(w in OTHER_CUES for w in words), clean_left, clean_right, bool(separators), len(separators) > 1,
        span[0] in "+(" or span.startswith("00"), len(digits) >= 13, (not left or left.isspace()) and (not right or right.isspace()),
        right in "%$€£" if right else False, left in "\"'`" if left else False,
    )
    return sum(1 << k for k, bit in enumerate(bits) if bit)


@dataclass(frozen=True)
class Labeler:
    """Which bits are its vote for and against; what it is believed to do before any data is seen."""

    name: str
    votes_for: int
    votes_against: int
    #: Beliefs (for, against, abstain) about personal data and about anything else, worth ``weight`` candidates.
    if_personal: tuple[float, float, float]
    if_other: tuple[float, float, float]
    weight: float = 20.0

    def vote(self, pattern: np.ndarray) -> np.ndarray:
        """0 for, 1 against, 2 abstains; all bits of the vote for are needed, any bit of the vote against is enough."""
        for_, against = (pattern & self.votes_for) == self.votes_for, (pattern & self.votes_against) > 0
        return np.where(against, 1, np.where(for_, 0, 2))


LABELERS = (
    Labeler("regex", 1 << 0, 0, (0.7, 0.0, 0.3), (0.2, 0.0, 0.8)),
    Labeler("check", 1 << 1, 1 << 2, (0.94, 0.01, 0.05), (0.15, 0.75, 0.1)),
    Labeler("gazetteer", 1 << 3, 1 << 4, (0.6, 0.1, 0.3), (0.3, 0.4, 0.3)),
    Labeler("context", 1 << 5, 1 << 6, (0.4, 0.02, 0.58), (0.02, 0.2, 0.78)),
    Labeler("boundary", 1 << 7 | 1 << 8 | 1 << 13, 1 << 14 | 1 << 15, (0.7, 0.02, 0.28), (0.45, 0.2, 0.35)),
)


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50, prior: float = 0.3) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation over one kind: the share of personal data, P(vote | class) by labeler, and each pattern's likelihood.

    Labelers are taken as independent given the class; their beliefs count as that many further candidates, which
    keeps the classes from changing places and decides alone where there are no data.
    """
    votes = np.stack([lab.vote(patterns) for lab in LABELERS], axis=1) if len(patterns) else np.empty((0, len(LABELERS)), np.int64)
    believed = np.array([[lab.if_other, lab.if_personal] for lab in LABELERS])  # labeler, class, vote
    weight = np.array([lab.weight for lab in LABELERS])[:, None, None]
    tables, share = believed, prior
    for _ in range(rounds):
        chance = np.log(np.array([1 - share, share]))[None, :] + sum(
            (np.log(np.maximum(tables[k], 1e-9)).T[votes[:, k]] for k in range(len(LABELERS))), np.zeros((len(votes), 2))
        )
        likely = 1 / (1 + np.exp(np.clip(chance[:, 0] - chance[:, 1], -500, 500)))
        mass = np.stack([counts * (1 - likely), counts * likely])
        seen = np.stack([
            np.stack([np.bincount(votes[:, k], mass[c], 3) for c in (0, 1)]) for k in range(len(LABELERS))
        ])
        tables = (seen + weight * believed) / (seen.sum(axis=2, keepdims=True) + weight)
        share = (mass[1].sum() + 10 * prior) / (counts.sum() + 10)
    return float(share), tables, likely


def _bits(patterns: np.ndarray) -> np.ndarray:
    bits = (patterns[:, None] >> np.arange(BITS)) & 1
    return np.concatenate([bits, np.ones((len(patterns), 1), np.int64)], axis=1).astype(float)


def logistic(patterns: np.ndarray, counts: np.ndarray, likely: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Weights of the sixteen bits and a constant: Newton's method on the likelihoods as soft labels."""
    x, w = _bits(patterns), np.zeros(BITS + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (likely - p)) - ridge * w
        curve = (x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(BITS + 1)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class Model:
    """Per kind: the classifier's weights, the share of personal data among the candidates, the labelers' tables."""

    weights: dict[str, np.ndarray]
    shares: dict[str, float]
    tables: dict[str, np.ndarray]

    def score(self, kind: str, pattern: int) -> float:
        w = self.weights[kind]
        total = w[BITS] + sum(w[k] for k in range(BITS) if pattern >> k & 1)
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(patterns: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """A model from each kind's distinct patterns and how many candidates have them."""
    weights, shares, tables = {}, {}, {}
    for kind in KINDS:
        which, counts = patterns.get(kind, (np.empty(0, np.int64), np.empty(0)))
        shares[kind], tables[kind], likely = reliabilities(which, counts.astype(float))
        weights[kind] = logistic(which, counts.astype(float), likely)
    return Model(weights, shares, tables)


def pattern_counts(text: str) -> Counter:
    """How many candidates, base spans included, have each kind and pattern."""
    base, more = candidates(text)
    found = Counter((kind, features(text, kind, a, b, True)) for kind, spans in base.items() for a, b in spans)
    found.update((kind, features(text, kind, a, b, False)) for kind, a, b in more)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: Counter = Counter()
    for batch in pieces(batches, "text"):
        for text in batch.column("text").to_pylist():
            if text:
                totals.update(pattern_counts(text))
    keys = list(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.int64()), pa.array([totals[k] for k in keys], pa.int64())],
        names=["kind", "pattern", "n"],
    )


def learn(docs: DataFrame, text: str = "text") -> Model:
    """A model of all candidates of all documents.  Null and empty texts have none; without any, beliefs decide nothing."""
    rows = docs.select(F.col(f"`{text}`").alias("text"))
    counts = rows.mapInArrow(_counted, "kind string, pattern bigint, n bigint").groupBy("kind", "pattern").agg(F.sum("n").alias("n"))
    found = sorted(counts.collect(), key=lambda r: (r["kind"], r["pattern"]))  # at most 4 x 65,536 rows
    return fit({
        kind: (
            np.array([r["pattern"] for r in found if r["kind"] == kind], np.int64), np.array([r["n"] for r in found if r["kind"] == kind], np.int64),
        ) for kind in KINDS
    })


def all_spans(text: str, model: Model, threshold: float = THRESHOLD) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and base and added spans together: ``(start, end, kind)``, by start, then kind as listed.

    Of added candidates that overlap, the likelier stays; equal ones by start, then kind, then the shorter.
    """
    base, more = candidates(text)
    kept = [(a, b, kind) for kind, spans in base.items() for a, b in spans]
    added: list[tuple[int, int, str]] = []  # by start; they do not overlap
    rated = [(-model.score(kind, features(text, kind, a, b, False)), a, KINDS.index(kind), b, kind) for kind, a, b in more]
    for score, a, _, b, kind in sorted(rated):
        if -score < threshold:
            break
        place = bisect_left(added, (a, b, kind))
        if (place == 0 or added[place - 1][1] <= a) and (place == len(added) or b <= added[place][0]):
            added.insert(place, (a, b, kind))

    def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))

    return ordered(kept), ordered(kept + added)


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in capitals and angle brackets; of overlapping ones the first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, mask: bool = False) -> DataFrame:
    """The rows of ``docs`` as struct ``_row`` with ``n_email n_ip n_card n_phone base_sha256 spans``, and ``masked`` on request.

    Counts and digest are of the base spans; ``spans`` has the added ones too.  Places are code points, ends exclusive.
    A null text is an empty one and has no spans (``masked`` stays null); very long texts are read whole, in time
    proportional to their length; repeated rows get equal results; other columns pass through, whatever their names.
    """
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            rows = []
            for one in batch.column("_text").to_pylist():
                base, every = all_spans(one or "", model, threshold)
                counts = Counter(kind for _, _, kind in base)
                digest = hashlib.sha256(_written(base).encode()).hexdigest()
                rows.append([*[counts[k] for k in KINDS], digest, _written(every), masked(one, every) if one is not None and mask else None])
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["_row", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "masked"],
            )

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    found = step.mapInArrow(run, f"_row {step.schema['_row'].dataType.simpleString()}, {counts}, base_sha256 string, spans string, masked string")
    return found if mask else found.drop("masked")
