"""Personal data: strict patterns, and a boosted-tree choice among further candidates.

Strict patterns (``base_spans``) find e-mail addresses, IP addresses, payment
cards and phone numbers that stand in the prescribed form. They take the longest
run and do not try again, so a card number next to another number, or a phone
number run into the digits after it, fails its check and is lost.

The method wins those back. Generators propose every run of digit groups within
a broken match and every broken address near one, overlapping as they may. Each
proposal is described by its format and its surroundings. Gradient-boosted trees
rank them, a calibration turns ranks into probabilities, and a threshold per kind
picks redactions. Strict spans always stay; a pick never overlaps one of its kind.

Labels come from the texts: strict spans are positive; the wrong cuts that the
generators make of a strict span, and proposals outside any strict match, are
negative; proposals inside a broken match are unknown and left to the model. The
model is fitted on documents with the smallest hashes (``SAMPLE`` of them, about),
half of which calibrate it. Everything else covers all rows and whole texts.

Null text counts as empty. Repeated rows are scored alike. Work is linear in the
length of a text, but for the short windows within one run of digits. An empty
table gives no rows, and a sample without proposals gives a model that adds none.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents the model is fitted on, about.
SAMPLE = 4_000
#: Labelled proposals that one document of the sample gives at most.
PER_TEXT = 64
#: Least calibrated probability of a pick, by kind.
THRESHOLDS = {"email": 0.95, "ip": 0.95, "card": 0.95, "phone": 0.95}

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9]+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){2,}")
_LOOSE_PHONE = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
_SPELLED = re.compile(r"\b([\w.+-]{1,64}) ?[(\[] ?at ?[)\]] ?([\w-]{1,63}(?:(?: ?[(\[] ?dot ?[)\]] ?|\.)[\w-]{1,63}){1,8})", re.I | re.A)


def luhn(digits: str) -> bool:
    total = 0
    for i, sign in enumerate(reversed(digits)):
        value = ord(sign) - 48
        if i % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long runs cost one look."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Every strict match (kind, start, end, whether it passes), by kind and start."""
    for start, end in _emails(text):
        yield "email", start, end, True
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), _octets(m[0])
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            yield "card", m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 8 <= sum(c.isdigit() for c in m[0]) <= 15


def base_spans(text: str) -> list[Span]:
    return [(kind, a, b) for kind, a, b, good in base_matches(text) if good]


@dataclass
class Proposal:
    kind: str
    start: int
    end: int
    label: float  # 1, 0, or nan where unknown


def _windows(text: str, start: int, end: int, least: int, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole digit groups between ``start`` and ``end`` with ``least`` to ``most`` digits."""
    groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, start, end)]
    for i in range(len(groups)):
        total = 0
        for j in range(i, len(groups)):
            total += groups[j][1] - groups[j][0]
            if total > most:
                break
            if total >= least:
                yield groups[i][0], groups[j][1]


def proposals(text: str, matches: list[tuple[str, int, int, bool]]) -> Iterator[Proposal]:
    """Candidates of all kinds: strict spans, cuts of strict matches, and looser forms."""
    taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for kind, start, end, good in matches:
        taken[kind].append((start, end))
        if good:
            yield Proposal(kind, start, end, 1.0)
        unknown = 0.0 if good else float("nan")
        if kind == "card":
            for a, b in _windows(text, start, end, 12, 19):
                if (a, b) != (start, end):
                    yield Proposal(kind, a, b, unknown)
        elif kind == "phone":
            for a, b in _windows(text, start + 1, end, 7, 15):
                if a == start + 1 and b != end:
                    yield Proposal(kind, start, b, unknown)
        elif kind == "ip" and not good:
            yield Proposal(kind, start, end, 0.0)
    outside = {k: ([a for a, _ in v], v) for k, v in taken.items()}

    def free(kind: str, a: int, b: int) -> bool:
        starts, spans = outside[kind]
        i = bisect.bisect_left(starts, b) - 1
        return i < 0 or spans[i][1] <= a

    for m in _DOTTED.finditer(text):
        if free("ip", m.start(), m.end()):
            yield Proposal("ip", m.start(), m.end(), 0.0)
    for m in _LOOSE_PHONE.finditer(text):
        if free("phone", m.start(), m.end()):
            yield Proposal("phone", m.start(), m.end(), 0.0)
    if "(" in text or "[" in text:
        for m in _SPELLED.finditer(text):
            if free("email", m.start(), m.end()):
                yield Proposal("email", m.start(), m.end(), float("nan"))


FEATURES = ("kind", "signs", "digits", "groups", "longest_group", "shortest_group", "letters", "blanks", "dots", "dashes",
            "brackets", "plus", "at", "luhn", "octets", "digit_before", "digit_after", "letter_before", "letter_after",
            "sign_before", "sign_after", "near_digit_before", "near_digit_after", "distinct_digits", "tail")


def features(text: str, p: Proposal) -> list[float]:
    """Format and surroundings of a proposal, in the order of ``FEATURES``."""
    span = text[p.start:p.end]
    groups = _GROUP.findall(span)
    digits = "".join(groups)
    before, after = text[max(0, p.start - 2):p.start], text[p.end:p.end + 2]
    b, a = before[-1:], after[:1]
    sizes = [len(g) for g in groups] or [0]
    tail = re.search(r"\.([A-Za-z]+)$", span)
    parts = span.split(".")
    return [KINDS.index(p.kind), len(span), len(digits), len(groups), max(sizes), min(sizes), sum(c.isalpha() for c in span),
            span.count(" "), span.count("."), span.count("-"), span.count("(") + span.count("["), span.startswith("+"),
            "@" in span or " at " in span or "(at)" in span or "[at]" in span, len(digits) >= 12 and luhn(digits),
            len(parts) == 4 and all(x.isdigit() for x in parts) and _octets(span), b.isdigit(), a.isdigit(), b.isalpha(),
            a.isalpha(), b in "+#-/_=." and b != "", a in "-/_=@" and a != "", any(c.isdigit() for c in before),
            any(c.isdigit() for c in after), len(set(digits)), len(tail[1]) if tail else 0]


class Boosted:
    """Gradient-boosted regression trees for a yes-or-no label, in numpy.

    Trees of fixed depth on values cut at quantiles; leaves take Newton steps.
    """

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.3, cuts: int = 32, least: int = 5):
        self.rounds, self.depth, self.rate, self.cuts, self.least = rounds, depth, rate, cuts, least
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bias = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(mean / (1 - mean)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.cuts))) for f in range(x.shape[1])]
        raw = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            tree = self._tree(x, p - y, p * (1 - p), edges)
            self.trees.append(tree)
            raw += self._walk(tree, x)
        return self

    def _tree(self, x, grad, hess, edges):
        size = 2 ** self.depth
        feature, limit, value = np.full(size - 1, -1), np.zeros(size - 1), np.zeros(size)
        node = np.zeros(len(grad), dtype=int)
        for level in range(self.depth):
            first = 2 ** level - 1
            for k in range(2 ** level):
                rows = np.flatnonzero(node == k)
                best = self._split(x, grad, hess, edges, rows) if len(rows) >= 2 * self.least else None
                if best:
                    feature[first + k], limit[first + k] = best
                    right = x[rows, best[0]] > best[1]
                else:
                    right = np.zeros(len(rows), dtype=bool)
                node[rows] = 2 * k + right
        g = np.bincount(node, grad, size)
        h = np.bincount(node, hess, size)
        value[:] = np.clip(-g / (h + 1.0), -4, 4) * self.rate
        return feature, limit, value

    def _split(self, x, grad, hess, edges, rows):
        g, h = grad[rows], hess[rows]
        all_g, all_h, best, found = g.sum(), h.sum(), 1e-6, None
        for f, cut in enumerate(edges):
            if len(cut) < 2:
                continue
            place = np.searchsorted(cut, x[rows, f], side="left")
            n = np.cumsum(np.bincount(place, minlength=len(cut) + 1))[:-1]
            left_g = np.cumsum(np.bincount(place, g, len(cut) + 1))[:-1]
            left_h = np.cumsum(np.bincount(place, h, len(cut) + 1))[:-1]
            gain = left_g ** 2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g ** 2 / (all_h + 1)
            gain[(n < self.least) | (len(rows) - n < self.least)] = 0
            if gain.max() > best:
                best, found = gain.max(), (f, cut[gain.argmax()])
        return found

    def _walk(self, tree, x):
        feature, limit, value = tree
        node = np.zeros(len(x), dtype=int)
        every = np.arange(len(x))
        for level in range(self.depth):
            at = 2 ** level - 1 + node
            node = 2 * node + ((feature[at] >= 0) & (x[every, feature[at]] > limit[at]))
        return value[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for tree in self.trees:
            total += self._walk(tree, x)
        return total


@dataclass
class Model:
    trees: Boosted | None
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.raw(x) + self.shift, -40, 40)))


def calibrate(raw: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Slope and shift of a logistic curve from ranks to labels, by Newton steps
    with targets pulled in from 0 and 1 so that separable labels stay finite."""
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - target) * raw).sum(), (p - target).sum()])
        hess = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, sample: int = SAMPLE, per_text: int = PER_TEXT) -> Model:
    """Fit and calibrate on about ``sample`` documents, chosen by a hash of the row.

    Tasks send back one row of numbers per labelled proposal, no text, and at most
    ``per_text`` from a document, so the driver's share is bounded by the sample.
    """
    rows = docs.count()
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    share = 1_000_000 if rows <= sample else max(1, int(1_000_000 * sample / rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, half in zip(batch["text"], batch["half"]):
                known = [p for p in proposals(text, list(base_matches(text))) if p.label == p.label]
                known = sorted(known, key=lambda p: _order(text[p.start:p.end]))[:per_text]
                out += [(int(half), p.label, [float(v) for v in features(text, p)]) for p in known]
            yield pd.DataFrame(out, columns=["half", "label", "x"])

    picked = docs.where(F.col("text").isNotNull() & (part < share)).select(
        "text", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("half"))
    found = picked.mapInPandas(run, "half int, label double, x array<double>").toPandas()
    if found.empty:
        return Model(None)
    found["x"] = found["x"].map(tuple)
    found = found.sort_values(["half", "label", "x"])  # the fit then does not depend on which task came first
    x, y, half = np.array(found["x"].tolist()), found["label"].to_numpy(), found["half"].to_numpy()
    first, second = half == 0, half == 1
    if len(set(y[first])) < 2 or len(set(y[second])) < 2:
        return Model(None)
    trees = Boosted().fit(x[first], y[first])
    return Model(trees, *calibrate(trees.raw(x[second]), y[second]))


def _order(text: str) -> bytes:
    return hashlib.md5(text.encode()).digest()


def spans(texts: list[str], model: Model, thresholds: dict[str, float] = THRESHOLDS) -> list[tuple[list[Span], list[Span]]]:
    """(strict spans, all spans) of each text, ordered by kind and start."""
    strict, open_, owner, rows = [], [], [], []
    for i, text in enumerate(texts):
        matches = list(base_matches(text))
        strict.append([(k, a, b) for k, a, b, good in matches if good])
        for p in proposals(text, matches):
            if p.label != 1.0:
                open_.append(p)
                owner.append(i)
                rows.append(features(text, p))
    chances = model.probability(np.array(rows, dtype=float).reshape(len(rows), len(FEATURES)))
    extra: list[list[tuple[float, Proposal]]] = [[] for _ in texts]
    for p, i, chance in zip(open_, owner, chances):
        if chance >= thresholds[p.kind]:
            extra[i].append((chance, p))
    out = []
    for base, more in zip(strict, extra):
        chosen = list(base)
        kept = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS} if more else {}
        # Likeliest first; of equally likely ones the longer, then the earlier.
        for _, p in sorted(more, key=lambda c: (-round(c[0], 9), c[1].start - c[1].end, c[1].start)):
            at = bisect.bisect_left(kept[p.kind], (p.start, p.end))
            near = kept[p.kind][max(0, at - 1):at + 1]
            if all(b <= p.start or a >= p.end for a, b in near):
                kept[p.kind].insert(at, (p.start, p.end))
                chosen.append((p.kind, p.start, p.end))
        out.append((base, sorted(chosen, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def listed(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def mask(text: str, found: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by [KIND]."""
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (strict), base_sha256, spans (all)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            found = spans(texts, model)
            out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64")})
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(s[0] == kind for s in base) for base, _ in found]
            out["base_sha256"] = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]
            out["spans"] = [listed(every) for _, every in found]
            yield out
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with all spans masked in ``text`` and ``n_chars`` counted
    anew. Rows of null text and all other columns stay as they are."""
    @F.pandas_udf("string")
    def masked(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            plain = [t or "" for t in batch]
            found = spans(plain, model)
            yield pd.Series([None if t is None else mask(t, every) for t, (_, every) in zip(batch, found)], dtype=object)

    return docs.withColumns({"text": masked(F.col("text"))}).withColumn(
        "n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))
