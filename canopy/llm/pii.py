"""Personal data by scored candidates.

Three steps. Generators with high recall propose overlapping spans: addresses
with ``@`` or a spelled "at", and every sequence of neighbouring digit groups
that could be a card, a phone number or an IP address. Boosted trees score each
proposal from features of its format (groups, separators, checksum, ranges) and
of its context (what stands before and after, cue words nearby). Thresholds on
calibrated probabilities, one per kind, choose the spans; overlapping choices
go to the more probable one. Spans of the strict base patterns always stay.

Training needs no labelled table. Base spans are found in all texts; a sample of
at most ``SAMPLE_TEXTS`` different texts, dealt evenly over the kinds (texts that
hold a base span of the kind) and the texts that may hold a proposal but no base span,
is chosen by hash. ``SEED_TEXTS`` fixed texts of every kind are added to it, so
every kind is learned and calibrated whatever the table holds of it. Of the sample's
proposals the fit takes at most ``SAMPLE_PROPOSALS`` of each kind and label, those
with the least hashes; spans are still looked for in whole texts. The positives
are base spans, and the same spans rewritten in the ways people write them (spelled
separators, other groupings, no country code). Negatives are proposals that
fail the strict checks and the sample's digits rewritten as dates, times,
amounts and versions. A third of the texts, chosen by hash, is held back: it
calibrates the probabilities and sets, per kind, the lowest threshold that
keeps ``MIN_PRECISION`` there, or the highest one where none does.

Defined results: a null text is empty and has no spans; offsets count code
points, end exclusive; repeated rows are each searched; ids are only carried;
an empty table gives no rows; other columns are not read by :func:`find` and carried by
:func:`redact`, whatever their names.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, hash_share, joined, quoted, ship, slices, strings, text_or_empty

# --- fixed values: kinds in their order, and the base patterns ---
KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCAL = "A-Za-z0-9._%+-"
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)
# --- end of fixed values ---

# --- production parameters ---
SAMPLE_TEXTS = 3000
MIN_PRECISION = 0.995
SEED_TEXTS = 120
SAMPLE_PROPOSALS = 20_000
THRESHOLDS = (0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 0.999)
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
# --- end of parameters ---

#: Proposals that are taken up at a time, in training and in a text.
TASK_PROPOSALS = 4096

Span = tuple[int, int, str]
_LOCAL_RUN = re.compile(rf"[{EMAIL_LOCAL}]+")
_NEEDS = re.compile(r"[0-9@]")


# ------------------------------------------------------------------ base spans
def luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return (sum(own[0::2]) + sum(d * 2 - 9 * (d > 4) for d in own[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches in linear time: a match holds exactly one ``@``, and
    starts as far left of it as local characters and the previous match allow."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start, then kind."""
    spans = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        d = _digits(m.group())
        if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and luhn(d):
            spans.append((*m.span(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m.group())) <= PHONE_DIGITS[1]:
                spans.append((*m.span(), "phone"))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# ------------------------------------------------------------------ proposals
_MARKED_AT = r"[\[(]\s?at\s?[\])]"
_AT = re.compile(rf"@|\s?{_MARKED_AT}\s?| at ")
_LEFT = re.compile(rf"[{EMAIL_LOCAL}]{{1,64}}\Z")
_DOT = r"(?:\.|\s?[\[(]\s?(?:dot|\.)\s?[\])]\s?| dot )"
_RIGHT = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}})*")
_RUN = re.compile(r"[+(]?[0-9]+(?:(?: ?[-./:() ] ?|[\[(](?:\.|dot)[\])]| dot )[+(]?[0-9]+)*")
_GROUP = re.compile(r"[+(]*[0-9]+")
_CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
         "card": ("card", "visa", "credit", "payment"), "phone": ("call", "phone", "tel", "mobile", "fax")}


_MARKED = re.compile(_MARKED_AT)


def _has_at(text: str) -> bool:
    """Whether ``_AT`` matches anywhere, found faster."""
    return "@" in text or " at " in text or _MARKED.search(text) is not None


def _may_hold(text: str) -> bool:
    """False only for texts without proposals and base spans: each has a digit or a match of ``_AT``."""
    return _NEEDS.search(text) is not None or _has_at(text)


def proposals(text: str) -> list[Span]:
    """Overlapping candidate spans of every kind."""
    return list(propose(text))


def propose(text: str) -> Iterator[Span]:
    """The same one by one, so that a text need not hold them all."""
    if _has_at(text):
        for m in _AT.finditer(text):
            left = _LEFT.search(text, max(0, m.start() - 64), m.start())
            right = _RIGHT.match(text, m.end())
            if left and right and (m.group() != " at " or re.search(r"dot|\.", right.group())):
                yield left.start(), right.end(), "email"
    for run in _RUN.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            total = 0
            for j in range(i, len(groups)):
                total += sum(c.isdigit() for c in text[groups[j][0]:groups[j][1]])
                if total > CARD_DIGITS[1]:
                    break
                end = groups[j][1]
                if total >= CARD_DIGITS[0]:
                    yield start, end, "card"
                if 7 <= total <= PHONE_DIGITS[1]:
                    yield start, end, "phone"
                if j - i == 3 and total <= 12:
                    yield start, end, "ip"


def chains(likely: list[tuple[float, Span]]) -> Iterator[list[tuple[float, Span]]]:
    """Groups of spans that overlap each other, directly or by others."""
    group: list[tuple[float, Span]] = []
    reach = 0
    for x in sorted(likely, key=lambda x: x[1]):
        if group and x[1][0] >= reach:
            yield group
            group, reach = [], 0
        group.append(x)
        reach = max(reach, x[1][1])
    if group:
        yield group


class Taken:
    """Places that spans cover, as intervals apart from each other in order, so
    a look-up is a bisection. With ``among`` they are the union of those spans."""

    def __init__(self, among: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, _ in sorted(among):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, span: Span) -> bool:
        """Whether the span overlaps any: the last interval that begins before
        its end reaches furthest."""
        k = bisect.bisect_left(self.starts, span[1])
        return k > 0 and self.ends[k - 1] > span[0]

    def add(self, span: Span) -> None:
        """A span that meets none."""
        k = bisect.bisect_left(self.starts, span[0])
        self.starts.insert(k, span[0])
        self.ends.insert(k, span[1])


def features(text: str, span: Span) -> list[float]:
    """Format and context of one proposal."""
    start, end, kind = span
    own, digits = text[start:end], _digits(text[start:end])
    groups = re.findall(r"[0-9]+", own)
    marks = re.sub(r"[0-9A-Za-z]", "", own)
    before, after = text[max(0, start - 1):start], text[end:end + 1]
    near = text[max(0, start - 24):start].lower()
    sizes = [len(g) for g in groups] or [0]
    right = own.rsplit("@", 1)[-1] if "@" in own else re.split(r"at[\])]?\s?", own, maxsplit=1)[-1]
    return [float(x) for x in (
        *(kind == k for k in KINDS), len(own), len(digits), len(groups), max(sizes), min(sizes), sizes[-1],
        sizes[0], len(marks), len(set(marks)), "+" in own, "(" in own, marks.count("."), marks.count("-"),
        marks.count(" "), "@" in own, bool(re.search(r"\bat\b", own)), len(re.findall(r"\bdot\b", own)),
        len(re.findall(_DOT, right)), bool(digits) and len(digits) >= 12 and luhn(digits),
        bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        ":" in own or "/" in own, before.isalnum(), after.isalnum(), before in ("+", "-", ".", "/", ":", "="),
        after in ("-", "/", ":", "%"), any(c in near for c in _CUES[kind]),
        len(digits) == 8 and digits[:2] in ("19", "20"))]


# ------------------------------------------------------------------ boosted trees
@dataclass
class Boosted:
    """Gradient boosting with logistic loss over binned features."""
    edges: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS)[1:])) for k in range(x.shape[1])]
        bins, share = self._bins(x), np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        margin, width = np.full(len(y), self.start), BINS + 1
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            grad, weight = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature, cut = np.full(2 ** DEPTH, -1), np.zeros(2 ** DEPTH, dtype=np.int64)
            for level in range(DEPTH):
                first = 2 ** level  # nodes of a level are numbered from first on, heap order
                for k in range(first, 2 * first):
                    rows = np.flatnonzero(node == k - first) if level else np.arange(len(y))
                    if len(rows) < 20:
                        continue
                    best = 1e-6
                    total_g, total_w = grad[rows].sum(), weight[rows].sum()
                    for f in range(x.shape[1]):
                        g = np.cumsum(np.bincount(bins[rows, f], grad[rows], width))[:-1]
                        w = np.cumsum(np.bincount(bins[rows, f], weight[rows], width))[:-1]
                        gain = g ** 2 / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1) - total_g ** 2 / (total_w + 1)
                        at = int(np.argmax(gain))
                        if gain[at] > best:
                            best, feature[k], cut[k] = gain[at], f, at
                go = np.array([feature[first + n] >= 0 and bins[i, feature[first + n]] > cut[first + n]
                               for i, n in enumerate(node)], dtype=np.int64)
                node = 2 * node + go
            leaf = np.bincount(node, grad, 2 ** DEPTH) / (np.bincount(node, weight, 2 ** DEPTH) + 1) * RATE
            margin += leaf[node]
            self.trees.append((feature, cut, leaf))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins, out = self._bins(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                node = 2 * node + ((f >= 0) & (bins[rows, np.maximum(f, 0)] > cut[node]))
            out += leaf[node - 2 ** DEPTH]
        return out


@dataclass
class Model:
    """Boosted trees with calibrated thresholds; without trees it adds nothing."""
    trees: Boosted | None = None
    scale: float = 1.0
    shift: float = 0.0
    threshold: dict[str, float] = field(default_factory=dict)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.trees.margin(x) + self.shift)))

    def added(self, text: str, base: list[Span]) -> list[tuple[Span, float]]:
        """Chosen proposals that overlap neither base spans nor better choices."""
        if self.trees is None or not self.threshold:
            return []
        of_base = Taken(base)
        open_ = (s for s in propose(text) if s[2] in self.threshold and not of_base.meets(s))
        likely: list[tuple[float, Span]] = []  # of a part at a time, what reaches its threshold
        while part := list(islice(open_, TASK_PROPOSALS)):
            p = self.probability(np.array([features(text, s) for s in part])).tolist()
            likely += [(prob, s) for prob, s in zip(p, part) if prob >= self.threshold[s[2]]]
        chosen: list[tuple[Span, float]] = []
        for group in chains(likely):
            taken = Taken()
            for prob, s in sorted(group, key=lambda x: (-x[0], x[1][0] - x[1][1], x[1])):
                if not taken.meets(s):
                    taken.add(s)
                    chosen.append((s, prob))
        return chosen


# ------------------------------------------------------------------ training
def rewritten(own: str, kind: str) -> tuple[list[str], list[str]]:
    """Other ways to write a base span, and harmless things with its digits."""
    d = _digits(own).ljust(16, "0")
    if kind == "email":
        local, domain = own.split("@", 1)
        spelled = domain.replace(".", " dot ")
        return ([f"{local} at {spelled}", f"{local}[at]{domain.replace('.', '[dot]')}", f"{local} (at) {domain}"],
                [f"{local} at {domain.split('.')[0]}"])
    if kind == "ip":
        return [own.replace(".", "[.]"), own.replace(".", " dot ")], [f"{d[0]}.{d[1]}.{d[2]}", f"{d[:2]}:{d[2:4]}:{d[4:6]}"]
    if kind == "card":
        c = _digits(own)
        fours = [c[i:i + 4] for i in range(0, len(c), 4)]
        wrong = c[:-1] + str((int(c[-1]) + 5) % 10)
        return [".".join(fours), " - ".join(fours), "/".join(fours)], [wrong, ".".join(wrong[i:i + 4] for i in range(0, len(c), 4))]
    c = _digits(own)[-10:]
    return ([f"({c[:3]}) {c[3:6]}-{c[6:]}", f"{c[:3]}-{c[3:6]}-{c[6:]}", f"{c[:3]}.{c[3:6]}.{c[6:]}"],
            [f"20{c[:2]}-0{c[2]}-1{c[3]}", f"20{c[:2]}-0{c[2]}-1{c[3]} 1{c[4]}:3{c[5]}:2{c[6]}",
             f"1{c[0]}/0{c[1]}/20{c[2:4]}", f"{c[:3]},{c[3:6]}.{c[6:8]}", f"19{c[:2]}-20{c[2:4]}", c, c[:7]])


def examples(text: str) -> Iterator[tuple[list[float], int, str]]:
    """Labelled proposals ``(features, 0 or 1, kind)`` of one sample text."""
    base = base_spans(text)
    found, of_base = set(base), Taken(base)
    for s in propose(text):
        if s in found:
            yield features(text, s), 1, s[2]
        elif not of_base.meets(s):
            yield features(text, s), 0, s[2]
    for a, b, kind in base:
        before, after = text[max(0, a - 40):a], text[b:b + 40]
        for label, forms in zip((1, 0), rewritten(text[a:b], kind)):
            for form in forms:
                changed, end = before + form + after, len(before) + len(form)
                for s in proposals(changed):
                    if label and s == (len(before), end, kind):
                        yield features(changed, s), 1, kind
                    elif not label and s[0] >= len(before) and s[1] <= end:
                        yield features(changed, s), 0, s[2]


def seeds() -> Iterator[str]:
    """Fixed texts: ``SEED_TEXTS`` base spans of every kind between plain words."""
    draw = random.Random(7)
    words = ("the", "at", "order", "of", "we", "met", "and", "call", "mail", "card", "host", "number", "on", "please", "see")

    def some(letters: str, least: int, most: int) -> str:
        return "".join(draw.choices(letters, k=draw.randint(least, most)))

    def span(kind: str) -> str:
        if kind == "email":
            name, host = (some("abcdefghijklmnoprstuvw", 2, 9) for _ in range(2))
            return f"{name}{draw.choice(('', '.x', '_1', '7'))}@{host}.{draw.choice(('com', 'org', 'net', 'example.com', 'co.uk'))}"
        if kind == "ip":
            return ".".join(str(draw.randint(0, 255)) for _ in range(4))
        if kind == "card":
            own = draw.choice("3456") + some("0123456789", 14, 14)
            own += next(c for c in "0123456789" if luhn(own + c))
            return draw.choice(("", " ", "-")).join(own[i:i + 4] for i in range(0, 16, 4))
        d = draw.choice("23456789") + some("0123456789", 9, 9)
        return draw.choice((f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}", f"+1-{d[:3]}-{d[3:6]}-{d[6:]}", f"+49 {d[:3]} {d[3:]}", f"+44{d}"))

    for _ in range(SEED_TEXTS):
        for kind in KINDS:
            left, right = (" ".join(draw.choices(words, k=6)) for _ in range(2))
            yield f"{left} {span(kind)}{draw.choice((' ', ', ', '. '))}{right}"


def by_slices(texts: pa.Array, kind: pa.DataType, of_text: Callable) -> pa.Array:
    """``of_text`` of every text; of a batch a bounded part is held as Python objects at a time."""
    return joined([pa.array(list(map(of_text, texts.slice(a, b - a).to_pylist())), kind) for a, b in slices(texts)], kind)


def held_kinds(text: Column) -> Column:
    """The places in ``KINDS`` of a text's base spans, ``len(KINDS)`` alone without any; empty if it has no proposals."""

    @F.arrow_udf("array<int>")
    def pii_kinds(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.int32())
        return by_slices(strings(texts), kind, lambda t: (
            sorted({KINDS.index(s[2]) for s in base_spans(t)}) or [len(KINDS)]) if _may_hold(t) else [])

    return pii_kinds(text)


def sample(df: DataFrame, text_col: str, sample_texts: int) -> DataFrame:
    """``text, h``: the different texts with the least hashes, as many of every kind and of those without base spans."""
    from ..session import scratch_path
    able = df.select(text_or_empty(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    path = scratch_path(df.sparkSession, "pii-kinds")
    able.select("h", F.explode(held_kinds(F.col("text"))).alias("k")).distinct().write.parquet(path)
    kinds, wanted = df.sparkSession.read.parquet(path), max(1, sample_texts // (len(KINDS) + 1))
    near = F.lit(False)  # near the bound of its kind, cut exactly below
    for r in kinds.groupBy("k").count().collect():
        near |= (F.col("k") == r["k"]) & hash_share(F.col("h"), wanted, r["count"])
    rank = F.row_number().over(Window.partitionBy("k").orderBy("h"))
    chosen = kinds.filter(near).withColumn("rank", rank).filter(F.col("rank") <= wanted).select("h").distinct()
    return able.join(F.broadcast(chosen), "h", "left_semi").select("text", "h").distinct()  # sample_texts hashes at most


def labelled(texts: DataFrame, most: int = SAMPLE_PROPOSALS) -> DataFrame:
    """``x, y, kind, held`` of the proposals of ``text, h``: of each kind and label the ``most`` with the least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((x, y, k, h, n) for text, h in zip(strings(batch.column(0)).to_pylist(), batch.column(1).to_pylist())
                    for n, (x, y, k) in enumerate(examples(text)))
            while part := list(islice(rows, TASK_PROPOSALS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*part), (pa.list_(pa.float64()), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                    names=["x", "y", "kind", "h", "n"])

    found = texts.select("text", "h").mapInArrow(run, "x array<double>, y int, kind string, h long, n long")
    rank = F.row_number().over(Window.partitionBy("kind", "y").orderBy(F.xxhash64("h", "n"), "h", "n"))
    held = F.pmod(F.col("h"), F.lit(3)) == 0
    return found.withColumn("rank", rank).filter(F.col("rank") <= most).select("x", "y", "kind", held.alias("held"))


def train(df: DataFrame, text_col: str = "text", sample_texts: int = SAMPLE_TEXTS) -> Model:
    """A model from the bounded sample and the seeds; the driver holds the features of bounded proposals only."""
    ship(df.sparkSession)

    found = labelled(sample(df, text_col, sample_texts)).toArrow()
    fixed = [(x, y, k, n // len(KINDS) % 3 == 0) for n, text in enumerate(seeds()) for x, y, k in examples(text)]
    x, y, kind, back = (np.array(found[name].to_pylist() + list(own))
                        for name, own in zip(("x", "y", "kind", "held"), zip(*fixed)))
    y = y.astype(float)
    order = np.lexsort((*x.T, y, kind))  # the same model however Spark ordered the rows
    x, y, kind, back = x[order], y[order], kind[order], back[order]
    model = Model(Boosted().fit(x[~back], y[~back]))
    margin, yb = model.trees.margin(x[back]), y[back]
    for _ in range(50):  # logistic calibration by Newton steps, slightly regularised
        p = 1 / (1 + np.exp(-(model.scale * margin + model.shift)))
        w, g = p * (1 - p) + 1e-9, p - yb
        h = np.array([[(w * margin ** 2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(g * margin).sum() + 1e-3 * (model.scale - 1), g.sum() + 1e-3 * model.shift])
        model.scale, model.shift = model.scale - float(step[0]), model.shift - float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    p = model.probability(x[back])
    for k in KINDS:
        mine = kind[back] == k
        ps, ys = p[mine], yb[mine]
        good = [t for t in THRESHOLDS if (ps >= t).any() and ys[ps >= t].mean() >= MIN_PRECISION]
        model.threshold[k] = min(good, default=max(THRESHOLDS))
    return model


# ------------------------------------------------------------------ columns
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                             ("base", pa.bool_()), ("score", pa.float64())]))


def all_spans(text: str, model: Model) -> list[dict]:
    """Every span of a text in order, base ones with score 1."""
    base = base_spans(text)
    rows = [(s, True, 1.0) for s in base] + [(s, False, p) for s, p in model.added(text, base)]
    rows.sort(key=lambda r: (r[0][0], KINDS.index(r[0][2]), r[0][1]))
    return [{"start": s[0], "end": s[1], "kind": s[2], "base": b, "score": p} for s, b, p in rows]


def spans(text: Column, model: Model) -> Column:
    """``array<struct<start, end, kind, base, score>>`` of a text column."""

    @F.arrow_udf("array<struct<start:long,end:long,kind:string,base:boolean,score:double>>")
    def pii_spans(texts: pa.Array) -> pa.Array:
        return by_slices(strings(texts), _SPANS, lambda t: all_spans(t, model) if _may_hold(t) else [])

    return pii_spans(text)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``id, spans`` for every row."""
    ship(df.sparkSession)
    model = train(df, text_col) if model is None else model
    return df.select(F.col(quoted(id_col)).alias("id"), spans(text_or_empty(text_col), model).alias("spans"))


def redact(df: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``df`` with every span replaced by its kind in brackets; overlapping
    spans are replaced together, under the kind that starts first. A text
    without spans, null included, stays as it is."""
    ship(df.sparkSession)
    model = train(df, text_col) if model is None else model

    @F.arrow_udf("string")
    def pii_redacted(texts: pa.Array) -> pa.Array:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        return by_slices(texts.cast(pa.string()), pa.string(), lambda t: (
            None if t is None else redacted(t, all_spans(t, model)) if _may_hold(t) else t))

    new = free_name(df, "redacted")
    out = df.withColumn(new, pii_redacted(F.col(quoted(text_col)).cast("string")))
    return out.select(*[(F.col(new) if c == text_col else F.col(quoted(c))).alias(c) for c in df.columns])


def redacted(text: str, found: list[dict]) -> str:
    out, done = [], 0
    for s in found:
        if s["start"] >= done:
            out += [text[done:s["start"]], f"[{s['kind'].upper()}]"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


def written(spans_col: Column, only_base: bool = False) -> Column:
    """``kind:start:end`` of the spans in order, comma-joined."""
    own = F.filter(spans_col, lambda s: s["base"]) if only_base else spans_col
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_count(spans_col: Column, kind: str) -> Column:
    """Base spans of one kind."""
    return F.size(F.filter(spans_col, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
