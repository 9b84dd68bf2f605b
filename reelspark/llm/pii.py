"""Personal data: candidate spans, ranked by boosted trees.

Fixed rules find e-mail and IP addresses, card and phone numbers (the base spans, which always stay). High-recall
generators propose more spans of each kind, which may overlap: addresses with "[at]", numbers with other separators
or without a country's prefix. Gradient-boosted trees score each proposal from its format and its surroundings. For
each kind a threshold, calibrated on rows that the trees have not seen, selects what is added.

There are no labels, so the trees learn from the base rules: proposals that a rule finds, there, by themselves, or with their mark put
back ("[at]" for "@", another separator of a card's digits, eight groups of an IPv6 address), are positive, also base spans in forms that
lose their mark. What overlaps none is negative, but for numbers grouped as telephone numbers are (no dates, no
parts of words), of which no rule can tell: they teach nothing. They are
fitted on the driver on at most ``MAX_TRAINING`` proposals of the whole table, shared out evenly among kinds and labels
and taken by hashes; weights give each label its share in the whole table back, and each kind its share in the sample.

A quarter of all distinct proposals, by a hash, is never fitted on. All of them are scored in Spark, and a histogram by
kind and score, with copies counted, gives the thresholds: the least score from which on proposals are right in ``PRECISION``
of the cases, and in half at least by the score itself. To this share count ``PRIOR`` proposals that are right as often as the score at
the cut says. So with nothing to calibrate on the threshold is ``PRECISION`` itself, and the more there is, the less the prior weighs.

Defined cases: a null or empty text has no spans; offsets count code points; a long text is read whole in time near
to its length; repeated rows get equal results; without proposals of both labels to learn from only base spans are returned. Other
columns are carried along, and result columns of the same name replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.arrow_text import passes
from reelspark.llm.store import stored, task_session

KINDS = ("email", "ip", "card", "phone")
#: Proposals that the trees are fitted on.
MAX_TRAINING = 20_000
PRECISION = 0.98
#: Proposals that the trees' own probability counts for in a threshold.
PRIOR = 20
#: One in so many distinct proposals is for calibration.
HELD_OUT = 4
#: Intervals of log-odds in the histogram of scores, from -``TOP_ODDS`` to ``TOP_ODDS``.
INTERVALS, TOP_ODDS = 4096, 16

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Texts without any of these hold no span and no proposal.
_TRIGGER = re.compile(r"[0-9@]|[\[({]\s?at\s?[\])}]", re.IGNORECASE)

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed rules, leftmost and not overlapping within a kind, by start and kind."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, 0, free := found.end()))
        at = text.find("@", max(at + 1, free))
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


class Cover:
    """The stretches of text that spans cover, for quick questions whether another span meets one."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, span: Span) -> bool:
        at = bisect_right(self.ends, span[0])
        return at < len(self.starts) and self.starts[at] < span[2]

    def add(self, span: Span) -> None:
        """A span that meets none so far."""
        at = bisect_right(self.ends, span[0])
        self.starts.insert(at, span[0])
        self.ends.insert(at, span[2])


_PROPOSE = (
    re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|[\[({] ?at ?[\])}]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{1,63}+)+", re.IGNORECASE),
    re.compile(r"(?<![0-9A-Za-z.:])(?:[0-9]{1,5}+\.){3}[0-9]{1,5}+|(?<![0-9A-Za-z.:])(?:[0-9A-Fa-f]{1,4}+:){4,7}[0-9A-Fa-f]{1,4}+"),
    re.compile(r"(?<![0-9])[0-9](?:[ ._/-]?[0-9]){11,18}(?![0-9])"),
    re.compile(r"(?<![0-9])[+(]?[0-9](?:[ ().-]{0,2}[0-9]){7,14}(?![0-9])"),
)


def proposals(text: str) -> list[Span]:
    """Spans of the generators, which may overlap."""
    return sorted((m.start(), kind, m.end()) for kind, pattern in enumerate(_PROPOSE) for m in pattern.finditer(text))


_WORDS = re.compile(r"phone|tel|call|fax|mobil|card|visa|credit|konto|pay|mail|contact|write|kontakt|ip|host|server|address|adresse|addr|log", re.IGNORECASE)
FEATURES = 24


def features(text: str, span: Span, inside: str | None = None) -> list[float]:
    """Format and surroundings of a span; ``inside`` stands for another form of it."""
    start, kind, end = span
    own = text[start:end] if inside is None else inside
    before, after = text[max(0, start - 24) : start], text[end : end + 24]
    digits = _digits(own)
    runs = re.findall(r"[0-9]+", own)
    letters = sum(c.isalpha() for c in own)
    length = max(len(own), 1)
    return [
        *(float(kind == k) for k in range(4)),
        len(own),
        len(digits),
        letters,
        len(digits) / length,
        len(runs),
        max(map(len, runs), default=0),
        min(map(len, runs), default=0),
        sum(c in " ()-" for c in own),
        own.count("."),
        sum(c in "/_:" for c in own),
        float(len(runs) == 4 and all(map(_small, runs))),
        float(len(digits) > 11 and luhn(digits)),
        float("@" in own or "at" in own.lower()),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in "+-.,/:=#$%" and before != ""),
        float(len(_WORDS.findall(before))),
        sum("0" <= c <= "9" for c in before) / 24,
        sum("0" <= c <= "9" for c in after) / 24,
        len(set(digits)) / max(len(digits), 1),
    ]


def _unmarked(own: str, kind: int) -> str | None:
    """A span of the rules as the generators might meet it without its mark."""
    if kind == 0:
        return own.replace("@", " [at] ")
    if kind == 2:
        return re.sub(r"[ -]", ".", own) if re.search(r"[ -]", own) else None
    return own.lstrip("+0") if kind == 3 else None


_GROUPED = re.compile(r"\(?[0-9]{1,4}\)?(?:[ .-]{1,2}\(?[0-9]{2,4}\)?){2,}|\([0-9]{2,4}\) ?[0-9][0-9 .-]+")


_DATE = re.compile(r"(?:19|20)[0-9]{2}[ .-][0-9]{1,2}[ .-][0-9]{1,2}(?![0-9])|[0-9]{1,2}[ .-][0-9]{1,2}[ .-](?:19|20)[0-9]{2}(?![0-9])")


def _may_be_a_phone(text: str, start: int, own: str) -> bool:
    return bool(_GROUPED.fullmatch(own)) and not _DATE.match(own) and not text[max(0, start - 1) : start].isalnum()


def _remarked(own: str, kind: int) -> bool:
    """Whether a rule finds the span once its mark is put back."""
    if kind == 1:
        groups = own.split(":")
        return len(groups) == 8 and all(0 < len(g) <= 4 for g in groups)
    if kind == 0:
        own = re.sub(r" ?(?:@|[\[({] ?at ?[\])}]) ?", "@", own, flags=re.IGNORECASE)
        own = re.sub(r" ?(?:\.|[\[({] ?dot ?[\])}]) ?", ".", own, flags=re.IGNORECASE)
    elif kind == 2:
        own = re.sub(r"[ ._/-]", " ", own)
    else:
        return False
    return (0, kind, len(own)) in base_spans(own)


def training_rows(text: str) -> list[tuple[int, int, list[float]]]:
    """kind, label (1 for what the rules find) and features of every proposal and of unmarked forms of base spans."""
    base = set(base_spans(text))
    cover, out = Cover(base), []
    for span in proposals(text):
        start, kind, end = span
        # Two numbers in a row can be more than a rule takes, while each by itself is what it looks for.
        own = text[start:end]
        if span in base or not cover.meets(span) and ((0, kind, end - start) in base_spans(own) or _remarked(own, kind)):
            out.append((kind, 1, features(text, span)))
            if other := _unmarked(text[start:end], kind):
                out.append((kind, 1, features(text, span, other)))
        elif not cover.meets(span) and not (kind == 3 and _may_be_a_phone(text, start, own)):
            out.append((kind, 0, features(text, span)))
    return out


@dataclass
class Trees:
    """Boosted regression trees of one depth for the log-odds: per tree the features, cuts and leaves of a full tree."""

    depth: int = 3
    rounds: int = 40
    rate: float = 0.2
    bins: int = 32
    first: float = 0.0
    each: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.first = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
        odds = np.full(len(y), self.first)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-odds))
            slope, bend = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
            inner = (1 << self.depth) - 1
            feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                for k in range((1 << level) - 1, (2 << level) - 1):
                    rows = np.flatnonzero(node == k)
                    best = 1e-6
                    for f, c in enumerate(cuts):
                        g = np.bincount(binned[rows, f], slope[rows], self.bins + 1)
                        h = np.bincount(binned[rows, f], bend[rows], self.bins + 1)
                        gl, hl = np.cumsum(g)[: len(c)], np.cumsum(h)[: len(c)]
                        gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
                        if len(c) and gain.max() > best:
                            best, feature[k], cut[k] = gain.max(), f, c[gain.argmax()]
                inside = node >= (1 << level) - 1
                node = np.where(inside, 2 * node + 1 + (x[np.arange(len(x)), feature[np.minimum(node, inner - 1)]] > cut[np.minimum(node, inner - 1)]), node)
            leaf = node - inner
            value = self.rate * np.bincount(leaf, slope, 1 << self.depth) / (np.bincount(leaf, bend, 1 << self.depth) + 1)
            odds += value[leaf]
            self.each.append((feature, cut, value))
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        odds = np.full(len(x), self.first)
        for feature, cut, value in self.each:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            odds += value[node - len(feature)]
        return odds

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities."""
        return 1 / (1 + np.exp(-self.odds(x)))


@dataclass
class Model:
    trees: Trees | None
    threshold: list[float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Proposals over their kind's threshold that overlap no base span and no added one of a higher score."""
        if self.trees is None:
            return []
        cover = Cover(base)
        open_spans = [s for s in proposals(text) if not cover.meets(s)]
        if not open_spans:
            return []
        score = self.trees.score(np.array([features(text, s) for s in open_spans]))
        chosen: list[Span] = []
        for k in np.argsort(-score, kind="stable").tolist():
            if score[k] >= self.threshold[open_spans[k][1]] and not cover.meets(open_spans[k]):
                cover.add(open_spans[k])
                chosen.append(open_spans[k])
        return chosen


def shares(counts: list[int], total: int) -> list[int]:
    """How many of ``total`` places each group gets: as many as others, or all it has; what it leaves goes to larger ones."""
    out, left = [0] * len(counts), total
    for done, k in enumerate(sorted(range(len(counts)), key=counts.__getitem__)):
        out[k] = min(counts[k], left // (len(counts) - done))
        left -= out[k]
    return out


def threshold_of(right: np.ndarray, wrong: np.ndarray) -> float:
    """The threshold of a kind from how many proposals of each interval of log-odds are right and wrong."""
    edges = 1 / (1 + np.exp(-np.linspace(-TOP_ODDS, TOP_ODDS, INTERVALS + 1)[:-1]))
    good, all_ = np.cumsum(right[::-1])[::-1], np.cumsum((right + wrong)[::-1])[::-1]
    ok = ((good + PRIOR * edges) / (all_ + PRIOR) >= PRECISION) & (edges >= 0.5)
    return float(edges[np.flatnonzero(ok)[0]]) if ok.any() else np.inf


def _sample(found: DataFrame, max_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of the proposals to fit on: ``max_rows`` at most, shared out among kinds and labels."""
    groups = found.groupBy("kind", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).orderBy("kind", "label").collect()
    quota = shares([g.rows for g in groups], max_rows)
    place = F.pmod(F.xxhash64(F.lit(1), "kind", "label", "x"), F.lit(1 << 30))
    # A little more than the share of each group, of which the driver takes the first.
    within = F.lit(False)
    for g, most in zip(groups, quota, strict=True):
        limit = min(1.0, (most + 4 * most**0.5 + 10) / g.rows)
        within = within | ((F.col("kind") == g.kind) & (F.col("label") == g.label) & (F.col("place") < int(limit * (1 << 30))))
    rows = sorted(found.withColumn("place", place).where(within).collect(), key=lambda r: (r.kind, r.label, r.place, r.x))
    x, label, weight = [], [], []
    for g, most in zip(groups, quota, strict=True):
        own = [r for r in rows if (r.kind, r.label) == (g.kind, g.label)][:most]
        x += [r.x for r in own]
        label += [g.label] * len(own)
        seen, kind_rows, kind_n = sum(r.n for r in own), *(sum(v) for v in zip(*((q, h.n) for h, q in zip(groups, quota, strict=True) if h.kind == g.kind), strict=True))
        weight += [r.n / seen * g.n / kind_n * kind_rows for r in own]
    return np.array(x).reshape(-1, FEATURES), np.array(label, np.float64), np.array(weight)


def _histogram(held: DataFrame, trees: Trees) -> np.ndarray:
    """How many proposals there are of each kind, label and interval of log-odds."""
    sent = held.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = sent.value.odds(np.array(batch.column("x").flatten(), np.float64).reshape(-1, FEATURES))
            at = np.clip((odds + TOP_ODDS) * (INTERVALS / (2 * TOP_ODDS)), 0, INTERVALS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("label"), pa.array(at), batch.column("n")], names=["kind", "label", "at", "n"])

    out = np.zeros((len(KINDS), 2, INTERVALS))
    for r in held.mapInArrow(run, "kind int, label int, at int, n long").groupBy("kind", "label", "at").agg(F.sum("n").alias("n")).collect():
        out[r.kind, r.label, r["at"]] = r.n
    return out


def train(docs: DataFrame, text: str = "text", max_rows: int = MAX_TRAINING) -> Model:
    """Trees from ``max_rows`` proposals of all rows at most, and thresholds from all proposals that are held out."""
    task_session(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            rows = [row for t in batch.column("text").to_pylist() if t and _TRIGGER.search(t) for row in training_rows(t)]
            yield pa.RecordBatch.from_pydict({"kind": pa.array([r[0] for r in rows], pa.int32()), "label": pa.array([r[1] for r in rows], pa.int32()), "x": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "kind int, label int, x array<double>")
    # Equal proposals are one with its count, so that many copies don't fill the sample.
    found = stored(found.groupBy("kind", "label", "x").agg(F.count("*").alias("n")), "proposals")
    held = F.pmod(F.xxhash64("x"), F.lit(HELD_OUT)) == HELD_OUT - 1
    x, label, weight = _sample(found.where(~held), max_rows)
    if not 0 < label.sum() < len(label):
        return Model(None, [np.inf] * len(KINDS))
    trees = Trees().fit(x, label, weight)
    return Model(trees, [threshold_of(right, wrong) for wrong, right in _histogram(found.where(held), trees)])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping ones, replaced by the kind of its first."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds n_email, n_ip, n_card, n_phone (base spans), base_spans, spans (kind:start:end, ...) and redacted_text."""
    spark = task_session(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    counts = [f"n_{kind}" for kind in KINDS]
    new = [*counts, "base_spans", "spans", "redacted_text"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in new))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in counts), *(T.StructField(c, T.StringType()) for c in new[4:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in passes(batches, text):
            number, base_all, all_all, texts = np.zeros((4, batch.num_rows), np.int64), [], [], batch.column(text).to_pylist()
            for row, t in enumerate(texts):
                base = spans = []
                if t and _TRIGGER.search(t):
                    base = base_spans(t)
                    spans = sorted(base + own.added(t, base))
                    for _, kind, _ in base:
                        number[kind, row] += 1
                    texts[row] = redacted(t, spans)
                base_all.append(_joined(base))
                all_all.append(_joined(spans))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, number), *(pa.array(v, pa.string()) for v in (base_all, all_all, texts))], names=schema.names)

    return docs.mapInArrow(run, schema)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the spans of personal data in every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, train(docs))
    return found.select("doc_id", *(f"n_{kind}" for kind in KINDS), F.sha2("base_spans", 256).alias("base_sha256"), "spans")
