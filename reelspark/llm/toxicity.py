"""Toxicity by weak supervision.

Many voters look at a text: each word of a lexicon (a short list of insults, and words and beginnings of words, also
where they are dense, that labelled rows suggest) votes "toxic" where it occurs, patterns vote on shouting and on several
hits. A generative label model estimates from the votes alone how accurate the voters are in both classes and how they
correlate within them, so that voters that repeat each other (a word and its beginning) don't count twice. It is fitted by expectation maximisation over all documents that teach, labelled or not: Spark counts
the patterns of votes once, and each round sums over the patterns; only sums arrive at the driver. Its posteriors are the
labels on which a linear classifier over hashed words and beginnings is trained. Labels choose the lexicon and scale the
classifier's odds at the end; they are no part of what the label model and the classifier learn from.

Bounds: the lexicon and the scale come from at most ``MAX_TRAINING`` labelled rows, the classifier from about as many rows
by posterior, half of them with votes, weighted by how many of each there are. Spark counts their features; of those rows
only the classifier's features reach the driver. The lexicon keeps the ``MAX_VOTERS`` voters of most labelled hits, the classifier the ``MAX_FEATURES`` features that tell
most. Scoring goes over all whole texts in Arrow tasks.

Defined cases: null, empty and wordless texts have no feature and get the classifier's base rate; without labelled
rows of both kinds the fixed list alone votes; repeated rows get equal scores; other columns are carried along, and
``score`` is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.arrow_text import LOWER, WORD, SpanHasher, passes, ranges, text_bytes, word_spans
from reelspark.llm.labelled import fold, sample
from reelspark.llm.store import stored, task_session

#: Labelled rows that the models are fitted on.
MAX_TRAINING = 8000
#: Words that voters know without labels.
INSULTS = ("idiot", "stupid", "moron", "loser", "pathetic", "worthless", "scum", "trash", "disgusting", "clown", "dumb", "filth", "vermin", "imbecile")
BUCKETS = 1 << 30
#: Bytes of the beginnings of words that are features of their own.
BEGINNINGS = (4, 5, 6, 7)
#: A word or beginning that occurs twice and makes up this share of the words is a feature of its own as well.
DENSE, DENSE_MARK = 0.004, 0x15A4F35
MAX_VOTERS, MAX_FEATURES = 160, 2048
#: Rounds of expectation maximisation.
ROUNDS = 12
#: The last buckets are the patterns': shouting.
SHOUTING = BUCKETS


def text_features(column: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct features of each row, by row; only those of ``known`` if given (sorted)."""
    raw, at = text_bytes(column)
    data = LOWER[raw]
    starts, ends = word_spans(WORD[data], at)
    hasher = SpanHasher(data)
    row = np.searchsorted(at, starts, "right") - 1
    words = np.bincount(row, minlength=len(at) - 1)
    rows, buckets = [], []
    for length in (0, *BEGINNINGS):
        long = np.flatnonzero(ends - starts > length)
        # The length is hashed with it, so a beginning is no word.
        own = hasher.of(starts[long], starts[long] + length if length else ends[long]) ^ np.uint64(length << 40)
        pair, count = np.unique(row[long] * BUCKETS + (own % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
        of, bucket = pair // BUCKETS, pair % BUCKETS
        dense = (count >= 2) & (count >= DENSE * words[of])
        rows += [of, of[dense]]
        buckets += [bucket, (bucket[dense] ^ DENSE_MARK) % BUCKETS]
    n = len(at) - 1
    size = np.maximum(np.diff(at), 1)
    of = np.repeat(np.arange(n), np.diff(at))
    upper = np.bincount(of, (raw >= 65) & (raw <= 90), minlength=n) / size
    marks = np.bincount(of, raw == 33, minlength=n) / size
    shouts = np.flatnonzero((upper > 0.3) & (marks > 0.02))
    row, bucket = np.concatenate([*rows, shouts]), np.concatenate([*buckets, np.full(len(shouts), SHOUTING)])
    if known is not None:
        there = known[np.minimum(np.searchsorted(known, bucket), len(known) - 1)] == bucket if len(known) else np.zeros(len(bucket), bool)
        row, bucket = row[there], bucket[there]
    key = np.unique(row * (BUCKETS * 2) + bucket)
    return key // (BUCKETS * 2), key % (BUCKETS * 2)


def _whole_words() -> np.ndarray:
    found = []
    for word in INSULTS:
        data = np.frombuffer(word.encode(), np.uint8)
        found.append(int(SpanHasher(data).of(np.array([0]), np.array([len(data)]))[0] % np.uint64(BUCKETS)))
    return np.array(found)


def choose_voters(labelled: DataFrame) -> np.ndarray:
    """The lexicon: the fixed words, and the features that are telling in labelled rows, counted by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            row, bucket = text_features(batch.column("text"))
            label = np.array(batch.column("label"), np.int64)
            features, place = np.unique(bucket, return_inverse=True)
            toxic, times = np.bincount(place, label[row], minlength=len(features)), np.bincount(place, minlength=len(features))
            yield pa.RecordBatch.from_arrays([pa.array(features.astype(np.int32)), pa.array(toxic.astype(np.int64)), pa.array(times)], names=["bucket", "toxic", "times"])

    found = labelled.mapInArrow(count, "bucket int, toxic long, times long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("times").alias("times"))
    telling = found.where((F.col("toxic") >= 3) & (F.col("times") - F.col("toxic") <= 0.1 * F.col("toxic")) & (F.col("bucket") != SHOUTING))
    best = telling.orderBy(F.desc("toxic"), "bucket").limit(MAX_VOTERS - len(INSULTS)).select("bucket").collect()
    return np.unique(np.concatenate([np.array([r[0] for r in best], np.int64), _whole_words()]))


def voted(row: np.ndarray, bucket: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, voter) of all votes, by row; after the lexicon come two patterns: several hits, and shouting."""
    there = np.isin(bucket, lexicon)
    of, voter = row[there], np.searchsorted(lexicon, bucket[there])
    several = np.flatnonzero(np.bincount(of, minlength=1) >= 3)
    shouts = row[bucket == SHOUTING]
    of = np.concatenate([of, several, shouts])
    voter = np.concatenate([voter, np.full(len(several), len(lexicon)), np.full(len(shouts), len(lexicon) + 1)])
    order = np.lexsort((voter, of))
    return of[order], voter[order]


def ballots(at: np.ndarray, voter: np.ndarray, voters: int) -> np.ndarray:
    """A row of 0 and 1 for each pattern of votes."""
    out = np.zeros((len(at) - 1, voters))
    out[np.repeat(np.arange(len(at) - 1), np.diff(at)), voter] = 1
    return out


@dataclass
class LabelModel:
    """The share of toxic texts, what each vote adds to the odds of "toxic", and what no vote at all leaves of them."""

    share: float
    weight: np.ndarray
    silence: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.share / (1 - self.share)) + self.silence + votes @ self.weight
        return 1 / (1 + np.exp(-np.clip(odds, -8, 8)))

    @classmethod
    def of(cls, number: float, products: np.ndarray, mass: float, toxic: np.ndarray, all_votes: np.ndarray) -> LabelModel:
        """From sums over the texts: their number, the votes' products, the posterior, posterior * votes, and votes.

        A voter's accuracies are how often it votes in both classes; its evidence is their log ratio. Voters that
        correlate within the classes say the same twice: evidence is divided by the sum of a voter's squared
        correlations with all voters, which for n copies of one voter is n.
        """
        rest = max(number - mass, 1e-9)
        mean_t, mean_c = toxic / max(mass, 1e-9), (all_votes - toxic) / rest
        within = (products - np.outer(mean_t, mean_t) * mass - np.outer(mean_c, mean_c) * rest) / max(number, 1)
        spread = np.sqrt(np.maximum(np.diag(within), 1e-9))
        alike = within / np.outer(spread, spread)
        alike[spread < 1e-4] = 0
        np.fill_diagonal(alike, 1)
        copies = (alike**2).sum(axis=1)
        hit_t, hit_c = (toxic + 0.5) / (mass + 1), (all_votes - toxic + 0.5) / (rest + 1)
        hit_t, hit_c = np.clip(hit_t, 1e-3, 1 - 1e-3), np.clip(hit_c, 1e-5, 1 - 1e-3)
        vote, none = np.log(hit_t / hit_c) / copies, np.log((1 - hit_t) / (1 - hit_c)) / copies
        return cls(float(np.clip(mass / max(number, 1), 1e-3, 1 - 1e-3)), vote - none, float(none.sum()))


def first_posterior(votes: np.ndarray) -> np.ndarray:
    """Where the estimates start: three votes speak for toxic, fewer may be chance."""
    return np.select([votes.sum(axis=1) >= 3, votes.sum(axis=1) > 0], [0.95, 0.3], 0.01)


def label_model(votes: np.ndarray, times: np.ndarray | None = None, rounds: int = ROUNDS) -> np.ndarray:
    """The posterior of "toxic" for each row of votes (that stands for ``times`` texts), from the votes alone."""
    times = np.ones(len(votes)) if times is None else times
    posterior = first_posterior(votes)
    products, all_votes = (votes.T * times) @ votes, times @ votes
    for _ in range(rounds):
        model = LabelModel.of(times.sum(), products, float(times @ posterior), (times * posterior) @ votes, all_votes)
        posterior = model.posterior(votes)
    return posterior


def _features_of(batch: pa.RecordBatch, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    row, bucket = text_features(batch.column("text"))
    of, voter = voted(row, bucket, lexicon)
    return row, bucket, np.searchsorted(of, np.arange(batch.num_rows + 1)), voter


def fit_label_model(corpus: DataFrame, lexicon: np.ndarray, rounds: int = ROUNDS) -> tuple[LabelModel, int, int]:
    """The label model of all texts of ``corpus``, and how many have votes and how many have none."""
    voters = len(lexicon) + 2
    sent = task_session(corpus.sparkSession).sparkContext.broadcast(lexicon)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            _, _, at, voter = _features_of(batch, sent.value)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at.astype(np.int32), pa.array(voter.astype(np.int32)))], names=["votes"])

    patterns = stored(corpus.select("text").mapInArrow(vote, "votes array<int>").groupBy("votes").agg(F.count("*").alias("times")), "patterns")

    slots = max(8, math.isqrt(patterns.rdd.getNumPartitions()))

    def summed(step: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """A sum over all patterns: one of each task, added up in a few slots, and those here."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for first in range(0, batch.num_rows, 4096):
                    some = batch.slice(first, 4096)
                    lists = some.column("votes")
                    at = np.array(lists.offsets, np.int64)
                    one = step(ballots(at - at[0], np.array(lists.flatten(), np.int64), voters), np.array(some.column("times"), float))
                    total = one if total is None else total + one
            if total is not None:
                slot = TaskContext.get().partitionId() % slots
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "sums"])

        def add(table: pa.Table) -> pa.Table:
            return pa.table({"sums": pa.array([sum(np.frombuffer(x.as_py()) for x in table.column("sums")).tobytes()], pa.binary())})

        each = patterns.mapInArrow(run, "slot int, sums binary").groupBy("slot").applyInArrow(add, "sums binary").collect()
        return sum((np.frombuffer(r[0]) for r in each), np.zeros(0) if not each else 0.0)

    fixed = summed(lambda v, n: np.concatenate([[n.sum(), n[v.sum(axis=1) > 0].sum()], n @ v, ((v.T * n) @ v).ravel()]))
    if not len(fixed):
        fixed = np.zeros(2 + voters + voters**2)
    number, with_votes, all_votes, products = fixed[0], int(fixed[1]), fixed[2 : 2 + voters], fixed[2 + voters :].reshape(voters, voters)
    model = None
    for _ in range(rounds if number else 1):
        held = model
        sums = summed(lambda v, n: np.concatenate([[n @ (p := first_posterior(v) if held is None else held.posterior(v))], (n * p) @ v]))  # noqa: B023
        sums = sums if len(sums) else np.zeros(1 + voters)
        model = LabelModel.of(number, products, float(sums[0]), sums[1:], all_votes)
    return model, with_votes, int(number) - with_votes


@dataclass
class Classifier:
    features: np.ndarray
    weight: np.ndarray
    bias: float

    def odds(self, n: int, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        if not len(self.features):
            return np.full(n, self.bias)
        place = np.minimum(np.searchsorted(self.features, bucket), len(self.features) - 1)
        there = self.features[place] == bucket
        return self.bias + np.bincount(row[there], self.weight[place[there]], minlength=n)


def _descend(x_row: np.ndarray, x_place: np.ndarray, size: int, target: np.ndarray, share: np.ndarray, start: float, steps: int = 400, decay: float = 2e-6) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over presence features, each row of its share, by scaled full gradients."""
    weight, bias, n = np.zeros(size), start, len(target)
    past, past_b = np.full(size, 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(x_row, weight[x_place], minlength=n), -30, 30)))
        error = (p - target) * share
        slope = np.bincount(x_place, error[x_row], minlength=size) + decay * weight
        past += slope**2
        weight -= 1.0 * slope / np.sqrt(past)
        past_b += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(past_b)
    return weight, bias


def telling_features(rows: DataFrame, share: float) -> np.ndarray:
    """The features that tell most of the posterior (rows: posterior, weight, bucket), counted by Spark."""
    each = rows.select("posterior", "weight", F.explode("bucket").alias("bucket")).groupBy("bucket").agg(
        F.sum("weight").alias("with_it"), F.sum(F.col("weight") * F.col("posterior")).alias("toxic"), F.count("*").alias("times"))
    tells = (F.col("toxic") - share * F.col("with_it")) ** 2 / (F.col("with_it") * share * (1 - share) + 1)
    best = each.where((F.col("times") >= 2) & (F.col("bucket") != SHOUTING)).withColumn("tells", tells).where("tells > 2")
    return np.sort(np.array([r[0] for r in best.orderBy(F.desc("tells"), "bucket").limit(MAX_FEATURES).select("bucket").collect()], np.int64))


def fit(features: np.ndarray, n: int, row: np.ndarray, bucket: np.ndarray, posterior: np.ndarray, weight: np.ndarray, share: float) -> Classifier:
    """The classifier over ``features`` from (row, bucket) of n rows, their posteriors, and how many texts each stands for."""
    weights, bias = _descend(row, np.searchsorted(features, bucket), len(features), posterior, weight / max(weight.sum(), 1e-9), float(np.log(share / (1 - share))))
    return Classifier(features, weights, bias)


def _scaled(odds: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """The scale and shift of the odds that fit the labels best, both classes softened by one row."""
    target = np.where(label == 1, (label.sum() + 1) / (label.sum() + 2), 1 / (len(label) - label.sum() + 2))
    scale, shift = 1.0, 0.0
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(scale * odds + shift, -30, 30)))
        error, bend = p - target, np.maximum(p * (1 - p), 1e-9)
        slope = np.array([(error * odds).sum() + 1e-2 * (scale - 1), error.sum()])
        curve = np.array([[(bend * odds * odds).sum() + 1e-2, (bend * odds).sum()], [(bend * odds).sum(), bend.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(curve, slope), -1, 1)
        scale, shift = max(0.1, scale - step[0]), shift - step[1]
    return float(scale), float(shift)


def train(labelled: DataFrame, corpus: DataFrame | None = None) -> Classifier:
    """Fits on ``corpus`` (text), all of whose votes teach the label model; ``labelled`` (text, label), a bounded frame,
    chooses the voters and scales the odds. Without a corpus the labelled texts are it."""
    spark = task_session(labelled.sparkSession)
    labelled = stored(labelled, "labelled")
    lexicon = choose_voters(labelled)
    corpus = labelled.select("text") if corpus is None else corpus.select("text")
    model, many, few = fit_label_model(corpus, lexicon)
    if many + few == 0:
        return Classifier(lexicon, np.full(len(lexicon), 4.0), -3.0)
    # Half of the rows to learn from have votes, by the hash of their text.
    half = MAX_TRAINING // 2
    keep = np.array([min(1.0, half / max(few, 1)), min(1.0, half / max(many, 1))])
    sent = spark.sparkContext.broadcast((lexicon, model, keep))

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, model, keep = sent.value
        for batch in passes(batches, "text"):
            row, bucket, at, voter = _features_of(batch, lexicon)
            votes = np.diff(at) > 0
            chosen = np.flatnonzero(np.array(batch.column("draw"), float) < keep[votes.astype(int)])
            own = ballots(at, voter, len(lexicon) + 2)[chosen]
            place = np.searchsorted(row, np.arange(batch.num_rows + 1))
            size = np.diff(place)[chosen]
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), pa.array(bucket[ranges(place[:-1][chosen], size)].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(model.posterior(own)), pa.array(votes[chosen]), lists], names=["posterior", "votes", "bucket"])

    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)
    drawn = stored(corpus.withColumn("draw", draw).mapInArrow(teach, "posterior double, votes boolean, bucket array<int>"), "drawn")
    # At most so many of each kind; a row stands for as many texts as there are for it.
    some = stored(drawn.where("votes").limit(2 * half).unionByName(drawn.where("NOT votes").limit(2 * half)), "teaching")
    taken = dict(map(tuple, some.groupBy("votes").count().collect()))
    rows = some.withColumn("weight", F.when(F.col("votes"), many / max(taken.get(True, 0), 1)).otherwise(few / max(taken.get(False, 0), 1)))
    mass = rows.agg(F.sum(F.col("weight") * F.col("posterior")), F.sum("weight")).first()
    share = float(np.clip((mass[0] or 0) / max(mass[1] or 0, 1e-9), 1e-3, 1 - 1e-3))
    features = telling_features(rows, share)
    known = spark.sparkContext.broadcast(features)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("bucket")
            bucket = np.array(lists.flatten(), np.int64)
            own = known.value
            there = own[np.minimum(np.searchsorted(own, bucket), len(own) - 1)] == bucket if len(own) else np.zeros(len(bucket), bool)
            at = np.array(lists.offsets, np.int64) - lists.offsets[0].as_py()
            kept = np.concatenate([[0], np.cumsum(there)])[at]
            yield pa.RecordBatch.from_arrays([batch.column("posterior"), batch.column("weight"), pa.ListArray.from_arrays(kept.astype(np.int32), pa.array(bucket[there].astype(np.int32)))], names=["posterior", "weight", "bucket"])

    found = rows.select("posterior", "weight", "bucket").mapInArrow(cut, "posterior double, weight double, bucket array<int>").toArrow().combine_chunks()
    lists = found.column("bucket").combine_chunks()
    row = np.repeat(np.arange(found.num_rows), np.array(pc.list_value_length(lists), np.int64))
    classifier = fit(features, found.num_rows, row, np.array(lists.flatten(), np.int64), np.array(found.column("posterior"), float), np.array(found.column("weight"), float), share)
    return calibrated(classifier, labelled)


def calibrated(classifier: Classifier, labelled: DataFrame) -> Classifier:
    """The classifier with its odds scaled to labelled rows, if there are both kinds."""
    sent = labelled.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, "text"):
            odds = sent.value.odds(batch.num_rows, *text_features(batch.column("text"), sent.value.features))
            yield pa.RecordBatch.from_arrays([pa.array(odds), batch.column("label")], names=["odds", "label"])

    found = labelled.mapInArrow(run, "odds double, label int").toArrow()
    odds, label = np.array(found.column("odds"), float), np.array(found.column("label"), float)
    if not 0 < label.sum() < len(label):
        return classifier
    scale, shift = _scaled(odds, label)
    return Classifier(classifier.features, classifier.weight * scale, classifier.bias * scale + shift)


def score(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, higher: more likely toxic) to every row."""
    spark = task_session(docs.sparkSession)
    docs = docs.drop(*(c for c in docs.columns if c.lower() == "score"))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    # Features of next to no weight are left out.
    big = np.abs(classifier.weight) > 1e-3
    sent = spark.sparkContext.broadcast(Classifier(classifier.features[big], classifier.weight[big], classifier.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in passes(batches, text):
            odds = own.odds(batch.num_rows, *text_features(batch.column(text), own.features))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))))], names=schema.names)

    return docs.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the toxicity of every whole text of ``documents``, learned from texts and labels outside fold 1 of 3."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    classifier = train(sample(docs, labels, "toxic", fold(3) != 1, MAX_TRAINING), docs.where(fold(3) != 1))
    rows = score(docs.select("doc_id", (fold(3) == 1).alias("held_out"), "text"), classifier).drop("text")
    return rows.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
