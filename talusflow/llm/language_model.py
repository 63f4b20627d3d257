"""A log-bilinear language model over word classes, trained by noise-contrastive estimation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import crc_remainder, hashed_words, mixed, text_chunks, written

_END = mixed(np.array([0x2545F4914F6CDD1D], dtype=np.uint64))[0]  # stands for the end of a text


@dataclass(frozen=True)
class Settings:
    """The model's size. Frequent words are classes of their own, others share one by their first bytes."""

    frequent: int = 384
    shared: int = 256
    head: int = 3  # bytes
    listed: int = 65_536  # words whose counts travel to the tasks
    width: int = 16
    noise: int = 64
    batch: int = 8192
    rate: float = 0.1

    @property
    def classes(self) -> int:
        return self.frequent + self.shared


def _tokens(column: pa.Array, settings: Settings) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, word hashes with an end after each text, the classes words share, text bounds."""
    for first, _, data, offsets in text_chunks(column):
        words, bounds, (heads,) = hashed_words(data, offsets, (settings.head,))
        at = bounds[1:]
        groups = settings.frequent + ((heads >> np.uint64(40)) % np.uint64(settings.shared)).astype(np.int64)
        yield first, np.insert(words, at, _END), np.insert(groups, at, 0), bounds + np.arange(len(bounds))


def word_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """How often each token occurs: `word` (hash), `group`, `n`. Tasks add up batches before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(w, g) for _, w, g, _ in _tokens(batch.column(0), settings)]
            if parts:
                words, groups = (np.concatenate(x) for x in zip(*parts))
                words, first, n = np.unique(words, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(groups[first]), pa.array(n)], ["word", "group", "n"])
    return texts.mapInArrow(run, "word long, group long, n long").groupBy("word", "group").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The most frequent words with their counts, and the class of any word.

    The end of a text has class 0. The next frequent words have one class each, all other words the
    class they share. The list is bounded by the settings.
    """

    def __init__(self, words: np.ndarray, groups: np.ndarray, counts: np.ndarray, settings: Settings):
        classes = groups.copy()
        own = np.flatnonzero(words != _END)[:settings.frequent - 1]
        classes[own] = np.arange(1, len(own) + 1)
        order = np.argsort(words)
        self.words = np.r_[words[order], np.uint64(2**64 - 1)]
        self.counts, self.classes = np.r_[counts[order], 0], np.r_[classes[order], 0]

    def find(self, words: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each word, whether it is listed, and its count if so."""
        at = np.searchsorted(self.words[:-1], words)
        listed = self.words[at] == words
        return np.where(listed, self.classes[at], groups), listed, np.where(listed, self.counts[at], 0)


class LogBilinear:
    """Predicts a class from the two before it: a weighted sum of their vectors meets each class's.

    `train` raises the odds of seen classes against classes drawn from the noise distribution, so no
    sum over the classes is needed there; `log_probabilities` takes products with all classes at once
    and normalises them.
    """

    def __init__(self, shares: np.ndarray, settings: Settings, seed: int = 1):
        draw = np.random.default_rng(seed)
        k, d = len(shares), settings.width
        self.settings, self.shares = settings, shares
        self.inputs = draw.normal(0, 0.1, (2, k, d)).astype(np.float32)  # one table per distance
        self.outputs = draw.normal(0, 0.1, (k, d)).astype(np.float32)
        self.bias = np.log(shares).astype(np.float32)
        self.odds = np.log(settings.noise * shares)
        self.norms: np.ndarray | None = None  # by context, of the weights as they are
        self.past = [np.zeros_like(x) for x in (*self.inputs, self.outputs, self.bias)]

    def contexts(self, classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes one and two before each token; the end class stands before a text."""
        one = np.r_[0, classes[:-1]]
        two = np.r_[0, 0, classes][:len(classes)]
        starts = bounds[:-1]
        one[starts] = 0
        two[starts] = 0
        two[np.minimum(starts + 1, bounds[1:] - 1)] = 0
        return one, two

    def train(self, one: np.ndarray, two: np.ndarray, target: np.ndarray, draw: np.random.Generator, rate: float) -> None:
        self.norms = None
        noise = draw.choice(len(self.shares), self.settings.noise, p=self.shares)
        u = self.inputs[0][one] + self.inputs[1][two]
        out = self.outputs[target]
        # Odds against `noise` draws; the draws are shared by the batch.
        seen = (u * out).sum(1) + self.bias[target] - self.odds[target]
        drawn = u @ self.outputs[noise].T + self.bias[noise] - self.odds[noise]
        push = 1 / (1 + np.exp(np.clip(seen, -30, 30)))
        pull = np.exp(np.negative(np.clip(drawn, -30, 30, out=drawn), out=drawn), out=drawn)
        pull = np.divide(-1, np.add(pull, 1, out=pull), out=pull)  # the largest array, kept in one place
        to_u = push[:, None] * out + pull @ self.outputs[noise]
        k = len(self.shares)

        def added(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
            order = np.argsort(rows.astype(np.min_scalar_type(k)), kind="stable")  # short numbers sort by digits
            rows, values = rows[order], values[order]
            at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            total = np.zeros((k, values.shape[1]), dtype=np.float32)
            total[rows[at]] = np.add.reduceat(values, at, axis=0)
            return total

        ones = np.ones((len(u), 1), dtype=np.float32)
        wide = np.hstack([u, ones])  # the last column is the bias
        outward = added(target, push[:, None] * wide)
        np.add.at(outward, noise, (pull.T @ wide).astype(np.float32))
        for table, past, slope in (
            (self.inputs[0], self.past[0], added(one, to_u)), (self.inputs[1], self.past[1], added(two, to_u)),
            (self.outputs, self.past[2], outward[:, :-1]), (self.bias, self.past[3], outward[:, -1]),
        ):
            past += slope * slope  # steps shrink with the slopes seen so far
            table += rate * slope / (np.sqrt(past) + 1e-6)

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability of each target.

        A context is normalised over all classes the first time that it occurs, and its norm kept: a
        table of classes x classes numbers, which all further texts look up.
        """
        k = len(self.shares)
        if self.norms is None:
            self.norms = np.full(k * k, np.nan, dtype=np.float32)
        contexts = one * k + two
        asked = np.zeros(k * k, dtype=bool)
        asked[contexts] = True
        new = np.flatnonzero(asked & np.isnan(self.norms))
        for block in range(0, len(new), 4096):
            part = new[block:block + 4096]
            scores = (self.inputs[0][part // k] + self.inputs[1][part % k]) @ self.outputs.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            self.norms[part] = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))
        u = self.inputs[0][one] + self.inputs[1][two]
        own = np.einsum("ij,ij->i", u, self.outputs[target]) + self.bias[target]
        return (own - self.norms[contexts]).astype(np.float64)


def trained(texts: DataFrame, vocabulary: Vocabulary, shares: np.ndarray, settings: Settings) -> LogBilinear:
    """One pass over all texts: each task trains on its own, and the tasks' weights are averaged.

    A task's weight is its number of tokens. What comes to the driver is one fixed-size model per
    block of tasks, summed in tree form before.
    """
    spark = texts.sparkSession
    start = LogBilinear(shares, settings)
    shared = spark.sparkContext.broadcast((vocabulary, start))  # bounded by the settings

    def flat(m: LogBilinear) -> np.ndarray:
        return np.concatenate([m.inputs.ravel(), m.outputs.ravel(), m.bias.ravel()]).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, first = shared.value
        model = LogBilinear(first.shares, settings)
        draw, tokens = np.random.default_rng(17), 0
        for batch in batches:
            for _, words, groups, bounds in _tokens(batch.column(0), settings):
                classes, _, _ = vocabulary.find(words, groups)
                one, two = model.contexts(classes, bounds)
                mix = draw.permutation(len(classes))
                for a in range(0, len(mix), settings.batch):
                    at = mix[a:a + settings.batch]
                    model.train(one[at], two[at], classes[at], draw, settings.rate)
                tokens += len(classes)
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([tokens], pa.int64()), pa.array([(flat(model) * tokens).tobytes()], pa.binary())],
                ["n", "weights"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                value = np.frombuffer(row["weights"])
                n, total = n + row["n"], value if total is None else total + value
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                             ["n", "weights"])

    models = written(texts.mapInArrow(run, "n long, weights binary"), "lm-models")
    groups = max(1, int(models.count() ** 0.5))
    parts = models.repartition(groups).mapInArrow(summed, "n long, weights binary").collect()
    if parts:
        total = sum(np.frombuffer(p["weights"]) for p in parts) / sum(p["n"] for p in parts)
        k, d = len(shares), settings.width
        start.inputs = total[:2 * k * d].reshape(2, k, d).astype(np.float32)
        start.outputs = total[2 * k * d:3 * k * d].reshape(k, d).astype(np.float32)
        start.bias = total[3 * k * d:].astype(np.float32)
    return start


def score_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Texts whose id has remainder 2 are held out. Counts cover all other texts whole. `score` adds for
    each token the log-bilinear probability of its class and the token's share in the class, which is
    (count + 1) over the class's tokens plus its different words plus 1. Counts of the most frequent
    words go to the tasks; all other words are looked up by a join on their hash.

    Null and empty texts consist of the end token. Null ids are learnt from. Repeated rows are texts
    of their own; an empty table gives an empty result, and without any training text every count is
    0. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    learnt = texts.where(crc_remainder("doc_id", 7) != 2).select("text")
    counts = written(word_counts(learnt, settings), "lm-counts")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n, v = int(totals[0]), int(totals[1])
    top = counts.orderBy(F.col("n").desc(), "word").limit(settings.listed).toArrow()
    vocabulary = Vocabulary(top.column("word").to_numpy().view(np.uint64), top.column("group").to_numpy(),
                            top.column("n").to_numpy(), settings)

    # Tokens and different words of each class, over the whole table.
    k = settings.classes
    shared_words = spark.sparkContext.broadcast(vocabulary)

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, _, _ = shared_words.value.find(
                batch.column("word").to_numpy().view(np.uint64), batch.column("group").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k)), pa.array(np.bincount(classes, batch.column("n").to_numpy(), k).astype(np.int64)),
                 pa.array(np.bincount(classes, minlength=k))], ["class", "n", "v"])

    sizes, kinds = np.zeros(k), np.zeros(k)
    for row in counts.mapInArrow(by_class, "class long, n long, v long").groupBy("class").agg(
            F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        sizes[row["class"]], kinds[row["class"]] = row["n"], row["v"]
    shares = (sizes + 1) / (sizes + 1).sum()
    model = trained(learnt, vocabulary, shares, settings)
    # A class of one word has no share to give away, unless nothing was counted for it.
    alone = np.arange(k) < settings.frequent
    under = np.where(alone, np.maximum(sizes, 1), sizes + kinds + 1)
    whole = n + v + 1
    shared = spark.sparkContext.broadcast((vocabulary, model, under, alone))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model, under, alone = shared.value
        for batch in batches:
            for first, words, groups, bounds in _tokens(batch.column("text"), settings):
                classes, listed, count = vocabulary.find(words, groups)
                logs = model.log_probabilities(*model.contexts(classes, bounds), classes) / np.log(10)
                # What the join still adds is log10(count + 1), to both scores.
                logs += np.where(alone[classes], 0.0, np.where(listed, np.log10(count + 1), 0.0) - np.log10(under[classes]))
                base = np.where(listed, np.log10(count + 1), 0.0) - np.log10(whole)
                size = np.diff(bounds)
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (logs, base, (listed & (count > 0)).astype(np.int64))]
                rest = words.view(np.int64).copy()
                left = ~listed
                ends = np.cumsum(np.add.reduceat(left.astype(np.int64), bounds[:-1]))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(rest[left]))
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(first, len(size)).column("doc_id"), pa.array(size), pa.array(sums[2]),
                     pa.array(sums[1]), pa.array(sums[0]), lists],
                    ["doc_id", "n_tokens", "known", "base", "score", "rest"])

    kind = docs.schema[id_col].dataType.simpleString()
    partial = written(
        texts.mapInArrow(run, f"doc_id {kind}, n_tokens long, known long, base double, score double, rest array<long>")
        .withColumn("node", F.monotonically_increasing_id()), "lm-partial")
    more = written(
        partial.select("node", F.explode("rest").alias("word")).join(counts, "word").groupBy("node").agg(
            F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("gain")), "lm-rest")
    return partial.join(more, "node", "left").select(
        "doc_id", (crc_remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"))
