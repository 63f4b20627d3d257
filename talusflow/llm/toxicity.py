"""Toxicity by class-conditional Kneser-Ney models of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import Lookup, crc_remainder, hashed_words, mixed, text_chunks, written

_MARGIN = 1.5  # log ratio that a token must pass to count as clear
_PREFIXES = (6, 4)  # bytes of a word that its backoff levels look at
_START = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0x9FB21C651E98DF25)


def _tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """First row, text bounds, words before, words, prefixes."""
    for first, _, data, offsets in text_chunks(column):
        words, bounds, prefixes = hashed_words(data, offsets, _PREFIXES)
        before = np.r_[_START, words[:-1]] if len(words) else words
        starts = bounds[:-1][bounds[:-1] < bounds[1:]]
        before[starts] = _START
        yield first, bounds, before, words, prefixes


def _pairs(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(before * _PAIR + words)


def _counted(sample: DataFrame) -> DataFrame:
    """Word pairs of the sample by class with their counts, and the words' prefixes."""
    names = ["toxic", "before", "word", "p6", "p4"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("toxic").to_numpy()
            for first, bounds, before, words, (p6, p4) in _tokens(batch.column("text")):
                classes = np.repeat(label[first:first + len(bounds) - 1], np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes.astype(np.int32))] + [pa.array(x.view(np.int64)) for x in (before, words, p6, p4)],
                    names)

    rows = sample.select("toxic", "text").mapInArrow(
        run, "toxic int, before long, word long, p6 long, p4 long")
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Model:
    """Two Kneser-Ney models over word pairs with a common end of the backoff.

    A pair's count is discounted by 1 and what that frees goes to the word, whose count is the number
    of different words before it; then to its first six and four bytes, counted the same way within
    the class; at last to the four bytes' counts in both classes together. The share of a word among
    the words of its prefix is that of both classes together, so for a word that neither class knows
    well it cancels out, and the prefixes decide.
    """

    pair: Lookup
    context: Lookup
    word: Lookup
    p6: Lookup
    p4: Lookup
    free: np.ndarray  # rows word, p6, p4; columns ordinary, toxic
    weights: np.ndarray | None = None

    def token_ratios(self, before, words, p6, p4) -> np.ndarray:
        """Log of the toxic over the ordinary probability of each token."""
        four = self.p4(p4)
        low = four[:, :2] + self.free[2] * four[:, 2:]
        six = self.p6(p6)
        low = six[:, :2] + self.free[1] * low * six[:, 2:]
        own = self.word(words)
        low = own[:, :2] + self.free[0] * low * own[:, 2:]
        context = self.context(before)
        low = self.pair(_pairs(before, words)) + context * low
        return np.log(low[:, 1]) - np.log(low[:, 0])

    def features(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Per text: 1, and ratios in relation to the number of words.

        The plain mean; the mean of what is above a clear margin, to which chance in rare words adds
        nothing; each also times the root of the number of words, as long texts are more certain.
        """
        for first, bounds, before, words, (p6, p4) in _tokens(column):
            ratios = self.token_ratios(before, words, p6, p4)
            clear = np.maximum(ratios - _MARGIN, 0)
            n = np.diff(bounds)
            sums = [np.diff(np.r_[0.0, np.cumsum(x, dtype=np.float64)][bounds]) for x in (ratios, clear)]
            mean, strong = (x / np.maximum(n, 1) for x in sums)
            yield first, np.stack([np.ones(len(n)), mean, mean * np.sqrt(n), strong, strong * np.sqrt(n),
                                   np.log1p(sums[1])], axis=1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -500, 500)))


def _table(frame: DataFrame, key: str, values: list[str], default: tuple[float, ...]) -> Lookup:
    rows = frame.select(key, *[F.col(v).cast("double") for v in values]).toArrow()
    return Lookup(rows.column(0).to_numpy().view(np.uint64),
                  np.stack([rows.column(1 + i).to_numpy() for i in range(len(values))], axis=1)
                  if rows.num_rows else np.empty((0, len(values))), default)


def fit_models(sample: DataFrame) -> Model:
    """Models from the rows `toxic`, `text`; the size of the tables is bounded by that of the sample."""
    pairs = written(_counted(sample), "toxicity-pairs")

    def by_class(value: Column, name: str) -> list[Column]:
        return [F.coalesce(F.sum(F.when(F.col("toxic") == c, value)), F.lit(0)).alias(f"{name}{c}") for c in (0, 1)]

    one = F.lit(1)
    sums = pairs.agg(*by_class(one, "n")).first()
    totals = np.maximum(np.array([sums["n0"], sums["n1"]], dtype=float), 1.0)
    less = lambda name, c: F.greatest(F.col(f"{name}{c}") - 1, F.lit(0)) / totals[c]
    free, levels = [], {}
    for level in ("word", "p6", "p4"):
        counts = written(pairs.groupBy(level).agg(*by_class(one, "c")).withColumn(
            "both", F.col("c0") + F.col("c1")), f"toxicity-{level}")
        levels[level] = counts
        kinds = counts.agg(F.sum((F.col("c0") > 0).cast("int")), F.sum((F.col("c1") > 0).cast("int"))).first()
        free.append(np.maximum(np.array([kinds[0] or 0, kinds[1] or 0], dtype=float), 1.0) / totals)

    def level_table(level: str, parent: str | None) -> Lookup:
        counts = levels[level]
        values = [less("c", 0).alias("a0"), less("c", 1).alias("a1")]
        if parent is None:
            kinds = counts.count() + 1
            share = (F.col("both") + 1.0) / float(totals.sum() + kinds)
            return _table(counts.select(level, *values, share.alias("share")), level, ["a0", "a1", "share"],
                          (0, 0, 1 / float(totals.sum() + kinds)))
        # What stands at 1 in both classes has no count of its own after the discount.
        kept = counts.where((F.col("c0") > 1) | (F.col("c1") > 1))
        above = levels[parent].select(parent, F.col("both").alias("all"))
        links = pairs.select(level, parent).distinct()
        rows = kept.join(links, level).join(above, parent)
        return _table(rows.select(level, *values, (F.col("both") / F.col("all")).alias("share")), level,
                      ["a0", "a1", "share"], (0, 0, 1e-3))

    per_context = pairs.groupBy("before").agg(*by_class(F.col("n"), "n"), *by_class(one, "k"))
    rest = [F.when(F.col(f"n{c}") > 0, F.col(f"k{c}") / F.col(f"n{c}")).otherwise(1.0).alias(f"g{c}") for c in (0, 1)]
    contexts = written(per_context.select("before", "n0", "n1", *rest), "toxicity-contexts")
    repeated = pairs.where("n > 1").groupBy("before", "word").agg(*by_class(F.col("n"), "m")).join(contexts, "before")
    found = repeated.select("before", "word", *[
        F.when(F.col(f"n{c}") > 0, F.greatest(F.col(f"m{c}") - 1, F.lit(0)) / F.col(f"n{c}"))
        .otherwise(0.0).alias(f"a{c}") for c in (0, 1)]).toArrow()
    key = _pairs(*[found.column(c).to_numpy().view(np.uint64) for c in ("before", "word")])
    value = np.stack([found.column(c).to_numpy() for c in ("a0", "a1")], axis=1) if found.num_rows else np.empty((0, 2))
    return Model(
        Lookup(key, value, (0, 0)),
        _table(contexts.where("g0 < 1 or g1 < 1"), "before", ["g0", "g1"], (1, 1)),
        level_table("word", "p6"), level_table("p6", "p4"), level_table("p4", None), np.array(free, dtype=np.float32))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps, columns scaled to unit spread."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    x = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * len(y) * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w)), slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def train(labelled: DataFrame, rows_per_class: int = 6000, seed: int = 5, cut: float = 0.7) -> Model | None:
    """Models and calibration from rows `ident`, `toxic` (0 or 1) and `text`.

    At most about `rows_per_class` rows of each class take part, picked by a hash of the id. Four
    fifths are counted; the last fifth, which the models have not seen, sets the weights that turn a
    text's ratios into a probability, with the classes weighted as in all labelled rows; `cut` is the
    probability at which a text is best called toxic. Without both classes there is no model.
    """
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    draw = F.pmod(F.xxhash64(F.lit(seed), "ident"), F.lit(1 << 30)) / float(1 << 30)
    limit = F.when(F.col("toxic") == 1, rows_per_class / counts[1]).otherwise(rows_per_class / counts[0])
    sample = written(labelled.where(draw < limit).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(seed + 1), "ident"), F.lit(5))), "toxicity-sample")
    model = fit_models(sample.where("part > 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in model.features(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(first, len(x)).column("toxic"), pa.array(list(x), pa.list_(pa.float64()))],
                    ["toxic", "x"])

    seen = sample.where("part = 0").select("toxic", "text").mapInArrow(run, "toxic int, x array<double>").toArrow()
    y = seen.column("toxic").to_numpy()
    x = np.array(seen.column("x").to_pylist())
    share = {c: counts[c] / max((y == c).sum(), 1) for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    if len(set(y)) < 2:
        model.weights = np.array([0.0, 1.0, 1.0, 0.0, 0.0, 0.0])
        return model
    model.weights = _logistic(x, y, weight / weight.mean())
    # Where the harmonic mean of precision and recall is best, the probability shall be `cut`.
    order = np.argsort(-(x @ model.weights), kind="stable")
    found = np.cumsum(weight[order] * y[order])
    harmonic = 2 * found / (np.cumsum(weight[order]) + (weight * y).sum())
    best = int(np.argmax(harmonic))
    level = (x @ model.weights)[order[best:best + 2]].mean()
    model.weights[0] += np.log(cut / (1 - cut)) - level
    return model


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if not given) with a `toxicity` from 0 to 1; 0 without a model."""
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    if model is None:
        return docs.select(*columns, F.lit(0.0).alias("toxicity"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the rows it was fitted on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in shared.value.features(batch.column("_text")):
                part = batch.slice(first, len(x))
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(shared.value.scores(x))],
                                                 ["_row", "toxicity"])

    packed = docs.select(F.struct(*columns).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    schema = packed.select("_row").schema.add("toxicity", "double")
    return packed.mapInArrow(run, schema).select("_row.*", "toxicity")


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """`ident`, `toxic`, `text` of the documents with a label that may be learnt from.

    Those are the rows whose id has a remainder other than 1; null labels and ids are left out, and
    of contradicting labels the toxic one counts.
    """
    known = labels.where(F.col(label_col).isNotNull() & (crc_remainder(id_col, 3) != 1)).groupBy(
        F.col(id_col).alias("ident")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic"))
    return docs.select(F.col(id_col).alias("ident"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        known, "ident").select("ident", "toxic", "text")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.7, **training: int) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    Null and empty texts get the score of a text without any word. Without labels of both classes
    all scores are 0. Repeated rows are scored one by one; an empty table gives an empty result.
    """
    model = train(labelled_texts(docs, labels, id_col, text_col), cut=threshold, **training)
    found = scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, keep=["doc_id"])
    return found.select("doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
                        (F.col("toxicity") >= threshold).cast("int").alias("predicted"))
