"""Ranked lexical search: best-first document intervals, bounded by range maxima of posting lists."""

from __future__ import annotations

import math
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talusflow.llm.common import text_chunks, written
from talusflow.llm.words import coded, split_words

SHARD_DOCS = 1024       # documents of one shard of the index
SHARD_BYTES = 3 << 20   # text at which a shard is closed earlier
BLOCK_BYTES = 2 << 20   # query text that one pass over the index carries to its tasks
SPLITS = 96             # intervals that are split together

INDEX = ("n_docs long, n_terms long, n_with_id int, ids binary, sizes binary, letters binary, ends binary, "
         "ptr binary, docs binary, tf binary")


def _bytes(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


def _shard_row(ids: list[pa.Array], words: list[pa.Array], counts: list[np.ndarray]) -> pa.RecordBatch:
    """One shard: documents with an id first, terms with their postings in document order."""
    ids, counts = pa.concat_arrays(ids), np.concatenate(counts)
    codes, terms = coded(pa.concat_arrays(words))
    known = np.asarray(ids.is_valid())
    place = np.empty(len(ids), np.int64)
    place[np.argsort(~known, kind="stable")] = np.arange(len(ids))
    doc = np.repeat(place, counts)
    pairs, tf = np.unique(codes * np.int64(max(1, len(ids))) + doc, return_counts=True)
    term, docs = np.divmod(pairs, max(1, len(ids)))
    _, offsets, letters = terms.buffers()
    offsets = np.frombuffer(offsets, np.int64)[terms.offset:terms.offset + len(terms) + 1] if len(terms) else np.zeros(1, np.int64)
    letters = np.frombuffer(letters, np.uint8)[offsets[0]:offsets[-1]] if len(terms) else np.zeros(0, np.uint8)
    sizes = np.empty(len(ids), np.int64)
    sizes[place] = counts
    return pa.RecordBatch.from_arrays(
        [pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())]), pa.array([int(known.sum())], pa.int32()),
         *_bytes(ids.drop_null().to_numpy(zero_copy_only=False).astype("<i8"), sizes.astype("<i8"), letters,
                 (offsets[1:] - offsets[0]).astype("<i4"),
                 np.searchsorted(term, np.arange(len(terms) + 1)).astype("<i4"), docs.astype("<i4"), tf.astype("<i4"))],
        [c.split()[0] for c in INDEX.split(", ")])


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts like `text_chunks`, of a quarter shard's documents at most."""
    for first, end, data, offsets in text_chunks(column):
        for a in range(0, end - first, SHARD_DOCS // 4):
            b = min(a + SHARD_DOCS // 4, end - first)
            yield first + a, first + b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index in shards, written to the shared folder: a row holds some documents' postings.

    Terms are kept as written, every term of every document with its frequency, in document order.
    """
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, counts, docs, size = [], [], [], 0, 0
        for batch in batches:
            for first, end, data, offsets in _chunks(batch.column(1)):
                if docs and (docs + end - first > SHARD_DOCS or size + len(data) > SHARD_BYTES):
                    yield _shard_row(ids, words, counts)
                    ids, words, counts, docs, size = [], [], [], 0, 0
                part, bounds = split_words(data, offsets)
                ids.append(batch.column(0).slice(first, end - first))
                words.append(part)
                counts.append(np.diff(bounds))
                docs, size = docs + end - first, size + len(data)
        if docs:
            yield _shard_row(ids, words, counts)

    return written(texts.mapInArrow(run, INDEX), "search-index")


def _terms_of(letters: bytes, ends: bytes) -> pa.LargeBinaryArray:
    ends = np.frombuffer(ends, "<i4")
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(letters)])


class QueryBlock:
    """Queries as counted terms: `terms` of the block, and for each query its terms and repeats."""

    def __init__(self, texts: list[bytes]):
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        words, bounds = split_words(np.frombuffer(b"".join(texts), np.uint8), bounds)
        codes, self.terms = coded(words)
        self.of_query = [np.unique(codes[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]


def term_counts(index: DataFrame, block: QueryBlock) -> np.ndarray:
    """Documents that hold each term of the block, over the whole index."""
    terms = block.terms.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = pa.array(terms, pa.large_binary()), np.zeros(len(terms), np.int64)
        for batch in batches:
            for letters, ends, ptr in zip(*(batch.column(i).to_pylist() for i in range(3))):
                at = pc.index_in(wanted, value_set=_terms_of(letters, ends))
                there, at = np.flatnonzero(at.is_valid()), at.drop_null().to_numpy()
                total[there] += np.diff(np.frombuffer(ptr, "<i4"))[at]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    counted = index.select("letters", "ends", "ptr").mapInArrow(run, "term long, df long")
    df = np.zeros(len(terms), np.int64)
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most the block's terms
        df[row.term] = row.df
    return df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class SearchShard:
    """Posting lists of a block's terms in one shard, end to end, with a sparse table of range maxima.

    `table[k, i]` is the place of the largest impact among the 2^k postings from i on. Ranges are
    asked inside one list only, so a single table serves all lists.
    """

    def __init__(self, row: dict, block: QueryBlock, weight: np.ndarray, n_docs: int, n_terms: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        sizes = np.frombuffer(row["sizes"], "<i8")
        ptr, docs, tf = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("ptr", "docs", "tf"))
        at = pc.index_in(block.terms, value_set=_terms_of(row["letters"], row["ends"]))
        self.known = np.asarray(at.is_valid()) & (weight > 0)
        at = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        count = np.where(self.known, np.diff(ptr)[at], 0) if len(ptr) > 1 else np.zeros(len(weight), np.int64)
        self.known &= count > 0
        self.base = np.cumsum(count) - count
        self.count = count
        from_ = np.repeat(ptr[at] if len(ptr) > 1 else at, count)
        source = from_ + np.arange(count.sum()) - np.repeat(self.base, count)
        self.docs = docs[source]
        tf = tf[source]
        m = 100 - 25 + (25 * sizes * n_docs) // max(1, n_terms)
        self.impact = np.repeat(weight, count) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs]))
        self.logs = np.zeros(int(count.max(initial=0)) + 2, np.int64)
        for i in range(2, len(self.logs)):
            self.logs[i] = self.logs[i >> 1] + 1
        levels = int(self.logs[int(count.max(initial=0))]) + 1
        n = len(self.docs)
        self.table = np.empty((levels, n), np.int32)
        self.table[0] = np.arange(n)
        for k in range(1, levels):
            half = 1 << (k - 1)
            near = self.table[k - 1]
            far = near[np.minimum(np.arange(n) + half, n - 1)]
            self.table[k] = np.where(self.impact[far] > self.impact[near], far, near)

    def query(self, terms: np.ndarray, repeats: np.ndarray) -> "_Search":
        here = self.known[terms]
        return _Search(self, terms[here], repeats[here])


class _Search:
    """One query in one shard: `before[d, t]` postings of its t-th term lie before document d."""

    def __init__(self, shard: SearchShard, terms: np.ndarray, repeats: np.ndarray):
        self.shard, self.repeats, self.base = shard, repeats, shard.base[terms]
        n, count = len(shard.ids), shard.count[terms]
        column = np.repeat(np.arange(len(terms)), count)
        place = np.repeat(self.base, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        doc = shard.docs[place]
        self.before = np.zeros((n + 1, len(terms)), np.int32)
        inside = doc < n  # documents without an id are counted, but not found
        self.before[doc[inside] + 1, column[inside]] = 1
        np.cumsum(self.before, axis=0, out=self.before)

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For document intervals [low, high): the sum of the terms' largest impacts, and the document
        with the largest single one, where the interval will be split."""
        shard = self.shard
        first, end = self.before[low], self.before[high]
        size = end - first
        some = size > 0
        k = shard.logs[size]
        left = shard.table[k, np.where(some, self.base + first, 0)]
        right = shard.table[k, np.where(some, self.base + end - (1 << k), 0)]
        a, b = shard.impact[left], shard.impact[right]
        largest = np.where(some, np.maximum(a, b) * self.repeats, 0)
        top = largest.argmax(axis=1)
        row = np.arange(len(low))
        place = np.where(b[row, top] > a[row, top], right[row, top], left[row, top])
        return largest.sum(axis=1), shard.docs[place]

    def scores(self, docs: np.ndarray) -> np.ndarray:
        at = self.before[docs]
        there = self.before[docs + 1] > at
        return (self.shard.impact[np.where(there, self.base + at, 0)] * there * self.repeats).sum(axis=1)

    def best(self, best_scores: np.ndarray, best_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the given documents and this shard's, highest first, ties by id."""
        if not len(self.repeats) or not len(self.shard.ids):
            return best_scores, best_ids
        low, high = np.array([0]), np.array([len(self.shard.ids)])
        bound, split = self.bounds(low, high)
        while True:
            bar = max(1, best_scores[k - 1] if len(best_scores) >= k else 0)
            live = bound >= bar
            if not live.any():
                return best_scores, best_ids
            low, high, bound, split = low[live], high[live], bound[live], split[live]
            first = np.argpartition(-bound, SPLITS)[:SPLITS] if len(bound) > SPLITS else np.arange(len(bound))
            docs = split[first]
            all_scores = np.concatenate([best_scores, self.scores(docs)])
            all_ids = np.concatenate([best_ids, self.shard.ids[docs]])
            order = np.lexsort((all_ids, -all_scores))[:k]
            best_scores, best_ids = all_scores[order], all_ids[order]
            new_low, new_high = np.concatenate([low[first], docs + 1]), np.concatenate([docs, high[first]])
            held = np.ones(len(low), dtype=bool)
            held[first] = False
            some = new_low < new_high
            new_low, new_high = new_low[some], new_high[some]
            new_bound, new_split = self.bounds(new_low, new_high)
            low, high = np.concatenate([low[held], new_low]), np.concatenate([high[held], new_high])
            bound, split = np.concatenate([bound[held], new_bound]), np.concatenate([split[held], new_split])


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """(item, text) rows in blocks of about `block_bytes`, one at a time."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total <= block_bytes:
        rows = items.orderBy("item").collect()
        if rows:
            yield rows
        return
    count = 2 * ceil(total / block_bytes)
    dealt = written(items.withColumn("_block", F.pmod(F.xxhash64("item"), F.lit(count))), "search-queries")
    for block in range(count):
        rows = dealt.where(F.col("_block") == block).drop("_block").orderBy("item").collect()
        if rows:
            yield rows


def search(index: DataFrame, queries: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = 20,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of each item: item_col, rank, doc_id, score.

    A block of queries of bounded size goes to the tasks; more queries take a pass over the index
    for each block. In a task each query keeps its k best so far from shard to shard, so later
    shards start with that bar; intervals whose summed range maxima stay below it are not opened.
    """
    spark = index.sparkSession
    items = queries.where(F.col(text_col).isNotNull()).groupBy(F.col(item_col).alias("item")).agg(
        F.array_join(F.collect_list(text_col), " ").alias("text"))
    kind = queries.schema[item_col].dataType.simpleString()
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    found = spark.createDataFrame([], f"item {kind}, doc_id long, score long")
    for rows in _blocks(items, block_bytes):
        texts = [r.text.encode() for r in rows]
        weight = weights(term_counts(index, QueryBlock(texts)), n_docs)
        numbered = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], f"query int, item {kind}")
        found = found.union(_searched(index, texts, weight, n_docs, n_terms, k).join(
            F.broadcast(numbered), "query").select("item", "doc_id", "score"))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("item").alias(item_col), "rank", "doc_id", "score")


def _searched(index: DataFrame, texts: list[bytes], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = QueryBlock(texts)
        none = np.zeros(0, np.int64)
        best = [(none, none) for _ in texts]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                shard = SearchShard(row, block, weight, n_docs, n_terms)
                for q, (terms, repeats) in enumerate(block.of_query):
                    best[q] = shard.query(terms, repeats).best(*best[q], k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), [len(s) for s, _ in best]).astype(np.int32)),
             pa.array(np.concatenate([i for _, i in best])), pa.array(np.concatenate([s for s, _ in best]))],
            ["query", "doc_id", "score"])

    needed = index.drop("n_docs", "n_terms", "n_with_id")
    return needed.mapInArrow(run, "query int, doc_id long, score long")


def ranked_documents(documents: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text: str = "text", k: int = 20) -> DataFrame:
    """`search` over a new index of all documents.

    Null texts have no terms. Documents without an id count in all statistics but are not returned;
    each of several rows with one id is a document of its own. Rows of `queries` with one id are one
    item with the terms of all of them; an item without an id is an item like others; one without
    terms or without a document that scores finds nothing. Empty tables give no rows. Texts may have
    any length: a long one closes its shard. Other columns are not read.
    """
    return search(build_index(documents, id_col, text_col), queries, item_col, item_text, k)
