"""Removal of documents that hold benchmark passages, by suffix arrays over the training words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import text_chunks, written
from talusflow.llm.words import coded, split_words

WINDOW = 10
BLOCK_BYTES = 2 << 20   # benchmark text that one pass over the documents carries to its tasks
PIECE_WORDS = 50_000    # longer items are searched in overlapping pieces
SHARD_BYTES = 6 << 20   # text of one suffix array
SHARD_WORDS = 1 << 20   # its words at most, so that three ranks fit one sort key

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def benchmark_pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """`item` (text), `first` (number of the piece's first word in its item) and `words` as written.

    Pieces overlap by a window less one word, so each window of an item lies in exactly one piece.
    """
    words = benchmark.select(
        F.col(item_col).cast("string").alias("item"),
        F.regexp_extract_all(text_col, F.lit(_WORD), F.lit(0)).alias("_all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_all") - window, F.lit(0)), F.lit(PIECE_WORDS))
    return words.where(F.size("_all") > 0).select(
        "item", "_all", F.explode(starts).alias("first")).select(
        "item", "first", F.slice("_all", F.col("first") + 1, PIECE_WORDS + window - 1).alias("words"))


def benchmark_blocks(pieces: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, int, list[str]]]]:
    """The pieces in blocks of about `block_bytes`, one at a time: what a pass takes to its tasks."""
    size = F.octet_length(F.array_join("words", " "))
    total = pieces.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    if total <= block_bytes:
        rows = [(r.item, r.first, r.words) for r in pieces.orderBy("item", "first", "words").collect()]
        if rows:
            yield rows
        return
    blocks = 2 * ceil(total / block_bytes)
    dealt = written(pieces.withColumn("_block", F.pmod(F.xxhash64("item", "first", "words"), F.lit(blocks))),
                    "benchmark-pieces")
    for block in range(blocks):
        rows = [(r.item, r.first, r.words) for r in
                dealt.where(F.col("_block") == block).orderBy("item", "first", "words").collect()]
        if rows:
            yield rows


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first `depth` codes (0 and up).

    Ranks by 1, 3, 9 ... codes: three ranks of one step make the sort key of the next.
    """
    n = len(codes)
    rank, reach = codes.astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while reach < depth and n:
        base = np.int64(rank.max() + 1)
        padded = np.concatenate([rank, np.zeros(2 * reach, np.int64)])
        key = (rank * base + padded[reach:reach + n]) * base + padded[2 * reach:2 * reach + n]
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(key[1:] != key[:-1])])
        reach *= 3
        if rank[order[-1]] == n:
            break
    return order


@dataclass
class BenchmarkBlock:
    """The words of a block's pieces end to end, a closing mark after each, and its windows.

    Equal windows form a class; `class_items` lists the items of each class.
    """

    vocabulary: pa.LargeBinaryArray
    codes: np.ndarray         # word numbers, -1 behind each piece
    piece_of: np.ndarray      # piece of each position
    piece_start: np.ndarray
    piece_first: np.ndarray
    items: list[str | None]   # of each piece
    class_start: np.ndarray   # where a window of the class stands
    class_size: np.ndarray
    class_ptr: np.ndarray
    class_items: np.ndarray   # numbers into `names`
    names: list[str]

    @classmethod
    def of(cls, rows: list[tuple[str | None, int, list[str]]], window: int) -> BenchmarkBlock:
        sizes = np.array([len(words) for _, _, words in rows], np.int64)
        lowered = pa.array([w.encode() for _, _, words in rows for w in words], pa.large_binary())
        # bytes.lower() touches A-Z only
        lowered = pa.array([w.lower() for w in lowered.to_pylist()], pa.large_binary())
        numbers, vocabulary = coded(lowered)
        piece_start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        codes = np.full(int(sizes.sum()) + len(rows), -1, np.int64)
        piece_of = np.repeat(np.arange(len(rows)), sizes + 1)
        closing = piece_start + sizes
        codes[np.setdiff1d(np.arange(len(codes)), closing, assume_unique=True)] = numbers
        names = sorted({item for item, _, _ in rows if item is not None})
        number = {name: i for i, name in enumerate(names)}
        items = [item for item, _, _ in rows]
        of_piece = np.array([number.get(item, -1) for item in items], np.int64)
        # A piece of fewer words than a window is one window itself.
        window_size = np.minimum(sizes, window)
        count = sizes - window_size + 1
        start = np.repeat(piece_start, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        size = np.repeat(window_size, count)
        at = start[:, None] + np.arange(window)
        padded = np.concatenate([codes, np.full(window, -1, np.int64)])
        text = np.where(np.arange(window) < size[:, None], padded[np.minimum(at, len(padded) - 1)], -2)
        _, representative, classes = np.unique(text, axis=0, return_index=True, return_inverse=True)
        named = of_piece[piece_of[start]]
        pairs = np.unique(classes.ravel()[named >= 0] * np.int64(max(1, len(names))) + named[named >= 0])
        class_of, item_of = np.divmod(pairs, max(1, len(names)))
        return cls(vocabulary, codes, piece_of, piece_start, np.array([f for _, f, _ in rows], np.int64), items,
                   start[representative], size[representative],
                   np.searchsorted(class_of, np.arange(len(representative) + 1)), item_of, names)

    @property
    def longest(self) -> int:
        return int(np.diff(np.append(self.piece_start, len(self.codes))).max()) - 1


class Shard:
    """A suffix array over the words of some documents, and the block's words in its numbers."""

    def __init__(self, words: pa.LargeBinaryArray, bounds: np.ndarray, block: BenchmarkBlock, depth: int):
        numbers, vocabulary = coded(words)
        # A mark behind each document, below all words, keeps matches inside documents.
        self.doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) + 1)
        self.start = bounds[:-1] + np.arange(len(bounds) - 1)
        self.codes = np.zeros(len(self.doc), np.int64)
        inside = np.ones(len(self.doc), dtype=bool)
        inside[self.start + np.diff(bounds)] = False
        self.codes[inside] = numbers + 1
        known = pc.index_in(block.vocabulary, value_set=vocabulary)
        here = known.fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.query = np.where(block.codes >= 0, here[np.maximum(block.codes, 0)], -2)  # absent: -1, mark: -2
        self.order = suffix_array(self.codes, depth)
        self.codes = np.concatenate([self.codes, [0]])

    def compared(self, at: np.ndarray, suffix: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign (training suffix against test suffix, first `sizes` words) and equal words before."""
        sign, equal = np.zeros(len(at), np.int8), np.zeros(len(at), np.int64)
        left, step, last = np.arange(len(at)), 0, len(self.codes) - 1
        while len(left):
            left = left[sizes[left] > step]
            ours = self.codes[np.minimum(at[left] + step, last)]
            theirs = self.query[suffix[left] + step]
            same = ours == theirs
            sign[left[~same]] = np.where(ours[~same] < theirs[~same], -1, 1)
            left = left[same]
            equal[left] += 1
            step += 1
        return sign, equal

    def bound(self, suffix: np.ndarray, sizes: np.ndarray, behind: bool) -> np.ndarray:
        """Binary search: the first place in the suffix array not below (`behind`: above) each test suffix."""
        low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(self.order), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            sign, _ = self.compared(self.order[middle], suffix[open_], sizes[open_])
            below = sign <= 0 if behind else sign < 0
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        return low

    def occurrences(self, block: BenchmarkBlock) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a window stands, and the window's class."""
        missing = np.concatenate([[0], np.cumsum(self.query < 0)])
        whole = np.flatnonzero(missing[block.class_start + block.class_size] == missing[block.class_start])
        starts, sizes = block.class_start[whole], block.class_size[whole]
        low = self.bound(starts, sizes, behind=False)
        count = self.bound(starts, sizes, behind=True) - low
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return self.order[at], np.repeat(whole, count)

    def longest(self, block: BenchmarkBlock) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix the length of its longest verbatim match here, and where one stands."""
        suffix = np.flatnonzero(block.codes >= 0)
        ends = np.append(block.piece_start[1:], len(block.codes))[block.piece_of[suffix]] - 1
        sizes = ends - suffix
        behind = self.bound(suffix, sizes, behind=False)
        best, where = np.zeros(len(suffix), np.int64), np.zeros(len(suffix), np.int64)
        for place in (behind - 1, behind):
            at = self.order[np.clip(place, 0, len(self.order) - 1)]
            _, equal = self.compared(at, suffix, sizes)
            better = equal > best
            best[better], where[better] = equal[better], at[better]
        return best, where


def _shards(column: pa.Array, overlap: int) -> Iterator[tuple[int, np.ndarray, pa.LargeBinaryArray, np.ndarray, np.ndarray]]:
    """Shards of whole texts: first row, words per row, words, bounds, and the words before each part.

    A text beyond `SHARD_WORDS` is cut into parts that overlap by `overlap` words.
    """
    for first, _, data, offsets in text_chunks(column, SHARD_BYTES):
        words, bounds = split_words(data, offsets)
        counts = np.diff(bounds)
        if len(words) <= SHARD_WORDS:
            yield first, counts, words, bounds, np.zeros(len(counts), np.int64)
            continue
        for row in range(len(counts)):
            for begin in range(0, max(1, int(counts[row]) - overlap), SHARD_WORDS):
                part = words.slice(bounds[row] + begin, min(SHARD_WORDS + overlap, int(counts[row]) - begin))
                yield first + row, counts[row:row + 1], part, np.array([0, len(part)]), np.array([begin])


def _hit_runs(rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n: int) -> pa.ListArray:
    """Runs of hit words (start, length) of each of `n` rows, from windows that may overlap or touch."""
    order = np.lexsort((starts, rows))
    rows, starts, sizes = rows[order], starts[order], sizes[order]
    shift = rows * np.int64(1 << 40)
    reach = np.maximum.accumulate(shift + starts + sizes) if len(rows) else shift
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (shift + starts)[1:] > reach[:-1]  # else it begins no later than the furthest end so far
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(rows))[:len(begin)] - 1
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(rows[begin], np.arange(n + 1)), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(starts[begin]), pa.array((reach - shift)[last] - starts[begin])], ["start", "length"]))


class _Found:
    """What the shards of one Arrow batch found: hit positions and items per row."""

    def __init__(self, rows: int):
        self.n_words = np.zeros(rows, np.int64)
        self.rows, self.starts, self.sizes = [], [], []
        self.item_rows, self.item_numbers = [], []

    def add(self, first: int, before: np.ndarray, shard: Shard, block: BenchmarkBlock) -> None:
        at, classes = shard.occurrences(block)
        doc = shard.doc[at]
        self.rows.append(first + doc)
        self.starts.append(at - shard.start[doc] + before[doc])
        self.sizes.append(block.class_size[classes])
        pairs = np.unique(doc * np.int64(len(block.class_size)) + classes)
        doc, classes = np.divmod(pairs, len(block.class_size))
        count = np.diff(block.class_ptr)[classes]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.item_rows.append(np.repeat(first + doc, count))
        self.item_numbers.append(block.class_items[np.repeat(block.class_ptr[classes], count) + inner])

    def arrays(self, names: list[str]) -> list[pa.Array]:
        n = len(self.n_words)
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        rows, starts, sizes = joined(self.rows), joined(self.starts), joined(self.sizes)
        spans = _hit_runs(rows, starts, sizes, n)
        item_rows, numbers = joined(self.item_rows), joined(self.item_numbers)
        width = max(1, len(names))
        item_rows, numbers = np.divmod(np.unique(item_rows * np.int64(width) + numbers), width)
        items = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(item_rows, np.arange(n + 1)), pa.int32()),
            pa.array(names, pa.string()).take(pa.array(numbers)))
        return [pa.array(self.n_words), spans, items]


_FOUND = "n_words long, spans array<struct<start: long, length: long>>, items array<string>"


def _searched(texts: DataFrame, rows: list, window: int) -> DataFrame:
    """Columns of `texts` but the first, `_text`, with what one block of the benchmark hits."""
    kept = [f for f in texts.schema.fields[1:]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = BenchmarkBlock.of(rows, window) if rows else None
        for batch in batches:
            found = _Found(batch.num_rows)
            for first, counts, words, bounds, before in _shards(batch.column(0), window - 1):
                found.n_words[first:first + len(counts)] = counts
                if block is not None and len(words):
                    found.add(first, before, Shard(words, bounds, block, window), block)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *found.arrays(block.names if block else [])],
                [*(f.name for f in kept), "n_words", "spans", "items"])

    return texts.mapInArrow(run, f"{schema}, {_FOUND}" if kept else _FOUND)


def _merged(results: DataFrame) -> DataFrame:
    """`_row`, n_words, spans, items, the spans of several blocks (in any order) made one list of runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2)
            flat, offsets = spans.flatten(), spans.offsets.to_numpy()
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            start, length = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _hit_runs(rows, start, length, batch.num_rows), batch.column(3)],
                ["_row", "n_words", "spans", "items"])
    return results.select("_row", "n_words", "spans", "items").mapInArrow(run, f"_row long, {_FOUND}")


def find_contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = (),
                       window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document with the benchmark words it holds: id, `keep`, n_words, n_hit, spans, items.

    Tasks sort the suffixes of their documents' words, in shards of bounded size, and look every
    distinct window of the benchmark up by binary search; all places of a window are neighbours in
    the array. `spans` are the runs of hit words (start, length in words), `items` the ids (as
    text, sorted) of the items with a window in the document. A block of the benchmark of bounded
    size goes to the tasks; a larger benchmark takes a pass for each block, whose results are joined
    by document.

    Null and empty texts have no words and no hits; an item without words has no window; an item
    without an id hits words but is not listed; items of one id count as one. Repeated documents
    are judged each, equal windows of several items hit for all of them. Documents and items may be
    of any length. Empty tables give no rows or no hits. Other columns are not read, unless named in
    `keep`.
    """
    pieces = benchmark_pieces(benchmark, item_col, item_text, window)
    picked = [F.col(text_col).cast("binary").alias("_text"), F.col(id_col)]
    picked += [F.col(c) for c in keep if c != id_col]
    texts = documents.select(*picked)
    kept = texts.columns[1:]
    blocks = benchmark_blocks(pieces, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = _searched(texts, first, window)
    else:
        rows = written(texts.withColumn("_row", F.monotonically_increasing_id()), "decontamination-texts")
        narrow = rows.select("_text", "_row")
        passes = [written(_searched(narrow, first, window), "decontamination-pass")]
        for block in (second, *blocks):
            passes.append(written(_searched(narrow, block, window), "decontamination-pass"))
        union = passes[0]
        for other in passes[1:]:
            union = union.union(other)
        joined = _merged(union.groupBy("_row").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
        found = rows.drop("_text").join(joined, "_row").drop("_row")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["length"])
    return found.select(*kept, "n_words", n_hit.alias("n_hit"), "spans", "items")


def clean_documents(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without a single hit, with all their columns; `options` as in `find_contamination`."""
    columns = documents.columns
    names = [f"_c{i}" for i in range(len(columns))]
    found = find_contamination(documents.toDF(*names), benchmark, id_col=names[0],
                               text_col=names[columns.index(text_col)], keep=tuple(names[1:]), **options)
    return found.where("n_hit = 0").select(*names).toDF(*columns)


def longest_matches(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim match of each item: item_id, item_start, length, doc_id, doc_start (in words).

    Of several longest matches that of the smallest document, then the first place, is named; a null
    id comes first. Items without a common word with any document are not listed. Pieces of items
    beyond `PIECE_WORDS` words are matched each; a match cannot cross from one to the next.
    """
    pieces = benchmark_pieces(benchmark, item_col, item_text, window)
    texts = documents.select(F.col(text_col).cast("binary").alias("text"), F.col(id_col).cast("string").alias("id"))
    schema = "item string, item_start long, length long, id string, doc_start long"

    def searching(rows):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = BenchmarkBlock.of(rows, window)
            suffix = np.flatnonzero(block.codes >= 0)
            piece = block.piece_of[suffix]
            for batch in batches:
                for first, _, words, bounds, before in _shards(batch.column(0), block.longest):
                    if not len(words):
                        continue
                    shard = Shard(words, bounds, block, block.longest)
                    length, where = shard.longest(block)
                    # the longest of each piece stands first
                    order = np.lexsort((suffix, -length, piece))
                    best = order[np.unique(piece[order], return_index=True)[1]]
                    best = best[length[best] > 0]
                    doc = shard.doc[where[best]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.items[i] for i in piece[best]], pa.string()),
                         pa.array(suffix[best] - block.piece_start[piece[best]] + block.piece_first[piece[best]]),
                         pa.array(length[best]), batch.column(1).take(pa.array(first + doc)).cast(pa.string()),
                         pa.array(where[best] - shard.start[doc] + before[doc])],
                        ["item", "item_start", "length", "id", "doc_start"])
        return texts.mapInArrow(run, schema)

    found = None
    for rows in benchmark_blocks(pieces, block_bytes):
        part = searching(rows)
        found = part if found is None else found.union(part)
    if found is None:
        found = documents.sparkSession.createDataFrame([], schema)
    kind = documents.schema[id_col].dataType
    row = F.struct((-F.col("length")).alias("order"), F.col("id").cast(kind).alias("doc_id"), "doc_start", "item_start",
                   "length")
    return found.groupBy(F.col("item").alias("item_id")).agg(F.min(row).alias("m")).select(
        "item_id", "m.item_start", "m.length", "m.doc_id", "m.doc_start")
