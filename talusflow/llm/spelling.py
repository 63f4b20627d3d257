"""Spelling variants: words one edit apart, by edit-matrix rows over sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import written

# Fixed values of the contract: what a run is, which runs get a deletion, which words count.
RUN = r"[A-Za-zÀ-ÿ]+"
NOISE = 97
MIN_LENGTH = 5
MIN_COUNT = 3

GROUP_ROWS = 16_384   # a larger group is divided; the last division leaves fewer than 9,000 words
BATCH_ROWS = 32_768   # words that a task compares together, in whole groups
BATCH_CELLS = 1 << 25


def _lowered(run: Column) -> Column:
    """A-Z lowered only: `lower` does that to a run of single-byte letters."""
    plain = F.octet_length(run) == F.char_length(run)
    return F.when(plain, F.lower(run)).otherwise(
        F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`word`, `n`: the words of all documents with their number of occurrences."""
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = documents.select(id_text.alias("id"), F.explode(
        F.regexp_extract_all(text_col, F.lit(RUN), F.lit(0))).alias("run")).where(F.char_length("run") >= MIN_LENGTH)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    noisy = runs.select("id", _lowered(F.col("run")).alias("run")).select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    rest = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    word = F.when(F.col("h") % NOISE == 0, rest).otherwise(F.col("run"))
    return noisy.select(word.alias("word")).where(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def _grouped(ranges: DataFrame) -> DataFrame:
    """`key`: words that a pair of this range may come from; `mid`: what is left of the word.

    A row says: pairs whose shorter word has `m` letters and whose common prefix has at least `low`
    and fewer than `high`. Two words one edit apart then also share the last `m - high` letters, so
    both sit in the group of that prefix and that suffix, and differ by one edit between them.
    """
    tail = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    length = F.char_length("word")
    return ranges.withColumn("key", F.concat_ws(
        "/", "m", "low", "high", F.expr("left(word, low)"), F.when(tail > 0, F.expr("right(word, greatest(m - high, 0))")))
    ).withColumn("mid", F.encode(F.col("word").substr(F.col("low") + 1, length - F.col("low") - tail), "ISO-8859-1"))


def _halves(ranges: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")),
                    F.struct(middle.alias("low"), F.col("high").alias("high")))
    return ranges.select("word", "n", "m", F.inline(parts))


def groups(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every word in the groups in which its near words are found, none of more than `group_rows`.

    Each pair of near words meets in exactly one group: that of its shorter length and its common
    prefix. Ranges of prefix lengths are halved where a group is too large; a range of one length
    fixes all but one or two letters, which bounds its groups by the alphabet.
    """
    length = F.char_length("word")
    shorter = F.array_compact(F.array(length, F.when(length > MIN_LENGTH, length - 1)))
    todo = words.select("word", "n", F.explode(shorter).alias("m")).withColumns(
        {"low": F.lit(0), "high": F.col("m") + 1})
    todo, done = _halves(todo), None
    while True:
        placed = _grouped(todo)
        hot = placed.groupBy("key", "low", "high").agg(F.count(F.lit(1)).alias("rows")).where(
            (F.col("rows") > group_rows) & (F.col("high") - F.col("low") > 1)).select("key")
        hot = written(hot, "spelling-hot-groups")
        if hot.isEmpty():
            return placed if done is None else done.union(placed)
        settled = placed.join(hot, "key", "left_anti").select(*placed.columns)
        done = settled if done is None else done.union(settled)
        todo = _halves(written(placed.join(hot, "key", "left_semi").select(*todo.columns), "spelling-divided"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Binary rows as a matrix of bytes filled up with 0, and their lengths."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    sizes = np.diff(offsets)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] \
        else np.zeros(0, np.uint8)
    matrix = np.zeros((len(column), int(sizes.max(initial=0)) + 2), np.uint8)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = data
    return matrix, sizes


def near_pairs(letters: np.ndarray, sizes: np.ndarray, group: np.ndarray, span: np.ndarray, short: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are one edit apart within their group, as (row, near row), each pair both ways.

    Rows are sorted by group and letters, so rows with a common prefix are a range, and the
    adjacent common prefixes (LCPs) say where each range divides at the next letter. All rows walk
    down the ranges of their group together. A step extends the edit matrix by one row, of which
    only the band of three cells around the diagonal can hold a value below two; the row of a prefix is
    computed once for the whole range that shares it, and a range is left as soon as no cell of
    the band is below two. Only a pair whose shorter word has `short` letters and whose common
    prefix is shorter than `span` is reported; other groups report the others.
    """
    n, width = letters.shape
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = group[1:] != group[:-1]
    lcp = np.zeros(n, np.int64)
    differ = letters[1:] != letters[:-1]
    lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp[fresh] = -1
    begin = np.flatnonzero(fresh)
    row = np.arange(n)
    node = np.cumsum(fresh) - 1
    # The band: cells of the query's first depth - 1, depth and depth + 1 letters.
    left, middle, right = np.full(n, 2, np.int8), np.zeros(n, np.int8), np.ones(n, np.int8)
    rows, found = [], []
    for depth in range(width):
        first = begin[node]
        over = sizes[row] - depth
        distance = np.select([over == -1, over == 0, over == 1], [left, middle, right], 2)
        hit = (sizes[first] == depth) & (distance == 1) & (np.minimum(sizes[row], depth) == short[row])
        rows.append(row[hit])
        found.append(first[hit])
        # Children: ranges that share one letter more. The word that ends here is none of them.
        child = np.flatnonzero((lcp <= depth) & (sizes > depth))
        if not len(child) or not len(row):
            break
        parent = np.searchsorted(begin, child, side="right") - 1
        letter = letters[child, depth]
        ptr = np.searchsorted(parent, np.arange(len(begin) + 1))
        exact = middle == 0
        # No edit so far: every child may go on. One edit: only those that match the next letter
        # of a cell that has one.
        at = np.flatnonzero(exact)
        count = ptr[node[at] + 1] - ptr[node[at]]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        states, nodes = [np.repeat(at, count)], [np.repeat(ptr[node[at]], count) + inner]
        edited = np.flatnonzero(~exact)
        key = parent * 256 + letter
        seen = np.full((len(edited), 2), -1, np.int64)
        for i, (cell, place) in enumerate(((left, depth - 1), (middle, depth), (right, depth + 1))):
            use = cell[edited] == 1
            use &= (sizes[row[edited]] > place) & (place >= 0)
            wanted = letters[row[edited], max(place, 0) if place < width else width - 1].astype(np.int64)
            for earlier in range(i):
                use &= ~(seen[:, earlier] == wanted)
            if i < 2:
                seen[use, i] = wanted[use]
            wanted = node[edited] * 256 + wanted
            spot = np.searchsorted(key, wanted)
            use &= key[np.minimum(spot, len(key) - 1)] == wanted
            states.append(edited[use])
            nodes.append(spot[use])
        state, node = np.concatenate(states), np.concatenate(nodes)
        row, c = row[state], letter[node]
        query = lambda place: letters[row, min(max(place, 0), width - 1)] != c
        one = np.minimum(left[state] + (query(depth - 1) if depth else np.int8(2)), middle[state] + 1)
        two = np.minimum(np.minimum(middle[state] + query(depth), right[state] + 1), one + 1)
        three = np.minimum(right[state] + query(depth + 1), two + 1)
        left, middle, right = (np.minimum(x, 2).astype(np.int8) for x in (one, two, three))
        alive = (np.minimum(np.minimum(left, middle), right) < 2) & (sizes[row] >= depth)
        alive &= ~((middle == 0) & (depth + 1 >= span[row]))
        row, node, left, middle, right = row[alive], node[alive], left[alive], middle[alive], right[alive]
        begin = child
    return np.concatenate(rows), np.concatenate(found)


_NEAR = "word string, n long, n_near long, near_n long, near string"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups, sorted by key and mid, to a row per word: its near words' number and the best one."""
    for rows in _whole_groups(batches):
        key = rows.column("key").combine_chunks()
        change = np.concatenate([[True], pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)])
        letters, sizes = _lists(rows.column("mid").combine_chunks())
        m, low, high, n = (rows.column(c).to_numpy() for c in ("m", "low", "high", "n"))
        short = m - low - np.maximum(m - high, 0)
        row, near = near_pairs(letters, sizes, np.cumsum(change), high - low, short)
        words = rows.column("word").combine_chunks()
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        order = np.lexsort((rank[near], -n[near], row))
        row, near = row[order], near[order]
        has, first = np.unique(row, return_index=True)
        best = np.full(len(words), -1, np.int64)
        best[has] = near[first]
        index = pa.array(best, mask=best < 0)
        yield pa.RecordBatch.from_arrays(
            [words, pa.array(n), pa.array(np.bincount(row, minlength=len(words)).astype(np.int64)),
             pa.array(n).take(index), words.take(index)], ["word", "n", "n_near", "near_n", "near"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of about `BATCH_ROWS` (fewer when long) that end where a group ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        longest = pc.max(pc.binary_length(batch.column("mid"))).as_py() + 2
        if rows >= BATCH_ROWS or rows * longest >= BATCH_CELLS:
            table = pa.Table.from_batches(held)
            key = table.column("key").combine_chunks()
            last = pc.not_equal(key, key[len(key) - 1]).to_numpy(zero_copy_only=False)
            cut = int(last.sum())  # sorted by key: the last group is the rest
            if cut:
                yield table.slice(0, cut)
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def near_words(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Each word with the number of its near words and the most frequent of them (ties: the smallest)."""
    placed = groups(words, group_rows).select("key", "mid", "word", "n", "m", "low", "high")
    compared = placed.repartition("key").sortWithinPartitions("key", "mid").mapInArrow(_compared, _NEAR)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("order"), "near")))
    return compared.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n", "n_near", (-F.col("_best.order")).alias("near_n"), F.col("_best.near").alias("near"))


def spelling_variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      group_rows: int = GROUP_ROWS) -> DataFrame:
    """word, n, n_near, form, form_n, root: each word's more frequent spelling, and where following them ends.

    A form is at least twice as frequent as its word, so a chain of forms is no longer than the
    logarithm of the largest count; each round follows twice as many steps as the one before.

    Null and empty texts have no words; a null id counts as empty text. Repeated documents count
    each. Words may be of any length; equal counts resolve to the smaller word in code-point order.
    An empty table gives no rows. Other columns are not read.
    """
    words = written(vocabulary(documents, id_col, text_col), "spelling-vocabulary")
    near = near_words(words, group_rows)
    takes = F.col("near_n") >= 2 * F.col("n")
    formed = written(near.select(
        "word", "n", "n_near", F.when(takes, F.col("near")).alias("form"),
        F.when(takes, F.col("near_n")).alias("form_n")), "spelling-forms")
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        further = steps.select(F.col("word").alias("to"), F.col("to").alias("next"))
        after = written(steps.join(further, "to", "left").select(
            "word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "spelling-steps")
        if after.where("moved").isEmpty():
            break
        steps = after.select("word", "to")
    return formed.join(steps.withColumnRenamed("to", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
