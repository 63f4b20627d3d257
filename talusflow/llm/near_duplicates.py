"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import dealt_tiles, hashed_words, in_runs, mixed, runs, settled, text_chunks, written
from talusflow.llm.components import connected
from talusflow.operators.reduction import key_bits, likely_keys


@dataclass(frozen=True)
class Method:
    """Parameters of the search.

    A pair at the threshold shares no band with probability (1 - threshold^rows)^bands. Its
    signature of `hashes` values, of which one byte each is kept, is compared in batches, and the pair
    goes when it is too unlikely to reach the threshold. `miss` limits the probability that a pair at
    the threshold is dropped by any of these looks.
    """

    words: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    hashes: int = 512
    batch: int = 32
    miss: float = 1e-6
    tile: int = 1024

    def least_matches(self) -> list[tuple[int, int]]:
        """After n compared values, the fewest matches that leave the pair in the race.

        With a uniform prior, similarity given m of n matches is Beta(m + 1, n - m + 1); it reaches
        the threshold with the probability that a binomial of n + 1 trials is at most m. Bytes of
        different values agree once in 256 times, which raises the threshold t a little. A pair at t
        has at most m of n matches with up to 1 / (1 - t) times that probability, so each look gets
        (1 - t) times its share of `miss`.
        """
        t, out = self.percent / 100 + (1 - self.percent / 100) / 256, []
        looks = range(self.batch, self.hashes + 1, self.batch)
        limit = self.miss * (1 - t) / len(looks)
        for n in looks:
            below, m = 0.0, 0
            while m < n:
                below += comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
                if below >= limit:
                    break
                m += 1
            out.append((n, m))
        return out

    def survivors(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose signatures pass all bounds, and their matches; losers leave after each batch."""
        alive = np.arange(len(left))
        matches = np.zeros(len(left), dtype=np.int32)
        done = 0
        for n, least in self.least_matches():
            matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
            keep = matches >= least
            alive, matches, done = alive[keep], matches[keep], n
            if not len(alive):
                break
        return alive, matches


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of texts in runs: first row, hashes, bounds of each text."""
    steps = np.random.default_rng(7 * words).integers(1, 2**62, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    short = np.random.default_rng(11).integers(1, 2**62, words + 1, dtype=np.uint64)
    for first, end, data, offsets in text_chunks(column):
        hashes, bounds, _ = hashed_words(data, offsets)
        weighted = hashes[:max(len(hashes) - words + 1, 0)] * steps[0]
        for j in range(1, words):
            weighted = weighted + hashes[j:len(hashes) - words + 1 + j] * steps[j]
        weighted = mixed(weighted)
        sets = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= words:
                s = np.sort(weighted[a:b - words + 1])
                if len(s) > 1:
                    s = s[np.r_[True, s[1:] != s[:-1]]]
            elif b > a:
                s = mixed((hashes[a:b] * steps[:b - a]).sum(dtype=np.uint64, keepdims=True) + short[b - a:b - a + 1])
            else:
                s = np.empty(0, np.uint64)
            sets.append(s)
        yield first, np.concatenate(sets) if sets else np.empty(0, np.uint64), np.cumsum([0] + [len(s) for s in sets])


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = (np.arange(len(rows) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()),
                                                          pa.py_buffer(rows.tobytes())])


def _signatures(rows: DataFrame, method: Method) -> DataFrame:
    """node, doc_id, n_shingles, a 128-bit mark of the whole set, signature, band keys."""
    draw = np.random.default_rng(20240301)
    factors = draw.integers(0, 2**31, method.hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = draw.integers(0, 2**32, method.hashes, dtype=np.uint32)
    steps = draw.integers(1, 2**62, method.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in shingle_sets(batch.column("text"), method.words):
                n = len(bounds) - 1
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                signature = np.zeros((n, method.hashes), dtype=np.uint32)
                marks = np.zeros((n, 2), dtype=np.uint64)
                if len(full):
                    at = bounds[:-1][full]
                    small = (hashes >> np.uint64(32)).astype(np.uint32)
                    value = np.empty_like(small)
                    for k in range(method.hashes):
                        np.multiply(small, factors[k], out=value)
                        np.add(value, shifts[k], out=value)
                        signature[full, k] = np.minimum.reduceat(value, at)
                    marks[full, 0] = np.add.reduceat(hashes, at)
                    marks[full, 1] = np.add.reduceat(mixed(hashes), at)
                lines = signature[:, :method.bands * method.rows].reshape(
                    n, method.bands, method.rows).astype(np.uint64)
                keys = mixed((lines * steps).sum(axis=2, dtype=np.uint64)
                             + mixed(np.arange(1, method.bands + 1, dtype=np.uint64)))
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("doc_id"), pa.array(sizes.astype(np.int64)),
                     _binary(marks), _binary((signature & np.uint32(255)).astype(np.uint8)), _binary(keys)],
                    ["node", "doc_id", "n_shingles", "mark", "signature", "keys"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"node long, doc_id {kind}, n_shingles long, mark binary, "
                                "signature binary, keys binary")


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


def _keys(rows: DataFrame, method: Method) -> DataFrame:
    """node, band key (the band is part of it) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _matrix(batch.column("keys"), "<i8", method.bands)
            nodes = np.repeat(batch.column("node").to_numpy(), method.bands)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys.reshape(-1))], ["node", "key"])
    return rows.select("node", "keys").mapInArrow(run, "node long, key long")


def _asked(rows: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """Rows whose `node` may be in one of the columns of `nodes`, found before the rows are shuffled.

    All that are there stay, and by chance some others: what follows joins exactly.
    """
    asked = nodes.select(F.explode(F.array(*columns)).alias("node"))
    return likely_keys(rows, "node", key_bits(asked, "node"))


def _pruned(pairs: DataFrame, signatures: DataFrame, method: Method) -> DataFrame:
    """Pairs a, b that survive the comparison of their signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = pa.array(method.survivors(_matrix(batch.column("sa"), "u1", method.hashes),
                                                  _matrix(batch.column("sb"), "u1", method.hashes))[0])
                yield pa.RecordBatch.from_arrays([batch.column("a").take(alive), batch.column("b").take(alive)],
                                                 ["a", "b"])
    sides = _asked(signatures.select("node", "signature"), pairs, "a", "b")
    joined = pairs.join(sides.toDF("a", "sa"), "a").join(sides.toDF("b", "sb"), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, method: Method) -> DataFrame:
    """Pairs a, b whose full shingle sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, np.ndarray] = {}

        def set_of(node: int, text: pa.Scalar) -> np.ndarray:
            if node not in last:
                if len(last) > 64:
                    last.clear()
                last[node] = next(shingle_sets(pa.array([text.as_py()], pa.string()), method.words))[1]
            return last[node]

        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                x, y = set_of(a, batch.column("ta")[i]), set_of(b, batch.column("tb")[i])
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= method.percent * (len(x) + len(y) - shared) > 0:
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)],
                                             ["a", "b"])
    sides = _asked(texts.select("node", "text"), pairs, "a", "b")
    joined = pairs.join(sides.toDF("a", "ta"), "a").join(sides.toDF("b", "tb"), "b")
    return joined.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame, method: Method) -> DataFrame:
    """node and its sorted shingle hashes, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in shingle_sets(batch.column("text"), method.words):
                rows = pa.Array.from_buffers(
                    pa.large_binary(), len(bounds) - 1,
                    [None, pa.py_buffer((bounds * 8).astype(np.int64)), pa.py_buffer(hashes)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, len(bounds) - 1), rows.cast(pa.binary())], ["node", "set"])
    return texts.select("node", "text").mapInArrow(run, "node long, set binary")


class _Forest:
    """Components inside one tile, by the roots known before."""

    def __init__(self, roots: np.ndarray):
        _, self.of = np.unique(roots, return_inverse=True)

    def merge(self, a: int, b: int) -> bool:
        x, y = self.of[a], self.of[b]
        if x != y:
            self.of[self.of == max(x, y)] = min(x, y)
        return x != y


def _forest_links(pairs: tuple[np.ndarray, np.ndarray], sets: list[np.ndarray], roots: np.ndarray, percent: int
                  ) -> list[tuple[int, int]]:
    """Links that join different components, each confirmed on the full sets: fewer than the rows.

    `pairs` are all that may be links. A row is compared with all its partners of other components
    at once, by counting its shingles among theirs. A pair whose rows meanwhile lie in one component
    cannot change anything and is passed over; every other pair is decided here.
    """
    left, right = pairs
    used, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    left, right = at[:len(left)], at[len(left):]
    sizes = np.array([len(sets[i]) for i in used])
    _, numbers = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
    ends = np.cumsum(sizes)
    own = [numbers[end - size:end] for end, size in zip(ends, sizes)]
    forest, links = _Forest(roots[used]), []
    mark = np.zeros(int(numbers.max(initial=-1)) + 1, dtype=bool)
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    heads, begins = np.unique(left, return_index=True)
    for x, begin, end in zip(heads, begins, np.append(begins[1:], len(left))):
        near = right[begin:end]
        near = near[forest.of[near] != forest.of[x]]
        if not len(near):
            continue
        mark[own[x]] = True
        starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
        shared = np.add.reduceat(mark[np.concatenate([own[y] for y in near])].astype(np.int64), starts)
        mark[own[x]] = False
        linked = 100 * shared >= percent * (sizes[x] + sizes[near] - shared)
        links += [(int(used[x]), int(used[y])) for y in near[linked] if forest.merge(x, y)]
    return links


def _tile_links(members: DataFrame, signatures: DataFrame, sets: DataFrame, method: Method, parts: int) -> DataFrame:
    """Confirmed links a, b between different components in buckets of any size, tile by tile.

    `members` has key, node, root, n (bucket size). A bucket is dealt into tiles by hash and each
    pair of tiles is a group of its own. A pair is looked at in its first common band only. What
    survives the signatures is decided on the full sets inside the task; of the links only those
    leave it that join components, so a tile sends fewer rows than it has.
    """
    def links_of(group: pa.Table) -> Iterator[tuple[int, int]]:
        i, j, key = (group.column(c)[0].as_py() for c in ("i", "j", "key"))
        side = group.column("side").to_numpy()
        node, root = group.column("node").to_numpy(), group.column("root").to_numpy()
        signature = _matrix(group.column("signature"), "u1", method.hashes)
        keys = _matrix(group.column("keys"), "<i8", method.bands)
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        if not len(left) or not len(right):
            return
        band = int(np.flatnonzero(keys[left[0]] == key)[0])
        open_pairs = root[left][:, None] != root[right][None, :]
        if i == j:
            open_pairs &= np.triu(np.ones_like(open_pairs), 1)
        for t in range(band):
            open_pairs &= keys[left, t][:, None] != keys[right, t][None, :]
        # All pairs of the tile batch by batch, until what is left is few enough to be listed.
        matches, done = np.zeros(open_pairs.shape, dtype=np.int16), 0
        for n, least in method.least_matches():
            if 50 * np.count_nonzero(open_pairs) < open_pairs.size:
                break
            for k in range(done, n):
                matches += signature[left, k][:, None] == signature[right, k][None, :]
            open_pairs &= matches >= least
            done = n
        x, y = (at.astype(np.int64) for at in np.nonzero(open_pairs))
        if not len(x):
            return
        alive, _ = method.survivors(signature[left[x]], signature[right[y]])
        if len(alive):
            column = group.column("set").to_pylist()
            full = [np.frombuffer(s, "<u8") for s in column]
            for a, b in _forest_links((left[x[alive]], right[y[alive]]), full, root, method.percent):
                yield int(node[a]), int(node[b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in runs(batches, ["key", "i", "j"]):
            found += links_of(group)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    dealt = dealt_tiles(members, method.tile, "root").join(
        _asked(signatures.select("node", "signature", "keys"), members, "node"), "node").join(sets, "node")
    return in_runs(dealt, parts).mapInArrow(run, "a long, b long").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    method: Method = Method()) -> DataFrame:
    """Groups of near-duplicate texts: doc_id, n_shingles, component_id, kept, first_row.

    Documents with equal shingle sets are one class. Of the other classes, first each member of a
    bucket meets the bucket's smallest one; what is linked by then needs no further look. In buckets
    that still hold several components, all pairs between components are tried, tile by tile. Links
    are confirmed on the full sets. `component_id` is the smallest id of the group, `kept` marks the
    rows with that id, `first_row` just one row of each group.

    Null and blank texts have no shingles and are alone. A null id is never the smallest unless the
    group has no other; such groups have a null component and all their rows are kept. Repeated
    rows are members like others. An empty table gives an empty result; other columns aren't read.
    """
    def make() -> DataFrame:
        texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        # Written once, as a plan that is run again might number its rows in another way.
        return _grouped(written(texts.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text"),
                                "neardup-texts", "zstd"), method)

    return settled(docs.sparkSession, "neardup-groups", make)


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       method: Method = Method()) -> DataFrame:
    """The documents with all their columns, one row of each group: with the smallest id."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    by_name = dict(zip(docs.columns, names))
    numbered = written(docs.toDF(*names).withColumn("node", F.monotonically_increasing_id()), "neardup-texts", "zstd")
    texts = numbered.select("node", F.col(by_name[id_col]).alias("doc_id"),
                            F.col(by_name[text_col]).cast("string").alias("text"))
    first = settled(docs.sparkSession, "neardup-first",
                    lambda: _grouped(texts, method).where("first_row").select("node"))
    return numbered.join(first, "node", "left_semi").select(*names).toDF(*docs.columns)


def _grouped(numbered: DataFrame, method: Method) -> DataFrame:
    rows = written(_signatures(numbered, method), "neardup-rows", "zstd")

    marks = written(rows.where("n_shingles > 0").groupBy("n_shingles", "mark").agg(
        F.min("node").alias("class")), "neardup-classes")
    classes = rows.select("node", "keys").join(marks.select(F.col("class").alias("node")), "node", "left_semi")
    keys = written(_keys(classes, method), "neardup-keys", "zstd")
    buckets = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lead"))
                      .where("n > 1"), "neardup-buckets")
    members = written(keys.join(buckets, "key"), "neardup-members", "zstd")

    stars = written(members.where("node != lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))
                    .distinct(), "neardup-stars")
    links = written(_confirmed(written(_pruned(stars, rows, method), "neardup-likely"),
                               numbered, method), "neardup-links")
    roots = written(connected(links), "neardup-roots")
    # A bucket of two held no other pair than its star; one with a single root is done.
    rooted = written(members.where("n > 2").join(roots, "node", "left").select(
        "key", "node", "n", F.coalesce("root", "node").alias("root")), "neardup-rooted", "zstd")
    open_keys = written(rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
                        .where("x != y").select("key"), "neardup-open")
    tiled = written(rooted.join(open_keys, "key"), "neardup-tiled", "zstd")
    tile_rows = tiled.agg(F.coalesce(F.sum(F.ceil(F.col("n") / method.tile)), F.lit(0))).first()[0]
    open_nodes = tiled.select("node").distinct()
    sets = written(_sets(_asked(numbered.select("node", "text"), tiled, "node").join(open_nodes, "node", "left_semi"), method),
                   "neardup-sets", "zstd")
    more = _tile_links(tiled, rows, sets, method, 1 + tile_rows // (2 * method.tile))
    links = links.union(written(more.distinct(), "neardup-more"))
    roots = written(connected(links), "neardup-final")

    # Every class hangs on its root, every row on its class.
    named = marks.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").select(
        "n_shingles", "mark", F.coalesce("root", "class").alias("root"))
    placed = written(rows.select("node", "doc_id", "n_shingles", "mark").join(
        named, ["n_shingles", "mark"], "left").select(
        "node", "doc_id", "n_shingles", F.coalesce("root", "node").alias("root")), "neardup-placed")
    smallest = written(placed.groupBy("root").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))["node"].alias("_first")), "neardup-smallest")
    return placed.join(smallest, "root").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("node") == F.col("_first")).alias("first_row"), "node")
