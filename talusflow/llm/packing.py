"""Pack token ids of documents into windows of fixed length by sum-of-squares placement."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
_CACHE_WORDS = 800_000  # words, and as many of their parts, kept between texts; a full cache is emptied
# Letters that lower one by one and never compose, then signs; the tokenizer cuts between the two.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
_LETTERS_SIGNS = re.compile(rf"([{_LETTERS}{_LETTERS.lower()}ßÿ]+)([!-&(-/:-@\[-`{{-~]*)")


class TextIds:
    """Token ids of texts, through a cache of the ids of the words between spaces.

    The tokenizer lowers letters, drops white space, never joins characters across it and cuts
    between letters and signs, so the ids of a text are those of its words in order, and the ids of
    a word of letters and signs are those of its two parts.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        # How the tokenizer writes the bytes of a letter.
        self.spelled = str.maketrans({x: self.tokenizer.pre_tokenizer.pre_tokenize_str(x)[0][0]
                                      for x in _LETTERS.lower() + "ßÿ"})

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        for first in range(0, len(words), 10_000):
            part = words[first:first + 10_000]
            for code in self.tokenizer.encode_batch_fast(part, add_special_tokens=False):
                yield array("I", code.ids).tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        if len(self.parts) > _CACHE_WORDS:
            self.parts = {"": b""}
        known, parts = self.known, self.parts
        merged = self.tokenizer.model.tokenize
        cut, whole = [], []
        for word in words:
            match = _LETTERS_SIGNS.fullmatch(word)
            if match is None:
                whole.append(word)
                continue
            letters = match[1].lower()
            if letters not in parts:
                spelled = letters if letters.isascii() else letters.translate(self.spelled)
                parts[letters] = array("I", [t.id for t in merged(spelled)]).tobytes()
            cut.append((word, letters, match[2]))
        signs = list({sign for _, _, sign in cut}.difference(parts))
        parts.update(zip(signs, self._encoded(signs)))
        known.update(zip(whole, self._encoded(whole)))
        for word, letters, sign in cut:
            known[word] = parts[letters] + parts[sign]

    def of(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end id."""
        words = [(t or "").replace("\n", " ").split(" ") for t in texts]
        codes = [list(map(self.known.get, text)) for text in words]
        gaps = [[i for i, code in enumerate(of) if code is None] if None in of else () for of in codes]
        new = {text[i] for text, open_ in zip(words, gaps) for i in open_}
        if new:
            self._learn(new)
            for text, of, open_ in zip(words, codes, gaps):
                for i in open_:
                    of[i] = self.known[text[i]]
        return [b"".join(of) + self.end for of in codes]


class SquaresPacker:
    """Open windows by fill level; each item goes where the squared level counts grow least."""

    def __init__(self, capacity: int, max_open: int = 4096):
        self.capacity, self.max_open = capacity, max_open
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The fill level (0: a new window) that takes the item at the least sum of squares."""
        levels = np.flatnonzero(self.counts[1:self.capacity - size + 1]) + 1
        change = 2 * (self.counts[levels + size] - self.counts[levels]) + 2
        change[levels + size == self.capacity] = (1 - 2 * self.counts[levels])[levels + size == self.capacity]
        fresh = 2 * self.counts[size] + 1
        if len(levels) == 0 or fresh < change.min():
            return 0
        return int(levels[len(levels) - 1 - np.argmin(change[::-1])])  # of equals the fullest

    def add(self, item: object, size: int) -> Iterator[list]:
        """Place an item below the capacity; yields the window if it is full now."""
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        window.append(item)
        if level:
            self.counts[level] -= 1
        else:
            self.n_open += 1
        if level + size == self.capacity:
            self.n_open -= 1
            yield window
            return
        self.counts[level + size] += 1
        self.open.setdefault(level + size, []).append(window)

    def drain(self) -> list[list]:
        """All open windows, the fullest first."""
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.counts[:] = 0
        self.open, self.n_open = {}, 0
        return windows


def pack(documents: Iterable[tuple[object, bytes]], capacity: int = 4096, max_open: int = 4096
         ) -> Iterator[list[tuple[object, int, int, bytes]]]:
    """Windows of pieces (document, total tokens, start, ids) from documents as 32-bit ids.

    Documents above the capacity are cut into full windows and a rest. When the input ends, or
    `max_open` windows are open, the open ones are refilled one after the other by cutting pieces,
    so at most one window of the whole input is not full.
    """
    packer = SquaresPacker(capacity, max_open)

    def refilled(last: bool) -> Iterator[list]:
        window, room = [], capacity
        for doc, total, start, ids in (p for w in packer.drain() for p in w):
            while ids:
                part, ids = ids[:4 * room], ids[4 * room:]
                window.append((doc, total, start, part))
                start += len(part) // 4
                room -= len(part) // 4
                if room == 0:
                    yield window
                    window, room = [], capacity
        if window and last:
            yield window
        elif window:  # goes on as an open window
            packer.open[capacity - room] = [window]
            packer.counts[capacity - room] = packer.n_open = 1

    for doc, ids in documents:
        total = len(ids) // 4
        full = total // capacity * capacity
        for start in range(0, full, capacity):
            yield [(doc, total, start, ids[4 * start:4 * (start + capacity)])]
        if full < total:
            yield from packer.add((doc, total, full, ids[4 * full:]), total - full)
            if packer.n_open > packer.max_open:
                yield from refilled(last=False)
    yield from refilled(last=True)


_readers: dict[tuple[str, int], TextIds] = {}


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 4096, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of packed documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each task packs the texts of its partition as they come, without a shuffle; at most one window
    of a task is not full. Null and empty texts consist of the end id. Repeated rows and null ids
    are documents of their own. An empty table gives no pieces. `with_ids` adds the ids themselves.
    """
    fields = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)] + [T.StructField(f, T.LongType()) for f in fields])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _readers.get((tokenizer, end_id))
        if reader is None:
            reader = _readers[tokenizer, end_id] = TextIds(tokenizer, end_id)
        out: pa.Schema | None = None

        def documents():
            nonlocal out
            for batch in batches:
                out = batch.schema
                for first in range(0, batch.num_rows, 256):
                    part = batch.slice(first, 256)
                    yield from zip(part.column(0).to_pylist(), reader.of(part.column(1).to_pylist()))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(
                zip(*[r[:7] for r in rows]), [out.field(0).type] + [pa.int64()] * 6)]
            names = ["doc_id", *fields]
            if with_ids:
                columns.append(pa.array([np.frombuffer(r[7], dtype="<u4").astype(np.int32) for r in rows],
                                        pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)

        rows: list[tuple] = []
        base = TaskContext.get().partitionId() << 36
        for number, window in enumerate(pack(documents(), capacity)):
            offset = 0
            for doc, total, start, ids in window:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), total, base + number, offset)
                            + ((ids,) if with_ids else ()))
                offset += n
            if len(rows) >= (500 if with_ids else 10_000):
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
