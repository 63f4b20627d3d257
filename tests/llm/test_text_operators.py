"""Spelling variants, decontamination and lexical search against brute force on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from talusflow.llm import decontamination, lexical_search, queries, spelling
from talusflow.llm.common import text_chunks
from talusflow.llm.words import split_words

ALPHABET = "abcdeéß"


def random_words(seed, n, length=(5, 7), letters=ALPHABET):
    draw = np.random.default_rng(seed)
    return ["".join(letters[i] for i in draw.integers(0, len(letters), draw.integers(length[0], length[1] + 1)))
            for _ in range(n)]


def passage(seed, n, pool=400):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, pool, n))


VOCABULARY = random_words(1, 150, letters="aé")
SHARED = passage(7, 30)
DOCS = [
    (1, " ".join(w for i, w in enumerate(VOCABULARY) for _ in range(3 + i * i % 37))),
    (2, " ".join(VOCABULARY[100:] * 4).replace("a", "A")), (3, None), (4, ""),
    (5, "  .,-!  "), (6, "Ä" * 40 + " ab cd"), (7, f"Before {SHARED.upper()}; after"), (7, f"Before {SHARED.upper()}; after"),
    (None, f"{SHARED} tail"), (8, " ".join([passage(3, 4000), SHARED, passage(4, 4000)])), (9, "the quick-brown fox"),
    (10, "the fox 12.5 the"), (11, "the fox 12.5 the"), (12, "one two three four five six seven eight nine ten eleven"),
    (13, "naïve a×÷éb caféteria caféteria CAFÉTERIA cafeteria " * 3), (14, "one" + "é" * 3 + " fox"),
]
ITEMS = [
    (1, SHARED), (2, "The Fox"), (3, None), (4, ""), (5, passage(3, 4000)[200:500]), (6, SHARED),
    (7, "zero two three four five six seven eight nine ten eleven"), (8, "-- ,"), (9, "nothing of this is anywhere at all"),
    (10, "the the fox"), (10, "quick"), (None, "one two three four five six seven eight nine ten"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s", 1, 2, "k", 0.5, "x") for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, word int, key string, "
                                       "score double, item string").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 1, "r") for i, t in ITEMS],
                                 "item_id long, text string, doc_id int, query string").repartition(2)


@pytest.fixture(scope="module")
def folder(docs, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- Spelling ----------------------------------------------------------------------------

def brute_spelling(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    forms = {}
    for w, n in words.items():
        close = sorted((-m, v) for v, m in words.items() if near(w, v))
        best = close[0] if close and -close[0][0] >= 2 * n else None
        forms[w] = (best and best[1], best and -best[0], len(close))
    out = []
    for w, n in words.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, forms[w][0], root, n, forms[w][2], forms[w][1]))
    return sorted(out)


def spelled(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_spelling_equals_brute_force(spark, docs, folder):
    want = brute_spelling(DOCS)
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] != r[2] for r in want if r[1])
    assert any("é" in r[0] for r in want) and any("×" in r[0] for r in want)
    assert spelled(queries.QUERIES["op11_spelling"](spark, folder)) == want
    # Groups that are divided again and again give the same words.
    assert spelled(spelling.spelling_variants(docs, group_rows=4)) == want


def test_groups_are_divided_and_hold_each_pair_once(spark):
    words = sorted(set(random_words(2, 3000, (5, 8), "ab")))
    frame = spark.createDataFrame([(w, 3 + i % 7) for i, w in enumerate(words)], "word string, n long")
    sizes = {k: spelling.groups(frame, k).groupBy("key").count().agg({"count": "max"}).first()[0] for k in (40, 10**6)}
    assert sizes[40] <= 40 < sizes[10**6]
    deletions = {}
    for w in words:
        for i in range(len(w)):
            deletions.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    pairs = {(a, b) for group in deletions.values() for a in group for b in group if a != b}
    known = set(words)
    for w in words:
        for i in range(len(w)):
            if (shorter := w[:i] + w[i + 1:]) in known:
                pairs |= {(w, shorter), (shorter, w)}
    want = Counter(a for a, _ in pairs)
    for limit in (40, 10**6):
        got = {r.word: r.n_near for r in spelling.near_words(frame, limit).collect()}
        assert got == {w: want[w] for w in words}


def test_long_words_are_compared(spark):
    long = "a" * 3000
    rows = [(1, f"{long} {long}b c{long} " * 3), (2, f"{long} " * 9)]
    got = spelled(spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute_spelling(rows) and len(got) >= 3


# --- Decontamination ---------------------------------------------------------------------

def tokens(text):
    return [w.lower() for w in re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())]


def brute_hits(text, items):
    words, hit, found = tokens(text), set(), set()
    for item, passage_text in items:
        w = tokens(passage_text)
        size = min(10, len(w))
        for o in range(len(w) - size + 1 if w else 0):
            for p in range(len(words) - size + 1):
                if words[p:p + size] == w[o:o + size]:
                    hit.update(range(p, p + size))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


def runs_of(positions):
    out = []
    for p in sorted(positions):
        if out and out[-1][0] + out[-1][1] == p:
            out[-1][1] += 1
        else:
            out.append([p, 1])
    return out


def test_decontamination_equals_brute_force(spark, docs, items, folder):
    want = []
    for i, text in DOCS:
        n, hit, found = brute_hits(text, ITEMS)
        want.append((i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    want = sorted(want, key=str)
    assert sum(r[5] for r in want) >= 8 and any(r[3] >= 3 for r in want)
    got = sorted(map(tuple, queries.QUERIES["op12_decontamination"](spark, folder).collect()), key=str)
    assert got == want
    # A benchmark in many blocks, and documents with clashing columns.
    for block in (700,):
        found = decontamination.find_contamination(docs, items, block_bytes=block)
        rows = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=str)
        assert rows == sorted(((i, *brute_hits(t, ITEMS)) for i, t in DOCS), key=str)
        assert all(sum(s.length for s in r.spans) == r.n_hit and
                   all(a.start + a.length < b.start for a, b in zip(r.spans, r.spans[1:])) for r in found.collect())


def test_affected_documents_go(docs, items):
    clean = decontamination.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted(
        (i for i, t in DOCS if not brute_hits(t, ITEMS)[1]), key=str)


def test_longest_matches_and_their_places(docs, items):
    got = {r.item_id: (r.item_start, r.length, r.doc_id, r.doc_start)
           for r in decontamination.longest_matches(docs, items).collect()}
    for item, text in ITEMS:
        words, best = tokens(text), 0
        for _, other in DOCS:
            theirs = tokens(other)
            table = np.zeros(len(theirs) + 1, int)
            for w in words:
                table[1:] = np.where(np.array([w == t for t in theirs], bool), table[:-1] + 1, 0)
                best = max(best, table.max(initial=0))
        if item == 10:  # two rows
            continue
        if not best:
            assert str(item) not in got
            continue
        start, length, doc, at = got[None if item is None else str(item)]
        assert length == best
        assert any(tokens(t)[at:at + length] == words[start:start + length] for i, t in DOCS if i == doc)


def test_suffix_array_sorts_suffixes():
    for seed in range(5):
        codes = np.random.default_rng(seed).integers(0, 3, 200)
        for depth in (1, 4, 50):
            order = decontamination.suffix_array(codes, depth)
            keys = [tuple(codes[i:i + depth]) for i in order]
            assert sorted(order) == list(range(200)) and keys == sorted(keys)


def test_texts_beyond_a_shard_are_cut_with_overlap(monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 25)
    text = passage(11, 300)
    item = [("a", 0, text.split()[20:60]), ("b", 0, text.split()[240:250])]
    block = decontamination.BenchmarkBlock.of(item, 10)
    found = decontamination._Found(2)
    for first, counts, words, bounds, before in decontamination._shards(pa.array([text, None]), 9):
        found.n_words[first:first + len(counts)] = counts
        if len(words):
            found.add(first, before, decontamination.Shard(words, bounds, block, 10), block)
    n_words, spans, names = found.arrays(block.names)
    want = brute_hits(text, [(n, " ".join(w)) for n, _, w in item])
    assert n_words.to_pylist() == [300, 0] and names.to_pylist() == [want[2], []]
    assert sum(s["length"] for s in spans.to_pylist()[0]) == want[1] and spans.to_pylist()[1] == []


# --- Lexical search ----------------------------------------------------------------------

def brute_search(rows, items, k=20):
    terms = [Counter(tokens(t)) for _, t in rows]
    sizes = [sum(c.values()) for c in terms]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in terms for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(tokens(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for (i, _), c, size in zip(rows, terms, sizes):
            if i is None:
                continue
            m = 100 - 25 + (25 * size * n_docs) // max(1, total)
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in wanted.items() if c[t])
            if score > 0:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found_by(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_search_equals_brute_force(spark, docs, items, folder):
    want = brute_search(DOCS, ITEMS)
    assert len(want) > 10 and any(a[0] == b[0] and a[3] == b[3] for a, b in zip(want, want[1:]))
    assert found_by(queries.QUERIES["op13_lexical_search"](spark, folder)) == want
    index = lexical_search.build_index(docs)
    for block in (300,):
        assert found_by(lexical_search.search(index, items, block_bytes=block)) == want


def test_search_over_shards_and_deep_lists(spark):
    rows = [(i, passage(i, 20 + i % 50, 60)) for i in range(3000)]
    asked = [(q, passage(10_000 + q, 25, 60)) for q in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    index = lexical_search.build_index(frame)
    assert index.count() >= 3  # each shard holds 1,024 documents at most
    got = lexical_search.search(index, spark.createDataFrame(asked, "item_id long, text string"), k=7)
    assert found_by(got) == brute_search(rows, asked, 7)


def test_range_maxima_bound_every_interval():
    texts = [passage(i, 30, 40).encode() for i in range(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    words, bounds = split_words(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    batch = lexical_search._shard_row([pa.array(range(200), pa.int64())], [words], [np.diff(bounds)])
    row = {n: batch.column(i)[0].as_py() for i, n in enumerate(batch.schema.names)}
    block = lexical_search.QueryBlock([passage(999, 15, 40).encode()])
    shard = lexical_search.SearchShard(row, block, np.full(len(block.terms), 700), 200, len(words))
    search = shard.query(*block.of_query[0])
    scores = search.scores(np.arange(200))
    draw = np.random.default_rng(1)
    low = draw.integers(0, 199, 300)
    high = low + 1 + draw.integers(0, 200, 300) % (200 - low)
    bound, split = search.bounds(low, high)
    assert all(b >= scores[x:y].max() for b, x, y in zip(bound, low, high))
    assert ((low <= split) & (split < high))[bound > 0].all()
    one, at = search.bounds(np.arange(200), np.arange(200) + 1)
    assert (one == scores).all()


# --- Words and empty tables --------------------------------------------------------------

def test_words_end_with_their_text():
    column = pa.array(["ab cd", None, "", "ef", "9é-X", "gh ij"])
    found = []
    for first, end, data, offsets in text_chunks(column.cast(pa.binary()), 4):
        words, bounds = split_words(data, offsets)
        found += [[w.decode() for w in words.slice(a, b - a).to_pylist()] for a, b in zip(bounds, bounds[1:])]
    assert found == [["ab", "cd"], [], [], ["ef"], ["9é", "x"], ["gh", "ij"]]


def test_empty_tables(docs, items):
    none, no_items = docs.where("false"), items.where("false")
    assert spelling.spelling_variants(none).count() == 0
    assert decontamination.find_contamination(none, items).count() == 0
    assert decontamination.find_contamination(docs, no_items).where("n_hit = 0").count() == len(DOCS)
    assert decontamination.longest_matches(docs, no_items).count() == 0
    assert lexical_search.ranked_documents(none, items).count() == 0
    assert lexical_search.ranked_documents(docs, no_items).count() == 0
    assert lexical_search.ranked_documents(docs.withColumn("text", docs.text.substr(1, 0)), items).count() == 0


# --- Near-duplicates in one large bucket -------------------------------------------------

def test_a_bucket_of_thousands_of_near_copies(spark):
    """Copies of one passage with none to thirteen words changed: links, components and the rest."""
    from talusflow.llm import near_duplicates

    base, draw = passage(21, 200, 10_000).split(), np.random.default_rng(22)
    texts = []
    for i in range(2500):
        words = list(base)
        for at in draw.choice(200, i % 14, replace=False):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    number = {}
    shared_with_base = [s & sets[0] for s in sets]
    for s in shared_with_base:
        for shingle in s:
            number.setdefault(shingle, len(number))
    # Changed words are unique to a copy, so only shingles of the base are shared.
    matrix = np.zeros((len(texts), len(number)), np.float32)
    for i, s in enumerate(shared_with_base):
        matrix[i, [number[x] for x in s]] = 1
    shared = matrix @ matrix.T
    sizes = np.array([len(s) for s in sets])
    linked = 100 * shared >= 75 * (sizes[:, None] + sizes[None, :] - shared)
    root = np.arange(len(texts))
    while True:
        low = np.where(linked, root[None, :], len(texts)).min(axis=1)
        low = np.minimum(low, root)
        low = low[low]
        if (low == root).all():
            break
        root = low
    assert 10 < len(set(root)) < 1500
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(rows).collect()}
    assert got == dict(enumerate(root.tolist()))
    kept = near_duplicates.distinct_documents(rows).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root.tolist()))


# --- Personal data: planted identifiers and long texts -----------------------------------

def test_planted_identifiers_are_found_by_their_context(spark):
    """Known addresses teach the words around them; made-up user names stand in the same contexts."""
    from talusflow.llm import personal_data

    draw = np.random.default_rng(31)
    filler = lambda: " ".join(f"w{i}" for i in draw.integers(0, 400, 12))
    openers = ["please write to", "my account name is", "reach the owner at", "signed in as user"]
    rows, planted = [], {}
    for i in range(900):
        opener = openers[i % 4]
        if i % 3:
            rows.append((i, f"{filler()} {opener} u{i}@example.org {filler()}"))
        elif i % 6 == 0:
            name = f"secret_{i}_name"
            planted[i] = name
            rows.append((i, f"{filler()} {opener} {name}, {filler()}"))
        else:
            rows.append((i, f"{filler()} {filler()}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # four openers share the known contexts: a quarter of what follows them is unknown at first
    done = personal_data.find_personal_data(frame, keep=("text",), min_share=0.6).collect()
    found = {r.doc_id: [r.text[s.start:s.end] for s in r["all"] if s.rank == personal_data.KINDS.index("id")] for r in done}
    right = sum(planted[i] in found[i] for i in planted)
    extra = sum(len(v) for v in found.values()) - right
    assert right >= 0.9 * len(planted) and extra <= 0.1 * right


def test_a_text_with_thousands_of_spans_ends_soon(spark):
    import time

    from talusflow.llm import personal_data

    text = " ".join(f"é{'x' * 60} mail u{i}@example.org and 10.{i % 250}.2.3 now" for i in range(5000))
    frame = spark.createDataFrame([(1, text), (2, "call u7@example.org")], "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: r for r in personal_data.find_personal_data(frame, keep=("text",)).withColumn(
        "clean", personal_data.masked(personal_data.F.col("text"), personal_data.F.col("all"))).collect()}
    assert time.time() - began < 120
    spans = [(m.start(), m.end()) for m in re.finditer(r"u\d+@example\.org|10\.\d+\.2\.3", text)]
    assert [(s.start, s.end) for s in rows[1].base] == spans and len(spans) == 10_000
    assert rows[1].clean.count("[email]") == 5000 and "@" not in rows[1].clean
    assert rows[1].clean.startswith("é" + "x" * 60 + " mail [email] and [ip] now")
