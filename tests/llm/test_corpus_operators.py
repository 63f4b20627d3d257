"""The corpus operators on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from talusflow.llm import (
    language_model,
    mixing,
    near_duplicates,
    packing,
    personal_data,
    topk_search,
    toxicity,
    url_rules,
    vector_duplicates,
    warc,
)

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


def sentence(seed, n):
    draw = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j % 7}" for j, i in enumerate(draw.integers(0, len(WORDS), n)))


TEXTS = [
    (1, sentence(1, 60), "a"), (2, sentence(1, 60), "a"), (3, sentence(1, 59) + " other", "b"),
    (4, None, "b"), (5, "", None), (6, " \t\n", None), (7, "One two", "a"), (7, "One two", "a"),
    (None, sentence(2, 30), None), (8, sentence(3, 9000), "c"), (9, "mail me at x.y@example.org or +1 (555) 010-2345", "c"),
    (10, "4111 1111 1111 1111 and 10.0.0.256 and 10.0.0.1", "c"), (11, "é" * 50 + " ünï code", "b"),
]
DOCS = "doc_id long, text string, source string, lang string, n_chars long, score double, node long, key string, hit int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, s, None, None if t is None else len(t), 1.0, 5, "k", 1) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i == 9)) for i in range(1, 12)] + [(None, None, None)],
                                 "doc_id long, quality int, toxic int")


def words_of(text):
    return (text or "").encode().lower().split()


def test_packing_covers_every_id_once(docs):
    from tokenizers import Tokenizer

    read = Tokenizer.from_file(packing.TOKENIZER)
    rows = packing.pack_documents(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    for doc_id, text in {i: t for i, t, _ in TEXTS if i is not None}.items():
        ids = np.array(read.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_ids_by_words_equal_ids_of_whole_texts():
    from tokenizers import Tokenizer
    texts = ["Ab,c 's it's I'M x<|endoftext|>", "İstanbul ΑΣ. ς ﬁ x² ª", "éa É. ß.ÀÉ!? ÿ] àb Å.\u030a $$\u0300", "", None,
             "  \n\t x\u00a0y ok\u200b. 12ab3 ### -a-b- ÐÞ×÷", "a^ `b` c\u0301 D_e"]
    whole = Tokenizer.from_file(packing.TOKENIZER)
    reader = packing.TextIds(packing.TOKENIZER, packing.END_ID)
    for _ in range(2):
        for text, ids in zip(texts, reader.of(texts)):
            expected = whole.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
            assert np.frombuffer(ids, "<u4").tolist() == expected


def test_squares_packer_picks_the_least_sum_of_squares():
    packer, draw = packing.SquaresPacker(12), np.random.default_rng(3)
    for size in draw.integers(1, 12, 400):
        def squares(level):
            counts = packer.counts.copy()
            counts[level] -= level > 0
            counts[level + size] += level + size < 12
            return int((counts[1:12] ** 2).sum())
        options = [0] + [h for h in range(1, 12 - size + 1) if packer.counts[h]]
        assert squares(packer.level_for(int(size))) == min(map(squares, options))
        list(packer.add(object(), int(size)))


def test_near_duplicates_equal_brute_force(docs):
    rows = near_duplicates.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    sets = []
    for _, t, _ in TEXTS:
        w = words_of(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(TEXTS)))
    for _ in TEXTS:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    root[i] = root[j] = min(root[i], root[j])
    low = lambda r: min((TEXTS[i][0] for i in range(len(TEXTS)) if root[i] == r and TEXTS[i][0] is not None), default=None)
    want = sorted(str((TEXTS[i][0], len(sets[i]), low(root[i]))) for i in range(len(TEXTS)))
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in rows) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert near_duplicates.distinct_documents(docs).columns == docs.columns


def dropped(method, similarity):
    """Probability that the looks drop a pair whose signature bytes agree as `similarity` says."""
    t = similarity + (1 - similarity) / 256
    alive, lost = np.array([1.0]), 0.0
    for n, least in method.least_matches():
        for _ in range(n - (len(alive) - 1)):
            alive = np.r_[alive * (1 - t), 0] + np.r_[0, alive * t]
        lost += alive[:least].sum()
        alive[:least] = 0
    return lost


def test_near_duplicate_looks_drop_few_pairs_in_all():
    method = near_duplicates.Method()
    assert dropped(method, 0.75) <= 1e-6 and dropped(method, 0.76) <= 5e-7
    assert dropped(near_duplicates.Method(miss=1e-3), 0.75) <= 1e-3


def test_near_duplicates_just_above_the_threshold(spark):
    # Copies of one text with one to six words changed: most pairs lie near the threshold.
    base, draw = sentence(5, 160).split(), np.random.default_rng(6)
    texts = []
    for i in range(300):
        words = list(base)
        for at in draw.choice(160, 1 + i % 6, replace=False):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    root, close = list(range(300)), 0
    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            union = len(x) + len(sets[j]) - shared
            close += 75 * union <= 100 * shared < 80 * union
            if 100 * shared >= 75 * union:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert close > 500 and len(set(root)) > 1
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_duplicates.near_duplicates(rows, method=near_duplicates.Method(tile=32)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))


def _shuffled_rows(plan):
    """Rows that the exchanges of a plan have written."""
    n = plan.metrics().get("shuffleRecordsWritten")
    below = plan.children()
    return (n.get().value() if n.isDefined() else 0) + sum(_shuffled_rows(below.apply(i)) for i in range(below.size()))


def test_only_texts_of_pairs_are_shuffled(spark):
    method = near_duplicates.Method()
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    texts = spark.createDataFrame([(i, text(i // 2 if i < 4 else i)) for i in range(600)], "node long, text string")
    rows = near_duplicates._signatures(texts.selectExpr("node", "node AS doc_id", "text"), method)
    pairs = spark.createDataFrame([(1, 0), (3, 2), (9, 8)], "a long, b long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(kept, ("false", "-1")):
            spark.conf.set(k, v)
        for found in (near_duplicates._pruned(pairs, rows, method), near_duplicates._confirmed(pairs, texts, method)):
            assert sorted(map(tuple, found.collect())) == [(1, 0), (3, 2)]
            assert _shuffled_rows(found._jdf.queryExecution().executedPlan()) < 60
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_personal_data_equals_plain_patterns(docs):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    found = personal_data.find_personal_data(docs).select("doc_id", personal_data.spans_text(
        personal_data.F.col("base")).alias("s")).collect()
    want = []
    for i, text, _ in TEXTS:
        spans = []
        for rank, (kind, pattern) in enumerate(patterns.items()):
            for m in re.finditer(pattern, text or ""):
                d = re.sub("[^0-9]", "", m[0])
                if {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".") if kind == "ip"),
                        "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                    spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        want.append((str(i), ",".join(x[2] for x in sorted(spans))))
    assert sorted((str(r.doc_id), r.s) for r in found) == sorted(want)
    assert sum(bool(s) for _, s in want) == 2


def test_learnt_context_finds_an_unknown_identifier(spark):
    known = [(i, f"the customer card number: {n} was used") for i, n in enumerate(
        ["4111111111111111", "5500005555555559", "4012888888881881", "5105105105105100", "4222222222222220", "378282246310005"])]
    rows = spark.createDataFrame([*known, (99, "a customer card number: 1234567812345678 was used")], "doc_id long, text string")
    spans = {r.doc_id: [s.rank for s in r["all"]] for r in personal_data.find_personal_data(rows, min_hits=4).collect()}
    assert spans[99] == [personal_data.KINDS.index("id")] and spans[0] == [personal_data.KINDS.index("card")]


def test_contexts_of_addresses_find_names_without_digits(spark):
    texts = [f" \tWrite {'so ' * (i % 3)}to user contact: <{n}@example.org> now" for i, n in enumerate("amy bob cat dan eve fay gil hal ida jim kim lee".split())]
    texts += ["é user contact: (zoe_at_example), please", "zoe_at_example met owner login: zoe_at_example", None, "contact: nobody"]
    # The found names teach a context that no base span stands in.
    names = "una_at_x vic_at_x wim_at_x xan_at_x yan_at_x".split()
    texts += [f"user contact: {n}" for n in names] + [f"owner login: {n}" for n in names] + ["owner login: late_at_x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [r.text[s.start:s.end] for s in r["all"] if s.rank == personal_data.KINDS.index("id")]
             for r in personal_data.find_personal_data(rows, keep=("text",), min_hits=3, min_share=0.5).collect()}
    assert found[12] == ["zoe_at_example"] and found[0] == [] and found[15] == []
    assert found[16] == ["una_at_x"] and found[len(texts) - 1] == ["late_at_x"]
    assert found[13] == ["zoe_at_example"]


def test_mixing_meets_its_targets(docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    assert abs(sum({r.target for r in rows}) - 1.5 * sum(r["size"] for r in rows)) < 1e-6 or len({r.target for r in rows}) < 4
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mixing_goes_on_after_a_document_too_long(spark):
    # One document holds a third of its source; the targets are 0.3 of the sizes.
    draw, rows = np.random.default_rng(8), []
    for s in range(24):
        sizes = draw.integers(20, 60, 150).tolist()
        rows += [(1000 * s + i, "w " * n, f"s{s:02}") for i, n in enumerate([*sizes, sum(sizes) // 2])]
        rows += [(1000 * s + 900, "w " * 50, f"s{s:02}")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got, counted, target = {}, {}, {}
    for r in mixing.mixed_documents(frame, weights=(1,), share=0.3).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    for r in mixing.mix_sources(frame, weights=(1,), share=0.3).collect():
        source = f"s{r.doc_id // 1000:02}"
        target[source], counted[source] = r.target, counted.get(source, 0) + r.taken
    assert len(target) == 24 and all(abs(got[s] / t - 1) < 0.02 for s, t in target.items())
    assert got == counted


@pytest.mark.parametrize("seed", [f"draw{i}" for i in range(3)])
def test_mixing_meets_the_target_beside_a_giant(spark, seed):
    rows = [(i, "w " * (100 + 7 * i % 600), "a") for i in range(1000)] + [(5000, "w " * 400_000, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    done = mixing.mix_sources(frame, share=0.3, seed=seed).collect()
    assert abs(sum(r.taken for r in done) / done[0].target - 1) < 0.01


def test_plans_of_the_mix_stay_small(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * n)) for i, n in enumerate(np.random.default_rng(3).integers(1, 400, 300).tolist())]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "concat('s', doc_id % 3) AS source")
    joins, write = [], mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, *more: (
        joins.append(df._jdf.queryExecution().analyzed().toString().count("Join ")), write(df, *more))[1])
    mixing.mix_sources(frame).collect()
    assert max(joins) <= 5 and sum(joins) <= 3 * len(joins)


def test_language_model_counts_and_normalises(docs):
    rows = language_model.score_language(docs).collect()
    assert len(rows) == len(TEXTS) and all(np.isfinite([r.score, r.base_score]).all() and r.score < 0 for r in rows)
    counts = {}
    for i, t, _ in TEXTS:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            for w in [*words_of(t), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted(round(sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in [*words_of(t), None]), 6) for _, t, _ in TEXTS)
    assert sorted(round(r.base_score, 6) for r in rows) == want
    model = language_model.LogBilinear(np.full(5, 0.2), language_model.Settings())
    every = np.arange(5)
    assert np.isclose(np.exp(model.log_probabilities(np.full(5, 2), np.full(5, 3), every)).sum(), 1, atol=1e-5)


def test_language_model_normalises_a_context_once(monkeypatch):
    settings = language_model.Settings(frequent=20, shared=12)
    k = settings.classes
    model = language_model.LogBilinear(np.full(k, 1 / k), settings)
    one, two, target = np.random.default_rng(3).integers(0, k, (3, 5000))
    contexts = len(np.unique(one * k + two))
    work, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **more: (work.append(np.size(x)), exp(x, **more))[1])
    first = model.log_probabilities(one, two, target)
    assert sum(work) == contexts * k
    assert (model.log_probabilities(one[::2], two[::2], target[::2]) == first[::2]).all()
    assert sum(work) == contexts * k  # nothing new
    model.train(one, two, target, np.random.default_rng(4), 0.1)
    got = model.log_probabilities(one, two, target)  # of the new weights
    scores = (model.inputs[0][one] + model.inputs[1][two]).astype(float) @ model.outputs.T + model.bias
    want = scores[np.arange(len(target)), target] - np.log(exp(scores).sum(axis=1))
    assert np.abs(got - want).max() < 1e-5 and np.abs(got - first).max() > 1e-3


def test_toxicity_on_separable_texts(spark):
    rows = [(i, sentence(i, 40) + (" awful dreadful" if i % 3 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame([*rows, (900, None), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(docs, labels).collect()
    assert len(out) == 242 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) > 0.95


def test_toxicity_without_labels(docs, labels):
    assert {r.score for r in toxicity.score_toxicity(docs, labels.where("false")).collect()} == {0.0}


VECTORS = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]),
           (6, [1.0, None, 0.0]), (7, [float("nan"), 1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (8, [1.0, 0.0, 0.0]), (50, [0.9, 0.1, 0.3]),
           (100, [0.0, 2.0])]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in VECTORS], "vec_id long, embedding array<float>, label int, score double")


def test_vector_duplicates(vectors):
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_duplicates.duplicate_vectors(vectors).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 3, 1), (8, 3, 1), (50, 0, 50),
                   (100, 1, 3)]


def test_topk_equals_brute_force(spark, vectors):
    draw = np.random.default_rng(4)
    wide = spark.createDataFrame([(int(i), [float(x) for x in draw.normal(size=8)]) for i in range(400)], "vec_id long, embedding array<double>")
    twice = wide.unionAll(wide.where("vec_id % 100 = 0"))
    for frame in (vectors, wide, twice):
        rows = [(r.vec_id, np.floor(256 * np.pad(np.array(r.embedding, float), (0, 8 - len(r.embedding))))) for r in frame.collect()
                if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
        want = []
        for q, x in {q: x for q, x in rows if q % 50 == 0}.items():
            best = sorted((-int(x @ y), i) for i, y in rows if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
        got = [tuple(r) for r in topk_search.top_inner_products(frame, topk_search.F.col("vec_id") % 50 == 0).collect()]
        assert sorted(got) == sorted(want)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(3, "http://a.net/x", "p" * 120), (1, "https://b.example.net/en/1", "p" * 120), (2, "http://c.org/fr/2?q=1#f", "short"),
            (4, "no scheme", None), (5, None, ""), (6, "HTTP://D.Example.COM/de/é\r\nx", "short"), (None, "http://e.net", "p" * 120)]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")


def test_archives_round_trip(pages):
    got = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1), 2: ("response", None), 4: ("response", None),
        5: ("response", None), 6: ("response", None)}
    assert got[3].digest == hashlib.sha256(b"p" * 120).hexdigest() and got[3].payload_bytes == 120
    assert bytes(got[2].payload) == b"short"


def test_url_rules(pages, labels):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.filter_urls(pages, labels, min_rows=1).collect()}
    assert got[1] == ("b.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("c.org", "/fr/2", "org/fr/", "allow") and got[3] == ("a.net", "/x", "net/", "block")
    assert got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None) and got[6][2:] == ("example.com/de/", "block")
    assert got[None][:3] == ("e.net", "", None)


def test_mined_rules_follow_the_labels(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.example.io/p/{i}", "") for i in range(80)],
                                  "page_id long, url string, html string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(0, 80, 1) if i % 5], "doc_id long, quality int, toxic int")
    got = url_rules.filter_urls(pages, labels, min_rows=5).collect()
    assert all((r.verdict == "block") == (r.page_id % 2 == 1) for r in got)


def test_empty_tables(spark, docs, labels, vectors, pages):
    none = docs.where("false")
    for out in (packing.pack_documents(none), near_duplicates.near_duplicates(none), personal_data.find_personal_data(none),
                mixing.mix_sources(none), language_model.score_language(none), toxicity.score_toxicity(none, labels),
                vector_duplicates.duplicate_vectors(vectors.where("false")),
                topk_search.top_inner_products(vectors.where("false"), topk_search.F.col("vec_id") % 50 == 0),
                warc.archive_round_trip(pages.where("false")), url_rules.filter_urls(pages.where("false"), labels.where("false"))):
        assert out.count() == 0


def test_pipeline_stages_keep_their_contract(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    assert corpus_pipeline.drop_near_duplicates(spark, rows, sf_dir).columns == rows.columns
    clean = corpus_pipeline.mask_personal_data(spark, rows, sf_dir)
    assert clean.count() == rows.count() and not clean.where("text rlike '@[A-Za-z0-9-]+[.]'").count()
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
