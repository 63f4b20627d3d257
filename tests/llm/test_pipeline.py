"""The corpus pipeline, stage by stage, against plain versions on a small table."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from talusflow.llm import packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(seed, n):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, 500, n))


def texts():
    rows = []
    for i in range(360):
        text = words(i, 30 + i % 40)
        if i % 4 == 0:
            text += " awful dreadful vile " + words(1000 + i, 5)
        rows.append((i, text, f"s{i % 3}"))
    rows += [(400, None, "s0"), (401, "", "s1"), (402, " \n\t", None), (403, words(1, 31), "s2"),
             (404, words(1, 31) + " more", "s2"), (None, words(7, 37), "s0"), (405, f"{words(5000, 40)} mail bob@example.org or 10.1.2.3 now", None),
             (406, words(9, 3000), "s1")]
    return [*rows, rows[2], rows[2]]  # repeated rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(i, t, "en", s, None if t is None else len(t), 0.5, "x") for i, t, s in texts()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, toxicity double, "
                                "node string").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(360)] + [(None, None, 1), (403, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows that go into the first stage, and what each stage gives."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [[tuple(r[c] for c in COLUMNS) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name))
        stage(spark, docs, folder).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        assert name == "packing" or docs.columns == COLUMNS
        out.append([tuple(r) for r in docs.collect()] if name != "packing" else docs.collect())
    return out


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_toxic_documents_go(stages):
    kept = stages[1]
    ids = [r[0] for r in kept]
    clean = [r[0] for r in stages[0] if "awful" not in (r[1] or "")]
    assert {400, 401, 402, None, 405}.issubset(ids) and ids.count(2) == 3
    assert sum("awful" in (r[1] or "") for r in kept) <= 5
    assert len(set(clean) - set(ids)) <= 0.05 * len(clean)
    assert set(map(str, kept)) <= set(map(str, stages[0]))


def test_one_document_of_each_group_stays(stages):
    before, kept = stages[1], stages[2]
    sets = [shingles(r[1]) for r in before]
    root = list(range(len(before)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    want = []
    for r in set(root):
        group = [before[i] for i in range(len(before)) if root[i] == r]
        want.append(min(group, key=lambda d: (d[0] is None, d[0] or 0)))
    assert sorted(map(str, kept)) == sorted(map(str, want)) and len(want) < len(before)


def test_personal_data_is_masked_and_nothing_else(stages):
    before, after = {str(r[0]): r for r in stages[2]}, {str(r[0]): r for r in stages[3]}
    assert before.keys() == after.keys() and "bob@example.org" in before["405"][1]
    for key, row in before.items():
        want = row[1] and re.sub(r"10\.1\.2\.3", "[ip]", row[1].replace("bob@example.org", "[email]"))
        assert after[key][1] == want and after[key][2:4] == row[2:4]
        assert after[key][4] == (row[4] if want == row[1] else len(want))


def test_the_mix_meets_its_targets(stages):
    before, after = stages[3], stages[4]
    size = lambda r: len((r[1] or "").split())
    have = {}
    for r in before:
        have[r[3]] = have.get(r[3], 0) + size(r)
    weight = dict(zip(sorted(have, key=lambda s: (s is None, s or "")), [5, 2, 1, 5]))
    total, target, open_ = 1.5 * sum(have.values()), {}, set(have)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * have[s]}
        if not full:
            break
        target |= {s: 2 * have[s] for s in full}
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    taken, copies = dict.fromkeys(have, 0), {}
    for r in after:
        taken[r[3]] += size(r)
        copies[str(r)] = copies.get(str(r), 0) + 1
    for s in have:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 30)
    assert max(copies.values()) <= 2 and set(copies) <= set(map(str, before))


def test_packed_ids_are_those_of_the_texts(stages):
    from tokenizers import Tokenizer

    read = Tokenizer.from_file(packing.TOKENIZER)
    want = {}
    for r in stages[4]:
        ids = np.array(read.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(str(r[0]), []).append(ids)
    pieces = stages[5]
    assert sum(p.length for p in pieces) == sum(len(x) for many in want.values() for x in many)
    for p in pieces:
        assert any(zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for x in want[str(p.doc_id)])


def test_empty_documents_pass_through_all_stages(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none.select(*COLUMNS) if name != "toxicity" else none, folder)
        assert out.count() == 0 and (name == "packing" or out.columns == COLUMNS)


def test_run_equals_its_stages_and_leaves_one_folder(spark, folder, stages, tmp_path, monkeypatch):
    from talusflow import session

    monkeypatch.setattr(session, "shared_root", lambda _: str(tmp_path / "shared"))
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sum(r.length for r in rows) == sum(r.length for r in stages[5])
    assert [p.name.split("-")[:2] for p in (tmp_path / "shared").iterdir()] == [["pipeline", "packing"]]
