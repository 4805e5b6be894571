"""Operators 4, 7, 8 and 9 against plain versions: nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns."""
import itertools
import random

import numpy as np
import pytest

import brute
from loanlab.llm import decontam, jaccard, langid, substr
from loanlab.llm.queries import QUERIES


def copies(seed=1):
    """Documents with exact and near copies, shared passages, short and empty texts."""
    rng = random.Random(seed)
    rows, base = [], brute.prose(1, 160)
    shared = brute.prose(2, 70)
    for i in range(60):
        kind = i % 6
        if kind == 0:
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
        elif kind == 1:
            w = brute.prose(100 + i, 40) + shared[:rng.choice([48, 50, 55, 70])] + brute.prose(200 + i, 30)
        elif kind == 2:
            w = brute.prose(3, rng.choice([4, 5, 6, 50, 51]))
        elif kind == 3:
            w = brute.prose(300 + i, rng.choice([3, 80, 2000]))
        elif kind == 4:
            w = brute.prose(4, 120)
        else:
            w = ["the", "same"] * 60 + brute.prose(5, rng.choice([1, 2, 30]))
        rows.append((1000 - i if i % 7 else i, rng.choice([" ", "\n", " \t "]).join(w)))
    return rows + [(2000, None), (2001, ""), (2002, " \n "), (2003, "One"), (2004, "one"), (2005, "A b C d"), (2006, "a B c d")]


@pytest.fixture(scope="module")
def rows():
    return copies()


def test_jaccard_equals_all_pairs(docs, rows):
    got = sorted(map(tuple, jaccard.jaccard_components(docs(rows)).collect()))
    assert got == brute.jaccard_components(rows)


def test_jaccard_repeated_rows_null_ids_and_empty(docs, rows):
    some = rows[:12]
    got = sorted(map(tuple, jaccard.jaccard_components(docs(some + some + [(None, some[0][1])])).collect()), key=str)
    want = sorted([*brute.jaccard_components(some) * 2], key=str)
    assert [r for r in got if r[0] is not None] == want
    assert [r[2] for r in got if r[0] is None] == [None]
    assert jaccard.jaccard_components(docs(rows).limit(0)).count() == 0


def test_one_id_with_two_texts_is_one_node(docs):
    a, b = " ".join(brute.prose(8, 60)), " ".join(brute.prose(9, 60))
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs([(1, a), (5, a), (5, b), (9, b)])).collect()}
    assert got == {1: 1, 5: 1, 9: 1}


def test_substring_equals_brute_force(spark, sf, docs, rows):
    got = sorted(map(tuple, QUERIES["op8_substring_dedup"](spark, sf(documents=docs(rows))).collect()))
    assert got == brute.substring(rows)


def test_substring_odd_rows(docs):
    t = " ".join(brute.prose(11, 60))
    u = " ".join(brute.prose(11, 55) + ["z"] * 60)  # repeats inside one document stay
    got = sorted(((r.doc_id, r.n_removed, r.kept) for r in substr.substring_dedup(docs([(3, t), (3, u), (4, t), (4, t), (None, t), (5, " ".join(["z"] * 70))])).collect()), key=str)
    by = {}
    for i, n, kept in got:
        by.setdefault(i, []).append((n, kept))
    assert sorted(n for n, _ in by[3]) == [0, 0]  # rows of one id do not remove each other's
    assert [n for n, _ in by[4]] == [60, 60] and [n for n, _ in by[None]] == [0]
    assert by[5][0][0] == 70  # its windows start in document 3, too
    assert substr.substring_dedup(docs([(1, t)]).limit(0)).count() == 0
    part = " ".join(brute.prose(12, 20) + t.split() + brute.prose(13, 20))  # a repeated row that loses a passage
    again = substr.substring_dedup(docs([(1, t), (2, part), (2, part), (2, u)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in again) == [(1, 0), (2, 55), (2, 60), (2, 60)]


def test_language_code_lengths_equal_ppm(spark, docs, monkeypatch):
    rng = random.Random(3)
    train = {"aa": [" ".join(brute.prose(i, 60)) for i in range(5)], "bb": ["".join(rng.choice("xyzéß ") for _ in range(200)) for _ in range(5)]}
    rows = [(i * 2 + j, t, lang) for j, (lang, ts) in enumerate(train.items()) for i, t in enumerate(ts)]
    model = langid.train(docs(rows), sample=1 << 40)
    import pickle
    m = pickle.loads(model)
    texts = ["", "ta", "tarino", "xyé ß tano unseen QQ 12", " ".join(brute.prose(77, 30)), "ééé"]
    got = langid.code_lengths(m, [t.encode() for t in texts])
    monkeypatch.setattr(langid, "POSITIONS", 7)   # pieces of a text and groups of texts give the same
    assert np.allclose(langid.code_lengths(m, [t.encode() for t in texts]), got)
    for j, lang in enumerate(m["langs"]):
        counts = brute.ppm_counts([t.lower().encode() for t in train[lang]], langid.ORDER)
        for i, t in enumerate(texts):
            assert got[i, j] == pytest.approx(brute.ppm_bits(counts, langid.ORDER, t.encode()), abs=0.01)


def test_language_rows(spark, sf, docs):
    rows = [(i, " ".join(brute.prose(i, 30)) if i % 2 else "ççé ùù àà " * 9, "aa" if i % 2 else "bb") for i in range(60)]
    rows += [(100, None, "aa"), (101, "", None), (102, "12 !?", "bb"), (None, "ççé ùù", "bb"), (103, "ççé ùù àà", None), (103, "ççé ùù àà", None)]
    out = QUERIES["op4_language_id"](spark, sf(documents=docs(rows))).collect()
    assert len(out) == len(rows)
    import zlib
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.doc_id in (100, 101, 102):
            assert r.lang_pred == "und"
        elif r.doc_id is None or r.doc_id == 103 or r.doc_id < 60:
            assert r.lang_pred == ("aa" if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 2 else "bb")
    empty = docs([(1, "a", None)])
    assert [r.lang_pred for r in QUERIES["op4_language_id"](spark, sf(documents=empty)).collect()] == ["und"]


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.fit_and_predict(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97


def test_decontamination(spark, docs):
    item = brute.prose(21, 30)
    rng = random.Random(2)
    def planted(changes, cut=30):
        w = list(item[:cut])
        for k in rng.sample(range(cut), changes):
            w[k] = "changed"
        return " ".join(brute.prose(rng.randrange(10**6), 40) + w + brute.prose(rng.randrange(10**6), 40))
    rows = [(1, planted(0)), (2, planted(3).upper()), (3, " ".join(brute.prose(99, 200))), (4, planted(0, 16)), (5, None), (6, ""), (None, planted(0)),
            (7, planted(0)), (7, planted(0)), (8, " ".join(item[:7] + brute.prose(5, 30))), (9, "x " * 3000 + planted(2))]
    items = spark.createDataFrame([(50, " ".join(item), "x"), (51, None, "x"), (52, "", "x"), (None, " ".join(item), "x"), (53, " ".join(item), "x"), (54, "short item", "x")], "item_id long, text string, doc_id string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), items).collect())
    assert got == [(d, i) for d in (1, 2, 4, 7, 9) for i in (50, 53)]
    assert decontam.contaminated(docs(rows), items.limit(0)).count() == 0
    assert decontam.contaminated(docs(rows).limit(0), items).count() == 0


def test_decontamination_no_accepted_pattern_is_missed(spark, docs):
    """Every placement of the changed words that the rule accepts has the hits that it asks for."""
    least = decontam.least_hits()
    for n in range(8, 17):
        for equal in itertools.product((0, 1), repeat=n):
            run = any(sum(equal[i:i + 13]) >= 11 for i in range(n - 12))
            if run or sum(equal) >= 8 and 5 * sum(equal) >= 3 * n:
                hits = sum(all(equal[i + o] for o in m) for m in decontam.MASKS for i in range(n - m[-1]))
                assert hits >= least[n - 1] > 0
    assert min(least) == 1
    item, other = [f"w{i}" for i in range(15)], [f"v{i}" for i in range(12)]
    rows = [(i, "before " + " ".join("changed" if k in gone else w for k, w in enumerate(words)) + " after")
            for i, (words, gone) in enumerate([(item, g) for g in itertools.combinations(range(15), 6)] + [(other, g) for g in itertools.combinations(range(12), 3)])]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other))], "item_id long, text string")
    got = decontam.contaminated(docs(rows), items).groupBy("item_id").count().collect()
    assert {r.item_id: r["count"] for r in got} == {1: 5005, 2: 220}


def test_decontamination_short_items_and_unspaced_scripts(spark, docs):
    chinese = "机器学习模型的训练数据需要仔细清理才能使用"
    rows = [(1, "so What Is, the capital here"), (2, "what is a capital"), (3, "a b"), (4, "one"), (5, "abone b"), (6, "前言" + chinese + "。后记"),
            (7, "前言" + chinese.replace("模型", "网络").replace("清理", "筛选") + "后记"), (8, "完全不同的一段中文文字没有任何关系"), (9, "b a"), (10, "the capital")]
    items = spark.createDataFrame([(1, "What is the capital"), (2, "a b"), (3, "One"), (4, chinese), (5, "capital here")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs(rows), items).collect())
    assert got == [(1, 1), (1, 5), (3, 2), (4, 3), (6, 4), (7, 4)]
