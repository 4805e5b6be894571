"""Operator 1 against the tokenizers library (exact ids and decoded text)."""
import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from loanlab.llm import bpe
from loanlab.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def both():
    path = tokenizer_path()
    with open(path, "rb") as f:
        return bpe.Transducer(f.read()), Tokenizer.from_file(path)


def test_same_as_library_on_odd_texts(both):
    mine, lib = both
    rng = random.Random(5)
    letters = ["ab", "aeinrst", "!?.", "a!1 ", "éàüß ñ", "Σσς Iİ", "́e x\x1c 日本語ひ", "'s't'rell ", "\t\n\x85  x٣²Ⅷ"]
    for _ in range(400):
        s = "".join(rng.choice(rng.choice(letters)) for _ in range(rng.choice([0, 3, 40, 900])))
        s += rng.choice(["", "<|endoftext|>", "<|startoftext|>x"])
        ids = np.frombuffer(mine.encode(s), "<u4").tolist()
        assert ids == lib.encode(s, add_special_tokens=False).ids, s
        d = bpe.Decoder(mine)
        assert b"".join(d.tokens(ids[i:i + 5]) for i in range(0, len(ids), 5)).decode() == lib.decode(ids, skip_special_tokens=False)


def test_stream_equals_whole_word_merge(both):
    mine, _ = both
    rng = random.Random(6)
    for _ in range(30):
        w = "".join(rng.choice(rng.choice(["a", "ab", "thein", "aeinrstlo"])) for _ in range(rng.choice([300, 900, 2500])))
        s = [mine.letters[b] for b in w.encode()]
        assert list(mine.stream(iter(s))) == mine.closed(list(s))


def test_text_decoder_round_trip(both):
    mine, _ = both
    ids = np.frombuffer(mine.encode("the naïve 日本 café"), "<u4").tolist()
    d = bpe.Decoder(mine)
    assert "".join(d.text([i]) for i in ids) + d.text([], True) == "the naïve 日本 café "


def test_query_rows(spark, docs, sf, both):
    rows = [(1, "The cat's 42 dogs"), (2, None), (3, ""), (3, ""), (None, "x" * 70_000 + " 's"), (5, "\n \t")]
    out = QUERIES["op1_bpe"](spark, sf(documents=docs(rows))).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    for i, t in rows:
        ids = both[1].encode(t or "", add_special_tokens=False).ids
        assert by[i].n_tokens == len(ids)
        assert by[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256(both[1].decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pieces_give_the_same_ids(both, monkeypatch):
    mine, lib = both
    rng = random.Random(9)
    for size in (1, 3, 17):
        monkeypatch.setattr(bpe, "PIECE", size)
        for _ in range(150):
            s = "".join(rng.choice(["a", "é", "e\u0301", "\u0301", " ", "\u2001", "\x85", "Σ", "ΑΣ ", "<|endoftext|>", "'s", "1", "!", "\n", "日"]) for _ in range(40))
            assert np.frombuffer(mine.encode(s), "<u4").tolist() == lib.encode(s, add_special_tokens=False).ids, s


def test_encode_by_size(spark, docs, both, monkeypatch):
    monkeypatch.setattr(bpe, "OUT_BYTES", 100)
    rows = [(i, "word naïve 日本 " * (i % 7)) for i in range(40)] + [(None, None), (50, "")]
    got = bpe.encode(docs(rows), tokenizer_path()).collect()
    assert len(got) == len(rows)
    for r in got:
        t = dict(rows)[r.doc_id] or ""
        assert r.ids == both[1].encode(t, add_special_tokens=False).ids and r.n_tokens == len(r.ids) and r.decoded == t


def test_empty_table(spark, docs, sf):
    assert QUERIES["op1_bpe"](spark, sf(documents=docs([(1, "a")]).limit(0))).count() == 0
