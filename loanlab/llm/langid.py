"""Operator 4: language identification by prediction by partial matching.

Each language has a byte context tree of orders 0..ORDER with frozen counts.  The code length of
a byte is that of PPM with escape method C: in the longest context seen in training, a seen byte
costs -log2(count / (n + d)) and an unseen one the escape -log2(d / (n + d)) plus its cost one order
down (n occurrences and d distinct bytes of the context); below order 0 all 256 bytes are equal.
A text goes to the language that codes it in the fewest bits.

Because the statistics are frozen, the whole cost of every byte that has been seen after
its context in any language is computed once, when the model is made, and a text is scored by
table lookups over all its positions at once, highest order first; only positions without an
entry go down one order and add the escapes.

Training reads a sample bounded by ``SAMPLE`` rows a language (drawn by hash of doc_id, whole
texts); counts are aggregated in Spark.

Defined results: null text, or text without a letter: ``und`` with score 0; ties go to the
alphabetically first language; no labelled row: everything is ``und``; a null doc_id is not
held out and not learned from; repeated rows are returned as often as they occur.
"""
from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import map_arrow, mixed, values

ORDER = 4
SAMPLE = 300
POSITIONS = 1 << 17  # looked up together
LETTER = r"\p{L}"


def grams(data: np.ndarray, k: int) -> np.ndarray:
    """Codes of the k+1 bytes ending at each position from k on (big-endian)."""
    if len(data) <= k:
        return np.zeros(0, np.int64)
    x = data.astype(np.int64)
    code = x[:len(x) - k].copy()
    for i in range(1, k + 1):
        code = (code << 8) | x[i:len(x) - k + i]
    return code


def _counted(batches):
    """Occurrences of every context with its next byte, by language and order."""
    seen: dict = {}
    for b in batches:
        for lang, v in zip(b.column(0).to_pylist(), values(b.column(1))):
            data = np.frombuffer(v or b"", np.uint8)
            for k in range(ORDER + 1):
                seen.setdefault((lang, k), []).append(grams(data, k))
    for (lang, k), parts in seen.items():
        code, n = np.unique(np.concatenate(parts), return_counts=True)
        m = len(code)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * m, pa.string()), pa.array(np.full(m, k, np.int32)), pa.array(code, pa.int64()), pa.array(n.astype(np.int64))], names=["lang", "k", "code", "n"])


def train(labelled: DataFrame, sample: int = SAMPLE) -> bytes:
    """Model of ``labelled`` (doc_id, text, lang), as bytes; at most about ``sample`` rows a language."""
    labelled = labelled.where("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return pickle.dumps(None)
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, sample / n)))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20)
    counts = map_arrow(labelled.where(drawn).select("lang", F.lower("text").alias("text")), _counted, "lang string, k int, code long, n long")
    counts = counts.groupBy("lang", "k", "code").agg(F.sum("n").alias("n")).toArrow()
    return pickle.dumps(build(sorted(sizes), counts), protocol=5)


def build(langs: list[str], counts: pa.Table) -> dict:
    """Per order: codes seen in any language with their cost in each, and contexts with escapes."""
    lang = np.searchsorted(np.array(langs), np.array(counts.column("lang").to_pylist(), dtype=object).astype(str)) if counts.num_rows else np.zeros(0, int)
    order, code, n = (counts.column(c).to_numpy() for c in ("k", "code", "n"))
    many, tables = len(langs), []
    below = None
    for k in range(ORDER + 1):
        mine = order == k
        codes = np.unique(code[mine])
        ctxs = np.unique(codes >> 8)
        count = np.zeros((len(codes), many))
        count[np.searchsorted(codes, code[mine]), lang[mine]] = n[mine]
        at = np.searchsorted(ctxs, codes >> 8)
        total, kinds = np.zeros((len(ctxs), many)), np.zeros((len(ctxs), many))
        np.add.at(total, at, count)
        np.add.at(kinds, at, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            direct = -np.log2(count / (total + kinds)[at])
        low = np.full((len(codes), many), 8.0) if below is None else looked_up(below, codes & ((1 << (8 * k)) - 1), k - 1)
        cost = np.where(count > 0, direct, escape[at] + low)
        tables.append((*hashed(codes, cost.astype(np.float32)), *hashed(ctxs, escape.astype(np.float32))))
        below = tables
    return {"langs": langs, "tables": tables}


def hashed(keys: np.ndarray, rows: np.ndarray):
    """Open-addressed table: slots of key + 1 (0 is free) and the row of each slot."""
    size = 1 << max(4, (2 * len(keys)).bit_length())
    slot_key, slot_row = np.zeros(size, np.int64), np.zeros(size, np.int32)
    left, at = np.arange(len(keys)), (mixed(keys.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)
    while len(left):
        free = slot_key[at] == 0
        won = np.unique(at[free], return_index=True)[1]
        mine = np.nonzero(free)[0][won]
        slot_key[at[mine]], slot_row[at[mine]] = keys[left[mine]] + 1, left[mine]
        rest = np.ones(len(left), bool)
        rest[mine] = False
        left, at = left[rest], (at[rest] + 1) & (size - 1)
    return slot_key, slot_row, rows


def found(table, keys: np.ndarray) -> np.ndarray:
    """Row of each key, or -1."""
    slot_key, slot_row, _ = table
    size = len(slot_key)
    out = np.full(len(keys), -1, np.int64)
    at = (mixed(keys.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)
    got = slot_key[at]
    hit = got == keys + 1
    out[hit] = slot_row[at[hit]]
    left = np.nonzero(~hit & (got != 0))[0]
    at = at[left]
    while len(left):
        at = (at + 1) & (size - 1)
        got = slot_key[at]
        hit = got == keys[left] + 1
        out[left[hit]] = slot_row[at[hit]]
        go = ~hit & (got != 0)
        left, at = left[go], at[go]
    return out


def looked_up(tables, codes: np.ndarray, k: int) -> np.ndarray:
    """Cost of each code of order k in each language, escapes included."""
    row = found(tables[k][:3], codes)
    costs = tables[k][2]
    out = costs[np.maximum(row, 0)].astype(np.float64)
    miss = np.nonzero(row < 0)[0]
    if len(miss):
        escapes = tables[k][5]
        ctx = found(tables[k][3:], codes[miss] >> 8)
        esc = np.where((ctx >= 0)[:, None], escapes[np.maximum(ctx, 0)], 0.0) if len(escapes) else 0.0
        low = looked_up(tables, codes[miss] & ((1 << (8 * k)) - 1), k - 1) if k else 8.0
        out[miss] = esc + low
    return out


def code_lengths(model: dict, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language.  Positions are looked up ``POSITIONS`` at a time, over several short texts or a piece
    of a long one (with the ``ORDER`` bytes before it), so memory does not grow with the text."""
    out = np.zeros((len(texts), len(model["langs"])))
    held, size = [], 0

    def settle(k):
        cost = looked_up(model["tables"], np.concatenate([p for _, p in held]), k)
        starts = np.cumsum([0] + [len(p) for _, p in held[:-1]])
        np.add.at(out, [i for i, _ in held], np.add.reduceat(cost, starts, axis=0))

    for k in range(ORDER + 1):
        for i, t in enumerate(texts):
            d = np.frombuffer(t, np.uint8)
            # the first bytes have shorter contexts; from position ORDER on, the full one
            for at in range(0, max(1, len(d) - k), POSITIONS) if k == ORDER else (0,):
                p = grams(d[at:at + POSITIONS + k] if k == ORDER else d[:k + 1], k)
                if len(p):
                    held.append((i, p))
                    size += len(p)
                if size >= POSITIONS:
                    settle(k)
                    held, size = [], 0
        if held:
            settle(k)
            held, size = [], 0
    return out


def _predicted(model):
    def run(batches):
        m = pickle.loads(model.value)
        step = 1 << 20   # bytes of text whose results are made together
        for b in batches:
            texts = [v or b"" for v in values(b.column(1))]
            lettered = b.column(2).to_pylist()
            lang, score, bits = [], [], []
            i = 0
            while m is not None and i < len(texts):
                j, held = i, 0
                while j < len(texts) and (j == i or held + len(texts[j]) <= step):
                    held += len(texts[j])
                    j += 1
                cost = code_lengths(m, texts[i:j])
                best = cost.argmin(axis=1)
                for r in range(j - i):
                    ok = lettered[i + r]
                    rest = cost[r] - cost[r, best[r]]
                    lang.append(m["langs"][best[r]] if ok else "und")
                    score.append(float(1 / np.exp2(-np.minimum(rest, 1000)).sum()) if ok else 0.0)
                    bits.append(float(cost[r, best[r]] / len(texts[i + r])) if ok else None)
                i = j
            if m is None:
                lang, score, bits = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])
    return run


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior under equal priors) and bits per byte."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    cols = docs.select("doc_id", F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("lettered"), held_out().alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(cols, _predicted(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")


def fit_and_predict(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs.where("doc_id is not null").where(~held_out()).select("doc_id", "text", "lang")))
