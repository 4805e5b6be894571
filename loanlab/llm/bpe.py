"""Operator 1: BPE encoding and decoding as a bounded-lookahead streaming transducer.

The merge list alone says how far a token can depend on what follows it: a merge
of (a, b) at rank r can only be prevented from the right by a merge of lower rank that takes
b, or the right end of b while b was still being made, and so on with ever lower ranks.  One
pass over the merges in rank order sums the longest such chain (``lookahead``).  A word is read
in blocks; tokens that end at least that many symbols before the end of what was read are
stable and leave, and the rest of the buffer goes on with the next block.  Memory is one block
and the lookahead, whatever the length of the word.  Decoding is a state machine over ids
that carries at most an unfinished character.

Defined results: null or empty text gives no ids and an empty decoded text; equal rows give
equal rows; other columns are kept out of the way (only the named ones are read).
"""
from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loanlab.llm.text import map_arrow, values

BLOCK = 256
#: Unicode's white space, for use inside a character class (``\\s`` of Python's engines has more).
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS_KEPT = 50_000
PIECE = 1 << 16        # letters split into words together
STEP = 4096            # ids decoded together
OUT_BYTES = 4 << 20    # of ids and text in one batch of results


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return [x for _, x in sorted([(b, chr(b)) for b in plain] + [(b, chr(256 + i)) for i, b in enumerate(rest)])]


def sufficient_lookahead(merges: list[tuple[str, str]], end: str) -> int:
    """Symbols after a token's end that can still change it, from the merge list (see above)."""
    size = lambda s: len(s) - (len(end) if end and s.endswith(end) else 0)
    taken: dict[str, int] = {}  # by left part: |right part| and what that merge itself waits for
    made: dict[str, int] = {}   # by product: what the merge that makes it waits for
    for a, b in merges:
        waits = max(taken.get(b, 0), made.get(b, 0))
        taken[a] = max(taken.get(a, 0), size(b) + waits)
        made[a + b] = max(made.get(a + b, 0), waits)
    return max([0, *taken.values(), *made.values()])


class Transducer:
    """Encoder and decoder of one vocabulary file (JSON, model BPE with a word-end suffix)."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in reversed(list(enumerate(merges)))}
        self.lookahead = sufficient_lookahead(merges, self.end)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = pattern.replace(r"\s", SPACES)
        self.words = regex.compile(pattern).findall
        # the same pattern over ASCII only, for the standard engine, which is faster
        self.ascii_words = re.compile(pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")).findall
        self.space = re.compile(f"[{SPACES}]")
        self.letters = byte_letters()
        self.by_id = {i: t for t, i in {**self.vocab, **special}.items()}
        self.bytes_of = {i: t.encode() for i, t in self.by_id.items()}
        self.plain_bytes = self._plain_bytes(special)
        self.id_bytes = {t: int(i).to_bytes(4, "little") for t, i in self.vocab.items()}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain_bytes(self, special: dict[str, int]) -> dict[int, bytes]:
        """What each id stands for: bytes of its letters, a space at a word's end; special tokens as they are."""
        byte, end, out = {c: b for b, c in enumerate(self.letters)}, self.end, {}
        for i, t in self.by_id.items():
            stop = bool(end) and t.endswith(end)
            out[i] = t.encode() if t in special else bytes(byte[c] for c in (t[:-len(end)] if stop else t)) + (b" " if stop else b"")
        return out

    def merged(self, symbols: list[str]) -> list[str]:
        """Apply merges, lowest rank and then leftmost first, until none fits."""
        get, none = self.ranks.get, 1 << 60
        found = [get(p, none) for p in zip(symbols, symbols[1:])]
        while found and (low := min(found)) != none:
            i = found.index(low)
            symbols[i] += symbols.pop(i + 1)
            del found[i]
            if i < len(found):
                found[i] = get((symbols[i], symbols[i + 1]), none)
            if i:
                found[i - 1] = get((symbols[i - 1], symbols[i]), none)
        return symbols

    def stream(self, symbols):
        """Tokens of one word's symbols, each as soon as it is stable."""
        held: list[str] = []
        full = BLOCK + self.lookahead
        for s in symbols:
            held.append(s)
            if len(held) > full:  # the last symbol stays out: it may be the word's end
                at, stable = 0, len(held) - 1 - self.lookahead
                for token in self.merged(held[:-1]):
                    if at + len(token) > stable:
                        break
                    at += len(token)
                    yield token
                held = held[at:]
        if held:
            yield from self.merged(held[:-1] + [held[-1] + self.end])

    def word(self, word: str) -> bytes:
        """Little-endian 32-bit ids of one word; short words are remembered, in two bounded
        generations, so that common words stay."""
        got = self.older.get(word)
        if got is None:
            symbols = [self.letters[b] for b in word.encode()]
            known = self.id_bytes
            got = b"".join([known[t] for t in (self.stream(symbols) if len(symbols) > BLOCK else self.closed(symbols)) if t in known])
        if len(word) <= 64:
            if len(self.cache) >= WORDS_KEPT:
                self.older, self.cache = self.cache, {}
            self.cache[word] = got
        return got

    def closed(self, symbols: list[str]) -> list[str]:
        """Tokens of a whole word that is within one block."""
        symbols[-1] += self.end
        return self.merged(symbols)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(self.encoded(text))

    def encoded(self, text: str) -> Iterator[bytes]:
        """The same, a piece of about ``PIECE`` letters at a time, so that no list of all words is made.

        White space is in no token and joins with no letter, so a piece may end after it."""
        at = 0
        while len(text) - at > PIECE:
            space = self.space.search(text, at + PIECE)
            end = space.end() if space else len(text)
            yield self.piece(text[at:end])
            at = end
        if at < len(text):
            yield self.piece(text[at:] if at else text)

    def forget(self):
        """Empty the word caches (a worker process outlives its task)."""
        self.cache, self.older = {}, {}

    def piece(self, text: str) -> bytes:
        if self.cut is not None and "<|" in text:
            return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self.plain(p) for p in self.cut.split(text))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if text.isascii():
            words = self.ascii_words(text.lower())
        else:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            words = self.words(text.replace("Σ", "σ").lower())  # letter by letter: no final sigma
        make, out = self.word, []
        get = self.cache.get
        for w in words:
            got = get(w)
            if got is None:
                got = make(w)
                get = self.cache.get
            out.append(got)
        return b"".join(out)


class Decoder:
    """Ids to text, a piece at a time.

    ``tokens`` joins the vocabulary's own forms with one space, as the file's empty decoder
    asks; ``text`` turns byte letters back into characters, holding back an unfinished one,
    and ends words with a space.
    """

    def __init__(self, owner: Transducer):
        self.owner, self.started = owner, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def tokens(self, ids: list[int]) -> bytes:
        out = b" ".join(map(self.owner.bytes_of.__getitem__, ids))
        if ids and self.started:
            out = b" " + out
        self.started |= bool(ids)
        return out

    def text(self, ids: list[int], last: bool = False) -> str:
        return self.utf8.decode(b"".join(map(self.owner.plain_bytes.__getitem__, ids)), last)


@lru_cache(maxsize=2)
def transducer(raw: bytes) -> Transducer:
    return Transducer(raw)


def _file(df: DataFrame, path: str):
    with open(path, "rb") as f:  # on the driver; a vocabulary has a fixed size of a few MB
        return df.sparkSession.sparkContext.broadcast(f.read())


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, SHA-256 of the ids and of the decoded text."""
    raw = _file(df, path)

    def run(batches):
        t = transducer(raw.value)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for v in values(b.column(1)):
                count, of_ids, of_text, d = 0, hashlib.sha256(), hashlib.sha256(), Decoder(t)
                for ids in t.encoded(v.decode("utf-8", "replace")) if v else ():
                    count += len(ids) // 4
                    of_ids.update(ids)
                    of_text.update(d.tokens(np.frombuffer(ids, "<u4").tolist()))
                n.append(count)
                ids_sha.append(of_ids.hexdigest())
                text_sha.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        t.forget()

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, text_col), run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids (array of int) and the decoded text (byte-to-text form)."""
    raw = _file(df, path)

    def out(keys, ids, text):
        ends = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
        flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
        return pa.RecordBatch.from_arrays([keys, pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(text, pa.string())],
                                          names=["doc_id", "n_tokens", "ids", "decoded"])

    def run(batches):
        t = transducer(raw.value)
        for b in batches:
            ids, text, first, held = [], [], 0, 0
            for at, v in enumerate(values(b.column(1)), 1):
                one = t.encode(v.decode("utf-8", "replace")) if v else b""
                every, d = np.frombuffer(one, "<u4"), Decoder(t)
                ids.append(one)
                text.append("".join(d.text(every[i:i + STEP].tolist(), i + STEP >= len(every)) for i in range(0, len(every), STEP)))
                held += len(one) + len(text[-1])
                if held >= OUT_BYTES:  # rows leave by size, not by the batches that came in
                    yield out(b.column(0).slice(first, at - first), ids, text)
                    ids, text, first, held = [], [], at, 0
            yield out(b.column(0).slice(first), ids, text)
        t.forget()

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, text_col), run, f"doc_id {kind}, n_tokens long, ids array<int>, decoded string")
