"""Operator 7: benchmark decontamination by spaced-seed hashing (DataFrame functions only).

Words are runs of letters and digits, lower-cased; in scripts without spaces each letter is a word.
Two masks hash three words each: three in a row, and two in a row with the next but one.  Seeds of
all documents join the seeds of the benchmark; a hit names a document, an item and a diagonal
(document position minus item position).  Hits are counted by diagonal, and a diagonal with the
fewest hits that any accepted pair of that item size can have (``least_hits``, over every placement
of the changed words) is verified on the whole item: words that stand at the same place on the
diagonal are counted, and a document is contaminated by an item if

* at least 60 % of the item's words, and at least eight, are equal; or
* some 13 consecutive places of the diagonal hold at least 11 equal words; or
* the item has under eight words, and all of them are equal.

Defined results: null or empty texts and items match nothing; items of one and two words are seeded
by their words alone; rows without an id take no part; repeated rows and several items give one row for
each (document, item), at the diagonal with the most equal words, then the smallest.
"""
from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlab.llm.text import broadcast_if_small, reliable

MASKS = ((0, 1, 2), (0, 1, 3))
WEIGHT = 3  # items under so many words have a mask of their own size
SHARE, LEAST = 0.6, 8
RUN, RUN_EQUAL = 13, 11
#: Letters of Thai, Lao, Burmese, Khmer, Kana and Han; the first range keeps other letters cheap.
UNSPACED = r"([\u0E00-\x{3FFFF}&&[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]&&\p{L}])"


def word_array(text: str) -> F.Column:
    spaced = F.when(F.col(text).rlike(UNSPACED), F.regexp_replace(text, UNSPACED, " $1 ")).otherwise(F.col(text))
    return F.array_remove(F.split(F.lower(spaced), r"[^\p{L}\p{N}]+"), "")


def fewest_hits(size: int, equal) -> list[int]:
    """For n up to ``size``: the fewest hits of the masks on n places, ``equal(n)`` or more of them equal."""
    span = max(m[-1] for m in MASKS) + 1
    marks = [sum(1 << (m[-1] - o) for o in m) for m in MASKS]
    have, out = {(0, 0): 0}, []  # (the last places, how many are equal): fewest hits
    for n in range(1, size + 1):
        after = {}
        for (last, k), hits in have.items():
            for x in (0, 1):
                now = (last << 1 | x) & ((1 << span) - 1)
                made = hits + (sum(now & m == m for m in marks) if x else 0)
                after[now, k + x] = min(made, after.get((now, k + x), made))
        have = after
        out.append(min(h for (_, k), h in have.items() if k >= equal(n)))
    return out


@cache
def least_hits() -> list[int]:
    """Hits that an accepted diagonal has at least, for items of 1, 2, ... words; the last holds beyond, too.

    Without a hit at most n / 2 + 1 of n places are equal, and each equal place more costs a hit: at
    60 % these are n / 10 - 1, which from 100 words on is no less than what the second rule needs."""
    full = fewest_hits(100, lambda n: n if n < LEAST else max(LEAST, -(-3 * n // 5)))
    run = fewest_hits(RUN, lambda n: min(n, RUN_EQUAL))[-1]
    return [1 if n < WEIGHT else h if n < RUN else min(h, run) for n, h in enumerate(full, 1)]


def seeds(df: DataFrame, key: str, words: F.Column, masks: tuple) -> DataFrame:
    """(key, seed, at) for each mask and word position, at the masks' first word; null beyond the last word."""
    hashed = df.select(key, F.transform(words, lambda w: F.xxhash64(w)).alias("h"))
    # no filter on the size: pushed below the projection, it would split every text twice
    places = hashed.select(key, "h", F.size("h").alias("n"))
    of = lambda m, i: F.xxhash64(F.lit(sum(1 << o for o in m)), *[F.get(F.col("h"), i + o) for o in m])
    one = lambda m: F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.when(i + m[-1] < F.col("n"), of(m, i)))
    every = places.select(key, "n", F.posexplode(F.when(F.col("n") > 0, F.flatten(F.array(*[one(m) for m in masks])))).alias("p", "seed"))
    return every.select(key, "seed", (F.col("p") % F.col("n")).alias("at"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words, n_equal, overlap, at: one row for each contaminated pair."""
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    items = items.select("item_id", F.col("text").alias("item")).where("item_id is not null and item is not null")
    words = reliable(items.select("item_id", word_array("item").alias("iw")))
    tiny = [tuple(range(r.n)) for r in words.select(F.size("iw").alias("n")).where(f"n > 0 and n < {WEIGHT}").distinct().collect()]
    floor = F.element_at(F.array(*map(F.lit, least_hits())), F.least(F.size("iw"), F.lit(len(least_hits()))))
    long = words.where(F.size("iw") >= WEIGHT)
    probe = seeds(long, "item_id", F.col("iw"), MASKS)
    for m in tiny:
        probe = probe.unionByName(seeds(words.where(F.size("iw") == len(m)), "item_id", F.col("iw"), (m,)))
    probe = probe.where("seed is not null").withColumnRenamed("at", "item_at").distinct()
    floors = words.where(F.size("iw") > 0).groupBy("item_id").agg(F.min(floor).alias("floor"))
    probe = reliable(probe.join(floors, "item_id"))
    hits = seeds(docs, "doc_id", word_array("text"), MASKS + tuple(tiny)).join(broadcast_if_small(probe, 64), "seed")
    hits = hits.groupBy("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("at")).agg(F.count("*").alias("n_hits"), F.min("floor").alias("floor"))
    hits = reliable(hits.where("n_hits >= floor"))
    named = reliable(hits.select("item_id").distinct().join(words, "item_id"))
    lines = hits.join(broadcast_if_small(named, 4096), "item_id")
    # one row for each document with hits: its diagonals, verified where the text is read again
    lines = reliable(lines.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "at", "iw")).alias("ls")))
    texts = docs.join(broadcast_if_small(lines, 4096), "doc_id").select("doc_id", word_array("text").alias("w"), "ls")
    # the generator keeps the split out of the comparisons, which would repeat it for every word
    pairs = texts.select("doc_id", "w", F.inline("ls"))
    checked = pairs.select("doc_id", "item_id", "at", F.transform("iw", lambda x, i: F.when(F.get(F.col("w"), i + F.col("at")) == x, 1).otherwise(0)).alias("eq"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    run = F.exists(F.sequence(F.lit(1), F.greatest(F.size("eq") - (RUN - 1), F.lit(1))), lambda i: total(F.slice("eq", i, RUN)) >= RUN_EQUAL)
    checked = checked.select("doc_id", "item_id", "at", F.size("eq").cast("long").alias("n_words"), total(F.col("eq")).cast("long").alias("n_equal"), run.alias("run"))
    full = (F.col("n_equal") >= SHARE * F.col("n_words")) & (F.col("n_equal") >= F.least(F.lit(LEAST), F.col("n_words")))
    best = checked.where(full | F.col("run")).groupBy("doc_id", "item_id", "n_words").agg(F.max(F.struct("n_equal", (-F.col("at")).alias("back"))).alias("b"))
    return best.select("doc_id", "item_id", "n_words", F.col("b.n_equal").alias("n_equal"), (F.col("b.n_equal") / F.col("n_words")).alias("overlap"), (-F.col("b.back")).cast("long").alias("at"))
