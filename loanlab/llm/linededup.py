"""Operator 11: line dedup by range-partitioned line hashes (DataFrame functions only).

A line's key is the line without white space (space, \\t-\\r) at its ends, A-Z lower-cased.  Keys of at
least ``LEAST_CHARS`` code points that stand in at least ``LEAST_DOCS`` documents lose all their lines
except in the largest doc_id that holds them.

Only hashes travel: 128 bits of the key, the document, a fingerprint of its text and the line's
position.  One aggregation with map-side combine leaves the keys that occur often enough at all.  Their lines
are range-partitioned by hash, sorted by hash, document (largest first) and position, and read in
that order: the first document of a key keeps its lines, every later one loses them once a third is seen.
A key with more than ``PIECE`` lines is cut into pieces by a hash of the document, each of which is
streamed alone; what a piece cannot tell by itself (its first two documents) is settled in a second
stream over the first three documents of each piece.

The result is a keep bitmap for each document, compressed to the ends of its runs: lines before keep[0] stay,
those up to keep[1] go, those up to keep[2] stay and so on (keep[0] is 0 if the first line goes; the last
end is the number of lines).  ``kept_text`` applies it to a text.

Defined results: a null or empty text is one empty line; rows without a doc_id keep all lines and count as no
document; rows that share a doc_id are one document, each with a bitmap of its own; equal rows have
equal bitmaps; a key repeated within its largest document keeps all its lines there; an empty table gives
no rows; only the named columns are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlab.llm.text import BROADCAST_BYTES, broadcast_if_small, reliable

LEAST_CHARS, LEAST_DOCS = 20, 3
PIECE = 1 << 13   # lines of one key that are streamed together
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, t, pos, h1, h2) of each line whose key is long enough; t is a fingerprint of the text."""
    named = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("t"), F.translate("text", UPPER, LOWER).alias("text"))
    lines = named.select("doc_id", "t", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "t", "pos", F.btrim("line", F.lit(BLANK)).alias("key"))
    keys = keys.where(F.char_length("key") >= LEAST_CHARS)
    return keys.select("doc_id", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, t, pos) of every line that goes; ``docs`` has doc_id and text."""
    lines = reliable(line_hashes(docs))
    often = reliable(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_DOCS))
    some = lines.join(broadcast_if_small(often, 96), ["h1", "h2"])
    pieces = F.when(F.col("n") > PIECE, F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / PIECE))).otherwise(F.lit(-1))
    some = reliable(some.select("h1", "h2", pieces.cast("long").alias("piece"), "doc_id", "t", "pos"))

    last = F.col("doc_id").desc()
    dealt = some.repartitionByRange("h1", "piece").sortWithinPartitions("h1", "h2", "piece", last, "t", "pos")
    piece = Window.partitionBy("h1", "h2", "piece")
    seen = dealt.withColumn("place", F.dense_rank().over(piece.orderBy(last))).withColumn("places", F.max("place").over(piece))
    whole = F.col("piece") < 0
    gone = F.when(whole, (F.col("place") > 1) & (F.col("places") >= LEAST_DOCS)).when(F.col("place") >= LEAST_DOCS, True)  # null: not known yet
    seen = seen.withColumn("gone", gone)
    seen = reliable(seen.where("piece >= 0 or gone").select("h1", "h2", "piece", "doc_id", "t", "pos", "place", "gone"))

    key = Window.partitionBy("h1", "h2")
    first = seen.where((F.col("piece") >= 0) & (F.col("place") <= LEAST_DOCS))
    first = first.withColumn("of_all", F.dense_rank().over(key.orderBy(last))).withColumn("of_all_max", F.max("of_all").over(key))
    late = first.where(F.col("gone").isNull() & (F.col("of_all") > 1) & (F.col("of_all_max") >= LEAST_DOCS))
    return seen.where("gone").select("doc_id", "t", "pos").union(late.select("doc_id", "t", "pos"))


def _ends(dropped: Column, n_lines: Column) -> Column:
    """Where kept and dropped stretches end in turn, from the sorted positions of dropped lines."""
    starts = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) != x + 1))
    return F.array_distinct(F.concat(F.flatten(F.zip_with(starts, ends, lambda s, e: F.array(s, e + 1))), F.array(n_lines)))


def kept_text(text: Column, keep: Column) -> Column:
    """The text without its dropped lines; ``keep`` as from ``keep_bitmaps``."""
    def cut(lines):
        start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(keep, i - 1))
        runs = F.transform(keep, lambda end, i: F.when(i % 2 == 0, F.slice(lines, start(i) + 1, end - start(i))).otherwise(F.array().cast("array<string>")))
        return F.array_join(F.flatten(runs), "\n")
    # the outer transform gives the lines a name, so that the text is split once
    return F.when(F.size(keep) == 1, F.coalesce(text, F.lit(""))).otherwise(F.get(F.transform(F.array(_lines(text)), cut), F.lit(0)))


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gone = dropped_lines(docs).groupBy("doc_id", "t").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    gone = reliable(gone)
    size = gone.agg(F.sum(F.lit(64) + 4 * F.size("dropped"))).first()[0] or 0
    n = F.size(_lines(F.col("text")))
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("t"), n.alias("n_lines"))
    out = docs.join(F.broadcast(gone) if size <= BROADCAST_BYTES else gone, ["doc_id", "t"], "left")
    return out.select("doc_id", "text", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).alias("n_dropped"),
                      F.when(F.col("dropped").isNull(), F.array("n_lines")).otherwise(_ends(F.col("dropped"), F.col("n_lines"))).alias("keep"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and ``keep`` (ends of runs) for every row of ``docs``."""
    long = lambda c: F.col(c).cast("long").alias(c)
    return _marked(docs, id_col, text_col).select("doc_id", long("n_lines"), long("n_dropped"), "keep")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``keep_bitmaps``, with the text that the bitmap leaves (``kept``)."""
    long = lambda c: F.col(c).cast("long").alias(c)
    return _marked(docs, id_col, text_col).select("doc_id", long("n_lines"), long("n_dropped"), "keep", kept_text(F.col("text"), F.col("keep")).alias("kept"))
