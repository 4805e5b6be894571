"""Sampling and splitting on a partition-independent hash of the row key.

Every row gets ``h = hash_u32(key, seed)``; order by (h, key) is a seeded random
permutation that a SQL engine can reproduce.  "The first 75 %" or "as many as the minority"
need only the row at which to stop, not a rank for every row.  ``hash_cut`` finds it: a
histogram of the top 16 hash bits per group (at most groups x 65,536 rows), the bin in which each
group's cut falls, and a rank of the keys of those bins alone (1 row in 65,536).  The cut goes back
as one (hash, key) pair for each group, and the rows are kept by a comparison: no
column but the key is ever shuffled.

Folds are equal parts of the hash order (``hash_pieces``), of which only the first rows are looked for; over-sampling draws
copies in place.  ``hash_rank`` gives every row's rank where that is asked for: the histogram's running totals are
joined back (one row per group and bin) and ``row_number`` runs within (group, bin).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlab.functions.columns import TWO_32, hash_u32, hash_u60
from loanlab.session import cut_lineage

BIN_SHIFT = 16   # 32-bit hash -> 65,536 bins
BROADCAST_BYTES = 256 << 20   # of a table that goes to every executor


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _binned(df: DataFrame, key: str, seed, salt: str, salt_col: str | None) -> DataFrame:
    return df.withColumn("_h", hash_u32(key, seed, salt, salt_col)) \
             .withColumn("_bin", F.shiftright(F.col("_h"), BIN_SHIFT))


def _bin_offsets(d: DataFrame, keys: list[str]) -> DataFrame:
    """(group, bin): rows in the bin, rows before it, rows of the group.  65,536 rows a group at
    most, whatever the size of the data; the window runs over one group's bins."""
    hist = d.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy(*keys).orderBy("_bin")
    return hist.withColumns({
        "_off": F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_c").over(Window.partitionBy(*keys))})


def _sized(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Broadcast a materialised frame if its counted size allows it."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def hash_rank(df: DataFrame, key: str, seed, by=None, salt: str = "", salt_col: str | None = None,
              out: str = "_rank", with_counts: bool = False) -> DataFrame:
    """Exact 0-based rank in (hash, key) order within each ``by`` group.

    ``by`` must be low-cardinality (a class label, a split number).  With
    ``with_counts`` the group size ``_n`` and the smallest group size ``_nmin`` are added.
    """
    keys = _keys(by)
    d = _binned(df, key, seed, salt, salt_col)
    off = cut_lineage(_bin_offsets(d, keys).drop("_c"))
    if with_counts:
        off = off.withColumn("_nmin", F.lit(off.agg(F.min("_n")).first()[0]))
    else:
        off = off.drop("_n")
    j = d.join(_sized(off), keys + ["_bin"])
    wr = Window.partitionBy(*keys, "_bin").orderBy("_h", key)
    return j.withColumn(out, F.col("_off") + F.row_number().over(wr) - 1).drop("_bin", "_off")


def _cut_points(d: DataFrame, keys: list[str], key: str, take) -> DataFrame:
    """(group, ``_cut``): hash and key of the last row taken in each group of a binned frame; see ``hash_cut``."""
    bins = cut_lineage(_bin_offsets(d, keys))
    least = bins.agg(F.min("_n")).first()[0]
    bins = bins.withColumn("_take", take(F.col("_n"), F.lit(least)).cast("long"))
    # the bin that holds the last row taken, and that row's place within it
    edges = bins.where((F.col("_off") < F.col("_take")) & (F.col("_take") <= F.col("_off") + F.col("_c")))
    edges = cut_lineage(edges.select(*keys, "_bin", (F.col("_take") - F.col("_off")).alias("_place")))
    inside = d.select(*keys, "_bin", "_h", F.col(key).alias("_key")).join(_sized(edges), keys + ["_bin"])
    order = Window.partitionBy(*keys, "_bin").orderBy("_h", "_key")
    cuts = inside.withColumn("_at", F.row_number().over(order)).where(F.col("_at") == F.col("_place"))
    return cut_lineage(cuts.select(*keys, F.struct("_h", "_key").alias("_cut")))


def cut_points(df: DataFrame, key: str, seed, take, by=None, salt: str = "", salt_col: str | None = None) -> DataFrame:
    """(group, ``_cut``): the (hash, key) at which each group of ``hash_cut`` ends, for groups that are not rows' own columns."""
    keys = _keys(by)
    return _cut_points(_binned(df, key, seed, salt, salt_col), keys, key, take)


def hash_cut(df: DataFrame, key: str, seed, take, by=None, salt: str = "", salt_col: str | None = None,
             out: str = "_in") -> DataFrame:
    """Adds a boolean: is the row among the first ``take`` of its group in (hash, key) order?

    ``take`` is an expression over ``_n`` (the group's size) and ``_nmin`` (the smallest group's).
    Equal to ``hash_rank(...) < take`` without ranking, sorting or moving the rows.
    """
    keys = _keys(by)
    d = _binned(df, key, seed, salt, salt_col)
    cuts = _cut_points(d, keys, key, take)
    kept = F.coalesce(F.struct("_h", F.col(key).alias("_key")) <= F.col("_cut"), F.lit(False))
    j = d.join(_sized(cuts), keys, "left") if keys else d.crossJoin(F.broadcast(cuts)) if cuts.count() else d.withColumn("_cut", F.lit(None).cast(cuts.schema["_cut"].dataType))
    return j.withColumn(out, kept).drop("_h", "_bin", "_cut")


def hash_pieces(df: DataFrame, key: str, seed, pieces: int, by=None, salt: str = "", out: str = "fold") -> DataFrame:
    """Adds the number of the piece, 0 to ``pieces`` - 1, of the group's rows in (hash, key) order; pieces are equal but for one
    row: a row of rank r among n is in piece ``r * pieces div n``.

    As in ``hash_cut`` only the rows at which pieces begin are looked for: keys of a few bins are shuffled, rows are not.
    """
    keys = _keys(by)
    d = _binned(df, key, seed, salt, None)
    bins = cut_lineage(_bin_offsets(d, keys))
    # the first rank of piece p is ceil(p n / pieces); of pieces that would begin at one row the last does
    first = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda p: F.struct(F.floor((p * F.col("_n") + (pieces - 1)) / F.lit(pieces)).alias("_first"), p.alias("_p")))
    edges = bins.select(*keys, "_bin", "_off", "_c", F.inline(first))
    edges = edges.where((F.col("_off") <= F.col("_first")) & (F.col("_first") < F.col("_off") + F.col("_c")))
    edges = cut_lineage(edges.groupBy(*keys, "_bin", (F.col("_first") - F.col("_off") + 1).cast("int").alias("_at")).agg(F.max("_p").alias("_p")))
    inside = d.select(*keys, "_bin", "_h", F.col(key).alias("_key")).join(_sized(edges.select(*keys, "_bin").distinct()), keys + ["_bin"])
    order = Window.partitionBy(*keys, "_bin").orderBy("_h", "_key")
    starts = inside.withColumn("_at", F.row_number().over(order)).join(_sized(edges), keys + ["_bin", "_at"])
    starts = cut_lineage(starts.groupBy(*keys).agg(F.collect_list(F.struct("_h", "_key", "_p")).alias("_starts")))   # ``pieces`` at most in each group
    joined = d.join(_sized(starts, 64 + 32 * pieces), keys, "left") if keys else d.crossJoin(F.broadcast(starts))   # one row without groups
    here = F.struct("_h", F.col(key).alias("_key"))
    begun = F.transform(F.filter("_starts", lambda s: F.struct(s["_h"].alias("_h"), s["_key"].alias("_key")) <= here), lambda s: s["_p"])
    return joined.withColumn(out, F.coalesce(F.array_max(begun), F.lit(0)).cast("int")).drop("_h", "_bin", "_starts")


def hash_sample(df: DataFrame, key: str, fraction: float, seed=111) -> DataFrame:
    """Rows whose hash falls below ``fraction``: a narrow filter, no shuffle."""
    return df.filter(hash_u32(key, seed) < F.lit(int(fraction * TWO_32)))


def split_flag(df: DataFrame, key: str, train_frac: float = 0.75, seed=111, exact: bool = True,
               out: str = "is_train") -> DataFrame:
    """Adds ``is_train`` (1/0).  ``exact``: the first floor(frac*n) rows in hash
    order; otherwise the hash threshold (no shuffle, size within sampling noise)."""
    if not exact:
        return df.withColumn(out, (hash_u32(key, seed, "split") < F.lit(int(train_frac * TWO_32))).cast("int"))
    r = hash_cut(df, key, seed, lambda n, _: F.floor(n * F.lit(train_frac)), salt="split")
    return r.withColumn(out, F.col("_in").cast("int")).drop("_in")


def train_test_split(df: DataFrame, key: str, train_frac: float = 0.75, seed=111, exact: bool = True):
    """(train, test); not stratified."""
    f = split_flag(df, key, train_frac, seed, exact)
    return f.filter(F.col("is_train") == 1).drop("is_train"), f.filter(F.col("is_train") == 0).drop("is_train")


def stratified_shuffle_split(df: DataFrame, key: str, label: str, n_splits: int = 4,
                             train_frac: float = 0.75, seed=111) -> DataFrame:
    """``n_splits`` independent stratified splits (they may overlap), long form:
    (split, ..., is_train).  Per class, the first floor(frac*n_class) rows in the
    split's own hash order are train.  The copies are made in place and never shuffled."""
    e = df.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    r = hash_cut(e, key, seed, lambda n, _: F.floor(n * F.lit(train_frac)), by=["split", label], salt="sss", salt_col="split")
    return r.withColumn("is_train", F.col("_in").cast("int")).drop("_in")


def kfold_assign(df: DataFrame, key: str, k: int = 3, seed=111, out: str = "fold") -> DataFrame:
    """Disjoint folds of equal size (+-1): the k-th part of the rows in hash order.  No row is moved."""
    return hash_pieces(df, key, seed, k, salt="kfold", out=out)


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed=111, out: str = "fold") -> DataFrame:
    """Disjoint folds, each class spread evenly: the k-th part of each class in hash order.  No row is moved."""
    return hash_pieces(df, key, seed, k, by=label, salt="skfold", out=out)


def under_sample(df: DataFrame, key: str, label: str, seed=111) -> DataFrame:
    """Every class cut to the smallest class size, without replacement."""
    return hash_cut(df, key, seed, lambda _, least: least, by=label, salt="rus").filter("_in").drop("_in")


def over_sample(df: DataFrame, key: str, label: str, seed=111, minority=None) -> DataFrame:
    """Binary random over-sampling with replacement: all rows plus (n_major - n_minor) draws of minority rows.

    Each minority row draws a Poisson number of copies from its key hash, n_draws / n_minor on average; as many Poisson counts of a
    given total are a uniform draw with replacement, only the total has to be made exact: missing draws go to the first rows in
    a hash order, surplus ones are taken from the draws that come first in a hash order (about the square root of n_draws either way).
    Copies are made in place: no row is shuffled or looked up.  ``draw`` numbers a row's copies from 0 and is NULL for the
    original rows.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().limit(3).collect()}
    if len(counts) != 2:
        raise ValueError("over_sample expects exactly two classes")
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], c))
    n_minor = counts[minority]
    n_draws = sum(counts.values()) - 2 * n_minor
    base = df.withColumn("draw", F.lit(None).cast("long"))
    if n_draws <= 0:
        return base
    minor = df.filter(F.col(label) == F.lit(minority)).withColumn("_k", _poisson_draws(key, seed, n_draws / n_minor))
    drawn = minor.agg(F.sum("_k")).first()[0] or 0
    if drawn < n_draws:   # less than one a row: the deficit is far below n_minor, or every row gets some whole draws first
        whole, rest = divmod(n_draws - drawn, n_minor)
        minor = hash_cut(minor, key, seed, lambda n, _: F.lit(rest), salt="ros-more", out="_more")
        minor = minor.withColumn("_k", F.col("_k") + F.lit(whole) + F.col("_more").cast("int")).drop("_more")
    numbered = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k").cast("long") - 1))
    copies = minor.filter(F.col("_k") > 0).withColumn("draw", numbered).drop("_k")
    if drawn > n_draws:
        named = copies.withColumn("_draw", F.concat_ws(":", F.col(key).cast("string"), F.col("draw").cast("string")))
        copies = hash_cut(named, "_draw", seed, lambda n, _: F.lit(drawn - n_draws), salt="ros-less", out="_less").filter(~F.col("_less")).drop("_less", "_draw")
    return base.unionByName(copies.select(*base.columns))


#: Poisson draws of more than this on average are sums of several.
MOST_RATE = 16.0


def _rate_parts(rate: float) -> list[float]:
    n = max(1, math.ceil(rate / MOST_RATE))
    return [rate / n] * n


def _poisson_draws(key: str, seed, rate: float):
    """Poisson number with mean ``rate`` from the key hash."""
    # the draws are made by the array, so that the hash is not repeated for every threshold
    parts = _rate_parts(rate)
    draws = F.transform(F.sequence(F.lit(0), F.lit(len(parts) - 1)), lambda i: hash_u32(key, seed, "ros", i) / F.lit(TWO_32))
    return F.aggregate(draws, F.lit(0), lambda a, u: a + poisson_weight(u, parts[0]).cast("int"))


def poisson_cdf(lam: float) -> list[float]:
    """Cumulative Poisson probabilities until the tail is below 2**-40 (the hash
    resolution is 2**-32).  Terms are formed from their logarithms, so no rate underflows."""
    out, acc, k = [], 0.0, 0
    while 1.0 - acc >= 2.0 ** -40:
        p = math.exp(k * math.log(lam) - lam - math.lgamma(k + 1)) if lam > 0 else float(k == 0)
        if k > lam and p < 2.0 ** -60:   # sums of many terms round: the rest is below the resolution
            break
        acc += p
        out.append(acc)
        k += 1
    return out


def bootstrap_bags(df: DataFrame, key: str, n_bags: int = 10, fraction: float = 1.0, seed=111,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Bootstrap bags as weights: (bag, key, keep..., weight>0) with weight ~
    Poisson(fraction) per (row, bag), the distributed form of drawing n*fraction
    rows with replacement."""
    # the uniform draw is produced by the generator itself, so the optimizer
    # cannot inline the hash into each of the Poisson thresholds below
    draws = F.transform(F.sequence(F.lit(0), F.lit(n_bags - 1)),
                        lambda b: F.struct(b.alias("bag"), (hash_u32(key, seed, "bag", b) / F.lit(TWO_32)).alias("_u")))
    e = df.select(key, *keep, F.inline(draws))
    first = poisson_cdf(fraction)[0]
    return e.filter(F.col("_u") >= F.lit(first)).withColumn("weight", poisson_weight(F.col("_u"), fraction)) \
            .select("bag", key, *keep, "weight")


def poisson_weight(u, fraction: float = 1.0):
    """Inverse-CDF Poisson draw from a uniform column ``u`` in [0, 1)."""
    return sum(((u >= F.lit(c)).cast("int") for c in poisson_cdf(fraction)[:-1]), F.lit(0))


def bag_weight_sql(key_sql: str, seed, bag_sql: str, fraction: float) -> str:
    """DuckDB text of the bag weight (oracle)."""
    from loanlab.functions.columns import sql_hash_u32
    u = f"({sql_hash_u32(key_sql, seed, 'bag', bag_sql)} / {TWO_32})"
    cdf = poisson_cdf(fraction)
    return "(" + " + ".join(f"CAST({u} >= {repr(c)} AS INTEGER)" for c in cdf[:-1]) + ")"
