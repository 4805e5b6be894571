"""Exact quantiles by distributed radix selection.

A double has a 64-bit image whose unsigned order is the order of the numbers.  Four passes of 16 bits
find the image at a given rank: each pass counts, by map-side aggregation, the next 16 bits of the
rows whose earlier bits are those found so far; running counts over these bins (65,536 for one
target at most) tell the next 16 bits.  Nothing is sorted, no sketch is used, no column or group
is gathered, and the result does not depend on how the values are spread.

Up to ``CELLS`` targets go to the tasks with the pass, which count in arrays; more, as with many groups, are
a table that joins the rows on the group (broadcast within a measured size).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlab.session import cut_lineage, ship

DIGIT, PASSES = 16, 4
CELLS = 64               # of 65,536 counts each, in a task
BROADCAST_BYTES = 64 << 20
_TOP = np.uint64(1 << 63)


def image(x: np.ndarray) -> np.ndarray:
    """Signed 64-bit pattern whose unsigned order is the order of ``x`` (NaN last, -0 equal to 0)."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP).view(np.int64)


def number(img: np.ndarray) -> np.ndarray:
    """The doubles of images."""
    bits = img.view(np.uint64)
    return np.where(bits & _TOP, bits ^ _TOP, ~bits).view(np.float64)


def _mapped(fn, names: list[str]):
    """Arrow batches with ``fn`` applied to the named columns; other columns pass."""
    def run(batches):
        for b in batches:
            cols = []
            for name, c in zip(b.schema.names, b.columns):
                if name in names:
                    kind = np.float64 if pa.types.is_floating(c.type) else np.int64
                    made = fn(c.fill_null(0).to_numpy(zero_copy_only=False).astype(kind))
                    c = pa.array(made, mask=c.is_null().to_numpy(zero_copy_only=False))
                cols.append(c)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
    return run


def _images(df: DataFrame, cols: Sequence[str], by: str | None) -> DataFrame:
    """Group ``g`` (null without ``by``) and the columns' images x0, x1, ..."""
    group = F.col(by) if by else F.lit(None)
    narrow = df.select(group.alias("g"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    ship(df.sparkSession)
    names = [f"x{i}" for i in range(len(cols))]
    return narrow.mapInArrow(_mapped(image, names), f"g {narrow.schema['g'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))


def _first_bins(imgs: DataFrame, k: int) -> DataFrame:
    """(g, col, prefix 0, digit, n) of the first bits; digit null counts the gaps."""
    entries = [F.struct(F.lit(i).alias("col"), F.shiftrightunsigned(f"x{i}", 64 - DIGIT).alias("digit")) for i in range(k)]
    rows = imgs.select("g", F.inline(F.array(*entries)))
    return rows.groupBy("g", "col", "digit").agg(F.count("*").alias("n")).withColumn("prefix", F.lit(0).cast("long"))


def _next_bins(imgs: DataFrame, cells: DataFrame, shift: int) -> DataFrame:
    """(g, col, prefix, digit, n) of the bits at ``shift`` for rows that have a target's earlier bits."""
    mask = (1 << DIGIT) - 1
    k = len(imgs.columns) - 1
    told = cut_lineage(cells.groupBy("g").agg(F.collect_list(F.struct("col", "prefix")).alias("cells")))  # a few for each column and quantile
    size = told.agg(F.sum(64 + 32 * F.size("cells"))).first()[0] or 0
    told = told.withColumnRenamed("g", "h")
    every = imgs.select("g", F.array(*[f"x{i}" for i in range(k)]).alias("x"))
    rows = every.join(F.broadcast(told) if size <= BROADCAST_BYTES else told, F.col("g").eqNullSafe(F.col("h")))
    rows = rows.select("g", "x", F.inline("cells")).withColumn("x", F.get("x", F.col("col")))
    digit = F.shiftrightunsigned("x", shift).bitwiseAND(F.lit(mask).cast("long"))
    rows = rows.where(F.shiftrightunsigned("x", shift + DIGIT) == F.col("prefix")).select("g", "col", "prefix", digit.alias("digit"))
    return rows.groupBy("g", "col", "prefix", "digit").agg(F.count("*").alias("n"))


def _counted(cells: list[tuple], shift: int, single: bool):
    """Per task (cell, digit, n) of the bits at ``shift`` of the rows in each cell (group, column, earlier bits)."""
    groups: dict = {}
    for i, (g, col, prefix) in enumerate(cells):
        groups.setdefault(g, {}).setdefault(col, []).append((i, prefix))

    def run(batches):
        total = np.zeros((len(cells), 1 << DIGIT), np.int64)
        for b in batches:
            for g, cols in groups.items():
                if not single:
                    part = b.filter(pc.is_null(b.column(0)) if g is None else pc.fill_null(pc.equal(b.column(0), pa.scalar(g, b.column(0).type)), False))
                else:
                    part = b
                for col, mine in cols.items():
                    x = part.column(col + 1).drop_null().to_numpy().view(np.uint64)
                    before = x >> np.uint64(shift + DIGIT) if shift + DIGIT < 64 else np.zeros(len(x), np.uint64)
                    for i, prefix in mine:
                        hit = x[before == np.uint64(prefix)]
                        total[i] += np.bincount(((hit >> np.uint64(shift)) & np.uint64((1 << DIGIT) - 1)).astype(np.int64), minlength=1 << DIGIT)
        cell, digit = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(digit.astype(np.int32)), pa.array(total[cell, digit])], names=["cell", "digit", "n"])
    return run


def _few(imgs: DataFrame, groups: list, cols: Sequence[int], probs: Sequence[float]) -> dict:
    """{(group, column, quantile): value} where all cells fit in one table: each pass is one job, whose result, at most 65,536
    counts a cell, goes to the driver."""
    single = groups == [None]
    at = {(g, c): [(0, None, None)] for g in groups for c in cols}   # (prefix, rank within it, target)
    for p in range(PASSES):
        cells = sorted({(key, prefix) for key, ts in at.items() for prefix, _, _ in ts}, key=str)
        number = {cell: i for i, cell in enumerate(cells)}
        got = imgs.mapInArrow(_counted([(*key, prefix) for key, prefix in cells], 64 - DIGIT * (p + 1), single), "cell int, digit int, n long").groupBy("cell", "digit").agg(F.sum("n").alias("n")).toArrow()
        cell, digit, n = (got.column(c).to_numpy() for c in ("cell", "digit", "n"))
        order = np.lexsort((digit, cell))
        cell, digit, n = cell[order], digit[order], n[order]
        ends = np.searchsorted(cell, np.arange(len(cells) + 1))
        new: dict = {}
        for key, ts in at.items():
            for prefix, rank, target in ts:
                i = number[key, prefix]
                d, run = digit[ends[i]:ends[i + 1]], np.cumsum(n[ends[i]:ends[i + 1]])
                if not len(d):
                    continue
                wanted = [(rank, target)]
                if p == 0:
                    size = int(run[-1])
                    places = [(q, q * (size - 1)) for q in probs]
                    wanted = [(k, (q, side, x - math.floor(x))) for q, x in places for side, k in enumerate((math.floor(x), min(math.floor(x) + 1, size - 1)))]
                for k, t in wanted:
                    j = int(np.searchsorted(run, k, "right"))
                    new.setdefault(key, []).append((prefix << DIGIT | int(d[j]), k - (int(run[j - 1]) if j else 0), t))
        at = new
    out = {}
    for (g, c), ts in at.items():
        ends = {(q, side): (float(number_of(prefix)), frac) for prefix, _, (q, side, frac) in ts}
        for q in probs:
            (lo, frac), (hi, _) = ends[q, 0], ends[q, 1]
            out[g, c, q] = lo if lo == hi or frac == 0 else lo + frac * (hi - lo)
    return out


def number_of(img: int) -> float:
    return number(np.array([img], np.uint64).view(np.int64))[0]


def _chosen(bins: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets (g, col, prob, side, k, prefix) one digit further: the bin that holds rank k, k within it."""
    cell = Window.partitionBy("g", "col", "prefix").orderBy("digit")
    run = bins.where("digit is not null").withColumn("to", F.sum("n").over(cell))
    b, t = run.alias("b"), targets.alias("t")
    same = F.col("b.g").eqNullSafe(F.col("t.g")) & (F.col("b.col") == F.col("t.col")) & (F.col("b.prefix") == F.col("t.prefix"))
    here = (F.col("t.k") < F.col("b.to")) & (F.col("t.k") >= F.col("b.to") - F.col("b.n"))
    return b.join(t, same).where(here).select("t.g", "t.col", "t.prob", "t.side", "t.frac", (F.col("t.k") - F.col("b.to") + F.col("b.n")).alias("k"),
                                              F.shiftleft("b.prefix", DIGIT).bitwiseOR(F.col("b.digit")).alias("prefix"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / DuckDB ``quantile_cont``).

    Returns (``by``?, feature, prob, value).  ``by`` may have any number of groups, a null group included.  NULLs are skipped;
    NaN counts as the largest number; a column without values gives NULL.
    """
    cols = list(dict.fromkeys(cols))
    imgs = _images(df, cols, by).persist()
    try:
        out = _selected(imgs, cols, probs)
    finally:
        imgs.unpersist()
    return out.withColumnRenamed("g", by) if by else out.drop("g")


def _selected(imgs: DataFrame, cols: list[str], probs: Sequence[float]) -> DataFrame:
    """(g, feature, prob, value) from images (see ``_images``); a frame without groups has the null group alone."""
    spark, probs = imgs.sparkSession, sorted({float(p) for p in probs})
    kind = imgs.schema["g"].dataType.simpleString()
    schema = f"g {kind}, feature string, prob double, value double"
    each = 2 * len(probs)   # cells of a column and group at most
    groups = [None] if kind == "void" else [r.g for r in imgs.select("g").distinct().limit(CELLS // each + 1).collect()]
    if len(groups) * each <= CELLS:
        got, step = {}, max(1, CELLS // (each * max(1, len(groups))))
        for lo in range(0, len(cols), step):
            got.update(_few(imgs, groups, range(lo, min(lo + step, len(cols))), probs))
        return spark.createDataFrame([(g, c, q, got.get((g, i, q))) for g in groups for i, c in enumerate(cols) for q in probs], schema)
    first = _first_bins(imgs, len(cols)).persist()
    every = cut_lineage(first.select("g").distinct())
    size = F.coalesce(F.sum(F.when(F.col("digit").isNotNull(), F.col("n"))), F.lit(0)).alias("size")
    count = first.groupBy("g", "col").agg(size).where("size > 0").withColumn("prob", F.explode(F.array(*map(F.lit, probs))))
    place = F.col("prob") * (F.col("size") - 1)
    low = F.floor(place).cast("long")
    sides = F.array(F.struct(F.lit(0).alias("side"), low.alias("k")), F.struct(F.lit(1).alias("side"), F.least(low + 1, F.col("size") - 1).alias("k")))
    targets = count.select("g", "col", "prob", (place - F.floor(place)).alias("frac"), F.inline(sides)).withColumn("prefix", F.lit(0).cast("long"))
    bins = first
    for p in range(1, PASSES + 1):
        targets = cut_lineage(_chosen(bins, targets))
        if p < PASSES:
            bins = _next_bins(imgs, targets.select("g", "col", "prefix").distinct(), 64 - DIGIT * (p + 1))
    first.unpersist()
    found = f"g {kind}, col int, prob double, side int, frac double, k long, prefix long"
    plain = targets.select("g", "col", "prob", "side", "frac", "k", "prefix", F.col("prefix").alias("value")).mapInArrow(_mapped(number, ["value"]), f"{found}, value double")
    side = lambda s: F.max(F.when(F.col("side") == s, F.col("value"))).alias(f"v{s}")
    pairs = plain.groupBy("g", "col", "prob").agg(side(0), side(1), F.max("frac").alias("frac"))
    value = F.when((F.col("v0") == F.col("v1")) | (F.col("frac") == 0), F.col("v0")).otherwise(F.col("v0") + F.col("frac") * (F.col("v1") - F.col("v0")))
    grid = [F.struct(F.lit(i).alias("i"), F.lit(c).alias("feature"), F.lit(q).alias("q")) for i, c in enumerate(cols) for q in probs]
    every = every.select(F.col("g").alias("h"), F.inline(F.array(*grid)))
    same = F.col("h").eqNullSafe(F.col("g")) & (F.col("i") == F.col("col")) & (F.col("q") == F.col("prob"))
    return every.join(pairs.withColumn("value", value), same, "left").select(F.col("h").alias("g"), "feature", F.col("q").alias("prob"), "value")


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """{(feature, prob): value} for a whole frame."""
    return {(r["feature"], r["prob"]): r["value"] for r in quantile_table(df, cols, probs).collect()}


def sequential_iqrs(df: DataFrame, cols: Sequence[str], cut) -> list[float | None]:
    """For each column in turn ``cut(Q3 - Q1)`` of the rows that no earlier column's cut removed
    (rows above it go, gaps stay); None where a column has no value.  ``cut`` may give None, too.

    The images are made once; each column's four passes read them from there."""
    cols, out = list(cols), []
    imgs = _images(df, cols, None).persist()
    kept = imgs
    sign = F.lit(-(1 << 63))
    try:
        for i, c in enumerate(cols):
            q = {r.prob: r.value for r in _selected(kept.select("g", F.col(f"x{i}").alias("x0")), [c], [0.25, 0.75]).collect()}
            at = None if q[0.25] is None else cut(q[0.75] - q[0.25])
            out.append(at)
            if at is not None:
                most = int(image(np.array([at]))[0]) ^ -(1 << 63)  # signed order from here
                kept = kept.where(~F.coalesce(F.col(f"x{i}").bitwiseXOR(sign) > F.lit(most), F.lit(False)))
    finally:
        imgs.unpersist()
    return out
