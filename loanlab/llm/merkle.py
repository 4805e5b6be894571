"""Operator 13: Merkle dataset manifest by slot pivot.

Rows are leaves; a leaf is the SHA-256 of its fields, each with its length.  Within a group leaves ascend by id; runs of
``fanout`` consecutive nodes become one parent, level by level, until one node, the subroot, remains.  Subroots
ordered by group are the leaves of a second tree, whose top is the root.

Places come from one range-partitioned sort: a row's place is its number within its partition plus the sizes of
the group's earlier partitions, so no group is gathered in one task.  One pivot covers as many levels as
fit in ``SLOTS`` columns: conditional aggregates spread the nodes under one ancestor into slot columns,
concatenated columns hash to the columns of the next level, and a node's siblings are the columns
of its run without its own.  Upwards only the ancestors go on; downwards each pivot row meets its ancestor's
path (one row to one row) and is spread into its slots again, so a table of levels is a sixteenth of the one before.

Defined results: null fields are hashed as ``-``; a null group comes first and is a group of its own; null ids come
first; equal ids are ordered by their leaf; repeated rows are leaves of their own with equal leaf hashes; an empty
table gives no rows; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlab.llm.text import broadcast_if_small, reliable

FANOUT = 2
SLOTS = 16          # columns of one pivot at most, unless the fanout alone is larger
DIGEST = 64         # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 over the fields: ``-`` for null, else UTF-8 length, ``:`` and the value."""
    def coded(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return _sha(*[coded(c) for c in fields])


def placed(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df`` with ``place`` (from 0, within the group, in the order given) and ``size`` of the group."""
    rows = df.orderBy(group, *order).withColumn("_n", F.monotonically_increasing_id())  # partition number, then row number
    rows = reliable(rows.withColumn("_part", F.shiftright("_n", 33)))
    parts = rows.groupBy(group, "_part").agg(F.min("_n").alias("_least"), F.count("*").alias("_rows"))
    same = Window.partitionBy(group)
    before = F.coalesce(F.sum("_rows").over(same.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = reliable(parts.select(group, "_part", (before - F.col("_least")).alias("_shift"), F.sum("_rows").over(same).alias("size")))
    out = rows.join(broadcast_if_small(parts, 256), [group, "_part"])
    return out.withColumn("place", F.col("_n") + F.col("_shift")).drop("_n", "_part", "_shift")


def _above(size: Column, fanout: int) -> Column:
    """Nodes one level up."""
    return F.floor((size + (fanout - 1)) / F.lit(fanout)).cast("long")


def _levels(fanout: int) -> int:
    """Levels of one pivot: the most whose slots fit."""
    n = 1
    while fanout ** (n + 1) <= SLOTS:
        n += 1
    return n


def _pivot(nodes: DataFrame, group: str, fanout: int, levels: int) -> DataFrame:
    """One row for each ancestor ``levels`` up: columns c0_0, c0_1, ... (structs with ``hash``), the levels
    c1_*, ... between (digests), ``top`` (the ancestor itself), ``up`` (its place), ``size`` and ``size_up``."""
    slots = fanout ** levels
    up = F.floor(F.col("place") / F.lit(slots)).cast("long")
    spread = [F.max(F.when(F.col("place") - F.col("up") * slots == s, F.col("node"))).alias(f"c0_{s}") for s in range(slots)]
    rows = nodes.withColumn("up", up).groupBy(group, "up", "size").agg(*spread).withColumn("size_up", F.col("size"))
    at = lambda k, j: F.col(f"c0_{j}.hash") if k == 0 else F.col(f"c{k}_{j}")
    for k in range(1, levels + 1):
        made = {}
        for j in range(slots // fanout ** k):
            run = [at(k - 1, j * fanout + r) for r in range(fanout)]
            parent = F.when(run[0].isNotNull(), _sha(*[F.coalesce(c, F.lit("")) for c in run]))
            made[f"c{k}_{j}"] = F.when(F.col("size_up") == 1, run[0]).otherwise(parent)  # a lone node is done
        rows = rows.withColumns(made).withColumn("size_up", _above(F.col("size_up"), fanout))
    return rows.withColumnRenamed(f"c{levels}_0", "top")


def _spread(rows: DataFrame, group: str, fanout: int, levels: int) -> DataFrame:
    """Pivot rows with their ancestor's ``path`` back to nodes: group, place, node, path (siblings, from here up)."""
    slots = fanout ** levels
    at = lambda k, j: F.col(f"c0_{j}.hash") if k == 0 else F.col(f"c{k}_{j}")

    def siblings(s: int) -> list[Column]:
        out = []
        for k in range(levels):
            own = s // fanout ** k
            first = own - own % fanout
            out += [F.coalesce(at(k, j), F.lit("")) for j in range(first, first + fanout) if j != own]
        return out
    made = [F.when(F.col(f"c0_{s}").isNotNull(), F.struct((F.col("up") * slots + s).alias("place"), F.col(f"c0_{s}").alias("node"), F.concat(*siblings(s), F.col("path")).alias("path"))) for s in range(slots)]
    return rows.select(group, F.explode(F.array(*made)).alias("x")).where("x is not null").select(group, "x.*")


def tree(nodes: DataFrame, group: str, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes`` (group, place, size and the struct ``node``, whose field ``hash`` counts).

    Returns (group, place, node, path) with the siblings' digests of each node joined from its own level to the top,
    left to right, and (group, top) with each group's top.
    """
    levels = _levels(fanout)
    most = nodes.agg(F.max("size")).first()[0] or 0
    pivots = []
    while True:
        rows = reliable(_pivot(nodes, group, fanout, levels))
        pivots.append(rows)
        if most <= fanout ** levels:
            break
        most = -(-most // fanout ** levels)
        nodes = rows.select(group, F.col("up").alias("place"), F.col("size_up").alias("size"), F.struct(F.col("top").alias("hash")).alias("node"))
    tops = pivots[-1].select(group, "top")
    below = pivots[-1].withColumn("path", F.lit(""))
    for rows in reversed(pivots[:-1]):
        paths = reliable(_spread(below, group, fanout, levels).select(group, F.col("place").alias("up"), "path"))
        size = paths.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
        below = rows.join(broadcast_if_small(paths, -(-size // max(1, paths.count()))), [group, "up"])
    return _spread(below, group, fanout, levels), tops


def folded(start: Column, path: Column, place: Column, size: Column, fanout: int, levels: int) -> Column:
    """The top that a node with digest ``start`` at ``place`` of ``size`` nodes gives with the siblings in ``path``."""
    def step(a, _):
        slot = a["place"] % fanout
        run = F.least(F.lit(fanout).cast("long"), a["size"] - a["place"] + slot)
        left = F.substring(path, (a["at"] + 1).cast("int"), (slot * DIGEST).cast("int"))
        right = F.substring(path, (a["at"] + slot * DIGEST + 1).cast("int"), ((run - 1 - slot) * DIGEST).cast("int"))
        done = a["size"] <= 1
        return F.struct(F.when(done, a["hash"]).otherwise(_sha(left, a["hash"], right)).alias("hash"), F.when(done, a["at"]).otherwise(a["at"] + (run - 1) * DIGEST).alias("at"),
                        F.floor(a["place"] / F.lit(fanout)).cast("long").alias("place"), _above(a["size"], fanout).alias("size"))
    begin = F.struct(start.alias("hash"), F.lit(0).cast("long").alias("at"), place.cast("long").alias("place"), size.cast("long").alias("size"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, levels))), begin, step, lambda a: a["hash"])


def _height(size: int, fanout: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // fanout), n + 1
    return n


def manifest(df: DataFrame, id_col: str, group_col: str, leaf: Column, offered: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """id, leaf, subroot, root, path (the siblings, from the leaf to the root), folded_root and verified per row.

    ``folded_root`` is folded from ``offered`` (default: the leaf itself) and the siblings of the true tree.
    """
    key = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("."), F.col(group_col).cast("string")))
    rows = df.select(key.alias("g"), F.col(id_col).alias("id"), leaf.alias("hash"), (leaf if offered is None else offered).alias("offered"))
    rows = placed(rows, "g", "id", "hash")
    nodes = rows.select("g", "place", "size", F.struct("hash", "id", "offered", "place", "size").alias("node"))
    below, tops = tree(nodes, "g", fanout)
    groups = placed(tops.withColumn("one", F.lit(1)), "one", "g")
    groups = reliable(groups.select("one", "place", "size", F.struct(F.col("top").alias("hash"), "g", "place", "size").alias("node")))
    over, root = tree(groups, "one", fanout)
    root = root.first()
    over = reliable(over.select("node.g", F.col("node.hash").alias("subroot"), F.col("node.place").alias("g_place"), F.col("node.size").alias("g_size"), F.col("path").alias("g_path")))
    most, n_groups = (x or 0 for x in (nodes.agg(F.max("size")).first()[0], over.count()))
    out = below.select("g", F.col("node").alias("n"), "path").join(broadcast_if_small(over, 512 + DIGEST * fanout * (1 + _height(n_groups, fanout))), "g")
    sub = folded(F.col("n.offered"), F.col("path"), F.col("n.place"), F.col("n.size"), fanout, _height(most, fanout))
    out = out.withColumn("folded", sub)
    top = folded(F.col("folded"), F.col("g_path"), F.col("g_place"), F.col("g_size"), fanout, _height(n_groups, fanout))
    out = out.select(F.col("n.id").alias("id"), F.col("n.hash").alias("leaf"), "subroot", F.lit(root.top if root else None).alias("root"), F.concat("path", "g_path").alias("path"), top.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The contracted check of ``documents``: trees by lang, and a fold with one character more in n_chars
    where 7 divides the unsigned crc32 of the decimal doc_id (null ids and counts stay)."""
    docs = docs.select(*FIELDS)
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    offered = F.when(changed, F.col("n_chars").cast("long") + 1).otherwise(F.col("n_chars").cast("long"))
    fields = lambda n: leaf_hash(*[n if f == "n_chars" else F.col(f) for f in FIELDS])
    out = manifest(docs, "doc_id", "lang", fields(F.col("n_chars")), fields(offered), fanout)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("path", 256).alias("proof_sha256"), "folded_root", "verified")
