"""Merkle dataset manifest with checkpoints (operator 11).

Every row is a leaf, every source a tree of ``FAN_OUT`` children a node over its
leaves in id order, and the roots of the sources, in source order, are the
leaves of a tree of their own whose root stands for the whole table.

*Checkpoint and recompute.*  A tree keeps only every ``STEP``-th level, as Parquet
tables of *blocks*: the ``FAN_OUT ** STEP`` aligned stored nodes under one stored
parent.  A proof needs the levels between as well; ``descend`` makes them again
from a block's stored nodes, emits each node's siblings, and keeps none of them.
A block is the unit of every grouping, so a source that holds most rows is many
small groups, and the upper part of a path, which all rows below a node share,
is joined once a block and not once a row.

*Numbering.*  Rows get their place in a source from one range sort and a count
per partition: only a partition's first source can have begun in an earlier
one, so one number a partition reaches the driver, however many rows, sources
or levels there are.

A path is an array of ``struct<before, after>``, one for each level from leaf to
root: the concatenated digests of the siblings left and right of the node.

Defined cases: a null in any column is ``-`` in its leaf; null ids come first in
their source and are never tampered with in the query; rows that share an id
are ordered by their leaf, rows that are equal altogether have equal leaves and
take neighbouring places in any order; a source of one row has that leaf as its
root, one source has its root as the table's; an empty table has no root and no
proofs; a long text is hashed where it is read and never shuffled; columns
beyond the hashed ones are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisor.llm.common import staged
from revisor.session import release, stage_dir

FAN_OUT = 16
STEP = 2  # a level is stored, the next STEP - 1 are made again when a proof asks for them
BLOCK = FAN_OUT ** STEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<before: string, after: string>>"


def digest(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def field(column: Column) -> Column:
    """Unambiguous form of a value: its length in UTF-8 bytes, a colon and the value; ``-`` for null."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    """Digest of one row's fields."""
    return digest(F.concat(*[field(c) for c in columns]))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, start, lambda node, level: digest(F.concat(level.before, node, level.after)))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda level: F.concat(level.before, level.after))))


def numbered(rows: DataFrame, tree: str, *order: str) -> tuple[DataFrame, str]:
    """``rows`` with ``pos``, the place of each within its ``tree`` (not null) in ``order``, from 0; a folder it reads."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = len(rows.columns)
    key = rows.columns.index(tree)

    def count(batches):
        part, seen, last, place, first = TaskContext.get().partitionId(), 0, None, 0, None
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            own = batch.column(key)
            first = own[0].as_py() if first is None else first
            begins = np.r_[own[0].as_py() != last,
                           pc.not_equal(own.slice(1), own.slice(0, size - 1)).to_numpy(zero_copy_only=False)]
            at = np.arange(size)
            places = at - np.maximum.accumulate(np.where(begins, at, 0))
            ahead = int(begins.argmax()) if begins.any() else size
            places[:ahead] += place
            leads = pc.equal(own, pa.scalar(first, own.type))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(size, part)), pa.array(at + seen), pa.array(places), leads],
                names=[*batch.schema.names, "part", "nth", "place", "leads"])
            seen, last, place = seen + size, own[-1].as_py(), int(places[-1]) + 1

    plain = rows.toDF(*[f"c{i}" for i in range(n)])
    names = dict(zip(rows.columns, plain.columns))
    by = [names[c] for c in (tree, *order)]
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes) + ", part long, nth long, place long, leads boolean"
    placed, path = staged(plain.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(count, schema), "merkle-order")
    # one row a partition reaches the driver
    ends = placed.groupBy("part").agg(
        F.min_by(names[tree], "nth").alias("first"), F.max_by(names[tree], "nth").alias("last"),
        F.count_if("leads").alias("in_first"), (F.max_by("place", "nth") + 1).alias("in_last")).orderBy("part").collect()
    before, tail, offsets = None, 0, []
    for end in ends:
        offset = tail if end["first"] == before else 0
        offsets.append((end["part"], offset))
        tail = offset + end["in_first"] if end["first"] == end["last"] else end["in_last"]
        before = end["last"]
    shift = F.broadcast(spark.createDataFrame(offsets or [(-1, 0)], "part long, ahead long"))
    pos = F.col("place") + F.when(F.col("leads"), F.col("ahead")).otherwise(F.lit(0))
    return placed.join(shift, "part").select(*[F.col(names[c]).alias(c) for c in rows.columns], pos.alias("pos")), path


def blocks(nodes: DataFrame, *payload: str) -> DataFrame:
    """(tree, block, nodes) of (tree, pos, node): the stored nodes under one stored parent, in order."""
    own = F.struct("pos", "node", *payload)
    return nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(own)).alias("nodes"))


def _inner(rows: DataFrame) -> DataFrame:
    """The blocks with ``inner``, the digests one level above their nodes, and ``whole``: that level is the root's."""
    runs = F.sequence(F.lit(0), F.ceil(F.size("nodes") / FAN_OUT).cast("int") - 1)
    inner = F.transform(runs, lambda k: digest(F.concat_ws("", F.transform(
        F.slice("nodes", k * FAN_OUT + 1, FAN_OUT), lambda x: x.node))))
    return rows.select("*", inner.alias("inner"), ((F.col("block") == 0) & (F.size("nodes") <= FAN_OUT)).alias("whole"))


def _lone() -> Column:
    """A tree of this one node."""
    return (F.col("block") == 0) & (F.size("nodes") == 1)


class Tree:
    """The stored levels of many trees: ``levels[k]`` holds the blocks of level ``k * STEP``."""

    def __init__(self, folder: str, levels: list[DataFrame]):
        self.folder, self.levels = folder, levels

    @classmethod
    def grow(cls, folder: str, bottom: DataFrame) -> Tree:
        """Store the blocks of the lowest level, then every ``STEP``-th level above, until each tree has one node."""
        spark, levels, rows = bottom.sparkSession, [], bottom
        while True:
            path = f"{folder}/level={len(levels) * STEP}"
            rows.write.parquet(path)
            levels.append(spark.read.schema(rows.schema).parquet(path))
            open_ = levels[-1].filter(~_lone())
            if open_.isEmpty():
                return cls(folder, levels)
            node = F.when(F.col("whole"), F.col("inner")[0]).otherwise(digest(F.concat_ws("", "inner")))
            rows = blocks(_inner(open_).select("tree", F.col("block").alias("pos"), node.alias("node")))

    def roots(self) -> DataFrame:
        """(tree, node): one row a tree."""
        every = [level.filter(_lone()).select("tree", F.col("nodes")[0]["node"].alias("node")) for level in self.levels]
        found = every[0]
        for more in every[1:]:
            found = found.unionByName(more)
        return found

    def descend(self, tops: DataFrame) -> DataFrame:
        """(tree, x, path) of every node ``x`` of the lowest level, with ``tops``' (tree, path) above the roots.

        ``tops`` may have more columns, one value a tree; they are kept.
        """
        more = [c for c in tops.columns if c not in ("tree", "path")]
        above = None
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            found = (level.filter(_lone()).select("tree", F.col("nodes")[0].alias("x"))
                     .join(tops, "tree").select("tree", "x", "path", *more))
            if above is not None:
                under = above.select("tree", F.col("x.pos").alias("block"), "path", *more)
                runs = (_inner(level.filter(~_lone())).join(under, ["tree", "block"])
                        .select("*", F.explode(F.sequence(F.lit(0), F.size("inner") - 1)).alias("run")))
                up = F.struct(F.concat_ws("", F.slice("inner", F.lit(1), F.col("run"))).alias("before"),
                              F.concat_ws("", F.slice("inner", F.col("run") + 2, FAN_OUT)).alias("after"))
                runs = runs.select("tree", F.slice("nodes", F.col("run") * FAN_OUT + 1, FAN_OUT).alias("own"), *more,
                                   F.when(F.col("whole"), F.col("path")).otherwise(F.concat(F.array(up), "path")).alias("path"))
                runs = runs.select("tree", "path", *more, F.transform("own", lambda x: x.node).alias("digests"),
                                   F.posexplode("own").alias("at", "x"))
                here = F.struct(F.concat_ws("", F.slice("digests", F.lit(1), F.col("at"))).alias("before"),
                                F.concat_ws("", F.slice("digests", F.col("at") + 2, FAN_OUT)).alias("after"))
                found = found.unionByName(runs.select("tree", "x", F.concat(F.array(here), "path").alias("path"), *more))
            above = found
            if k:
                above, _ = staged(found, "merkle-paths")
        return above


class Manifest:
    """The trees of a table's sources and the tree over them, stored under one folder.

    ``write`` makes them from rows, ``proofs`` reads them; nothing else is kept.
    """

    def __init__(self, sources: Tree, top: Tree):
        self.sources, self.top = sources, top

    @classmethod
    def write(cls, leaves: DataFrame, *payload: str, folder: str | None = None) -> Manifest:
        """Manifest of (doc_id, source, node) rows; ``payload`` columns come back with the proofs.

        ``leaves`` is read twice and should be a stored table.
        """
        spark = leaves.sparkSession
        folder = folder or stage_dir(spark, "merkle")
        # the form of a source as in a leaf is a key that is never null; its order is the source's own
        rows = leaves.select("source", "doc_id", "node", *payload, field(F.col("source")).alias("tree"))
        placed, by_source = numbered(rows, "tree", "doc_id", "node")
        sources = Tree.grow(f"{folder}/sources", blocks(placed, "doc_id", "source", *payload))
        firsts = sources.levels[0].filter("block = 0").select("tree", F.col("nodes")[0]["source"].alias("source"))
        subroots, path = staged(sources.roots().join(firsts, "tree"), "merkle-subroots")
        ordered, by_top = numbered(subroots.select(F.lit("").alias("tree"), "source", "node", F.col("tree").alias("of")), "tree", "source")
        top = Tree.grow(f"{folder}/top", blocks(ordered, "of"))
        release(spark, path, by_source, by_top)
        return cls(sources, top)

    def root(self) -> str | None:
        found = self.top.roots().first()
        return found["node"] if found else None

    def proofs(self) -> DataFrame:
        """One row a leaf: ``x`` (``pos, node, doc_id, source`` and the payload), ``subroot``, ``root`` and ``path``."""
        spark = self.top.levels[0].sparkSession
        # a path above the root is empty, and there is one root
        start = spark.createDataFrame([("", [])], f"tree string, path {PATH}")
        tops = self.top.descend(start).select(F.col("x.of").alias("tree"), F.col("x.node").alias("subroot"), "path")
        tops, _ = staged(tops, "merkle-tops")
        return self.sources.descend(tops).withColumn("root", F.lit(self.root()).cast("string"))


def checked(docs: DataFrame, tampered: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Proofs of every row, and the root that the row leads to where ``tampered`` lower-cases its text's A-Z.

    The first two ``fields`` are id and source, the last is the text.  Texts are
    read once; the narrow rows that hold their digests are all that moves.
    """
    columns = [docs[c] for c in fields]
    lower = F.translate(columns[-1].cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(columns[0].alias("doc_id"), columns[1].alias("source"), leaf(*columns).alias("node"),
                       F.when(tampered, leaf(*columns[:-1], lower)).alias("other"))
    leaves, path = staged(rows, "merkle-leaves")
    found = Manifest.write(leaves, "other").proofs()
    release(leaves.sparkSession, path)
    out = found.select("x.doc_id", F.col("x.node").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       fold(F.coalesce("x.other", "x.node"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
