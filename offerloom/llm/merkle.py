"""Merkle manifest of a document table, by checkpoint and recompute.

Every row is a leaf; the leaves of a language form a binary tree, and the roots of the languages form one more. Of
each tree only every ``TIER``-th level is stored. A proof needs nodes of all levels: the aligned subtree below a
stored node has at most 2**TIER stored descendants, so one task regenerates its inner nodes from them, emits the
siblings and discards the rest. Proofs run from the top tier down, each tier handing its paths to the one below.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from offerloom.llm.common import broadcast_within, stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels between two stored ones; a task holds at most 2**TIER nodes of one subtree.
TIER = 10
#: How a path marks each level: sibling to the left, to the right, or none.
LEFT, RIGHT, ALONE = "<", ">", "-"
HEX = 64
NODE = "tree string, pos long, size long, digest string"


@dataclass(frozen=True)
class Manifest:
    """leaves: tree (the language), pos, size (leaves of the tree), digest and the columns kept of the rows.
    tiers, top: the stored levels of the language trees and of the tree above them; root is null without rows."""
    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(*values: Column) -> Column:
    """Digest of a row: ``-`` for a null, else the UTF-8 byte count, a colon and the value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*(part(v) for v in values)), 256)


def _levels(size: int, most: int) -> int:
    """Levels that one tier climbs above ``size`` nodes of a tree."""
    return min(most, (size - 1).bit_length())


def _climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the levels above them; two consecutive nodes, or the last one alone, give their hash."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_hash("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return out


def numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Adds pos and size: the rank of a row among the rows of its tree, gapless from 0, and their number.

    Rows are dealt by ranges of (tree, order, a row number), so neither a tree nor a value of the order has to fit
    one task; what is counted per tree and range is as small as the number of ranges plus that of trees.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order, "tie")]
    dealt = stored(rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
                   .withColumn("part", F.spark_partition_id()), label)
    by_tree = Window.partitionBy("tree")
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("n")).select(
        F.col("tree").alias("t"), F.col("part").alias("p"), F.sum("n").over(by_tree).alias("size"),
        (F.sum("n").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    near = dealt.join(broadcast_within(counts, 100_000), F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p")))
    at = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*keys[1:]))
    return near.withColumn("pos", F.col("before") + at - 1).drop("t", "p", "part", "tie", "before")


def _forest(leaves: DataFrame, tier: int, label: str) -> list[DataFrame]:
    """The stored levels above the leaves, every ``tier`` levels one, until each tree has a single node."""
    def parent(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("pos")
        size, pos = nodes["size"][0].as_py(), nodes["pos"][0].as_py()
        top = _climb(nodes["digest"].to_pylist(), _levels(size, tier))[-1]
        return pa.table({"tree": nodes["tree"][:1].cast(pa.string()), "pos": [pos >> tier], "size": [-(-size >> tier)],
                         "digest": top}, pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.string())]))

    tiers = [leaves]
    while tiers[-1].where("size > 1").limit(1).count():
        below = tiers[-1].where("size > 1").select("tree", "pos", "size", "digest")
        tiers.append(stored(below.groupBy("tree", F.shiftright("pos", tier).alias("block"))
                            .applyInArrow(parent, NODE), label))
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    out = tiers[0].where("size = 1").select("tree", "digest")
    for t in tiers[1:]:
        out = out.unionByName(t.where("size = 1").select("tree", "digest"))
    return out


def build(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tree: str = "lang", order: str = "doc_id",
          keep: dict[str, Column] | None = None, tier: int = TIER) -> Manifest:
    """The manifest of a table: leaves over ``columns``, one tree per value of ``tree``, leaves ascending by ``order``.

    Nulls come first in both orders; rows that share a tree and an order value stand by digest, and equal rows are as
    many leaves. An empty table has no root. ``keep`` names further columns to carry with the leaves.
    """
    keep = keep or {}
    rows = docs.select(F.col(tree).cast("string").alias("tree"), F.col(order).alias("order_key"),
                       leaf(*(F.col(c) for c in columns)).alias("digest"), *(c.alias(k) for k, c in keep.items()))
    leaves = stored(numbered(rows, ["order_key", "digest"], "merkle-order"), "merkle-leaves")
    tiers = _forest(leaves, tier, "merkle-tier")
    subroots = stored(_roots(tiers), "merkle-subroots")
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    above = stored(numbered(named, ["name"], "merkle-top-order"), "merkle-top-leaves")
    top = _forest(above, tier, "merkle-top")
    root = _roots(top).first()
    return Manifest(leaves, tiers, subroots, top, root["digest"] if root else None)


def _emitter(schema: pa.Schema, tier: int):
    def emit(nodes: pa.Table, above: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return schema.empty_table()
        nodes = nodes.sort_by("pos")
        rest, subroot = (above[c][0].as_py() for c in ("path", "subroot"))
        levels = _climb(nodes["digest"].to_pylist(), _levels(nodes["size"][0].as_py(), tier))
        wanted = nodes["wanted"].to_pylist() if "wanted" in nodes.column_names else [True] * nodes.num_rows
        paths = []
        for i, w in enumerate(wanted):
            path = []
            for level in levels[:-1] if w else ():
                other = i ^ 1
                path.append(ALONE if other >= len(level) else (LEFT if i & 1 else RIGHT) + level[other])
                i >>= 1
            paths.append("".join(path) + rest if w else "")
        out = nodes.append_column("path", pa.array(paths, pa.string())).append_column(
            "subroot", pa.array([subroot] * len(paths), pa.string()))
        return out.filter(pa.array(wanted)).select(schema.names).cast(schema)
    return emit


def _descend(tiers: list[DataFrame], start: DataFrame, tier: int, wanted: Column | None = None) -> DataFrame:
    """Adds path and subroot to the nodes of the lowest tier; ``start`` (tree, path, subroot) has those of each root."""
    above = None
    for k in range(len(tiers) - 1, -1, -1):
        nodes = tiers[k]
        out = StructType([*nodes.schema.fields, *StructType.fromDDL("path string, subroot string").fields])
        ended = nodes.where("size = 1").select(F.col("tree").alias("t"))
        handed = start.join(ended, F.col("tree").eqNullSafe(F.col("t")), "left_semi").select(
            "tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
        if above is not None:
            handed = handed.unionByName(above.select("tree", F.col("pos").alias("block"), "path", "subroot"))
        nodes = nodes.withColumn("block", F.shiftright("pos", tier))
        if k == 0 and wanted is not None:
            nodes = nodes.withColumn("wanted", F.coalesce(wanted, F.lit(False)))
            used = nodes.where("wanted").select(F.col("tree").alias("t"), F.col("block").alias("b")).distinct()
            nodes = nodes.join(used, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b")), "left_semi")
        emit = _emitter(to_arrow_schema(out), tier)
        above = nodes.groupBy("tree", "block").cogroup(handed.groupBy("tree", "block")).applyInArrow(emit, out)
        if k:
            above = stored(above, "merkle-paths")
    return above


def proofs(manifest: Manifest, wanted: Column | None = None, tier: int = TIER) -> DataFrame:
    """The leaves with their proof: path (a mark per level, with the sibling's digest if there is one) and subroot.

    With ``wanted``, a condition on the leaves, only subtrees that hold such a leaf are regenerated.
    """
    one = manifest.top[0].sparkSession.createDataFrame([("", "", "")], "tree string, path string, subroot string")
    top = _descend(manifest.top, one, tier)
    start = top.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"))
    return _descend(manifest.tiers, stored(start, "merkle-start"), tier, wanted)


def fold(digest: str, path: str) -> tuple[str, str]:
    """The root that a leaf digest and its path give, and the siblings in the path, joined."""
    at, siblings = 0, []
    while at < len(path):
        mark = path[at]
        at += 1
        if mark == ALONE:
            digest = _hash(digest)
            continue
        other = path[at:at + HEX]
        at += HEX
        siblings.append(other)
        digest = _hash(other + digest if mark == LEFT else digest + other)
    return digest, "".join(siblings)


def folded(proved: DataFrame, digest: str, columns: list[str]) -> DataFrame:
    """``columns`` of proved leaves, proof_sha256 and folded_root: what the digests in column ``digest`` give with the paths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [fold(d, p) for d, p in zip(batch[0].to_pylist(), batch[1].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array([_hash(s) for _, s in both], pa.string()), pa.array([r for r, _ in both], pa.string())],
                [*columns, "proof_sha256", "folded_root"])

    kept = proved.select(*columns)
    out = StructType([*kept.schema.fields, *StructType.fromDDL("proof_sha256 string, folded_root string").fields])
    return proved.select(digest, "path", *columns).mapInArrow(run, out)


def manifest_digest(docs: DataFrame, tier: int = TIER) -> DataFrame:
    """Per document its leaf, the roots, its proof, and whether the root follows from what an auditor finds.

    What is found is the row itself, but for ids whose crc32 is divisible by 7: there n_chars is one higher (a null
    stays). Null ids are never altered. Rows that repeat are proved each; an empty table gives no rows; other columns are
    not read.
    """
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    higher = F.col("n_chars").cast("decimal(20,0)") + 1
    found = F.when(altered, leaf(F.col("doc_id"), F.col("source"), F.col("lang"), higher, F.col("text")))
    manifest = build(docs, keep={"found": found}, tier=tier)
    proved = proofs(manifest, tier=tier).withColumn("found", F.coalesce("found", "digest"))
    checked = folded(proved, "found", ["order_key", "digest", "subroot"])
    root = F.lit(manifest.root).cast("string")
    return checked.select(
        F.col("order_key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == root).alias("verified"))
