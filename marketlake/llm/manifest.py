"""Merkle manifest of a dataset: a tree over each group's rows, and one over the groups' roots.

Every node is labelled by the interval [lo, hi) of the leaf ranks that it covers. The nodes of a level
lie in buckets of that level's span, so that a node finds its parent by an equality on (tree, bucket)
and the containment of its interval, and at most ``fanout`` nodes meet a parent. A node's siblings are
its parent's interval without its own: the members that end before it, and those that begin behind it.
Digests go up level by level, proofs come down the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged
from marketlake.llm.ranks import ranked

FANOUT = 16
_NODE = ["tree", "n", "lo", "hi", "digest"]
_PATH = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Digest of a row: sha256, lowercase hex, of its encoded values."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


@dataclass(frozen=True)
class Forest:
    """Trees over ranked leaves.

    ``leaves``: tree, n (leaves of the tree), lo, hi, digest and what else came with them.
    ``levels``: from the parents of leaves upwards, (tree, n, lo, hi, digest, members). ``roots``: (tree, digest).
    """

    leaves: DataFrame
    levels: list[DataFrame]
    roots: DataFrame
    fanout: int

    def nodes(self) -> DataFrame:
        """(tree, level, lo, hi, digest) of all nodes: the manifest that is kept beside the data."""
        all_levels = [self.leaves, *self.levels]
        parts = [d.select("tree", F.lit(k).alias("level"), "lo", "hi", "digest") for k, d in enumerate(all_levels)]
        return reduce(DataFrame.unionByName, parts)


def _bucket(span: int) -> Column:
    return F.call_function("div", F.col("lo"), F.lit(span).cast("long"))


def plant(leaves: DataFrame, fanout: int = FANOUT) -> Forest:
    """The trees over (tree, n, lo, digest): as long as a tree has several nodes on a level, each run
    of ``fanout`` becomes one, the last run with what is left. Groups hold ``fanout`` rows at most."""
    leaves = leaves.withColumn("hi", F.col("lo") + 1)
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels, span = leaves.select(*_NODE), [], 1
    roots = [nodes.filter("n = 1")]
    while most > span:
        runs = nodes.filter(F.col("n") > span)
        span *= fanout
        members = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("members")
        parents = runs.groupBy("tree", "n", _bucket(span).alias("_bucket")).agg(members)
        digest = F.sha2(F.array_join(F.col("members.digest"), ""), 256)
        lo, hi = F.array_min("members.lo"), F.array_max("members.hi")
        nodes = staged(parents.select("tree", "n", lo.alias("lo"), hi.alias("hi"), digest.alias("digest"), "members"), "level")
        levels.append(nodes)
        roots.append(nodes.filter(F.col("n") <= span).select(*_NODE))
    return Forest(leaves, levels, reduce(DataFrame.unionByName, roots).select("tree", "digest"), fanout)


def _joined_digests(members: Column) -> Column:
    return F.array_join(F.transform(members, lambda m: m["digest"]), "")


def descend(forest: Forest, above: DataFrame) -> DataFrame:
    """The leaves, all columns, with ``path`` and what else ``above`` has for their tree.

    ``above``: tree, path (the steps above the tree's root) and further columns. A path goes from the
    leaf upwards: per level the siblings' digests to the left and to the right.
    """
    given = [c for c in above.columns if c not in ("tree", "path")]
    parents = None
    for depth in range(len(forest.levels), -1, -1):
        nodes = forest.levels[depth - 1] if depth else forest.leaves
        span = forest.fanout**depth
        # the root of its tree
        found = nodes.filter(F.col("n") <= span).join(above, "tree")
        if parents is not None:
            inner = nodes.filter(F.col("n") > span).withColumn("_bucket", _bucket(span * forest.fanout))
            contained = inner.join(parents, ["tree", "_bucket"]).filter((F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
            left = _joined_digests(F.filter("_members", lambda m: m["hi"] <= F.col("lo")))
            right = _joined_digests(F.filter("_members", lambda m: m["lo"] >= F.col("hi")))
            step = F.array(F.struct(left.alias("left"), right.alias("right")))
            contained = contained.withColumn("path", F.concat(step, F.col("path")))
            found = found.unionByName(contained.select(*found.columns))
        if depth:
            parents = found.select(
                "tree", _bucket(span).alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                F.col("members").alias("_members"), "path", *given,
            )
    return found


def fold(digest: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its path."""
    return F.aggregate(path, digest, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """sha256 of all siblings' digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """``forest`` over the rows of each group, ``top`` over the groups' roots, ``root`` of all (null without rows)."""

    forest: Forest
    top: Forest
    root: str | None

    def proofs(self) -> DataFrame:
        """What each row brought, with leaf, subroot and path (array of left and right siblings, upwards)."""
        start = self.top.roots.select("tree", F.array().cast(_PATH).alias("path"))
        groups = descend(self.top, start).select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "path")
        return descend(self.forest, groups)


def build(rows: DataFrame, leaf: str, group: str, key: str, carry: Sequence[str] = (), fanout: int = FANOUT) -> Manifest:
    """The manifest of rows that have a digest in column ``leaf``.

    Leaves of a group ascend by ``key`` (null first), rows of one key by digest, so that equal keys and
    equal rows have a defined tree; equal rows take neighbouring places. Groups ascend by the UTF-8
    bytes of their value, null first. ``carry`` names columns that stay with the leaves. Only these
    columns are used, whatever others are called. Without rows there are no nodes and no root.
    """
    own = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    named = rows.select(
        F.col(group).cast("string").alias("group"), F.col(key).alias("key"), F.col(leaf).alias("digest"), *own
    ).withColumn("tree", encoded(F.col("group")))
    placed = ranked(named, "tree", [F.col("key").asc_nulls_first(), F.col("digest")], "lo", "n")
    forest = plant(staged(placed, "leaves"), fanout)
    # one first leaf a tree names its group
    subroots = forest.roots.join(forest.leaves.filter("lo = 0").select("tree", "group"), "tree")
    subroots = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_member"), "digest", "group")
    order = [F.col("group").asc_nulls_first()]
    tops = ranked(staged(subroots, "subroots"), "tree", order, "lo", "n")
    tops = tops.select("tree", F.col("_member").alias("group"), "digest", "lo", "n")
    top = plant(staged(tops, "tops"), fanout)
    row = top.roots.first()
    return Manifest(forest, top, row["digest"] if row else None)


def verified_rows(manifest: Manifest, changed: int = 0) -> DataFrame:
    """Every row's carried columns (``_c0`` ...), leaf, subroot, root, proof_sha256, folded_root and verified.

    The fold starts at the carried column with number ``changed``, a digest as the row is now, where
    that is not null, else at the stored leaf.
    """
    root = F.lit(manifest.root).cast("string")
    found = manifest.proofs()
    folded = fold(F.coalesce(F.col(f"_c{changed}"), F.col("digest")), F.col("path"))
    own = [c for c in found.columns if c.startswith("_c")]
    out = found.select(
        *own, "key", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
