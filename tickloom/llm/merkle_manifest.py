"""A Merkle manifest of a dataset by cogrouped subtree exchange: roots, inclusion proofs, audits.

Every document is a leaf; the leaves of a source form one tree by ascending doc_id, and the roots of
the sources (subroots) form the tree above. A node is the digest of up to ``FANOUT`` children.

A tree is cut into superblocks of ``FANOUT ** height`` consecutive leaves, so no source is ever one
group. Superblocks are first reduced to one node each; these few nodes are reduced in groups of the
same size until one is left, and each group hands down, for each of its nodes, the siblings on the
way up. Then leaves and the outer siblings their superblock needs are cogrouped by superblock, and
one function finishes the local levels, joins both parts of the proof and folds it. A leaf moves
as 32 bytes; texts never leave the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import numbered_parts
from tickloom.session import materialise

FANOUT = 16

#: One step of a proof: the siblings left and right of the node, as joined hex digests.
_PATH = "tree string, block bigint, level int, left string, right string"
_RESULT = (
    "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean, proof array<struct<left:string,right:string>>"
)


def digest(joined: str) -> str:
    return hashlib.sha256(joined.encode("ascii")).hexdigest()


def climb(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The nodes and the levels above them: so many, or until one node is left."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return out


def siblings(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """Joined digests left and right of the node, for each level below the last."""
    steps = []
    for nodes in levels[:-1]:
        first = place // FANOUT * FANOUT
        run = nodes[first : first + FANOUT]
        steps.append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
        place //= FANOUT
    return steps


def folded(leaf: str, steps: Iterable[tuple[str, str]]) -> str:
    for left, right in steps:
        leaf = digest(left + leaf + right)
    return leaf


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Hex digest of a document's fields; a field is ``-`` if null, else byte count, ``:``, value."""

    def field(value: Column) -> Column:
        return F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        )

    parts = [x.cast("string") for x in (doc_id, source, lang, n_chars, text)]
    return F.sha2(F.concat(*map(field, parts)).cast("binary"), 256)


def manifest(
    docs: DataFrame,
    *,
    altered: Column | None = None,
    where: Column | None = None,
    height: int = 2,
    with_proofs: bool = False,
) -> DataFrame:
    """One row per document: its leaf, its source's subroot, the root, its proof, and the audit.

    ``altered`` is the text to audit in place of the recorded one in the rows that satisfy
    ``where``; in all others the recorded leaf is folded again. ``folded_root`` is what the audited
    leaf and the recorded siblings fold to, ``verified`` whether it is the root. ``proof_sha256`` is
    the digest of all siblings from the leaf up, left to right; ``proof`` has them level by level
    if ``with_proofs``, else null (a proof is about as large as a text).

    Each row is a leaf, repeated and null ids included: within a source null ids come first, rows
    of one id are ordered by their leaves, and equal rows take neighbouring places in any order. A
    null source is a tree of its own, before all others; an empty source is another one. An empty
    table gives no rows. Columns other than doc_id, source, lang, n_chars and text are ignored.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, proof.
    """
    if height < 1:
        raise ValueError("height must be at least 1")
    size = FANOUT**height
    leaves = _placed(docs, altered, where)
    ranked = leaves.withColumn("block", F.floor(F.col("rank") / size))

    roots = ranked.select("tree", "block", "rank", "leaf", "total").groupBy("tree", "block")
    nodes = materialise(roots.applyInPandas(_subtree(height), _NODES), "superblocks")
    outer = _outer(nodes, height)

    def finish(key: tuple, block: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        path = path.sort_values("level")
        ends = path.iloc[0]
        subroot, root = ends["left"], ends["right"]
        above = list(zip(path["left"].iloc[1:], path["right"].iloc[1:], strict=True))
        recorded = [x.hex() for x in block["leaf"]]
        # a tree of one superblock ends inside it
        whole = block["total"].iloc[0] <= size
        levels = climb(recorded, None if whole else height)
        rows = []
        for place, (doc_id, leaf, changed) in enumerate(
            zip(block["doc_id"], recorded, block["changed"], strict=True)
        ):
            steps = siblings(levels, place) + above
            proof = digest("".join([side for step in steps for side in step]))
            top = folded(leaf if changed is None else changed.hex(), steps)
            kept = [{"left": a, "right": b} for a, b in steps] if with_proofs else None
            rows.append((doc_id, leaf, subroot, root, proof, top, top == root, kept))
        return pd.DataFrame(rows, columns=_COLUMNS)

    # ids travel as text: pandas would turn integers beside nulls into floats
    doc_id = F.col("doc_id").cast("string").alias("doc_id")
    left = ranked.select("tree", "block", "rank", "total", doc_id, "leaf", "changed")
    done = left.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    done = done.applyInPandas(finish, _RESULT)
    return done.withColumn("doc_id", F.col("doc_id").cast("bigint"))


_COLUMNS = [x.split(" ")[0] for x in _RESULT.split(", ")]
_NODES = "tree string, at bigint, node string, total bigint"


def _placed(docs: DataFrame, altered: Column | None, where: Column | None) -> DataFrame:
    """Leaves with their ``rank`` in their tree and its ``total``.

    ``tree`` is the source with a mark before it, ``-`` for null, which sorts first and bytewise.
    """
    names = ("doc_id", "source", "lang", "n_chars")
    integers = {"doc_id", "n_chars"}
    fields = [F.col(x).cast("bigint") if x in integers else F.col(x).cast("string") for x in names]
    text = F.col("text").cast("string")
    changed = F.lit(None).cast("binary")
    if altered is not None:
        changed = F.unhex(leaf_digest(*fields, altered.cast("string")))
        if where is not None:
            changed = F.when(where, changed)
    leaves = docs.select(
        fields[0].alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), fields[1]), F.lit("-")).alias("tree"),
        F.unhex(leaf_digest(*fields, text)).alias("leaf"),
        changed.alias("changed"),
    )
    # the digests are computed once; sorting samples its input first
    leaves = materialise(leaves, "leaves").withColumn("tie", F.monotonically_increasing_id())
    placed = numbered_parts(leaves, [F.col(x) for x in ("tree", "doc_id", "leaf", "tie")], "sorted_leaves")
    spans = placed.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    # a tree has one row here for each partition it reaches into
    per_tree = Window.partitionBy("tree")
    earlier = F.sum("n").over(per_tree.orderBy("part")) - F.col("n")
    spans = spans.select(
        "tree", "part", (earlier - F.col("first")).alias("base"), F.sum("n").over(per_tree).alias("total")
    )
    return placed.join(spans, ["tree", "part"]).select(
        "doc_id", "tree", "leaf", "changed", (F.col("base") + F.col("row")).alias("rank"), "total"
    )


def _subtree(height: int):
    """Reduces a superblock of leaves to its node."""
    size = FANOUT**height

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        total = int(block["total"].iloc[0])
        leaves = [x.hex() for x in block.sort_values("rank")["leaf"]]
        node = climb(leaves, None if total <= size else height)[-1][0]
        return pd.DataFrame([(*key, node, -(-total // size))], columns=["tree", "at", "node", "total"])

    return run


def _ascend(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """One step of the exchange: the proof steps of every node inside its group, and the groups' nodes."""
    size = FANOUT**height

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, up = key
        group = group.sort_values("at")
        total = int(group["total"].iloc[0])
        levels = climb(list(group["node"]), None if total <= size else height)
        rows = [
            (tree, at, level, left, right, None)
            for place, at in enumerate(group["at"])
            for level, (left, right) in enumerate(siblings(levels, place))
        ]
        rows.append((tree, up, -1, levels[-1][0], None, -(-total // size)))
        frame = pd.DataFrame(rows, columns=["tree", "block", "level", "left", "right", "total"])
        return frame.astype({"total": "Int64"})

    grouped = nodes.withColumn("up", F.floor(F.col("at") / size)).groupBy("tree", "up")
    both = materialise(grouped.applyInPandas(run, f"{_PATH}, total bigint"), "outer_nodes")
    above = both.filter("level = -1")
    return (
        both.filter("level >= 0").drop("total"),
        above.select("tree", F.col("block").alias("at"), F.col("left").alias("node"), "total"),
    )


def _climb_all(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """Proof steps of all nodes up to the roots of their trees, numbered from 1, and those roots."""
    size = FANOUT**height
    start = nodes.select("tree", F.col("at").alias("block"))
    paths, reach, step = None, 1, 0
    most = nodes.agg(F.max("total")).first()[0] or 0
    while reach == 1 or most > reach:
        inside, nodes_up = _ascend(nodes, height)
        inside = inside.select(
            "tree", F.col("block").alias("at"), (F.col("level") + (1 + step)).alias("level"), "left", "right"
        )
        at = F.floor(F.col("block") / reach).alias("at")
        here = start.select("tree", "block", at).join(inside, ["tree", "at"]).drop("at")
        paths = here if paths is None else paths.unionByName(here)
        nodes, reach, step = nodes_up, reach * size, step + height
    return paths, nodes.select("tree", "node")


def _outer(nodes: DataFrame, height: int) -> DataFrame:
    """What a superblock needs from outside: proof steps, and at level 0 subroot and root."""
    inside, subroots = _climb_all(nodes, height)
    lined = numbered_parts(subroots, [F.col("tree")], "subroots")
    spans = lined.groupBy("part").agg(F.count("*").alias("n"))
    spans = spans.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    lined = lined.join(spans, "part").select(
        F.lit("").alias("tree"), (F.col("base") + F.col("row")).alias("at"), "node", F.col("tree").alias("source")
    )
    total = lined.count()
    lined = materialise(lined.withColumn("total", F.lit(total).cast("bigint")), "source_nodes")
    above, root = _climb_all(lined.drop("source"), height)
    # after all steps inside the source's tree
    first = F.lit(1 << 16)
    above = lined.select(F.col("source").alias("tree"), F.col("at").alias("block")).join(
        above.drop("tree"), "block"
    )
    above = above.select("tree", (F.col("level") + first).alias("level"), "left", "right")
    top = root.first()
    ends = lined.select(
        F.col("source").alias("tree"), F.lit(0).alias("level"), F.col("node").alias("left"),
        F.lit(top and top.node).cast("string").alias("right"),
    )
    blocks = nodes.select("tree", F.col("at").alias("block"))
    shared = blocks.join(above.unionByName(ends), "tree")
    return inside.unionByName(shared.select(*inside.columns))
