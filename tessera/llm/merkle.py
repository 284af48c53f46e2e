"""A manifest of a table as a persistent hash tree, whose versions copy only the ancestors of what changed (operator 11).

Every row is a leaf; the leaves of a source, in the order of their ids, form a
tree, and the roots of the sources form the tree above. A run of ``ARITY``
successive nodes has one parent, the last run may be shorter, and a node
without neighbours on a level with others gets a parent of its own.

Trees are worked through in aligned blocks of ``ARITY ** HEIGHT`` nodes, one
task's group each. On the way up a block gives its one node on the level above,
until each tree is one node; on the way down each block gets what stands above
it, so that a row's way to the root is known where the row is. A source with
most of the rows is many blocks.

A changed leaf makes a version: it shares all nodes that its leaf is not below
of, and copies the leaf's ancestors, first those in the block and then those
above it, whose neighbours came down with the block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.operators.ranking import group_rank

ARITY = 3
#: Levels of a block: 3 ** 6 = 729 nodes.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
_STEPS = "array<struct<before: string, after: string>>"


def leaf(text: Column | None = None) -> Column:
    """The digest of a row's fields; ``text`` stands in for the row's own text."""
    parts = []
    for name in FIELDS:
        value = (F.col(name) if name != "text" or text is None else text).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Block:
    """The levels of one block, ``levels[0]`` its nodes; reaches ``height`` levels up, or to a single node if ``height`` is None."""

    def __init__(self, nodes: list[str], height: int | None):
        self.levels = [nodes]
        while len(self.levels[-1]) > 1 if height is None else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([digest(*below[k : k + ARITY]) for k in range(0, len(below), ARITY)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def steps(self, k: int) -> list[dict[str, str]]:
        """What stands before and after node ``k`` and its ancestors in their runs, level by level."""
        out = []
        for level in self.levels[:-1]:
            first = k - k % ARITY
            out.append({"before": "".join(level[first:k]), "after": "".join(level[k + 1 : first + ARITY])})
            k //= ARITY
        return out


def copied(changed: str, steps: list[dict[str, str]]) -> list[str]:
    """The ancestors of a node that is now ``changed``, from its parent to the root: all that a version copies."""
    out = []
    for step in steps:
        changed = digest(step["before"], changed, step["after"])
        out.append(changed)
    return out


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """``nodes`` (tree, at, n, digest): ``at`` counts from 0 in a tree of n nodes."""
    return nodes.withColumn("block", F.expr(f"at div {ARITY**height}"))


def _of(table: pa.Table, height: int) -> tuple[pa.Table, Block]:
    table = table.sort_by("at")
    single = table["n"][0].as_py() <= ARITY**height
    return table, Block(table["digest"].to_pylist(), None if single else height)


def rise(nodes: DataFrame, height: int) -> list[DataFrame]:
    """``nodes`` and the nodes of each round above them, until every tree is one node; each round is written to the shared folder."""

    def parent(table: pa.Table) -> pa.Table:
        table, block = _of(table, height)
        n = -(-table["n"][0].as_py() // ARITY**height)
        return pa.table({"tree": table["tree"][:1], "at": table["block"][:1], "n": pa.array([n], pa.int64()), "digest": [block.top]})

    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 1) > 1:
        up = _blocks(rounds[-1].select("tree", "at", "n", "digest"), height).groupBy("tree", "block").applyInArrow(parent, "tree string, at long, n long, digest string")
        rounds.append(saved(up, "merkle-round"))
    return rounds


def _descend(nodes: DataFrame, above: DataFrame, height: int, shape: Callable[[pa.Table, list[list[dict]]], pa.Table], schema: str) -> DataFrame:
    """What ``shape`` makes of each block's rows and their steps to the root; ``above`` (tree, at, steps) has those of the blocks."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        left, block = _of(left, height)
        upper = right["steps"][0].as_py()
        return shape(left, [block.steps(k) + upper for k in range(left.num_rows)])

    upper = above.select("tree", F.col("at").alias("block"), "steps")
    return _blocks(nodes, height).groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(work, schema)


def _steps(table: pa.Table, steps: list[list[dict]]) -> pa.Table:
    return pa.table({"tree": table["tree"], "at": table["at"], "steps": pa.array(steps, pa.list_(_STEP))})


def _way_down(rounds: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """``top`` (tree, at, steps) of the last round, brought down to the first round above the lowest."""
    for nodes in reversed(rounds[1:-1]):
        top = saved(_descend(nodes, top, height, _steps, f"tree string, at long, steps {_STEPS}"), "merkle-steps")
    return top


def versions(docs: DataFrame, changed_text: Column | None = None, changed: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof, version, copies.

    ``proof`` (an array of before and after, from the leaf up) is all that it
    takes to come from the leaf to the root. Where ``changed`` holds, the row's
    text is now ``changed_text``: ``version`` is the changed leaf and ``copies``
    its new ancestors, the last one the version's root; any other row has its
    leaf and the ancestors recomputed from it. All other nodes are shared.

    Leaves ascend by doc_id, null first, and equal ids by leaf, so reruns agree;
    repeated rows are leaves of their own. A null source is a source, the first.
    Other columns are ignored, whatever their names. An empty table has no rows.
    """
    rows = docs.select("doc_id", F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("tree"), leaf().alias("digest"), (F.when(changed, leaf(changed_text)) if changed is not None else F.lit(None).cast("string")).alias("version"))
    rows = saved(rows, "merkle-leaves")
    ranked = group_rank(rows, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("version")], "at", "n")
    leaves = saved(ranked.withColumn("at", F.col("at").cast("long") - 1), "merkle-ranked")
    lower = rise(leaves, height)
    # the subroots are the nodes of one more tree, in the order of the sources
    sources = saved(lower[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "merkle-subroots")
    sources = saved(group_rank(sources, ["tree"], [F.col("source")], "at", "n").withColumn("at", F.col("at").cast("long") - 1), "merkle-sources")
    upper = rise(sources, height)
    none = F.array().cast(_STEPS)
    above = _way_down(upper, upper[-1].select("tree", "at", none.alias("steps")), height)
    root = upper[-1].select(F.col("digest").alias("root"))
    if len(upper) == 1:  # one source: its root is the root
        above = sources.select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("at"), none.alias("steps"))
    else:
        above = _descend(sources, above, height, lambda t, s: pa.table({"tree": t["source"], "at": pa.array([0] * len(s), pa.int64()), "steps": pa.array(s, pa.list_(_STEP))}), f"tree string, at long, steps {_STEPS}")
    above = _way_down(lower, saved(above, "merkle-steps"), height)
    subroots = sources.select(F.col("source").alias("tree"), F.col("digest").alias("subroot"))

    def shape(table: pa.Table, steps: list[list[dict]]) -> pa.Table:
        now = [v or d for v, d in zip(table["version"].to_pylist(), table["digest"].to_pylist(), strict=True)]
        copies = [copied(d, s) for d, s in zip(now, steps, strict=True)]
        return pa.table({"doc_id": table["doc_id"], "tree": table["tree"], "leaf": table["digest"], "version": now, "proof": pa.array(steps, pa.list_(_STEP)), "copies": pa.array(copies, pa.list_(pa.string()))})

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, tree string, leaf string, version string, proof {_STEPS}, copies array<string>"
    if len(lower) == 1:  # every source has one row, a subroot itself
        found = leaves.join(above.select("tree", "steps"), "tree").select("doc_id", "tree", F.col("digest").alias("leaf"), F.coalesce("version", "digest").alias("version"), F.col("steps").alias("proof"))
        found = found.mapInArrow(_fold, schema)
    else:
        found = _descend(leaves, above, height, shape, schema)
    found = found.join(subroots, "tree").crossJoin(F.broadcast(root))  # one row
    return found.select("doc_id", "leaf", "subroot", "root", "proof", "version", "copies")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        copies = [copied(d, s) for d, s in zip(b["version"].to_pylist(), b["proof"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "tree": b["tree"], "leaf": b["leaf"], "version": b["version"], "proof": b["proof"], "copies": pa.array(copies, pa.list_(pa.string()))})


def verified(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest's rows with every second document (by the checksum of its id) without its line ends, and whether it still verifies.

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; a null id or a null text is never tampered with.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = versions(docs, F.translate(F.col("text"), "\n", ""), F.coalesce(tampered, F.lit(False)), height)
    folded = F.coalesce(F.try_element_at("copies", F.lit(-1)), F.col("version"))
    proof = F.sha2(F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
