"""A Merkle manifest of a dataset: every document is a leaf, every source a subtree, and every leaf gets its proof up to the one root."""
from __future__ import annotations

from collections.abc import Iterator

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from feedyard.llm.common import running_sum, source_key, written

FAN = 3
# A superblock is an aligned run of FAN ** LEVELS nodes of one tree: what one call of the Python functions holds.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes: list[str], fan: int, rounds: int | None) -> list[list[str]]:
    """The nodes and what they become when every ``fan`` consecutive ones are hashed together: ``rounds`` times, or until one is left."""
    out = [nodes]
    while len(out) <= rounds if rounds is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([digest("".join(last[i:i + fan])) for i in range(0, len(last), fan)])
    return out


def paths_of(levels: list[list[str]], fan: int, above: str) -> list[str]:
    """The proof of each node of the lowest level: ``left*right`` siblings per level, levels joined by ``;``, ``above`` behind them."""
    paths = [above] * len(levels[-1])
    for nodes in reversed(levels[:-1]):
        here = []
        for i in range(len(nodes)):
            begin = i - i % fan
            step = "".join(nodes[begin:i]) + "*" + "".join(nodes[i + 1:begin + fan])
            up = paths[i // fan]
            here.append(f"{step};{up}" if up else step)
        paths = here
    return paths


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and its proof lead to."""
    for step in path.split(";") if path else ():
        left, right = step.split("*")
        leaf = digest(left + leaf + right)
    return leaf


def siblings(path: str) -> str:
    """The nodes of a proof, one after the other."""
    return path.replace("*", "").replace(";", "")


def field(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 bytes, ``:`` and itself; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


class Tree:
    """Several trees whose nodes are numbered from 0 in ``pos``, reduced by superblocks.

    ``nodes`` is ``(tree, pos, n, node)``, n being the number of leaves of the tree. Upward, each superblock becomes one node of the
    next table, until every tree is one superblock; downward, each superblock's members are cogrouped with the one row
    of nodes outside it. All calls hold at most ``fan ** levels`` nodes, whatever the size of a tree.
    """

    def __init__(self, nodes: DataFrame, most: int, fan: int, levels: int):
        self.fan, self.levels, self.size = fan, levels, fan ** levels
        self.tables = [self._blocked(nodes)]
        tops = []
        while True:
            blocks = self.tables[-1].select("tree", "block", "pos", "n", "node").groupBy("tree", "block")
            top = written(blocks.applyInPandas(self._reduce(), "tree bigint, pos bigint, n bigint, node binary"), "merkle-tops")
            tops.append(top.filter("n = 1").select("tree", "node"))
            most = -(-most // self.size)
            if most <= 1:
                break
            self.tables.append(self._blocked(top.filter("n > 1")))
        self.roots = tops[0]
        for more in tops[1:]:
            self.roots = self.roots.union(more)

    def _blocked(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.floor(F.col("pos") / self.size))

    def _reduce(self):
        fan, levels, size = self.fan, self.levels, self.size

        def reduce(key: tuple, members: pd.DataFrame) -> pd.DataFrame:
            n = int(members["n"].iloc[0])
            nodes = [x.hex() for x in members.sort_values("pos")["node"]]
            top = levels_of(nodes, fan, levels if n > size else None)[-1][0]
            return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // size)], "node": [bytes.fromhex(top)]})
        return reduce

    def unfold(self, outside: DataFrame, finish, schema: str) -> DataFrame:
        """``finish(members, paths, outer)`` over all superblocks of the leaves, ``outside`` being ``(tree, path, subroot, root)`` per tree.

        ``members`` are the rows of the first table by position, ``paths`` the whole proofs, ``outer`` the superblock's row.
        """
        fan, levels, size = self.fan, self.levels, self.size

        def exchange(done):
            def run(key: tuple, members: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
                members, outer = members.sort_values("pos"), outer.iloc[0]
                rounds = levels if members["n"].iloc[0] > size else None
                reduced = levels_of([x.hex() for x in members["node"]], fan, rounds)
                return done(members, paths_of(reduced, fan, outer["path"]), outer)
            return run

        def pass_on(members: pd.DataFrame, paths: list[str], outer: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"tree": members["tree"], "block": members["pos"], "path": paths, "subroot": outer["subroot"], "root": outer["root"]})

        nothing: DataFrame | None = None
        for k in range(len(self.tables) - 1, -1, -1):
            table = self.tables[k]
            # trees that are one superblock at this height have only what is outside of the tree
            whole = table.filter((F.col("pos") == 0) & (F.col("n") <= self.size)).select("tree", F.lit(0).cast("bigint").alias("block")).join(outside, "tree")
            outer = (whole if nothing is None else nothing.unionByName(whole)).withColumnsRenamed({"tree": "of_tree", "block": "of_block"})
            outer = outer.select(*[F.col(c).alias(c) for c in outer.columns])
            pair = table.groupBy("tree", "block").cogroup(outer.groupBy("of_tree", "of_block"))
            if k == 0:
                return pair.applyInPandas(exchange(finish), schema)
            nothing = pair.applyInPandas(exchange(pass_on), "tree bigint, block bigint, path string, subroot string, root string")
        raise AssertionError


def manifest(docs: DataFrame, received: Column | None = None, fan: int = FAN, levels: int = LEVELS, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, path, proof_sha256, folded_root, verified)`` of every row.

    ``fields`` names id, source, two more columns and the text. ``received`` is the text as it came back (default: as it is); its leaf is folded with the
    original proof, and ``verified`` tells whether that gives the root. ``path`` is the proof itself: per level the
    siblings to the left and to the right, ``left*right``, levels joined by ``;``. Digests are lowercase hex.

    Leaves of a source stand by id (NULL first), rows of one id by leaf; equal rows are leaves of their own. A NULL source is a
    source and stands first; an empty text is ``0:``, a NULL one ``-``. Of a source with one document the leaf is the subroot, of one
    source the subroot is the root and the proof ends there. No rows give no rows and no root.
    """
    key, source = F.col(fields[0]).cast("bigint"), F.col(fields[1])
    original = [F.col(c) for c in fields]
    returned = leaf_of([*original[:-1], received]) if received is not None else F.lit(None).cast("binary")
    leaves = written(docs.select(key.alias("doc_id"), *source_key(source), leaf_of(original).alias("node"), returned.alias("returned")), "leaves")
    sources = written(leaves.groupBy("nameless", "name").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0).cast("bigint")), "sources")
    trees = written(running_sum(sources, "all", [F.col("nameless").desc(), F.col("name")], {}).select("nameless", "name", F.col("place").alias("tree"), "n"), "trees")
    count, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(1))).first()
    placed = running_sum(leaves.join(trees, ["nameless", "name"]).select("tree", "n", "doc_id", "node", "returned"), "tree", [F.col("doc_id"), F.col("node")], {})
    documents = Tree(placed.withColumnRenamed("place", "pos"), most, fan, levels)
    # subroots are the leaves of one more tree
    subroots = documents.roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("bigint").alias("n"), "node")
    top = Tree(subroots, count, fan, levels)
    apex = top.roots.select("tree", F.lit("").alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("node")).alias("root"))

    def place_source(members: pd.DataFrame, paths: list[str], outer: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"tree": members["pos"], "path": paths, "subroot": [x.hex() for x in members["node"]], "root": outer["root"]})

    def prove(members: pd.DataFrame, paths: list[str], outer: pd.Series) -> pd.DataFrame:
        leaves = [x.hex() for x in members["node"]]
        folded = [fold(leaf if back is None else back.hex(), path) for leaf, back, path in zip(leaves, members["returned"], paths)]
        return pd.DataFrame({"doc_id": members["doc_id"], "leaf": leaves, "subroot": outer["subroot"], "root": outer["root"], "path": paths,
                             "proof_sha256": [digest(siblings(p)) for p in paths], "folded_root": folded, "verified": [f == outer["root"] for f in folded]})

    outside = written(top.unfold(apex, place_source, "tree bigint, path string, subroot string, root string"), "merkle-sources")
    return documents.unfold(outside, prove, "doc_id bigint, leaf string, subroot string, root string, path string, proof_sha256 string, folded_root string, verified boolean")
