"""Sharding by a k-d tree over metadata: shards of near equal bytes, each a box of alike documents.

The unit that is placed is a group of equal texts, at the coordinates (source, language, size). Equal texts share a
shard unless their group holds over 1/320 of all bytes or rows: such groups are placed row by row, so a hot text
cannot unbalance a shard, and there are 640 of them at most, which bounds what is broadcast. A node of k shards
is split along its widest dimension where the weight below is floor(k/2)/k of its own, found by rounds of
weighted histograms over all nodes of a level at once. The driver sees histograms and the tree, whose sizes
depend on the shard count alone, and rows find their leaf by a descent through an array of the tree's nodes.

Coordinates keep the order of values: a name's is its bytes after the prefix that all names share, a size's its
logarithm. Extents are compared as shares of all documents' extent. Below a coordinate's grain is a hashed
fraction, so a value that holds a third of all rows can be split anywhere.

Defined cases: a null text has no bytes and crc 0; null sources and languages are like empty names; equal rows get
slots of their own; very long texts are one unit each; an empty table gives an empty result; further columns are
not read, whatever their names.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.llm import ranks, store

DIMENSIONS = ("source", "lang", "length")
CELLS = 1 << 16
BINS = 1024
HEAVY = 320
OVERHEAD = 16
ROUNDS = 5


@dataclass
class Node:
    """A leaf holds shards [first, first + k); a split sends units below at to the left."""

    first: int
    k: int
    dim: str = ""
    at: float = 0.0
    left: Node | None = None
    right: Node | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def depth(self) -> int:
        return 0 if self.left is None else 1 + max(self.left.depth(), self.right.depth())

    def shard(self) -> Column:
        """Number of a row's first shard, from its coordinates: one step a level through the array of nodes."""
        nodes: list[Column] = []

        def number(n: Node) -> int:
            mine = len(nodes)
            nodes.append(F.lit(None))
            left, right = (number(n.left), number(n.right)) if n.left else (mine, mine)
            dim = DIMENSIONS.index(n.dim) if n.left else 0
            kinds = zip(("dim", "at", "left", "right", "first"), (dim, float(n.at), left, right, n.first))
            nodes[mine] = F.struct(*[F.lit(v).alias(k) for k, v in kinds])
            return mine

        number(self)
        table, place = F.array(*nodes), F.array(*DIMENSIONS)

        def descend(at: Column, _: Column) -> Column:
            node = F.get(table, at)
            return F.when(F.get(place, node["dim"]) < node["at"], node["left"]).otherwise(node["right"])

        if not self.depth():
            return F.lit(self.first)
        last = F.aggregate(F.sequence(F.lit(1), F.lit(self.depth())), F.lit(0), descend)
        return F.get(table, last)["first"]


def _common_prefix(df: DataFrame, column: str) -> int:
    """Bytes that all values share at their beginning: what the least and the greatest share."""
    row = df.agg(F.min(column), F.max(column)).collect()[0]
    return len(os.path.commonprefix([(v or "").encode() for v in row]))


def _with_coordinates(df: DataFrame, unit: Column, prefixes: dict[str, int]) -> DataFrame:
    """df with columns source, lang and length in [0, 1), ties broken by the unit's hash."""

    def cell(value: Column, salt: int) -> Column:
        """The value's cell of 65,536, and inside it a place by the unit's hash."""
        u = F.pmod(F.xxhash64(unit, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
        return (value + u) / CELLS

    def name(column: str, salt: int) -> Column:
        told = F.hex(F.substring(F.col(column).cast("binary"), prefixes[column] + 1, 2))
        return cell(F.conv(F.rpad(told, 4, "0"), 16, 10).cast("double"), salt)

    return df.select(
        "*",
        name("g_source", 1).alias("source"),
        name("g_lang", 2).alias("lang"),
        cell(F.floor(F.log2(F.col("size")) * 1024), 3).alias("length"),
    )


def _listed(shards: int, values: dict[int, float], other: float) -> Column:
    """By a node's number, its value."""
    return F.get(F.array(*[F.lit(float(values.get(i, other))) for i in range(shards)]), F.col("node"))


def build(units: DataFrame, shards: int) -> Node:
    """Tree over units (the dimensions and weight)."""
    root, extent = Node(0, shards), {}
    while todo := [n for n in root.leaves() if n.k > 1]:
        firsts = [n.first for n in todo]
        at = units.select("*", root.shard().alias("node")).filter(F.col("node").isin(firsts))
        box = {
            r["node"]: r
            for r in at.groupBy("node")
            .agg(*[f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))], F.sum("weight").alias("w"))
            .collect()
        }
        for n in todo:
            if r := box.get(n.first):
                extent = extent or {d: max(r[f"hi_{d}"] - r[f"lo_{d}"], 1e-300) for d in DIMENSIONS}
                n.dim = max(DIMENSIONS, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / extent[d])
                n.at = r[f"hi_{n.dim}"]
        full = [n for n in todo if n.first in box]
        spans = {n.first: (box[n.first][f"lo_{n.dim}"], box[n.first][f"hi_{n.dim}"]) for n in full}
        below = dict.fromkeys(spans, 0)
        place = F.array(*DIMENSIONS)
        dims = {n.first: DIMENSIONS.index(n.dim) for n in full}
        coarse = list(full)
        for _ in range(ROUNDS):
            if not coarse:
                break
            hist: dict[int, dict[int, int]] = {n.first: {} for n in coarse}
            x = F.get(place, _listed(shards, dims, 0).cast("int"))
            lo = _listed(shards, {f: spans[f][0] for f in hist}, 0.0)
            step = _listed(shards, {f: max(spans[f][1] - spans[f][0], 1e-300) / BINS for f in hist}, 1.0)
            cut = at.filter(F.col("node").isin(list(hist))).select("node", "weight", F.floor((x - lo) / step).alias("bin"))
            inside = cut.filter(F.col("bin").between(0, BINS)).select("node", "weight", F.least("bin", F.lit(BINS - 1)).alias("bin"))
            for node, bin_, w in inside.groupBy("node", "bin").agg(F.sum("weight")).collect():
                hist[node][bin_] = w
            for n in list(coarse):
                a, b = spans[n.first]
                step_, want, got = max(b - a, 1e-300) / BINS, box[n.first]["w"] * (n.k // 2) / n.k, below[n.first]
                found = BINS - 1
                for bin_ in sorted(hist[n.first]):
                    w = hist[n.first][bin_]
                    if got + w >= want:
                        found = bin_
                        break
                    got += w
                w = hist[n.first].get(found, 0)
                nearer = want - got > got + w - want  # the bin's upper edge is nearer to what is wanted
                n.at = a + step_ * (found + nearer)
                spans[n.first], below[n.first] = (a + step_ * found, a + step_ * (found + 1)), got
                if 200 * w * n.k <= box[n.first]["w"]:  # half a per cent of a shard: near enough
                    coarse.remove(n)
        for n in todo:
            n.dim = n.dim or DIMENSIONS[0]
            n.left, n.right = Node(n.first, n.k // 2), Node(n.first + n.k // 2, n.k - n.k // 2)
    return root


def placed(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (0, 1, .. in the shard) of every row."""
    with store.scratch(docs.sparkSession):
        rows = store.cut(
            docs.select(
                F.col(key).alias("doc_id"),
                F.coalesce(F.col(source).cast("string"), F.lit("")).alias("g_source"),
                F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("g_lang"),
                (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
                F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")).alias("text_crc32"),
                F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
            ),
            "metadata",
        )
        groups = store.cut(
            rows.groupBy("h", "size", "text_crc32").agg(
                F.count("*").alias("n"), F.min("g_source").alias("g_source"), F.min("g_lang").alias("g_lang")
            ),
            "groups",
        )
        total = groups.agg(F.sum(F.col("n") * F.col("size")).alias("b"), F.sum("n").alias("n")).collect()[0]
        all_bytes, all_rows = total["b"] or 0, total["n"] or 0
        prefixes = {c: _common_prefix(groups, c) for c in ("g_source", "g_lang")}
        same = ["h", "size", "text_crc32"]
        is_heavy = (F.col("n") > 1) & (
            (F.col("n") * F.col("size") * HEAVY > all_bytes) | (F.col("n") * HEAVY > all_rows)
        )
        heavy = F.broadcast(groups.filter(is_heavy).select(*same))
        single = _with_coordinates(rows.join(heavy, same, "left_semi"), F.xxhash64("h", "doc_id"), prefixes)
        whole = _with_coordinates(groups.filter(~is_heavy), F.col("h"), prefixes)
        units = store.cut(
            whole.select(*DIMENSIONS, (F.col("n") * F.col("size")).alias("weight")).unionByName(
                single.select(*DIMENSIONS, F.col("size").alias("weight"))
            ),
            "units",
        )
        tree = build(units, shards)
        homes = store.cut(whole.select(*same, tree.shard().alias("shard")), "homes")
        out = rows.join(heavy, same, "left_anti").join(homes, same).select("doc_id", *same, "shard")
        out = out.unionByName(single.select("doc_id", *same, tree.shard().alias("shard")))
        out = store.cut(out, "shards")
        out = ranks.ranked(out, "shard", ["doc_id", "h"], "slot", "doc_id").select(
            "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot"
        )
        return store.cut(out, "placed", keep=True)
