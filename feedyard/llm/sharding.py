"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under quotas."""
from __future__ import annotations

from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from feedyard.operators.skew import with_position
from feedyard.session import stable

SHARDS = 40
# Pieces of at least this part of a shard's rows (so at most LARGE * shards of them) are packed one by one on the driver.
LARGE = 16


def _quotas(wishes: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many rows go from shard i to shard j: those that wish to, and free rows that make room for them.

    Every shard gets as many rows as it gives, so sizes never change. First wishes are granted along cycles (two
    shards that swap, or longer rounds), each for its least wish; what is left is swapped for rows without links, as
    far as shard j has them.
    """
    left, n = wishes.copy(), len(free)
    granted = np.minimum(left, left.T)  # pairs that swap
    left = left - granted
    while True:
        # a walk that always takes the largest wish either ends, at a shard that takes part in no cycle, or closes one
        path, at = [], next((i for i in range(n) if left[i].any()), None)
        if at is None:
            break
        while at not in path and left[at].any():
            path.append(at)
            at = int(np.argmax(left[at]))
        if at in path:
            ring = path[path.index(at):] + [at]
            least = min(left[i, j] for i, j in zip(ring, ring[1:]))
            for i, j in zip(ring, ring[1:]):
                left[i, j] -= least
                granted[i, j] += least
        else:
            left[:, at] = 0  # nothing leaves this shard, so nothing can come by wishes alone
    left = wishes - granted
    filler = np.zeros_like(wishes)
    for j in range(n):
        spare = free[j]
        for i in np.argsort(-left[:, j], kind="stable"):
            moved = int(min(spare, left[i, j]))
            granted[i, j] += moved
            filler[j, i] += moved
            spare -= moved
    return granted, filler


def _packed(pieces: list[tuple[int, int]], room: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(piece, begin, end, shard)``: pieces by falling size, each where it fits most closely; ``room`` is lessened.

    What fits nowhere whole fills the largest rooms one after the other.
    """
    out, rest = [], []
    for size, piece in sorted(((n, p) for p, n in pieces), reverse=True):
        fits = np.flatnonzero(room >= size)
        if len(fits):
            at = int(fits[np.argmin(room[fits])])
            room[at] -= size
            out.append((piece, 0, size, at))
        else:
            rest.append((size, piece))
    for size, piece in rest:
        begin = 0
        while begin < size:
            at = int(np.argmax(room))
            end = min(size, begin + int(room[at]))
            room[at] -= end - begin
            out.append((piece, begin, end, at))
            begin = end
    return out


def propagate(nodes: DataFrame, shards: int, max_rounds: int | None = None) -> DataFrame:
    """``(node, piece, shard)`` after label propagation; nodes are ``(node, piece, free, shard)``.

    Nodes of one piece are linked, free ones have no links. In each round every linked node wishes for the shard that holds most of its piece
    (ties: by hash) and the quotas between each two shards say how many go; who goes is decided by node number.
    Each round is joins and aggregates over the pieces and is checkpointed; only the shards x shards matrix of wishes
    reaches the driver. It ends when no wish can be granted; each that is granted adds to a piece's largest part, so it does end.
    """
    spark = nodes.sparkSession
    now = stable(nodes.select("node", "piece", "shard", "free"))
    for _ in count() if max_rounds is None else range(max_rounds):
        linked = now.filter("not free")
        held = linked.groupBy("piece", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = held.groupBy("piece").agg(F.max(F.struct("n", F.xxhash64("piece", "shard").alias("tie"), "shard")).alias("best"))
        wish = linked.join(best.select("piece", F.col("best.shard").alias("wish")), "piece").filter("wish <> shard")
        wish = stable(wish.select("node", "shard", "wish"))
        wishes, free = np.zeros((shards, shards), np.int64), np.zeros(shards, np.int64)
        for r in wish.groupBy("shard", "wish").count().collect():  # shards x shards counts
            wishes[r["shard"], r["wish"]] = r["count"]
        if not wishes.any():
            break
        for r in now.filter("free").groupBy("shard").count().collect():
            free[r["shard"]] = r["count"]
        wishing, filler = _quotas(wishes, free)
        if not wishing.any():
            break
        quota = spark.createDataFrame([(int(i), int(j), int(wishing[i, j])) for i, j in zip(*np.nonzero(wishing))], "shard int, wish int, quota bigint")
        goers = with_position(wish, ["shard", "wish"], [F.col("node")], "rank").join(F.broadcast(quota), ["shard", "wish"]).filter("rank < quota")
        # free rows of a shard, by position: the first filler[j, 0] go to shard 0, the next to shard 1 and so on
        ends = np.cumsum(filler, axis=1)
        cuts = spark.createDataFrame([(int(j), int(i), int(ends[j, i] - filler[j, i]), int(ends[j, i])) for j, i in zip(*np.nonzero(filler))],
                                     "shard int, wish int, begin bigint, end bigint")
        spare = with_position(now.filter("free").select("node", "shard"), ["shard"], [F.col("node")], "rank")
        makers = spare.join(F.broadcast(cuts), "shard").filter("rank >= begin and rank < end")
        moves = goers.select("node", "wish").union(makers.select("node", "wish"))
        now = stable(now.join(moves, "node", "left").select("node", "piece", F.coalesce("wish", "shard").cast("int").alias("shard"), "free"))
    return now.select("node", "piece", "shard")


def _start(placed: DataFrame, sizes: DataFrame, shards: int, total: int) -> DataFrame:
    """``placed`` (node, piece, free) with ``shard``: exactly balanced, with all but a few pieces whole.

    Large pieces are packed on the driver. The other pieces lie in a row along the rooms that are left, so at most one is cut
    at each border; rows without links fill every shard up, which leaves the propagation something to swap.
    """
    spark = placed.sparkSession
    least = total // shards
    room = np.full(shards, least, np.int64)
    room[:total % shards] += 1
    large = max(2, least // LARGE)
    packed = _packed([tuple(r) for r in sizes.filter(F.col("n") >= large).select("piece", "n").collect()], room)
    spots = spark.createDataFrame(packed, "piece bigint, begin bigint, end bigint, shard int")
    packed_pieces = spots.select("piece").distinct()
    known = placed.join(F.broadcast(spots), "piece").filter("node - piece >= begin and node - piece < end").select("node", "piece", "free", "shard")
    rest = with_position(placed.join(F.broadcast(packed_pieces), "piece", "left_anti"), ["free"], [F.col("node")], "rank")
    free_rows = placed.filter("free").count()
    linked = int(room.sum()) - free_rows
    wide = np.where(room >= 4 * large, room, 0)
    wide = wide if wide.sum() >= linked else room
    ends = np.cumsum(wide) * linked // max(1, int(wide.sum()))
    free_ends = np.cumsum(room) - ends

    def shard_of(bounds: np.ndarray) -> Column:
        return F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= F.col("rank")))

    return known.union(rest.select("node", "piece", "free", F.when(F.col("free"), shard_of(free_ends)).otherwise(shard_of(ends)).alias("shard")))


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", max_rounds: int | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row, under the law ``rows``.

    Shards differ by at most one row. All documents of equal texts are linked; only a group larger than a shard is cut, into
    pieces that fill shards and one for the rest. Rows start balanced exactly, with nearly all pieces whole, and every round
    swaps equal numbers, so the law holds at any time. A smaller group is in two shards or more only where the law leaves no
    shard with enough rows to swap for it. ``slot`` counts the rows of a shard from 0, pieces
    together. ``size`` is the bytes of the text plus 16; NULL counts as no bytes and equals the empty text. NULL and
    repeated ids are rows like any other. ``grown_shard`` is NULL: rows may move when shards are added.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.octet_length(body).cast("bigint").alias("bytes"),
                       F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest"))
    total = rows.count()
    least, most = max(1, total // shards), -(-total // shards)
    placed = with_position(rows.withColumn("one", F.lit(0)), ["one"], [F.col("digest"), F.col("doc_id")], "node").drop("one")
    groups = stable(placed.groupBy("digest").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")))  # a plain table, so a frequent digest can be split in the join
    offset = F.col("node") - F.col("first")
    placed = placed.join(groups, "digest").withColumn("piece", F.when(F.col("n") > most, F.col("node") - offset % least).otherwise(F.col("first")))
    placed = stable(placed.select("node", "piece", (F.col("n") == 1).alias("free"), "doc_id", "bytes", "text_crc32"))
    step = F.when(F.col("n") > most, F.lit(least)).otherwise(F.col("n"))
    sizes = groups.filter("n > 1").withColumn("step", step).select(
        "first", "n", "step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.col("step"))).alias("at")).select(
        (F.col("first") + F.col("at")).alias("piece"), F.least("step", F.col("n") - F.col("at")).alias("n"))
    shard = propagate(_start(placed.select("node", "piece", "free"), sizes, shards, total), shards, max_rounds).select("node", "shard")
    out = with_position(placed.join(shard, "node"), ["shard"], [F.col("piece"), F.col("node")], "slot")
    return out.select("doc_id", (F.col("bytes") + 16).alias("size"), "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("piece").alias("linked_piece"))
