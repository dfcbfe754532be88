"""Sharding by a histogram sort, with DataFrame operations only.

The sort key of a document is a hash of its text, so equal texts stand together. Bytes are
counted exactly: a first histogram over coarse key cells finds the cell in which each shard
boundary falls, the next looks into those cells only, and so on until every boundary is
within tolerance. Then the documents are exchanged once, by shard and fine key range.

Texts that fill more than ``tolerance`` of a shard (at most ``n_shards / tolerance`` of them,
because all together fill ``n_shards`` shards) are placed first, whole, each into the emptiest
shard; one that exceeds a whole shard is dealt out by document. The boundaries then share
the rest so that all shards come out equal.

Defined cases: a null text has no bytes and counts as size 1, as an empty one does; documents
without id and repeated rows are placed like others; ties (equal texts) stand by a hash of the id;
a text of any length is one document, whole; with no documents there are no rows; other columns are kept, but for those
named like the ones added, whatever their names.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.names import unused
from perkline.llm.storage import stored

KEY_BITS, RADIX_BITS = 63, 8
FINE_BITS = 12  # key ranges inside a shard: the unit of the final exchange
PARTS = 256  # of a text that exceeds a shard


def text_key(text: Column) -> Column:
    """Non-negative 63-bit hash; equal texts have equal keys."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def splitters(
    keys: DataFrame, key: str, weight: str, targets: list[float], slack: float, bits: int = KEY_BITS
) -> list[int]:
    """For each target (ascending) a boundary b such that the weight of ``key < b`` is within ``slack`` of it.

    ``key`` is a number from 0 to ``2 ** bits - 1``. Each round collects at most
    ``2 ** RADIX_BITS`` sums per boundary. Where a single key outweighs the slack, the
    boundary is the nearer of its two sides.
    """
    found: dict[int, int] = {}
    # target -> (cell prefix, weight before the cell); all start in the one cell that holds everything
    open_cells = {i: (0, 0) for i in range(len(targets))}
    shift = bits
    while open_cells:
        above, shift = shift, max(0, shift - RADIX_BITS)
        wanted = sorted({cell for cell, _ in open_cells.values()})
        rows = keys if above >= bits else keys.where(F.shiftright(key, above).isin(wanted))
        sums: dict[int, dict[int, int]] = {}
        for cell, total in (
            rows.groupBy(F.shiftright(key, shift).alias("cell")).agg(F.sum(weight)).collect()
        ):
            sums.setdefault(cell >> (above - shift), {})[cell] = total
        still = {}
        for i, (parent, before) in open_cells.items():
            cells = sorted(sums.get(parent, {}).items())
            last = (parent + 1) << (above - shift)
            for cell, total in cells:
                if before + total >= targets[i]:
                    last = cell
                    break
                before += total
            else:
                total = 0
            low, high = targets[i] - before, before + total - targets[i]
            if min(low, high) <= slack or shift == 0:
                found[i] = (last if low <= high else last + 1) << shift
            else:
                still[i] = (last, before)
        open_cells = still
    return [found[i] for i in range(len(targets))]


def _placed(items: list[tuple[int, int, int]], n_shards: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Each item (key, part, bytes), the largest first, into the emptiest shard; and the loads."""
    loads = [(0, s) for s in range(n_shards)]
    placed = []
    for key, part, total in sorted(items, key=lambda x: (-x[2], x[0], x[1])):
        load, shard = heapq.heappop(loads)
        placed.append((key, part, shard))
        heapq.heappush(loads, (load + total, shard))
    return placed, [load for load, _ in sorted(loads, key=lambda x: x[1])]


def _room(loads: list[int], rest: int) -> list[float]:
    """What each shard takes of the rest so that all are filled to one level."""
    level = 0.0
    for n, load in enumerate(sorted(loads), 1):
        level = (rest + sum(sorted(loads)[:n])) / n
        if n == len(loads) or level <= sorted(loads)[n]:
            break
    return [max(0.0, level - load) for load in loads]


def shard_documents(docs: DataFrame, n_shards: int = 16, tolerance: float = 0.01) -> DataFrame:
    """``docs`` with ``size`` (bytes plus one), ``shard`` (0 ..) and ``slot`` (0 .. without gaps in its shard).

    Needs the columns doc_id and text; columns named like those added are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("size", "shard", "slot")
    key, own, at_part, at_placed, at_fine, first, row = unused(
        docs.columns, "_key", "_own", "_part", "_placed", "_fine", "_first", "_row"
    )
    keyed = docs.select(
        "*",
        byte_size(F.col("text")).alias("size"),
        text_key(F.col("text")).alias(key),
        F.xxhash64(F.col("doc_id"), F.lit(1)).alias(own),
    )
    keys = stored(keyed.select("size", key, own), "shard-keys")

    total = keys.agg(F.sum("size")).first()[0] or 0
    share = total / n_shards
    heavy = (
        keys.groupBy(key).agg(F.sum("size").alias("total")).where(F.col("total") > share * tolerance).collect()
    )
    over = [r[key] for r in heavy if r["total"] > share]
    items = [(r[key], -1, r["total"]) for r in heavy if r["total"] <= share]
    part = F.pmod(F.col(own), F.lit(PARTS)).cast("int")
    if over:
        parts = keys.where(F.col(key).isin(over)).groupBy(key, part.alias("part"))
        items += [tuple(r) for r in parts.agg(F.sum("size")).collect()]
    placed, loads = _placed(items, n_shards)
    placed_table = spark.createDataFrame(placed, f"{key} long, {at_part} int, {at_placed} int")

    room = _room(loads, total - sum(loads))
    targets = [sum(room[: i + 1]) for i in range(n_shards - 1)]
    light = keys.join(F.broadcast(placed_table.select(key).distinct()), key, "left_anti")
    bounds = splitters(light, key, "size", targets, share * tolerance / 10) if total else []

    def assigned(df: DataFrame) -> DataFrame:
        by_key = F.lit(0)
        for bound in bounds:
            if bound >> KEY_BITS:  # above every key
                continue
            by_key = by_key + (F.col(key) >= bound).cast("int")
        fine = F.when(F.col(at_placed).isNull(), F.shiftright(key, KEY_BITS - FINE_BITS)).otherwise(
            F.pmod(F.col(own), F.lit(1 << FINE_BITS))
        )
        df = df.withColumn(at_part, F.when(F.col(key).isin(over), part).otherwise(F.lit(-1)))
        # At most n_shards / tolerance texts and n_shards * PARTS parts of texts.
        df = df.join(F.broadcast(placed_table), [key, at_part], "left")
        return df.select("*", F.coalesce(at_placed, by_key).alias("shard"), fine.cast("int").alias(at_fine))

    ahead = Window.partitionBy("shard").orderBy(at_fine).rowsBetween(Window.unboundedPreceding, -1)
    first_slot = (
        assigned(keys)
        .groupBy("shard", at_fine)
        .agg(F.count("*").alias("n"))
        .select("shard", at_fine, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy("shard", at_fine).orderBy(key, own, "doc_id")
    return (
        assigned(keyed)
        .withColumn(row, F.row_number().over(inside))
        .join(first_slot, ["shard", at_fine])
        .select(*docs.columns, "size", "shard", (F.col(first) + F.col(row) - 1).alias("slot"))
    )
