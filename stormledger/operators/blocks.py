"""Header/detail block join: a range join on the line index by a dyadic interval tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_ROWS, FAN_OUT, key_cuts, on_grid, skew_safe_join
from .staging import stage

CELL_BITS = 5  # 32 lines per leaf of the tree
# Blocks on one node that meet their lines in one task.
NODE_BLOCKS = 1_000

_NODE, _FIRST, _LAST, _SALT, _SALTS, _CHUNK, _CHUNKS = (
    "__node", "__first", "__last", "__salt", "__salts", "__chunk", "__chunks"
)


def covering_nodes(first: str, last: str) -> Column:
    """The nodes, at most two per level, that together hold exactly the leaves ``first`` to ``last`` (columns).

    Node ``i`` of level ``l`` holds the leaves from ``i << l`` to ``(i + 1 << l) - 1``; it is the number ``i << 6 | l``. Bottom up, a level
    hands on all its nodes but an odd one at the front and an even one at the back: their parents hold more than asked for.
    """
    low = f"shiftright({first} + shiftleft(1L, l) - 1, l)"
    end = f"shiftright({last} + 1, l)"
    front = f"if({low} < {end} and {low} & 1L = 1, shiftleft({low}, 6) | l, null)"
    back = f"if({low} < {end} and {end} & 1L = 1, shiftleft({end} - 1, 6) | l, null)"
    levels = f"sequence(0, length(bin({last} - {first} + 1)))"
    return F.expr(f"flatten(transform({levels}, l -> array_compact(array({front}, {back}))))")


def level_of(node: str) -> Column:
    return F.col(node).bitwiseAND(63).cast("int")


def with_ancestors(lines: DataFrame, line_id: str, levels: list[int], cell_bits: int) -> DataFrame:
    """A row per line and level: the node of that level that holds the line."""
    nodes = [F.shiftleft(F.shiftright(line_id, cell_bits + l), 6).bitwiseOR(F.lit(l).cast("bigint")) for l in levels]
    return lines.withColumn(_NODE, F.explode(F.array(*nodes)) if len(nodes) > 1 else nodes[0])


def split_levels(counts: dict[int, int], most: int) -> tuple[list[int], list[int]]:
    """(fine, coarse) levels: the coarse ones from the top down as long as they hold at most ``most`` nodes together."""
    coarse, held = [], 0
    for level in sorted(counts, reverse=True):
        held += counts[level]
        if held > most:
            break
        coarse.append(level)
    return sorted(set(counts) - set(coarse)), sorted(coarse)


def block_join(
    headers: DataFrame,
    details: DataFrame,
    header_id: str = "header_id",
    entries: str = "entries",
    line_id: str = "stat_id",
    cell_bits: int = CELL_BITS,
    broadcast_nodes: int = BROADCAST_ROWS,
    node_blocks: int = NODE_BLOCKS,
) -> DataFrame:
    """Pairs with ``header_id <= line_id <= header_id + entries``, one row per pair.

    Blocks may overlap (a line then appears once per block) and may leave lines
    out. A header without entries, or with fewer than none, has no block.

    The line axis is cut into leaves of ``2 ** cell_bits`` lines, the leaves of a binary tree. A block becomes the few nodes that
    cover it, two per level at most; a line asks its leaf and the leaf's ancestors, on those levels only that hold a node. Each
    pair meets at one node, and only a block's two end leaves can hold lines outside it.

    Long blocks lie on coarse nodes. From the top of the tree down these are broadcast, as many levels as hold at most
    ``broadcast_nodes`` nodes together, so that a block of most of the feed moves no line. On the finer levels lines are shuffled to
    their nodes. A node with more than ``node_blocks`` blocks is met in parts of that many, whose lines are repeated, however many blocks cover the same lines.

    The nodes are written once (they are as many as headers, times a few). No block goes beyond the feed's last line, whatever its
    header claims; finding that line reads one column of ``details``.
    """
    last_line = F.coalesce(F.try_add(header_id, entries), F.lit(2**63 - 1))
    feed_end = details.agg(F.coalesce(F.max(line_id), F.lit(-1))).scalar()
    bounds = (
        headers.where(F.col(entries) >= 0)
        .withColumn(_FIRST, F.shiftright(header_id, cell_bits))
        .withColumn(_LAST, F.shiftright(F.least(last_line, feed_end), cell_bits))
        .where(F.col(_FIRST) <= F.col(_LAST))
    )
    placed = bounds.withColumn(_NODE, F.explode(covering_nodes(_FIRST, _LAST))).drop(_FIRST, _LAST)
    nodes = stage(placed, "block-nodes")
    # a row per level of the tree, so never more than 63
    counts = dict(nodes.groupBy(level_of(_NODE)).count().collect())
    fine, coarse = split_levels(counts, broadcast_nodes)
    if not counts:
        coarse = [0]
    on_levels = lambda levels: nodes.where(level_of(_NODE).isin(levels)) if fine and coarse else nodes
    parts = []
    if coarse:
        asked = with_ancestors(details, line_id, coarse, cell_bits)
        parts.append(skew_safe_join(asked, on_levels(coarse), _NODE, broadcast_rows=broadcast_nodes, fan_out=min(node_blocks, FAN_OUT)))
    if fine:
        asked, held = with_ancestors(details, line_id, fine, cell_bits), on_levels(fine)
        crowded = stage(key_cuts(held, _NODE, node_blocks, _CHUNKS), "crowded-nodes")
        if crowded.isEmpty():
            parts.append(asked.join(held, _NODE))
        else:
            cut = on_grid(asked, held, crowded.withColumn(_SALTS, F.lit(1)), _NODE)
            parts.append(cut[0].join(cut[1], [_NODE, _SALT, _CHUNK]).drop(_SALT, _CHUNK))
    in_block = F.col(line_id).between(F.col(header_id), last_line)
    return reduce(DataFrame.unionByName, (p.where(in_block).drop(_NODE) for p in parts))
