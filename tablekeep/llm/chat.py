"""Chat formatting as prefix trees: turns that conversations share at their start are emitted once.

A node is a turn together with all turns before it (a chained hash), so conversations that begin alike share nodes, and
those with one first turn form a tree. The distinct conversations are sorted by their paths of hashes; each node belongs
to the first conversation with it, and the nodes that one conversation owns are a *segment*: a run of the depth-first
order. A node carries its ids, where they start in the tree, the position id of its first token (as in the conversation
read alone), and the intervals it attends to: runs of its ancestors, then its own segment up to itself.

Template: ``### role: text </turn>`` and a line feed. In texts and roles a backslash, a ``#``, the slash of ``</turn>``
(and a colon in a role) get a backslash before them, so no control string is left in them and the parse is exact.

Defined cases: null roles and texts are empty; turns are ordered by turn (null first), role, text, and repeated rows are
turns of their own; a null ``conv_id`` is one conversation; an empty table gives empty tables; other columns are ignored.
A conversation is read in order by one task, row by row, whatever its length; trees and shared turns are never in one task.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablekeep.llm.common import partitions, settled, text_or_empty
from tablekeep.llm.tokens import ByteLevelEncoder
from tablekeep.session import Workspace, col

# The template.
OPEN, BETWEEN, CLOSE = "### ", ": ", " </turn>\n"
LEARNED_ROLE = "assistant"

_CONTROL = re.compile(r"\\|#|(?<=<)/(?=turn>)")
_CONTROL_OF_ROLE = re.compile(r"\\|#|:|(?<=<)/(?=turn>)")
_TURN = re.compile(r"### ((?:[^:\\]|\\.)*): (.*) </turn>\n", re.DOTALL)

TURN_SCHEMA = (
    "conv_id long, depth long, node binary, tree binary, formatted string, ids binary, n_tokens long, "
    "position_start long, loss_start long, loss_end long, path binary"
)
BATCH_ROWS = 2000


def escaped(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def formatted_turn(role: str, text: str) -> tuple[str, int | None, int | None]:
    """The turn as the template has it, and the span of it that is learned, if any."""
    head = OPEN + escaped(role, _CONTROL_OF_ROLE) + BETWEEN
    body = escaped(text)
    span = (len(head), len(head) + len(body)) if role == LEARNED_ROLE else (None, None)
    return (head + body + CLOSE, *span)


def parsed_turn(formatted: str) -> tuple[str, str]:
    """The role and the text of one formatted turn."""
    found = _TURN.fullmatch(formatted)
    if found is None:
        raise ValueError(f"not a turn: {formatted[:80]!r}")
    return unescaped(found[1]), unescaped(found[2])


def _turns(batches, tokenizer: str):
    """Chain, format and tokenise turns that come sorted by conversation; what a conversation needs so far is carried over."""
    encoder = ByteLevelEncoder(tokenizer)
    fields = ("conv_id", "depth", "node", "tree", "formatted", "ids", "n_tokens", "position_start", "loss_start", "loss_end", "path")
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary(), *[pa.int64()] * 4, pa.binary())
    rows: list[list] = []
    last: list | None = None
    path = bytearray()

    def batch_of(some):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=fields)

    for batch in batches:
        for conv, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            same = last is not None and last[0] == conv
            if last is not None:
                if not same:
                    last[-1] = bytes(path)
                rows.append(last)
            if not same:
                path.clear()
            parent = last[2] if same else b""
            written, loss_start, loss_end = formatted_turn(role, text)
            node = hashlib.blake2b(parent + written.encode(), digest_size=16).digest()
            path += node[:8]
            ids = encoder.ids(written)
            last = [
                conv, last[1] + 1 if same else 0, node, last[3] if same else node, written, ids.tobytes(), len(ids),
                last[7] + last[6] if same else 0, loss_start, loss_end, None,
            ]
            if len(rows) >= BATCH_ROWS:
                yield batch_of(rows)
                rows = []
    if last is not None:
        last[-1] = bytes(path)
        yield batch_of([*rows, last])


@dataclass
class ChatTrees:
    """``nodes``: tree, segment, node, depth, start, n_tokens, position_start, ids, formatted, loss_start, loss_end,
    attention (segment, start, end), ordered by start within a tree. ``conversations``: conv_id, tree, node (its last turn),
    n_turns. Starts and ends count tokens of the tree."""

    nodes: DataFrame
    conversations: DataFrame


def format_conversations(conversations: DataFrame, tokenizer: str, ws: Workspace) -> ChatTrees:
    spark = conversations.sparkSession
    parts = partitions(spark)
    rows = conversations.select(
        col("conv_id"), col("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text")
    )
    ordered = rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    turns = settled(ordered.mapInArrow(lambda batches: _turns(batches, tokenizer), TURN_SCHEMA), ws, "turns")

    ends = turns.where(F.col("path").isNotNull()).select(
        "conv_id", "tree", "node", (F.col("depth") + 1).alias("n_turns"), "path"
    )
    # Distinct conversations in the order of their paths. The rank is written down, so it is the same for every later use.
    leaves = ends.groupBy("node", "tree").agg(F.min("path").alias("path"))
    in_order = leaves.repartitionByRange(parts, "path").sortWithinPartitions("path")
    leaves = settled(in_order.select("node", F.monotonically_increasing_id().alias("segment")), ws, "leaves")

    conversation_of = ends.join(leaves, "node").select("conv_id", "segment")
    on_path = turns.join(conversation_of, turns["conv_id"].eqNullSafe(conversation_of["conv_id"])).select("segment", "node", "depth")
    owners = on_path.groupBy("node").agg(F.min("segment").alias("segment"))
    # All that follows is about numbers; texts and ids wait, once per node, to be joined at the end.
    once = turns.groupBy("node").agg(*(F.first(c).alias(c) for c in ("tree", "depth", "n_tokens", "position_start")))
    nodes = settled(once.join(owners, "node"), ws, "owned")

    # Starts: tokens before a segment in all trees (sums per range of segments first), less those before its tree.
    segments = nodes.groupBy("segment", "tree").agg(F.sum("n_tokens").alias("n"), F.min("depth").alias("top"))
    segments = segments.withColumn("range", F.shiftright("segment", 33))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = segments.groupBy("range").agg(F.sum("n").alias("all")).select("range", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("so_far"))
    running = W.partitionBy("range").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    segments = (
        segments.withColumn("at", F.coalesce(F.sum("n").over(running), F.lit(0)))
        .join(F.broadcast(ranges), "range")  # a row per range, of which there are as many as partitions
        .select("segment", "tree", "top", (F.col("at") + F.col("so_far")).alias("at"))
    )
    segments = settled(segments, ws, "segments")
    trees = segments.groupBy("tree").agg(F.min("at").alias("tree_at"))
    starts = segments.join(trees, "tree").select("segment", "top", (F.col("at") - F.col("tree_at")).alias("segment_start"))
    inside = W.partitionBy("segment").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    placed = nodes.join(starts, "segment").withColumn(
        "start", F.col("segment_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    )
    placed = settled(placed, ws, "placed")

    # The ancestors of a segment: along its conversation, nodes that other segments own are one run per segment.
    where = placed.select("node", F.col("segment").alias("of"), "start", (F.col("start") + F.col("n_tokens")).alias("end"))
    above = on_path.distinct().join(starts.select("segment", "top"), "segment").where(F.col("depth") < F.col("top"))
    runs = above.join(where, "node").groupBy("segment", "of").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    run = F.struct("start", "end", F.col("of").alias("segment"))
    ancestors = runs.groupBy("segment").agg(F.sort_array(F.collect_list(run)).alias("ancestors"))
    own = F.struct(F.col("segment_start").alias("start"), (F.col("start") + F.col("n_tokens")).alias("end"), F.col("segment"))
    attention = F.concat(F.coalesce("ancestors", F.array().cast("array<struct<start:bigint,end:bigint,segment:bigint>>")), F.array(own))
    attending = placed.join(ancestors, "segment", "left").withColumn("attention", attention)
    written = turns.groupBy("node").agg(*(F.first(c).alias(c) for c in ("formatted", "ids", "loss_start", "loss_end")))
    nodes = attending.join(written, "node").select(
        "tree", "segment", "node", "depth", "start", "n_tokens", "position_start", "ids", "formatted", "loss_start", "loss_end", "attention"
    )
    return ChatTrees(settled(nodes, ws, "nodes"), ends.select("conv_id", "tree", "node", "n_turns"))


def position_ids(nodes: DataFrame) -> DataFrame:
    """The position id of every token of a node, as an array."""
    last = F.col("position_start") + F.col("n_tokens") - 1
    return nodes.withColumn("position_ids", F.sequence("position_start", last))


def read_back(trees: ChatTrees) -> DataFrame:
    """The formatted turns of every conversation, found by what its last node attends to: conv_id, depth, formatted, loss_*."""
    ends = trees.conversations.join(trees.nodes.select("node", "attention"), "node")
    intervals = ends.select("conv_id", F.explode("attention").alias("i")).select(
        "conv_id", F.col("i.segment").alias("segment"), F.col("i.end").alias("end")
    )
    written = trees.nodes.select("segment", "start", "depth", "formatted", "loss_start", "loss_end")
    met = intervals.join(written, "segment").where(F.col("start") < F.col("end"))
    return met.select("conv_id", "depth", "formatted", "loss_start", "loss_end")


def _digest(batches):
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    nothing = object()
    conv, rows, state = nothing, [], None

    def closed():
        n, turns, loss_chars, loss, chars = state
        return (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

    def batch_of(some):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)

    for batch in batches:
        for of, formatted, start, end in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end"))):
            if conv is nothing or of != conv:
                if conv is not nothing:
                    rows.append(closed())
                conv, state = of, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parsed_turn(formatted)
            learned = "" if start is None else unescaped(formatted[start:end])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            state[2] += len(learned)
            state[3].update(learned.encode())
            state[4] += len(formatted)
            if len(rows) >= BATCH_ROWS:
                yield batch_of(rows)
                rows = []
    if conv is not nothing:
        yield batch_of([*rows, closed()])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation of ``read_back``: number of turns and digests of them, of the learned text, and the length."""
    ordered = turns.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(
        _digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
