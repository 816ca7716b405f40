"""Prefix trie of conversations, built as a burst trie: heads burst by next turn, containers sorted and swept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_per_key, numbered, released, stream_groups

NODE = "struct<hi:bigint,lo:bigint>"
_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _digest(data: bytes) -> tuple[int, int, bytes]:
    raw = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True), raw


def _node(hi: str, lo: str):
    return F.struct(F.col(hi).alias("hi"), F.col(lo).alias("lo"))


def ordered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv, pos (from 0), id, chars of ``conversations(conv_id, turn, role, text)``; texts become digests.

    Turns are placed by one range partitioning over all rows, so that one long conversation lies in many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat_ws(":", F.char_length(role).cast("string"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(F.sha2(said.cast("binary"), 256), 1, 32)).alias("id"), F.char_length(text).cast("long").alias("chars")
    )
    placed = numbered(scratch.save(rows, "turns"), [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("id")], scratch, "placed")
    convs = scratch.save(placed.groupBy("conv").agg(F.min("number").alias("first"), F.count("*").alias("n")), "first")
    return join_per_key(placed, convs, "conv").select("conv", (F.col("number") - F.col("first")).alias("pos"), "id", "chars")


def rebuilt_turns(turns: DataFrame, scratch: Scratch, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): each conversation c begins with the first h turns of c - c % group, then come its own
    after h; h is the CRC-32 of c modulo ``heads``. Turns are conv, depth (from 1), id, chars; conversations conv, length."""
    turns = scratch.save(turns, "own")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h")
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv", "n", h, (F.col("conv") - F.col("conv") % group).alias("base"))
    # At most heads - 1 turns of a conversation; at most 2 * group conversations share a base.
    lead = turns.where((F.col("conv") % group == 0) & (F.col("pos") < heads - 1)).groupBy(F.col("conv").alias("base"))
    lead = lead.agg(F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("lead"))
    convs = convs.join(lead, "base", "left").withColumn("lead", F.coalesce(F.expr("slice(lead, 1, h)"), F.expr("array()")))
    convs = scratch.save(convs.withColumn("length", F.size("lead") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "convs")
    own = join_per_key(turns, convs.select("conv", "h", F.size("lead").alias("k"), "n"), "conv").where("pos >= h")
    own = own.select("conv", (F.col("k") + F.col("pos") - F.col("h") + 1).cast("long").alias("depth"), "id", "chars")
    led = convs.select("conv", F.explode("lead").alias("t")).select("conv", (F.col("t.pos") + 1).cast("long").alias("depth"), "t.id", "t.chars")
    return scratch.save(own.unionByName(led), "rebuilt"), convs.select("conv", F.col("length").cast("long").alias("length"))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per turn of the members' windows: the node it leads to, a digest of the path, and the node before."""
    names = ["conv", "length", "depth", "hi", "lo", "up_hi", "up_lo", "own", "chars"]
    for batch in batches:
        out: dict[str, list] = {n: [] for n in names}
        for row in batch.to_pylist():
            hi, lo, chars = row["hi"], row["lo"], row["chars"]
            raw = hi.to_bytes(8, "big", signed=True) + lo.to_bytes(8, "big", signed=True)
            for k, turn in enumerate(row["turns"]):
                up_hi, up_lo = hi, lo
                hi, lo, raw = _digest(raw + turn["id"])
                chars += turn["chars"]
                for n, v in zip(names, (row["conv"], row["length"], row["depth"] + 1 + k, hi, lo, up_hi, up_lo, turn["chars"], chars)):
                    out[n].append(v)
            if len(out["conv"]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[n], pa.int64()) for n in names], names)
                out = {n: [] for n in names}
        yield pa.RecordBatch.from_arrays([pa.array(out[n], pa.int64()) for n in names], names)


def _burst(turns: DataFrame, convs: DataFrame, scratch: Scratch, most_turns: int, window: int) -> tuple[DataFrame, DataFrame]:
    """(head steps, containers) once no container has more than ``most_turns`` turns below its head.

    A round bursts all open containers by their next turns, ``window`` levels at a time, twice as many in each next
    round up to 2^14: a member is read with a bounded number of turns, and a node's size is a pre-aggregated sum. A
    member goes down to the first node that is small enough or that it has alone, which becomes the head of a
    container, or it stays open to the next round. The root is always burst.
    """
    root = _digest(b"")
    open_ = convs.select("conv", "length", F.lit(root[0]).alias("hi"), F.lit(root[1]).alias("lo"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars")).where("length > 0")
    steps, heads, depth, number = [], [], 0, 0
    while True:
        near = turns.where((F.col("depth") > depth) & (F.col("depth") <= depth + window))
        near = near.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("depth", "id", "chars"))).alias("turns"))
        found = open_.join(near, "conv").mapInArrow(released(_steps), "conv long, length long, depth long, hi long, lo long, up_hi long, up_lo long, own long, chars long")
        found = found.select("conv", "length", "depth", _node("hi", "lo").alias("node"), _node("up_hi", "up_lo").alias("up"), "own", "chars")
        found = scratch.save(found, f"steps{number}")
        sizes = found.groupBy("node").agg(F.count("*").alias("n"), F.min("conv").alias("least"), F.sum(F.col("length") - F.col("depth")).alias("below"))
        small = (F.col("n") == 1) | (F.col("below") <= most_turns)
        sized = join_per_key(found, scratch.save(sizes.select("node", "n", "least", small.alias("small"), F.col("n").alias("members")), f"sizes{number}"), "node")
        at = F.struct("depth", "node", "up", "own", "chars", "least", "small", "members")
        path = sized.groupBy("conv", "length").agg(F.sort_array(F.collect_list(at)).alias("path"))
        path = path.withColumn("head", F.expr("get(filter(path, s -> s.small), 0)"))
        path = scratch.save(path.withColumn("path", F.expr("filter(path, s -> head is null or s.depth <= head.depth)")), f"path{number}")
        steps.append(path.select("conv", "length", F.explode("path").alias("s")).select("conv", "length", "s.*"))
        heads.append(path.where("head is not null and length > head.depth").select("conv", "length", "head.*"))
        depth, number = depth + window, number + 1
        window = min(2 * window, 1 << 14)
        open_ = path.where(F.col("head").isNull() & (F.col("length") > depth)).select("conv", "length", F.element_at("path", -1).alias("s")).select("conv", "length", "s.node.*", "s.depth", "s.chars")
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, steps), reduce(DataFrame.unionByName, heads)


def _sweep(key: tuple, rows: pa.Table) -> dict:
    """Nodes below the head of one container: sequences are sorted, and a stack holds the path of the present one.

    The first row sums the container up for its head: children, leaves and saved tokens below it.
    """
    order = np.lexsort((rows["depth"].to_numpy(), rows["conv"].to_numpy()))
    conv, chars, ids = rows["conv"].to_numpy()[order], rows["chars"].to_numpy()[order], rows["id"].take(pa.array(order)).to_pylist()
    starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]])).tolist()
    members = sorted((ids[a:b], int(conv[a]), chars[a:b].tolist()) for a, b in zip(starts, [*starts[1:], len(conv)]))
    first, top = rows["least"][0].as_py(), rows["head_depth"][0].as_py()
    # A node: depth, parent, members, least member, children, leaves, saved, ends, code points of its last text.
    nodes: list[list] = [[top, None, 0, first, 0, 0, 0, [], 0]]
    stack, before = [0], []
    for turns, member, sizes in members:
        same = next((i for i, (a, b) in enumerate(zip(before, turns)) if a != b), min(len(before), len(turns)))
        del stack[same + 1 :]
        for k in range(same, len(turns)):
            nodes.append([top + 1 + k, stack[-1], 0, member, 0, 0, 0, [], sizes[k]])
            nodes[stack[-1]][4] += 1
            stack.append(len(nodes) - 1)
        for at in stack[1:]:
            nodes[at][2] += 1
            nodes[at][3] = min(nodes[at][3], member)
        nodes[stack[-1]][7].append(member)
        before = turns
    for node in reversed(nodes[1:]):  # children come after their parents
        node[5] += 0 if node[4] else 1
        node[6] += (node[2] - 1) * node[8]
        nodes[node[1]][5] += node[5]
        nodes[node[1]][6] += node[6]
    out = {
        "conv_id": [n[3] for n in nodes],
        "depth": [n[0] for n in nodes],
        "parent_conv_id": [first if n[1] is None else nodes[n[1]][3] for n in nodes],
        "n_convs": [n[2] for n in nodes],
        "n_children": [n[4] for n in nodes],
        "n_leaves": [n[5] for n in nodes],
        "saved_tokens": [n[6] for n in nodes],
        "hi": [key[0]] * len(nodes),
        "lo": [key[1]] * len(nodes),
        "member": [members[0][1]] * len(nodes),
    }
    arrays = {k: np.array(v, np.int64) for k, v in out.items()}
    arrays["ends_sha256"] = np.array([hashlib.sha256(",".join(map(str, sorted(n[7]))).encode()).hexdigest() for n in nodes], object)
    arrays["ends_sha256"][0] = None
    return arrays


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined members of runs of one node, in the order of the rows."""
    number = 0
    for batch in batches:
        hi, lo = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        conv, part = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])).tolist() if len(hi) else []
        ends = [*starts[1:], len(hi)]
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(hi[starts]), pa.array(lo[starts]), pa.array(part[starts]), pa.array(np.arange(number, number + len(starts))), pa.array(text, pa.string())], ["hi", "lo", "part", "number", "text"])
        number += len(starts)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, fed one after the other."""
    now, state = None, None
    out: list[tuple] = []
    for batch in batches:
        for hi, lo, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (hi, lo) != now:
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (hi, lo), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if len(out) > 20_000:
            yield _hashes(out)
            out = []
    if now:
        out.append((*now, state.hexdigest()))
    yield _hashes(out)


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["hi", "lo", "ends_sha256"])


def _ends(steps: DataFrame) -> DataFrame:
    """node, ends_sha256 of the nodes where conversations end.

    Rows are dealt out by ranges of node and conversation; each task joins its ids to text, and a node's texts are
    hashed in their order as they are read, so that a node with very many ends is held by no task.
    """
    rows = steps.where("depth = length").select("node.hi", "node.lo", "conv")
    rows = rows.repartitionByRange("hi", "lo", "conv").sortWithinPartitions("hi", "lo", "conv").withColumn("part", F.spark_partition_id().cast("long"))
    text = rows.mapInArrow(_chunks, "hi long, lo long, part long, number long, text string")
    text = text.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "part", "number").select("hi", "lo", "text")
    return text.mapInArrow(_hash_chunks, "hi long, lo long, ends_sha256 string").select(_node("hi", "lo").alias("node"), "ends_sha256")


def _head_nodes(steps: DataFrame, below: DataFrame, scratch: Scratch) -> DataFrame:
    """The burst nodes as result rows.

    A node saves its last text for all members but the least. A conversation is the least member from some depth on,
    so it adds to each node of its path the code points from there down to that depth: sums over a node's members
    give what its subtree saves, without going up the trie level by level. ``below`` has what containers hold, by a
    member each.
    """
    nodes = steps.groupBy("node", "up", "depth").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n"), F.max("length").alias("longest"))
    nodes = scratch.save(nodes, "nodes")
    least = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("least_from"), F.sum((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    saves = join_per_key(steps.select("conv", "depth", "chars"), scratch.save(_per_conv(steps).join(least, "conv", "left"), "least"), "conv")
    saves = saves.where("least_from is null or depth < least_from").groupBy("conv").agg(F.max("chars").alias("until"))
    member = below.groupBy(F.col("member").alias("conv")).agg(F.sum("n_leaves").alias("leaves_below"), F.sum("saved_tokens").alias("saved_below"))
    each = _per_conv(steps).join(least, "conv", "left").join(saves, "conv", "left").join(member, "conv", "left")
    each = each.select("conv", "n", (F.coalesce("leaf", F.lit(0)) + F.coalesce("leaves_below", F.lit(0))).alias("leaves"), F.coalesce("saved_below", F.lit(0)).alias("saved_below"), F.coalesce("until", F.lit(0)).alias("until"))
    rows = join_per_key(steps.select("conv", "node", "own", "chars"), scratch.save(each, "each"), "conv")
    saved = F.greatest(F.lit(0), F.col("until") - F.col("chars") + F.col("own")) + F.col("saved_below")
    sums = rows.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum(saved).alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("burst"))
    children = children.join(below.select("node", F.col("n_children").alias("held")), "node", "full_outer").select("node", (F.coalesce("burst", F.lit(0)) + F.coalesce("held", F.lit(0))).alias("n_children"))
    parents = nodes.join(children, "node", "left").select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"), F.coalesce("n_children", F.lit(1)).alias("n"))
    with_parent = join_per_key(nodes.where("depth > 0"), scratch.save(parents, "parents"), "up").unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    out = with_parent.join(sums, "node").join(children, "node", "left").join(_ends(steps), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def _per_conv(steps: DataFrame) -> DataFrame:
    return steps.groupBy("conv").agg(F.count("*").alias("n"))


def trie_nodes(turns: DataFrame, convs: DataFrame, scratch: Scratch, most_turns: int = 2000, window: int = 8) -> DataFrame:
    """A row per distinct prefix of the sequences ``turns(conv, depth, id, chars)`` of ``convs(conv, length)``.

    Containers of at most ``most_turns`` turns are swept in one task each. A conversation that has a container to
    itself is a chain of nodes of its own, which needs no task that holds it.
    """
    steps, heads = _burst(turns, convs, scratch, most_turns, window)
    root = _digest(b"")
    at_root = F.struct(F.lit(root[0]).alias("hi"), F.lit(root[1]).alias("lo"))
    zero = F.lit(0).cast("long")
    steps = convs.select("conv", "length", zero.alias("depth"), at_root.alias("node"), at_root.alias("up"), zero.alias("own"), zero.alias("chars")).unionByName(steps.select("conv", "length", "depth", "node", "up", "own", "chars"))
    heads = heads.select("conv", "length", F.col("depth").alias("head_depth"), "node", "least", (F.col("members") == 1).alias("alone"), F.col("length").alias("n"))
    held = join_per_key(turns, scratch.save(heads, "heads"), "conv").where("depth > head_depth")

    one = held.where("alone")
    ends = F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(_EMPTY)
    last = F.col("depth") == F.col("length")
    chains = one.select(F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), (~last).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), ends.alias("ends_sha256"))

    many = held.where("not alone").select("node.hi", "node.lo", "conv", "depth", "id", "chars", "least", "head_depth")
    shape = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, hi long, lo long, member long, ends_sha256 string"
    swept = scratch.save(stream_groups(many, ["hi", "lo"], _sweep, shape), "swept")
    below = swept.where("ends_sha256 is null").select(_node("hi", "lo").alias("node"), "member", "n_children", "n_leaves", "saved_tokens")
    lone = heads.where("alone").select("node", F.col("conv").alias("member"), F.lit(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"))
    top = _head_nodes(steps, scratch.save(below.unionByName(lone), "below"), scratch)
    return top.unionByName(chains).unionByName(swept.where("ends_sha256 is not null").select(_COLUMNS))


def conversation_trie(conversations: DataFrame, group: int = 100, heads: int = 6, most_turns: int = 2000, window: int = 8) -> DataFrame:
    """A row per node of the prefix trie of the rebuilt ``conversations(conv_id, turn, role, text)``: conv_id (its
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, null first; equal turns by a digest of role and text. Null roles and texts are empty.
    Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of their own. An empty
    table has no conversation and gives no row; otherwise the root counts all of them.

    Conversations begin with the turns of the first of their group (``rebuilt_turns``). The trie is a burst trie
    (``_burst``, ``_sweep``); turns are known by 128-bit digests, and no text is moved.
    """
    scratch = Scratch(conversations.sparkSession)
    turns, convs = rebuilt_turns(ordered_turns(conversations, scratch), scratch, group, heads)
    return trie_nodes(turns, convs, scratch, most_turns, window)
