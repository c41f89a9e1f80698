"""Prefix trie of conversations: sorted matrices of turn ids by range shard, shared nodes recombined."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import partitions
from shopgrain.session import materialize

WIDTH = 32  # columns of a matrix: deeper turns are sorted in further rounds, among rows alike so far
SHARD_TURNS = 500_000  # turns a shard is meant to hold

NODE = (
    "key string, parent_key string, part long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string"
)
NODE_ARROW = pa.schema(
    [
        (name, pa.string() if kind == "string" else pa.int64())
        for name, kind in (c.split() for c in NODE.split(", "))
    ]
)
EMPTY_SHA = hashlib.sha256().hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """Role and text of a turn as one digest; equal turns only have equal ones."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def turn_lists(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``: two halves of the digest and the code points of each turn.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text``. Turns go by their number, null first, equal numbers by
    digest; null role or text counts as empty; rows without a conv_id belong to no conversation.
    A conversation has to fit into a row with 20 bytes a turn; texts are not gathered.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    half = lambda start: F.conv(F.substring("__turn", start, 15), 16, 10).cast("long")
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.length(text).alias("n"),
        turn_digest(role, text).alias("__turn"),
    )
    listed = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", half(1).alias("hi"), half(16).alias("lo"), "n"))).alias("l")
    )
    own = F.transform("l", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["n"].alias("n")))
    return listed.select("conv_id", own.alias("turns"))


def lead_by_first(lists: DataFrame, block: int, most: int) -> DataFrame:
    """Conversations whose first turns are taken from the first of their block of ids.

    conv_id c gets the first h turns of conversation c - c % ``block`` (all if fewer, none if absent), then its own
    after its first h, if any; h is the unsigned CRC-32 of the decimal c, modulo ``most`` + 1. Negative ids
    are cut towards zero.
    """
    leads = lists.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("__first"), F.slice("turns", 1, most).alias("__lead")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    none = F.slice("turns", 1, 0)
    return lists.join(leads, F.col("conv_id") - F.col("conv_id") % block == F.col("__first"), "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("__lead", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))
        ).alias("turns"),
    )


def _find_order(ids: np.ndarray, at: np.ndarray, size: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' order by turn ids, then conv_id, and how many turns each shares with the one before.

    A round sorts a padded matrix of the next columns of those rows that are alike so far; the columns'
    changes, accumulated by OR, tell where the common beginning ends.
    """
    rows = len(size)
    order = np.argsort(conv, kind="stable")
    group = np.zeros(rows, np.int64)  # first place of the rows alike so far
    common = np.full(rows, -1, np.int64)
    done = 0
    while True:
        first = np.flatnonzero(np.diff(group, prepend=-1))
        count = np.diff(np.append(first, rows))
        deep = np.maximum.reduceat(size[order], first) > done if rows else first
        places = np.flatnonzero(np.repeat(deep & (count > 1), count))
        if not len(places):
            break
        row = order[places]
        matrix = np.full((len(row), WIDTH), -1, np.int64)
        column = np.arange(WIDTH)
        filled = column + done < size[row][:, None]
        matrix[filled] = ids[(at[row][:, None] + done + column)[filled]]
        by = np.lexsort((conv[row], *matrix.T[::-1], group[places]))
        order[places], matrix = row[by], matrix[by]
        same = group[places][1:] == group[places][:-1]
        changed = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
        shared = np.minimum((~changed).sum(axis=1), np.maximum(size[row[by]][1:] - done, 0))
        common[places[1:][same]] = done + shared[same]
        new = np.flatnonzero(~same | changed[:, -1]) + 1
        starts = np.zeros(len(places), np.int64)
        starts[0], starts[new] = places[0], places[new]
        group[places] = np.maximum.accumulate(starts)
        done += WIDTH
    common[1:] = np.maximum(common[1:], 0)
    return order, common


def _shared(a: tuple, b: tuple) -> int:
    """How many first turns two lists (of both digest halves) have in common."""
    n = min(len(a[0]), len(b[0]))
    differ = np.flatnonzero((a[0][:n] != b[0][:n]) | (a[1][:n] != b[1][:n]))
    return int(differ[0]) if len(differ) else n


def _keys(halves: tuple, depth: int) -> list[str]:
    """Names of a list's first prefixes, the same in all shards."""
    pairs = np.stack([h[: max(depth, 0)] for h in halves], axis=1).astype("<i8")
    running, out = hashlib.sha256(), []
    for pair in [b"", *(p.tobytes() for p in pairs)]:
        running.update(pair)
        out.append(f"{len(out)}:{running.hexdigest()}")
    return out


def _sha(conv: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, conv.tolist())).encode()).hexdigest()


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one shard; those it shares with its neighbours have a key and are partial.

    ``kind`` marks the last row of the shard before (-1) and the first of the one after (1).
    """
    kind = table.column("kind").to_numpy()
    part = int(table.column("part")[0].as_py())
    lists = table.column("turns").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    hi, lo, n = (lists.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("hi", "lo", "n"))
    halves = lambda i: (hi[offsets[i] : offsets[i + 1]], lo[offsets[i] : offsets[i + 1]])
    mine = np.flatnonzero(kind == 0)
    conv = table.column("conv_id").to_numpy(zero_copy_only=False)[mine].astype(np.int64)
    size, at = np.diff(offsets)[mine], offsets[:-1][mine]

    # Turn ids: places of the digests among the different ones, so their order is kept.
    pairs = np.lexsort((lo, hi))
    fresh = np.concatenate([[False], (np.diff(hi[pairs]) != 0) | (np.diff(lo[pairs]) != 0)])[: len(pairs)]
    ids = np.empty(len(pairs), np.int64)
    ids[pairs] = np.cumsum(fresh)

    order, common = _find_order(ids, at, size, conv)
    conv, size, at, index = conv[order], size[order], at[order], mine[order]
    rows = len(conv)
    before, after = np.flatnonzero(kind == -1), np.flatnonzero(kind == 1)
    # Turns shared with the rows before and after; -1 where there is none.
    common[0] = _shared(halves(before[0]), halves(index[0])) if len(before) else -1
    last = _shared(halves(index[-1]), halves(after[0])) if len(after) else -1
    follow = np.append(common[1:], last)
    shared = np.maximum(common, follow)

    words = np.concatenate([[0], np.cumsum(n)])
    up_to = lambda i, depth: words[at[i] + np.maximum(depth, 0)] - words[at[i]]
    again = up_to(np.arange(rows), common)  # code points of the shared beginning
    leaf = follow < size
    first_keys, last_keys = _keys(halves(index[0]), common[0]), _keys(halves(index[-1]), last)

    out = {c: [] for c in NODE_ARROW.names}

    def emit(count: int, **columns) -> None:
        for c in out:
            value = columns.get(c)
            out[c].append(value if isinstance(value, (np.ndarray, list)) else [value] * count)

    # Nodes with several rows, in this shard or beyond, depth by depth.
    row_conv, row_key = np.full(rows, -1, np.int64), np.full(rows, None, object)  # of the depth above
    single_parent, single_key = np.full(rows, -1, np.int64), np.full(rows, None, object)
    for depth in range(int(shared.max()) + 1 if rows else 0):
        live = np.flatnonzero(shared >= depth)
        starts = np.flatnonzero(common[live] < depth)
        if not len(starts) or starts[0]:
            starts = np.concatenate([[0], starts])  # goes on from the shard before
        reach = np.diff(np.append(starts, len(live)))
        cont = common[live] >= depth  # rows that are not their node's first one
        add = lambda v: np.add.reduceat(v[live].astype(np.int64), starts)  # noqa: B023, E731
        least = np.minimum.reduceat(conv[live], starts)
        head = live[starts]
        ahead = up_to(head, np.full(len(head), depth - 1))
        saved = np.add.reduceat(np.where(cont, again[live], 0), starts) - np.add.reduceat(cont.astype(np.int64), starts) * ahead
        key = np.full(len(starts), None, object)
        if common[0] >= depth:
            key[0] = first_keys[depth]
        if last >= depth:
            key[-1] = last_keys[depth]
        ending = size[live] == depth
        stops = np.append(starts[1:], len(live))
        texts, shas = [], []
        for a, b, k in zip(starts, stops, key):
            members = conv[live[a:b][ending[a:b]]]
            texts.append(",".join(map(str, members.tolist())) if k is not None and len(members) else None)
            shas.append(None if k is not None else _sha(members))
        emit(
            len(starts),
            key=list(key),
            parent_key=list(row_key[head]),
            part=part,
            conv_id=least,
            depth=depth,
            parent_conv_id=[None if depth == 0 else v for v in row_conv[head].tolist()],
            n_convs=reach,
            n_children=add((size > depth) & (common <= depth)),
            n_leaves=add(leaf),
            saved_tokens=saved,
            ends_sha256=shas,
            ends=texts,
        )
        row_conv, row_key = row_conv.copy(), row_key.copy()
        row_conv[live], row_key[live] = np.repeat(least, reach), np.repeat(key, reach)
        deepest = live[shared[live] == depth]
        single_parent[deepest], single_key[deepest] = row_conv[deepest], row_key[deepest]

    # Below, a row is alone: one node a turn.
    alone = np.maximum(size - shared, 0)
    row = np.repeat(np.arange(rows), alone)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(alone) - alone, alone) + shared[row] + 1
    top, end = depth == shared[row] + 1, depth == size[row]
    known = np.where(top, single_parent[row], conv[row])
    ends = np.full(len(row), EMPTY_SHA, object)
    ends[end] = [_sha(c) for c in conv[row[end]][:, None]]
    emit(
        len(row),
        parent_key=list(np.where(top, single_key[row], None)),
        part=part,
        conv_id=conv[row],
        depth=depth,
        parent_conv_id=[None if d == 0 else v for d, v in zip(depth.tolist(), known.tolist())],
        n_convs=1,
        n_children=(~end).astype(np.int64),
        n_leaves=1,
        saved_tokens=0,
        ends_sha256=list(ends),
    )
    columns = [
        pa.concat_arrays([pa.array(v, f.type, from_pandas=False) for v in out[f.name]]) for f in NODE_ARROW
    ]
    return pa.table(columns, schema=NODE_ARROW)


def hash_ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The digest of each key's texts, joined by commas, in their order; sorted rows, one text at a time."""
    key, running = None, None
    for frame in frames:
        done = []
        for k, text in zip(frame["key"], frame["ends"]):
            if k != key:
                if running is not None:
                    done.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256()
            else:
                running.update(b",")
            running.update(text.encode())
        yield pd.DataFrame(done, columns=["key", "sha"])
    if running is not None:
        yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "sha"])


def trie(lists: DataFrame) -> DataFrame:
    """The nodes of the prefix trie over ``conv_id``, ``turns`` (of ``hi``, ``lo``, ``n``; empty lists count).

    A node is a different sequence of first turns. Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``
    (null for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversations are dealt out by ranges of their turns, equal ones by conv_id, so a hot beginning spreads
    over many shards. A shard finds its nodes from sorted matrices of turn ids; it knows the last row
    before it and the first after it, so the nodes it shares are those on these two paths. Their counts
    add up; a shard has at most two such paths. conv_ids must differ. An empty table gives no rows.
    """
    spark = lists.sparkSession
    total = lists.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    shards = max(partitions(spark), -(-total // SHARD_TURNS))
    ranged = materialize(
        lists.repartitionByRange(shards, "turns", "conv_id").withColumn("part", F.spark_partition_id().cast("long")),
        "shards",
    )
    edge = F.struct("turns", "conv_id")
    edges = materialize(ranged.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last")), "edges")
    line = Window.orderBy("part")  # one row a shard
    near = edges.select("part", F.lag("last").over(line).alias("b"), F.lead("first").over(line).alias("a"))
    marks = [
        near.where(f"{c} IS NOT NULL").select(f"{c}.conv_id", f"{c}.turns", "part", F.lit(kind).alias("kind"))
        for c, kind in (("b", -1), ("a", 1))
    ]
    rows = ranged.withColumn("kind", F.lit(0)).unionByName(marks[0]).unionByName(marks[1])
    nodes = materialize(
        rows.groupBy("part").applyInArrow(lambda table: shard_nodes(table), NODE), "nodes"
    )
    partial = nodes.where("key IS NOT NULL")
    counts = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    whole = partial.groupBy("key").agg(
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("parent_key").alias("parent_key"),
        *(F.sum(c).alias(c) for c in counts),
    )
    texts = partial.where("ends IS NOT NULL").select("key", "part", "ends")
    hashed = texts.repartition("key").sortWithinPartitions("key", "part").mapInPandas(hash_ends, "key string, sha string")
    joined = materialize(
        whole.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY_SHA))), "shared"
    )
    parents = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    plain = ("conv_id", "depth", "parent_key", *counts, "ends_sha256")
    every = nodes.where("key IS NULL").select("parent_conv_id", *plain).unionByName(
        joined.select(F.lit(None).cast("long").alias("parent_conv_id"), *plain)
    )
    return every.join(parents, "parent_key", "left").select(
        "conv_id",
        "depth",
        F.coalesce("above", "parent_conv_id").alias("parent_conv_id"),
        *counts,
        "ends_sha256",
    )
