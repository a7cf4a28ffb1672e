"""Prefix trie of conversations (operator 12).

A turn is a 128-bit id of its role and text, a conversation the string of its turns' ids.
Conversations are range-partitioned by that string and their number, so that equal ones may
lie in several shards. A shard pads its turn ids to a matrix, sorts the rows, ORs up the
columns' change masks, which mark where nodes start, and aggregates each depth by
``reduceat``. Nodes that reach over a shard's edge, on the paths that its first and last
row share with the neighbours, are given out in parts and put together afterwards.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import broadcast_staged, stage

#: Bytes of a turn's id.
ID = 16
#: A shard has about so many conversations, or so many turns.
SHARD_ROWS, SHARD_TURNS = 20_000, 200_000
#: Columns sorted at a time.
BAND = 8
#: Words: runs without a blank or one of the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
REST = 2**30


def conversation_turns(
    df: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``conv_id, turns``: an array of ``turn, role, id, words`` in the order of the turns.

    A null turn comes first; rows of one turn go by role and then by id. Null roles and
    texts are empty. Rows without a conversation are left out. Texts are not moved.
    """
    role, text = F.coalesce(F.col(role_column).cast("string"), F.lit("")), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col(turn_column).alias("turn"), role.alias("role"), F.substring(F.sha2(whole, 256), 1, 2 * ID).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"),
    )
    rows = df.where(F.col(conv_column).isNotNull()).select(F.col(conv_column).cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of conversation ``c - c % every``, h = crc32(c) % ``most``.

    ``%`` is Spark's, so a negative number's remainder is negative.
    """
    base = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_first"))
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).cast("int")
    own = F.slice(F.col("turns"), h + 1, F.lit(REST))
    first = F.coalesce(F.slice(F.col("_first"), F.lit(1), h), F.slice("turns", 1, 0))
    joined = convs.join(base, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    return joined.select("conv_id", F.concat(first, own).alias("turns"))


# --- one shard --------------------------------------------------------------------------------

NODES = "conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Parts of nodes that other shards share: what their own rows and their inner children add.
PARTS = "key binary, keys array<binary>, depth long, conv_id long, n_convs long, words long, n_children long, n_leaves long, saved_tokens long, shard long, ends binary"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def node_key(path: bytes, depth: int) -> bytes:
    """The key of the node of the first turns of a path."""
    return hashlib.blake2b(path[: depth * ID], digest_size=16).digest() + depth.to_bytes(4, "big")


class Rows:
    """A shard's conversations in the order of their paths; equal ones by number."""

    def __init__(self, table: pa.Table):
        convs, paths = table.column("conv_id").to_numpy(), table.column("path").to_pylist()
        depth = np.array([len(p) // ID for p in paths], np.int64)
        self.cells = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2).astype(np.uint64)
        self.words = np.array(table.column("words").combine_chunks().values if len(paths) else [], np.int64)
        self.at = np.cumsum(depth) - depth
        order = self.sorted_rows(convs, depth)
        self.convs, self.depth, self.at, self.paths = convs[order], depth[order], self.at[order], paths
        self.order = order

    def column(self, d: int, depth: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Column d of the padded matrix: the ids of the turns number d, 0 where a conversation has none."""
        ids = np.zeros((len(depth), 2), np.uint64)
        has = depth > d
        ids[has] = self.cells[at[has] + d]
        return ids

    def sorted_rows(self, convs: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """A lexsort of the matrix, band by band: each sorts the rows that the ones before leave equal."""
        group = np.zeros(len(convs), np.int64)
        for first in range(0, int(depth.max(initial=0)), BAND):
            keys = [part for d in range(first, first + BAND) for part in self.column(d, depth, self.at).T]
            order = np.lexsort([*reversed(keys), group])
            changed = np.zeros(len(order), bool)
            for key in [group, *keys]:
                changed[1:] |= key[order][1:] != key[order][:-1]
            group[order] = np.cumsum(changed)
            if changed[1:].all():
                break
        return np.lexsort([convs, group])

    def path(self, row: int) -> bytes:
        return self.paths[self.order[row]]


def joined_ids(convs: np.ndarray) -> bytes:
    return ",".join(map(str, convs.tolist())).encode()


def shard_nodes(rows: Rows, left: int, right: int) -> Iterator[dict]:
    """All nodes of a shard, from the deepest up; those up to the depths shared to the left and right are open.

    Per depth: arrays of the nodes' first rows, sizes and sums; ``open`` marks parts.
    """
    n, deepest = len(rows.convs), int(rows.depth.max(initial=0))
    changed = np.zeros(n, bool)
    changed[0] = True
    levels = []
    for d in range(deepest + 1):
        if d:
            ids = rows.column(d - 1, rows.depth, rows.at)
            changed[1:] |= (ids[1:] != ids[:-1]).any(axis=1)
        inside = np.flatnonzero(rows.depth >= d)
        starts = np.flatnonzero(changed[inside])
        first = inside[starts]
        sizes = np.diff(np.append(starts, len(inside)))
        words = rows.words[rows.at[first] + d - 1] if d else np.zeros(len(first), np.int64)
        ends = np.add.reduceat((rows.depth[inside] == d).astype(np.int64), starts)
        open_ = ((first == 0) & (d <= left)) | ((inside[starts + sizes - 1] == n - 1) & (d <= right)) | (d == 0)
        levels.append({
            "first": first, "n_convs": sizes, "conv_id": np.minimum.reduceat(rows.convs[inside], starts), "words": words, "ends": ends, "open": open_,
        })
    below = None
    for d in range(deepest, -1, -1):
        level = levels[d]
        level["depth"] = d
        for name in ("n_children", "n_leaves", "saved_tokens"):
            level[name] = np.zeros(len(level["first"]), np.int64)
        if below is not None:
            # An open node counts its inner children only; open ones are joined to it later.
            inner = ~below["open"]
            for name, values in (("n_children", np.ones(len(inner), np.int64)), ("n_leaves", below["n_leaves"]), ("saved_tokens", below["saved_tokens"])):
                np.add.at(level[name], below["parent"][inner], values[inner])
        closed = ~level["open"]
        level["n_leaves"] += closed & (level["n_children"] == 0)
        level["saved_tokens"] += np.where(closed, (level["n_convs"] - 1) * level["words"], 0)
        if d:
            level["parent"] = np.searchsorted(levels[d - 1]["first"], level["first"], "right") - 1
            level["above"] = levels[d - 1]
        yield level
        below = level


def inner_nodes(rows: Rows, level: dict) -> pa.RecordBatch:
    """The finished nodes of a depth; those below an open node name its key."""
    pick = np.flatnonzero(~level["open"])
    above, d = level.get("above"), level["depth"]
    parent = level["parent"][pick] if above else pick
    open_ = above["open"][parent] if above else np.zeros(0, bool)
    keys = {p: node_key(rows.path(int(above["first"][p])), d - 1) for p in np.unique(parent[open_]).tolist()} if above else {}
    ends = [
        hashlib.sha256(joined_ids(rows.convs[f : f + e])).hexdigest() if e else NO_ENDS
        for f, e in zip(level["first"][pick].tolist(), level["ends"][pick].tolist())
    ]
    return pa.RecordBatch.from_pydict({
        "conv_id": pa.array(level["conv_id"][pick], pa.int64()), "depth": pa.array(np.full(len(pick), d), pa.int64()),
        "parent_conv_id": pa.array(above["conv_id"][parent] if above else [], pa.int64(), mask=open_),
        "parent_key": pa.array([keys.get(p) if o else None for p, o in zip(parent.tolist(), open_.tolist())], pa.binary()),
        **{name: pa.array(level[name][pick], pa.int64()) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")},
        "ends_sha256": pa.array(ends, pa.string()),
    })


def open_parts(rows: Rows, level: dict, shard: int) -> pa.RecordBatch:
    """This shard's parts of the open nodes of a depth, with the keys of the nodes above them."""
    pick, d = np.flatnonzero(level["open"]), level["depth"]
    paths = [rows.path(f) for f in level["first"][pick].tolist()]
    return pa.RecordBatch.from_pydict({
        "key": pa.array([node_key(p, d) for p in paths], pa.binary()),
        "keys": pa.array([[node_key(p, i) for i in range(d + 1)] for p in paths], pa.list_(pa.binary())),
        "depth": pa.array(np.full(len(pick), d), pa.int64()),
        **{name: pa.array(level[name][pick], pa.int64()) for name in ("conv_id", "n_convs", "words", "n_children", "n_leaves", "saved_tokens")},
        "shard": pa.array(np.full(len(pick), shard), pa.int64()),
        "ends": pa.array([joined_ids(rows.convs[f : f + e]) for f, e in zip(level["first"][pick].tolist(), level["ends"][pick].tolist())], pa.binary()),
    })


# --- all shards -------------------------------------------------------------------------------


def whole_partition(batches) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def shared_depths(sharded: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard that has rows, how many turns its first path shares with the shard before, its last with the next.

    Two paths a shard come to the driver.
    """

    def edges(batches):
        least = most = None
        for batch in batches:
            paths = batch.column("path").to_pylist()
            if paths:
                least, most = min([*paths, *([least] if least is not None else [])]), max([*paths, *([most] if most is not None else [])])
        if least is not None:
            yield pa.record_batch({"shard": pa.array([TaskContext.get().partitionId()], pa.int64()), "least": pa.array([least], pa.binary()), "most": pa.array([most], pa.binary())})

    rows = sorted(sharded.select("path").mapInArrow(edges, "shard long, least binary, most binary").collect(), key=lambda r: r["shard"])
    common = [shared_turns(a["most"], b["least"]) for a, b in zip(rows, rows[1:])]
    return {r["shard"]: (left, right) for r, left, right in zip(rows, [0, *common], [*common, 0])}


def shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // ID
    return next((i for i in range(n) if a[i * ID : (i + 1) * ID] != b[i * ID : (i + 1) * ID]), n)


def chained_hashes(parts: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the open nodes: the parts' numbers, shard after shard, in one stream."""
    chunks = parts.where(F.length("ends") > 0).select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")

    def hashed(batches):
        key = digest = None
        for batch in batches:
            for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k != key:
                    if key is not None:
                        yield pa.record_batch({"key": pa.array([key], pa.binary()), "ends_sha256": [digest.hexdigest()]})
                    key, digest = k, hashlib.sha256(ends)
                else:
                    digest.update(b"," + ends)
        if key is not None:
            yield pa.record_batch({"key": pa.array([key], pa.binary()), "ends_sha256": [digest.hexdigest()]})

    return chunks.mapInArrow(hashed, "key binary, ends_sha256 string")


def recombined(parts: DataFrame) -> DataFrame:
    """The open nodes from their parts: ``key`` and the columns of a node."""
    own = stage(parts.groupBy("key").agg(
        F.first("keys").alias("keys"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("words").alias("words"), F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    ).withColumn("parent_key", F.get("keys", (F.col("depth") - 1).cast("int"))))
    children = own.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("open"))
    full = own.join(children, "key", "left").withColumn("n_children", F.col("inner") + F.coalesce("open", F.lit(0)))
    # What a node adds to itself and to all nodes above it.
    adds = full.select(
        F.explode("keys").alias("key"), (F.col("leaves") + (F.col("n_children") == 0).cast("long")).alias("l"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("s"),
    )
    sums = adds.groupBy("key").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    above = own.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = full.join(sums, "key").join(above, "parent_key", "left").join(chained_hashes(parts), "key", "left")
    return nodes.select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def trie(convs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """All nodes of the trie of ``conv_id, turns`` (one row a conversation).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree and
    ``ends_sha256`` of the numbers of the conversations that end there. Without a conversation
    there is no node, the root included. A conversation's turn ids (not its texts) are in one task.
    """
    paths = stage(convs.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    ))
    size = paths.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("t")).first()
    shards = max(1, math.ceil(size["n"] / shard_rows), math.ceil(size["t"] / SHARD_TURNS))
    sharded = stage(paths.repartitionByRange(shards, "path", "conv_id"))
    depths = shared_depths(sharded)

    def levels(batches) -> Iterator[tuple[Rows, dict, int]]:
        table, shard = whole_partition(batches), TaskContext.get().partitionId()
        if table is not None:
            rows = Rows(table)
            for level in shard_nodes(rows, *depths[shard]):
                yield rows, level, shard

    inner = sharded.mapInArrow(lambda batches: (inner_nodes(rows, level) for rows, level, _ in levels(batches)), NODES)
    parts = stage(sharded.mapInArrow(lambda batches: (open_parts(rows, level, shard) for rows, level, shard in levels(batches)), PARTS))
    whole = stage(recombined(parts))
    above = broadcast_staged(whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above")))
    inner = inner.join(above, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).drop("parent_key", "_above")
    return inner.unionByName(whole.drop("key"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(conversation_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


#: The same trie over lists: every prefix of every conversation is a row. CRC-32 is the bitwise one.
SQL = r"""
WITH own AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), steps AS (
    SELECT conv_id, turns, list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))) AS s
    FROM own
), sizes AS (
    SELECT conv_id, turns, (xor(list_reduce(s, lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4)::BIGINT AS h
    FROM steps
), rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
    FROM sizes a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20
), prefixes AS (
    SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
    SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY turns[1:depth], depth
), counted AS (
    SELECT a.*, b.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = a.depth + 1 AND c.path[1:a.depth] = a.path) AS n_children,
           CASE WHEN a.depth = 0 THEN 0 ELSE (a.n_convs - 1) * len(regexp_extract_all(a.path[a.depth].t, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth - 1 AND b.path = a.path[1:a.depth - 1]
), shares AS (
    SELECT unnest(range(0, depth + 1)) AS d, path, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, saved FROM counted
), sums AS (
    SELECT d, path[1:d] AS top, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM shares GROUP BY d, path[1:d]
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN sums ON d = depth AND top = path
"""
