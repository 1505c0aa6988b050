"""Prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn's id is the 16 bytes of a digest of role and text, most significant first, so a conversation
is a byte string in which every 16th depth is the end of a turn. The conversations are dealt by ranges of (ids,
conversation) into slices of bounded size; a node is a run of neighbours in that order, however many
slices it spans. Each slice is held in an adaptive radix tree: nodes grow from 4 over 16 and 48 to 256
children as they fill, and runs without a branch are one prefix of a node. Only depths at the end of a turn are
nodes of the result.

Of two neighbouring slices each knows the nearest key of the other. So it knows which of its nodes began before it
or go on after it; a node is counted as a child where it begins and as a leaf where it ends, and all of its
figures are then sums (or the least) over its slices. Only those few nodes are merged, everything
below them is final in its slice.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.session import settled

WIDTH = 16
#: turns a slice holds on average, and at least where there are cores for more slices
SLICE_TURNS = 1 << 18
LEAST_TURNS = 1 << 13
#: conversation ids of a node that spans slices travel in texts of so many ids
IDS = 1 << 10
#: turns taken from the base conversation are fewer than this
HEADS = 9

NO_IDS = hashlib.sha256(b"").hexdigest()


class SortedKids:
    """Up to 4 or 16 children by sorted byte."""

    __slots__ = ("bytes", "kids", "room")

    def __init__(self, room: int = 4):
        self.bytes, self.kids, self.room = [], [], room

    def find(self, byte: int) -> Node | None:
        at = bisect_left(self.bytes, byte)
        return self.kids[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def add(self, byte: int, kid: Node) -> SortedKids | IndexedKids:
        if len(self.kids) == self.room:
            grown = SortedKids(16) if self.room == 4 else IndexedKids()
            for b, k in zip(self.bytes, self.kids, strict=True):
                grown.add(b, k)
            return grown.add(byte, kid)
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def all(self) -> list[Node]:
        return self.kids


class IndexedKids:
    """Up to 48 children behind one byte of index for every byte."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def find(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def add(self, byte: int, kid: Node) -> IndexedKids | DirectKids:
        if len(self.kids) == 48:
            grown = DirectKids()
            for b, at in enumerate(self.index):
                if at:
                    grown.add(b, self.kids[at - 1])
            return grown.add(byte, kid)
        self.kids.append(kid)
        self.index[byte] = len(self.kids)
        return self

    def all(self) -> list[Node]:
        return self.kids


class DirectKids:
    """A place for every byte."""

    __slots__ = ("places",)

    def __init__(self):
        self.places: list[Node | None] = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.places[byte]

    def add(self, byte: int, kid: Node) -> DirectKids:
        self.places[byte] = kid
        return self

    def all(self) -> list[Node]:
        return [k for k in self.places if k is not None]


class Node:
    """``prefix`` leads from the parent's byte to here; ``member`` is any conversation below."""

    __slots__ = ("prefix", "ends", "kids", "member", "total")

    def __init__(self, prefix: bytes, member: int):
        self.prefix, self.member = prefix, member
        self.ends: list[int] = []
        self.kids: SortedKids | IndexedKids | DirectKids | None = None
        self.total: tuple | None = None


def shared_length(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Tree:
    def __init__(self, keys: list[bytes]):
        """One conversation for each key, numbered by its place."""
        self.keys = keys
        self.root = Node(b"", 0)
        for member, key in enumerate(keys):
            self._insert(key, member)

    def _insert(self, key: bytes, member: int) -> None:
        node, depth = self.root, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, depth):
                same = shared_length(prefix, key[depth : depth + len(prefix)])
                below = Node(prefix[same + 1 :], node.member)
                below.ends, below.kids = node.ends, node.kids
                node.prefix, node.ends, node.kids = prefix[:same], [], SortedKids()
                node.kids.add(prefix[same], below)
            depth += len(node.prefix)
            if depth == len(key):
                node.ends.append(member)
                return
            if node.kids is None:
                node.kids = SortedKids()
            child = node.kids.find(key[depth])
            if child is None:
                child = Node(key[depth + 1 :], member)
                child.ends.append(member)
                node.kids = node.kids.add(key[depth], child)
                return
            node, depth = child, depth + 1

    def bottom_up(self) -> Iterator[tuple[Node, int, int]]:
        """Every tree node after its children: node, byte depth of its parent (-1 at the root) and of its own end."""
        stack = [(self.root, -1, 0, False)]
        while stack:
            node, above, end, ready = stack.pop()
            if ready or node.kids is None:
                yield node, above, end
                continue
            stack.append((node, above, end, True))
            stack += [(k, end, end + 1 + len(k.prefix), False) for k in node.kids.all()]


NODES = T.StructType([
    # what a row is: a node that is final in its slice, part of a node that spans slices, ids that end in such a node
    T.StructField("kind", T.StringType()), T.StructField("node", T.BinaryType()), T.StructField("conv_id", T.LongType()),
    T.StructField("depth", T.LongType()), T.StructField("parent", T.BinaryType()), T.StructField("parent_conv_id", T.LongType()),
    T.StructField("n_convs", T.LongType()), T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()),
    T.StructField("saved_tokens", T.LongType()), T.StructField("ends", T.StringType()), T.StructField("part", T.LongType()),
])


def _digests(key: bytes, turns: int) -> list[bytes]:
    """Names of the nodes on the way to ``key``, down to depth ``turns``."""
    running = hashlib.md5(usedforsecurity=False)
    out = [running.digest()]
    for t in range(turns):
        running.update(key[t * WIDTH : (t + 1) * WIDTH])
        out.append(running.digest())
    return out


def slice_nodes(
    keys: list[bytes], sizes: list[list[int]], convs: list[int], before: bytes | None, after: bytes | None
) -> list[list]:
    """The rows of one slice; ``before`` and ``after`` are the nearest keys of its neighbours.

    ``sizes`` are the UTF-8 bytes of each turn of each key.
    """
    rows: list[list] = []
    first, last = min(keys), max(keys)
    began = shared_length(first, before) // WIDTH if before is not None else -1
    goes_on = shared_length(last, after) // WIDTH if after is not None else -1
    names = {False: _digests(first, began), True: _digests(last, goes_on)}
    tree = Tree(keys)
    for node, above, end in tree.bottom_up():
        key, size = keys[node.member], sizes[node.member]
        left = min(shared_length(key, first) // WIDTH, began) if began >= 0 else -1
        right = min(shared_length(key, last) // WIDTH, goes_on) if goes_on >= 0 else -1
        members, low, kids, leaves, saved, pending = len(node.ends), min((convs[m] for m in node.ends), default=None), 0, 0, 0, []
        for child in node.kids.all() if node.kids is not None else ():
            m, c, k, f, s, p = child.total
            members, kids, leaves, saved = members + m, kids + k, leaves + f, saved + s
            low = c if low is None or c < low else low
            pending = p + pending if len(p) > len(pending) else pending + p
            child.total = None
        for depth in range(end // WIDTH, max(above, -WIDTH) // WIDTH, -1):
            span = "part" if depth <= left or depth <= right else "final"
            name = None if span == "final" else names[depth > left][depth]
            text = size[depth - 1] if depth else 0
            leaves += not pending and depth > right
            saved += members * text - (text if depth > left else 0)
            here = sorted(convs[m] for m in node.ends) if depth * WIDTH == end else []
            if span == "final":
                ends = hashlib.sha256(",".join(map(str, here)).encode()).hexdigest() if here else NO_IDS
            else:
                ends = None
                for part in range(0, len(here), IDS):
                    rows.append(["ids", name, None, None, None, None, None, None, None, None, ",".join(map(str, here[part : part + IDS])), part])
            for child in pending:
                rows[child][4 if span == "part" else 5] = name if span == "part" else low
            pending = [len(rows)]
            rows.append([span, name, low, depth, None, None, members, kids, leaves, saved, ends, None])
            kids = int(depth > left)
        node.total = (members, low, kids, leaves, saved, pending)
    return rows


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, key, sizes): the hex ids of the rebuilt turns laid end to end and their UTF-8 bytes.

    Only digests and sizes are exchanged, no text. Every fifth conversation lends the head of its four successors.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    own = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), role.alias("role"), digest.alias("id"), F.octet_length(text).alias("size")).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("own"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 5).alias("base"),
    )
    own = settled(own, "turns")
    heads = own.where(F.col("conv_id") == F.col("base")).select("base", F.slice("own", 1, HEADS - 1).alias("head"))

    def first(array: Column) -> Column:
        return F.slice(array, F.lit(1), F.col("h"))

    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))
    whole = F.concat(F.coalesce(first(F.col("head")), first(F.slice("own", 1, 0))), rest)
    return own.join(heads, "base", "left").select("conv_id", whole.alias("t")).select(
        "conv_id", F.array_join("t.id", "").alias("key"), F.col("t.size").alias("sizes")
    )


def _rows(group: pa.Table) -> pa.Table:
    mark = group.column("mark").to_pylist()
    keys = [bytes.fromhex(k) for k in group.column("key").to_pylist()]
    real = [k for k, m in enumerate(mark) if m == 0]
    sizes, convs = group.column("sizes").to_pylist(), group.column("conv_id").to_pylist()
    slice_no = group.column("slice")[0].as_py()
    rows = slice_nodes(
        [keys[k] for k in real], [sizes[k] for k in real], [convs[k] for k in real],
        next((keys[k] for k, m in enumerate(mark) if m < 0), None), next((keys[k] for k, m in enumerate(mark) if m > 0), None),
    )
    for row in rows:
        if row[11] is not None:
            row[11] += slice_no << 32
    kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.string(), pa.int64()]
    return pa.Table.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=NODES.names
    )


def _running_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends) from the sorted ids of nodes that come one after the other, piece by piece."""
    node, running = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends"])

    for batch in batches:
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    yield done()
                node, running = name, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.encode())
    if node is not None:
        yield done()


def trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct sequence of leading turns of the rebuilt conversations, the root included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, as defined for the query. Turns are ordered by ``turn``, null first, then by role and
    digest; null role or text is empty; repeated rows are turns each. Rows without a conversation id are
    in no conversation. An empty table has no node. Other columns are not read. One conversation's ids
    (32 characters a turn) must fit a task; the ids that end in one node need not, they are hashed as a stream.
    """
    whole = rebuilt(turns, conv_col, turn_col, role_col, text_col)
    whole = settled(whole, "rebuilt")
    total = whole.agg(F.sum(F.size("sizes") + 1)).first()[0]
    if total is None:
        total = 0
    cores = whole.sparkSession.sparkContext.defaultParallelism
    slices = max(1, -(-total // SLICE_TURNS), min(cores, -(-total // LEAST_TURNS)))
    dealt = settled(whole.repartitionByRange(slices, "key", "conv_id").withColumn("slice", F.spark_partition_id()), "slices")
    # one row per slice
    order = Window.orderBy("slice")
    edges = dealt.groupBy("slice").agg(F.min("key").alias("low"), F.max("key").alias("high")).select(
        "slice", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after")
    )
    edges = edges.select("slice", F.explode(F.array(
        F.struct(F.lit(-1).alias("mark"), F.col("before").alias("key")), F.struct(F.lit(1).alias("mark"), F.col("after").alias("key"))
    )).alias("edge")).select("slice", "edge.*").where(F.col("key").isNotNull())
    grouped = dealt.withColumn("mark", F.lit(0)).unionByName(edges, allowMissingColumns=True).groupBy("slice")
    parts = settled(grouped.applyInArrow(_rows, NODES), "nodes")

    ids = parts.where(F.col("kind") == "ids").select("node", "part", "ends")
    ends = ids.repartition("node").sortWithinPartitions("node", "part").mapInArrow(_running_hash, "node binary, ends string")
    spanning = parts.where(F.col("kind") == "part").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.max("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    spanning = settled(spanning.join(ends, "node", "left").withColumn("ends", F.coalesce("ends", F.lit(NO_IDS))), "spanning")
    parents = spanning.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    final = parts.where(F.col("kind") == "final")
    return (
        final.where(F.col("parent").isNull()).select(*columns)
        .unionByName(final.where(F.col("parent").isNotNull()).join(parents, "parent").withColumn("parent_conv_id", F.col("above")).select(*columns))
        .unionByName(spanning.join(parents, "parent", "left").withColumn("parent_conv_id", F.col("above")).select(*columns))
    )
