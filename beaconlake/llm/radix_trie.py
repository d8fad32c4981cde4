"""The prefix trie of conversations, from adaptive radix trees over big-endian turn ids.

A turn's id is the MD5 digest of its role and text, 16 bytes; a conversation's key is the chain of its turns' ids. Keys
are range-partitioned in byte order (equal keys by conversation id), so no first turn or group of equal conversations is
too large: it spans several tasks. Every task inserts its keys into one adaptive radix tree: inner nodes of 4, 16, 48 or
256 children that grow as needed, with the bytes that all keys below share kept as the node's prefix. A trie node exists
at every turn-aligned byte depth of a path, in the middle of a prefix too; depths inside an id give none.

Only a prefix of a task's first or last key can have members in another task. All other nodes are final where they are
found. The prefixes, at most two chains a task, are summed over the tasks, and one pass in trie order with a stack adds
up their subtrees. Their digests are taken over pieces of text of a bounded size, in order, as a stream.

Rebuilding: conversation c takes the first ``crc32(c) % 9`` turns of conversation ``c - c % 5`` and its own turns after as
many. Turns meet by that base conversation, so one shuffle of ids and lengths (no texts) does it.

Bounds: a task holds the keys of ``TASK_TURNS`` turns or of one conversation, 16 bytes a turn. Defined cases: a null role
or text is empty; a null turn comes first; equal turn numbers are ordered by the turns' ids, so repeated rows are turns of
their own. Rows without ``conv_id`` are no conversation. An empty table has no nodes, not even a root. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import broadcast_if_small, is_small, table, written
from beaconlake.operators.skew import lookup_join

WIDTH = 16
GROUP = 5
HEADS = 9
TASK_TURNS = 250_000

#: Bytes of conversation ids in one piece of a digest that spans tasks, and rows of one output batch.
PIECE = 4096
ROWS = 10_000

REBUILT = "conv_id long, key binary, sizes array<int>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, tokens long, own_tokens long"
PARTS = f"kind int, {NODE}, size long, ends_sha256 string, id binary, parent_id binary, part int, side int, piece long, ids string"
FINAL, SHARED, ENDS = range(3)
KINDS = [c.split()[0] for c in PARTS.split(", ")]


# ---- adaptive radix tree ----

class Node:
    """A node with the bytes that all keys below it share, the keys that end after them, and its children by next byte.

    Up to 4 and up to 16 children are two parallel lists in byte order; up to 48 a table of 256 places into a list; beyond
    that a list of 256.
    """

    __slots__ = ("prefix", "ends", "layout", "index", "children")

    def __init__(self, prefix: bytes):
        self.prefix, self.ends = prefix, None
        self.layout, self.index, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.index.find(byte)
            return None if at < 0 else self.children[at]
        if self.layout == 48:
            at = self.index[byte]
            return None if at == 255 else self.children[at]
        return self.children[byte]

    def put(self, byte: int, node: Node) -> None:
        """Set the child of a byte; a full node takes the next larger layout first."""
        if self.layout <= 16:
            at = self.index.find(byte)
            if at >= 0:
                self.children[at] = node
            elif len(self.children) < self.layout:
                at = 0
                while at < len(self.index) and self.index[at] < byte:
                    at += 1
                self.index.insert(at, byte)
                self.children.insert(at, node)
            else:
                self._grow()
                self.put(byte, node)
        elif self.layout == 48:
            at = self.index[byte]
            if at != 255:
                self.children[at] = node
            elif len(self.children) < 48:
                self.index[byte] = len(self.children)
                self.children.append(node)
            else:
                self._grow()
                self.put(byte, node)
        else:
            self.children[byte] = node

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray([255]) * 256
            for place, byte in enumerate(self.index):
                index[byte] = place
            self.layout, self.index = 48, index
        else:
            children = [None] * 256
            for byte, place in enumerate(self.index):
                if place != 255:
                    children[byte] = self.children[place]
            self.layout, self.index, self.children = 256, None, children

    def below(self) -> list[Node]:
        """Children in byte order."""
        if self.layout <= 16:
            return list(self.children)
        if self.layout == 48:
            return [self.children[place] for place in self.index if place != 255]
        return [child for child in self.children if child is not None]


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    # The prefixes of a length are equal up to the answer and differ beyond it.
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def insert(root: Node, key: bytes) -> Node:
    """The node at which ``key`` ends, made if it is not there."""
    node, above, at = root, None, 0
    while True:
        prefix = node.prefix
        if not key.startswith(prefix, at):
            same = shared_length(prefix, key[at:at + len(prefix)])
            upper = Node(prefix[:same])
            node.prefix = prefix[same + 1:]
            upper.put(prefix[same], node)
            above.put(key[at - 1], upper)
            node = upper
            at += same
        else:
            at += len(prefix)
        if at == len(key):
            return node
        child = node.child(key[at])
        if child is None:
            child = Node(key[at + 1:])
            node.put(key[at], child)
            return child
        above, node, at = node, child, at + 1


class Ends:
    """Conversations with one key, in ascending order."""

    __slots__ = ("key", "sizes", "ids")

    def __init__(self, key: bytes, sizes):
        self.key, self.sizes, self.ids = key, sizes, []


# ---- nodes of one task ----

class Subtree:
    """What the trie nodes next below a place add up to: final ones in the sums, shared ones in ``n_convs`` and ``conv_id``
    only. ``waiting`` are the rows that still need their parent's name."""

    __slots__ = ("n_convs", "conv_id", "n_children", "n_leaves", "tokens", "own_tokens", "waiting", "any")

    def __init__(self):
        self.n_convs = self.n_children = self.n_leaves = self.tokens = self.own_tokens = 0
        self.conv_id, self.waiting, self.any = None, [], None

    def add(self, other: Subtree) -> None:
        self.n_convs += other.n_convs
        self.conv_id = other.conv_id if self.conv_id is None else min(self.conv_id, other.conv_id)
        self.n_children += other.n_children
        self.n_leaves += other.n_leaves
        self.tokens += other.tokens
        self.own_tokens += other.own_tokens
        if len(other.waiting) > len(self.waiting):
            self.waiting, other.waiting = other.waiting, self.waiting
        self.waiting += other.waiting
        self.any = other.any


def _chain(key: bytes) -> list[bytes]:
    """Names of a key's prefixes at all turn-aligned depths."""
    digest, names = hashlib.md5(), [hashlib.md5().digest()]
    for at in range(0, len(key), WIDTH):
        digest.update(key[at:at + WIDTH])
        names.append(digest.digest())
    return names


class Trie:
    """The trie nodes of a sorted list of keys, as rows of ``PARTS``."""

    def __init__(self, part: int):
        self.root, self.part, self.first, self.last = Node(b""), part, None, None

    def add(self, key: bytes, conv_id: int, sizes) -> None:
        if self.last is not None and self.last.key == key:
            self.last.ids.append(conv_id)
            return
        node = insert(self.root, key)
        node.ends = self.last = Ends(key, sizes)
        self.first = self.first or self.last
        self.last.ids.append(conv_id)

    def rows(self) -> Iterator[dict]:
        """Children before their parents, without recursion: a path may be as long as a conversation."""
        chains = _chain(self.first.key), _chain(self.last.key)
        # (node, byte depth above its branching byte, children left, sums of the children done)
        stack = [[self.root, -1, self.root.below(), Subtree()]]
        while stack:
            node, start, left, below = stack[-1]
            if left:
                child = left.pop()
                stack.append([child, max(start, 0) + len(node.prefix) + (start >= 0), child.below(), Subtree()])
                continue
            stack.pop()
            end = max(start, 0) + len(node.prefix) + (start >= 0)
            yield from self._aligned(node, start, end, below, chains)
            if stack:
                stack[-1][3].add(below)

    def _aligned(self, node: Node, start: int, end: int, below: Subtree, chains) -> Iterator[dict]:
        """Rows for the aligned depths in (start, end], deepest first; ``below`` becomes the sums seen from ``start``."""
        ends = node.ends
        if ends is not None:
            below.n_convs += len(ends.ids)
            below.conv_id = ends.ids[0] if below.conv_id is None else min(below.conv_id, ends.ids[0])
            below.any = ends
        deepest = end // WIDTH
        shallowest = start // WIDTH + 1 if start >= 0 else 0
        if deepest < shallowest:
            return
        key = below.any.key
        on_first, on_last = (shared_length(key, other.key) // WIDTH for other in (self.first, self.last))
        for depth in range(deepest, shallowest - 1, -1):
            size = below.any.sizes[depth - 1] if depth else 0
            ids = ends.ids if ends is not None and depth * WIDTH == end else []
            if depth <= on_first or depth <= on_last:
                side = 0 if depth <= on_first else 1
                name = chains[side][depth]
                yield {
                    "kind": SHARED, "conv_id": below.conv_id, "depth": depth, "n_convs": below.n_convs,
                    "n_children": below.n_children, "n_leaves": below.n_leaves, "tokens": below.tokens,
                    "own_tokens": below.own_tokens, "size": size, "id": name, "part": self.part, "side": side,
                }
                for row in below.waiting:
                    row["parent_id"] = name
                    yield row
                yield from self._pieces(name, ids)
                below.waiting = []
                below.n_children = below.n_leaves = below.tokens = below.own_tokens = 0
                continue
            below.n_leaves = below.n_leaves or 1
            below.tokens += below.n_convs * size
            below.own_tokens += size
            for row in below.waiting:
                row["parent_conv_id"] = below.conv_id
                yield row
            below.waiting = [{
                "kind": FINAL, "conv_id": below.conv_id, "depth": depth, "n_convs": below.n_convs,
                "n_children": below.n_children, "n_leaves": below.n_leaves, "tokens": below.tokens,
                "own_tokens": below.own_tokens, "ends_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            }]
            below.n_children = 1

    def _pieces(self, name: bytes, ids: list[int]) -> Iterator[dict]:
        text, number = [], 0
        held = 0
        for i, conv_id in enumerate(ids):
            text.append(str(conv_id))
            held += len(text[-1]) + 1
            if held >= PIECE or i == len(ids) - 1:
                yield {"kind": ENDS, "id": name, "part": self.part, "piece": number, "ids": ",".join(text)}
                text, held, number = [], 0, number + 1


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in ddl.split(", ")])


# ---- Spark ----

def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): every conversation after rebuilding, as its turns' ids in a row and their texts' bytes."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), F.col("conv_id").cast("bigint"),
        F.struct(
            F.col("turn"), F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
            F.octet_length(text).alias("size"),
        ).alias("turn"),
    )
    # The turns of a base meet in one task with those of the few conversations that start with them.
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    family = own.groupBy("base").agg(F.collect_list(F.struct("conv_id", "turns")).alias("members"))
    first = F.get(F.filter("members", lambda m: m["conv_id"] == F.col("base")), F.lit(0))["turns"]
    each = family.select(F.coalesce(first, F.array().cast(own.schema["turns"].dataType)).alias("first"), F.inline("members"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    whole = F.concat(F.slice("first", F.lit(1), heads), F.slice("turns", heads + 1, F.size("turns")))
    each = each.select("conv_id", whole.alias("turns"))
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    return each.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def _parts(keys: DataFrame, tasks: int) -> DataFrame:
    schema = _schema(PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(TaskContext.get().partitionId())
        for batch in batches:
            for conv_id, key, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
                trie.add(key, conv_id, sizes)
        if trie.first is not None:
            yield from _batches(trie.rows(), schema)

    ordered = keys.select("conv_id", "key", "sizes").repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(run, PARTS)


def _totals(shared: DataFrame) -> DataFrame:
    """The nodes that tasks share, with their subtrees' sums: (``NODE``, id).

    There are at most two chains of prefixes a task, so one task can read them in trie order. A node waits on the stack
    until a node of its depth or less comes, then adds its sums to its parent.
    """
    merged = shared.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("tokens").alias("tokens"),
        F.sum("own_tokens").alias("own_tokens"), F.min("size").alias("size"),
        # A prefix of a task's first key comes before those of its last key alone.
        F.min(F.struct("part", "side")).alias("place"),
    )
    schema = _schema(f"{NODE}, id binary")

    def finished(rows: Iterator[dict]) -> Iterator[dict]:
        stack: list[dict] = []

        def close(depth: int) -> Iterator[dict]:
            while stack and stack[-1]["depth"] >= depth:
                node = stack.pop()
                node["n_leaves"] = node["n_leaves"] or 1
                node["tokens"] += node["n_convs"] * node["size"]
                node["own_tokens"] += node.pop("size")
                if stack:
                    parent = stack[-1]
                    node["parent_conv_id"] = parent["conv_id"]
                    parent["n_children"] += 1
                    for name in ("n_leaves", "tokens", "own_tokens"):
                        parent[name] += node[name]
                yield node

        for row in rows:
            yield from close(row["depth"])
            stack.append(row)
        yield from close(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(finished(row for batch in batches for row in batch.to_pylist()), schema)

    ordered = merged.coalesce(1).sortWithinPartitions("place", "depth").drop("place")
    return ordered.mapInArrow(run, f"{NODE}, id binary")


def _digests(pieces: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the nodes whose ids are in pieces: read in order as a stream, one digest at a time."""
    schema = _schema("id binary, ends_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            name, digest = None, None
            for batch in batches:
                for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if node != name:
                        if name is not None:
                            yield {"id": name, "ends_sha256": digest.hexdigest()}
                        name, digest = node, hashlib.sha256()
                    else:
                        digest.update(b",")
                    digest.update(text.encode())
            if name is not None:
                yield {"id": name, "ends_sha256": digest.hexdigest()}

        yield from _batches(rows(), schema)

    ordered = pieces.select("id", "part", "piece", "ids").repartition("id").sortWithinPartitions("id", "part", "piece")
    return ordered.select("id", "ids").mapInArrow(run, "id binary, ends_sha256 string")


def prefix_trie(keys: DataFrame) -> DataFrame:
    """A row per node of the prefix trie of ``keys`` (``REBUILT``)."""
    keys = written(keys, "trie-keys")
    turns = keys.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    parts = written(_parts(keys, 1 + turns // TASK_TURNS), "trie-parts")
    totals = written(_totals(parts.where(F.col("kind") == SHARED)), "trie-shared")
    digests = _digests(parts.where(F.col("kind") == ENDS))
    nothing = hashlib.sha256().hexdigest()
    shared = totals.join(broadcast_if_small(written(digests, "trie-digests")), "id", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(nothing))
    )
    final = parts.where(F.col("kind") == FINAL)
    names = totals.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("_parent"))
    children = final.where("parent_id is not null")
    named = children.join(F.broadcast(names), "parent_id") if is_small(names) else lookup_join(children, names, ["parent_id"], "inner")
    columns = [c.split()[0] for c in NODE.split(", ")] + ["ends_sha256"]
    nodes = final.where("parent_id is null").select(*columns).unionByName(
        named.withColumn("parent_conv_id", F.col("_parent")).select(*columns)
    ).unionByName(shared.select(*columns))
    saved: Column = F.col("tokens") - F.col("own_tokens")
    return nodes.withColumn("saved_tokens", saved).drop("tokens", "own_tokens")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    nodes = prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
