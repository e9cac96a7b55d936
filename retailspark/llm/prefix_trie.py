"""The trie of conversations' beginnings (operator 13).

A turn's id is a number of ``WIDTH`` bytes, big end first: 16 bytes of the SHA-256 of its role and text, then the length
of the text in bytes. A conversation is the row of its turns' ids, and a node of the trie stands for each distinct
beginning of one, the root for the empty one.

1. Conversations are sorted by their ids over all partitions, equal ones by conv_id, so a beginning that a third of all
   conversations share is spread like any other. A pass over the sorted rows merges equal conversations and writes blocks
   of bounded size. The SHA-256 of the conv_ids that end at a node is computed along the way; where a run of equal
   conversations may go on in the next partition or is long, its conv_ids are written in chunks, which are hashed in order
   afterwards.
2. Each block becomes an adaptive radix tree over bytes: nodes grow through layouts of 4, 16, 48 and 256 children, and
   a path without branches is one node. Only depths at whole turns give rows, those inside a compressed path too.
3. A node that reaches into the neighbouring block has a row in each. Its block knows how far the last conversation before
   and the first one behind agree with its own, and counts children, leaves and the one copy of each text that is not
   saved only where they appear first (leaves: last). So these rows, a few for each block, are added up, and no other.

Turns are ordered by turn, null first, equal ones by id, so the order of ties does not depend on the run; repeated rows
are repeated turns. Null role or text is empty. Turns without conv_id belong to no conversation and take no part. An empty
table gives no node. Other columns are left behind. One conversation's ids, 20 bytes a turn, are one row; texts are never
gathered.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailspark.llm.common import join_checked, portable, staged

WIDTH = 20
BLOCK = 4 << 20  # bytes of ids in a block, or one conversation
ROWS = 20_000  # distinct conversations in a block
CHUNK = 1 << 20  # bytes of conv_ids in a chunk
NOTHING = hashlib.sha256().hexdigest()


# ------------------------------------------------------------ the tree


class Node:
    """A node of the radix tree: the bytes of its path, its children by their first byte, and the key that ends here.

    Up to 4 or 16 children are found by search in a sorted string of bytes, up to 48 through a table of 256 places, and
    more by the byte itself.
    """

    __slots__ = ("path", "kind", "bytes", "children", "key")
    LAYOUTS = (4, 16, 48, 256)

    def __init__(self, path: bytes, key: int = -1):
        self.path, self.kind, self.bytes, self.children, self.key = path, 4, bytearray(), [], key

    def find(self, byte: int) -> Node | None:
        if self.kind <= 16:
            at = bisect_left(self.bytes, byte)
            return self.children[at] if at < len(self.bytes) and self.bytes[at] == byte else None
        if self.kind == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def add(self, byte: int, child: Node) -> None:
        """A child under a new byte; a full node moves to the next layout first."""
        if self.kind <= 48 and len(self.children) == self.kind:
            self._grow()
        if self.kind <= 16:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.children.insert(at, child)
        elif self.kind == 48:
            self.children.append(child)
            self.bytes[byte] = len(self.children)
        else:
            self.children[byte] = child

    def replace(self, byte: int, child: Node) -> None:
        if self.kind <= 16:
            self.children[bisect_left(self.bytes, byte)] = child
        elif self.kind == 48:
            self.children[self.bytes[byte] - 1] = child
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        pairs = list(self.items())
        self.kind = self.LAYOUTS[self.LAYOUTS.index(self.kind) + 1]
        if self.kind == 48:
            self.bytes, self.children = bytearray(256), [c for _, c in pairs]
            for at, (byte, _) in enumerate(pairs, 1):
                self.bytes[byte] = at
        elif self.kind == 256:
            self.bytes, self.children = bytearray(), [None] * 256
            for byte, child in pairs:
                self.children[byte] = child

    def items(self):
        """(byte, child) in order of the bytes."""
        if self.kind <= 16:
            return zip(self.bytes, self.children)
        if self.kind == 48:
            return ((b, self.children[at - 1]) for b, at in enumerate(self.bytes) if at)
        return ((b, c) for b, c in enumerate(self.children) if c is not None)


def agreeing(a: bytes, b: bytes) -> int:
    """How many first bytes are equal."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def insert(root: Node, key: bytes, number: int) -> None:
    node, parent, at = root, None, 0
    while True:
        path = node.path
        same = agreeing(path, key[at : at + len(path)])
        if same < len(path):  # the key leaves inside the path, which is cut there
            upper = Node(path[:same])
            upper.add(path[same], node)
            node.path = path[same + 1 :]
            if parent is None:
                # the root stays the same object
                lower = Node(node.path, node.key)
                lower.kind, lower.bytes, lower.children = node.kind, node.bytes, node.children
                upper.replace(path[same], lower)
                node.path, node.kind, node.bytes, node.children, node.key = upper.path, 4, upper.bytes, upper.children, -1
            else:
                parent.replace(key[at - 1], upper)
                node = upper
        at += same
        if at == len(key):
            node.key = number
            return
        child = node.find(key[at])
        if child is None:
            node.add(key[at], Node(key[at + 1 :], number))
            return
        parent, node, at = node, child, at + 1


def build(keys: list[bytes]) -> Node:
    root = Node(keys[0], 0)
    for number in range(1, len(keys)):
        insert(root, keys[number], number)
    return root


# ------------------------------------------------------------ nodes of a block


def shared_turns(a: bytes | None, b: bytes) -> int:
    """How many first turns are equal; -1 without a neighbour, which not even the root is shared with."""
    return -1 if a is None else agreeing(a, b) // WIDTH


def digest(path: bytes) -> bytes:
    return hashlib.sha256(path).digest()[:16]


def block_nodes(before: bytes | None, after: bytes | None, keys: list[bytes], ends: list[int], least: list[int], hashes: list):
    """Rows (key, parent key, depth, turn, conv_id, parent conv_id, n_convs, n_children, n_leaves, saved_tokens, ends,
    shared) of a block's nodes. A parent that is shared is named by its key, any other by its conv_id. ``ends`` is None if
    no conversation ends there, and empty if they are hashed elsewhere.
    """
    left, right = shared_turns(before, keys[0]), shared_turns(after, keys[-1])
    final = len(keys) - 1
    rows: list[list] = []

    # Children come first. What is gathered below a node: conversations, least conv_id, leaves, saved tokens, first and
    # last key, and the rows whose parent has not been met.
    def emit(depth: int, state: list, number: int) -> None:
        n, smallest, leaves, saved, first, last, pending = state
        path = keys[first][: depth * WIDTH]
        old, on = first == 0 and depth <= left, last == final and depth <= right
        size = int.from_bytes(path[-4:], "big") if depth else 0
        if not pending:
            state[2] = leaves = 0 if on else 1
        state[3] = saved = saved + n * size - (0 if old else size)
        is_shared = old or on
        ended = None if number < 0 else hashes[number] or ""
        key = digest(path) if is_shared or ended == "" else None
        for child in pending:
            child[1], child[5] = (key, None) if is_shared else (None, smallest)
        children = sum(not child[-1] for child in pending)
        row = [key, None, depth, path[-WIDTH:-4].hex() if depth else None, smallest, None, n, children, leaves, saved, ended, is_shared, old]
        rows.append(row)
        state[6] = [row]

    root = build(keys)
    stack = [(root, 0, root.items(), [0, None, 0, 0, None, None, []])]
    # (node, bytes above its path, children to come, what is gathered)
    if root.key >= 0:
        _end(stack[0][3], root.key, ends, least)
    while stack:
        node, top, children, state = stack[-1]
        step = next(children, None)
        if step is not None:
            child = step[1]
            below = [0, None, 0, 0, None, None, []]
            if child.key >= 0:
                _end(below, child.key, ends, least)
            stack.append((child, top + len(node.path) + 1, child.items(), below))
            continue
        stack.pop()
        bottom = top + len(node.path)
        # whole turns on the way from the parent node, whose own depth is above ``top``
        highest = -(-top // WIDTH) if stack else 0
        for depth in range(bottom // WIDTH, highest - 1, -1):
            emit(depth, state, node.key if depth * WIDTH == bottom else -1)
        if stack:
            up = stack[-1][3]
            up[0] += state[0]
            up[1] = state[1] if up[1] is None else min(up[1], state[1])
            up[2] += state[2]
            up[3] += state[3]
            up[4] = state[4] if up[4] is None else min(up[4], state[4])
            up[5] = state[5] if up[5] is None else max(up[5], state[5])
            up[6] += state[6]
    return [row[:-1] for row in rows]


def _end(state: list, number: int, ends: list[int], least: list[int]) -> None:
    state[0], state[1], state[4], state[5] = ends[number], least[number], number, number


# ------------------------------------------------------------ Spark


def turn_id(role: Column, text: Column) -> Column:
    """The id as hexadecimal digits. Role and text are kept apart by the role's length."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lower(F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def listed(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's ids in order."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        turn_id(F.col("role"), F.col("text")).alias("id"),
    ).filter("conv_id IS NOT NULL")
    order = F.sort_array(F.collect_list(F.struct(F.col("turn"), F.col("id"))))  # null first
    return turns.groupBy("conv_id").agg(F.transform(order, lambda t: t["id"]).alias("turns"))


def paths(lists: DataFrame) -> DataFrame:
    """(conv_id, path) of (conv_id, turns)."""
    return lists.select("conv_id", F.unhex(F.array_join("turns", "")).alias("path"))


def rebuilt(lists: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Conversations that begin with the first h turns of the one whose conv_id is the next lower multiple of ``family``,
    and go on with their own behind their first h; h is the CRC-32 of the decimal conv_id, modulo ``most``."""
    lists = staged(lists, "trie-turns")  # read twice
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = lists.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), "turns", h.alias("h"))
    heads = lists.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head")
    )
    none = F.array().cast("array<string>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


_BLOCKS = (
    "pid int, number int, before binary, after binary, keys array<binary>, ends array<long>, least array<long>,"
    " hashes array<string>, run binary, chunk binary"
)
_NODES = (
    "key binary, parent_key binary, depth long, turn string, conv_id long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends string, shared boolean"
)


def _schema(text: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(text))


def blocks(sequences: DataFrame, block: int = BLOCK, rows: int = ROWS, chunk: int = CHUNK) -> DataFrame:
    """Sorted blocks of distinct conversations, and chunks of the conv_ids of runs that may go on elsewhere."""
    arrow = _schema(_BLOCKS)

    def run(batches):
        from pyspark import TaskContext

        pid, number = TaskContext.get().partitionId(), 0

        def record(**values):
            nonlocal number
            number += 1
            values |= {"pid": pid, "number": number}
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in arrow], schema=arrow)

        before = None  # the last conversation of the block before
        keys, ends, least, hashes, size = [], [], [], [], 0
        path, ids, count, smallest, hashed, wide = None, [], 0, 0, 0, True
        # ``wide``: the run may reach beyond this task, or is too long to wait for its end
        for batch in batches:
            for new, conv_id in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                if new != path:
                    if path is not None:
                        if wide and ids:
                            yield record(run=digest(path), chunk=b"," * (hashed > 0) + b",".join(ids))
                        text = None if wide else hashlib.sha256(b",".join(ids)).hexdigest()
                        keys.append(path), ends.append(count), least.append(smallest), hashes.append(text)
                        size += len(path)
                        wide = False
                        if size >= block or len(keys) >= rows:
                            yield record(before=before, after=new, keys=keys, ends=ends, least=least, hashes=hashes)
                            before, size = path, 0
                            keys, ends, least, hashes = [], [], [], []
                    path, ids, count, smallest, hashed, held = new, [], 0, conv_id, 0, 0
                ids.append(b"%d" % conv_id)
                held += len(ids[-1]) + 1
                count += 1
                if held >= chunk:
                    yield record(run=digest(path), chunk=b"," * (hashed > 0) + b",".join(ids))
                    ids, held, hashed, wide = [], 0, hashed + 1, True
        if path is not None:
            if ids:
                yield record(run=digest(path), chunk=b"," * (hashed > 0) + b",".join(ids))
            keys.append(path), ends.append(count), least.append(smallest), hashes.append(None)
            yield record(before=before, keys=keys, ends=ends, least=least, hashes=hashes)

    ordered = staged(sequences.select("path", "conv_id"), "trie-paths")  # ranges are found by a scan before the sort
    ordered = ordered.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return staged(ordered.mapInArrow(portable(run), _BLOCKS), "trie-blocks")


def neighboured(found: DataFrame) -> DataFrame:
    """The blocks, with the conversations beside them in the partitions before and behind."""
    found = found.filter("keys IS NOT NULL")
    edges = found.groupBy("pid").agg(
        F.min("number").alias("first"), F.max("number").alias("last"),
        F.min_by(F.element_at("keys", 1), "number").alias("head"), F.max_by(F.element_at("keys", -1), "number").alias("tail"),
    )
    order = Window.orderBy("pid")  # one row a partition, whatever the table's size
    edges = edges.select(
        "pid", "first", "last", F.lag("tail").over(order).alias("tail_before"), F.lead("head").over(order).alias("head_after"), "head"
    )
    sorted_ = F.when(F.col("tail_before") > F.col("head"), F.raise_error(F.lit("partitions out of order")).cast("binary"))
    edges = staged(edges.withColumn("tail_before", sorted_.otherwise(F.col("tail_before"))).drop("head"), "trie-edges")
    return join_checked(found, edges, ["pid"], 10_000).select(
        F.when(F.col("number") == F.col("first"), F.col("tail_before")).otherwise(F.col("before")).alias("before"),
        F.when(F.col("number") == F.col("last"), F.col("head_after")).otherwise(F.col("after")).alias("after"),
        "keys", "ends", "least", "hashes",
    )


def run_hashes(found: DataFrame) -> DataFrame:
    """(key, whole): SHA-256 over the chunks of each run, in their order."""
    arrow = _schema("key binary, whole string")

    def run(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for new, text in zip(*(batch.column(i).to_pylist() for i in (0, 3))):
                if new != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = new, hashlib.sha256()
                elif not text.startswith(b","):
                    state.update(b",")  # the run goes on in another partition
                state.update(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], schema=arrow)

    chunks = found.filter("run IS NOT NULL").select("run", "pid", "number", "chunk")
    dealt = chunks.repartition("run").sortWithinPartitions("run", "pid", "number")
    return dealt.mapInArrow(portable(run), "key binary, whole string")


def nodes(sequences: DataFrame, block: int = BLOCK, rows: int = ROWS, chunk: int = CHUNK) -> DataFrame:
    """One row a node of the trie of (conv_id, path): conv_id (least member), depth, turn (hexadecimal id of its last turn
    without the length, null for the root), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    found = blocks(sequences, block, rows, chunk)
    arrow = _schema(_NODES)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                out = block_nodes(*(batch.column(i)[row].as_py() for i in range(6)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    parts = staged(neighboured(found).mapInArrow(portable(run), _NODES), "trie-nodes")
    merged = parts.filter("shared").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.max("turn").alias("turn"),
        F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        # empty, if some are hashed elsewhere: all of a run that is in several blocks are
        F.min("ends").alias("ends"),
    )
    merged = staged(merged, "trie-shared")
    columns = merged.columns
    every = parts.filter("NOT shared").select(*columns).unionByName(merged)
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    wholes = staged(run_hashes(found), "trie-ends")
    for small, on in ((above, "parent_key"), (wholes, "key")):
        # a few rows a block and a partition; beyond the bound by shuffle
        every = every.join(F.broadcast(small) if small.count() <= 500_000 else small, on, "left")
    return every.select(
        "conv_id", "depth", "turn", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens",
        F.when(F.col("ends").isNull(), NOTHING).when(F.col("ends") == "", F.col("whole")).otherwise(F.col("ends")).alias("ends_sha256"),
    )
