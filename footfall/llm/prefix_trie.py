"""Prefix trie of conversations: what they share from their first turn on.

Turns become 16-byte digests of role and text, which order sequences of turns. Sequences are sorted by range;
each run of about RUN turns of that order is a shard, in which a dictionary numbers the digests and a ternary
search tree over those numbers holds the distinct sequences, inserted median first so that it is balanced.
An iterative traversal adds up members, leaves and savings from the leaves to the top. Nodes on the path of a
run's first or last sequence may go on in a neighbouring run; only they are merged across runs.

Long and hot things are split. A conversation is cut into segments of SEGMENT turns; a segment hangs below the
node where its predecessor ends, whose digest it carries, so that a run holds short sequences whatever a
conversation's length. Sums below deeper segments reach the upper ones by pointer doubling, in a number of
rounds that is the logarithm of the segments of the longest conversation. Turns are numbered in range-sorted
partitions with offsets between them, never gathered by conversation. Copies of a conversation may fill many
runs; their ids are joined to text chunk by chunk, and only the last hash reads the chunks one after the other.

Defined results: null role and text count as empty; a null turn comes first; turns that tie are ordered by role
and text; repeated rows are turns of their own; rows without conv_id belong to no conversation; conversations
that are rebuilt without a turn are members of the root alone; an empty table gives no node; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from footfall.llm.tables import stored

SEGMENT = 64
RUN = 200_000
CHUNK = 10_000
DIGEST = 16
ROOT = bytes(DIGEST)
GROUP = 20
HEAD = 3


def _kept_turns(conv: Column) -> Column:
    """How many turns a conversation takes over from the first of its group of GROUP ids."""
    return (F.crc32(conv.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


# --- turns in order -------------------------------------------------------------------------------------------


def _count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column: the task's number, and each row's place among those of equal first column."""
    task, key, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        fresh = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        place = np.arange(len(keys)) - np.repeat(fresh, np.diff(np.r_[fresh, len(keys)]))
        if keys[0] == key:
            place[: fresh[1] if len(fresh) > 1 else len(keys)] += n
        key, n = keys[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(keys), task, np.int32)), pa.array(place)], [*batch.schema.names, "__task", "__place"]
        )


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """rows with `place`, from 0 on, among those of the same key (first column, a non-null long). A key may have any
    number of rows: they are sorted by range, and what the tasks before have of it is added."""
    first = rows.select(key, *[c for c in rows.columns if c != key])
    ordered = first.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    kinds = T.StructType([*first.schema.fields, T.StructField("__task", T.IntegerType()), T.StructField("__place", T.LongType())])
    counted = stored(ordered.mapInArrow(_count_on, kinds), name)
    # Only the first and the last key of a task can go on in another: two rows a task.
    edge = counted.groupBy("__task").agg(F.array(F.min(key), F.max(key)).alias("keys")).select("__task", F.explode("keys").alias(key)).distinct()
    held = counted.join(F.broadcast(edge), ["__task", key]).groupBy("__task", key).agg((F.max("__place") + 1).alias("n"))
    before = Window.partitionBy(key).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offset = held.select("__task", key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__more")).where("__more > 0")
    out = counted.join(F.broadcast(offset), ["__task", key], "left")
    return out.select(*first.columns, (F.col("__place") + F.coalesce("__more", F.lit(0))).alias("place"))


def _turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 0), t (digest of role and text), w (words of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ", -1))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").isNotNull().alias("dated"),
        F.coalesce(F.col("turn"), F.lit(0)).alias("at"),
        digest.alias("t"),
        F.when(text.rlike(r"[^\x20\x09-\x0D]"), words).otherwise(0).alias("w"),
        role.alias("role"),
        text.alias("text"),
    )
    narrow = stored(rows.drop("role", "text"), "turns")
    spot = ["conv", "dated", "at"]
    tied = narrow.groupBy(*spot).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select(*spot)
    full = rows.join(tied, spot, "left_semi").dropDuplicates([*spot, "t"])
    rank = numbered(full.drop("w"), "conv", ["dated", "at", "role", "text"], "ties").select(*spot, "t", F.col("place").alias("rank"))
    ranked = narrow.join(rank, [*spot, "t"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    return numbered(ranked, "conv", ["dated", "at", "rank", "t"], "ordered").select("conv", "place", "t", "w")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv, place (from 1), t, w of every rebuilt conversation; at place 0 each has a row without t."""
    convs = stored(turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv"), "convs")
    base = F.col("conv") - F.col("conv") % GROUP
    kept = _kept_turns(F.col("conv"))
    own = turns.where((F.col("place") >= kept) | (F.col("conv") % GROUP == 0))
    heads = turns.where((F.col("conv") % GROUP == 0) & (F.col("place") < HEAD)).withColumnRenamed("conv", "base")
    taken = convs.where(F.col("conv") % GROUP != 0).select("conv", base.alias("base"), kept.alias("kept"))
    taken = taken.join(heads, "base").where("place < kept").select("conv", "place", "t", "w")
    start = convs.select("conv", F.lit(-1).cast("long").alias("place"), F.lit(b"").alias("t"), F.lit(0).alias("w"))
    rows = start.unionByName(taken).unionByName(own).withColumnRenamed("place", "was")
    return numbered(rows, "conv", ["was"], "rebuilt").select("conv", "place", "t", "w")


# --- segments -------------------------------------------------------------------------------------------------


def _end_key(root: bytes, turns: bytes) -> bytes:
    """Key of the node that `turns` lead to from the node `root`."""
    return hashlib.md5(root + hashlib.md5(turns).digest()).digest() if turns else root


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the segments of conversations, sorted by (conv, seg): each with the key of the node that it hangs from,
    the key of its end, and whether it is the last."""
    held: list[list] = []
    conv, root = None, ROOT

    def rows(some: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in some], kind) for k, kind in enumerate(kinds)], ["conv", "seg", "root", "end", "last"])

    for batch in batches:
        for c, seg, digest in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if held and held[-1][0] == c:
                held[-1][4] = False
            root = root if c == conv else ROOT
            end = hashlib.md5(root + digest).digest()
            held.append([c, seg, root, end, True])
            conv, root = c, end
        if len(held) > 1:
            yield rows(held[:-1])
            del held[:-1]
    yield rows(held)


def _segments(turns: DataFrame) -> DataFrame:
    """conv, seg, root, end, last, turns (digests joined), words: at most SEGMENT turns a row, stored."""
    seg = F.floor((F.greatest("place", F.lit(1)) - 1) / SEGMENT).alias("seg")
    rows = turns.groupBy("conv", seg).agg(F.array_sort(F.collect_list(F.struct("place", "t", "w"))).alias("row"))
    row = F.filter("row", lambda x: x["place"] > 0)
    rows = rows.select("conv", "seg", F.unhex(F.concat_ws("", F.transform(row["t"], F.hex))).alias("turns"), row["w"].alias("words"))
    rows = stored(rows, "segments")
    whole = (F.col("seg") == 0) & (F.size("words") < SEGMENT)
    short = rows.where(whole).withColumns({"root": F.lit(ROOT), "end": F.lit(b""), "last": F.lit(True)})
    long = rows.where(~whole)
    digests = long.select("conv", "seg", F.unhex(F.md5("turns")).alias("digest"))
    links = digests.repartition("conv").sortWithinPartitions("conv", "seg")
    links = links.mapInArrow(_chain, "conv long, seg long, root binary, end binary, last boolean")
    return stored(short.unionByName(long.join(links, ["conv", "seg"])), "rooted")


# --- one shard ------------------------------------------------------------------------------------------------


class _Tree:
    """A ternary search tree over turn numbers: nodes with one turn each, links to smaller, larger and next turns."""

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.next, self.ends = [-1], [0], [0], [0], [-1]

    def _new(self, turn: int) -> int:
        for column, value in ((self.turn, turn), (self.low, 0), (self.high, 0), (self.next, 0), (self.ends, -1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, turns: list[int], sequence: int) -> None:
        turn, low, high, below = self.turn, self.low, self.high, self.next
        parent = 0
        for t in turns:
            at = below[parent]
            if not at:
                at = below[parent] = self._new(t)
            while turn[at] != t:
                side = low if t < turn[at] else high
                if not side[at]:
                    side[at] = self._new(t)
                at = side[at]
            parent = at
        self.ends[parent] = sequence

    def walk(self) -> Iterator[tuple[int, int, int, int]]:
        """(turn, parent's place in this walk, depth, sequence that ends here or -1), depth first and without recursion."""
        yield -1, -1, 0, self.ends[0]
        stack, place = [(self.next[0], 0, 1)], 0
        while stack:
            at, parent, depth = stack.pop()
            while at:
                place += 1
                yield self.turn[at], parent, depth, self.ends[at]
                stack += [(self.high[at], parent, depth), (self.low[at], parent, depth)]
                at, parent, depth = self.next[at], place, depth + 1


def _median_first(n: int) -> Iterator[int]:
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            yield (a + b) // 2
            todo += [((a + b) // 2 + 1, b), (a, (a + b) // 2)]


_NODE = (
    "key binary, parent binary, parent_conv long, above array<binary>, edge boolean, group boolean, seg long, depth long, conv long, n long, "
    "words long, children long, leaves long, saved long, goes_on boolean, deep_children long, deep_leaves long, deep_saved long, "
    "ends_sha256 string, ends_first long, ends string"
)
_NODE_TYPES = (
    pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(),
)
_NODE_NAMES = [field.split()[0] for field in _NODE.split(", ")]


def _nodes_of(seg: int, root: bytes, sequences: list[tuple[bytes, list[int]]], rows: list[list[tuple]], edges: tuple[bool, bool]) -> Iterator[tuple]:
    """The nodes that the sorted distinct `sequences` below one root make. rows: for each, (conv, last, deeper children,
    leaves and savings) of its members, by conv. edges: whether the first and the last sequence may go on elsewhere."""
    joined = b"".join(s for s, _ in sequences)
    digests, numbers = np.unique(np.frombuffer(joined, f"V{DIGEST}").astype(f"V{DIGEST}"), return_inverse=True) if joined else ([], np.empty(0, int))
    starts = np.cumsum([0, *[len(s) // DIGEST for s, _ in sequences]])
    weight = dict(zip(numbers.tolist(), [w for _, words in sequences for w in words], strict=True))
    tree = _Tree()
    for k in _median_first(len(sequences)):
        tree.insert(numbers[starts[k] : starts[k + 1]].tolist(), k)

    nodes = list(tree.walk())
    n, conv, children, leaves, saved = (np.zeros(len(nodes), np.int64) for _ in range(5))
    conv[:] = np.iinfo(np.int64).max
    edge = np.zeros(len(nodes), bool)
    marked = {k for k, open_ in ((0, edges[0]), (len(sequences) - 1, edges[1])) if open_}
    goes_on: dict[int, tuple] = {}
    for i in range(len(nodes) - 1, -1, -1):  # leaves first
        turn, parent, _, sequence = nodes[i]
        if sequence >= 0:
            members = rows[sequence]
            n[i] += len(members)
            conv[i] = min(conv[i], members[0][0])
            edge[i] |= sequence in marked
            if deeper := next((m[2:] for m in members if not m[1]), None):
                goes_on[i] = deeper
                if not edge[i]:
                    children[i], leaves[i], saved[i] = deeper
        if edge[i]:
            if i:
                edge[parent] = True
                n[parent] += n[i]  # its own sums follow when all its parts are merged
                conv[parent] = min(conv[parent], conv[i])
            continue
        if i:
            leaves[i] += not children[i] and i not in goes_on
            saved[i] += (n[i] - 1) * weight[turn]
            n[parent] += n[i]
            conv[parent] = min(conv[parent], conv[i])
            children[parent] += 1
            leaves[parent] += leaves[i]
            saved[parent] += saved[i]
        elif not children[0] and 0 not in goes_on:
            leaves[0] += 1

    path: list = [hashlib.md5()]
    keys = [root]
    for i, (turn, parent, depth, sequence) in enumerate(nodes):
        del path[depth + (not i) :], keys[depth + (not i) :]
        if i:
            path.append(path[-1].copy())
            path[-1].update(digests[turn].tobytes())
            keys.append(hashlib.md5(root + path[-1].digest()).digest())
        ends = [m[0] for m in rows[sequence] if m[1]] if sequence >= 0 else []
        text = ",".join(map(str, ends))
        known = (hashlib.sha256(text.encode()).hexdigest(), None, None) if not edge[i] else (None, ends[0] if ends else None, text or None)
        inside = i and not edge[parent] and (parent or not seg)
        yield (
            keys[-1], keys[-2] if i else None, int(conv[parent]) if inside else None, keys[:-1] if edge[i] else None, bool(edge[i]), not i, seg,
            seg * SEGMENT + depth, int(conv[i]), int(n[i]), weight[turn] if i else 0, int(children[i]), int(leaves[i]), int(saved[i]),
            i in goes_on, *(goes_on.get(i, (0, 0, 0)) if edge[i] else (0, 0, 0)), *known,
        )


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (seg, root, turns, conv): the nodes of each run of about RUN turns."""

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), _NODE_TYPES, strict=True)], _NODE_NAMES)

    def settle(groups: list[tuple]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for k, (seg, root, sequences, members) in enumerate(groups):
            for node in _nodes_of(seg, root, sequences, members, (k == 0, k == len(groups) - 1)):
                found.append(node)
                if len(found) >= 5000:
                    yield rows(found)
                    found = []
        if found:
            yield rows(found)

    groups: list[tuple] = []
    size = copies = 0
    for batch in batches:
        for conv, seg, root, turns, words, last, *deeper in zip(*(batch.column(k).to_pylist() for k in range(9)), strict=True):
            if size >= RUN or copies >= CHUNK:
                yield from settle(groups)
                groups, size, copies = [], 0, 0
            if not groups or groups[-1][:2] != (seg, root):
                groups.append((seg, root, [], []))
            _, _, sequences, members = groups[-1]
            if not sequences or sequences[-1][0] != turns:
                sequences.append((turns, words))
                members.append([])
                size, copies = size + len(words) + 1, 0
            members[-1].append((conv, last, *deeper))
            copies += 1
            size += 1
    if groups:
        yield from settle(groups)


def _nodes(segments: DataFrame) -> DataFrame:
    """Nodes of all shards, as stored rows. segments: conv, seg, root, turns, words, last, children, leaves, saved."""
    order = ["seg", "root", "turns", "conv"]
    fields = ["conv", "seg", "root", "turns", "words", "last", "children", "leaves", "saved"]
    rows = segments.select(*fields).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.mapInArrow(_shard, _NODE), "nodes")


# --- merging --------------------------------------------------------------------------------------------------


def _merged(nodes: DataFrame) -> DataFrame:
    """Edge nodes, one row for each segment number and key, with the sums of whole subtrees. An edge node's ancestors in
    its segment are edge nodes too, at most SEGMENT of them, and it adds to each. (Where a segment begins, its root has
    the key of the node that it hangs from, which is of the segment before.)"""
    node = ["seg", "key"]
    keep = {c: F.first(c).alias(c) for c in ("parent", "above", "group", "depth", "words")}
    total = {c: F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")}
    deep = {c: F.max(f"deep_{c}").alias(f"deep_{c}") for c in ("children", "leaves", "saved")}  # comes with each part, counts once
    whole = (*keep.values(), *total.values(), *deep.values(), F.min("conv").alias("conv"), F.bool_or("goes_on").alias("goes_on"))
    parts = nodes.where("edge").groupBy(*node).agg(*whole).withColumns({c: F.col(c) + F.col(f"deep_{c}") for c in deep})
    parts = stored(parts, "parts")
    more = parts.where("parent is not null").groupBy("seg", F.col("parent").alias("key")).agg(F.count("*").alias("more"))
    own = parts.join(more, node, "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    own = own.withColumn("leaves", F.col("leaves") + F.when((F.col("children") == 0) & ~F.col("goes_on"), 1).otherwise(0))
    own = stored(own.withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("words")).drop("more"), "own")
    up = own.select("seg", F.explode(F.concat("above", F.array("key"))).alias("key"), "leaves", "saved").groupBy(*node)
    return own.drop("leaves", "saved").join(up.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), node)


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of joined ids sorted by (key, first id): one hash for each key, in a stream."""
    key, state = None, hashlib.sha256()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    for batch in batches:
        for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    yield row()
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if key is not None:
        yield row()


def _deeper(segments: DataFrame) -> DataFrame:
    """end (key of the node where a segment begins), children, leaves, saved of all that hangs below, for nodes where a
    conversation is cut."""
    below = segments.where("seg > 0").withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
    nodes = _nodes(below)
    fields = ["key", "children", "leaves", "saved"]
    roots = nodes.where("group and not edge").select(*fields).unionByName(_merged(nodes).where("group").select(*fields))
    up = segments.where("seg > 0 and not last").select(F.col("end").alias("key"), F.col("root").alias("up")).distinct()
    tops = stored(roots.join(up, "key", "left"), "roots")
    while not tops.where("up is not null").isEmpty():  # S(v) reaches 2^k segments down, `up` is 2^k segments up
        sent = tops.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        jump = tops.select(F.col("key").alias("up"), F.col("up").alias("far"))
        moved = tops.join(jump, "up", "left").join(sent, "key", "left")
        leaves, saved = (F.col(a) + F.coalesce(b, F.lit(0)) for a, b in (("leaves", "l"), ("saved", "s")))
        tops = stored(moved.select("key", "children", leaves.alias("leaves"), saved.alias("saved"), F.col("far").alias("up")), "roots")
    return tops.select(F.col("key").alias("end"), "children", "leaves", "saved")


def build(turns: DataFrame) -> DataFrame:
    """The trie's nodes from sequences (conv, place from 1 on with an empty row at 0, t, w)."""
    segments = _segments(turns)
    zero = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
    if segments.where("seg > 0").isEmpty():
        segments = segments.withColumns(zero)
    else:
        more = segments.where("not last").join(_deeper(segments), "end", "left")
        more = more.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})
        segments = segments.where("last").withColumns(zero).unionByName(more)
    nodes = _nodes(segments)
    merged = _merged(nodes).where("not group or seg = 0")
    chunks = nodes.where("edge and ends is not null").select("key", "ends_first", "ends")
    hashes = chunks.repartition("key").sortWithinPartitions("key", "ends_first").mapInArrow(_digest_chunks, "key binary, ends_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    merged = merged.join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    fields = ["key", "parent", "group", "seg", "depth", "conv", "n", "children", "leaves", "saved", "ends_sha256", "goes_on"]
    inner = nodes.where("not edge and (not group or seg = 0)").select(*fields, "parent_conv")
    whole = stored(merged.select(*fields, F.lit(None).cast("long").alias("parent_conv")), "merged")
    out = inner.unionByName(whole)
    # Parents in other shards or segments: a few merged nodes and those where a segment ends.
    parents = whole.unionByName(inner.where("goes_on")).select(F.col("key").alias("parent"), F.col("conv").alias("up"))
    known = F.col("parent").isNull() | F.col("parent_conv").isNotNull()
    found = out.where(~known).join(parents, "parent").withColumn("parent_conv", F.col("up")).drop("up")
    return out.where(known).unionByName(found).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
        F.hex("key").alias("node"),
        F.hex("parent").alias("parent"),
    )


def _with_start(turns: DataFrame) -> DataFrame:
    """turns (conv, place from 0) moved on by one, and a row without turn at place 0."""
    start = turns.select("conv").distinct().select("conv", F.lit(0).cast("long").alias("place"), F.lit(b"").alias("t"), F.lit(0).alias("w"))
    return start.unionByName(turns.withColumn("place", F.col("place") + 1))


def trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the conversations as they are. A row for each distinct sequence of first turns: conv_id (the
    smallest that begins with it), depth, parent_conv_id, n_convs, n_children, n_leaves (childless nodes below, itself
    included), saved_tokens (words that a cache of its subtree saves), ends_sha256 (of the ids that end there), node and
    parent, which name nodes."""
    return build(_with_start(_turns(conversations)))


def report(conversations: DataFrame) -> DataFrame:
    """The same of the rebuilt conversations, without the names of nodes."""
    return build(rebuilt(_turns(conversations))).drop("node", "parent")
