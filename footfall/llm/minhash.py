"""MinHash near-dedup with circulant signatures, banding, and exact verification.

A document's set holds the hashes of its distinct 5-word shingles. One permutation places a shingle in a
ring of 2^32 places; a second one, shifted around the ring by k places, gives the k-th coordinate: the
smallest value over the set. BANDS bands of ROWS coordinates are the search keys; a pair at similarity 0.75
misses all of them with probability 5e-6. Links are confirmed on the full sets.

Documents with equal sets are one node, so copies never meet each other. Inside a band's bucket, members are
compared with the bucket's first member, not with each other. In buckets whose members are still in different
components, blocks of nodes that share rare shingles are compared, as all linked pairs share one (see
`_open_links`): no link that joins components is lost, and no list of all pairs of a group is made.

Everything between the steps is a table in the shared folder. Nothing but counts comes to the driver.

Defined results: null and empty texts and texts of blanks have no shingles and are linked with nothing; one
to four words are one shingle; repeated rows share their component; a document without an id takes part, and
its component is the smallest id it reaches, or null; `kept` compares null-safe; columns other than doc_id
and text pass through `keep_one`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from footfall.llm.tables import stored, stored_alone
from footfall.llm.text import NOT_SPACE, Slice, find_words, grams, mix, slices

SHINGLE = 5
BANDS, ROWS = 32, 4
PERCENT = 75
BLOCK = 256


def shingles(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all documents in order, and where each document's begin."""
    words = find_words(part, NOT_SPACE)
    count = np.diff(words.bounds)
    size = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    bounds = np.r_[0, np.cumsum(size)]
    out = np.empty(bounds[-1], np.uint64)
    row = np.repeat(np.arange(len(part)), size)
    at = words.bounds[:-1][row] + np.arange(len(out)) - bounds[:-1][row]
    full = grams(words.hashes, SHINGLE)
    long = count[row] >= SHINGLE
    out[long] = full[at[long]]
    for i in np.flatnonzero((count > 0) & (count < SHINGLE)).tolist():
        out[bounds[i]] = grams(words.hashes[words.bounds[i] : words.bounds[i + 1]], int(count[i]))[0]
    return out, bounds


def _permuted(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Coordinates by document, for documents that all have shingles."""
    place = (mix(hashes) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        out[:, k] = np.minimum.reduceat(_permuted(place + np.uint32(k)), bounds[:-1])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.empty((len(signature), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(signature), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            h = mix(h + signature[:, k])
        keys[:, band] = h
    return keys.view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: number of shingles, digests of set and text, band keys."""
    for batch in batches:
        for part in slices(batch.column(1)):
            hashes, bounds = shingles(part)
            some = np.flatnonzero(np.diff(bounds))
            keys = band_keys(signatures(hashes, np.r_[bounds[some], bounds[-1]])) if len(some) else np.empty((0, BANDS), np.int64)
            sizes, sets, texts = np.zeros(len(part), np.int64), [b""] * len(part), [b""] * len(part)
            for i in some.tolist():
                unique = np.unique(hashes[bounds[i] : bounds[i + 1]])
                sizes[i], sets[i] = len(unique), hashlib.blake2b(unique.tobytes(), digest_size=16).digest()
                texts[i] = hashlib.sha256(part.text(i)).digest()
            at = np.zeros(len(part) + 1, np.int32)
            at[some + 1] = BANDS
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum(at, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(part.first, len(part)),
                    pa.array(sizes),
                    pa.array(sets, pa.binary()),
                    pa.array(texts, pa.binary()),
                    bands,
                ],
                ["doc_id", "n", "set_id", "text_id", "bands"],
            )


def _similar(a: Column, b: Column) -> Column:
    """Sizes at which a link is possible."""
    return (a * 100 >= b * PERCENT) & (b * 100 >= a * PERCENT)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (leader, chunk), the leader's text before its members': the linked pairs."""
    key, own = None, np.empty(0, np.uint64)
    for batch in batches:
        leaders, chunks, nodes = (batch.column(k).to_pylist() for k in range(3))
        a, b = [], []
        for part in slices(batch.column(3)):
            hashes, bounds = shingles(part)
            for i, row in enumerate(range(part.first, part.last)):
                mine = np.unique(hashes[bounds[i] : bounds[i + 1]])
                if nodes[row] is None:
                    key, own = (leaders[row], chunks[row]), mine
                    continue
                assert key == (leaders[row], chunks[row])
                common = int((own[np.minimum(np.searchsorted(own, mine), len(own) - 1)] == mine).sum())
                if 100 * common >= PERCENT * (len(own) + len(mine) - common):
                    a.append(leaders[row])
                    b.append(nodes[row])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a leader, b) whose texts are linked. texts: node, text. Members of a leader are dealt in chunks."""
    size = pairs.groupBy("a").agg((F.floor(F.count("*") / BLOCK) + 1).alias("chunks"))
    dealt = pairs.join(size, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    members = dealt.join(texts, F.col("b") == F.col("node")).select("a", "chunk", "b", "text")
    heads = dealt.select("a", "chunk").distinct().join(texts, F.col("a") == F.col("node"))
    rows = members.unionByName(heads.select("a", "chunk", F.lit(None).cast("long").alias("b"), "text"))
    rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return rows.mapInArrow(_verify, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node it reaches, for the nodes of edges (a, b), as a stored table."""
    return stored_alone(edges.sparkSession, lambda: _labels(edges), "components")


def _labels(edges: DataFrame) -> DataFrame:
    both = stored(edges.union(edges.select("b", "a")).toDF("a", "b"), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        up = lower.select(F.col("node").alias("up"), F.col("label").alias("top"))
        jumped = lower.join(up, F.col("label") == F.col("up")).select("node", F.col("top").alias("label"), "old")
        seen = Observation()
        labels = stored(jumped.observe(seen, F.count_if(F.col("label") != F.col("old")).alias("changed")).drop("old"), "labels")
        if not seen.get.get("changed"):
            return labels


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node and distinct shingle."""
    for batch in batches:
        for part in slices(batch.column(3)):
            hashes, bounds = shingles(part)
            sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            index = pa.array(np.repeat(np.arange(part.first, part.last), [len(x) for x in sets]))
            columns = [batch.column(k).take(index) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(sets).view(np.int64))], ["node", "n", "label", "s"])


def _compare(ones: list[tuple], twos: list[tuple], same: bool) -> tuple[list[int], list[int]]:
    """Links between two blocks of nodes (node, n, label, alone, rare shingles, set) with different labels."""
    n, m = (np.array([x[1] for x in some]) for some in (ones, twos))
    common = -(-(n[:, None] + m[None, :]) * PERCENT // (100 + PERCENT))
    room_n, room_m = n[:, None] - common, m[None, :] - common
    shared = np.zeros(common.shape, bool)
    lists = []
    for some in (ones, twos):
        s = np.concatenate([np.array(x[4], np.int64) for x in some])
        own = np.repeat(np.arange(len(some)), [len(x[4]) for x in some])
        at = np.concatenate([x[3] + np.arange(len(x[4])) for x in some])
        order = np.argsort(s, kind="stable")
        lists.append((s[order], own[order], at[order]))
    (s1, own1, at1), (s2, own2, at2) = lists
    for token in np.intersect1d(s1, s2):
        lo1, hi1 = np.searchsorted(s1, token), np.searchsorted(s1, token, side="right")
        lo2, hi2 = np.searchsorted(s2, token), np.searchsorted(s2, token, side="right")
        cell = np.ix_(own1[lo1:hi1], own2[lo2:hi2])
        shared[cell] |= (at1[lo1:hi1, None] <= room_n[cell]) & (at2[None, lo2:hi2] <= room_m[cell])
    shared &= np.array([x[2] for x in ones])[:, None] != np.array([x[2] for x in twos])[None, :]
    a, b = [], []
    for i, j in np.argwhere(np.triu(shared) if same else shared).tolist():
        one, two = ones[i][5], twos[j][5]
        k = int((one[np.minimum(np.searchsorted(one, two), len(one) - 1)] == two).sum())
        if 100 * k >= PERCENT * (len(one) + len(two) - k):
            a.append(ones[i][0])
            b.append(twos[j][0])
    return a, b


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes sorted by block pair (x, y), with the block each is from: the links between them."""

    def settle(key: tuple[int, int], held: list[tuple]) -> pa.RecordBatch:
        ones, twos = [x[1:] for x in held if x[0] == key[0]], [x[1:] for x in held if x[0] == key[1]]
        a, b = _compare(ones, twos, key[0] == key[1]) if ones and twos else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    key, held = None, []
    for batch in batches:
        columns = list(zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True))
        for part in slices(batch.column(8)):
            hashes, bounds = shingles(part)
            for i, (x, y, *node) in enumerate(columns[part.first : part.last]):
                if key != (x, y):
                    if held:
                        yield settle(key, held)
                    key, held = (x, y), []
                held.append((*node, np.unique(hashes[bounds[i] : bounds[i + 1]])))
    if held:
        yield settle(key, held)


def _open_links(nodes: DataFrame, hubs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between nodes (node, n, label) with different labels. hubs: node, hub.

    Order each set by how rare its shingles are among these nodes. Two linked sets of n and m shingles have
    `common` = 3/7 (n + m) of them in common, so they share one among the first n - common + 1 and m - common + 1,
    which is the rarest quarter at most. A node with that many shingles of its own can be linked with nothing.

    Nodes of a hub are dealt to blocks of about BLOCK, and blocks meet in a shingle's list, not nodes: a pair of
    blocks that share a rare shingle under different labels is one piece of work, which reads each text once and
    compares the nodes that share a shingle early enough.
    """
    rows = nodes.join(texts, "node").select("node", "n", "label", "text").mapInArrow(_tokens, "node long, n long, label long, s long")
    rows = stored(rows, "tokens")
    shared = rows.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
    own = rows.join(shared, "s").groupBy("node", "n", "label").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("some"))
    alone = F.col("n") - F.size("some")  # shingles that no other node has come first
    room = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - alone
    rare = own.where(room > 0).select("node", "n", "label", alone.alias("alone"), F.slice("some", F.lit(1), room.cast("int"))["s"].alias("rare"))
    at_hub = rare.join(hubs, "node", "left").withColumn("hub", F.coalesce("hub", "node")).withColumn("single", F.col("label") == F.col("node"))
    at_hub = stored(at_hub, "rare")
    parts = at_hub.groupBy("hub", "single").agg((F.floor(F.count("*") / BLOCK) + 1).alias("parts"))
    block = F.xxhash64("hub", "single", F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = at_hub.join(parts, ["hub", "single"]).join(texts, "node").select("node", "n", "label", "alone", "rare", "text", block.alias("block"))
    placed = stored(placed, "placed")

    listed = placed.select("block", "label", F.explode("rare").alias("s")).groupBy("s", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    one, two = listed.toDF("s", "x", "lx", "hx"), listed.toDF("s", "y", "ly", "hy")
    differ = F.least("lx", "ly") != F.greatest("hx", "hy")
    work = stored(one.join(two, "s").where((F.col("x") <= F.col("y")) & differ).select("x", "y").distinct(), "work")
    fields = ("x", "y", "block", "node", "n", "label", "alone", "rare", "text")
    rows = work.join(placed, F.col("x") == F.col("block")).select(*fields)
    rows = rows.unionAll(work.where("x <> y").join(placed, F.col("y") == F.col("block")).select(*fields))
    return rows.repartition("x", "y").sortWithinPartitions("x", "y").mapInArrow(_compare_blocks, "a long, b long")


def _links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect all that can be connected inside the buckets. members: key, node, n."""
    first = members.groupBy("key").agg(F.min("node").alias("a"), F.min_by("n", "node").alias("na"))
    pairs = members.join(first, "key").where((F.col("a") != F.col("node")) & _similar(F.col("n"), F.col("na")))
    tested = stored(pairs.select("a", F.col("node").alias("b")).distinct(), "pairs")
    links = stored(verified(tested, texts), "links")
    now = members.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    rest = stored(now.join(mixed, "key", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("label").alias("label")), "rest")
    hubs = tested.select(F.col("b").alias("node"), "a").unionAll(tested.select("a", "a")).groupBy("node").agg(F.min("a").alias("hub"))
    return links.unionByName(_open_links(rest, hubs, texts))


def _node_labels(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and label for the nodes that are linked with others. nodes: node, n, one of its documents, bands."""
    keyed = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    members = stored(keyed.join(shared, "key"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "one.doc_id", "one.text_id")
    keys = docs.withColumn("__text_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    same = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.__text_id") == F.col("w.text_id"))
    texts = keys.alias("t").join(wanted.alias("w"), same).select("node", "text").dropDuplicates(["node"])
    return components(_links(members, stored(texts, "texts")))


def groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. Also `text_id`, a digest of the text (empty without words)."""
    docs = docs.select("doc_id", "text")
    described = stored(
        docs.mapInArrow(_describe, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, set_id binary, text_id binary, bands array<long>"),
        "described",
    )
    own = described.where("n > 0").groupBy("set_id")
    own = own.agg(F.min(F.struct("doc_id", "text_id")).alias("one"), F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = stored(own.withColumn("node", F.monotonically_increasing_id()), "nodes")

    labels = stored_alone(docs.sparkSession, lambda: _node_labels(docs, nodes), "labels")
    labelled = nodes.join(labels, "node", "left").select("set_id", "doc", F.coalesce("label", "node").alias("label"))
    least = labelled.groupBy("label").agg(F.min("doc").alias("component"))
    by_set = labelled.join(least, "label").select("set_id", "component", "label")
    out = described.join(by_set, "set_id", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "text_id", "label").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    return groups(docs).drop("text_id", "label")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies: its smallest id, nulls last, and of texts that share it the one
    with the smallest digest. Rows that repeat both id and text become one; documents without words stay. Columns
    as given."""
    found = groups(docs).where("n_shingles > 0")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")).alias("one")
    keep = found.groupBy("label").agg(one).select(F.col("one.doc_id").alias("__id"), F.col("one.text_id").alias("__digest"))
    text_id = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    some = docs.where(~wordless).withColumn("__text_id", text_id)
    same = some["doc_id"].eqNullSafe(keep["__id"]) & (some["__text_id"] == keep["__digest"])
    some = some.join(keep, same, "left_semi").dropDuplicates(["doc_id", "__text_id"]).drop("__text_id")
    return docs.where(wordless).unionByName(some)
