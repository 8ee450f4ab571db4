"""Prefix trie of conversations from adaptive radix trees.

A turn has a fixed-width id, 16 bytes of the digest of its role and text, so a conversation is a byte
string and its prefixes are the turn-aligned ones. Conversations of any length are cut into segments of
SEGMENT turns; the id of what comes before a segment is made in rounds over blocks of SEGMENT segments, blocks
of blocks and so on, so no task holds a whole conversation. Segments are ranged by (id before, bytes);
tasks put them, a batch at a time, into an adaptive radix tree, and its turn-aligned depths leave the
task as partial nodes, which are added up by node id. Sums over subtrees double the distance they
cover in each round, over the nodes with two members or more; all others are plain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.sampling import SPLIT_ROWS
from ledgerspark.operators.ordered import RowNumber, with_running
from ledgerspark.session import stored

#: Bytes of an id, turns of a segment, conversations of a run whose ids are joined at a time.
WIDTH, SEGMENT, RUN = 16, 64, 256
ROOT = "0" * (2 * WIDTH)
#: Room of the node layouts.
SMALL, MIDDLE, LARGE, FULL = 4, 16, 48, 256
ART_SCHEMA = "node binary, parent binary, depth bigint, words bigint, conv bigint, n bigint"


class Node:
    """A node of an adaptive radix tree: the bytes of its compressed path, its children in a layout that grows with
    them, and what is said of the keys below: how many, the least conversation, and those that end here.

    Up to MIDDLE children: their bytes in a row. Up to LARGE: 256 bytes that name a child's place. More: 256 places.
    """

    __slots__ = ("path", "room", "keys", "children", "n", "least", "ends", "after")

    def __init__(self, path: bytes):
        self.path, self.room, self.keys, self.children = path, SMALL, bytearray(), []
        self.n, self.least, self.ends, self.after = 0, None, [], None

    def child(self, byte: int) -> Node | None:
        if self.room == FULL:
            return self.children[byte]
        if self.room == LARGE:
            return self.children[self.keys[byte] - 1] if self.keys[byte] else None
        at = self.keys.find(byte)
        return self.children[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        """Set the child at a byte, in the next larger layout when this one is full."""
        if self.room == FULL:
            self.children[byte] = node
            return
        at = self.keys[byte] - 1 if self.room == LARGE else self.keys.find(byte)
        if at >= 0:
            self.children[at] = node
        elif len(self.children) == self.room:
            self._grow()
            self.put(byte, node)
        else:
            self.children.append(node)
            if self.room == LARGE:
                self.keys[byte] = len(self.children)
            else:
                self.keys.append(byte)

    def each(self) -> Iterator[tuple[int, Node]]:
        if self.room == FULL:
            return ((b, c) for b, c in enumerate(self.children) if c is not None)
        if self.room == LARGE:
            return ((b, self.children[at - 1]) for b, at in enumerate(self.keys) if at)
        return iter(sorted(zip(self.keys, self.children), key=lambda x: x[0]))

    def _grow(self) -> None:
        now = list(self.each())
        self.room = {SMALL: MIDDLE, MIDDLE: LARGE, LARGE: FULL}[self.room]
        if self.room == FULL:
            self.keys, self.children = bytearray(), [None] * 256
            for b, c in now:
                self.children[b] = c
        elif self.room == LARGE:
            self.keys, self.children = bytearray(256), [c for _, c in now]
            for at, (b, _) in enumerate(now):
                self.keys[b] = at + 1


def _common(path: bytes, key: bytes, at: int) -> int:
    if key.startswith(path, at):
        return len(path)
    n = 0
    while n < len(path) and at + n < len(key) and path[n] == key[at + n]:
        n += 1
    return n


def insert(root: Node, key: bytes, conv: int, last: bool, after: bytes | None = None) -> None:
    """Add a segment of a conversation; ``last`` where the conversation ends with it."""
    above, edge, node, at = None, 0, root, 0
    while True:
        same = _common(node.path, key, at)
        if same < len(node.path):
            upper = Node(node.path[:same])
            upper.n, upper.least = node.n, node.least
            upper.put(node.path[same], node)
            node.path = node.path[same + 1 :]
            if above is None:
                raise ValueError("a root has no path")
            above.put(edge, upper)
            node = upper
        node.n += 1
        node.least = conv if node.least is None else min(node.least, conv)
        at += same
        if at == len(key):
            break
        below = node.child(key[at])
        if below is None:
            below = Node(key[at + 1 :])
            node.put(key[at], below)
        above, edge, node, at = node, key[at], below, at + 1
    node.after = after
    if last:
        node.ends.append(conv)


def aligned(root: Node, size: int = SEGMENT) -> Iterator[tuple[bytes, bytes, bytes, int, bytes, Node, bool]]:
    """Every turn-aligned depth of a tree of keys (id before, turns...): id, parent's id, id before, number and id of its
    last turn, the tree's node, and whether the node's path ends there."""
    todo = [(root, b"", b"", b"")]
    while todo:
        node, start, parent, before = todo.pop()
        full = start + node.path
        # the path to a child holds its edge's byte
        for end in range((max(len(start) - 1, 0) // WIDTH + 1) * WIDTH, len(full) + 1, WIDTH):
            turn = end // WIDTH - 1
            if not turn:
                parent = before = full[:end]
                continue
            ends = end == len(full)
            if turn == size:
                made = node.after
            else:
                made = hashlib.blake2b(parent + full[end - WIDTH : end], digest_size=WIDTH).digest()
            yield made, parent, before, turn, full[end - WIDTH : end], node, ends
            parent = made
        todo += [(c, full + bytes([b]), parent, before) for b, c in node.each()]


def _short(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 2 * WIDTH)


def turn_rows(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """c, nth (from 1), id (hex) and words of every turn of a conversation with an id."""
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = convs.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("c"),
        F.col(turn).alias("turn"),
        _short(F.concat(F.length(r).cast("string"), F.lit(":"), r, t)).alias("id"),
        F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    return with_running(rows, ["c"], ["turn", "id"], chunk_rows=SPLIT_ROWS, nth=RowNumber())


def rebuilt(turns: DataFrame, block: int = 20, kinds: int = 4) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (c, length) and their turns (c, d, id, words).

    At most ``kinds`` - 1 turns of a conversation go to the ``block`` conversations that begin with them.
    """
    sizes = stored(turns.groupBy("c").agg(F.max("nth").alias("own")), "conversations")
    named = sizes.withColumns({"b": F.expr(f"c - c % {block}"), "h": F.crc32(F.col("c").cast("string").cast("binary")) % kinds})
    base = sizes.select(F.col("c").alias("b"), F.col("own").alias("_theirs"))
    named = named.join(base, "b", "left").withColumn("taken", F.least("h", F.coalesce("_theirs", F.lit(0))))
    named = stored(named.select("c", "b", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    first = turns.filter((F.col("nth") < kinds) & (F.col("c") % block == 0)).withColumnRenamed("c", "b")
    taken = named.filter("taken > 0").join(first, "b").filter("nth <= h").select("c", F.col("nth").alias("d"), "id", "words")
    own = turns.join(named.select("c", "h", "taken"), "c").filter("nth > h")
    own = own.select("c", (F.col("nth") - F.col("h") + F.col("taken")).alias("d"), "id", "words")
    return named.select("c", "length"), taken.unionByName(own)


def prefix_ids(blocks: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``blocks`` (c, i, id), the parts of sequences -> c, i, before and after: ids of all that precedes a part, and
    of the same with the part. Equal beginnings have equal ids. Rounds go with the logarithm of the longest sequence."""
    most = blocks.agg(F.max("i")).first()[0]
    group = Window.partitionBy("c", F.expr(f"i DIV {size}")).orderBy("i")  # ``size`` rows at most
    so_far = F.array_join(F.collect_list("id").over(group.rowsBetween(Window.unboundedPreceding, 0)), "")
    rows = blocks.select("c", "i", F.expr(f"i DIV {size}").alias("j"), so_far.alias("ids"))
    width = 2 * WIDTH
    if most is None or most < size:
        rows = rows.withColumns({"up": F.lit(ROOT), "over": _short(F.concat(F.lit(ROOT), "ids"))})
    else:
        upper = rows.groupBy("c", F.col("j").alias("i")).agg(_short(F.max_by("ids", "i")).alias("id"))
        found = prefix_ids(stored(upper, "blocks"), size)
        rows = rows.join(found.select("c", F.col("i").alias("j"), F.col("before").alias("up"), F.col("after").alias("over")), ["c", "j"])
    earlier = F.expr(f"left(ids, length(ids) - {width})")
    return rows.select(
        "c", "i",
        F.when(F.col("i") % size == 0, F.col("up")).otherwise(_short(F.concat("up", earlier))).alias("before"),
        F.when(F.col("i") % size == size - 1, F.col("over")).otherwise(_short(F.concat("up", "ids"))).alias("after"),
    )


def segments(named: DataFrame, turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row per ``size`` turns: c, i, key (bytes of before and the turns), words of each turn, after, last."""
    at = F.expr(f"(d - 1) DIV {size}").alias("i")
    cut = turns.groupBy("c", at).agg(F.sort_array(F.collect_list(F.struct("d", "id", "words"))).alias("t"))
    cut = stored(cut.select("c", "i", F.array_join("t.id", "").alias("ids"), "t.words"), "segments")
    known = prefix_ids(cut.select("c", "i", _short(F.col("ids")).alias("id")), size)
    last = F.expr(f"(length - 1) DIV {size}") == F.col("i")
    return stored(
        cut.join(known, ["c", "i"]).join(named, "c").select(
            "c", "i", F.unhex(F.concat("before", "ids")).alias("key"), "words", F.unhex("after").alias("after"), last.alias("last")
        ),
        "keys",
    )


def _planted(keys: DataFrame, size: int) -> DataFrame:
    """Partial nodes of the radix tree of each batch, and a row without a parent for each end of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            root, known, first = Node(b""), {}, {}
            for c, i, k, w, a, z in zip(*(c.to_pylist() for c in batch.columns)):
                insert(root, k, c, z, a)
                first[k[:WIDTH]] = i * size
                known.update((k[at : at + WIDTH], n) for at, n in zip(range(WIDTH, len(k), WIDTH), w))
            rows = []
            for made, parent, before, turn, turn_id, node, ends in aligned(root, size):
                rows.append((made, parent, first[before] + turn, known[turn_id], node.least, node.n))
                if ends:  # a compressed path's keys end with it
                    rows += [(made, None, None, None, c, None) for c in node.ends]
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["node", "parent", "depth", "words", "conv", "n"])

    return keys.select("c", "i", "key", "words", "after", "last").mapInArrow(run, ART_SCHEMA)


def subtree_sums(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """``nodes`` (node, up, values), ``up`` null at the top -> values summed over each node's subtree.

    After k rounds a node has the sum of what is nearer below than 2 ** k and knows who is as far above,
    so rounds go with the logarithm of the depth. Hot ancestors are pre-aggregated, and joined one row to many.
    """
    now = stored(nodes.select("node", "up", *values), "sums")
    while not now.filter("up IS NOT NULL").isEmpty():
        below = now.filter("up IS NOT NULL").groupBy("up").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        higher = now.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        added = now.join(below.withColumnRenamed("up", "node"), "node", "left")
        added = added.select("node", "up", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])
        now = stored(added.join(higher, "up", "left").select("node", F.col("_up").alias("up"), *values), "sums")
    return now.select("node", *values)


def ends_digests(ends: DataFrame) -> DataFrame:
    """``ends`` (node, conv) -> node, sha (SHA-256 of its conv ids, ascending, with commas) and n.

    Ranges of (node, conv) write runs of ids; a node's runs then pass its one hash in order, never held together.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, int, list[str]]] = []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not found or found[-1][0] != node or len(found[-1][2]) == RUN:
                    found.append((node, conv, []))
                found[-1][2].append(str(conv))
            made = [(n, c, ",".join(t), len(t)) for n, c, t in found]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], ["node", "first", "ids", "n"]) if made else batch.slice(0, 0)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, total, sha = None, 0, hashlib.sha256()
        for batch in batches:
            done = []
            for now, ids, n in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if now != node:
                    if node is not None:
                        done.append((node, sha.hexdigest(), total))
                    node, total, sha = now, 0, hashlib.sha256()
                sha.update(b"," * (total > 0) + ids.encode())
                total += n
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "sha", "n"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([sha.hexdigest()]), pa.array([total], pa.int64())], ["node", "sha", "n"])

    ranged = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    written = ranged.mapInArrow(runs, "node binary, first bigint, ids string, n bigint")
    return written.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node binary, sha string, n bigint")


def trie(
    convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations, all long but the digest: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and n_ends.

    Turns are ordered by number, null first, then by the digest of role and text, so equal turns count as
    often as they come. A null role or text is empty. Rows without a conversation id belong to none; a
    conversation that is left without turns ends at the root; the remainder of a negative id is negative. An empty table has no nodes. Other columns
    may have any name.
    """
    turns = turn_rows(convs, conv, turn, role, text)
    turns = stored(turns.select("c", "nth", "id", "words"), "turns")
    named, all_turns = rebuilt(turns)
    keys = segments(named, all_turns, segment)
    ranged = keys.repartitionByRange("key", "c").sortWithinPartitions("key", "c")
    planted = stored(_planted(ranged, segment), "planted")
    root = F.unhex(F.lit(ROOT))
    met = planted.filter("parent IS NOT NULL").groupBy("node").agg(
        F.any_value("parent").alias("parent"), F.any_value("depth").alias("depth"), F.any_value("words").alias("words"),
        F.min("conv").alias("conv"), F.sum("n").alias("n"),
    )
    top = named.agg(F.min("c").alias("conv"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    none = F.lit(None)
    top = top.select(root.alias("node"), none.cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("words"), "conv", "n")
    nodes = stored(met.select(top.columns).unionByName(top), "nodes")

    below = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    below = below.agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n") == 1).alias("_alone"))
    known = stored(nodes.join(below, "node", "left").fillna(0, ["n_children", "_alone"]), "children")
    # a child with one member is one leaf and saves nothing; only the others are summed
    shared = known.filter("n > 1").select(
        "node", F.when(F.col("depth") > 1, F.col("parent")).alias("up"), "depth",
        (F.col("_alone") + (F.col("n_children") == 0).cast("bigint")).alias("leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved"),
    )
    sums = subtree_sums(shared.filter("depth > 0"), ["leaves", "saved"]).unionByName(
        shared.groupBy().agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).filter("leaves IS NOT NULL").select(root.alias("node"), "leaves", "saved")
    )
    ends = planted.filter("parent IS NULL").select("node", "conv").unionByName(named.filter("length = 0").select(root.alias("node"), F.col("c").alias("conv")))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        known.join(sums, "node", "left")
        .join(ends_digests(ends).withColumnRenamed("n", "n_ends"), "node", "left")
        .join(above, "parent", "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
            F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
            F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"), F.coalesce("n_ends", F.lit(0)).alias("n_ends"),
        )
    )
