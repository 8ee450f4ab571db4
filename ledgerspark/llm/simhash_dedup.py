"""SimHash near-duplicates with vantage-point trees.

Fingerprints are grouped first, so copies are one point. A tree over a bounded sample cuts Hamming
space into shards: each node holds a vantage point and a radius, points inside go left, the others
right. Two points within the link distance can only lie on two sides if the inner one is within that
distance of the boundary, so inner points there also visit the outer side as guests. Each shard
builds its own tree the same way down to small leaves, where points are compared. A shard gives
back links that span its groups, never all pairs; the links of all shards are joined to components
by large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.sampling import least_hashed
from ledgerspark.session import stored

#: Words per shingle, hash seed, and bits in which linked fingerprints may differ.
SHINGLE, SEED, NEAR = 4, 42, 4
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Points aimed at per shard, most shards one tree makes, and points sampled for each of its leaves.
SHARD, MOST_SHARDS, SAMPLE = 32768, 4096, 24
#: A shard of more points than this is compared in blocks of as many home points and as many guests.
SPLIT = 4 * SHARD
#: Home points of a leaf within a shard's own tree; vantage points tried for a node, and points they
#: are judged on; pairs compared at a time.
LEAF, TRIED, JUDGED, PAIRS = 256, 6, 1024, 1 << 21


def folded_words(text: str | None) -> list[bytes]:
    """Words of a text between ASCII white space, ASCII letters lowered."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def simhash(text: str | None, words: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text; a null, empty or blank one has fingerprint 0."""
    found = folded_words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    stops = ends[min(words, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), stops.tolist())], np.uint64)
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounds the memory of a long text
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)
        bits += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``digest`` (64-bit hash of the text) and ``fp``, the fingerprint as
    a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([simhash(t.as_py()) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made)], [key, "digest", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.xxhash64(text).alias("digest"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, digest bigint, fp bigint")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _choose(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that cut the points with the least to compare on both sides;
    None where no point lies outside. Judged on a sample of the points."""
    best, seen = None, points if len(points) <= JUDGED else rng.choice(points, JUDGED, replace=False)
    for v in rng.choice(seen, min(TRIED, len(seen)), replace=False):
        inside = np.cumsum(np.bincount(_distance(seen, v), minlength=65))
        for share in (0.35, 0.5, 0.65):
            radius = int(np.searchsorted(inside, len(seen) * share))
            home = int(inside[radius])
            visiting = home - (int(inside[radius - NEAR]) if radius >= NEAR else 0)
            outside = len(seen) - home
            if outside:
                cost = home * home + outside * (outside + visiting)
                if best is None or cost < best[0]:
                    best = (cost, v, radius)
    return best and (best[1], best[2])


def plant(points: np.ndarray, shards: int, seed: int = 7) -> list[tuple[int, int, int]]:
    """A tree with up to ``shards`` leaves over sampled points: (vantage, radius, left child or -1 - shard)
    as flat nodes; the right child follows the left one. A single leaf is an empty list."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    queue = [(points, shards, None)]
    leaves = 0
    while queue:
        here, share, parent = queue.pop(0)
        cut = _choose(here, rng) if share > 1 and len(here) > 1 else None
        if cut is None:
            if parent is not None:
                nodes[parent[0]][2 + parent[1]] = -1 - leaves
            leaves += 1
            continue
        if parent is not None:
            nodes[parent[0]][2 + parent[1]] = len(nodes)
        near = _distance(here, cut[0]) <= cut[1]
        at = len(nodes)
        nodes.append([int(cut[0]), cut[1], 0, 0])
        queue += [(here[near], share // 2, (at, 0)), (here[~near], share - share // 2, (at, 1))]
    return [tuple(n) for n in nodes]


def place(points: np.ndarray, nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, shard, guest) of every visit that the points pay to the tree's shards."""
    if not nodes:
        n = len(points)
        return np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool)
    done: list[tuple] = []
    todo = [(0, np.arange(len(points)), np.zeros(len(points), bool))]
    while todo:
        at, who, guest = todo.pop()
        if at < 0:
            done.append((who, np.full(len(who), -1 - at), guest))
            continue
        vantage, radius, left, right = nodes[at]
        d = _distance(points[who], np.uint64(vantage)).astype(np.int64)
        inner, outer, to_left, to_right = _sides(d, radius, guest)
        todo.append((left, np.concatenate([who[inner], who[to_left]]), np.repeat([False, True], [inner.sum(), to_left.sum()])))
        todo.append((right, np.concatenate([who[outer], who[to_right]]), np.repeat([False, True], [outer.sum(), to_right.sum()])))
    return tuple(np.concatenate(part) for part in zip(*done))


def _sides(d: np.ndarray, radius: int, guest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Masks: at home inside, at home outside, guests inside, guests outside. By the triangle bound
    a point at distance d of the vantage has no link beyond d - NEAR and d + NEAR."""
    inner, outer = ~guest & (d <= radius), ~guest & (d > radius)
    to_left = guest & (d <= radius + NEAR)
    to_right = (guest | inner) & (d > radius - NEAR)
    return inner, outer, to_left, to_right


def link_points(points: np.ndarray, guest: np.ndarray, seed: int = 7) -> np.ndarray:
    """Group number of each point: home points within NEAR of each other or of a guest share one.

    Links between guests are left to the shards where one of them is at home.
    """
    rng = np.random.default_rng(seed)
    parent = list(range(len(points)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    todo = [(np.flatnonzero(~guest), np.flatnonzero(guest))]
    while todo:
        home, visiting = todo.pop()
        if not len(home) or len(home) + len(visiting) < 2:
            continue
        who = np.concatenate([home, visiting])
        cut = _choose(points[home], rng) if len(home) > LEAF else None
        if cut is not None:
            is_guest = np.arange(len(who)) >= len(home)
            sides = _sides(_distance(points[who], cut[0]).astype(np.int64), cut[1], is_guest)
            inner, outer, to_left, to_right = (who[m] for m in sides)
            cost = len(inner) * (len(inner) + len(to_left)) + len(outer) * (len(outer) + len(to_right))
            # within a dense cluster no boundary prunes, and its points are compared as they are
            if cost < 0.95 * len(home) * len(who):
                todo += [(inner, to_left), (outer, to_right)]
                continue
        for members in _leaf_groups(points[who], len(home)):
            first = root(int(who[members[0]]))
            for other in members[1:].tolist():
                parent[root(int(who[other]))] = first
    return np.fromiter((root(i) for i in range(len(points))), np.int64, len(points))


def _leaf_groups(points: np.ndarray, n_home: int) -> list[np.ndarray]:
    """Members of each group of two or more; compares the first ``n_home`` points with all."""
    n = len(points)
    label = np.arange(n)
    step = max(1, PAIRS // n)
    for at in range(0, n_home, step):
        rows = points[at : min(at + step, n_home)]
        near = np.bitwise_count(rows[:, None] ^ points[None, :]) <= NEAR
        for r in np.flatnonzero(near.sum(axis=1) > 1).tolist():
            own = label[at + r]
            for other in np.unique(label[near[r] & (label != own)]).tolist():
                label[label == other] = own
    order = np.argsort(label, kind="stable")
    cuts = np.flatnonzero(np.diff(label[order])) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def _visits(points: DataFrame, nodes: list[tuple]) -> DataFrame:
    """fp, shard and guest for every visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            who, shard, guest = place(fps.view(np.uint64), nodes)
            yield pa.RecordBatch.from_arrays([pa.array(fps[who]), pa.array(shard, pa.int32()), pa.array(guest)], ["fp", "shard", "guest"])

    return points.select("fp").mapInArrow(run, "fp bigint, shard int, guest boolean")


def links(points: DataFrame, shard_points: int = SHARD, split: int = SPLIT, most_shards: int = MOST_SHARDS) -> DataFrame:
    """``points`` (fp, distinct) -> hi, lo: links that join all points within NEAR of each other, one for
    each point and block at most.

    The tree that goes to the tasks, and its sample, are bounded by ``most_shards``; with more points than
    that many shards hold, shards grow and are compared in more blocks.
    """
    n = points.count()
    shards = max(1, min(most_shards, -(-n // shard_points)))
    # bounded by SAMPLE * most_shards numbers, which make the tree on the driver
    hashed = points.select("fp", F.xxhash64("fp").alias("_order"))
    sampled = least_hashed(hashed, "_order", n, SAMPLE * shards, "fp").collect()
    nodes = plant(np.array([r.fp for r in sampled], np.int64).view(np.uint64), shards)
    visits = _visits(points, nodes)
    found = visits.groupBy("shard").agg(F.count_if(~F.col("guest")).alias("home"), F.count_if("guest").alias("visiting"))
    large = found.filter(F.col("home") + F.col("visiting") > split).collect()  # one row per shard at most

    def parts(column: str) -> Column:
        if not large:
            return F.lit(0)
        sizes = F.create_map(*[F.lit(x) for r in large for x in (r.shard, -(-r[column] // split))])
        return F.coalesce(F.try_element_at(sizes, F.col("shard")), F.lit(0))

    # in a large shard, block (0, i, j) compares home parts i and j, and block (1, i, j) home part i with guest part j;
    # another shard is one block
    own = F.pmod(F.xxhash64("fp"), F.greatest(F.when(F.col("guest"), F.col("_g")).otherwise(F.col("_h")), F.lit(1))).cast("int")
    each = visits.withColumns({"_h": parts("home"), "_g": parts("visiting")}).withColumn("_own", own)
    upto = lambda column: F.when(F.col(column) > 0, F.sequence(F.lit(0), F.col(column) - 1)).otherwise(F.array().cast("array<int>"))

    def block(kind: int, i: Column, j: Column, guest: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), guest.alias("guest"))

    me = F.col("_own")
    at_home = F.concat(
        F.transform(upto("_h"), lambda t: block(0, F.least(me, t), F.greatest(me, t), me > t)),
        F.transform(upto("_g"), lambda t: block(1, me, t, F.lit(False))),
    )
    as_guest = F.transform(upto("_h"), lambda t: block(1, t, me, F.lit(True)))
    whole = F.array(block(0, F.lit(0), F.lit(0), F.col("guest")))
    places = F.when(F.col("_h") + F.col("_g") == 0, whole).when(F.col("guest"), as_guest).otherwise(at_home)
    blocks = each.select("fp", "shard", F.explode(places).alias("_b")).select("fp", "shard", "_b.*")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy()
        group = link_points(fps.view(np.uint64), rows["guest"].to_numpy(bool))
        least = pd.Series(fps).groupby(group).transform("min").to_numpy()
        moved = fps != least
        return pd.DataFrame({"hi": fps[moved], "lo": least[moved]})

    return blocks.groupBy("shard", "kind", "i", "j").applyInPandas(run, "hi bigint, lo bigint").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (hi > lo) is either hi in one edge only, or lo in its edges."""
    nodes = edges.select(F.col("hi").alias("x"), F.lit(1).alias("end")).unionAll(edges.select("lo", F.lit(0)))
    # as lo a node has an end of 0, which is its least
    found = nodes.groupBy("x").agg(F.sum("end").alias("ends"), F.min("end").alias("least"))
    return not found.agg(F.count_if(F.col("ends") > F.col("least"))).first()[0]


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """``edges`` (hi > lo) -> the same components as stars: every node but the least as hi, with that one as lo.

    Large-star and small-star rounds, each written to the shared folder; a hub's neighbours are
    aggregated and joined, never collected. The rounds end when the edges are stars, so edges that are stars take none.
    """
    now = stored(edges, label)
    while not _are_stars(now):
        # a node's neighbours above it move to the least of itself and its neighbours, which is among its own los
        least = now.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        large = now.join(least, "lo", "left").select("hi", F.coalesce("m", "lo").alias("lo")).distinct()
        # then a node and its neighbours below it move to the least of those
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = F.explode(F.array(F.col("hi"), F.col("lo"))).alias("hi")
        now = stored(large.join(lowest, "hi").select(moved, F.col("m").alias("lo")).filter("hi <> lo").distinct(), label)
    return now


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, digest, fp, fingerprint (16 lowercase hex digits), group (the least
    fp of the component) and component_id, the smallest key among the documents reachable over links
    of at most NEAR differing bits.

    The whole text counts. Null, empty and blank texts have fingerprint 0, which links like any
    other. Null keys have a fingerprint and a component, but name none: a component without any
    key has a null id. Repeated keys and rows stay; an empty table gives no rows. Only ``key`` and
    ``text`` are read, so other columns may have any name.
    """
    each = stored(fingerprints(docs, key, text), "fingerprints")
    points = stored(each.groupBy("fp").agg(F.min(key).alias("_least")), "points")
    stars = components(links(points))
    rooted = points.join(stars, points["fp"] == stars["hi"], "left").select("fp", "_least", F.coalesce("lo", "fp").alias("_root"))
    heads = stars.select(F.col("lo").alias("_head")).distinct()
    # only members of linked groups need their group's least key
    group = (
        rooted.join(heads, F.col("_root") == F.col("_head"), "left_semi").groupBy(F.col("_root").alias("_head")).agg(F.min("_least").alias("_of"))
    )
    named = rooted.join(group, F.col("_root") == F.col("_head"), "left").select(
        F.col("fp").alias("_fp"), F.col("_root").alias("group"), F.when(F.col("_head").isNull(), F.col("_least")).otherwise(F.col("_of")).alias("component_id")
    )
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return each.join(named, F.col("fp") == F.col("_fp")).select(key, "digest", "fp", shown, "group", "component_id")


def proposed_pairs(points: DataFrame) -> DataFrame:
    """``points`` (fp, of any type; sim, a fingerprint) -> a, b: in each component of fingerprints the least point with
    each of the others. For a rule that is stricter than NEAR bits these are pairs to be confirmed."""
    stars = components(links(stored(points.select(F.col("sim").alias("fp")).distinct(), "points")))
    root = stars.select(F.col("hi").alias("sim"), F.col("lo").alias("root"))
    grouped = points.join(root, "sim", "left").select("fp", F.coalesce("root", "sim").alias("root"))
    hubs = grouped.groupBy("root").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return grouped.join(hubs, "root").filter("a <> fp").select("a", F.col("fp").alias("b"))


def first_of_groups(docs: DataFrame, near: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each group of ``near`` (key, digest, group): the smallest key's, null keys last.

    A representative is named by key and text hash, so rows that share a key but not the text are
    told apart; of rows that share both, the first by a hash of the other columns stays. Only those are sorted: the
    other rows are looked up in the names, as rows hold whole texts.
    """
    named = near.select("group", F.col(key).isNull().alias("none"), F.col(key).alias("id"), "digest")
    counted = named.groupBy("group", "none", "id", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("group").agg(F.min(F.struct("none", "id", "digest", "n")).alias("r"))
    kind = docs.schema[key].dataType
    chosen = stored(
        first.select(
            F.col("r.none").alias("_c0"), F.coalesce("r.id", F.lit(0).cast(kind)).alias("_c1"), F.col("r.digest").alias("_c2"), F.col("r.n").alias("_n")
        ),
        "chosen",
    )
    row = docs.select(
        F.col(key).isNull().alias("_n0"), F.coalesce(F.col(key), F.lit(0).cast(kind)).alias("_n1"), F.xxhash64(text).alias("_n2"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
    )

    def met(names: DataFrame) -> DataFrame:
        return row.join(names.hint("shuffle_hash"), [F.col(f"_n{i}") == F.col(f"_c{i}") for i in range(3)], "left_semi")

    copies = Window.partitionBy("_n0", "_n1", "_n2").orderBy(F.xxhash64("_row"))
    one = met(chosen.filter("_n > 1")).withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1")
    return met(chosen.filter("_n = 1")).select("_row.*").unionAll(one.select("_row.*"))
