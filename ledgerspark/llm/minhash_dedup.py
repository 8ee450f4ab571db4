"""Near-duplicates by exact Jaccard similarity, found over lists of MinHash coordinates.

Texts with one set of shingles are one point. A point is posted under each of its COORDINATES pairs of
coordinate and value. Points of the least similarity collide in MATCHES pairs or more (see there for the
chance that they do not), so they meet in a list of their rarest pairs already: of a point's pairs, rarest
first, the last MATCHES - 1 post nothing, and lists of one point nobody. What meets in a list has its
collisions counted over all coordinates, a few at a time, and is passed over once the rest cannot bring it to
MATCHES. What reaches MATCHES is confirmed on the whole sets of shingles.

In each list the point that meets most others is compared with all of them first, so a large group of near
copies costs about a comparison a copy. What this leaves in different components of a list is compared pair
by pair where the list has FEW points, and in blocks where it has more: by collisions first, which makes
clusters, and within each cluster by the sets, which go to a block once and not with every pair. Blocks
give back links that span what they found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.simhash_dedup import components, first_of_groups, folded_words, simhash
from ledgerspark.session import stored

#: Words per shingle, and the least similarity of linked texts in hundredths.
SHINGLE, PERCENT = 4, 80
#: MinHash coordinates, and the collisions that a candidate has: at a similarity of exactly 0.8 fewer come with probability 1 in a million.
COORDINATES, MATCHES = 64, 35
#: Points of a list whose pairs are rows.
FEW = 16
#: Shingles hashed at a time, which bounds the memory of a long text; points on each side of a block; coordinates counted before
#: pairs are passed over; shingles of a block counted at a time.
PART, BLOCK, STRIDE, STRIP = 1 << 13, 512, 16, 1 << 12
_RNG = np.random.default_rng(13)
_FACTOR, _SHIFT = (_RNG.integers(0, 2**64, (COORDINATES, 1), np.uint64, endpoint=False) | np.uint64(1) for _ in range(2))


def shingle_hashes(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle, one without words has none."""
    found = folded_words(text)
    if not found:
        return np.zeros(0, np.uint64)
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(found[i : i + words])) for i in range(n)), np.uint64, n))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least mixed hash for each coordinate."""
    least = np.full(COORDINATES, ~np.uint64(0))
    for at in range(0, len(hashes), PART):
        part = hashes[at : at + PART] * _FACTOR
        part ^= part >> np.uint64(32)
        part *= _SHIFT
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def described(docs: DataFrame, key: str, text: str, words: int = SHINGLE, with_sim: bool = False) -> DataFrame:
    """key, digest (64-bit hash of the text), row (of key and text), fp (128-bit hash of the set of shingles, null for an
    empty one), n (its size), sig (MinHash values) and, if asked for, sim (SimHash fingerprint, moved into the range of a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, n, sig, sim = [], [], [], []
            for t in batch.column(3):
                hashes = shingle_hashes(t.as_py(), words)
                sim.append(simhash(t.as_py(), words) - (1 << 63) if with_sim else None)
                n.append(len(hashes))
                fp.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                sig.append(signature(hashes) if len(hashes) else None)
            made = [pa.array(fp, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.list_(pa.int32())), pa.array(sim, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], [key, "digest", "row", "fp", "n", "sig", "sim"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, F.xxhash64(text).alias("digest"), _row(key, text), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, digest bigint, row bigint, fp binary, n bigint, sig array<int>, sim bigint")


def _row(key: str, text: str) -> Column:
    return F.xxhash64(key, text).alias("row")


def _sized(a: str, b: str) -> Column:
    """Sets of these sizes can be alike."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def posting_lists(points: DataFrame) -> DataFrame:
    """``points`` (fp, n, sig) -> fp, n, token and met, the points of the token: the prefixes' lists with two points or more."""
    tokens = F.transform("sig", lambda value, i: F.shiftleft(i.cast("bigint"), 32) + value)
    posted = points.select("fp", "n", F.explode(tokens).alias("token"))
    met = posted.groupBy("token").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    own = posted.join(met, "token").groupBy("fp", "n").agg(F.sort_array(F.collect_list(F.struct("met", "token"))).alias("own"))
    # a point with fewer shared pairs than MATCHES has no partner; else its unshared ones are the rarest of its prefix
    prefix = F.slice("own", F.lit(1), F.size("own") - MATCHES + 1)
    return own.filter(F.size("own") >= MATCHES).select("fp", "n", F.explode(prefix).alias("p")).select("fp", "n", "p.token", "p.met")


def colliding(sig: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (at, to) of signatures that collide in MATCHES coordinates or more."""
    count = np.zeros(len(at), np.int16)
    for c in range(0, COORDINATES, STRIDE):
        count += (sig[at, c : c + STRIDE] == sig[to, c : c + STRIDE]).sum(axis=1, dtype=np.int16)
        kept = count + (COORDINATES - c - STRIDE) >= MATCHES
        at, to, count = at[kept], to[kept], count[kept]
    return at, to


def in_common(sets: list[np.ndarray], at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Size of the intersection for each of the pairs (at, to) of sorted sets: pair by pair, or for many pairs
    as a product of the members' rows over the shingles that several of them have."""
    if len(at) <= 8 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(at.tolist(), to.tolist())], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = n[which] > 1
    owner, which = owner[kept], (np.cumsum(n > 1) - 1)[which[kept]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    both = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2 ** 24 are exact
    for low in range(0, int(which[-1]) + 1 if len(which) else 0, STRIP):
        a, b = np.searchsorted(which, [low, low + STRIP])
        part = np.zeros((len(sets), STRIP), np.float32)
        part[owner[a:b], which[a:b] - low] = 1
        both += part @ part.T
    return both[at, to].astype(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``wanted`` (fp, row) -> fp and hashes, its set of shingles; one text of each point is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds what many long texts take at once
                part = batch.slice(at, 256)
                found = [shingle_hashes(t.as_py(), words).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], ["fp", "hashes"])

    named = docs.select(_row(key, text), F.col(text).alias("_text")).join(wanted, "row").select("fp", "_text")
    # repeated rows come more than once
    return named.mapInArrow(run, "fp binary, hashes array<bigint>").groupBy("fp").agg(F.any_value("hashes").alias("hashes"))


def _agreeing(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of fitting sizes that collide in MATCHES coordinates or more."""
    left = points.select(F.col("fp").alias("a"), F.col("n").alias("_n"), F.col("sig").alias("_s"))
    right = points.select(F.col("fp").alias("b"), F.col("n").alias("_m"), F.col("sig").alias("_t"))
    same = F.size(F.filter(F.zip_with("_s", "_t", lambda s, t: s == t), lambda x: x))
    return pairs.join(left, "a").join(right, "b").filter(_sized("_n", "_m")).filter(same >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose sets are alike, as hi, lo."""
    left = sets.select(F.col("fp").alias("a"), F.col("hashes").alias("_s"))
    right = sets.select(F.col("fp").alias("b"), F.col("hashes").alias("_t"))
    met = pairs.join(left, "a").join(right, "b").withColumn("_both", F.size(F.array_intersect("_s", "_t")))
    alike = 100 * F.col("_both") >= PERCENT * (F.size("_s") + F.size("_t") - F.col("_both"))
    return met.filter(alike).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))


def _blocks(rows: DataFrame, group: str, size: int) -> DataFrame:
    """``rows`` (group, fp, root, ...) of groups with several components, once for each block they take part in, with side.

    The largest component of a group needs no comparing within itself: its parts each meet the parts of the
    others, and those meet each other. ``kind`` is 0 for blocks with the largest, 1 for the others.
    """
    roots = rows.groupBy(group, "root").agg(F.count(F.lit(1)).alias("c"))
    shape = roots.groupBy(group).agg(F.max(F.struct("c", "root")).alias("_big"), F.sum("c").alias("_all"), F.count(F.lit(1)).alias("_roots"))
    parts = lambda n: F.ceil(n / size).cast("int")
    shape = shape.filter("_roots > 1").select(group, F.col("_big.root").alias("_big"), parts(F.col("_big.c")).alias("_p"), parts(F.col("_all") - F.col("_big.c")).alias("_q"))
    big = F.col("root") == F.col("_big")
    met = rows.join(shape, group).withColumn("_part", F.pmod(F.xxhash64("fp"), F.when(big, F.col("_p")).otherwise(F.col("_q"))).cast("int"))

    def places(many: str, kind: int, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(many) - 1), lambda t: F.struct(F.lit(kind).alias("kind"), *make(t)))

    part = F.col("_part")
    home = places("_q", 0, lambda t: (part.alias("i"), t.alias("j"), F.lit(0).alias("side")))
    visit = places("_p", 0, lambda t: (t.alias("i"), part.alias("j"), F.lit(1).alias("side")))
    other = places("_q", 1, lambda t: (F.least(part, t).alias("i"), F.greatest(part, t).alias("j"), (part > t).cast("int").alias("side")))
    each = met.withColumn("_at", F.explode(F.when(big, home).otherwise(F.concat(visit, other))))
    return each.select(group, "_at.kind", "_at.i", "_at.j", "_at.side", *[c for c in rows.columns if c != group])


def _spanning(blocks: DataFrame, group: str, exact: bool) -> DataFrame:
    """hi, lo: links that span the alike points of each block, by collisions or by the sets. Only points of different
    components are compared; by the sets, those that the block has linked already are left out."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fp, root, side = rows["fp"].tolist(), rows["root"].tolist(), rows["side"].to_numpy()
        n, sig = rows["n"].to_numpy(np.int64), np.stack(rows["sig"].to_numpy())
        kind, i, j = (rows[c].iat[0] for c in ("kind", "i", "j"))
        within = kind == 1 and i == j
        number = {r: k for k, r in enumerate(dict.fromkeys(root))}
        of = np.array([number[r] for r in root])
        sets = [np.asarray(h, np.int64) for h in rows["hashes"]] if exact else []
        parent = list(range(len(number) if exact else len(fp)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        hi, lo = [], []
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        step = 64  # rows of pairs at a time
        for start in range(0, len(left), step):
            own = left[start : start + step]
            others = left[start:] if within else right
            fits = 100 * np.minimum.outer(n[own], n[others]) >= PERCENT * np.maximum.outer(n[own], n[others])
            fits &= of[own][:, None] != of[others][None, :]
            a, b = np.nonzero(fits)
            at, to = colliding(sig, own[a], others[b])
            if exact and len(at):
                apart = np.array([top(x) != top(y) for x, y in zip(of[at].tolist(), of[to].tolist())])
                at, to = at[apart], to[apart]
                members, place = np.unique(np.concatenate([at, to]), return_inverse=True)
                both = in_common([sets[m] for m in members], place[: len(at)], place[len(at) :])
                alike = 100 * both >= PERCENT * (n[at] + n[to] - both)
                at, to = at[alike], to[alike]
            for x, y in zip(at.tolist(), to.tolist()):
                p, q = (top(int(of[x])), top(int(of[y]))) if exact else (top(x), top(y))
                if p != q:
                    parent[p] = q
                    hi.append(max(fp[x], fp[y]))
                    lo.append(min(fp[x], fp[y]))
        return pd.DataFrame({"hi": pd.Series(hi, dtype=object), "lo": pd.Series(lo, dtype=object)})

    # rows that were joined by the group alone would stay in one task with all its blocks, so blocks are dealt out first
    block = [group, "kind", "i", "j"]
    return blocks.repartition(*block).groupBy(*block).applyInPandas(run, "hi binary, lo binary").distinct()


def links(
    points: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE,
    proposed: DataFrame | None = None, block: int = BLOCK,
) -> DataFrame:
    """``points`` (fp, row, n, sig) -> stars (hi, lo) of the components of alike sets. Pairs ``proposed`` (a, b) by
    other means are confirmed on the sets, whatever their collisions."""
    lists = stored(posting_lists(points), "lists")
    wanted = lists.select("fp")
    if proposed is not None:
        wanted = wanted.unionAll(proposed.select("a")).unionAll(proposed.select("b"))
    members = stored(wanted.distinct().join(points.select("fp", "row", "n", "sig"), "fp"), "members")
    sets = stored(_sets(docs, members.select("fp", "row"), key, text, words), "sets")
    fame = lists.groupBy("fp").agg(F.sum("met").alias("fame"))
    hubs = lists.join(fame, "fp").groupBy("token").agg(F.max(F.struct("fame", "fp")).alias("hub"))
    first = lists.join(hubs, "token").filter("hub.fp <> fp").select(F.col("hub.fp").alias("a"), F.col("fp").alias("b"))
    first = _agreeing(first.distinct(), members)
    first = first if proposed is None else first.unionByName(proposed).distinct()
    stars = components(_confirmed(stored(first, "pairs"), sets).distinct())
    root = stars.select(F.col("hi").alias("fp"), F.col("lo").alias("root"))
    rooted = stored(members.join(root, "fp", "left").select("fp", "n", "sig", F.coalesce("root", "fp").alias("root")), "rooted")
    rows = stored(lists.select("token", "met", "fp").join(rooted.select("fp", "root"), "fp"), "rows")
    other = rows.select("token", F.col("fp").alias("b"), F.col("root").alias("_r"))
    pairs = rows.filter(F.col("met") <= FEW).withColumnRenamed("fp", "a").join(other, "token").filter(F.col("root") < F.col("_r"))
    stars = components(stars.unionByName(_confirmed(stored(_agreeing(pairs.select("a", "b").distinct(), members), "pairs"), sets)).distinct())
    apart = stored(_blocks(rows.filter(F.col("met") > FEW).drop("met"), "token", block), "blocks")
    clusters = components(_spanning(apart.join(rooted, ["fp", "root"]), "token", False))
    if clusters.isEmpty():
        return stars
    head = clusters.select(F.col("hi").alias("fp"), F.col("lo").alias("head"))
    head = head.unionByName(head.select(F.col("head").alias("fp"), "head").distinct())
    apart = _blocks(head.join(rooted.select("fp", "root"), "fp"), "head", block)
    found = _spanning(apart.join(rooted, ["fp", "root"]).join(sets, "fp"), "head", True)
    return components(stars.unionByName(found).distinct())


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, propose: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One row per row of ``docs``: key, digest (64-bit hash of the text), n_shingles, group (null for an empty set) and
    component_id, the smallest key among the documents reachable over links of a Jaccard similarity of 0.8 or more.

    The whole text counts. A text with fewer words than a shingle is one shingle. One without words, empty or
    null, is linked with nothing and is its own component. Null keys have a component but name none: one
    without any key has a null id. Repeated keys and rows stay; an empty table gives no rows. Only
    ``key`` and ``text`` are read, so other columns may have any name. ``propose`` may name further pairs (a, b) of
    points (fp, sim) to be confirmed.
    """
    each = stored(described(docs, key, text, words, propose is not None), "shingles")
    same = [F.any_value(c).alias(c) for c in ("n", "sig", "sim")]
    points = each.filter("fp IS NOT NULL").groupBy("fp").agg(F.min(key).alias("_least"), F.min("row").alias("row"), *same)
    points = stored(points, "points")
    proposed = stored(propose(points.select("fp", "sim")), "proposed") if propose else None
    stars = links(points, docs, key, text, words, proposed)
    rooted = points.select("fp", "_least").join(stars, points["fp"] == stars["hi"], "left").select("fp", "_least", F.coalesce("lo", "fp").alias("group"))
    least = rooted.groupBy("group").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "group").select(F.col("fp").alias("_fp"), "group", "component_id")
    met = each.join(named, F.col("fp") == F.col("_fp"), "left")
    component = F.when(F.col("fp").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id")
    return met.select(key, "digest", F.col("n").alias("n_shingles"), "group", component)


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, propose: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``docs``, all columns, with one row of each group: the smallest key's, null keys last. Texts without words are one group."""
    near = near_duplicates(docs, key, text, words, propose)
    return first_of_groups(docs, near.withColumn("group", F.coalesce("group", F.lit(b""))), key, text)
