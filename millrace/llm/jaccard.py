"""Exact n-gram Jaccard join in the metric space of shingle sets.

Distance is one minus Jaccard similarity, a metric; documents link within ``1 - 80 / 100``. Equal
sets are one class. ``jaccard_join`` keeps what connects: every link between different texts ends
up in one component, but it does not list links inside a component. ``jaccard_links`` verifies and
lists every link between classes, and counts the links of each document.

Regions. Two linked sets share a shingle among the first ``n - ceil(0.8 n) + 1`` of each, in any
one order of all shingles. So each of these shingles opens a region, the sets that may link
replicate into all regions they border on, and no link lies outside of a region. The order puts frequent shingles last
(a bit array of fixed size marks them; what it marks does not matter for the result), so a
passage that many documents share opens no region of its own, unless a document is made of
little else.

Pivots. In each region the set with the least hash is the pivot, the same one in all regions of
a group of near copies. Exact distances to pivots link most of a group in one step. Only regions
that then still hold several components join again: in order of size, where the triangle
inequality over the distance to the empty prefix leaves a window of sizes from 0.8 to 1.25, and
over counts of hashed shingles (whose L1 distance never exceeds the symmetric difference) a ball
for each set. What is left is compared exactly, shingle by shingle.

A null text, and one without words, has no set and links with nothing. Copies cost one row for
each task that reads one. Sets are told apart by a 64-bit digest and their size, shingles by
64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from millrace.llm.common import Bitmap, arrow_map, extended, mix, shingles, signed, stored
from millrace.llm.components import components

SIZE = 5
# Linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
FREQUENT = 64
# Shingles for each cell of the two sketches of a set: one to look at many pairs, one at few.
COARSE = 8
FINE = 1
LEAST_CELLS = 256
MOST_CELLS = 1 << 14
NEAREST = 3
MOST_SEEN = 500_000
FREQUENT_BITS = 24
WANTED_BITS = 24
BLOCK_ROWS = 4096
OUT_ROWS = 1 << 17
CHUNK_ROWS = 30_000
CHUNK_BYTES = 1 << 25
SLICE_ROWS = 4096


def prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def digest(found: np.ndarray) -> int:
    """Of a sorted set; the order of the sum does not matter, its bits are mixed before."""
    return int(np.sum(mix(found ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).astype(np.int64))


def cells_for(n: int, each: int) -> int:
    """About ``each`` shingles a cell, a power of two, so that sketches of two sizes compare."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << max(0, (n - 1) // each).bit_length()))


def sketch(found: np.ndarray, each: int) -> bytes:
    """How many shingles fall in each cell; empty when a count does not fit a byte."""
    cells = cells_for(len(found), each)
    counts = np.bincount((found >> np.uint64(20)).astype(np.int64) & (cells - 1), minlength=cells)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def folded(counts: np.ndarray, cells: int) -> np.ndarray:
    """Counts in fewer cells."""
    return counts.reshape(*counts.shape[:-1], -1, cells).sum(axis=-2, dtype=np.int16)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """L1 distance of counts: at most the size of the symmetric difference of the sets."""
    return np.abs(a.astype(np.int16) - b).sum(axis=-1, dtype=np.int64)


def too_far(gap, sizes):
    """Whether a symmetric difference of ``gap`` or more proves that two sets do not link.

    Linked sets have ``|a ^ b| <= (1 - s) / (1 + s) * (|a| + |b|)`` with ``s = PERCENT / 100``.
    """
    return gap * (100 + PERCENT) > (100 - PERCENT) * sizes


def may_link(a: bytes, b: bytes, na: int, nb: int) -> bool:
    if not a or not b:
        return True
    cells = min(len(a), len(b))
    x, y = (folded(np.frombuffer(v, np.uint8), cells) for v in (a, b))
    return not too_far(apart(x, y), na + nb)


def _describe(frame: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, d, sketch, fine, first) of every document; ``first`` has the shingles counted later."""

    def run(batches):
        for batch in batches:
            sets = [shingles(t, SIZE) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([sketch(s, COARSE) if len(s) else None for s in sets], pa.binary()),
                    pa.array([sketch(s, FINE) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[: counted_length(len(s))].tobytes() for s in sets], pa.binary()),
                ],
                names=[key, "n", "d", "sketch", "fine", "first"],
            )

    source = frame.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))
    kinds = {"n": LongType(), "d": LongType(), "sketch": BinaryType(), "fine": BinaryType(), "first": BinaryType()}
    return arrow_map(source, run, extended(StructType([source.schema[0]]), **kinds))


def counted_length(n: int) -> int:
    """The prefix, and some more that takes the place of frequent shingles in it."""
    return prefix_length(n) + n // 20 + 4


class Seen:
    """Digests that a task has met lately: copies inside a task cost nothing more."""

    def __init__(self) -> None:
        self.digests: set[int] = set()

    def again(self, d: int) -> bool:
        if d in self.digests:
            return True
        if len(self.digests) >= MOST_SEEN:
            self.digests.clear()
        self.digests.add(d)
        return False


def _gathered(parts, names, width: int = OUT_ROWS):
    """Arrays gathered to batches of about ``width`` rows."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= width:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)
            held, rows = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)


def frequent_shingles(described: DataFrame) -> Bitmap:
    """Shingles that begin more than ``FREQUENT`` different sets, counted over all of them."""

    def run(batches):
        def parts():
            seen = Seen()
            for batch in batches:
                for d, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if d is not None and not seen.again(d):
                        yield (np.frombuffer(first, np.int64),)

        yield from _gathered(parts(), ["token"])

    tokens = arrow_map(described.select("d", "first"), run, "token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > FREQUENT)
    return Bitmap.build(often, "token", FREQUENT_BITS)


def region_rows(texts: DataFrame, frequent: Bitmap) -> DataFrame:
    """(token, d, n, rank): every set in each region that it borders on.

    ``rank`` counts the shingles of the set that come before ``token`` in the order of all.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        def parts():
            bits, seen = shared.value, Seen()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    found = shingles(text, SIZE)
                    n = len(found)
                    if not n or seen.again(d := digest(found)):
                        continue
                    often = bits.holds(found)
                    order = np.concatenate((found[~often], found[often])) if often.any() else found
                    tokens = signed(order[: prefix_length(n)])
                    rank = np.arange(len(tokens), dtype=np.int32)
                    yield tokens, np.full(len(tokens), d, np.int64), np.full(len(tokens), n, np.int32), rank

        yield from _gathered(parts(), ["token", "d", "n", "rank"])

    return arrow_map(texts.select("text"), run, "token long, d long, n int, rank int")


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def with_pivots(rows: DataFrame) -> DataFrame:
    """(token, d, n, rank, pivot) of regions with two sets or more; rows sorted by token, then digest."""

    def run(batches):
        token = pivot = last = None
        waiting = None
        for batch in batches:
            t, d, n, r = _columns(batch)
            if not len(t):
                continue
            # Rows of copies are next to each other.
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
            fresh[0] = token is None or t[0] != token or d[0] != last
            t, d, n, r = t[fresh], d[fresh], n[fresh], r[fresh]
            if not len(t):
                continue
            starts = np.ones(len(t), bool)
            starts[1:] = t[1:] != t[:-1]
            starts[0] = token is None or t[0] != token
            first = np.maximum.accumulate(np.where(starts, np.arange(len(t)), -1))
            pivots = np.where(first >= 0, d[first], pivot if pivot is not None else 0)
            ends = np.ones(len(t), bool)
            ends[:-1] = starts[1:]
            keep = ~starts
            head = starts & ~ends
            out = []
            if waiting is not None and not starts[0]:
                out.append(waiting)
                waiting = None
            keep |= head
            out.append((t[keep], d[keep], n[keep], r[keep], pivots[keep]))
            if starts[-1]:
                waiting = (t[-1:], d[-1:], n[-1:], r[-1:], d[-1:])
            elif first[-1] >= 0:
                waiting = None
            token, pivot, last = t[-1], pivots[-1], d[-1]
            whole = [np.concatenate(c) for c in zip(*out)]
            if len(whole[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in whole], names=["token", "d", "n", "rank", "pivot"])

    sorted_rows = rows.repartition(F.col("token")).sortWithinPartitions("token", "d")
    return arrow_map(sorted_rows, run, "token long, d long, n int, rank int, pivot long")


def _gaps(i: np.ndarray, j: np.ndarray, cells: np.ndarray, place: np.ndarray, counts: dict) -> np.ndarray:
    """L1 distances of the sketches of pairs of rows; 0 where one has none."""
    gaps = np.zeros(len(i), np.int64)
    kinds = cells[i] * (2 * MOST_CELLS) + cells[j]
    for kind in np.unique(kinds):
        c, e = divmod(int(kind), 2 * MOST_CELLS)
        if c and e:
            every = np.flatnonzero(kinds == kind)
            for low in range(0, len(every), SLICE_ROWS):
                at = every[low : low + SLICE_ROWS]
                x, y = counts[c][place[i[at]]], counts[e][place[j[at]]]
                gaps[at] = apart(folded(x, min(c, e)), folded(y, min(c, e)))
    return gaps


def _close_rows(g, n, rank, comp, cells, place, counts):
    """(i, j, gap) of rows of one group that no bound rules out. Rows are sorted by group, size.

    Partners are ``step`` rows apart; a row is done when its partner is too large for it. A pair
    is left to the region of its first common shingle: there the shingles that still follow in
    both have to be enough for a link.
    """
    i, step = np.arange(len(g) - 1), 1
    held, rows = [], 0
    while len(i):
        i = i[i + step < len(g)]
        j = i + step
        i = i[(g[i] == g[j]) & (100 * n[i] >= PERCENT * n[j])]
        j = i + step
        enough = (100 + PERCENT) * np.minimum(n[i] - rank[i], n[j] - rank[j]) >= PERCENT * (n[i] + n[j])
        fits = (comp[i] != comp[j]) & enough
        held.append((i[fits], j[fits]))
        rows += len(held[-1][0])
        step += 1
        if rows and (rows >= OUT_ROWS or not len(i)):
            a, b = (np.concatenate(c) for c in zip(*held))
            gap = _gaps(a, b, cells, place, counts)
            near = ~too_far(gap, n[a] + n[b])
            yield a[near], b[near], gap[near]
            held, rows = [], 0


def rest_pairs(rows: DataFrame, nearest: int | None) -> DataFrame:
    """(a, b) of different components that share a region. ``rows`` has grp, n, rank, d, ...

    With ``nearest`` a set only gives so many of a region, of the least distance by counts.
    """
    names = ("grp", "n", "rank", "d", "component")

    def run(batches):
        held, held_rows, held_bytes = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held_bytes += batch.column("sketch").nbytes
            part = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
            part.append(batch.column("sketch").to_pylist())
            # Rows up to the last change of group are whole groups.
            cuts = np.flatnonzero(np.diff(part[0])) + 1
            start = 0
            if held and held[-1][0][-1] != part[0][0]:
                cuts = np.concatenate(([0], cuts))
            if len(cuts) and (held_rows + int(cuts[-1]) >= CHUNK_ROWS or held_bytes >= CHUNK_BYTES):
                start = int(cuts[-1])
                held.append([c[:start] for c in part])
                yield from pairs(held)
                held, held_rows, held_bytes = [], 0, 0
            held.append([c[start:] for c in part])
            held_rows += batch.num_rows - start
        if held:
            yield from pairs(held)

    def pairs(held):
        g, n, rank, d, comp = (np.concatenate([h[k] for h in held]) for k in range(5))
        sketches = [v for h in held for v in h[5]]
        order = np.lexsort((d, n, g))
        g, n, rank, d, comp = (c[order] for c in (g, n, rank, d, comp))
        sketches = [sketches[k] for k in order]
        cells = np.array([len(v) for v in sketches], np.int64)
        place, counts = np.zeros(len(g), np.int64), {}
        for c in np.unique(cells):
            at = np.flatnonzero(cells == c)
            place[at] = np.arange(len(at))
            joined = b"".join([sketches[k] for k in at])
            counts[int(c)] = np.frombuffer(joined, np.uint8).reshape(len(at), int(c))
        for i, j, gap in _close_rows(g, n, rank, comp, cells, place, counts):
            if nearest is not None and len(i):
                order = np.lexsort((gap, j))
                i, j = i[order], j[order]
                first = np.maximum.accumulate(np.where(np.diff(j, prepend=-1) != 0, np.arange(len(j)), 0))
                keep = np.arange(len(j)) - first < nearest
                i, j = i[keep], j[keep]
            both = np.unique(np.stack([np.minimum(d[i], d[j]), np.maximum(d[i], d[j])], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return arrow_map(rows.repartition(F.col("grp")).sortWithinPartitions("grp"), run, "a long, b long")


def verify(texts: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of distinct pairs (a, b) of digests those whose sets link. Only sets in a pair are moved.

    The texts to read again are those of the classes' first rows, told by a bit array of fixed
    size; what it lets through besides is dropped by the join.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct()
    wanted = stored(classes.select("d", "h", "n").join(ends, "d"), "jaccard-wanted")
    shared = texts.sparkSession.sparkContext.broadcast(Bitmap.build(wanted, "h", WANTED_BITS))

    def pick(batches):
        for batch in batches:
            hit = shared.value.holds(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))
            part = batch.filter(pa.array(hit))
            sets = [shingles(t, SIZE) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("h"),
                    pa.array([digest(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["h", "d", "shingles"],
            )

    sets = arrow_map(texts.select("h", "text"), pick, "h long, d long, shingles binary")
    sets = sets.join(wanted.select("h", "d"), ["h", "d"], "left_semi").dropDuplicates(["d"])
    sets = stored(sets.select("d", "shingles"), "jaccard-sets")
    # The smaller set of a pair travels to the larger one.
    size = wanted.select("d", "n")
    sized = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
    turned = sized.select(
        F.when(F.col("na") <= F.col("nb"), F.col("a")).otherwise(F.col("b")).alias("small"),
        F.when(F.col("na") <= F.col("nb"), F.col("b")).otherwise(F.col("a")).alias("large"),
    )
    both = turned.join(sets.toDF("small", "x"), "small").join(sets.toDF("large", "y"), "large")

    def compare(batches):
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            keep = [linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    named = both.select(F.least("small", "large").alias("a"), F.greatest("small", "large").alias("b"), "x", "y")
    return arrow_map(named, compare, "a long, b long")


def _near(pairs: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """Pairs that sizes and the counts of a sketch do not rule out."""
    one = classes.select("d", "n", column)
    both = pairs.join(one.toDF("a", "na", "sa"), "a").join(one.toDF("b", "nb", "sb"), "b")
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("sa", "sb", "na", "nb"))
            keep = [may_link(*row) for row in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(both.filter(fits).select("a", "b", "na", "nb", "sa", "sb"), run, "a long, b long")


def _open_rows(regions: DataFrame, classes: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows of the regions that still hold several components, in groups of bounded size.

    A region of more than ``BLOCK_ROWS`` rows comes as pairs of its blocks. Without ``known`` each
    set is a component of its own, so no pair of a region is left out.
    """
    if known is None:
        named = regions.select("token", "d", "n", "rank", F.col("d").alias("component"))
    else:
        named = regions.join(known.withColumnRenamed("node", "d"), "d", "left").select(
            "token", "d", "n", "rank", F.coalesce("component", "d").alias("component")
        )
    several = named.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows")
    ).filter(F.col("low") != F.col("high"))
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS)
    left = named.join(several.select("token", blocks.alias("blocks")), "token")
    own = F.pmod(F.xxhash64("d"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    spread = left.withColumn("block", own).select("*", other)
    grouped = spread.select(
        F.xxhash64("token", F.least("block", "other"), F.greatest("block", "other")).alias("grp"),
        "n",
        "rank",
        "d",
        "component",
    )
    return grouped.join(classes.select("d", "sketch"), "d")


def link_classes(texts: DataFrame, described: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) over digests, for the sets that link with another."""
    regions = stored(with_pivots(region_rows(texts, frequent_shingles(described))), "jaccard-regions")
    stars = regions.filter(F.col("d") != F.col("pivot")).select(
        F.least("d", "pivot").alias("a"), F.greatest("d", "pivot").alias("b")
    )
    likely = stored(_near(stars.distinct(), classes, "sketch"), "jaccard-likely")
    tried = stored(_near(likely, classes, "fine"), "jaccard-tried")
    links = stored(verify(texts, classes, tried), "jaccard-links")
    # First the nearest sets, which joins most of what belongs together, then all that is left.
    for nearest in (NEAREST, None):
        known = stored(components(links), "jaccard-known")
        pairs = rest_pairs(_open_rows(regions, classes, known), nearest).distinct()
        likely = stored(pairs.join(tried, ["a", "b"], "left_anti"), "jaccard-likely")
        pairs = stored(_near(likely, classes, "fine"), "jaccard-rest")
        found = stored(verify(texts, classes, pairs), "jaccard-links")
        tried, links = tried.unionByName(pairs), links.unionByName(found)
    return components(links)


def all_links(texts: DataFrame, described: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) over digests, ``a`` below ``b``: every link between two classes, each once."""
    regions = stored(with_pivots(region_rows(texts, frequent_shingles(described))), "jaccard-regions")
    likely = stored(rest_pairs(_open_rows(regions, classes, None), None).distinct(), "jaccard-likely")
    near = stored(_near(likely, classes, "fine"), "jaccard-tried")
    return verify(texts, classes, near)


def _classes(frame: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The described documents, the texts to read again, and a row for each different set."""
    described = stored(_describe(frame, key, text), "jaccard-described")
    texts = frame.select(F.xxhash64(F.col(f"`{key}`")).alias("h"), F.col(f"`{text}`").alias("text"))
    one = F.struct(F.xxhash64(key).alias("h"), "n", "sketch", "fine")
    sets = described.filter(F.col("d").isNotNull()).groupBy("d").agg(
        F.min_by(one, F.xxhash64(key)).alias("one"), F.min(key).alias("least"), F.count("*").alias("copies")
    )
    return described, texts, stored(sets.select("d", "one.*", "least", "copies"), "jaccard-classes")


def jaccard_links(frame: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents with their number of links, and every link between different sets.

    Documents: (key, set, n_shingles, n_links). ``set`` is the digest of the shingles, null without
    a word; ``n_links`` counts the other documents within the distance, copies of the set included.
    Links: (set_a, set_b, key_a, key_b), each once; the keys are the least ones of their sets. The
    links of all documents are those of their sets, and any two documents of one set link.
    """
    described, texts, sets = _classes(frame, key, text)
    links = stored(all_links(texts, described, sets), "jaccard-all-links")
    size = sets.select("d", "copies", "least")
    both = links.select(
        F.explode(F.array(F.struct(F.col("a").alias("d"), F.col("b").alias("other")), F.struct(F.col("b").alias("d"), F.col("a").alias("other")))).alias("e")
    ).select("e.*")
    linked_to = both.join(size.select(F.col("d").alias("other"), "copies"), "other").groupBy("d").agg(F.sum("copies").alias("linked"))
    counted = size.join(linked_to, "d", "left").select("d", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    documents = described.join(counted, "d", "left").select(
        key, F.col("d").alias("set"), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
    named = links.join(size.select(F.col("d").alias("a"), F.col("least").alias("key_a")), "a").join(
        size.select(F.col("d").alias("b"), F.col("least").alias("key_b")), "b"
    )
    return documents, named.select(F.col("a").alias("set_a"), F.col("b").alias("set_b"), "key_a", "key_b")


def jaccard_join(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): the least key reachable by links, itself included.

    Rows with a null key take part in links but give no component its name; repeated keys are
    rows of their own with the same set or not.
    """
    described, texts, sets = _classes(frame, key, text)
    nodes = stored(link_classes(texts, described, sets), "jaccard-components")
    named = sets.join(nodes, sets["d"] == nodes["node"], "left").select(
        "d", F.coalesce("component", "d").alias("component"), "least"
    )
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = named.join(names, "component").select("d", "component_id")
    return described.join(by_set, "d", "left").select(
        key,
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.col(key)).alias("component_id"),
    )
