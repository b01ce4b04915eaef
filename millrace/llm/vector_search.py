"""Nearest neighbours by inner product: inverted lists, scanned block by block of dimensions.

Vectors get one more component that gives all of them the greatest norm of the table, so the largest
inner product is the least distance. They are turned by a random rotation, dealt out to the lists of
the nearest centres, and stored by column blocks. A query scans the lists nearest to it. After each
block of dimensions a hypothesis test compares the distance so far, scaled up to all dimensions,
with the distance of the worst neighbour known: a candidate that is too far with high confidence is
abandoned. Those left are scored exactly, in double precision, component after component.

Two passes: the nearest lists first, which bounds the distance, then the other probed lists.

Bounded, and fitted on ``SAMPLE`` vectors at most: the centres (``LISTS`` at most) and the share of
lists to probe, the least that finds ``AIM`` of the sample's own neighbours. Every vector is indexed.

Copies of a vector are one entry with its least ids, as many as a result may need: no other of its
ids can ever be in a result. Long lists are cut into chunks, and the queries of a list into blocks.

Awkward rows: a vector that is null, empty, all zeros, or holds a null or a number that is not
finite takes no part, nor does a row without an id, nor one of another length than the commonest
(the longer of two that are as common). Of several vectors of one id the least counts, as arrays are
ordered. With fewer candidates than asked for, all are found. Other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millrace.llm.common import arrow_map, extended, stored

SAMPLE = 32_768
TRIALS = 256
LISTS = 4_096
AIM = 0.98
CHUNK = 4_096
QUERY_BLOCK = 512
COLUMNS = 16
# How sure the test is: an unlucky rotation misleads it with a chance below 2 * exp(-c * EPSILON ** 2).
EPSILON = 2.1
SEED = 20_250_101
FOUND = "query long, vec_id long, score double"


@dataclass(frozen=True)
class Fit:
    """What is learned from the sample; of fixed size, whatever the table holds."""

    norm: float
    rotation: np.ndarray
    centres: np.ndarray
    first: int
    probes: int

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with their further component, rotated."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ self.rotation

    def turned_queries(self, queries: np.ndarray) -> np.ndarray:
        """Queries at the common norm, which does not change what is nearest."""
        scaled = queries * (self.norm / np.sqrt((queries**2).sum(axis=1)))[:, None]
        return np.column_stack([scaled, np.zeros(len(queries))]) @ self.rotation


def usable_vectors(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part; ``vec`` keeps its own number type."""
    vec = F.col(f"`{vector}`")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = frame.select(F.col(f"`{key}`").cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("id").isNotNull() & vec.isNotNull() & good & F.exists(vec, lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vec").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    rows = rows.filter(F.size("vec") == (common["length"] if common else 0))
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def _entries(rows: DataFrame, ids: int) -> DataFrame:
    """(rep, ids, vec): one row for each different vector, with its least ids."""
    nth = F.row_number().over(Window.partitionBy("x", "y").orderBy("id"))
    return (
        rows.withColumn("_nth", nth)
        .filter(F.col("_nth") <= ids)
        .groupBy("x", "y")
        .agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) / 2 - points @ centres.T).argmin(axis=1)


def _order(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argsort((centres**2).sum(axis=1) / 2 - points @ centres.T, axis=1, kind="stable")


def fitted(entries: DataFrame, top: int) -> Fit:
    """Centres by a few rounds of k-means on a sample, and the number of lists that finds enough."""
    facts = entries.select(
        F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("square")
    ).first()
    sample = entries.orderBy(F.xxhash64(F.lit(SEED), "rep"), "rep").limit(SAMPLE).select("vec").toArrow()
    vectors = _matrix(sample.column(0).combine_chunks())
    rng = np.random.default_rng(SEED)
    size = vectors.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
    fit = Fit(math.sqrt(facts["square"]), rotation, np.empty((0, size)), 1, 1)
    points = fit.turned(vectors)
    lists = max(1, min(LISTS, math.isqrt(facts["n"]), len(points)))
    centres = points[:lists].copy()
    for _ in range(8):
        own = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=lists)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    own = _nearest(points, centres)
    # Vectors of the sample as queries, but none that a centre began as: at which probe is each
    # of their true neighbours met?
    queries = vectors[::-1][:TRIALS]
    scores = queries @ vectors.T
    scores[np.arange(len(queries)), len(vectors) - 1 - np.arange(len(queries))] = -math.inf
    best = np.argsort(-scores, axis=1)[:, : min(top, len(vectors) - 1)]
    place = np.argsort(_order(fit.turned_queries(queries), centres), axis=1)
    met = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    probes = int(met[math.ceil(AIM * len(met)) - 1]) + 1 if len(met) else lists
    return Fit(fit.norm, rotation, centres, max(1, probes // 8), probes)


def index_chunks(entries: DataFrame, fit: Fit) -> DataFrame:
    """(list, chunk, reps, ids, vectors, columns): the index, stored by column blocks."""
    model = entries.sparkSession.sparkContext.broadcast(fit)

    def place(batches):
        for batch in batches:
            own = _nearest(model.value.turned(_matrix(batch.column("vec"))), model.value.centres)
            yield batch.append_column("list", pa.array(own.astype(np.int64)))

    rows = entries.select("rep", "ids", "vec")
    listed = stored(arrow_map(rows, place, extended(rows.schema, list=LongType())), "vector-lists")
    sizes = listed.groupBy("list").count().toPandas()  # LISTS rows at most
    parts = np.ones(len(fit.centres), np.int64)
    parts[sizes["list"]] = np.ceil(sizes["count"] / CHUNK).astype(np.int64)
    known = F.lit([int(p) for p in parts])
    chunk = F.pmod(F.xxhash64(F.lit(1), "rep"), F.element_at(known, (F.col("list") + 1).cast("int")))
    grouped = (
        listed.withColumn("chunk", chunk)
        .groupBy("list", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("rep", "ids", "vec"))).alias("rows"))
    )
    flat = grouped.select("list", "chunk", *(F.col(f"rows.{c}").alias(c) for c in ("ids", "vec")))

    def pack(batches):
        for batch in batches:
            packed = []
            for vecs in batch.column("vec"):
                matrix = _matrix(vecs.values)
                packed.append((matrix.tobytes(), np.ascontiguousarray(model.value.turned(matrix).T, np.float32).tobytes()))
            vectors, columns = zip(*packed, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("list"), batch.column("chunk"), batch.column("ids"), pa.array(vectors, pa.binary()), pa.array(columns, pa.binary())],
                names=["list", "chunk", "ids", "vectors", "columns"],
            )

    return stored(
        arrow_map(flat, pack, "list long, chunk long, ids array<array<long>>, vectors binary, columns binary"), "vector-index"
    )


def _far(partial: np.ndarray, seen: int, size: int, limit: np.ndarray) -> np.ndarray:
    """The test: is the distance over ``seen`` of ``size`` turned dimensions too large? Over all it is exact."""
    doubt = EPSILON / math.sqrt(seen) if seen < size else 0.0
    return partial * (size / seen) > limit * (1 + doubt) ** 2


def scan(columns: np.ndarray, queries: np.ndarray, limits: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) of one chunk that are not abandoned.

    ``columns`` has a row for each turned dimension, ``limits`` the square of the distance that
    a neighbour has to keep, infinite where none is known yet.
    """
    size, count = columns.shape
    open_ = np.flatnonzero(np.isinf(limits))
    if len(open_) and count > need:
        # Nothing is known: the first vectors are measured in full.
        head = columns[:, : 4 * need]
        full = (head**2).sum(axis=0) + (queries[open_] ** 2).sum(axis=1)[:, None] - 2 * queries[open_] @ head
        limits = limits.copy()
        limits[open_] = np.partition(full, need - 1, axis=1)[:, need - 1] * (1 + 1e-4) + 1e-6
    limits = limits.astype(np.float32)
    partial = np.zeros((len(queries), count), np.float32)
    alive, seen = None, 0
    while seen < size:
        block = slice(seen, min(seen + COLUMNS, size))
        seen = block.stop
        if alive is None:
            part, mine = columns[block], queries[:, block]
            partial += (part**2).sum(axis=0) + (mine**2).sum(axis=1)[:, None] - 2 * mine @ part
            near = ~_far(partial, seen, size, limits[:, None])
            if near.mean() < 0.25 or seen == size:
                alive = np.nonzero(near)
                partial = partial[alive]
        else:
            q, v = alive
            partial = partial + ((columns[block].T[v] - queries[q, block]) ** 2).sum(axis=1)
            near = ~_far(partial, seen, size, limits[q])
            alive, partial = (q[near], v[near]), partial[near]
    return alive


def _best(ids: list, vectors: np.ndarray, columns: np.ndarray, asked: np.ndarray, turned: np.ndarray, limits: np.ndarray, need: int):
    """(query number, id, score) of the ``need`` nearest ids of a chunk for each query, at most."""
    q, v = scan(columns, turned, limits, need)
    scores = np.zeros(len(q))
    for k in range(vectors.shape[1]):
        scores += vectors[v, k] * asked[q, k]
    counts = np.array([len(x) for x in ids])
    flat = np.concatenate([np.asarray(x, np.int64) for x in ids])
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    times = counts[v]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    q, scores, found = np.repeat(q, times), np.repeat(scores, times), flat[np.repeat(starts[v], times) + within]
    order = np.lexsort((found, -scores, q))
    q, scores, found = q[order], scores[order], found[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return q[nth < need], found[nth < need], scores[nth < need]


def _probed(index: DataFrame, probes: DataFrame, load: DataFrame, fit: Fit, need: int) -> DataFrame:
    """What the probes (rep, list, vec, limit) find: (query, vec_id, score).

    ``load`` has the number of probes of each list.
    """
    model = index.sparkSession.sparkContext.broadcast(fit)
    chunks = index.groupBy("list").agg(F.collect_list("chunk").alias("chunk"))
    block = F.pmod(F.xxhash64(F.lit(2), "rep"), F.ceil(F.col("count") / QUERY_BLOCK))
    blocks = (
        probes.join(F.broadcast(load), "list")  # LISTS rows at most
        .withColumn("block", block)
        .groupBy("list", "block")
        .agg(F.collect_list(F.struct("rep", "vec", "limit")).alias("asked"))
    )
    # A chunk of a long list is a key of its own, so no list lands in one task.
    pairs = blocks.join(chunks, "list").withColumn("chunk", F.explode("chunk")).join(index, ["list", "chunk"])
    chosen = pairs.select(
        F.col("asked.rep").alias("reps"), F.col("asked.vec").alias("vecs"), F.col("asked.limit").alias("limits"),
        "ids", "vectors", "columns",
    )

    def run(batches):
        fitted_ = model.value
        size = fitted_.rotation.shape[0]
        for batch in batches:
            for k in range(batch.num_rows):
                reps = np.asarray(batch.column("reps")[k].values, np.int64)
                asked = _matrix(batch.column("vecs")[k].values)
                scores = np.asarray(batch.column("limits")[k].values.to_numpy(zero_copy_only=False), np.float64)
                vectors = np.frombuffer(batch.column("vectors")[k].as_py()).reshape(-1, size - 1)
                columns = np.frombuffer(batch.column("columns")[k].as_py(), np.float32).reshape(size, -1)
                lengths = np.sqrt((asked**2).sum(axis=1))
                # A score as the square of a distance between points of the common norm, with room for rounding.
                limits = 2 * fitted_.norm**2 - 2 * fitted_.norm * scores / lengths + 1e-4 * fitted_.norm**2
                limits[np.isnan(limits)] = math.inf
                q, found, score = _best(
                    batch.column("ids")[k].as_py(), vectors, columns, asked,
                    fitted_.turned_queries(asked).astype(np.float32), limits, need,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps[q]), pa.array(found), pa.array(score)], names=["query", "vec_id", "score"]
                )

    found = arrow_map(chosen, run, FOUND)
    return found.withColumn("_nth", _nth("query")).filter(F.col("_nth") <= need).drop("_nth")


def _nth(query: str):
    return F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), "vec_id"))


def nearest(
    frame: DataFrame, asked: DataFrame, top: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest of all other vectors for each id asked.

    ``asked`` has the ids of the queries in a column called like the key; they are rows of ``frame``.
    """
    need = top + 1  # the query's own row may be among them
    spark = frame.sparkSession
    digest = [F.xxhash64(F.lit(k), "vec").alias(n) for k, n in ((1, "x"), (2, "y"))]
    rows = stored(usable_vectors(frame, key, vector).select("id", "vec", *digest), "vectors")
    entries = stored(_entries(rows, need), "vector-entries")
    out = "query_id long, rank int, vec_id long, score double"
    if entries.isEmpty():
        return spark.createDataFrame([], out)
    fit = fitted(entries, top)
    index = index_chunks(entries, fit)
    wanted = asked.select(F.col(f"`{key}`").cast("long").alias("id")).distinct()
    queries = rows.select("id", "x", "y").join(wanted, "id").join(entries.select("x", "y", "rep"), ["x", "y"])
    queries = stored(queries.select("id", "rep"), "vector-queries")
    points = entries.join(queries.select("rep").distinct(), "rep").select("rep", "vec")
    model = spark.sparkContext.broadcast(fit)
    held = np.zeros(len(fit.centres), np.int64)
    counted = index.groupBy("list").agg(F.sum(F.size("ids")).alias("n")).toPandas()  # LISTS rows at most
    held[counted["list"]] = counted["n"]

    def probe(batches):
        for batch in batches:
            order = _order(model.value.turned_queries(_matrix(batch.column("vec"))), model.value.centres)
            # Lists go on until they hold enough vectors, whatever the usual number of probes is.
            before = np.cumsum(held[order], axis=1) - held[order]
            near = (np.arange(order.shape[1]) < model.value.probes) | (before < 2 * need)
            q, nth = np.nonzero(near)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(q)), pa.array(order[q, nth]), pa.array(nth)], names=["rep", "list", "nth"]
            )

    # Vectors join their probes last, so they are moved once for each list.
    probes = stored(arrow_map(points, probe, "rep long, list long, nth long"), "vector-probes")
    unknown = F.lit(None).cast("double").alias("limit")
    near, rest = (probes.filter(F.col("nth") < fit.first), probes.filter(F.col("nth") >= fit.first))
    load = near.groupBy("list").count()
    near = near.join(points, "rep").select("rep", "list", "vec", unknown)
    first = stored(_probed(index, near, load, fit, need), "vector-nearest-lists")
    worst = first.withColumn("_nth", _nth("query")).filter(F.col("_nth") == need)
    worst = worst.select(F.col("query").alias("rep"), F.col("score").alias("limit"))
    known = points.join(worst, "rep", "left")
    load = rest.groupBy("list").count()
    rest = rest.join(known, "rep").select("rep", "list", "vec", "limit")
    second = _probed(index, rest, load, fit, need)
    best = first.unionByName(second).withColumn("_nth", _nth("query")).filter(F.col("_nth") <= need)
    results = queries.join(best.withColumnRenamed("query", "rep"), "rep").filter(F.col("id") != F.col("vec_id"))
    return (
        results.withColumn("rank", _nth("id"))
        .filter(F.col("rank") <= top)
        .select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
