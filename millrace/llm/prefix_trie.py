"""The prefix trie of conversations, built by cutting depth in halves.

Depths are cut at half, each half again, and so on. A prefix is named after the pieces between the
cuts that it is made of, at most one of each length, and all pieces of all levels are summed in one
aggregation: the upper tries and the lower forests of every level are built side by side. A name is
the depth and 128 bits; it depends on the turns alone, so equal prefixes of different conversations
get equal names without being compared.

Totals are grafted upward over the same cuts. Between a node and any node below it exactly one cut
is the highest. A node adds its own value to the cut ancestors that stand at the start of its
pieces, and each cut node hands its sum to the nodes of the half above it. So each node takes part
in as many sums as its depth has binary digits, where plain ancestors would be as many as its depth.

Awkward rows: rows without a conversation id make no conversation; a null role or text is empty; a
null turn number comes first; rows with one turn number are taken by role, then by the SHA-256 of
the text, and equal rows stay as often as they occur. A conversation whose rebuilt form has no turn
is a member of the root alone. No conversation, no node. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, stored

FAMILY = 20
HEADS = 4
WORD = r"[^\x20\x09-\x0D]+"
KEY = ("depth", "x", "y")
# One row becomes this many at most before they are dealt out again.
SPREAD = 1 << 10
PIECE_CHARS = 1 << 16
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _shift(function: str, value: Column, bits: Column) -> Column:
    return F.call_function(function, value, bits)


def numbered_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, pos, token, words) of every turn, ``pos`` counted from 1 within its conversation.

    Turns are dealt out by ranges, so a conversation that holds most of the table is numbered by
    many tasks: each numbers its part, and the parts before it are added.
    """
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = turns.select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.sha2(said, 256).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    ).filter(F.col("conv").isNotNull())
    order = ("turn", "role", "digest")
    part = Window.partitionBy("task", "conv").orderBy(*order)
    # Cut points are drawn from a first look at the rows, so what is costly is done before.
    dealt = stored(source, "trie-source").repartitionByRange("conv", *order).withColumn("task", F.spark_partition_id())
    token = F.substring(F.unhex(F.sha2(F.concat(F.sha2("role", 256), "digest"), 256)), 1, 16)
    parts = stored(
        dealt.select("conv", "task", "words", token.alias("token"), F.row_number().over(part).cast("long").alias("nth")),
        "trie-turns",
    )
    before = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a task can have begun in another one: no more rows than tasks.
    skipped = (
        parts.groupBy("conv", "task")
        .agg(F.count("*").alias("n"))
        .select("conv", "task", F.sum("n").over(before).alias("skipped"))
        .filter(F.col("skipped") > 0)
    )
    pos = F.col("nth") + F.coalesce("skipped", F.lit(0))
    return parts.join(F.broadcast(skipped), ["conv", "task"], "left").select("conv", pos.alias("pos"), "token", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, n) after the exchange of heads, and their turns.

    The first ``h`` turns of a conversation are replaced by those of the first one of its family
    of twenty, where ``h`` is the checksum of its number modulo four.
    """
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    first = F.col("conv") - F.col("conv") % FAMILY
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    bases = sizes.filter(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("base"), F.col("own").alias("lent"))
    convs = stored(
        sizes.withColumn("base", first)
        .join(bases, "base", "left")
        .withColumn("h", h)
        .withColumn("head", F.least("h", F.coalesce("lent", F.lit(0).cast("long"))))
        .select("conv", "base", "h", "head", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")),
        "trie-conversations",
    )
    lent = turns.filter((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv", "base")
    heads = convs.join(lent, "base").filter(F.col("pos") <= F.col("head")).withColumn("depth", F.col("pos"))
    tails = (
        turns.join(convs, "conv")
        .filter(F.col("pos") > F.col("h"))
        .withColumn("depth", F.col("head") + F.col("pos") - F.col("h"))
    )
    columns = ("conv", "n", "depth", "token", "words")
    return convs.select("conv", "n"), heads.select(*columns).unionByName(tails.select(*columns))


def _spread(frame: DataFrame, first: Column, last: Column, most: int, name: str) -> DataFrame:
    """A row for each number from ``first`` to ``last``, none more than ``most`` apart."""
    if most <= SPREAD:
        return frame.withColumn(name, F.explode(F.sequence(first, last)))
    bounded = frame.withColumn("_first", first).withColumn("_last", last)
    blocks = bounded.withColumn("_block", F.explode(F.sequence("_first", "_last", F.lit(SPREAD).cast("long"))))
    dealt = blocks.repartition("conv", "_block")
    end = F.least(F.col("_block") + (SPREAD - 1), F.col("_last"))
    return dealt.withColumn(name, F.explode(F.sequence("_block", end))).drop("_first", "_last", "_block")


def named_prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, x, y, parent_x, parent_y, words, last) for every prefix of a conversation."""
    value = [F.xxhash64(F.lit(k), "token", "depth") for k in (1, 2)]
    turns = stored(rows.select("conv", "n", "depth", "words", value[0].alias("vx"), value[1].alias("vy")), "trie-values")
    longest = turns.agg(F.max("n")).first()[0] or 0
    # A piece of length 2^level that begins at an even multiple of it ends the upper half of a cut;
    # it belongs to the name of every prefix that ends in the half below.
    level = F.explode(F.sequence(F.lit(0), F.floor(F.log2("n")).cast("int") + 1))
    at = _shift("shiftright", F.col("depth") - 1, F.col("level"))
    begins = _shift("shiftleft", F.col("at") + 1, F.col("level"))
    pieces = (
        turns.withColumn("level", level)
        .withColumn("at", at)
        .filter((F.col("at") % 2 == 0) & (begins <= F.col("n")))
        .groupBy("conv", "n", "level", "at")
        .agg(F.bit_xor("vx").alias("x"), F.bit_xor("vy").alias("y"))
    )
    ends = F.least(begins + _shift("shiftleft", F.lit(1).cast("long"), F.col("level")) - 1, F.col("n"))
    parts = _spread(pieces, begins, ends, longest, "depth").select("conv", "n", "depth", "x", "y")
    own = turns.select("conv", "n", "depth", "vx", "vy", "words")
    # x, y: of a prefix; vx, vy: of its last turn, which the name of its parent lacks.
    return (
        parts.unionByName(own, allowMissingColumns=True)
        .groupBy("conv", "n", "depth")
        .agg(*(F.bit_xor(c).alias(c) for c in ("x", "y")), *(F.max(c).alias(c) for c in ("vx", "vy", "words")))
        .select(
            "conv", "depth", "x", "y", "words",
            F.col("x").bitwiseXOR(F.col("vx")).alias("parent_x"),
            F.col("y").bitwiseXOR(F.col("vy")).alias("parent_y"),
            (F.col("depth") == F.col("n")).alias("last"),
        )
    )


def _merged(frames: list[DataFrame], **aggregates: Column) -> DataFrame:
    """Facts about nodes from several frames, brought together by one shuffle."""
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return united.groupBy(*KEY).agg(*(column.alias(name) for name, column in aggregates.items()))


def _nodes(prefixes: DataFrame) -> DataFrame:
    """Nodes below the root with their members, and how many children each has."""
    members = prefixes.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv"),
        *(F.max(c).alias(c) for c in ("words", "parent_x", "parent_y")),
    )
    # A child by the name of its parent; the parent's own row is among those of ``members``.
    children = (
        members.filter(F.col("depth") > 1)
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_x").alias("x"), F.col("parent_y").alias("y"))
        .agg(F.count("*").alias("n_children"))
    )
    return _merged(
        [members, children],
        **{c: F.max(c) for c in ("n_convs", "conv", "words", "parent_x", "parent_y")},
        n_children=F.coalesce(F.max("n_children"), F.lit(0).cast("long")),
    )


def _ancestors(asked: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Names for (conv, depth): those of the prefixes of the conversation a node is known by."""
    return asked.join(prefixes.select("conv", *KEY), ["conv", "depth"])


def grafted_totals(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """What each node gets from the nodes below it: (depth, x, y, leaves, saved)."""
    own = nodes.filter((F.col("leaves") > 0) | (F.col("saved") > 0))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    below = F.col("depth") - 1
    levels = F.sequence(F.lit(0), F.lit(max(0, deepest.bit_length() - 1)))
    cut = _shift("shiftleft", _shift("shiftright", below, F.col("level")), F.col("level"))
    lifted = (
        own.select("conv", "depth", "leaves", "saved", F.explode(levels).alias("level"))
        .filter(_shift("shiftright", below, F.col("level")) % 2 == 1)
        .groupBy("conv", cut.alias("depth"))
        .agg(*sums)
    )
    heads = _ancestors(lifted, prefixes).groupBy(*KEY).agg(*sums)
    held = heads.join(nodes.select("conv", *KEY), list(KEY)).withColumnRenamed("depth", "cut")
    # The half above a cut is as long as the greatest power of two that divides its depth.
    half = F.col("cut").bitwiseAND(-F.col("cut"))
    reached = _spread(
        held.select("conv", "cut", "leaves", "saved"), F.col("cut") - half + 1, F.col("cut"), deepest, "depth"
    )
    return _ancestors(reached.groupBy("conv", "depth").agg(*sums), prefixes).groupBy(*KEY).agg(*sums)


def _joined_ids(batches):
    """Sorted (depth, x, y, conv) rows as pieces of comma-joined ids of one node."""
    key, first, ids, chars = None, None, [], 0
    for batch in batches:
        out = []
        for *node, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and (node != key or chars > PIECE_CHARS):
                out.append((*key, first, ",".join(ids)))
                ids, chars = [], 0
            if not ids:
                key, first = node, conv
            ids.append(str(conv))
            chars += len(ids[-1]) + 1
        if out:
            yield _batch(out, [*KEY, "first", "ids"])
    if ids:
        yield _batch([(*key, first, ",".join(ids))], [*KEY, "first", "ids"])


def _hashed_ids(batches):
    """One hash a node over its pieces, which come in order; no list of them is ever held."""
    key, state = None, None
    for batch in batches:
        out = []
        for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node == key:
                state.update(b",")
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield _batch(out, [*KEY, "ends"])
    if key:
        yield _batch([(*key, state.hexdigest())], [*KEY, "ends"])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"ids": pa.string(), "ends": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows), strict=True)], names=names
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of (depth, x, y, conv) by node, in order of number, comma-joined.

    Ids are joined in parallel by ranges; only pieces of some ten thousand characters meet in
    the task that hashes a node.
    """
    key = ", ".join(f"{c} long" for c in KEY)
    ranges = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    pieces = arrow_map(ranges, _joined_ids, f"{key}, first long, ids string")
    sorted_pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return arrow_map(sorted_pieces, _hashed_ids, f"{key}, ends string")


def prefix_trie(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, the root included."""
    convs, rows = rebuilt(numbered_turns(turns, conv, turn, role, text))
    prefixes = stored(named_prefixes(rows), "trie-prefixes")
    zero = F.lit(0).cast("long")
    nodes = stored(
        _nodes(prefixes).select(
            *KEY, "conv", "parent_x", "parent_y", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "trie-nodes",
    )
    whole = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return turns.sparkSession.createDataFrame([], NODE)
    sums = nodes.agg(F.sum("leaves"), F.sum("saved"), F.count(F.when(F.col("depth") == 1, 1))).first()
    at_root = convs.filter(F.col("n") == 0).select(*(zero.alias(c) for c in KEY), "conv")
    ends = end_digests(prefixes.filter("last").select(*KEY, "conv").unionByName(at_root))
    ends = stored(ends, "trie-ends")
    top = ends.filter(F.col("depth") == 0).first()
    digest = top["ends"] if top else NO_ENDS
    leaves, saved, children = (value or 0 for value in sums)
    row = (whole["conv"], 0, None, whole["n"], children, max(leaves, 1), saved, digest)
    root = turns.sparkSession.createDataFrame([row], NODE)
    facts = _merged(
        [nodes, grafted_totals(nodes, prefixes), ends.filter(F.col("depth") > 0)],
        **{c: F.max(c) for c in ("conv", "parent_x", "parent_y", "n_convs", "n_children", "ends")},
        **{c: F.sum(c) for c in ("leaves", "saved")},
    )
    named = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("parent_x"), F.col("y").alias("parent_y"),
        F.col("conv").alias("parent"),
    )
    columns = (
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    # All nodes of depth one have the root as parent: one known number, no join by it.
    upper = facts.filter(F.col("depth") == 1).withColumn("parent", F.lit(whole["conv"])).select(*columns)
    lower = facts.filter(F.col("depth") > 1).join(named, ["depth", "parent_x", "parent_y"]).select(*columns)
    return root.unionByName(upper).unionByName(lower)
