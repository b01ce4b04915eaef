"""URL rules by a sort-merge range join.

A host becomes its labels in reverse order, each with a dot behind it: ``www.example.com`` is
``com.example.www.``. All subdomains of a host then lie in one interval of keys. URLs are cut
into ranges of (key, path, tie-break); a rule goes to every range that its interval meets, and
in each range one sweep in key order keeps a stack of the hosts whose intervals are open. Each
open host has its path prefixes by length, so a URL asks for its own prefixes only.

Cut points come from one row for each of ``DRAWS`` buckets of a hash: they only balance the
ranges, any cut points give the same result. As the tie-break is part of the order, even a single
URL that fills a third of the table is cut into many ranges. At a cut only the rules of one chain
of nested hosts are open, so few rules go to more than one range.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: from
there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has both empty. The
longest rule (host and path together) wins; equally long ones by longer host, then "block" over
"allow". Without a rule the verdict is ``DEFAULT``. Rules with a null host or path never fit.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from millrace.llm.common import arrow_map, extended

DEFAULT = "allow"
DRAWS = 4096
KEY_CUT = 300
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULE_SCHEMA = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def cut_points(points: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """``ranges - 1`` places that cut the points about evenly. At most ``DRAWS`` short keys."""
    place = F.struct(
        F.substring("key", 1, KEY_CUT).alias("key"),
        F.substring("path", 1, KEY_CUT).alias("path"),
        "tie",
    )
    drawn = (
        points.groupBy(F.pmod("tie", F.lit(DRAWS)).alias("bucket"))
        .agg(F.min_by(place, F.xxhash64("tie", "key", "path")).alias("place"))
        .collect()
    )
    places = sorted({tuple(r["place"]) for r in drawn})
    if not places:
        return []
    step = len(places) / ranges
    return sorted({places[int(k * step)] for k in range(1, ranges)})


class Open:
    """Path rules of one host whose interval is open."""

    def __init__(self, key: str) -> None:
        self.key = key
        self.rules: dict[str, tuple[int, str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, host: str, verdict: str) -> None:
        old = self.rules.get(path)
        if old is None or verdict == "block":
            self.rules[path] = (len(host) + len(path), host + path, verdict)
        self.lengths = sorted({len(p) for p in self.rules})

    def longest(self, path: str) -> tuple[int, str, str] | None:
        for length in reversed(self.lengths):
            if length <= len(path) and (found := self.rules.get(path[:length])):
                return found
        return None


class Sweep:
    """Rules and URLs in key order; of equal keys, rules first."""

    def __init__(self) -> None:
        self.range: int | None = None
        self.stack: list[Open] = []

    def _enter(self, part: int, key: str) -> None:
        if part != self.range:
            self.range, self.stack = part, []
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def rule(self, part: int, key: str, host: str, path: str, verdict: str) -> None:
        self._enter(part, key)
        if not self.stack or self.stack[-1].key != key:
            self.stack.append(Open(key))
        self.stack[-1].add(path, host, verdict)

    def judge(self, part: int, key: str, path: str) -> tuple[str | None, str]:
        self._enter(part, key)
        best = None
        for host in reversed(self.stack):  # longer hosts first: they win among equally long rules
            found = host.longest(path)
            if found and (best is None or found[0] > best[0]):
                best = found
        return (best[1], best[2]) if best else (None, DEFAULT)


def judge_urls(frame: DataFrame, rules: DataFrame, url: str = "url", ranges: int | None = None) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict``; columns of these names are replaced."""
    spark = frame.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = ("host", "path", "rule", "verdict")
    kept = [c for c in frame.columns if c not in made]
    host, path = url_host(F.col(f"`{url}`")), url_path(F.col(f"`{url}`"))
    row = F.struct(*(F.col(f"`{c}`") for c in kept))
    points = frame.select(
        row.alias("row"),
        host.alias("host"),
        path.alias("path"),
        host_key(host).alias("key"),
        # By the place of the row, so that equal rows are cut into ranges as well.
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 62)).alias("tie"),
    )
    cuts = cut_points(points.select("key", "path", "tie"), ranges)
    lower = [c[0] for c in cuts]

    def place(batches):
        for batch in batches:
            keys, paths, ties = (batch.column(c).to_pylist() for c in ("key", "path", "tie"))
            found = [bisect_right(cuts, p) for p in zip(keys, paths, ties, strict=True)]
            yield batch.append_column("part", pa.array(found, pa.int32()))

    def spread(batches):
        """A rule for every range that may hold a key of its interval."""
        for batch in batches:
            keys = batch.column("key").to_pylist()
            parts = []
            for key in keys:
                first, last = bisect_right(cuts, (key,)), bisect_right(lower, key + "\U0010ffff")
                parts.append(list(range(first, last + 1)))
            yield batch.append_column("parts", pa.array(parts, pa.list_(pa.int32())))

    placed = arrow_map(points, place, extended(points.schema, part=IntegerType()))
    # Every verdict's rules are compared as they are; "block" comes last and so wins.
    own = (
        rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select("host", "path", "verdict")
        .distinct()
        .withColumn("key", host_key(F.translate("host", _UPPER, _UPPER.lower())))
    )
    own = arrow_map(own, spread, "host string, path string, verdict string, key string, parts array<int>"
    )
    events = (
        placed.select("part", "key", F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("verdict"), "row")
        .unionByName(
            own.select(F.explode("parts").alias("part"), "key", F.lit(0).alias("kind"), "host", "path", "verdict"),
            allowMissingColumns=True,
        )
        .repartition(ranges, "part")
        .sortWithinPartitions("part", "key", "kind")
    )

    def sweep(batches):
        state = Sweep()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "key", "kind", "host", "path", "verdict"))
            at, rule, verdict = [], [], []
            for k, (part, key, kind, host, path, said) in enumerate(zip(*columns, strict=True)):
                if kind:
                    found = state.judge(part, key, path)
                    at.append(k)
                    rule.append(found[0])
                    verdict.append(found[1])
                else:
                    state.rule(part, key, host, path, said)
            out = batch.select(["row", "host", "path"]).take(pa.array(at, pa.int64()))
            yield out.append_column("rule", pa.array(rule, pa.string())).append_column(
                "verdict", pa.array(verdict, pa.string())
            )

    schema = extended(
        events.select("row", "host", "path").schema, rule=StringType(), verdict=StringType()
    )
    return arrow_map(events, sweep, schema).select("row.*", *made)
