"""URL filter: a trie over reversed host labels and path segments.

A rule is an action, a host and a path prefix. Its labels, last first, lead
from the root to the node of its host; its whole path segments lead on from
there, and what follows the last slash is kept at the node as a plain prefix.
A URL walks the labels of its host down; at each node passed its path walks
the segments. The longest rule met wins: more host labels first, then the
longer path; of an allow and a block rule for the same place, block.

The trie is broadcast in blocks of at most BLOCK_RULES rules; a longer list
takes one pass per block and keeps the longest match. URLs are judged where
they are, without a shuffle.

Defined results: a null URL, or one without ``://``, has an empty host and
path and fits no rule; URLs that fit no rule get ``default``; repeated rows
are judged one by one; long URLs are walked whole; other columns pass
through whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import ship

BLOCK_RULES = 500_000
DEFAULT = "allow"


class Rule(NamedTuple):
    action: str  # allow or block
    host: str
    path: str = "/"


class Node:
    __slots__ = ("labels", "segments", "ends", "action")

    def __init__(self) -> None:
        self.labels: dict[str, Node] = {}    # next host label
        self.segments: dict[str, Node] = {}  # next whole path segment
        self.ends: dict[str, str] = {}       # rest of a path -> action


class Trie:
    def __init__(self, rules: Iterable[Rule]) -> None:
        self.root = Node()
        for rule in rules:
            if rule.action not in ("allow", "block"):
                raise ValueError(f"unknown action {rule.action!r}")
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.labels.setdefault(label, Node())
            *whole, rest = rule.path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, Node())
            if node.ends.get(rest) != "block":
                node.ends[rest] = rule.action

    def match(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """(labels, path length, action, rule) of the longest rule."""
        labels = host.split(".")
        node, best = self.root, None
        for depth in range(1, len(labels) + 1):
            node = node.labels.get(labels[-depth])
            if node is None:
                break
            found = self._path(node, path)
            if found:
                best = (depth, found[0], found[1],
                        ".".join(labels[-depth:]) + path[:found[0]])
        return best

    @staticmethod
    def _path(node: Node, path: str) -> tuple[int, str] | None:
        at, best = 0, None
        while True:
            for rest, action in node.ends.items():
                if path.startswith(rest, at) and (best is None or at + len(rest) >= best[0]):
                    best = (at + len(rest), action)
            slash = path.find("/", at)
            node = node.segments.get(path[at:slash]) if slash >= 0 else None
            if node is None:
                return best
            at = slash + 1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z
    lower-cased; empty without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(_after(url), r"^([^/?#]*)", 1)
    return F.translate(host, upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


_MATCH = T.StructType([
    T.StructField("labels", T.IntegerType()), T.StructField("length", T.IntegerType()),
    T.StructField("action", T.StringType()), T.StructField("rule", T.StringType())])


def _judge(trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("found").type
            found = [None if m is None else dict(zip(("labels", "length", "action", "rule"), m))
                     for m in map(trie.value.match, batch["host"].to_pylist(),
                                  batch["path"].to_pylist())]
            before = batch["found"].to_pylist()
            rank = lambda m: (-1, -1, "") if m is None else (m["labels"], m["length"], m["action"])
            found = [max(a, b, key=rank) for a, b in zip(before, found)]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["host"], batch["path"], pa.array(found, kind)],
                names=["row", "host", "path", "found"])
    return run


def _blocks(rules: Iterable[Rule], size: int) -> Iterator[list[Rule]]:
    block: list[Rule] = []
    for rule in rules:
        block.append(rule)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def judge(pages: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = DEFAULT,
          block_rules: int = BLOCK_RULES) -> DataFrame:
    """(row, host, path, rule, verdict): each input row, its URL's parts, the
    deciding rule (host and path; null: none) and ``allow`` or ``block``."""
    spark = pages.sparkSession
    ship(spark)
    kept = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    out = pages.select(kept.alias("row"), host_of(F.col(f"`{url}`")).alias("host"),
                       path_of(F.col(f"`{url}`")).alias("path"))
    out = out.select("row", F.coalesce("host", F.lit("")).alias("host"),
                     F.coalesce("path", F.lit("")).alias("path"),
                     F.lit(None).cast(_MATCH).alias("found"))
    schema = T.StructType([
        T.StructField("row", out.schema["row"].dataType), T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()), T.StructField("found", _MATCH)])
    for block in _blocks(rules, block_rules):
        out = out.mapInArrow(_judge(spark.sparkContext.broadcast(Trie(block))), schema)
    return out.select("row", "host", "path", F.col("found.rule").alias("rule"),
                      F.coalesce("found.action", F.lit(default)).alias("verdict"))
