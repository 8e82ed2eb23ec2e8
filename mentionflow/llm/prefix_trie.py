"""The prefix trie of conversations, from ternary search trees per range shard.

Turns are dictionary-encoded: a dense id per distinct (role, text). A conversation becomes segments of at most `SEGMENT`
ids, so that one of any length stays in bounded rows; the segments after equal beginnings share an origin and form a trie
of their own, and the levels of segments are handled from the deepest up, each passing the totals of its tries to the
nodes they hang on (conversations of up to `SEGMENT` turns make one level).

A level's segments are range-partitioned by (origin, ids, conversation), which also parts a third of all rows with equal
ids, and read as shards of about `SHARD` turns. The distinct sequences of a shard enter a ternary search tree, medians
first, so that it is balanced; one pass over its nodes, children before parents, adds up members, leaves and savings.
Nodes on the path of a shard's first or last sequence may go on in the neighbouring shards: these boundary nodes are
left open, at most `2 * SEGMENT + 2` a shard, and merged by their prefix in Spark; every merged node hands what is its
own to the nodes above it. All others are final within their shard.

Results: turns are ordered by turn, null first, ties by a hash of role and text; null roles and texts are empty; rows without
`conv_id` take no part; repeated rows are turns of their own; a conversation whose beginning is absent or shorter has
fewer turns or none, and is still a member; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionflow.session import staged

#: Conversations that share a beginning, and the number of lengths such a beginning may have.
FAMILY, BEGINNINGS = 100, 6
SEGMENT = 256
#: Turns of a shard, a conversation of none counting as one: the nodes one task holds at a time.
SHARD = 50_000

_NODE = "conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_OPEN = "key binary, above array<binary>, tokens long, inner_children long, inner_leaves long, inner_saved long, next_children long, next_leaves long, next_saved long, ends string, origin binary"
_COLUMNS = [part.split()[0] for part in f"{_NODE}, {_OPEN}".split(", ")]
_TYPES = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}
_KINDS = [_TYPES[part.split()[1]] for part in f"{_NODE}, {_OPEN}".split(", ")]


def _hashed(turns: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, two hashes of the turn's role and text, and the text's length."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    return turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), role, text).alias("h2"),
        F.char_length(text).cast("long").alias("tokens"),
    )


def _ranked(hashed: DataFrame) -> DataFrame:
    """`conv_id`, `at` (from 1), the hashes and the length, ranked without gathering a conversation.

    Rows are range-partitioned in order, so a long conversation lies in several partitions; its rows are counted per
    partition, and a row's rank is its rank within the partition plus the counts of the partitions before.
    """
    order = ("conv_id", F.col("turn").asc_nulls_first(), "h1", "h2")
    dealt = hashed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    # the lower 33 bits of that id count the rows of a partition, the others number the partitions
    numbered, _ = staged(dealt.withColumn("part", F.shiftright("row", 33)).drop("turn"), "ordered-turns")
    parts = numbered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts, _ = staged(parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "turn-counts")
    at = F.col("row") - F.col("first") + F.col("before") + 1
    return numbered.join(parts, ["conv_id", "part"]).select("conv_id", at.alias("at"), "h1", "h2", "tokens")


def encoded_turns(turns: DataFrame) -> DataFrame:
    """`conv_id`, `at`, the turn's `id` in a dictionary of the distinct turns, and `tokens`, its length."""
    hashed, _ = staged(_hashed(turns), "turns")
    dictionary, _ = staged(hashed.select("h1", "h2").distinct().withColumn("id", F.monotonically_increasing_id()), "dictionary")
    found = _ranked(hashed).join(dictionary, ["h1", "h2"]).select("conv_id", "at", "id", "tokens")
    return staged(found, "encoded-turns")[0]


def share_beginnings(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: their ids with their number of turns, and their turns.

    Conversation c takes the first crc32(c) % 6 turns of the first one of its hundred, then its own from there on.
    """
    counts, _ = staged(ranked.groupBy("conv_id").agg(F.count("*").alias("n")), "turns-per-conversation")
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = counts.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(BEGINNINGS))
    has = F.least(F.coalesce("n_base", F.lit(0)), "head")
    convs = convs.withColumn("head", head).withColumn("has", has)
    convs, _ = staged(convs.withColumn("n_turns", F.col("has") + F.greatest(F.col("n") - F.col("head"), F.lit(0))), "rebuilt")
    starts = ranked.filter(F.col("at") < BEGINNINGS).withColumnRenamed("conv_id", "base")  # at most five a conversation, for a hundred
    first = convs.filter("has > 0").join(starts, "base").filter("at <= head").select("conv_id", "at", "id", "tokens")
    rest = ranked.join(convs.select("conv_id", "head", "has"), "conv_id").filter("at > head")
    rest = rest.select("conv_id", (F.col("at") - F.col("head") + F.col("has")).alias("at"), "id", "tokens")
    return convs.select("conv_id", "n_turns"), first.unionByName(rest)


def _segments(convs: DataFrame, turns: DataFrame, segment: int) -> DataFrame:
    """One row per stretch of up to `segment` turns: `level`, `origin`, `next`, `full`, `ids`, `tokens`, `conv_id`.

    An origin stands for the sequence of all turns before a stretch: a fold, by exclusive or, of the hashes of the
    stretches so far and their levels. `next` is the origin of the stretch that follows, if there is one; `full` is the
    origin a stretch would give, if it has all its turns.
    """
    level = F.floor((F.col("at") - 1) / segment).cast("long").alias("level")
    listed = F.array_sort(F.collect_list(F.struct("at", "id", "tokens")))  # at most `segment` rows
    cut = turns.groupBy("conv_id", level).agg(listed.alias("rows"))
    cut = cut.select("conv_id", "level", F.col("rows.id").alias("ids"), F.col("rows.tokens").alias("tokens"))
    nothing = F.array().cast("array<bigint>")
    cut = cut.unionByName(convs.filter("n_turns = 0").select("conv_id", F.lit(0).cast("long").alias("level"), nothing.alias("ids"), nothing.alias("tokens")))
    in_order = Window.partitionBy("conv_id").orderBy("level")
    folds = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("level"), F.col("ids"))).over(in_order) for seed in (1, 2)]
    folded = cut.withColumn("fold", F.concat(*(F.unhex(F.lpad(F.hex(fold), 16, "0")) for fold in folds)))
    return folded.select(
        "level",
        F.coalesce(F.lag("fold").over(in_order), F.lit(b"")).alias("origin"),
        F.when(F.lead("level").over(in_order).isNotNull(), F.col("fold")).alias("next"),
        F.when(F.size("ids") == segment, F.col("fold")).alias("full"),
        "ids",
        "tokens",
        "conv_id",
    )


class Tree:
    """A ternary search tree over sequences of ids; node 0 stands for the empty sequence."""

    def __init__(self) -> None:
        self.ids, self.less, self.equal, self.more = [-1], [0], [0], [0]
        self.parent, self.depth, self.tokens = [-1], [0], [0]

    def _node(self, one: int, parent: int, tokens: int) -> int:
        for column, value in ((self.ids, one), (self.less, 0), (self.equal, 0), (self.more, 0), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.tokens, tokens)):
            column.append(value)
        return len(self.ids) - 1

    def insert(self, ids: Sequence[int], tokens: Sequence[int]) -> int:
        """The node of a sequence; its nodes are made where they are missing."""
        at = 0
        for one, size in zip(ids, tokens):
            parent, links = at, self.equal
            while links[at]:
                at = links[at]
                if one == self.ids[at]:
                    break
                links = self.less if one < self.ids[at] else self.more
            else:
                links[at] = at = self._node(one, parent, size)
        return at

    def path(self, at: int) -> list[int]:
        """The nodes from the empty sequence down to a node."""
        nodes = [at]
        while at:
            at = self.parent[at]
            nodes.append(at)
        return nodes[::-1]


def medians_first(count: int) -> Iterator[int]:
    """The numbers below `count`, so that a search tree filled in this order is balanced."""
    stretches = [(0, count)]
    while stretches:
        low, high = stretches.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stretches += [(middle + 1, high), (low, middle)]


def _digest(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, convs)).encode()).hexdigest()


def _keys(origin: bytes, ids: Sequence[int]) -> list[bytes]:
    """The keys of a sequence's prefixes, the empty one first."""
    keys = [xxhash.xxh3_128_digest(origin)]
    for one in ids:
        keys.append(xxhash.xxh3_128_digest(keys[-1] + one.to_bytes(8, "little", signed=True)))
    return keys


def shard_nodes(origin: bytes, depth: int, rows: list[dict], first: bool, last: bool) -> list[tuple]:
    """The nodes of one trie within a shard, in the layout of `_COLUMNS`.

    `rows` are sorted by ids and conversation. The paths of the first and the last row are left open where `first` and
    `last` say that the neighbouring shards may share them.
    """
    tree = Tree()
    starts = [at for at in range(len(rows)) if not at or rows[at]["ids"] != rows[at - 1]["ids"]]
    stops = [*starts[1:], len(rows)]
    ends: dict[int, list[int]] = {}
    through: dict[int, dict] = {}
    places = {}
    for at in medians_first(len(starts)):
        group = rows[starts[at] : stops[at]]
        node = places[at] = tree.insert(group[0]["ids"], group[0]["tokens"])
        ends[node] = [row["conv_id"] for row in group if row["next"] is None]
        onward = [row for row in group if row["next"] is not None]
        if onward:
            through[node] = {"n": len(onward), "low": min(row["conv_id"] for row in onward), "totals": onward[0]}
    open_keys: dict[int, bytes] = {}
    above: dict[int, list[bytes]] = {}
    for is_open, at, row in ((first, 0, rows[0]), (last, len(starts) - 1, rows[-1])):
        if is_open:
            keys = _keys(origin, row["ids"])
            for place, node in enumerate(tree.path(places[at])):
                open_keys[node] = keys[place]
                above[node] = keys[: place + 1]
    count = len(tree.ids)
    members, low = [0] * count, [None] * count
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    totals = [(0, 0, 0)] * count
    for node in range(count - 1, -1, -1):  # nodes are made after their parents
        own = ends.get(node, [])
        goes_on = through.get(node)
        lows = [low[node], min(own, default=None), goes_on and goes_on["low"], None if node else rows[0]["origin_low"]]
        low[node] = min(one for one in lows if one is not None)
        members[node] += len(own)
        if goes_on:
            members[node] += goes_on["n"]
            totals[node] = tuple(goes_on["totals"][name] or 0 for name in ("next_children", "next_leaves", "next_saved"))
        parent = tree.parent[node]
        if node not in open_keys:
            children[node] += totals[node][0]
            leaves[node] = leaves[node] + totals[node][1] if children[node] else 1
            saved[node] += totals[node][2] + (members[node] - 1) * tree.tokens[node]
        if parent >= 0:
            members[parent] += members[node]
            low[parent] = low[node] if low[parent] is None else min(low[parent], low[node])
            if node not in open_keys:
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
    found = []
    for node in range(count):
        parent, own = tree.parent[node], ends.get(node, [])
        if node in open_keys:
            place = (low[node], depth + tree.depth[node], None, above[node][-2] if node else None, members[node], None, None, None, None)
            found.append((*place, open_keys[node], above[node], tree.tokens[node], children[node], leaves[node], saved[node], *totals[node], ",".join(map(str, own)) or None, None if node else origin))
        else:
            known = parent >= 0 and parent not in open_keys
            place = (low[node], depth + tree.depth[node], low[parent] if known else None, open_keys.get(parent), members[node])
            found.append((*place, children[node], leaves[node], saved[node], _digest(own), *[None] * 10, None if node else origin))
    return found


def _shards(segments: DataFrame, depth: int, shard: int) -> DataFrame:
    """The nodes of every shard of one level; shards are runs of sorted rows within a partition."""
    order = ("origin", "ids", "conv_id")
    columns = (*order, "tokens", "next", "next_children", "next_leaves", "next_saved", "origin_low")
    dealt = segments.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)

    def nodes(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        starts = [at for at in range(len(rows)) if not at or rows[at]["origin"] != rows[at - 1]["origin"]]
        found: list[tuple] = []
        for start, stop in zip(starts, [*starts[1:], len(rows)]):
            found += shard_nodes(rows[start]["origin"], depth, rows[start:stop], start == 0, stop == len(rows))
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*found), _KINDS)], _COLUMNS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                size += len(row["ids"]) or 1
                if size >= shard:
                    yield from nodes(rows)
                    rows, size = [], 0
        if rows:
            yield from nodes(rows)

    return dealt.mapInArrow(work, f"{_NODE}, {_OPEN}")


def _ends(opened: DataFrame) -> DataFrame:
    """`key` and the digest of the ids that end at it: each task feeds the digests of its keys piece by piece, in order."""
    pieces = opened.filter(F.col("ends").isNotNull()).select("key", F.substring_index("ends", ",", 1).cast("long").alias("first"), "ends")
    dealt = pieces.repartition("key").sortWithinPartitions("key", "first")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, digests = [], []
            for next_key, piece in zip(batch.column(0).to_pylist(), batch.column(2)):
                if next_key != key:
                    if key is not None:
                        keys.append(key)
                        digests.append(digest.hexdigest())
                    key, digest = next_key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    return dealt.mapInArrow(work, "key binary, ends_sha256 string")


def _merged(found: DataFrame) -> DataFrame:
    """The boundary nodes of one level, merged over the shards, with the totals of their subtrees."""
    opened = found.filter(F.col("key").isNotNull())
    sums = ("n_convs", "inner_children", "inner_leaves", "inner_saved")
    same = ("depth", "parent_key", "above", "tokens")
    once = ("next_children", "next_leaves", "next_saved", "origin")  # the same in every shard
    merged = opened.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), *[F.first(name).alias(name) for name in same], *[F.sum(name).alias(name) for name in sums], *[F.max(name).alias(name) for name in once]
    )
    merged, _ = staged(merged, "boundary")
    below, _ = staged(merged.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("open_children")), "boundary-children")
    counted = merged.join(below, "key", "left").withColumn("n_children", F.coalesce("open_children", F.lit(0)) + F.col("inner_children") + F.col("next_children"))
    leaves = F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("inner_leaves") + F.col("next_leaves"))
    saved = F.col("inner_saved") + F.col("next_saved") + (F.col("n_convs") - 1) * F.col("tokens")
    counted, _ = staged(counted.select("key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "above", "origin", leaves.alias("leaves"), saved.alias("saved")), "boundary-own")
    totals = counted.select(F.explode("above").alias("key"), "leaves", "saved").groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    totals, _ = staged(totals, "boundary-totals")
    ends, _ = staged(_ends(opened), "boundary-ends")
    full = counted.join(totals, "key").join(ends, "key", "left")
    ended = F.coalesce("ends_sha256", F.lit(_digest([]))).alias("ends_sha256")
    return full.select("key", "parent_key", "origin", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", ended)


_RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_TOTALS = {"n_children": "next_children", "n_leaves": "next_leaves", "saved_tokens": "next_saved"}


def _level(segments: DataFrame, depth: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of one level's tries, and what lies below each of their origins."""
    found, _ = staged(_shards(segments, depth, shard), "trie-nodes")
    merged, _ = staged(_merged(found), "boundary-nodes")
    inner = found.filter(F.col("key").isNull())
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("open_parent"))
    hung = inner.select("parent_key", "origin", *_RESULT).unionByName(merged.select("parent_key", "origin", F.lit(None).cast("long").alias("parent_conv_id"), *(set(_RESULT) - {"parent_conv_id"})))
    inside = hung.filter(F.col("parent_key").isNull())
    beneath = hung.filter(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(parents, "parent_key").withColumnRenamed("open_parent", "parent_conv_id")
    nodes = inside.select("origin", *_RESULT).unionByName(beneath.select("origin", *_RESULT))
    tops = nodes.filter(F.col("origin").isNotNull()).select(F.col("origin").alias("next"), *(F.col(name).alias(new) for name, new in _TOTALS.items()))
    return nodes.select(*_RESULT), tops


def prefix_trie(turns: DataFrame, segment: int = SEGMENT, shard: int = SHARD, share: bool = True) -> DataFrame:
    """One row per distinct beginning of the conversations `conv_id`, `turn`, `role`, `text`.

    `share` rebuilds the conversations with shared beginnings first.
    """
    ranked = encoded_turns(turns)
    if share:
        convs, sequence = share_beginnings(ranked)
    else:
        convs, sequence = ranked.groupBy("conv_id").agg(F.count("*").alias("n_turns")), ranked
    segments, _ = staged(_segments(convs, sequence, segment), "segments")
    deepest = segments.agg(F.max("level")).first()[0] or 0
    whole: DataFrame | None = None
    tops: DataFrame | None = None
    for level in range(deepest, -1, -1):
        own = segments.filter(F.col("level") == level)
        if level:
            # the smallest conversation that has all turns before, whether it goes on or not
            lows = segments.filter((F.col("level") == level - 1) & F.col("full").isNotNull()).groupBy(F.col("full").alias("origin")).agg(F.min("conv_id").alias("origin_low"))
            own = own.join(staged(lows, "origin-lows")[0], "origin")
        else:
            own = own.withColumn("origin_low", F.lit(None).cast("long"))
        if tops is None:
            own = own.select("*", *(F.lit(None).cast("long").alias(name) for name in _TOTALS.values()))
        else:
            own = own.join(staged(tops, "origin-totals")[0], "next", "left")
        own, _ = staged(own, "level")
        nodes, tops = _level(own, level * segment, shard)
        nodes = nodes.filter(F.col("depth") > level * segment) if level else nodes
        whole = nodes if whole is None else whole.unionByName(nodes)
    return whole


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: CRC-32 by its polynomial, bit by bit; every conversation's beginnings as hashed lists; a node hands its own to the
#: beginnings of its smallest member.
OP13_SQL = rf"""
WITH RECURSIVE ranked AS (
    SELECT conv_id, coalesce(role, '') || chr(1) || coalesce(text, '') AS said, length(coalesce(text, '')) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), crc(conv_id, step, value) AS (
    SELECT DISTINCT conv_id, 0, 4294967295 FROM ranked
    UNION ALL
    SELECT conv_id, step + 1, CASE WHEN value % 2 = 1 THEN xor(value // 2, 3988292384) ELSE value // 2 END
    FROM (SELECT conv_id, step, CASE WHEN step % 8 = 0 THEN xor(value, ascii(substr(CAST(conv_id AS VARCHAR), step // 8 + 1, 1))) ELSE value END AS value
          FROM crc WHERE step < 8 * length(CAST(conv_id AS VARCHAR)))
), heads AS (
    SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, xor(max_by(value, step), 4294967295) % {BEGINNINGS} AS head FROM crc GROUP BY conv_id
), pieces AS (
    SELECT h.conv_id, 0 AS part, r.place, r.said, r.size FROM heads h JOIN ranked r ON r.conv_id = h.base AND r.place <= h.head
    UNION ALL
    SELECT h.conv_id, 1, r.place, r.said, r.size FROM heads h JOIN ranked r ON r.conv_id = h.conv_id AND r.place > h.head
), rebuilt AS (
    SELECT conv_id, size, row_number() OVER w AS depth, sha256(to_json(list(sha256(said)) OVER w)::VARCHAR) AS node
    FROM pieces WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), members AS (
    SELECT conv_id, size, depth, node FROM rebuilt UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), ends AS (
    SELECT depth, node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ended
    FROM members JOIN (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id) USING (conv_id, depth) GROUP BY depth, node
), nodes AS (
    SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved FROM members GROUP BY depth, node
), linked AS (
    SELECT n.*, up.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN members m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1 LEFT JOIN nodes up ON up.depth = m.depth AND up.node = m.node
), children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2
), own AS (
    SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (conv_id, depth)
), totals AS (
    SELECT m.depth, m.node, count(*) FILTER (WHERE o.n_children = 0) AS n_leaves, sum(o.saved) AS saved_tokens
    FROM own o JOIN members m ON m.conv_id = o.conv_id AND m.depth <= o.depth GROUP BY m.depth, m.node
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ended, '')) AS ends_sha256
FROM own JOIN totals USING (depth, node) LEFT JOIN ends USING (depth, node)
"""
