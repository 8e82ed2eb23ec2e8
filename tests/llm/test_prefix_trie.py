"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mentionflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, share=True):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [said[2:] for said in sorted(found)] for conv, found in turns.items()}
    rebuilt = own
    if share:
        rebuilt = {}
        for conv, found in own.items():
            head = zlib.crc32(str(conv).encode()) % 6
            rebuilt[conv] = own.get(conv - conv % 100, [])[:head] + found[head:]
    members, kids = defaultdict(list), defaultdict(set)
    for conv, found in rebuilt.items():
        for depth in range(len(found) + 1):
            members[tuple(found[:depth])].append(conv)
            if depth:
                kids[tuple(found[: depth - 1])].add(tuple(found[:depth]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not kids[node]
            saved[node[:depth]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, found in members.items():
        ended = ",".join(str(conv) for conv in sorted(found) if len(rebuilt[conv]) == len(node))
        out.append((min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(row) for row in frame.select(*prefix_trie._RESULT).collect()), key=str)


def random_rows(seed, convs, most, texts="ab"):
    draw = random.Random(seed)
    rows = []
    for conv in range(convs):
        number = draw.choice([conv, conv * 7, 100 + conv])
        for turn in range(draw.randint(0, most)):
            rows.append((number * 1000 + conv, turn, draw.choice(["user", "assistant"]), draw.choice(texts) * draw.randint(1, 2)))
    return rows


@pytest.mark.parametrize("seed, segment, shard", [(1, 64, 50_000), (2, 4, 12), (4, 5, 1)])
def test_without_shared_beginnings(spark, seed, segment, shard):
    rows = random_rows(seed, 60, 7)
    rows += [(900_000 + at, turn, "user", "aa") for at in range(40) for turn in range(6)]  # copies
    rows += [(800_000, turn, "user", "aa") for turn in range(9)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.prefix_trie(frame, segment, shard, share=False)) == plain(rows, share=False)


@pytest.mark.parametrize("segment, shard", [(64, 50_000), (5, 5)])
def test_shared_beginnings_and_awkward_rows(spark, segment, shard):
    draw = random.Random(9)
    rows = [(conv, turn, draw.choice(["user", None]), draw.choice(["é😀", "", None, "b", "bb"])) for conv in [*range(95, 130), *range(205, 215), 300] for turn in range(draw.randint(1, 8))]
    rows += [(301, None, "user", "first"), (301, -5, "user", "second"), (301, 2, None, None), (None, 1, "user", "x"), (301, 2, "", "")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("mine")).withColumn("at", F.lit(1))
    assert got(prefix_trie.prefix_trie(frame, segment, shard)) == plain(rows)
    assert prefix_trie.prefix_trie(frame.limit(0), segment, shard).count() == 0
    assert prefix_trie.prefix_trie(frame.filter("conv_id IS NULL"), segment, shard).count() == 0


def test_turns_that_tie_have_one_order(spark):
    rows = [(conv, 1, "user", text) for conv in (100, 200) for text in ("a", "b", "c", "a")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = got(prefix_trie.prefix_trie(frame, share=False))
    assert len(found) == 5 and {row[3] for row in found} == {2}
    assert got(prefix_trie.prefix_trie(frame.orderBy(F.desc("text")), share=False)) == found


def test_a_long_conversation_is_ranked_over_partitions(spark):
    rows = [(1, turn, "user", str(turn % 7)) for turn in range(300)] + [(2, turn, "user", str(turn % 7)) for turn in range(250)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = prefix_trie.encoded_turns(spark.createDataFrame(rows, SCHEMA))
        assert [row.at for row in ranked.filter("conv_id = 1").orderBy("at").collect()] == list(range(1, 301))
        found = got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), segment=200, shard=70, share=False))
        assert found == plain(rows, share=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_medians_first_fill_a_balanced_tree():
    assert sorted(prefix_trie.medians_first(100)) == list(range(100))
    tree = prefix_trie.Tree()
    for at in prefix_trie.medians_first(1023):
        tree.insert([at], [1])
    deepest, nodes = 0, [(tree.equal[0], 1)]
    while nodes:
        node, depth = nodes.pop()
        deepest = max(deepest, depth)
        nodes += [(child, depth + 1) for child in (tree.less[node], tree.more[node]) if child]
    assert deepest == 10
