"""Line dedup, URL filter, licence scan and chat formatting against plain versions."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from compare import difference
from helpers import AWKWARD, LOWER, documents
from pyspark.sql import functions as F

from mentionflow.llm import chat_format, license_scan, line_dedup, url_filter

BLANKS = " \t\n\x0b\x0c\r"


def plain_line_dedup(rows, least=2):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(BLANKS).translate(LOWER)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(BLANKS).translate(LOWER)
            ids = holders[key]
            keeper = min((one for one in ids if one is not None), default=None)
            if len(key) < 10 or len(ids) < least or doc_id == keeper:
                kept.append(line)
        out.append((str(doc_id), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("least", [2, 3])
def test_line_dedup(spark, least):
    own = ["row", "doc", "text_hash", "at", "line", "key", "h1", "h2", "held", "keeper", "gone", "in_doc", "in_text"]
    docs = documents(spark, AWKWARD).select("*", F.lit("mine").alias("n_lines"), *[F.lit(name).alias(name) for name in own])
    got = line_dedup.dedup_lines(docs, min_documents=least)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *own, "n_lines", "n_dropped"]
    rows = got.collect()
    assert all(row[name] == name for row in rows for name in own)
    assert sorted((str(r.doc_id), r.text or "", r.n_lines, r.n_dropped) for r in rows) == plain_line_dedup(AWKWARD, least)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_urls(spark):
    urls = [
        None, "", "nothing", "http://a.com", "http://a.com/", "HTTP://Www.Example.COM/en/1?x=/", "https://example.com/en/", "http://b.net/es/x",
        "x://y://z.net/fr/1#a", "http://bad.org/p", "http://www.bad.org/p/?q", "http://bad.org/p2", "http://notcom/", "http://com/a",
    ]
    own = ["row", "address", "block", "q0", "w0", "possible", "listed", "listed_url"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").select("*", F.lit(1).alias("host"), *[F.lit(name).alias(name) for name in own])
    listed = spark.createDataFrame([("bad.org/p",), ("bad.org/p",), (None,), ("",)], "listed_url string")
    got = url_filter.judge_urls(pages, listed)
    assert got.columns == ["page_id", "url", *own, "host", "path", "rule", "verdict"]
    rows = {row.page_id: row for row in got.collect()}
    assert all(row[name] == name for row in rows.values() for name in own)
    assert len(rows) == len(urls)
    assert [rows[at].rule for at in range(len(urls))] == [
        None, None, None, None, "com/", "www.example.com/en/", "example.com/en/", "net/es/", None, None, None, None, None, "com/",
    ]
    assert rows[8].host == "y:" and rows[8].path == "//z.net/fr/1"
    assert [at for at in rows if rows[at].verdict == "block"] and {at for at in rows if rows[at].verdict == "block"} == {6, 7, 9, 10}
    assert {row.verdict for row in url_filter.judge_urls(pages, listed.limit(0)).filter("rule is null").collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0


def test_filter_passes_every_listed_url(spark):
    urls = spark.range(3000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("listed_url"))
    pages = urls.select(F.col("listed_url").alias("page_id"), F.concat(F.lit("http://"), F.col("listed_url")).alias("url"))
    assert url_filter.judge_urls(pages, urls).filter("verdict = 'block'").count() == 3000
    blocks = url_filter.filter_blocks(3000)
    assert blocks == 256 and url_filter.bloom_blocks(urls, blocks).count() <= blocks
    assert url_filter.filter_blocks(0) == 1 and 8 <= 10**7 / url_filter.filter_blocks(10**7) <= url_filter.PER_BLOCK


def test_filter_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 2)
    urls = spark.range(500).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("listed_url"))
    pages = spark.range(1000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id").cast("string")).alias("url"))
    assert url_filter.judge_urls(pages, urls).filter("verdict = 'block'").count() == 500


def plain_licenses(text):
    found = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    places = [(at, label) for at in range(len(found)) for label, phrase in license_scan.BASE if found[at : at + len(phrase.split())] == phrase.split()]
    return len(found), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({label for _, label in places}))


def test_licenses(spark):
    texts = [text for _, text in AWKWARD] + [
        "Licensed under CC BY-NC 4.0.", "cc-by cc by CC\nBY", "GNU General  Public License, all rights reserved; All Rights Reserved",
        "Released under the MIT License.", "the mit licence and by the way", "Licensed under the Apache License, Version 2.0.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "granted free of charge", "cc" * 30_000 + " cc by " + "by " * 30_000, "general public licenseé",
    ]
    docs = documents(spark, list(enumerate(texts))).withColumn("_row", F.lit(1)).withColumn("found", F.lit(1))
    rows = {row.doc_id: row for row in license_scan.scan_licenses(docs).collect()}
    for at, text in enumerate(texts):
        row = rows[at]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_licenses(text), text
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1
    first = len(AWKWARD)
    assert rows[first].labels == "cc-by,cc-by-nc-4.0" and rows[first + 3].labels == "mit" and rows[first + 5].labels == "apache-2.0"
    assert rows[first + 6].labels == "mit" and rows[first + 7].labels == "" and rows[first + 4].labels == ""
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0
    twice = license_scan.scan_licenses(docs.unionAll(docs))
    assert twice.count() == 2 * len(texts)


def test_licenses_of_several_notices_in_one_file(spark):
    notices = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "apache-2.0": "Licensed under the Apache License, Version 2.0",
        "mpl-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0",
    }
    texts = ["\n\n".join(notices.values()), *[notices["apache-2.0"]] * 30, *[notices["mpl-2.0"]] * 20, *["no notice"] * 30]
    rows = {row.doc_id: row for row in license_scan.scan_licenses(documents(spark, list(enumerate(texts)))).collect()}
    assert rows[0].labels == "apache-2.0,mit,mpl-2.0" and rows[1].labels == "apache-2.0" and rows[31].labels == "mpl-2.0" and rows[60].labels == ""


def test_license_sql_states_the_rule_of_the_code(spark, tmp_path):
    notices = [notice for _, notice, _ in license_scan.TEMPLATES]
    texts = [" ".join(notices[at:] + notices[:at]) for at in range(len(notices))] + notices + [notice[: len(notice) * 3 // 4] for notice in notices] + ["no notice"] * 9
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/written")
    for part in (tmp_path / "written").glob("*.parquet"):
        part.rename(tmp_path / part.name)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/*.parquet')")
    assert connection.execute("SELECT count(*) FROM documents").fetchone()[0] == len(texts)
    assert difference(spark, connection, lambda s, _: license_scan.scan_licenses(s.read.parquet(f"{tmp_path}/*.parquet")), license_scan.OP7_SQL, None) is None


def test_chat_roles_on_held_out_conversations(spark):
    spoken = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    transcripts = chat_format.as_transcripts(spoken)
    model = chat_format.learn(transcripts)
    got = chat_format.parse_transcripts(transcripts, model).select("conv_id", "turn", F.col("role").alias("got"))
    judged = spoken.filter(chat_format.held_out(F.col("conv_id"))).join(got, ["conv_id", "turn"], "left")
    right = judged.agg(F.avg((F.coalesce("got", F.lit("")) == F.col("role")).cast("double"))).first()[0]
    assert right > 0.95


def test_chat_chunks_equal_one_pass(spark):
    spoken = [(1, at, ("user", "assistant")[at % 2], f"{'Q: ' if at % 2 == 0 else 'A: '}line {at}\nmore" + "?" * (at % 2 == 0)) for at in range(300)]
    frame = spark.createDataFrame(spoken, "conv_id long, turn long, role string, text string")
    model = chat_format.learn(frame.withColumn("conv_id", F.explode(F.sequence(F.lit(1), F.lit(9)))))
    rows = sorted(chat_format.parse_transcripts(frame, model).collect(), key=lambda row: (row.turn, row.part))
    lines = chat_format.read_turns([{"text": text, "role": role} for _, _, role, text in spoken])
    states = model.decode([line[1] for line in lines])
    assert [row.role for row in rows for _ in range(row.n_lines)] == [chat_format.ROLES[state // 2] for state in states]
    assert rows[0].rendered == "<|user|>\nline 0\nmore?\n<|end|>"


def test_chat_result_does_not_depend_on_how_turns_are_numbered(spark):
    said = [(conv, at, ("user", "assistant")[at % 2], ("Human: " if at % 2 == 0 else "Assistant: ") * (at < 50) + f"line {at}") for conv in range(30) for at in range(100)]
    spread = [(conv, at * 1000 - 7, role, text) for conv, at, role, text in said]
    alike = [(conv, None if at < 40 else 5, role, f"{at:03d} {text}") for conv, at, role, text in said[:300]]
    schema = "conv_id long, turn long, role string, text string"
    model = chat_format.learn(spark.createDataFrame(said, schema))
    roles = []
    for rows in (said, spread):
        found = chat_format.parse_transcripts(spark.createDataFrame(rows, schema), model).collect()
        roles.append([(row.conv_id, row.role, row.n_lines) for row in sorted(found, key=lambda row: (row.conv_id, row.turn, row.part))])
    assert roles[0] == roles[1]
    chunks = chat_format._chunks(spark.createDataFrame(alike, schema), chat_format.CONTEXT)
    sizes = chunks.select(F.size("turns").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert sizes[0] <= chat_format.CHUNK + 2 * chat_format.CONTEXT and sizes[1] == 6


def test_chat_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "user", ""), (1, 2, None, "User: hi"), (1, 2, None, "User: hi"), (None, 1, "user", "x"), (2, None, "user", "Assistant: a\n\nUser: b"), (3, 5, "odd", "y" * 100_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit(7))
    got = chat_format.parse_transcripts(frame, chat_format.learn(frame)).collect()
    assert {row.conv_id for row in got} == {1, 2, 3} and sum(row.n_lines for row in got if row.conv_id == 1) == 1
    assert chat_format.parse_transcripts(frame.limit(0), chat_format.learn(frame.limit(0))).count() == 0


def test_digest_of_kept_text(spark):
    kept = line_dedup.dedup_lines(documents(spark, {1: "one line here\ntwo"}))
    assert kept.select(F.sha2("text", 256)).first()[0] == hashlib.sha256(b"one line here\ntwo").hexdigest()
