"""Licence scan by a positional index of rare words, with DataFrame operations only.

Each file is read once: its words are counted, the words it shares with the templates are noted for the statistics, and
only files with a word that every template needs keep the positions of template words. Document frequencies, counted
over all files, rank the words; each template's highest-IDF words in a file propose its alignments (template, start =
position - relative position), so that notices do not displace one another; the template's other words support them, and an alignment counts when its mandatory phrase stands
complete and the words in place carry enough of the template's weight. The index is a constant of the templates and is
broadcast; grouping is by file and alignment, never by word.

Results: null and empty texts have no words, labels or places and score 0; places may overlap; repeated rows are scanned
one by one; files of any length are scanned whole; an empty table gives no rows. The result has the file's id and the
columns of the contract only, so input columns cannot clash.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.llm.text import ascii_lower, whole
from mentionflow.session import staged

#: Phrases that make a base label, whole and in place.
BASE = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

#: Fixed values: (label, words of the notice, mandatory phrase in it).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)

#: Words of the highest IDF of a template in a file that propose its alignments, and the share of a template's weight that must stand.
RARE_WORDS = 8
MIN_SHARE = 0.75
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _postings() -> list[dict]:
    """One row per template word: template number, relative position, whether it is mandatory, and sizes."""
    rows = []
    for number, (label, notice, phrase) in enumerate([(label, phrase, phrase) for label, phrase in BASE] + list(TEMPLATES)):
        words, key = notice.split(), phrase.split()
        first = next(at for at in range(len(words)) if words[at : at + len(key)] == key)
        for at, word in enumerate(words):
            rows.append({"word": word, "template": number, "rel": at, "needed": first <= at < first + len(key), "keys": len(key), "label": label, "base": number < len(BASE)})
    return rows


def _anchors() -> list[str]:
    """A word of every mandatory phrase: a file without any of them holds none of the phrases."""
    common = {"a", "all", "and", "any", "by", "for", "in", "is", "of", "or", "the", "to", "2", "3", "with", "free", "fee", "forms"}
    phrases = [phrase for _, phrase in BASE] + [phrase for _, _, phrase in TEMPLATES]
    return sorted({max((word for word in phrase.split() if word not in common), key=len) for phrase in phrases})


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(word) for word in words])


def _scanned(documents: DataFrame) -> DataFrame:
    """`_row`, `doc_id`, `n_words`, the distinct template words, and their positions where the file has an anchor."""
    vocabulary = _strings(sorted({row["word"] for row in _postings()}))
    line = F.btrim(F.regexp_replace(ascii_lower(whole(F.col("text"))), _GAP, " "), F.lit(" "))
    words = F.split(F.col("_line"), " ")
    located = F.filter(F.transform(words, lambda word, at: F.struct(word.alias("word"), at.alias("at"))), lambda hit: F.array_contains(vocabulary, hit["word"]))
    empty = F.array().cast("array<struct<word:string,at:int>>")
    return (
        documents.select(F.monotonically_increasing_id().alias("_row"), "doc_id", line.alias("_line"))
        .select("_row", "doc_id", F.when(F.col("_line") == "", 0).otherwise(F.size(words)).cast("long").alias("n_words"), "_line")
        .select(
            "_row",
            "doc_id",
            "n_words",
            F.array_intersect(vocabulary, words).alias("own"),
            F.when(F.arrays_overlap(words, _strings(_anchors())), located).otherwise(empty).alias("found"),
        )
    )


def scan_licenses(documents: DataFrame, rare_words: int = RARE_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """Word count, base places and licence labels of every document."""
    spark = documents.sparkSession
    scanned, _ = staged(_scanned(documents), "licence-words")
    counted = scanned.select(F.explode("own").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    held = {row["word"]: row["n"] for row in counted.collect()}  # at most one row per template word
    files = scanned.count()
    postings = [row | {"idf": math.log1p(files / (1 + held.get(row["word"], 0)))} for row in _postings()]
    wholes: dict[int, float] = {}
    for row in postings:
        wholes[row["template"]] = wholes.get(row["template"], 0.0) + row["idf"]
    postings = [row | {"whole": wholes[row["template"]]} for row in postings]
    ranked: dict[int, set[tuple[float, str]]] = {}
    for row in postings:
        ranked.setdefault(row["template"], set()).add((-row["idf"], row["word"]))
    postings = [row | {"ranked": [word for _, word in sorted(ranked[row["template"]])]} for row in postings]
    fields = "word:string,ranked:array<string>,template:int,rel:int,needed:boolean,keys:int,label:string,base:boolean,idf:double,whole:double"
    index = spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(json.dumps(postings)), f"array<struct<{fields}>>")))

    hits = scanned.filter(F.size("found") > 0).select("_row", "own", F.explode("found").alias("hit")).select("_row", "own", "hit.word", "hit.at")
    rare = F.array_contains(F.slice(F.array_intersect("ranked", "own"), 1, rare_words), F.col("word"))
    aligned = hits.join(F.broadcast(index), "word").withColumn("rare", rare).withColumn("start", F.col("at") - F.col("rel"))
    aligned = aligned.drop("ranked", "own")
    places = aligned.groupBy("_row", "template", "start", "label", "base", "keys", "whole").agg(
        F.count_if("rare").alias("rare"), F.count_if("needed").alias("stand"), F.sum("idf").alias("weight")
    )
    places = places.withColumn("share", F.least(F.col("weight") / F.col("whole"), F.lit(1.0)))
    sure = places.filter((F.col("stand") == F.col("keys")) & (F.col("base") | ((F.col("rare") > 0) & (F.col("share") >= min_share))))
    base_start = F.when(F.col("base"), F.col("start"))
    per_file = sure.groupBy("_row").agg(
        F.count_if("base").alias("n_base"),
        F.min(base_start).cast("long").alias("first_word"),
        F.max(base_start).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max(F.when(F.col("base"), F.lit(1.0)).otherwise(F.col("share"))).alias("score"),
    )
    return scanned.join(per_file, "_row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places and labels of every document."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("score", F.round("score", 6))


_INDEX_SQL = ", ".join(
    f"('{row['word']}', {row['template']}, {row['rel']}, {row['needed']}, {row['keys']}, '{row['label']}', {row['base']})" for row in _postings()
)

OP7_SQL = rf"""
WITH files AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), postings(word, template, rel, needed, keys, label, base) AS (
    VALUES {_INDEX_SQL}
), places AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM files
), own AS (
    SELECT DISTINCT doc_id, word FROM places WHERE word IN (SELECT word FROM postings)
), idf AS (
    SELECT word, ln(1 + CAST((SELECT count(*) FROM files) AS DOUBLE) / (1 + count(own.doc_id))) AS idf
    FROM (SELECT DISTINCT word FROM postings) LEFT JOIN own USING (word) GROUP BY word
), weighed AS (
    SELECT p.*, idf, sum(idf) OVER (PARTITION BY template) AS whole FROM postings p JOIN idf USING (word)
), ranked AS (
    SELECT doc_id, template, word, row_number() OVER (PARTITION BY doc_id, template ORDER BY idf DESC, word) <= {RARE_WORDS} AS rare
    FROM own JOIN (SELECT DISTINCT template, word FROM postings) USING (word) JOIN idf USING (word)
), aligned AS (
    SELECT doc_id, template, place - rel AS start, label, base, keys,
           count(*) FILTER (WHERE rare) AS rare, count(*) FILTER (WHERE needed) AS stand,
           least(sum(idf) / whole, 1) AS share
    FROM places JOIN ranked USING (doc_id, word) JOIN weighed USING (template, word)
    GROUP BY doc_id, template, start, label, base, keys, whole
), sure AS (
    SELECT * FROM aligned WHERE stand = keys AND (base OR rare > 0 AND share >= {MIN_SHARE})
), labelled AS (
    SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
           max(start) FILTER (WHERE base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
           max(CASE WHEN base THEN CAST(1 AS DOUBLE) ELSE share END) AS score
    FROM sure GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, CAST(0 AS DOUBLE)), 6) AS score
FROM files LEFT JOIN labelled USING (doc_id)
"""
