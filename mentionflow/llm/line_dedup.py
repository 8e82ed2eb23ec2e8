"""Drop lines that other documents hold too, with DataFrame operations only.

Lines are exploded once, normalised and hashed to 128 bits, and only numbers are kept of them. Per hash the distinct
documents are counted in two aggregations, both combined before their shuffle, so a line that stands in a third of all
documents is a few rows per task. The hashes over the threshold are stored and joined back to the lines on both halves
of the hash; the lines of a hot hash are split by adaptive execution. What comes of it is a list of positions per document,
from which the kept stretches are cut and joined in linear time.

Results: null and empty texts are one empty line; the line feed is the only separator; lines shorter than `min_chars`
never go; rows with the same id and the same text are treated alike, and rows with one id count as one document; a null
id counts as a document of its own that never holds the kept copy while another document has the line; an empty table
gives no rows; other columns are carried, `n_lines` and `n_dropped` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.llm.text import BLANKS, ascii_lower, carried, packed, whole
from mentionflow.session import staged

MIN_CHARS = 10
MIN_DOCUMENTS = 2


def _lines(text: Column) -> Column:
    return F.split(whole(text), "\n")


def _long_lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: document, text hash, position and the two halves of the key's hash."""
    found = documents.select("doc", "text_hash", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    keyed = found.select("doc", "text_hash", "at", F.btrim(ascii_lower(F.col("line")), F.lit(BLANKS)).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "doc", "text_hash", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")
    )


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Documents without their repeated lines, and how many lines each had and lost."""
    keys = (F.col("doc_id").alias("doc"), F.xxhash64(whole(F.col("text"))).alias("text_hash"))
    lines, _ = staged(_long_lines(documents.select(*keys, "text"), min_chars), "lines")
    # a null id is counted as one more document and left out of the minimum
    per_hash = lines.groupBy("h1", "h2").agg(
        (F.count_distinct("doc") + F.max(F.col("doc").isNull().cast("int"))).alias("held"), F.min("doc").alias("keeper")
    )
    # stored before the join: adaptive execution splits the lines of a hot hash only where both sides are plain shuffles
    repeated, _ = staged(per_hash.filter(F.col("held") >= min_documents).drop("held"), "repeated-lines")
    drops = (
        lines.join(repeated, ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "text_hash")
        .agg(F.sort_array(F.collect_set("at")).alias("gone"))
    )
    rows = documents.select(packed(documents), *keys)
    joined = rows.join(drops.withColumnsRenamed({"doc": "in_doc", "text_hash": "in_text"}), F.col("doc").eqNullSafe(F.col("in_doc")) & (F.col("text_hash") == F.col("in_text")), "left")
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    before = F.col("row.text")
    all_lines = _lines(before)
    starts = F.concat(F.array(F.lit(-1)), gone)
    ends = F.concat(gone, F.array(F.size(all_lines)))
    kept = F.flatten(F.zip_with(starts, ends, lambda start, end: F.slice(all_lines, start + 2, end - start - 1)))
    text = F.when(F.col("gone").isNull(), before).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *carried(documents, {"text": text}, without=("n_lines", "n_dropped")),
        F.size(all_lines).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the hash of what is kept, for every document."""
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(whole(F.col("text")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
), keyed AS (
    SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM lines
), repeated AS (
    SELECT key, min(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.*, coalesce(k.doc_id <> r.keeper, false) AS gone FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
