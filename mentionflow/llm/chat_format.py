"""Transcript parsing: a hidden Markov model recovers roles and turns, which are then rendered in one form.

States are role and position (first line of a turn, or a later one). A line is seen through its speaker marker, whether
a blank line stands before it, its closing question mark and its length. Emissions and transitions are smoothed counts
over all conversations whose roles are known and that are not held out. Viterbi runs per chunk of a conversation, so a
conversation of any length spreads over tasks; each chunk is decoded with the neighbouring `CONTEXT` turns on both sides,
where paths merge long before they reach it, and only its own lines count.

Results: lines are cut at the line feed; blank lines belong to no turn but are seen; null and empty texts give no turn;
null conversation ids are left out, null turns come first; repeated rows are one turn, different texts of one turn are
taken in their order; a chunk's first turn begins with the chunk; an empty table gives no rows. Without any training row
all states are alike likely and markers alone cannot be read, so every line becomes the first role's. The result has its
own columns only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionflow.llm.text import whole
from mentionflow.session import staged

ROLES = ("assistant", "system", "user")
CHUNK = 64
CONTEXT = 16
FOLDS = 5
#: Words by which transcripts mark a speaker, and the canonical form of a turn.
MARKERS = {
    "assistant": ("assistant", "ai", "bot", "a"),
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "q", "me"),
}
TURN = "<|{role}|>\n{text}\n<|end|>"
_SPEAKER = {word: role for role, words in MARKERS.items() for word in words}
_MARKER = re.compile(r"^\s*(?:#+\s*|\*\*|\[|<\|?)?([A-Za-z]{1,12})(?:\*\*|\]|\|?>)?\s*:\s*|^\s*(?:\[|<\|)([A-Za-z]{1,12})(?:\]|\|>)\s*")
_LENGTHS = (20, 80, 200)
_SYMBOLS = 4 * 2 * 2 * (len(_LENGTHS) + 1)
_STATES = 2 * len(ROLES)


def read_line(line: str, after_blank: bool) -> tuple[int, str]:
    """What the model sees of a line, as one number, and the line without its marker."""
    found = _MARKER.match(line)
    speaker = _SPEAKER.get((found[1] or found[2]).lower()) if found else None
    text = line[found.end() :] if speaker else line
    size = sum(len(text) > limit for limit in _LENGTHS)
    seen = ROLES.index(speaker) + 1 if speaker else 0
    return ((seen * 2 + after_blank) * 2 + text.rstrip().endswith("?")) * (len(_LENGTHS) + 1) + size, text


def read_turns(turns: list[dict]) -> list[tuple[int, int, str, str | None, bool]]:
    """The lines of some turns in order: number of the row, symbol, text, the row's role, and whether it is its first."""
    lines, blank = [], True
    for at, turn in enumerate(turns):
        first = True
        for line in (turn["text"] or "").split("\n"):
            if not line.strip():
                blank = True
                continue
            symbol, text = read_line(line, blank)
            lines.append((at, symbol, text, turn["role"], first))
            blank = first = False
    return lines


class Model:
    """Log probabilities from counts, each count one higher than seen."""

    def __init__(self, emitted: dict[tuple[int, int], int], moved: dict[tuple[int, int], int]) -> None:
        emission, move = np.ones((_STATES, _SYMBOLS)), np.ones((_STATES + 1, _STATES))
        for (state, symbol), count in emitted.items():
            emission[state, symbol] += count
        for (before, state), count in moved.items():
            move[before, state] += count
        self.emission = np.log(emission / emission.sum(1, keepdims=True))
        self.move = np.log(move / move.sum(1, keepdims=True))

    def decode(self, symbols: list[int]) -> list[int]:
        """The most likely states; among equals the first."""
        score = self.move[_STATES] + self.emission[:, symbols[0]]
        back = []
        for symbol in symbols[1:]:
            paths = score[:, None] + self.move[:_STATES]
            best = paths.argmax(0)
            back.append(best)
            score = paths[best, np.arange(_STATES)] + self.emission[:, symbol]
        states = [int(score.argmax())]
        for best in reversed(back):
            states.append(int(best[states[-1]]))
        return states[::-1]


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with `rank`, their place in their conversation from zero, without gathering a conversation.

    Rows are range-partitioned in order and counted per partition and conversation; a rank is the place within the
    partition plus the counts of the partitions before.
    """
    order = ("conv_id", "turn", "text", "role")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    # the lower 33 bits of that id count the rows of a partition, the others number the partitions
    numbered, _ = staged(dealt.withColumn("part", F.shiftright("row", 33)), "ordered-turns")
    counts = numbered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts, _ = staged(counts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "turn-counts")
    rank = F.col("row") - F.col("first") + F.col("before")
    return numbered.join(counts, ["conv_id", "part"]).select(*order, rank.alias("rank"))


def _chunks(transcripts: DataFrame, context: int) -> DataFrame:
    """Rows of `conv_id`, `chunk` and its turns in order; a turn near a border is also context of the next chunk.

    Chunks are cut by a turn's rank, so they have `CHUNK` turns however these are numbered.
    """
    rows = transcripts.select(F.col("conv_id").cast("long"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), "role", whole(F.col("text")).alias("text"))
    rows, _ = staged(rows.filter(F.col("conv_id").isNotNull()).distinct(), "turns")
    rows = _ranked(rows)
    low, high = F.floor((F.col("rank") - context) / CHUNK), F.floor((F.col("rank") + context) / CHUNK)
    rows = rows.withColumn("chunk", F.explode(F.sequence(low, high)))
    rows = rows.withColumn("own", F.floor(F.col("rank") / CHUNK) == F.col("chunk"))
    grouped = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("rank", "turn", "text", "role", "own"))).alias("turns"))
    return grouped.filter(F.exists("turns", lambda turn: turn["own"]))


def held_out(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % FOLDS == 0


def learn(transcripts: DataFrame) -> Model:
    """Count states, symbols and moves over all transcripts with known roles outside the held-out fold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emission, move = np.zeros((_STATES, _SYMBOLS), np.int64), np.zeros((_STATES + 1, _STATES), np.int64)
        for batch in batches:
            for turns in batch.column(0):
                before = _STATES
                for _, symbol, _, role, first in read_turns(turns.as_py()):
                    if role not in ROLES:
                        before = _STATES
                        continue
                    state = 2 * ROLES.index(role) + (not first)
                    emission[state, symbol] += 1
                    move[before, state] += 1
                    before = state
        for kind, table in enumerate((emission, move)):
            a, b = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind)), pa.array(a), pa.array(b), pa.array(table[a, b])], ["kind", "a", "b", "n"])

    known = _chunks(transcripts.filter(~held_out(F.col("conv_id"))), 0).select("turns")
    counted = known.mapInArrow(work, "kind long, a long, b long, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    rows = counted.collect()  # at most states x symbols and states x states rows
    tables = [{(row["a"], row["b"]): row["n"] for row in rows if row["kind"] == kind} for kind in (0, 1)]
    return Model(*tables)


def parse_transcripts(transcripts: DataFrame, model: Model) -> DataFrame:
    """One row per recovered turn: where it begins, its role, how many lines it has, and its canonical form.

    `transcripts` has `conv_id`, `turn` (the order of its pieces) and `text`; its `role` is not looked at.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = turns.as_py()
                lines = read_turns(rows)
                if not lines:
                    continue
                states = model.decode([line[1] for line in lines])
                kept = [(line, state) for line, state in zip(lines, states) if rows[line[0]]["own"]]
                number = 0
                marks = []
                for at, (_, state) in enumerate(kept):
                    number += at > 0 and (state % 2 == 0 or state // 2 != kept[at - 1][1] // 2)
                    marks.append(number)
                for number, members in groupby(range(len(kept)), key=marks.__getitem__):
                    at = list(members)
                    role = ROLES[kept[at[0]][1] // 2]
                    text = "\n".join(kept[one][0][2] for one in at)
                    out.append((conv_id, rows[kept[at[0]][0][0]]["turn"], number, role, len(at), TURN.format(role=role, text=text)))
            columns = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)], ["conv_id", "turn", "part", "role", "n_lines", "rendered"])

    chunks = _chunks(transcripts.withColumn("role", F.lit("")), CONTEXT).select("conv_id", "turns")
    return chunks.mapInArrow(work, "conv_id long, turn long, part long, role string, n_lines long, rendered string")


def as_transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts of several styles, some of which mark only some speakers; `role` stays for learning."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    name = F.initcap("role")
    marker = (
        F.when(style == 0, F.concat(name, F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), F.when(F.col("role") == "user", "Human").otherwise(name), F.lit(": ")))
        .when(style == 2, F.concat(F.lit("["), F.lower("role"), F.lit("] ")))
        .when(F.col("turn") % 3 != 2, F.concat(F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise(name), F.lit(": ")))
        .otherwise(F.lit("\n"))
    )
    return conversations.select("conv_id", "turn", "role", F.concat(F.coalesce(marker, F.lit("")), whole(F.col("text"))).alias("text"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recovered turns of all `conversations`, written as transcripts first."""
    transcripts = as_transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return parse_transcripts(transcripts, learn(transcripts))
