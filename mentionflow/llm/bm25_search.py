"""Exact top-k search: BM25 over sharded inverted indexes with block-max pruning.

Each task turns its documents into shards of at most `SHARD` documents: term hashes, postings in document order, term
counts and lengths. Within a shard documents are numbered so that those of like vocabulary stand together, and divided
there into blocks of at most `BLOCK`; so the maxima of a block stay close to its members, and the terms that are common in
it are those of its own vocabulary. Document frequencies and the mean length are summed over all shards, so every shard
scores by global statistics.

The stated query set is worked off in blocks of bounded size, broadcast one after the other. Each query is first answered
by one shard alone, of as many shards as there are tasks; its k-th score there is a floor under the k-th score of all.
Then every shard answers all queries: a block of documents is opened where the maxima of the query's terms in it add up
to the floor. What the common terms of open blocks give is added up in single precision, for many queries together; with
it more blocks close, the postings of the rare terms are added, and the documents that may be among the best are then
scored exactly. (Queries are whole documents, of hundreds of terms; a pivot within a block would have to look at as many
maxima as there are postings, so the blocks are the step of the pivot.) A block or document is passed over only where it
falls short by more than rounding, so the answers merged over the shards are those of scoring every document.

Results: words are runs of letters and digits, lower-cased; a query is a whole text, a term counts as often as it stands
in it; the query's own id is no candidate; documents that share no term are not returned; null and empty texts find
nothing; ties go to the smaller id; repeated ids are candidates of their own; an empty table gives no rows. Terms are
compared by 64-bit hashes. The result has its own four columns only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionflow.session import staged

K1, B = 1.2, 0.75
TOP = 10
QUERY_STEP = 50
SHARD = 16384  # at most 65536: documents are numbered by 16 bits
BLOCK = 4096
#: Query rows (one per query and term) that are broadcast at a time: some 35 MB. Every shard is made ready once for them.
QUERY_ROWS = 2_400_000
#: Terms held by one document of a block in so many are kept as rows over the documents of the block, at most `MOST_COMMON`
#: of them; queries look them up together, `TOGETHER` at a time. This changes speed alone, as does the number of terms
#: that documents are put in order by, of documents that tell the direction, and how far a part must fall into two.
COMMON_SHARE, MOST_COMMON, TOGETHER = 14, 1024, 128
ORDER_TERMS, ORDER_SAMPLE, APART = 256, 2048, 0.85
#: Scores are rounded to so many decimals, so that equal texts tie whatever the order of addition was.
DECIMALS, SLACK = 8, 1e-7
_WORD = re.compile(r"[^\W_]+")
#: Characters beyond ASCII that are no part of a word; and ASCII in lower case, with blanks for what is no part of a word.
_FOREIGN = re.compile(r"[^\w\x00-\x7f]")
_ASCII = bytes(byte if byte >= 128 else ord(chr(byte).lower()) if chr(byte).isalnum() else 32 for byte in range(256))
_SHARD_COLUMNS = "key long, ids binary, lengths binary, terms binary, starts binary, docs binary, counts binary, cuts binary"


def _terms(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Term hashes of a text in ascending order, how often each stands in it, and its number of words."""
    text = text or ""
    plain = text.isascii()
    text = text if plain else text.lower()
    words = text.encode().translate(_ASCII).split() if plain or not _FOREIGN.search(text) else _WORD.findall(text)
    counts = Counter(words)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, counts)), ">u8").astype(np.uint64)
    terms = (hashes ^ np.uint64(1 << 63)).view(np.int64)  # in the same order, signed
    order = np.argsort(terms)
    return terms[order], np.fromiter(counts.values(), np.int32, len(counts))[order], len(words)


def _halves(holds: np.ndarray) -> tuple[np.ndarray, int, float]:
    """An order of rows along their main direction, where they fall into two parts, and the parts' share of the spread."""
    sample = holds[:: -(-len(holds) // ORDER_SAMPLE)]
    sample = sample - sample.mean(0)
    axis = np.linalg.eigh(sample.T @ sample)[1][:, -1] if holds.shape[1] else np.zeros(0, np.float32)
    along = (holds @ axis).astype(np.float64)
    order = np.argsort(along, kind="stable")
    along = along[order] - along.mean()
    least = max(1, len(along) // 16)
    sizes = np.arange(least, len(along) - least + 1)
    between = np.cumsum(along)[sizes - 1] ** 2 / (sizes * (len(along) - sizes)) * len(along)
    at = int(between.argmax())
    total = float(along @ along)
    return order, int(sizes[at]), float(between[at]) / total if total > 0 else 0.0


def _alike(found: list[tuple[np.ndarray, np.ndarray, int]], block: int) -> tuple[np.ndarray, list[int]]:
    """An order of documents in which those that hold the same common terms stand together, and where its blocks begin.

    Documents are divided in two along the main direction of those terms, and the parts again, until they have the size
    of a block; a part that plainly consists of two is divided further.
    """
    terms = np.concatenate([own[0] for own in found])
    docs = np.repeat(np.arange(len(found), dtype=np.int32), [len(own[0]) for own in found])
    order = np.argsort(terms).astype(np.int32)
    starts = np.flatnonzero(np.r_[True, np.diff(terms[order]) != 0, True]) if len(terms) else np.zeros(1, np.int64)
    del terms
    common = np.argsort(-np.diff(starts), kind="stable")[:ORDER_TERMS].tolist()
    holds = np.zeros((len(found), len(common)), np.float32)
    for column, term in enumerate(common):
        holds[docs[order[starts[term] : starts[term + 1]]], column] = 1
    del docs, order
    left, done, cuts = [np.arange(len(found))], [], [0]
    while left:
        part = left.pop()
        if len(part) > max(1, block // 4):
            along, cut, apart = _halves(holds[part])
            if len(part) > block and apart == 0:
                along, cut = np.arange(len(part)), block
            if len(part) > block or apart > APART:
                left += [part[along[cut:]], part[along[:cut]]]
                continue
        done.append(part)
        cuts.append(cuts[-1] + len(part))
    return np.concatenate(done), cuts


def _shards(batches: Iterator[pa.RecordBatch], size: int = SHARD, block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    ids: list[int] = []
    found: list[tuple[np.ndarray, np.ndarray, int]] = []

    def shard() -> pa.RecordBatch:
        order, cuts = _alike(found, block)
        order = order.tolist()
        ids[:], found[:] = [ids[at] for at in order], [found[at] for at in order]
        terms = np.concatenate([own[0] for own in found])
        docs = np.repeat(np.arange(len(found), dtype=np.int32), [len(own[0]) for own in found])
        order = np.argsort(terms, kind="stable")
        terms, counts = terms[order], np.concatenate([own[1] for own in found])[order]
        new = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
        parts = (
            np.array(ids, np.int64),
            np.array([own[2] for own in found], np.int32),
            terms[new],
            np.r_[new, len(terms)].astype(np.int32),
            docs[order].astype(np.uint16),
            counts if len(counts) and counts.max() >= 1 << 16 else counts.astype(np.uint16),
            np.array(cuts, np.int32),
        )
        names = [column.split()[0] for column in _SHARD_COLUMNS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([min(ids)]), *(pa.array([part.tobytes()], pa.binary()) for part in parts)], names)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if doc_id is None:
                continue
            ids.append(doc_id)
            found.append(_terms(text.as_py()))
            if len(found) == size:
                yield shard()
                ids, found = [], []
    if found:
        yield shard()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, starts in zip(batch.column(0), batch.column(1)):
            held = np.diff(np.frombuffer(starts.as_py(), np.int32)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms.as_py(), np.int64)), pa.array(held)], ["term", "n"])


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            terms, counts, _ = _terms(text.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), doc_id)), pa.array(terms), pa.array(counts)], ["query_id", "term", "times"])


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of some ranges, one range after the other."""
    sizes = ends - starts
    jumps = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    jumps += np.arange(len(jumps))
    return jumps


class Shard:
    """One shard with the block maxima of its postings.

    The postings of a term in a block are an entry. Entries of common terms are kept as rows over the block's documents,
    the postings of all others in order of term.
    """

    def __init__(self, row: dict, mean_length: float, block: int = BLOCK) -> None:
        self.key = row["key"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.int64)
        starts = np.frombuffer(row["starts"], np.int32)
        docs = np.frombuffer(row["docs"], np.uint16)
        counts = np.frombuffer(row["counts"], np.uint16 if len(row["counts"]) == len(row["docs"]) else np.int32)
        self.norms = K1 * (1 - B + B * np.frombuffer(row["lengths"], np.int32) / max(mean_length, 1e-9))
        cuts = np.frombuffer(row["cuts"], np.int32).tolist()
        self.cuts = np.array([0, *(min(at + block, high) for low, high in zip(cuts, cuts[1:]) for at in range(low, high, block))])
        sizes = np.diff(self.cuts)
        self.blocks = len(sizes)
        impacts = self.norms[docs]
        impacts += counts
        np.divide(counts * (K1 + 1), impacts, out=impacts)
        blocks = np.repeat(np.arange(self.blocks, dtype=np.uint16), sizes)[docs]
        new = np.r_[True, blocks[1:] != blocks[:-1]] if len(blocks) else np.zeros(0, bool)
        new[starts[:-1]] = True
        entry_starts = np.r_[np.flatnonzero(new), len(blocks)].astype(np.int32)
        self.entry_blocks = blocks[entry_starts[:-1]]
        del new, blocks
        most = np.maximum.reduceat(impacts, entry_starts[:-1]) if len(docs) else np.zeros(0)
        self.entry_most = np.nextafter(most.astype(np.float32), np.float32(np.inf))  # rounded up, so it stays a bound
        self.term_entries = np.searchsorted(entry_starts, starts).astype(np.int32)
        self.opened = self.asked = 0
        held = np.diff(entry_starts)
        frequent = np.flatnonzero(held * COMMON_SHARE >= sizes.take(self.entry_blocks))
        frequent = frequent[np.lexsort((-held[frequent], self.entry_blocks[frequent]))]
        chosen = [own[:MOST_COMMON] for own in np.split(frequent, np.searchsorted(self.entry_blocks[frequent], np.arange(1, self.blocks)))]
        self.common = np.full(len(held), -1, np.int32)
        #: Impacts rounded, with the counts they follow from beside them; block by block, and in each term by term.
        self.common_impacts = np.zeros(sum(len(own) * size for own, size in zip(chosen, sizes.tolist())), np.float32)
        self.common_counts = np.zeros(self.common_impacts.shape, counts.dtype)
        self.rows: list[tuple[slice, slice, np.ndarray, np.ndarray]] = []
        first = column = 0
        for own, low, size in zip(chosen, self.cuts.tolist(), sizes.tolist()):
            self.common[own] = np.arange(column, column + len(own))
            last = first + len(own) * size
            values, times = self.common_impacts[first:last], self.common_counts[first:last]
            postings = _spans(entry_starts[own], entry_starts[own + 1])
            at = np.repeat(np.arange(len(own)) * size - low, held[own])
            at += docs.take(postings)
            values[at], times[at] = impacts.take(postings), counts.take(postings)
            self.rows.append((slice(low, low + size), slice(column, column + len(own)), values.reshape(len(own), size), times.reshape(len(own), size)))
            first, column = last, column + len(own)
        self.columns = column
        rare = np.flatnonzero(np.repeat(self.common < 0, held))
        self.counts = counts[rare]
        #: Document and rounded impact side by side, so that both are read at once.
        self.postings = np.empty((len(rare), 2), np.uint32)
        self.postings[:, 0] = impacts[rare].astype(np.float32).view(np.uint32)
        self.postings[:, 1] = docs[rare]
        self.number = np.full(len(self.ids), -1, np.int32)
        self.rare_entries = np.r_[0, np.cumsum(held * (self.common < 0))].astype(np.int32)
        self.rare_terms = self.rare_entries[self.term_entries]

    def where(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of some terms in this shard, -1 for those it does not hold."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        at[self.terms[at] != terms] = -1
        return at

    def _entries(self, rows: np.ndarray, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
        """Entries of the terms of some queries, with query, weight and block."""
        low = self.term_entries[at]
        sizes = self.term_entries[at + 1] - low
        entries = _spans(low, low + sizes)
        return entries, np.repeat(rows, sizes), np.repeat(weights, sizes), self.entry_blocks.take(entries)

    def likeliest(self, rows: np.ndarray, at: np.ndarray, weights: np.ndarray, queries: int) -> np.ndarray:
        """The block in which each of some queries may score most."""
        if not self.blocks:
            return np.zeros(queries, np.int64)
        here = np.flatnonzero(at >= 0)
        entries, rows, weights, blocks = self._entries(rows[here], at[here], weights[here])
        bounds = np.bincount(rows * self.blocks + blocks, weights * self.entry_most.take(entries), queries * self.blocks)
        return bounds.reshape(queries, self.blocks).argmax(1)

    def best(self, queries: list[tuple[int, int, np.ndarray, np.ndarray]], floors: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Query number, ids and scores of the `top` documents, best first, that reach a query's floor.

        Queries are given as number, id, terms and weights.
        """
        numbers, ids, terms, weights = zip(*queries)
        rows = np.repeat(np.arange(len(queries)), [len(own) for own in terms])
        for at, ids, scores in self.answer(np.array(ids), rows, self.where(np.concatenate(terms)), np.concatenate(weights), floors, top):
            yield numbers[at], ids, scores

    def answer(self, query_ids: np.ndarray, rows: np.ndarray, at: np.ndarray, weights: np.ndarray, floors: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Query, ids and scores for those of some queries that find any; their terms come by query, as numbers in this shard.

        What the common terms give in open blocks is added up in single precision, for all the queries together. With it,
        blocks are closed whose best document falls short even with the maxima of the rare terms. The postings of those are
        added for the queries left, and documents are picked that may be among the best; their scores are exact.
        """
        here = np.flatnonzero(at >= 0)
        rows, at, weights = rows[here], at[here], weights[here]
        entries, entry_rows, entry_weights, entry_blocks = self._entries(rows, at, weights)
        columns = self.common.take(entries)
        own = np.flatnonzero(columns >= 0)
        table = np.zeros((len(query_ids), self.columns))
        table[entry_rows[own], columns[own]] = entry_weights[own]
        bounds = np.zeros((2, len(query_ids), self.blocks))  # of common and of rare terms
        places = (columns < 0) * (len(query_ids) * self.blocks) + entry_rows * self.blocks + entry_blocks
        bounds.ravel()[:] = np.bincount(places, entry_weights * self.entry_most.take(entries), bounds.size)
        rounded, least = table.astype(np.float32), floors - SLACK
        opened = (bounds.sum(0) >= least[:, None]) & (bounds.sum(0) > 0)
        self.opened += int(opened.sum())
        self.asked += opened.size
        common = np.zeros((len(query_ids), len(self.ids)), np.float32)
        slack = np.full(len(query_ids), SLACK)
        for block, (docs, own, impacts, _) in enumerate(self.rows):
            mine = np.flatnonzero(opened[:, block])
            given = rounded[mine, own]
            used = np.flatnonzero(given.any(0))
            if 4 * len(used) < 3 * len(impacts):
                given, impacts = given[:, used], impacts[used]
            if not given.size:
                most = np.zeros(len(mine))
            else:
                found = given @ impacts
                common[mine, docs] = found
                most = found.max(1).astype(np.float64)
            # how far a sum of rounded products may be from the exact one
            slack[mine] = np.maximum(slack[mine], SLACK + (len(used) + 8) * 2.0**-23 * most)
            opened[mine, block] = most + bounds[1, mine, block] + slack[mine] >= floors[mine]
        slack += 2.0**-23 * bounds[1].max(1, initial=0)
        term_cuts, entry_cuts = (np.searchsorted(own, np.arange(len(query_ids) + 1)).tolist() for own in (rows, entry_rows))
        few = 2 * opened.sum(1) <= self.blocks
        packed = self.postings.view(np.uint64).ravel()
        for row in np.flatnonzero(opened.any(1)).tolist():
            if few[row]:
                part = slice(entry_cuts[row], entry_cuts[row + 1])
                own = np.flatnonzero(opened[row][entry_blocks[part]])
                asked, given, runs = entries[part][own], entry_weights[part][own], self.rare_entries
            else:
                part = slice(term_cuts[row], term_cuts[row + 1])
                asked, given, runs = at[part], weights[part], self.rare_terms
            starts = runs[asked]
            sizes = runs[asked + 1] - starts
            places = _spans(starts, starts + sizes)
            found, given = packed.take(places), np.repeat(given, sizes)
            holders = (found >> np.uint64(32)).view(np.int64)
            scores = common[row] + np.bincount(holders, found.view(np.float32)[::2] * given, len(self.ids))
            docs = np.flatnonzero(scores >= max(floors[row] - slack[row], 1e-300))
            docs = docs[self.ids[docs] != query_ids[row]]
            if len(docs) > 4 * top:
                rough = scores[docs]
                docs = docs[rough >= np.partition(rough, len(docs) - top)[len(docs) - top] - 2 * slack[row]]
            if not len(docs):
                continue
            exact = self._common(table[row], docs) + self._rare(places, holders, given, docs)
            docs, exact = docs[exact >= floors[row] - SLACK], exact[exact >= floors[row] - SLACK]
            exact = np.round(exact, DECIMALS)
            best = np.lexsort((self.ids[docs], -exact))[:top]
            if len(best):
                yield row, self.ids[docs[best]], exact[best]

    def _common(self, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """What the common terms give to some documents, exactly."""
        given = np.zeros(len(docs))
        edges = np.searchsorted(docs, self.cuts)
        for block in np.flatnonzero(np.diff(edges)).tolist():
            own, columns, _, times = self.rows[block]
            mine, asked = docs[edges[block] : edges[block + 1]], weights[columns]
            held = np.flatnonzero(asked)
            counts = times[held[:, None], mine - own.start].astype(np.float64)
            given[edges[block] : edges[block + 1]] = asked[held] @ (counts * (K1 + 1) / (self.norms[mine] + counts))
        return given

    def _rare(self, places: np.ndarray, holders: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """What some postings of rare terms, with the documents they are of, give to some documents, exactly."""
        self.number[docs] = np.arange(len(docs))
        mine = self.number.take(holders)
        self.number[docs] = -1
        own = np.flatnonzero(mine >= 0)
        mine, counts = mine[own], self.counts[places[own]].astype(np.float64)
        return np.bincount(mine, weights[own] * (counts * (K1 + 1) / (self.norms[docs[mine]] + counts)), len(docs))


_ANSWERS = "query_id long, doc_id long, score double, opened long, asked long"


def _answers(block: tuple[np.ndarray, ...], mean_length: float, top: int, block_size: int, keys: np.ndarray | None = None):
    """Answer one block of queries, as `_query_block` gives it, with each query's floor.

    A task keeps the best of its shards so far, which raises the floors for the next ones, and returns them once. With
    `keys`, the shards' keys, every query is answered by one shard only.
    """
    queries, cuts, terms, numbers, weights, floors = block

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = floors.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        order = None
        opened = looked = 0
        for batch in batches:
            for row in range(batch.num_rows):
                values = {name: batch.column(at)[row] for at, name in enumerate(batch.schema.names)}
                shard = Shard({name: value.as_py() if name == "key" else value.as_buffer() for name, value in values.items()}, mean_length, block_size)
                where = shard.where(terms)
                if order is None:  # queries that open the same blocks are scored together
                    parts = [np.arange(first, min(first + TOGETHER, len(queries))) for first in range(0, len(queries), TOGETHER)]
                    likeliest = [shard.likeliest(*_asked(part, cuts, where, numbers, weights), len(part)) for part in parts]
                    order = np.lexsort((np.diff(cuts), np.concatenate(likeliest)))
                mine = order if keys is None else order[keys[order % len(keys)] == shard.key]
                for first in range(0, len(mine), TOGETHER):
                    part = mine[first : first + TOGETHER]
                    found = shard.answer(queries[part], *_asked(part, cuts, where, numbers, weights), reached[part], top)
                    for at, ids, scores in found:
                        at = int(part[at])
                        if at in best:
                            ids, scores = np.concatenate([best[at][0], ids]), np.concatenate([best[at][1], scores])
                            ranked = np.lexsort((ids, -scores))[:top]
                            ids, scores = ids[ranked], scores[ranked]
                        best[at] = ids, scores
                        if len(ids) == top:
                            reached[at] = max(reached[at], scores[-1])
                opened, looked = opened + shard.opened, looked + shard.asked
                del shard, values
        if best:
            sizes = [len(ids) for ids, _ in best.values()]
            blocks = np.zeros((2, sum(sizes)), np.int64)
            blocks[:, :1] = [[opened], [looked]]  # for the share of opened blocks, summed over rows
            columns = [
                np.repeat([queries[at] for at in best], sizes).astype(np.int64),
                np.concatenate([ids for ids, _ in best.values()]),
                np.concatenate([scores for _, scores in best.values()]),
                *blocks,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["query_id", "doc_id", "score", "opened", "asked"])

    return work


def _asked(part: np.ndarray, cuts: np.ndarray, where: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows of some queries: the query's number among them, the term's in a shard, and the weight."""
    rows = _spans(cuts[part], cuts[part + 1])
    return np.repeat(np.arange(len(part)), cuts[part + 1] - cuts[part]), where[numbers[rows]], weights[rows]


def _query_block(weighted: DataFrame, at: int, blocks: int) -> tuple[np.ndarray, ...] | None:
    """One block of queries on the driver, about `QUERY_ROWS` rows of three numbers; repeated query rows are one query.

    Returns the queries' ids, where the rows of each begin, the terms asked for, and for each row its term's number among
    these and its weight.
    """
    table = weighted.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == at).toArrow()
    queries, terms, weights = (table.column(name).to_numpy() for name in ("query_id", "term", "weight"))
    order = np.lexsort((terms, queries))
    if not len(order):
        return None
    order = order[np.r_[True, (np.diff(queries[order]) != 0) | (np.diff(terms[order]) != 0)]]
    queries, weights = queries[order], weights[order]
    terms, numbers = np.unique(terms[order], return_inverse=True)
    new = np.flatnonzero(np.r_[True, queries[1:] != queries[:-1]])
    return queries[new], np.r_[new, len(queries)].astype(np.int32), terms, numbers.astype(np.int32), weights


def _floors(index: DataFrame, block: tuple[np.ndarray, ...], keys: np.ndarray, mean_length: float, top: int, block_size: int) -> np.ndarray:
    """For each query of a block its k-th score in one of the shards of `keys`, zero where that has fewer answers."""
    ids = block[0]
    shared = index.sparkSession.sparkContext.broadcast((*block, np.zeros(len(ids))))
    index = index.filter(F.col("key").isin(keys.tolist()))
    answers = index.mapInArrow(lambda batches: _answers(shared.value, mean_length, top, block_size, keys)(batches), _ANSWERS)
    kth = answers.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list("score"), False), 1, top).alias("scores"))
    kth = kth.filter(F.size("scores") == top).select("query_id", F.element_at("scores", -1).alias("low")).toArrow()  # two numbers a query
    floors = np.zeros(len(ids))
    floors[np.searchsorted(ids, kth.column("query_id").to_numpy())] = kth.column("low").to_numpy()
    shared.unpersist()
    return floors


def shard_answers(documents: DataFrame, queries: DataFrame, top: int = TOP, shard_size: int = SHARD, block_size: int = BLOCK) -> DataFrame:
    """Every shard's answers, and the document blocks it opened and was asked about, summed over rows."""
    spark = documents.sparkSession
    index, _ = staged(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches: _shards(batches, shard_size, block_size), _SHARD_COLUMNS), "shards")
    frequencies = index.select("terms", "starts").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("held"))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [np.frombuffer(own.as_py(), np.int32) for own in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, lengths))]), pa.array([int(sum(own.sum() for own in lengths))])], ["files", "words"])

    total = index.select("lengths").mapInArrow(totals, "files long, words long").agg(F.sum("files").alias("files"), F.sum("words").alias("words")).first()
    files, words = total["files"] or 0, total["words"] or 0
    asked = queries.select(F.col("doc_id").cast("long"), "text").filter(F.col("doc_id").isNotNull())
    asked = asked.mapInArrow(_query_terms, "query_id long, term long, times int")
    idf = F.log1p((F.lit(files) - F.col("held") + 0.5) / (F.col("held") + 0.5))
    weighted = asked.join(frequencies, "term").select("query_id", "term", (F.col("times") * idf).alias("weight"))
    weighted, _ = staged(weighted, "queries")
    # a task takes several shards where there are more shards than cores, so that answers grow with the tasks
    index = index.coalesce(2 * spark.sparkContext.defaultParallelism)
    keys, mean = np.array(sorted(row["key"] for row in index.select("key").distinct().collect()), np.int64), words / max(files, 1)  # one number a shard
    first = keys[:: max(1, -(-len(keys) // (2 * spark.sparkContext.defaultParallelism)))]  # as many as there are tasks
    blocks = max(1, -(-weighted.count() // QUERY_ROWS))
    found = spark.createDataFrame([], _ANSWERS)
    for at in range(blocks):
        block = _query_block(weighted, at, blocks)
        if block is None:
            continue
        shared = spark.sparkContext.broadcast((*block, _floors(index, block, first, mean, top, block_size)))
        answers, _ = staged(index.mapInArrow(lambda batches, shared=shared: _answers(shared.value, mean, top, block_size)(batches), _ANSWERS), "answers")
        found = found.unionByName(answers)
        shared.unpersist()
    return found


def search(documents: DataFrame, queries: DataFrame, top: int = TOP, shard_size: int = SHARD, block_size: int = BLOCK) -> DataFrame:
    """`query_id`, `rank`, `doc_id`, `score` of the best documents for each query (`doc_id`, `text`)."""
    found = shard_answers(documents, queries, top, shard_size, block_size)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "doc_id", "score")


def op6_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other documents for the whole text of every fiftieth document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(documents, documents.filter(F.col("doc_id") % QUERY_STEP == 0))


OP6_SQL = rf"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+')) AS term FROM documents
), counts AS (
    SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS n FROM words GROUP BY doc_id, term
), lengths AS (
    SELECT d.doc_id, coalesce(sum(n), 0) AS size FROM documents d LEFT JOIN counts USING (doc_id) GROUP BY d.doc_id
), totals AS (
    SELECT CAST(count(*) AS DOUBLE) AS files, sum(size) / count(*) AS mean FROM lengths
), frequencies AS (
    SELECT term, CAST(count(*) AS DOUBLE) AS held FROM counts GROUP BY term
), weights AS (
    SELECT doc_id AS query_id, term,
           n * ln(1 + (files - held + CAST(0.5 AS DOUBLE)) / (held + CAST(0.5 AS DOUBLE))) AS weight
    FROM counts JOIN frequencies USING (term), totals WHERE doc_id % {QUERY_STEP} = 0
), impacts AS (
    SELECT doc_id, term, n * CAST({K1 + 1} AS DOUBLE)
           / (n + CAST({K1} AS DOUBLE) * (CAST({1 - B} AS DOUBLE) + CAST({B} AS DOUBLE) * size / mean)) AS impact
    FROM counts JOIN lengths USING (doc_id), totals
), scored AS (
    SELECT query_id, doc_id, round(sum(weight * impact), {DECIMALS}) AS score
    FROM weights JOIN impacts USING (term) WHERE query_id <> doc_id GROUP BY query_id, doc_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM scored QUALIFY rank <= {TOP}
"""
