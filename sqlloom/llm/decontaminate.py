"""Benchmark decontamination: edit-similar stretches by the intact pieces of an item.

Texts and items are sequences of words. Of an item's words at most ``EDITS`` may be edited. The item
is cut into more disjoint pieces of 1 to 4 words than it may have edits; an edit breaks one piece at
most, so a stretch within the allowed edits holds at least the surplus of pieces unbroken, each within
the allowed edits of its place. Texts are searched for the pieces by hash, and the places of an item's
pieces are counted by diagonal. Nothing in reach is missed at any size (no sampling). Each candidate
is verified exactly: the least word edit distance between the item and any stretch of the text around
it; a text is contaminated where that is at most ``EDITS`` of the item's words. Items of fewer than
five words have no edit to spare and match exactly.

Stretches with fewer of the item's words than it must keep are left out before. A character of a
script written without spaces is a word of its own.

Items are broadcast in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes, one pass over
the texts for each block; texts are never shuffled.

Defined cases: null and empty texts match nothing; items without text, or of a single word, are not
searched for; equal items are all reported; repeated rows are all reported; among
equally near stretches the first is reported; empty tables give no rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sqlloom.llm.common import SYMBOLS, Words, arrow_batch, mix, pieces

EDITS = 0.2
LEAST = 2  # one word is no passage
PIECES = (4, 3, 2, 1)  # words in a piece; the longest is taken that gives a surplus of pieces
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
VOCABULARY_BITS = 22
FILTER_BITS = 22
HITS = 2 << 20  # places of pieces, and words of stretches, looked at together
#: Code points of scripts written without spaces.
UNSPACED = [(0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]

FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int64()), ("similarity", pa.float64())])


class Sequences:
    """Word hashes of texts, one text after the other, each followed by one pad symbol."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, SYMBOLS)
        split_unspaced(words)
        counts = words.counts
        self.begin = np.cumsum(counts + 1) - counts - 1
        self.end = self.begin + counts
        self.symbols = np.zeros(int((counts + 1).sum()), np.uint64)
        self.doc = np.repeat(np.arange(len(counts)), counts + 1)
        self.symbols[np.arange(len(words.doc)) + words.doc] = words.hash
        self.counts = counts


def allowed(n: np.ndarray) -> np.ndarray:
    """Edits an item of n words may have."""
    return np.floor(n * EDITS + 1e-9).astype(np.int64)


def split_unspaced(words: Words) -> None:
    """Make each character of an unspaced script a word of its own."""
    raw = words.bytes
    lead = np.flatnonzero(raw >= 0xE0)
    if not len(lead):
        return
    size = np.where(raw[lead] >= 0xF0, 4, 3)
    point = raw[lead].astype(np.int64) & np.where(size == 4, 0x07, 0x0F)
    for j in (1, 2, 3):
        more = size > j
        point = np.where(more, (point << 6) | (raw[np.minimum(lead + j, len(raw) - 1)] & 0x3F), point)
    alone = np.zeros(len(lead), bool)
    for low, high in UNSPACED:
        alone |= (point >= low) & (point <= high)
    first, behind = lead[alone], lead[alone] + size[alone]
    if len(first):
        start = np.union1d(np.concatenate([words.start, first]), np.setdiff1d(behind, words.end))
        words.end = np.union1d(np.concatenate([words.end, behind]), np.setdiff1d(first, words.start))
        words.start = start
        words.doc = np.searchsorted(words.bounds, start, "right") - 1


FACTORS = mix(np.arange(1, 1 + max(PIECES), dtype=np.uint64)) | np.uint64(1)


def keys(symbols: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each of the places."""
    out = np.zeros(len(places), np.uint64)
    for j in range(size):
        out += symbols[places + j] * FACTORS[j]
    return mix(out)


def expanded(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ranges of n numbers from first, end to end."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def bounded(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs with a sum of at most ``limit``, or of one."""
    sums = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def regions(item: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Number of the region of each stretch: stretches of one item that meet are one region. They are
    sorted by item, text and place, and those of an item have one length but at a text's ends."""
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
    return np.cumsum(new) - 1


class Index:
    """A block of items by the hashes of their pieces."""

    def __init__(self, items: list[tuple[int, str]]):
        items = [(i, t) for i, t in items if t is not None]
        seq = Sequences(pa.array([t for _, t in items], pa.string()))
        long = np.flatnonzero(seq.counts >= LEAST)
        self.ids = np.array([items[i][0] if items[i][0] is not None else -1 for i in long], np.int64)
        self.null_id = np.array([items[i][0] is None for i in long], bool)
        self.words = [seq.symbols[seq.begin[i] : seq.end[i]] for i in long]
        self.sizes = seq.counts[long]
        self.most = allowed(self.sizes)
        self.need = np.zeros(len(long), np.int64)
        self.vocabulary = np.zeros(1 << VOCABULARY_BITS, bool)
        self.members = np.zeros(1 << FILTER_BITS, bool)
        for i, words in enumerate(self.words):
            self.vocabulary[words >> np.uint64(64 - VOCABULARY_BITS)] = True
            self.members[self.member(words, np.full(len(words), i))] = True
        self.tables = []
        left = np.ones(len(long), bool)
        for size in PIECES:
            chosen = np.flatnonzero(left & (self.sizes // size > self.most))
            left[chosen] = False
            if not len(chosen):
                continue
            n = self.sizes[chosen] // size
            self.need[chosen] = n - self.most[chosen]
            item = np.repeat(chosen, n)
            offset = expanded(np.zeros(len(n), np.int64), n) * size
            made = keys(seq.symbols, seq.begin[long[item]] + offset, size)
            order = np.argsort(made, kind="stable")
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[made >> np.uint64(64 - FILTER_BITS)] = True
            self.tables.append((size, made[order], item[order], offset[order], bits))

    @staticmethod
    def member(symbols: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Place in the bit table of words of items."""
        return mix(symbols + mix(items.astype(np.uint64) + np.uint64(1))) >> np.uint64(64 - FILTER_BITS)

    def hits(self, seq: Sequences) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, text, diagonal) of pieces found in the texts; all those of an item in a text together."""
        known = self.vocabulary[seq.symbols >> np.uint64(64 - VOCABULARY_BITS)]
        known[seq.end] = False
        sums = np.concatenate([[0], np.cumsum(known)])
        for size, made, items, offsets, bits in self.tables:
            places = np.flatnonzero(sums[size:] - sums[:-size] == size)
            found = keys(seq.symbols, places, size)
            maybe = bits[found >> np.uint64(64 - FILTER_BITS)]
            places, found = places[maybe], found[maybe]
            first = np.searchsorted(made, found, "left")
            n = np.searchsorted(made, found, "right") - first
            places, first, n = places[n > 0], first[n > 0], n[n > 0]
            if not len(places):
                continue
            docs = seq.doc[places]
            edges = np.flatnonzero(np.diff(docs, prepend=-1))
            for a, b in bounded(np.add.reduceat(n, edges), HITS):
                a, b = edges[a], edges[b] if b < len(edges) else len(places)
                # A single text with more is looked at for some of the items at a time.
                turns = -(-int(n[a:b].sum()) // HITS)
                for turn in range(turns):
                    parts = []
                    for c, d in bounded(n[a:b], HITS):
                        some = slice(a + c, a + d)
                        at = expanded(first[some], n[some])
                        place, doc = np.repeat(places[some], n[some]), np.repeat(docs[some], n[some])
                        mine = items[at] % turns == turn
                        at = at[mine]
                        parts.append((items[at], doc[mine], place[mine] - offsets[at]))
                    yield tuple(np.concatenate(x) for x in zip(*parts))

    def candidates(self, seq: Sequences) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, low, high): the stretches that may hold an item."""
        for item, doc, diagonal in self.hits(seq):
            order = np.lexsort((diagonal, doc, item))
            item, doc, diagonal = item[order], doc[order], diagonal[order]
            last = np.arange(len(item)) + self.need[item] - 1
            there = np.minimum(last, len(item) - 1)
            ok = (last < len(item)) & (item[there] == item) & (doc[there] == doc) & (diagonal[there] <= diagonal + 2 * self.most[item])
            ok[1:] &= ~(ok[:-1] & (item[1:] == item[:-1]) & (doc[1:] == doc[:-1]) & (diagonal[1:] == diagonal[:-1]))
            item, doc, diagonal = item[ok], doc[ok], diagonal[ok]
            k = self.most[item]
            low = np.maximum(seq.begin[doc], diagonal - k)
            high = np.minimum(seq.end[doc], diagonal + self.sizes[item] + 2 * k)
            keep = np.zeros(len(item), bool)
            for a, b in bounded(high - low, HITS):
                region = regions(item[a:b], doc[a:b], low[a:b], high[a:b])
                edge = np.flatnonzero(np.diff(region, prepend=-1))
                start = low[a:b][edge]
                n = np.maximum.reduceat(high[a:b], edge) - start
                words = seq.symbols[expanded(start, n)]
                sums = np.concatenate([[0], np.cumsum(self.members[self.member(words, np.repeat(item[a:b][edge], n))])])
                shift = (np.cumsum(n) - n - start)[region]
                keep[a:b] = sums[high[a:b] + shift] - sums[low[a:b] + shift] >= self.sizes[item[a:b]] - k[a:b]
            item, doc, low, high = item[keep], doc[keep], low[keep], high[keep]
            if len(item):
                edge = np.flatnonzero(np.diff(regions(item, doc, low, high), prepend=-1))
                yield from zip(doc[edge].tolist(), item[edge].tolist(), low[edge].tolist(), np.maximum.reduceat(high, edge).tolist())

    def matches(self, seq: Sequences) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, distance): the nearest stretch of each item in each text."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, low, high in self.candidates(seq):
            found = nearest(self.words[item], seq.symbols[low:high], int(self.most[item]))
            if found is not None:
                distance, a, b = found
                entry = (distance, low + a - int(seq.begin[doc]), b - a)
                best[doc, item] = min(best.get((doc, item), entry), entry)
        return [(doc, item, first, n, d) for (doc, item), (d, first, n) in sorted(best.items())]


def nearest(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the stretch of ``text`` with the least edit distance to ``item``, if
    that is at most ``most``. Rows of the edit table are computed whole and only one is kept: runs of
    inserted words are a running minimum, and each cell carries the start of its stretch."""
    if np.isin(item, text).sum() < len(item) - most:
        return None
    column = np.arange(len(text) + 1)
    row, start = np.zeros(len(text) + 1, np.int64), column
    for symbol in item:
        cost, came = row + 1, start
        across = row[:-1] + (text != symbol)
        shorter = across <= cost[1:]
        cost[1:] = np.where(shorter, across, cost[1:])
        came = np.concatenate([came[:1], np.where(shorter, start[:-1], came[1:])])
        level = cost - column
        least = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == least, column, 0))
        row, start = least + column, came[source]
    end = int(row.argmin())
    distance = int(row[end])
    return (distance, int(start[end]), end) if distance <= most else None


def item_blocks(items: DataFrame) -> Iterator[Index]:
    """Indexes of the items, each over a block of bounded size."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    n, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // (BLOCK_ITEMS // 2)), -(-size // (BLOCK_BYTES // 2)))
    for part in range(parts):
        rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text")
        yield Index([(r["item_id"], r["text"]) for r in rows.collect()])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, n_words, distance, similarity of every text and item found in it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], FOUND_SPARK)
    for index in item_blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in pieces(batch, "text"):
                    ids = part.column("doc_id").to_pylist()
                    found = index.matches(Sequences(part.column("text")))
                    yield arrow_batch(
                        FOUND,
                        doc_id=[ids[d] for d, *_ in found],
                        item_id=[None if index.null_id[i] else int(index.ids[i]) for _, i, *_ in found],
                        first_word=[x[2] for x in found],
                        n_words=[x[3] for x in found],
                        distance=[x[4] for x in found],
                        similarity=[1 - x[4] / max(int(index.sizes[x[1]]), x[3]) for x in found],
                    )

        out = out.unionByName(rows.mapInArrow(find, FOUND_SPARK))
    return out


FOUND_SPARK = "doc_id long, item_id long, first_word long, n_words long, distance long, similarity double"


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    for index in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[[m[0] for m in shared.value.matches(Sequences(part.column("text")))]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
