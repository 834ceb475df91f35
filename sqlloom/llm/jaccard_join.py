"""Exact Jaccard join of word shingle sets as a metric-space join.

Jaccard distance is a metric. Equal sets are one class. Pivots are classes that others resemble in
min-hashes; every class is at home in the Voronoi region of its pivot (or of itself). For a pair
within distance r, with x at home at pivot p, the triangle inequality gives d(y,p) <= d(x,p) + r, so:

* a class y from elsewhere is replicated to the region of p only inside the window
  d(y,p) <= R(p) + r, with R(p) the largest distance of a home class;
* classes within r of their pivot are linked to it and so joined; only the shell beyond r and the
  replicas are compared with home classes, and only where distances to p differ by at most r.

Which (y, region) can hold a pair at all follows from prefixes: under one order of all shingles, two
sets that are similar enough share one of their first n - ceil(t*n) + 1 shingles. The order puts
frequent shingles last; any order is exact, so the list of frequent ones may be bounded. Regions are
joined in rings of distance and blocks of bounded size, block against block, so a region of any size
is many small tasks; a block pair sends on a spanning set of its links, never all pairs.

Links decide components; equal sets are never expanded into pairs.

Defined cases: null and empty texts have no shingles and link with nothing; a text of fewer words
than a shingle is one shingle; repeated rows are equal sets; rows without an id take part but never
name a component; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sqlloom.llm.common import BLANKS, Words, arrow_batch, mix, pieces
from sqlloom.llm.components import components
from sqlloom.sources.scratch import RunScratch

SHINGLE = 5
SIMILAR = Fraction(4, 5)

BANDS = 12
ROWS_A_BAND = 2
BANDS_TO_JOIN = 3  # bands in which a class must meet its pivot

#: A shingle seen this often within one task is reported as maybe frequent, and is put last when it
#: is seen that often in all; the list holds at most so many, the most frequent.
SEEN_LOCALLY = 3
SEEN = 48
FREQUENT = 1 << 20
LOCAL = 1_000_000  # shingles counted at a time in a task

RING = 10  # rings of distance 0.1
BLOCK_SHINGLES = 1 << 17
BLOCK_SETS = 512

SETS = pa.schema(
    [("doc_id", pa.int64()), ("text_md5", pa.binary()), ("n", pa.int64()), ("key_a", pa.int64()), ("key_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("head", pa.list_(pa.int64())), ("bitmap", pa.binary())]
)
_MIX = np.array([2 * k + 0x9E3779B1 for k in range(BANDS * ROWS_A_BAND)], np.uint32) | np.uint32(1)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of the distinct shingles of each text, sorted by both."""
    words = Words(texts, BLANKS)
    hashes, doc = words.hash, words.doc
    counts = words.counts
    with np.errstate(over="ignore"):
        if len(hashes) >= k:
            value = np.zeros(len(hashes) - k + 1, np.uint64)
            for j in range(k):
                value = mix(value + hashes[j : len(hashes) - k + 1 + j] + np.uint64(j + 1))
            whole = doc[k - 1 :] == doc[: len(doc) - k + 1]
            value, owner = value[whole], doc[: len(doc) - k + 1][whole]
        else:
            value, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        few = np.flatnonzero((counts > 0) & (counts < k))
        if len(few):  # the whole sequence is the shingle
            first = np.cumsum(counts)[few] - counts[few]
            rest = np.full(len(few), 0x5A5A, np.uint64) + counts[few].astype(np.uint64)
            for j in range(k - 1):
                more = j < counts[few]
                rest[more] = mix(rest[more] + hashes[first[more] + j] + np.uint64(j + 1))
            value, owner = np.concatenate([value, rest]), np.concatenate([owner, few])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], value[new]


def overlap_needed(n: np.ndarray, similar: Fraction = SIMILAR) -> np.ndarray:
    """Least intersection of a set of n with any set that is similar enough."""
    return -(-n * similar.numerator // similar.denominator)


def similar_enough(both: np.ndarray, union: np.ndarray, similar: Fraction = SIMILAR) -> np.ndarray:
    return similar.denominator * both >= similar.numerator * union


def _runs(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(owner, minlength=n)
    return size, np.cumsum(size) - size


def sketches(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """doc_id, n, two keys of the set, band keys and prefix of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                prints = [md5(t.as_py() or b"").digest() for t in part.column("text").cast(pa.binary())]
                yield _sketch(part.column("doc_id"), prints, *shingle_sets(part.column("text")), shared.value)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(compute, "doc_id long, text_md5 binary, n long, key_a long, key_b long, bands array<long>, head array<long>, bitmap binary")


def set_keys(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two keys that are equal for equal sets."""
    size, first = _runs(owner, n)
    some = np.flatnonzero(size)
    keys = np.zeros((2, n), np.uint64)
    with np.errstate(over="ignore"):
        for i, salt in enumerate((0x1234567, 0xABCDEF1)):
            keys[i, some] = np.add.reduceat(mix(value ^ np.uint64(salt)), first[some]) if len(some) else 0
    return keys[0].view(np.int64), keys[1].view(np.int64)


def _sketch(ids: pa.Array, prints: list[bytes], owner: np.ndarray, value: np.ndarray, frequent: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    size, first = _runs(owner, n)
    some = np.flatnonzero(size)
    key_a, key_b = set_keys(owner, value, n)
    low = (value >> np.uint64(32)).astype(np.uint32)
    least = np.zeros((len(_MIX), len(some)), np.uint32)
    for k, factor in enumerate(_MIX):
        if len(some):
            least[k] = np.minimum.reduceat((low ^ (low >> np.uint32(15))) * factor ^ np.uint32(k * 0x85EBCA6B & 0xFFFFFFFF), first[some])
    bands = np.zeros((n, BANDS), np.int64)
    for b in range(BANDS):
        key = least[2 * b].astype(np.uint64) << np.uint64(32) | least[2 * b + 1].astype(np.uint64)
        bands[some, b] = mix(key + np.uint64(b)).view(np.int64)
    last = np.isin(value, frequent) if len(frequent) else np.zeros(len(value), bool)
    order = np.lexsort((value, last, owner))
    head = np.where(size > 0, size - overlap_needed(size) + 1, 0)
    place = np.arange(len(value)) - np.repeat(first, size)
    heads = value[order][place < np.repeat(head, size)].view(np.int64)
    return arrow_batch(
        SETS,
        doc_id=ids,
        text_md5=prints,
        n=size,
        key_a=key_a,
        key_b=key_b,
        bands=pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64())),
        head=pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(head)]).astype(np.int32)), pa.array(heads)),
        bitmap=[bitmap(value[f : f + s]) for f, s in zip(first.tolist(), size.tolist())],
    )


def bitmap(shingles: np.ndarray) -> bytes:
    """Which remainders the shingles have: about four bits a shingle, a power of two of them."""
    bits = 1 << max(9, (4 * len(shingles) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def least_distance(a: bytes, n_a: int, b: bytes, n_b: int) -> float:
    """A lower bound of the distance of two sets of which only bitmaps and sizes are known: each bit
    that one has and the other hasn't is a shingle that one has and the other hasn't."""
    a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    apart = int(np.bitwise_count(a ^ b).sum())
    return 2 * apart / (n_a + n_b + apart) if n_a + n_b else 0.0


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("region", pa.int64()), ("class", pa.int64()), ("at_least", pa.float64())])
    for batch in batches:
        values = (batch.column(c).to_pylist() for c in ("bitmap", "n", "pivot_bitmap", "pivot_n"))
        yield arrow_batch(schema, region=batch.column("region"), **{"class": batch.column("class")}, at_least=[least_distance(*v) for v in zip(*values)])


def frequent_shingles(docs: DataFrame, limit: int = FREQUENT) -> np.ndarray:
    """Shingles to put last: an ordering hint of bounded size, counted over all rows."""
    schema = pa.schema([("shingle", pa.int64()), ("seen", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {"v": np.zeros(0, np.uint64), "n": np.zeros(0, np.int64)}
        pending, size = [], 0

        def merge() -> None:
            values = np.concatenate([seen["v"], *pending])
            weight = np.concatenate([seen["n"], np.ones(len(values) - len(seen["v"]), np.int64)])
            v, back = np.unique(values, return_inverse=True)
            n = np.bincount(back, weight, len(v)).astype(np.int64)
            if len(v) > LOCAL:  # what was seen once gives way
                v, n = v[n > 1], n[n > 1]
            seen["v"], seen["n"] = v, n
            pending.clear()

        for batch in batches:
            for part in pieces(batch, "text"):
                value = shingle_sets(part.column("text"))[1]
                pending.append(value)
                size += len(value)
                if size > LOCAL // 2:
                    merge()
                    size = 0
        if pending:
            merge()
        often = seen["n"] >= SEEN_LOCALLY
        yield arrow_batch(schema, shingle=seen["v"][often].view(np.int64), seen=seen["n"][often])

    local = docs.select("text").mapInArrow(count, "shingle long, seen long")
    total = local.groupBy("shingle").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= SEEN)
    got = total.orderBy(F.desc("seen"), "shingle").limit(limit).select("shingle").toPandas()
    return np.sort(got["shingle"].to_numpy(np.int64).view(np.uint64))


def regions(classes: DataFrame, scratch: RunScratch) -> DataFrame:
    """(class, region): the pivot met in most bands (at least ``BANDS_TO_JOIN``), else itself. A
    pivot that is at home elsewhere passes its classes on to that region."""
    met = classes.select("class", F.explode("bands").alias("band"))
    pivots = met.groupBy("band").agg(F.min("class").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    votes = met.join(pivots, "band").groupBy("class", "pivot").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.where(F.col("votes") >= BANDS_TO_JOIN).groupBy("class").agg(F.max(F.struct("votes", (-F.col("pivot")).alias("p"))).alias("best"))
    step = scratch.write(best.select("class", (-F.col("best.p")).alias("region")).where("region <> class"), "pivots")
    up = step.select(F.col("class").alias("region"), F.col("region").alias("higher"))
    for _ in range(2):
        step = step.join(up, "region", "left").select("class", F.coalesce("higher", "region").alias("region"))
    return scratch.write(step, "homes")


def _encode(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array, "<u8").tobytes()


def sets_of(docs: DataFrame, wanted: DataFrame, scratch: RunScratch, label: str, broadcast_rows: int = 2_000_000) -> DataFrame:
    """(class, shingles) of the wanted classes (class, doc_id, key_a, key_b), from the texts.

    The wanted rows are broadcast when they are few enough by count, else joined by a shuffle.
    """
    few = wanted.count() <= broadcast_rows
    sized = lambda df: F.broadcast(df) if few else df.hint("shuffle_hash")
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(sized(ids), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    schema = pa.schema([("doc_id", pa.int64()), ("key_a", pa.int64()), ("key_b", pa.int64()), ("shingles", pa.binary())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                owner, value = shingle_sets(part.column("text"))
                size, first = _runs(owner, part.num_rows)
                key_a, key_b = set_keys(owner, value, part.num_rows)
                yield arrow_batch(schema, doc_id=part.column("doc_id"), key_a=key_a, key_b=key_b, shingles=[_encode(value[f : f + s]) for f, s in zip(first, size)])

    made = rows.mapInArrow(compute, "doc_id long, key_a long, key_b long, shingles binary")
    named = wanted.select("class", F.col("doc_id").alias("wanted_id"), "key_a", "key_b")
    found = made.join(sized(named), ["key_a", "key_b"]).where(F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return scratch.write(found.select("class", "shingles"), label)


def _measure(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (region, class, guest) with their set and its distance to the region's pivot."""
    pivots = sets.select(F.col("class").alias("region"), F.col("shingles").alias("pivot_shingles"))
    rows = members.join(sets, "class").join(pivots, "region").select("region", "class", "guest", "shingles", "pivot_shingles")
    return rows.mapInArrow(_against_pivot, "region long, class long, guest boolean, d double, linked boolean, size long, shingles binary")


def _against_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distance to the pivot, and whether that is a link."""
    schema = pa.schema(
        [("region", pa.int64()), ("class", pa.int64()), ("guest", pa.bool_()), ("d", pa.float64()), ("linked", pa.bool_()), ("size", pa.int64()), ("shingles", pa.binary())]
    )
    for batch in batches:
        for part in pieces(batch, "shingles"):
            distance, linked, size = [], [], []
            for pair in zip(part.column("shingles"), part.column("pivot_shingles")):
                a, b = (np.frombuffer(x.as_buffer(), "<u8") for x in pair)
                both = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - both
                distance.append(1 - both / union)
                linked.append(bool(similar_enough(both, union)))
                size.append(len(a))
            yield arrow_batch(schema, region=part.column("region"), **{"class": part.column("class")}, guest=part.column("guest"), d=distance, linked=linked, size=size, shingles=part.column("shingles"))


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links between the sets of two blocks."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        for i in range(batch.num_rows):  # one pair of blocks at a time
            (ids_a, sets_a), (ids_b, sets_b) = (_members(batch.column(c)[i].values) for c in ("askers", "homes"))
            linked = _matrix(sets_a, sets_b)
            linked &= ids_a[:, None] != ids_b[None, :]
            a, b = spanning(linked)
            yield arrow_batch(schema, a=ids_a[a], b=ids_b[b])


def _members(block: pa.StructArray) -> tuple[np.ndarray, list[np.ndarray]]:
    return np.asarray(block.field("class"), np.int64), [np.frombuffer(x.as_buffer(), "<u8") for x in block.field("shingles")]


def _matrix(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Which sets are similar enough, by counting common shingles in slices of the vocabulary."""
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    value_a, value_b = np.concatenate(sets_a), np.concatenate(sets_b)
    owner_a, owner_b = np.repeat(np.arange(len(sets_a)), size_a), np.repeat(np.arange(len(sets_b)), size_b)
    common = np.intersect1d(value_a, value_b)
    both = np.zeros((len(sets_a), len(sets_b)), np.float32)
    cells = []
    for value, owner in ((value_a, owner_a), (value_b, owner_b)):
        at = np.minimum(np.searchsorted(common, value), max(len(common) - 1, 0))
        hit = common[at] == value if len(common) else np.zeros(len(value), bool)
        at, owner = at[hit], owner[hit]
        order = np.argsort(at, kind="stable")
        cells.append((at[order], owner[order]))
    for low in range(0, len(common), 4096):
        slices = []
        for (at, owner), n in zip(cells, both.shape):
            i, j = np.searchsorted(at, (low, low + 4096))
            dense = np.zeros((n, min(4096, len(common) - low)), np.float32)
            dense[owner[i:j], at[i:j] - low] = 1
            slices.append(dense)
        both += slices[0] @ slices[1].T
    both = both.astype(np.int64)
    return similar_enough(both, size_a[:, None] + size_b[None, :] - both)


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the links of a bipartite matrix that join the same rows and columns as all of them."""
    n, m = linked.shape
    if not linked.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, column = np.arange(n), np.full(m, n)
    while True:  # least label of each component
        new_column = np.where(linked, row[:, None], n).min(0)
        new_column = np.minimum(new_column, column)
        new_row = np.minimum(np.where(linked, new_column[None, :], n).min(1), row)
        if (new_row == row).all() and (new_column == column).all():
            break
        row, column = new_row, new_column
    # A breadth-first forest: each column hangs on one row of the wave before, each row on one column.
    out_a, out_b = [], []
    seen_row = (row == np.arange(n)) & linked.any(1)
    seen_column = np.zeros(m, bool)
    while True:
        reach = linked[seen_row].any(0) & ~seen_column
        if reach.any():
            columns = np.flatnonzero(reach)
            rows = np.flatnonzero(seen_row)[linked[np.ix_(seen_row, reach)].argmax(0)]
            out_a.append(rows), out_b.append(columns)
            seen_column |= reach
        back = linked[:, seen_column].any(1) & ~seen_row
        if not back.any():
            break
        rows = np.flatnonzero(back)
        columns = np.flatnonzero(seen_column)[linked[np.ix_(back, seen_column)].argmax(1)]
        out_a.append(rows), out_b.append(columns)
        seen_row |= back
    return np.concatenate(out_a), np.concatenate(out_b)


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a region in rings of distance to the pivot and blocks of bounded size."""
    ringed = rows.withColumn("ring", F.floor(F.col("d") * RING).cast("int"))
    sizes = ringed.groupBy("region", "ring").agg(F.ceil(F.greatest(F.sum("size") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_SETS)).alias("parts"))
    cut = ringed.join(sizes, ["region", "ring"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("parts")))
    return cut.groupBy("region", "ring", "block").agg(F.collect_list(F.struct("class", "shingles")).alias(name))


def links(docs: DataFrame, scratch: RunScratch) -> tuple[DataFrame, DataFrame]:
    """The rows with their class (doc_id, text_md5, n, class), and links (a, b) between classes that join
    exactly the classes that all similar pairs join."""
    spark = docs.sparkSession
    rows = sketches(docs, frequent_shingles(docs)).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.write(rows, "rows")
    by_set = rows.where("n > 0").groupBy("key_a", "key_b").agg(F.min("row").alias("class"))
    mapping = scratch.write(by_set, "classes")
    classes = rows.join(mapping.select(F.col("class").alias("row")), "row")
    classes = classes.withColumnRenamed("row", "class")
    homes = regions(classes.select("class", "bands"), scratch)
    at_home = classes.select("class", "doc_id", "key_a", "key_b", "n").join(homes, "class", "left")
    at_home = scratch.write(at_home.withColumn("region", F.coalesce("region", "class")), "at_home")

    # Prefixes: one shuffle by shingle; those met in several regions are the candidates. A region's
    # range of sizes leaves out whom it can't be similar to.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = classes.select("class", "head").join(at_home.select("class", "region", "n"), "class")
    heads = heads.select("class", "region", "n", F.explode("head").alias("shingle")).repartition(parts, "shingle")
    several = heads.groupBy("shingle").agg(F.min("region").alias("low"), F.max("region").alias("high")).where("low < high")
    candidates = scratch.write(heads.join(several.select("shingle").hint("shuffle_hash"), "shingle", "left_semi"), "candidates")
    ranges = candidates.groupBy("shingle", F.col("region").alias("host")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    t = float(SIMILAR)
    fits = (F.col("host") < F.col("region")) & (F.col("n") >= F.floor(F.col("least") * t)) & (F.floor(F.col("n") * t) <= F.col("most"))
    named = candidates.withColumnRenamed("shingle", "mine")
    guests = named.join(ranges, (F.col("mine") == F.col("shingle")) & fits).select(F.col("host").alias("region"), "class").distinct()
    guests = scratch.write(guests, "guests")

    # Home classes of the regions that have more than their pivot, and their pivots.
    crowded = homes.select("region").distinct()
    crowd = at_home.join(crowded, "region", "left_semi").select("region", "class")
    keys = at_home.select("class", "doc_id", "key_a", "key_b")
    needed = crowd.select("class").unionByName(crowded.select(F.col("region").alias("class"))).distinct()
    sets = sets_of(docs, scratch.write(keys.join(needed, "class", "left_semi"), "needed-homes"), scratch, "sets-homes")
    measured = scratch.write(_measure(crowd.withColumn("guest", F.lit(False)), sets), "measured-homes")
    radius = scratch.write(measured.groupBy("region").agg(F.max("d").alias("radius")), "radius")

    # Replicas: first by the bound that bitmaps give, then by their distance.
    reach = float(1 - SIMILAR) + 1e-9  # a little more than r, for rounding
    drawn = classes.select("class", "bitmap", "n")
    pivots = drawn.select(F.col("class").alias("region"), F.col("bitmap").alias("pivot_bitmap"), F.col("n").alias("pivot_n"))
    bounded = guests.join(drawn, "class").join(pivots, "region").select("region", "class", "bitmap", "n", "pivot_bitmap", "pivot_n")
    bounded = bounded.mapInArrow(_bounded, "region long, class long, at_least double").join(radius, "region", "left")
    possible = bounded.where(F.col("at_least") <= F.coalesce("radius", F.lit(0.0)) + reach).select("region", "class")
    possible = scratch.write(possible, "possible")
    more = possible.select("class").unionByName(possible.select(F.col("region").alias("class"))).distinct()
    more = keys.join(more, "class", "left_semi").join(sets.select("class"), "class", "left_anti")
    sets = sets.unionByName(sets_of(docs, scratch.write(more, "needed-guests"), scratch, "sets-guests"))
    outside = scratch.write(_measure(possible.withColumn("guest", F.lit(True)), sets), "measured-guests")
    measured = measured.unionByName(outside)
    direct = measured.where("linked AND class <> region").select(F.col("class").alias("a"), F.col("region").alias("b"))

    # The windows: who may still be similar to a home class of a region.
    # A linked replica is in the component of the pivot; only classes of the shell can still need it.
    radius = radius.where("radius > 0")
    open_ask = (~F.col("linked") & (F.col("d") <= F.col("radius") + reach)) | (F.col("guest") & F.col("linked") & (F.col("radius") > reach))
    askers = measured.join(radius, "region").where(open_ask)
    asked = askers.select("region").distinct()
    hosts = measured.where("NOT guest").join(asked, "region", "left_semi")
    a = _blocks(askers.drop("radius"), "askers").select("region", F.col("ring").alias("ring_a"), "askers")
    h = _blocks(hosts, "homes").select("region", F.col("ring").alias("ring_h"), "homes")
    near = F.abs(F.col("ring_a") - F.col("ring_h")) <= int(np.ceil(reach * RING))
    met = a.join(h, "region").where(near).select("askers", "homes")
    found = met.mapInArrow(_block_links, "a long, b long")
    every = scratch.write(direct.unionByName(found), "links")
    classed = rows.select("doc_id", "text_md5", "n", "key_a", "key_b").join(mapping, ["key_a", "key_b"], "left")
    return classed.select("doc_id", "text_md5", "n", "class"), every


def rooted(docs: DataFrame, scratch: RunScratch) -> DataFrame:
    """(doc_id, text_md5, n, root) of every row; rows without shingles have no root."""
    classed, found = links(docs, scratch)
    roots = components(found, scratch, "components").withColumnRenamed("vertex", "class")
    rows = classed.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    return scratch.write(rows.select("doc_id", "text_md5", "n", "root"), "rooted")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    scratch = RunScratch(docs.sparkSession, "jaccard")
    rows = rooted(docs, scratch)
    # Written, so that the join has a shuffle of its own on both sides and Spark can split a large
    # component's rows over tasks.
    names = scratch.write(rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("name")), "names")
    return rows.join(names, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    )


def one_of_each(docs: DataFrame, broadcast_rows: int = 2_000_000) -> DataFrame:
    """``docs`` with one row of each component, the one of the least id (rows without an id last).

    The rows that go are named by id and digest of the text. Their list is broadcast when it is short
    enough by count, else joined by a shuffle; the texts are not moved otherwise. Rows without
    shingles all stay.
    """
    scratch = RunScratch(docs.sparkSession, "jaccard")
    rows = rooted(docs, scratch).where("root IS NOT NULL")
    no_id = F.col("doc_id").isNull().alias("no_id")
    key = F.struct(no_id, "doc_id", "text_md5")
    counted = rows.groupBy("root", "doc_id", "text_md5").agg(F.count(F.lit(1)).alias("copies"))
    stays = scratch.write(rows.groupBy("root").agg(F.min(key).alias("stays")), "stays")  # see near_duplicates
    judged = counted.join(stays, "root").select("doc_id", "text_md5", "copies", (F.col("stays") == key).alias("first"))
    judged = scratch.write(judged, "judged")

    def named(some: DataFrame, kind: str, frame: DataFrame) -> DataFrame:
        some = some.select(F.col("doc_id").alias("__id"), F.col("text_md5").alias("__md5"))
        some = F.broadcast(some) if some.count() <= broadcast_rows else some.hint("shuffle_hash")
        print_ = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (print_ == F.col("__md5"))
        return frame.join(some, same, kind)

    kept = named(judged.where("NOT first"), "left_anti", docs)
    again = judged.where("first AND copies > 1")
    if again.isEmpty():
        return kept
    # Rows repeated as a whole: one of each.
    single = named(again, "left_semi", kept).dropDuplicates(["doc_id", "text"])
    return named(again, "left_anti", kept).unionByName(single)


def oracle() -> str:
    """near_duplicates over ``documents`` in DuckDB, by all pairs that share a shingle; for tables of
    unique ids."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(words) >= {SHINGLE} THEN list_distinct(list_transform(range(1, len(words) - {SHINGLE - 2}), lambda i: array_to_string(words[i:i + {SHINGLE - 1}], ' ')))
  WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE {SIMILAR.denominator} * shared >= {SIMILAR.numerator} * (a.n + b.n - shared)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.x, r.root FROM r JOIN l ON l.y = r.x),
c AS (SELECT x, min(root) AS root FROM r GROUP BY x)
SELECT c.x AS doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id FROM c LEFT JOIN n ON n.doc_id = c.x"""
