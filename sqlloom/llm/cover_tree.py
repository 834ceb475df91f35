"""Near-duplicate vectors by a cover tree and a dual traversal of node pairs, exact.

Equal vectors are one class. Unit vectors of one label are put into a tree: a node has a center and
a covering radius (the measured largest distance of its members); it is split by a net of centers
that lie more than the level's radius apart, and that radius halves from level to level. Nodes stop
splitting when they are small, or when their radius is at most half the threshold distance: then all
their members link with each other.

The upper levels, down to nodes of the size of a block, are split over the whole table; their centers
(some 48 to a block) are known to every task, so members find their node without being moved. Then the
vectors move once, into the order of the tree, and are cut into blocks of bounded size, in files of the
scratch folder. A block holds the lower levels: its leaves with their centers and radii.

The traversal takes pairs of blocks of one label, as names of files, never vectors; a task reads the
two blocks it compares. With d the distance of two centers and r1, r2 the radii, a pair of leaves is
dropped if d - r1 - r2 exceeds the threshold distance; two leaves with d + r1 + r2 within it link member
by member without a look at them. The members of all other leaf pairs are compared by their cosines, in
single precision and, where its rounding could decide, in double precision.

Counts of links and a spanning set of links leave a task, never all pairs. So disk and shuffles grow
with the table. Time grows with the pairs of leaves the bounds can't decide, which for vectors without
any structure are all.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and vectors
without a label link with nothing, and so do vectors of different lengths; repeated rows are equal
vectors; rows without an id take part but never name a component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from sqlloom.llm.common import arrow_batch, open_folder, pieces
from sqlloom.llm.components import components
from sqlloom.operators.joins import fits_broadcast
from sqlloom.options import JoinOptions
from sqlloom.sources.scratch import RunScratch

COSINE = 0.93
LEAF = 256  # members a node may have without a split
CANDIDATES = 48  # members of a node among which centers are sought
BLOCK = 16_384  # members of a block
BLOCK_BYTES = 8 << 20  # of a block's vectors
STRIP = 128  # members compared with a block at a time
LEVELS = 40
SLACK = 1e-6  # for rounding in the bounds; pairs inside it are compared

ROOT_RADIUS = 2.0  # no two unit vectors are farther apart


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(r, kind) for r in raw]).astype("<f8")
    return _scaled(x)


def _scaled(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def keyed_vectors(vectors: DataFrame, kind: str) -> DataFrame:
    """Rows (row, vec_id, label, vec, digest); vec as raw numbers, null for those that never link."""
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.string()), ("vec", pa.binary())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, labelled = batch.column("embedding"), batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            out = []
            for i in range(len(vec)):
                v = vec[i].values if vec[i].is_valid and labelled[i] else None
                x = np.asarray(v.cast(pa.float64()).fill_null(np.nan)) if v is not None and len(v) else np.zeros(1)
                out.append((x + 0.0).astype(kind).tobytes() if np.isfinite(x).all() and x.any() else None)  # no negative zero
            yield arrow_batch(schema, row=batch.column("row"), vec_id=batch.column("vec_id"), label=batch.column("label"), vec=out)

    rows = vectors.select("row", "vec_id", F.col("label").cast("string").alias("label"), "embedding")
    kept = rows.mapInArrow(keep, "row long, vec_id long, label string, vec binary")
    # Half a SHA-256: equal for equal vectors only.
    return kept.withColumn("digest", F.substring(F.unhex(F.sha2("vec", 256)), 1, 16))


def _net(x: np.ndarray, radius: float) -> list[int]:
    """A net among candidates: each further center is more than ``radius`` away from those before; the
    second is taken in any case, so a node always splits."""
    gap = np.full(len(x), np.inf)
    taken, at = [], 0
    while len(taken) < len(x):
        taken.append(at)
        gap = np.minimum(gap, np.sqrt(np.maximum(((x - x[at]) ** 2).sum(1), 0)))
        at = int(gap.argmax())
        if gap[at] <= 0 or (len(taken) > 1 and gap[at] <= radius):
            break
    return taken


def _choose_centers(radius: float, kind: str):
    """Centers of a node among its sampled members."""

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("class")
        return group.iloc[_net(_unit(group["vec"].to_list(), kind), radius)][["node", "class", "vec"]]

    return choose


def _assigned(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of the centers, and the distance to it."""
    best = (x @ centers.T).argmax(1)
    return best, np.sqrt(((x - centers[best]) ** 2).sum(1))


class Top:
    """The upper levels: for each label and length whose vectors fill more than a block, a root; for each
    node that is split, the centers and numbers of its children. Numbers count up in order of making."""

    def __init__(self, kind: str):
        self.kind = kind
        self.roots: dict[tuple[str, int], int] = {}
        self.children: dict[int, tuple[np.ndarray, list[int]]] = {}
        self.size = 0

    def add(self) -> int:
        self.size += 1
        return self.size - 1

    def order(self) -> np.ndarray:
        """The place of each node in a walk through its tree, so that near nodes are neighbours."""
        place, stack = np.zeros(self.size, np.int64), list(self.roots.values())
        for i in range(self.size):
            node = stack.pop()
            place[node] = i
            stack += self.children.get(node, (None, []))[1]
        return place

    def walk(self, labels: list, vecs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The lowest node of each vector, -1 where there is no tree, and the distance to its center."""
        node, d = np.full(len(vecs), -1, np.int64), np.full(len(vecs), ROOT_RADIUS)
        groups: dict[int, list[int]] = {}
        for i, key in enumerate(zip(labels, map(len, vecs))):
            root = self.roots.get(key)
            if root is not None:
                groups.setdefault(root, []).append(i)
        for root, members in groups.items():
            members = np.array(members)
            x, stack = _unit([vecs[i] for i in members], self.kind), [(root, np.arange(len(members)))]
            while stack:
                at, some = stack.pop()
                node[members[some]] = at
                if at not in self.children:
                    continue
                centers, numbers = self.children[at]
                best, far = _assigned(x[some], centers)
                d[members[some]] = far
                stack += [(numbers[k], some[best == k]) for k in np.unique(best)]
        return node, d


def _rows_of(width: int, block: int) -> int:
    """Members of a block of vectors of so many bytes."""
    return max(1, min(block, BLOCK_BYTES // width))


def build(members: DataFrame, kind: str, scratch: RunScratch, threshold: float, leaf: int, block: int) -> Top:
    """The upper levels of the trees of ``members`` (class, label, vec)."""
    context, top, level = members.sparkSession.sparkContext, Top(kind), 0
    width = F.octet_length("vec").alias("width")
    sizes = members.groupBy("label", width).agg(F.count(F.lit(1)).alias("size"))
    open_nodes = {}
    full = F.greatest(F.lit(leaf), F.least(F.lit(block), F.floor(F.lit(BLOCK_BYTES) / F.col("width"))))
    for r in sizes.where(F.col("size") > full).collect():
        top.roots[r.label, r.width] = root = top.add()
        open_nodes[root] = (r.size, r.width)
    narrow = members.select("class", F.xxhash64("class").alias("hash"), "label", "vec")
    while open_nodes and level + 1 < LEVELS:
        level += 1
        shared = context.broadcast((top, {k: n for k, (n, _) in open_nodes.items()}))

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """About CANDIDATES members of each open node, by their hash."""
            top, open_sizes = shared.value
            schema = pa.schema([("node", pa.int64()), ("class", pa.int64()), ("vec", pa.binary())])
            for batch in batches:
                for part in pieces(batch, "vec"):
                    node, _ = top.walk(part.column("label").to_pylist(), part.column("vec").to_pylist())
                    size = np.array([open_sizes.get(n, 0) for n in node.tolist()], np.int64)
                    drawn = np.flatnonzero((size > 0) & (np.asarray(part.column("hash")) % np.maximum(size, 1) < CANDIDATES))
                    yield arrow_batch(schema, node=node[drawn], **{k: part.column(k).take(pa.array(drawn)) for k in ("class", "vec")})

        sample = narrow.mapInArrow(draw, "node long, class long, vec binary")
        centers = sample.groupBy("node").applyInPandas(_choose_centers(ROOT_RADIUS / 2**level, kind), "node long, class long, vec binary")
        found: dict[int, list] = {}
        for r in centers.collect():
            found.setdefault(r.node, []).append((r["class"], bytes(r.vec)))
        shared.unpersist()
        made = {}
        for node, some in sorted(found.items()):
            if len(some) > 1:
                numbers = [top.add() for _ in some]
                top.children[node] = (_unit([v for _, v in sorted(some)], kind), numbers)
                made |= {n: open_nodes[node][1] for n in numbers}
        if not made:
            break
        shared = context.broadcast((top, made))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Sizes and radii of the new nodes, summed up by batch."""
            top, made = shared.value
            schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("radius", pa.float64())])
            for batch in batches:
                for part in pieces(batch, "vec"):
                    node, d = top.walk(part.column("label").to_pylist(), part.column("vec").to_pylist())
                    new, at = np.unique(node, return_inverse=True)
                    radius = np.zeros(len(new))
                    np.maximum.at(radius, at, d)
                    keep = np.array([n in made for n in new.tolist()], bool)
                    yield arrow_batch(schema, node=new[keep], size=np.bincount(at, minlength=len(new))[keep], radius=radius[keep])

        measured = narrow.mapInArrow(measure, "node long, size long, radius double").groupBy("node").agg(F.sum("size").alias("size"), F.max("radius").alias("radius"))
        open_nodes = {r.node: (r.size, made[r.node]) for r in measured.collect() if r.size > max(leaf, _rows_of(made[r.node], block)) and r.radius > threshold / 2 - SLACK}
        shared.unpersist()
    return top


def _leaves(x: np.ndarray, threshold: float, leaf: int) -> list[tuple[np.ndarray, int, float]]:
    """Members, center and radius of the leaves of a block, by the same splits as above it."""
    out, stack = [], [(np.arange(len(x)), 0, 1)]
    while stack:
        members, center, level = stack.pop()
        radius = float(np.sqrt(((x[members] - x[center]) ** 2).sum(1).max()))
        if len(members) > leaf and radius > threshold / 2 - SLACK and level < LEVELS:
            some = members[np.linspace(0, len(members) - 1, min(CANDIDATES, len(members))).astype(int)]
            centers = some[_net(x[some], ROOT_RADIUS / 2**level)]
            if len(centers) > 1:
                best, _ = _assigned(x[members], x[centers])
                stack += [(members[best == k], centers[k], level + 1) for k in np.unique(best)[::-1]]
                continue
        out.append((members, center, radius))
    return out


BLOCKS = "label string, width int, file string, at long, members int, leaves int"
BLOCKS_ARROW = pa.schema([("label", pa.string()), ("width", pa.int32()), ("file", pa.string()), ("at", pa.int64()), ("members", pa.int32()), ("leaves", pa.int32())])


def write_blocks(members: DataFrame, top: Top, scratch: RunScratch, threshold: float, leaf: int, block: int) -> DataFrame:
    """Members (class, n, label, vec) in the order of their trees, cut into blocks in files: the files'
    table (label, width, file, at, members, leaves)."""
    spark, kind, folder = members.sparkSession, top.kind, scratch.table("block-files")
    shared = spark.sparkContext.broadcast((top, top.order()))
    size = members.agg(F.sum(F.octet_length("vec"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (2 * BLOCK_BYTES)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, order = shared.value
        schema = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("label", pa.string()), ("vec", pa.binary()), ("place", pa.int64())])
        for batch in batches:
            for part in pieces(batch, "vec"):
                node, _ = top.walk(part.column("label").to_pylist(), part.column("vec").to_pylist())
                where = np.where(node < 0, -1, order[node]) if len(order) else node
                yield arrow_batch(schema, **{k: part.column(k) for k in ("class", "n", "label", "vec")}, place=where)

    placed = members.select("class", "n", "label", "vec")
    if top.size:
        placed = placed.mapInArrow(place, "class long, n long, label string, vec binary, place long")
    else:
        placed = placed.withColumn("place", F.lit(-1).cast("long"))
    order = ["label", "width", "place", "class"]
    ranged = placed.withColumn("width", F.octet_length("vec")).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        # Another attempt of this task writes another file; only that of the one that counts is listed.
        context = TaskContext.get()
        name = f"{context.partitionId()}-{context.taskAttemptId()}"
        out, at, key, held = system.open_output_stream(f"{path}/{name}"), 0, None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal at, held
            if held:
                data, leaves = _packed(held, kind, threshold, leaf)
                out.write(data)
                yield arrow_batch(BLOCKS_ARROW, label=[key[0]], width=[key[1]], file=[name], at=[at], members=[len(held)], leaves=[leaves])
                at, held = at + len(data), []

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("label", "width", "class", "n", "vec"))):
                if row[:2] != key or len(held) == _rows_of(key[1], block):
                    yield from flush()
                    key = row[:2]
                held.append(row[2:])
        yield from flush()
        out.close()

    return scratch.write(ranged.select("label", "width", "class", "n", "vec").mapInArrow(write, BLOCKS), "blocks")


def _packed(held: list[tuple], kind: str, threshold: float, leaf: int) -> tuple[bytes, int]:
    """Bytes of a block, and its number of leaves: sizes, radii and centers of leaves, then classes,
    counts and vectors of members, leaf by leaf."""
    raw = np.stack([np.frombuffer(v, kind) for _, _, v in held])
    x = _scaled(raw.astype("<f8"))
    leaves = _leaves(x, threshold, leaf)
    order = np.concatenate([m for m, _, _ in leaves])
    arrays = [
        np.array([len(m) for m, _, _ in leaves], "<i8"), np.array([r for _, _, r in leaves], "<f8"), x[[c for _, c, _ in leaves]].astype("<f8"),
        np.array([c for c, _, _ in held], "<i8")[order], np.array([n for _, n, _ in held], "<i8")[order], raw[order],
    ]
    return b"".join(a.tobytes() for a in arrays), len(leaves)


class Block:
    """A block as read: leaves at once, members when they are asked for."""

    def __init__(self, system, path: str, file: str, at: int, members: int, leaves: int, width: int, kind: str):
        self.source, self.kind, self.m, self.dim = system.open_input_file(f"{path}/{file}"), kind, members, width // np.dtype(kind).itemsize
        head = self.source.read_at(leaves * (16 + 8 * self.dim), at)
        self.sizes, self.radii = np.frombuffer(head, "<i8", leaves), np.frombuffer(head, "<f8", leaves, 8 * leaves)
        self.centers = np.frombuffer(head, "<f8", offset=16 * leaves).reshape(leaves, self.dim)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.leaf = np.repeat(np.arange(leaves), self.sizes)
        self.at, self.rest, self._body = at + len(head), members * (16 + width), None

    def load(self) -> Block:
        if self._body is None:
            self._body = self.source.read_at(self.rest, self.at)
            self.classes, self.n = np.frombuffer(self._body, "<i8", self.m), np.frombuffer(self._body, "<i8", self.m, 8 * self.m)
            self.raw = np.frombuffer(self._body, self.kind, offset=16 * self.m).reshape(self.m, self.dim)
            self.unit = _scaled(self.raw.astype("<f8")).astype("<f4")
            self.source.close()
        return self


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with the row of y, in double precision."""
    # Scaling by powers of two is exact and keeps sums of squares in range.
    x, y = (np.ldexp(v.astype("<f8"), -np.frexp(np.abs(v.astype("<f8")).max(1))[1][:, None]) for v in (x, y))
    return (x * y).sum(1) / np.sqrt((x * x).sum(1)) / np.sqrt((y * y).sum(1))


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the components of each a and b one; root has the least vertex of each component."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _linked(a: Block, b: Block, cosine: float, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Of the members of both blocks that link: class, links, and a class they link with in the end (or -1).
    The same object twice stands for the pairs inside a block."""
    same = a is b
    d = np.sqrt(np.maximum(2 - 2 * (a.centers @ b.centers.T), 0))
    reach = a.radii[:, None] + b.radii[None, :]
    todo, near = d - reach <= threshold + SLACK, d + reach <= threshold - SLACK
    if same:
        todo, near = np.triu(todo), near | near.T
    if not todo.any():
        return None
    todo &= ~near
    a.load(), b.load()
    shift = 0 if same else a.m
    links, root = np.zeros(a.m + (0 if same else b.m), np.int64), np.arange(a.m + (0 if same else b.m))
    if near.any():
        whole = [np.add.reduceat(v.n, v.starts[:-1]) for v in (a, b)]
        links[: a.m] += np.repeat(near @ whole[1], a.sizes)
        if same:
            links -= np.repeat(np.diag(near), a.sizes) * a.n
        else:
            links[shift:] += np.repeat(whole[0] @ near, b.sizes)
        for v, first, hit in ((a, 0, near.any(1)), (b, shift, near.any(0))):
            inside = np.flatnonzero(hit[v.leaf])
            _unite(root, first + inside, first + v.starts[v.leaf[inside]])
        u, v = np.nonzero(near)
        _unite(root, a.starts[u], shift + b.starts[v])
    margin = (a.dim + 8) * 2.0**-23  # of single precision
    first = 0
    while first < len(a.sizes):
        # Whole leaves up to about a strip, or a single larger leaf strip by strip.
        last = max(int(np.searchsorted(a.starts, a.starts[first] + STRIP, "right")) - 1, first + 1)
        wanted = todo[first:last].any(0)
        columns = np.flatnonzero(np.repeat(wanted, b.sizes)) if wanted.any() else np.zeros(0, np.int64)
        y = b.unit if len(columns) == b.m else b.unit[columns]
        for low in range(a.starts[first], a.starts[last] if len(columns) else a.starts[first], STRIP):
            high = min(low + STRIP, a.starts[last])
            c = a.unit[low:high] @ y.T
            i, j = np.divmod(np.flatnonzero(c >= np.float32(cosine - margin)), len(columns))
            value = c[i, j]
            i, j = i + low, columns[j]
            keep = todo[a.leaf[i], b.leaf[j]]
            if same:
                keep &= i < j
            i, j, value = i[keep], j[keep], value[keep]
            unsure = np.flatnonzero(value <= cosine + margin)
            sure = np.ones(len(i), bool)
            for k in range(0, len(unsure), 4096):
                some = unsure[k : k + 4096]
                sure[some] = _cosines(a.raw[i[some]], b.raw[j[some]]) >= cosine
            i, j = i[sure], j[sure]
            if len(i):
                np.add.at(links, i, b.n[j])
                np.add.at(links, shift + j, a.n[i])
                _unite(root, i, shift + j)
        first = last
    classes = a.classes if same else np.concatenate([a.classes, b.classes])
    to = np.where(root == np.arange(len(root)), -1, classes[root])
    hit = links > 0
    return classes[hit], links[hit], to[hit]


def compare(blocks: DataFrame, folder: str, kind: str, cosine: float, threshold: float) -> DataFrame:
    """(class, links, to) of the members of all pairs of blocks of one label and length."""
    side = lambda s: blocks.select("label", "width", *(F.col(c).alias(f"{c}_{s}") for c in ("file", "at", "members", "leaves")))
    met = side("a").join(side("b"), ["label", "width"])
    same = (F.col("file_a") == F.col("file_b")) & (F.col("at_a") == F.col("at_b"))
    later = (F.col("file_a") < F.col("file_b")) | ((F.col("file_a") == F.col("file_b")) & (F.col("at_a") < F.col("at_b")))
    pairs = met.where((same & (F.col("members_a") > 1)) | later).drop("label")
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    schema = pa.schema([("class", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        kept: dict[tuple, Block] = {}

        def block(row: dict, s: str) -> Block:
            key = row[f"file_{s}"], row[f"at_{s}"]
            if key not in kept:
                if len(kept) > 3:
                    kept.pop(next(iter(kept)))
                kept[key] = Block(system, path, *key, row[f"members_{s}"], row[f"leaves_{s}"], row["width"], kind)
            return kept[key]

        for batch in batches:
            for row in batch.to_pylist():
                found = _linked(block(row, "a"), block(row, "b"), cosine, threshold)
                if found:
                    yield arrow_batch(schema, **dict(zip(schema.names, found)))

    # Pairs are rows of some bytes and seconds of work each.
    dealt = pairs.repartition(max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8 * cores))
    return dealt.mapInArrow(run, "class long, links long, to long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    scratch = RunScratch(spark, "covertree")
    threshold = float(np.sqrt(2 - 2 * cosine))
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "<f8"
    columns = [F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding"]
    rows = scratch.write(keyed_vectors(vectors.select(*columns).withColumn("row", F.monotonically_increasing_id()), kind), "rows")
    valid = rows.where("digest IS NOT NULL")
    classes = scratch.write(valid.groupBy("label", "digest").agg(F.min("row").alias("class"), F.count(F.lit(1)).alias("n")), "classes")

    # Of equal vectors the first one stays, with their number.
    repeated = classes.where("n > 1")
    many, spare_rows = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    members = valid.select(F.col("row").alias("class"), "label", "vec")
    if many:
        small = fits_broadcast(spare_rows, 64 * spare_rows, JoinOptions())
        sent = F.broadcast if small else (lambda df: df)
        spare = valid.select("row", "label", "digest").join(sent(repeated), ["label", "digest"]).where(F.col("row") != F.col("class"))
        spare = scratch.write(spare.select(F.col("row").alias("class")), "spare")
        members = members.join(sent(spare), "class", "left_anti").join(sent(repeated.select("class", "n")), "class", "left")
        members = members.withColumn("n", F.coalesce("n", F.lit(1)).cast("long"))
        if not small:
            members = scratch.write(members, "members")
    else:
        members = members.withColumn("n", F.lit(1).cast("long"))

    top = build(members, kind, scratch, threshold, leaf, block)
    blocks = write_blocks(members, top, scratch, threshold, leaf, block)
    found = scratch.write(compare(blocks, scratch.table("block-files"), kind, cosine, threshold), "found")
    scratch.drop("block-files", "members")

    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.where("to >= 0").select(F.col("class").alias("a"), F.col("to").alias("b")), scratch, "components")
    ranked = classes.join(counts, "class", "left").join(roots.withColumnRenamed("vertex", "class"), "class", "left")
    ranked = ranked.select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("root"))
    placed = valid.select("row", "vec_id", "label", "digest").join(ranked, ["label", "digest"]).select("row", "vec_id", "n_links", "root")
    placed = scratch.write(placed, "placed")
    names = placed.groupBy("root").agg(F.min("vec_id").alias("name"))
    named = placed.join(names, "root").select("row", "n_links", "name")
    out = rows.select("row", "vec_id").join(named, "row", "left")
    out = out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("name")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def oracle(cosine: float = COSINE) -> str:
    """The same over ``embeddings`` in DuckDB, for tables of unique ids."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= {cosine}),
r(x, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.x, r.root FROM r JOIN e ON e.y = r.x),
c AS (SELECT x, min(root) AS root FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c.root AS component_id, vec_id = c.root AS kept
FROM embeddings JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id"""
