from collections import Counter, defaultdict

import numpy as np
from compare import connect, differences

from sqlloom.llm import cover_tree
from sqlloom.llm.queries import op6_cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    groups, out = defaultdict(list), []
    for i, (vec_id, v, label) in enumerate(rows):
        ok = v is not None and len(v) and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            groups[label, len(v)].append(i)
        else:
            out.append((vec_id, 0, vec_id, vec_id is not None))
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        linked = x @ x.T >= cover_tree.COSINE
        np.fill_diagonal(linked, False)
        root = np.arange(len(members))
        while True:
            new = np.minimum(root, np.where(linked, root[None, :], len(members)).min(1))
            if (new == root).all():
                break
            root = new
        names = {}
        for i, r in zip(members, root):
            if rows[i][0] is not None:
                names[r] = min(names.get(r, rows[i][0]), rows[i][0])
        out += [(rows[i][0], int(n), names.get(r), rows[i][0] is not None and rows[i][0] == names.get(r)) for i, n, r in zip(members, linked.sum(1), root)]
    return Counter(out)


def got(df, **options):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.near_duplicates(df, **options).collect())


def clustered(seed, n=700):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(20, 16))
    spread = rng.choice([0.0, 0.02, 0.1, 0.3, 0.8], n)
    x = centers[rng.integers(0, 20, n)] + rng.normal(size=(n, 16)) * spread[:, None]
    x[: n // 3] = centers[0] + rng.normal(size=(n // 3, 16)) * 0.05  # one hot group of near copies
    return [(i, [float(np.float32(c)) for c in v], int(label)) for i, (v, label) in enumerate(zip(x, rng.integers(0, 2, n)))]


def test_trees_of_several_levels_by_brute_force(spark):
    rows = clustered(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(df, leaf=24) == expected(rows)
    assert got(df) == expected(rows)


def test_blocks_and_upper_levels_by_brute_force(spark):
    rows = clustered(2, 1500)
    rows += [(5000 + i, rows[i][1], rows[i][2]) for i in range(0, 200, 3)]  # equal vectors too
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(df, leaf=8, block=32) == expected(rows)
    assert got(df, leaf=64, block=100) == expected(rows)


def test_doubles_near_the_threshold(spark):
    """Cosines that single precision cannot tell from the threshold."""
    rng, rows = np.random.default_rng(3), []
    for i in range(300):
        u, v = np.linalg.qr(rng.normal(size=(24, 2)))[0].T
        cosine = 0.93 + (1 if i % 2 else -1) * 10.0 ** -rng.integers(6, 12)
        rows += [(2 * i, [float(c) for c in u], i), (2 * i + 1, [float(c) for c in cosine * u + np.sqrt(1 - cosine**2) * v], i)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in cover_tree.near_duplicates(df).collect()}
    assert found == {v: v // 2 % 2 for v, _, _ in rows}


def test_vectors_are_not_shuffled_for_each_pair_of_leaves(spark):
    """Vectors without structure: no leaf pair can be dropped."""
    x = np.random.default_rng(4).normal(size=(800, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    manager = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {f.getPath(): f.length() for f in map(files.apply, range(files.size())) if "shuffle" in f.getName()}

    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = shuffled()
    try:
        assert got(df, leaf=16).total() == 800
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert 0 < sum(n for f, n in shuffled().items() if f not in before) < 10 * x.nbytes


def test_edge_rows(spark):
    one = [1.0, 0.0, 0.5]
    rows = [
        (1, one, 1), (1, one, 1), (2, [2.0, 0.0, 1.0], 1), (3, one, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [], 1),
        (7, [1.0, None, 0.5], 1), (8, [float("nan"), 0.0, 1.0], 1), (9, [float("inf"), 0.0, 1.0], 1), (10, one, 2), (None, one, 2),
        (11, [1.0, 0.0], 1), (12, [-0.0, 1.0, 0.0], 3), (13, [0.0, 1.0, -0.0], 3), (None, None, None), (14, [1e30, 0.0, 5e29], 1), (15, [1e-30, 0.0, 5e-31], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS class", "3 AS node", "4 AS n")
    assert got(df) == expected(rows)


def test_query_matches_oracle(spark, sf):
    assert differences(op6_cover_tree(spark, sf), connect(sf), cover_tree.oracle()) is None


def test_empty_table(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
