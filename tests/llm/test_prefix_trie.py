import hashlib
import random
import zlib

import pytest

from sqlloom.llm import prefix_trie as pt
from sqlloom.llm.queries import op13_prefix_trie

CONVERSATIONS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Plain restatement of the trie, node by node."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c in own:
        own[c] = [(r, t) for _, r, t in sorted(own[c], key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1], x[2]))]
    conv = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(c / 5 if c >= 0 else -(-c / 5)) * 0 - (c % 5 if c >= 0 else -((-c) % 5)), [])
        conv[c] = tuple(base[:h]) + tuple(turns[h:])
    nodes = {}
    for c, seq in conv.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    out = []
    for key, cs in nodes.items():
        d = len(key)
        kids = [k for k in nodes if len(k) == d + 1 and k[:d] == key]
        sub = [k for k in nodes if len(k) >= d and k[:d] == key]
        leaves = sum(1 for k in sub if not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in nodes))
        saved = sum((len(nodes[k]) - 1) * (len(k[-1][1].encode()) if k else 0) for k in sub)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(conv[c]) == d))
        parent = min(nodes[key[:-1]]) if d else None
        out.append((min(cs), d, parent, len(cs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    return sorted((tuple(r) for r in pt.prefix_trie(df).select(*COLUMNS).collect()), key=repr)


def random_rows(seed, n=40):
    rnd = random.Random(seed)
    texts = ["hello", "hi there", "", "ünï ok", "bye", None]
    rows = []
    for c in rnd.sample(range(0, 60), n):
        for t in range(rnd.randint(1, 12)):
            rows.append((c, rnd.choice([t, t, None, 3]), rnd.choice(["user", "assistant", None]), rnd.choice(texts)))
    return rows + rows[:4] + [(None, 1, "user", "no id")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_by_brute_force(spark, seed):
    rows = random_rows(seed)
    assert run(spark, rows) == brute(rows)


def test_tour_positions_are_a_preorder(spark):
    rows = random_rows(4)
    df = spark.createDataFrame(rows, CONVERSATIONS)
    got = {(r.conv_id, r.depth): r for r in pt.prefix_trie(df).collect()}
    positions = sorted(r.position for r in got.values())
    assert positions[0] == 0 and len(set(positions)) == len(positions)
    for r in got.values():
        if r.parent_conv_id is not None:
            assert got[(r.parent_conv_id, r.depth - 1)].position < r.position


def test_turnless_rebuilt_conversation_is_a_root_member(spark):
    # 10 takes its opening from conversation 10 itself; 11 takes crc32("11") % 9 = 2 turns of 10.
    rows = [(10, 1, "user", "a"), (10, 2, "assistant", "b"), (11, 1, "user", "only")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert pt.prefix_trie(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_extra_columns_are_not_read(spark):
    rows = random_rows(5, 10)
    df = spark.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "1 AS depth", "2 AS n_convs", "3 AS c", "4 AS pos", "5 AS k1", "6 AS id", "7 AS nxt")
    got = sorted((tuple(r) for r in pt.prefix_trie(df).select(*COLUMNS).collect()), key=repr)
    assert got == brute(rows)


def test_query_over_the_table(spark, sf):
    result = op13_prefix_trie(spark, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in result.select(*COLUMNS).collect()), key=repr) == brute(rows)
