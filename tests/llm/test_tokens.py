import random
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from sqlloom.llm import binary_index, curve_packing
from sqlloom.llm.common import table
from sqlloom.llm.queries import TOKENIZER, op2_binary_index, op5_curve_packing
from sqlloom.llm.tokens import WordEncoder
from sqlloom.sources.scratch import RunScratch

PLAIN = Tokenizer.from_file(TOKENIZER)


def ids_of(text, end):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_equals_the_library_on_odd_texts():
    rnd, coder = random.Random(4), WordEncoder(TOKENIZER)
    alphabet = list("abz AB.,..,éßÄΣ\t\n\x0b\x0c\r\x1c\x85  　​'’s12|<>中̈") + ["'s", "<|endoftext|>", "<|startoftext|>", "İ", "ſ"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 14))) for _ in range(4_000)] + [None, ""]
    got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)]
    assert got == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_between_marks_and_digits_are_encoded_once():
    coder = WordEncoder(TOKENIZER)
    stems = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("nt", "sh", "mers", "ué")]
    marks = ["", ".", ",", "&&&", ",###", ").", "!!", "12"]
    texts = [" ".join(stem + mark for stem in stems if stem.isascii()) for mark in marks]
    assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)] == [ids_of(t, 2)[:-1].tolist() for t in texts]
    assert len(coder.cache) <= len(stems) + len(marks)  # not one entry for each mark behind each word
    texts = [" ".join(stem + mark for stem in stems) for mark in marks]
    assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)] == [ids_of(t, 2)[:-1].tolist() for t in texts]


def test_encoder_equals_the_library_next_to_marks(monkeypatch):
    monkeypatch.setattr("sqlloom.llm.tokens.CACHED_WORDS", 2_000)
    rnd, coder = random.Random(9), WordEncoder(TOKENIZER)
    alphabet = list("abst xyz12'|<>/=_-#.,\u0338\u0301éσςΣ\n") + ["'ll", "'s", "a=\u0338", "1\u20e3", "</w>", "<|endoftext|>", "<|", "|>", "K", "\x00", "😀"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 20))) for _ in range(6_000)]
    for size in (1, 50, 6_000):
        records = [r for at in range(0, len(texts), size) for r in coder.records(texts[at : at + size], b"\x02\x00").to_pylist()]
        assert [np.frombuffer(r, coder.dtype).tolist() for r in records] == [ids_of(t, 2).tolist() for t in texts]


def expect_records(rows):
    """Records in (key, text) order with their start, as a multiset by key."""
    out, at = defaultdict(list), 0
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    starts = {}
    for doc_id, text, *_ in rows:
        ids = ids_of(text, 1)
        out[doc_id].append((len(ids), zlib.crc32(ids.tobytes())))
        starts.setdefault(doc_id, at)
        at += len(ids)
    return {k: (starts[k], sorted(v)) for k, v in out.items()}


def test_binary_index_round_trip(spark, edge_docs, edge_rows):
    got = defaultdict(list)
    for r in binary_index.id_records(edge_docs, TOKENIZER, 1).collect():
        got[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    expected = expect_records(edge_rows)
    assert {k: (min(v)[0], sorted(x[1:] for x in v)) for k, v in got.items()} == expected
    for records in got.values():  # without gaps inside a key
        records.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(records, records[1:]))


def test_lookup_by_key(spark, edge_docs, edge_rows):
    scratch = RunScratch(spark, "test-ids")
    manifest = binary_index.write_index(edge_docs, TOKENIZER, 1, scratch, shards=3)
    keys = spark.createDataFrame([(k,) for k in [1, 4, 8, 99, -5, None, 4]], "key long")
    got = defaultdict(list)
    for r in binary_index.lookup(manifest, scratch.table("shards"), keys, "key").collect():
        got[r.key].append(tuple(r.ids))
    for key in (1, 4, 8):
        assert sorted(got[key]) == sorted(tuple(ids_of(t, 1).tolist()) for i, t, *_ in edge_rows if i == key)
    assert set(got) == {1, 4, 8}
    scratch.close()


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64))
    index = binary_index.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert binary_index.PerfectHash.build(np.zeros(0, np.uint64)).slots(keys[:3]).tolist() == [-1] * 3


def check_packing(rows, pieces, capacity):
    sequences, expected = defaultdict(list), defaultdict(int)
    for doc_id, text, *_ in rows:
        ids = ids_of(text, 2)
        expected[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    by_doc = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(sum(n for _, n in s) < capacity for s in sequences.values()) <= 1
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[doc_id].append(ids_of(text, 2))
    for doc_id, parts in by_doc.items():
        assert sum(p.length for p in parts) == sum(map(len, texts[doc_id]))
        for p in parts:
            assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in texts[doc_id])
    assert set(by_doc) == set(texts)


def test_packing(edge_docs, edge_rows):
    check_packing(edge_rows, curve_packing.pack(edge_docs, TOKENIZER).collect(), 4096)
    check_packing(edge_rows, curve_packing.pack(edge_docs, TOKENIZER, capacity=16).collect(), 16)


@pytest.mark.parametrize("capacity", [4096, 16])
def test_sequences_are_made_of_the_ids_of_their_pieces(edge_docs, edge_rows, capacity, monkeypatch):
    monkeypatch.setattr(curve_packing, "PIECE_BYTES", 256)
    pieces = curve_packing.pack(edge_docs, TOKENIZER, capacity=capacity).collect()
    stream = []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        assert len(stream) == p.sequence_id * capacity + p.offset
        stream += ids.tolist()
    texts, text = [], []
    for i in stream:
        text.append(i)
        if i == 2 and len(text) in {len(ids_of(r[1], 2)) for r in edge_rows} and any(text == ids_of(r[1], 2).tolist() for r in edge_rows):
            texts.append(tuple(text))
            text = []
    assert not text and sorted(texts) == sorted(tuple(ids_of(r[1], 2).tolist()) for r in edge_rows)


def test_the_last_stage_keeps_the_ids(spark, sf, edge_docs):
    pieces = corpus_pipeline.STAGES[-1][1](spark, edge_docs, sf)
    assert dict(pieces.dtypes)["ids"] == "binary" and "ids" not in op5_curve_packing(spark, sf).columns
    assert all(len(p.ids) == 4 * p.length for p in pieces.collect())


def test_hilbert_curve_visits_every_cell_once_in_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = curve_packing.hilbert(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_curve_keys_are_those_of_the_sums_of_signs():
    rng, signs = np.random.default_rng(3), curve_packing.projection(1_000)
    lengths = np.array([0, 1, 1, 5, 300, 0, 4_000])
    ids = rng.integers(0, 1_000, lengths.sum()).astype("<u2")
    ids[-4_000:] = ids[-1]  # far beyond the grid
    documents = np.split(ids, np.cumsum(lengths)[:-1])
    spread = np.array([signs[d].sum(0, dtype=np.float64) / np.sqrt(max(len(d), 1)) for d in documents])
    grid = np.clip((spread + 4) / 8 * 256, 0, 255).astype(np.int64)
    assert curve_packing.curve_keys(ids, lengths, signs).tolist() == curve_packing.hilbert(grid, 8).tolist()


def test_queries_over_the_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    expected = expect_records(rows)
    got = {r.doc_id: (r.start, [(r.n_tokens, r.ids_crc32)]) for r in op2_binary_index(spark, sf).collect()}
    assert got == expected
    check_packing(rows, op5_curve_packing(spark, sf).collect(), 4096)


def test_empty_table(no_docs):
    assert binary_index.id_records(no_docs, TOKENIZER).count() == 0
    assert curve_packing.pack(no_docs, TOKENIZER).count() == 0
