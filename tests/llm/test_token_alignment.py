import hashlib
from collections import Counter

import public_tokenizers
import pytest

from sqlloom.llm import token_alignment as ta
from sqlloom.llm.queries import op12_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """Plain restatement with the libraries themselves: byte offsets of both encodings, end by end."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    decode = {v: k for k, v in enumerate(bytes(range(256)))}
    per_doc, links_all = [], Counter()
    for doc, text in rows:
        if not text:
            per_doc.append((doc, None))
            continue
        want = (" " + text).encode()
        enc = a.encode(" " + text, add_special_tokens=False)
        ids_a = enc.ids
        ta_bytes = [ta.vocabularies(A, B)[2][i] for i in ids_a]
        ids_b = b.encode(text)
        tb_bytes = []
        for i in ids_b:
            p = b.id_to_piece(i)
            tb_bytes.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i) or b.is_unknown(i) else p.replace("▁", " ").encode())
        if b"".join(ta_bytes) != want or b"".join(tb_bytes) != want:
            per_doc.append((doc, None))
            continue
        end_a, pos = {}, 0
        for k, t in enumerate(ta_bytes):
            pos += len(t)
            end_a[pos] = k
        groups, links, gb, pos, first_a = [], [], [], 0, 0
        for k, t in enumerate(tb_bytes):
            pos += len(t)
            gb.append(ids_b[k])
            if pos in end_a:
                last = end_a[pos]
                groups.append((list(ids_a[first_a : last + 1]), list(gb)))
                first_a = last + 1
                links.append((ids_a[last], ids_b[k]))
                gb = []
        links_all.update(links)
        per_doc.append((doc, (len(ids_a), len(ids_b), groups, links)))
    best = {}
    for (x, y), n in links_all.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc, got in per_doc:
        if got is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = got
        digest = hashlib.sha256(";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups).encode()).hexdigest()
        out.append((doc, n_a, n_b, len(groups), len(links), sum(links_all[l] == best[l[1]] for l in links), sum(links_all[l] for l in links), digest))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return sorted((tuple(r) for r in ta.alignment(df, A, B).select(*COLUMNS).collect()), key=repr)


ROWS = [
    (1, "Hello world, this is a test."),
    (2, "Hello world, this is another test."),
    (3, "Unusual tokens: ünïcödé, 中文字符, emoji 😀 and <|endoftext|> inside."),
    (4, None),
    (5, ""),
    (6, "Two  spaces\nand a new line"),
    (7, "Hello world, this is a test."),
    (None, "a row without an id, hello world"),
    (8, "x" * 3000),
    (9, "The quick brown fox jumps over the lazy dog. " * 50),
]


def test_by_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_identity_map_is_same_bytes():
    _, _, bytes_a, bytes_b, same = ta.vocabularies(A, B)
    found = [i for i in range(len(same)) if same[i] >= 0]
    assert len(found) > 1000
    assert all(bytes_a[i] == bytes_b[same[i]] for i in found)


def test_edge_rows(spark, edge_docs, edge_rows):
    got = sorted((tuple(r) for r in ta.alignment(edge_docs, A, B).select(*COLUMNS).collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in edge_rows])


def test_empty_table(no_docs):
    assert ta.alignment(no_docs, A, B).count() == 0


def test_query_by_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op12_token_alignment(spark, sf).collect()), key=repr)
    assert got == brute(rows)
    assert sum(1 for r in got if r[3] > 0) > len(got) / 2


def covered_texts():
    """Every covered character in several places, and seeded strings of the characters that part words."""
    import random

    texts = [f"a{c}b {c}{c} 1{c}'{c}s  {c}\n{c}" for c in ta.COVERED]
    rng = random.Random(12)
    marks = list("  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0''stmdrevlaAé½²ªº\xad19_.,<|>’“–\x00\x7f")
    texts += ["".join(rng.choices(marks, k=rng.randint(1, 60))) for _ in range(3000)]
    return [*texts, "it's we'll I'VE  don't\n\n  x <|endoftext|> y", "z" * 3000, " ", "\n"]


def test_word_ids_are_those_of_whole_texts(monkeypatch):
    a = ta.vocabularies(A, B)[0]
    words = ta.ByteLevelWords(a)
    texts = [*covered_texts(), "中文 字符 and words", "x́y ٣   z", "😀 it's"]
    want = [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]
    assert [i.tolist() for i in words.encode(texts)] == want
    assert max(map(len, words.cache)) <= ta.CACHED_LENGTH
    # Words that were met are not sent again, nor after a change of generations.
    monkeypatch.setattr(ta, "CACHED_WORDS", 10)
    sent = []
    monkeypatch.setattr(words, "_whole", lambda some: sent.extend(some) or [])
    for _ in range(3):
        assert [i.tolist() for i in words.encode(["it's we'll", "it's"])] == [e.ids for e in a.encode_batch(["it's we'll", "it's"], add_special_tokens=False)]
    assert not sent


def test_other_tokenizers_get_whole_texts():
    import tokenizers

    a = tokenizers.Tokenizer.from_file(A)  # special tokens in texts are tokens here
    words = ta.ByteLevelWords(a)
    assert not words.by_word
    assert [i.tolist() for i in words.encode(["x <|endoftext|> y"])] == [a.encode("x <|endoftext|> y", add_special_tokens=False).ids]
