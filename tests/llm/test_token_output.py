"""Round trips through the file format, against the tokenizer called on whole texts."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import token_output as T

TOK = public_tokenizers.path(T.TOKENIZER)


@pytest.mark.parametrize("sizes", [[0], [1], [5, 0, 3, 8], [1000], []])
def test_coding_round_trip(sizes):
    rnd = np.random.default_rng(len(sizes))
    streams = [(rnd.integers(0, 1 << 32, n, dtype=np.uint64) >> rnd.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32) for n in sizes]
    coded = [T.encode_ranks(s) for s in streams]
    out = T.decode_ranks(b"".join(c for c, _ in coded), b"".join(d for _, d in coded), np.array(sizes, dtype=np.int64))
    assert out.tolist() == [x for s in streams for x in s.tolist()]


def texts():
    rnd = random.Random(6)
    voc = ["Hello", "wörld", "it's", "日本語", "<|endoftext|>", "x<|startoftext|>y", "é", "́", "12,5", "a b", "\x1c", "Σ", "ΑΣ", "🙂"]
    out = ["".join(rnd.choice(voc) + rnd.choice([" ", "\n", "", "\t\r", " ", "\x0b"]) for _ in range(rnd.randrange(40))) for _ in range(80)]
    return [*out, None, "", " ", "word " * 30_000, "x" * 5000]


def want(rows):
    tok = Tokenizer.from_file(TOK)
    ids = {t: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in {t for _, t in rows}}
    return ids


def test_words_are_encoded_like_whole_texts():
    ts = texts()
    ids = want(list(enumerate(ts)))
    for cache in (10_000, 5):
        enc = T.WordEncoder(TOK, cache)
        for i in range(0, len(ts), 7):
            for t, raw in zip(ts[i:i + 7], enc.encode(ts[i:i + 7])):
                assert np.frombuffer(raw, enc.kind).tolist() == ids[t], t


def test_query_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "RANGE_BYTES", 20_000)
    rows = list(enumerate(texts()))
    rnd = random.Random(1)
    rows += [(7, rows[7][1]), (7, "another text of id seven"), (None, "nobody"), (-5, "first of all")]
    rnd.shuffle(rows)
    spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, ids string, part int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(T.op6_token_output(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda x: (x is not None, x or 0))
    ids = want(rows)
    at = 0
    left = [(i, t) for i, t in rows]
    for r in got:
        assert r.start == at
        at += r.n_tokens
        match = next(x for x in left if x[0] == r.doc_id and len(ids[x[1]]) == r.n_tokens
                     and zlib.crc32(np.array(ids[x[1]], "<u4").tobytes()) == r.ids_crc32)
        left.remove(match)
    assert not left


def test_ranks_follow_counts(spark, tmp_path):
    df = spark.createDataFrame([(1, "b b b b a a c")], "doc_id long, text string")
    T.write_tokens(df, f"{tmp_path}/t", tokenizer=TOK)
    tok = Tokenizer.from_file(TOK)
    ranks = [r.id for r in spark.read.parquet(f"{tmp_path}/t/ranks").orderBy("rank").limit(2).collect()]
    assert ranks == [tok.encode("b", add_special_tokens=False).ids[0], tok.encode("a", add_special_tokens=False).ids[0]]


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert T.op6_token_output(spark, str(tmp_path)).collect() == []


def test_pieces_give_the_tokenizer_s_own_ids():
    """Words cut into pieces, of characters that lower-casing and composing treat in their own way too."""
    tok = Tokenizer.from_file(TOK)
    rng = random.Random(4)
    alphabet = "abcABC'stredvml0129.,-_<|>éÉÀÿßŁłĮį×÷²½ª \t\n \u0085\u000b\u001c­ΣσςİKÅé漢"
    texts = ["It's O'Neil's ''s 'S 'LL x'd", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", ""]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 50))) for _ in range(1500)]
    enc = T.WordEncoder(TOK)
    assert enc.by_piece
    for text, raw in zip(texts, enc.encode(texts)):
        assert np.frombuffer(raw, dtype=enc.kind).tolist() == [*tok.encode(text, add_special_tokens=False).ids, T.END_ID], text


def test_other_tokenizers_encode_words_whole():
    assert not T._cuts_like_this({"model": {}, "normalizer": None, "pre_tokenizer": {"type": "Whitespace"}})
