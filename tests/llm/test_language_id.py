"""Gradients by finite differences, held-out accuracy, defined edge results."""
import zlib

import numpy as np
import pytest

from ledgerlake.llm import language_id as L
from tests.conftest import SMOKE


def test_backpropagation_matches_finite_differences():
    rng = np.random.default_rng(0)
    net = L.GruNet(3, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    seq, mask = L.padded([b"abc", b"de", b"fghij"])
    label, weight = np.array([0, 1, 2]), np.array([1, 2, 1], np.float64)
    _, g = net.gradients(seq, mask, label, weight)
    for k, v in net.p.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        if k == "E":
            at = (ord("a"), 2)
        kept, e = v[at], 1e-4
        v[at] = kept + e
        up = net.gradients(seq, mask, label, weight)[0]
        v[at] = kept - e
        down = net.gradients(seq, mask, label, weight)[0]
        v[at] = kept
        assert g[k][at] == pytest.approx((up - down) / 2 / e, rel=2e-2, abs=1e-5), k


def test_held_out_accuracy(spark):
    docs = L.table(spark, SMOKE, "documents")
    lang = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    got = L.op10_language_id(spark, SMOKE).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    out = [r.lang_pred == lang[r.doc_id][0] for r in got if r.held_out]
    assert np.mean(out) > 0.95


def test_labels_and_held_out_texts_are_not_read(spark):
    rows = [(i, f"texto número {i} con palabras" if i % 2 else f"some words of number {i} the text", "es" if i % 2 else "en") for i in range(60)]
    flip = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else g) for i, t, g in rows]
    schema = "doc_id long, text string, lang string"
    assert L.training_sample(spark.createDataFrame(rows, schema)) == L.training_sample(spark.createDataFrame(flip, schema))


def test_edges(spark, tmp_path):
    long = "the words and the thing " * 20_000
    rows = [(i, "the thing and word here" if i % 2 else "le mot et la chose été", "en" if i % 2 else "fr") for i in range(40)]
    edge = [(100, None, "en"), (101, "", None), (102, "123 !? 4", "fr"), (103, long, None), (104, "x" * 50_000, None), (None, "le mot", None), (1, rows[1][1], "en")]
    df = spark.createDataFrame([(*r, "z", 1.0) for r in rows + edge], "doc_id long, text string, lang string, lang_pred string, score double")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in L.op10_language_id(spark, str(tmp_path)).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert got[100].score == 0.0 and got[103].lang_pred == "en" and got[None].lang_pred == "fr" and got[None].held_out is False


def test_nothing_to_learn_from(spark, tmp_path):
    df = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert L.identify(df, L.training_sample(df)).first().lang_pred == "und"
    assert L.identify(df.limit(0), []).collect() == []


def test_words_are_letters_with_their_marks():
    assert L.words_of("½ ② Ⅷ 12") == [] and L.words_of("नमस्ते, x1 e\u0301t") == ["नमस्ते", "x", "e\u0301t"]
    for word in ("नमस्ते" * 9, "x" * 70, "漢" * 30, "é"):
        pieces = L.pieces_of(word)
        assert b"".join(pieces).decode() == f"^{word}$" and all(len(p) <= L.PIECE for p in pieces)
        assert [p.decode() for p in pieces]                                   # each piece is whole characters


def test_texts_without_a_letter_are_undetermined(spark):
    rows = [(i, "the thing" if i % 2 else "le mot", "en" if i % 2 else "fr") for i in range(40)] + [(50, "½ ②", None), (51, "Ⅷ", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(df, L.training_sample(df)).collect()}
    assert got[50] == got[51] == ("und", 0.0) and got[1][0] == "en"


def test_a_repeated_id_is_one_sample(spark):
    df = spark.createDataFrame([(1, "same", "en")] * 3000 + [(1, "another", "en"), (3, "le mot", "fr")], "doc_id long, text string, lang string")
    assert L.training_sample(df) == [("another", "en"), ("le mot", "fr")]
