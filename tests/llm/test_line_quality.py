"""Chain sums against enumeration, gradients, held-out accuracy, edge texts."""
import itertools
import zlib

import numpy as np

from ledgerlake.llm import line_quality as L

SF = "/root/testdata/sf0.01"


def enumerate_paths(unary, crf):
    n = len(unary)
    total, good, pair = 0.0, np.zeros(n), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=n):
        s = crf.ends[0][path[0]] + crf.ends[1][path[-1]] + sum(unary[i] * y for i, y in enumerate(path))
        s += sum(crf.pair[a, b] for a, b in zip(path, path[1:]))
        p = np.exp(s)
        total += p
        good += p * np.array(path)
        for a, b in zip(path, path[1:]):
            pair[a, b] += p
    return good / total, pair / total, np.log(total)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(3)
    crf = L.LineCrf()
    crf.pair, crf.ends = rng.normal(size=(2, 2)), rng.normal(size=(2, 2))
    sizes = [3, 1, 5, 2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    unary = rng.normal(size=offsets[-1])
    single, pairs, log_z = crf.forward_backward(unary, offsets)
    at = np.flatnonzero(~np.isin(np.arange(len(unary)), offsets[:-1]))
    for a, b in zip(offsets[:-1], offsets[1:]):
        good, pair, z = enumerate_paths(unary[a:b], crf)
        assert np.allclose(np.exp(single[a:b, 1]), good)
        assert np.allclose(np.exp(pairs[(at >= a) & (at < b)]).sum(axis=0), pair)
        assert np.allclose(log_z[a:b], z)


def test_lines_and_offsets():
    feats, size, off = L.line_features(["a b\n\n c\n", None, "", " \t\n ", "x x x x x x x x"])
    assert np.diff(off).tolist() == [2, 1, 1, 1, 1]
    assert size[:2].tolist() == [3.0, 2.0]
    assert not feats[2:5].any()
    assert feats[5, 4] > 0.5 and feats[0, 4] == 0          # the same word again and again


def test_batches_do_not_change_scores():
    rng = np.random.default_rng(1)
    texts = ["\n".join("### " * int(rng.integers(3)) + "word other" for _ in range(rng.integers(1, 9))) for _ in range(30)] + [None, ""]
    crf = L.LineCrf()
    crf.w, crf.pair = rng.normal(size=3 * L.BASE + 1), rng.normal(size=(2, 2))
    whole = crf.quality(texts)
    assert np.allclose(whole, [crf.quality([t])[0] for t in texts])


def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in L.table(spark, SF, "labels").collect()}
    got = L.op8_line_quality(spark, SF).collect()
    assert len(got) == L.table(spark, SF, "documents").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert len(right) > 50 and np.mean(right) > 0.93


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(80)], "doc_id long, text string")
    fold = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(80)]
    a = spark.createDataFrame([(i, i % 2, "x") for i in range(80)], "doc_id long, quality int, score string")
    b = spark.createDataFrame([(i, (i + fold[i]) % 2, "x") for i in range(80)], "doc_id long, quality int, score string")
    assert L.training_sample(docs, a) == L.training_sample(docs, b)


def test_edges(spark, tmp_path):
    schema = "doc_id long, text string, score string, lang string"
    rows = [(i, "### " * 20 if i % 2 else "plain words of prose\nand more of them", None, "en") for i in range(40)]
    edge = [(100, None, "x", None), (101, "", "x", None), (None, "### ### ###", "x", None), (102, "plain words of prose\n" * 20_000, "x", None), (1, rows[1][1], None, "en")]
    docs = spark.createDataFrame(rows + edge, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lab = [(i, 1 - i % 2) for i in range(40)] + [(1, 0), (None, 1), (7, None)]
    spark.createDataFrame(lab, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in L.op8_line_quality(spark, str(tmp_path)).collect()}
    assert got[None].predicted == 0 and got[None].held_out is False and got[102].predicted == 1
    assert got[100].score == got[101].score
    none = L.scored(docs, L.fitted([]))
    assert all(abs(r.score - 0.5) < 1e-9 for r in none.collect())
    assert L.scored(docs.limit(0), L.fitted([])).collect() == []


def test_a_repeated_id_is_one_sample(spark):
    docs = spark.createDataFrame([(1, "same")] * 3000 + [(1, "again"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 5 + [(3, 0)], "doc_id long, quality int")
    assert L.training_sample(docs, labels) == [("again", 1), (None, 0)]


def test_no_labels_at_all(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    got = L.scored(docs, L.fitted(L.training_sample(docs, spark.createDataFrame([], "doc_id long, quality int")))).first()
    assert 0 <= got.score <= 1
