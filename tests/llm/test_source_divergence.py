"""The source audit against sums written out term by term, and its defined cases."""

import re
from collections import Counter, defaultdict

import numpy as np

from ledgerlake.llm import source_divergence as S

SCHEMA = "doc_id long, text string, lang string, source string, value string, term string"
ROWS = [
    (1, "Alpha beta beta gamma", "en", "a", "x", "y"), (2, "alpha BETA delta", "en", "b", None, None),
    (3, "alpha, gamma-gamma beta!", "en", "c", None, None), (4, "Épée épée alpha beta", "en", "a", None, None),
    (4, "Épée épée alpha beta", "en", "a", None, None), (5, None, "en", "nothing", None, None),
    (6, "12 34 --", "en", "a", None, None), (7, "eins zwei", "de", "a", None, None), (8, "drei", "de", "b", None, None),
    (None, "alpha alpha", None, None, None, None), (9, "alpha 漢字 漢字", "", "b", None, None), (10, "漢字alpha", "", "b", None, None),
    (11, "alpha x 漢字", "", "c", None, None), (12, "alpha " * 5000 + "beta", "en", "long", None, None), (13, "", "fr", "only", None, None),
]


def brute(rows, min_docs=3, top=200):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        groups.add((lang, source))
        by[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang, source in groups:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        rate = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        mine = rate(by[lang, source])
        whole = rate(sum((by[g] for g in groups if g[0] == lang), Counter()))
        pair = []
        for other in groups:
            if other[0] == lang and other[1] != source:
                q = rate(by[other])
                pair.append((other[1], sum((mine[t] - q[t]) ** 2 // q[t] for t in kept)))
        term = [(t, (mine[t] - whole[t]) ** 2 // whole[t]) for t in kept if by[lang, source][t] and mine[t] > whole[t]]
        for part, found in (("pair", pair), ("term", term)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, item, v, k) for k, (item, v) in enumerate(found, 1) if part == "pair" or k <= top}
    return out


def test_against_written_out_sums(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)              # several blocks even here
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [tuple(r) for r in S.divergence(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(ROWS)
    assert set(map(tuple, S.divergence(df, min_docs=1, top=1).collect())) == brute(ROWS, 1, 1)


def test_empty_table(spark):
    assert S.divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_flushes_keep_all_counts(spark, monkeypatch):
    monkeypatch.setattr(S, "HELD", 2)
    import pyarrow as pa
    b = pa.RecordBatch.from_pylist([{"lang": "en", "source": "a", "text": "x y z x"}, {"lang": "en", "source": "a", "text": "x"}])
    sums = Counter()
    for out in S._count_rows(iter([b])):
        for r in out.to_pylist():
            if r["term"] is not None:
                sums[r["term"]] += r["n"]
    assert sums == {"x": 3, "y": 1, "z": 1}


def test_accumulated_rows_equal_dense_sums():
    rng = np.random.default_rng(3)
    peers, n = 7, 400
    counts = rng.poisson(0.4, (n, peers)) * rng.integers(1, 50, (n, 1))
    counts = counts[counts.any(axis=1)]
    total = counts.sum(axis=0)
    rate = 1 + 10**9 * (counts + 1) // (total + len(counts))
    zero = 1 + 10**9 // (total + len(counts))
    term, group = np.nonzero(counts)
    got = dict(S.accumulate(term, group, rate[term, group], zero))
    for g in range(peers):
        want = [int(S.distance(rate[:, g], rate[:, h]).sum()) for h in range(peers)]
        assert got[g].tolist() == want
