"""The pipeline against a brute-force version of its stages on a small corpus."""
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from ledgerlake.llm import common, mixing
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_quality_rules import brute as statistics
from tests.llm.test_simhash import brute_components, brute_print

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


def corpus():
    rnd = random.Random(12)
    words = [a + b for a in "bcdfghjklm" for b in ("a", "en", "ör", "tion", "s")]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, text(25)) for i in range(4)] + [(9, None)]
    docs = [(i, text(rnd.randrange(12, 90))) for i in range(70)]
    docs += [(100 + i, docs[i][1]) for i in range(6)]                                     # exact copies
    docs += [(200 + i, docs[i + 10][1] + " " + rnd.choice(words)) for i in range(6)]      # near copies
    docs += [(300 + i, text(20) + " " + items[i][1] + " " + text(20)) for i in range(4)]  # benchmark passages
    docs += [(400, "few words"), (401, None), (402, ""), (403, (text(6) + " ") * 12), (404, text(3000)), (None, text(40))]
    rows = [(i, t, "en", rnd.choice(["a", "b", "c", None]), len(t or ""), "z") for i, t in docs]
    rows.append(rows[7])                                                                  # a row repeated whole
    rnd.shuffle(rows)
    return rows, items


def expected_before_mix(rows, items):
    good = [r for r in rows if not statistics(r[1])[5]]          # too few rows for the robust part
    comp = brute_components([(r[0], brute_print(r[1])) for r in good])
    kept, seen = [], set()
    for k, r in enumerate(good):
        if r[0] == comp[k] and (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            kept.append(r)
    dirty = {x[0] for x in contaminated([(r[0], r[1]) for r in kept], items) if x[5]}
    return [r for r in kept if r[0] is None or r[0] not in dirty]


def test_run_matches_brute_force(spark, tmp_path):
    rows, items = corpus()
    d = str(tmp_path)
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    clean = expected_before_mix(rows, items)

    out, frames = common.table(spark, d, "documents"), []
    for _, stage in C.STAGES[:-1]:
        out = common.stored(stage(spark, out, d), "test")
        assert out.columns == docs.columns
        frames.append(out)
    assert sorted(map(str, map(tuple, frames[2].collect()))) == sorted(map(str, clean))

    # the mix repeats whole rows, each at most three times, as often as its plan says
    plan = Counter()
    for r in mixing.mixed(spark.createDataFrame(clean, SCHEMA)).collect():
        plan[r.doc_id] += r.copies
    mixed = Counter(r.doc_id for r in frames[3].collect())
    assert {k: v for k, v in plan.items() if v} == dict(mixed) and max(mixed.values()) <= 3

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r[0]: r[1] for r in clean}
    want, at = [], 0
    for i in sorted(mixed, key=lambda x: (x is not None, x or 0)):
        ids = [*tok.encode(text[i], add_special_tokens=False).ids, 2]
        for _ in range(mixed[i]):
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    got = sorted([tuple(r) for r in C.run(spark, d).collect()], key=lambda r: r[1])
    assert got == want


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
