"""Base statistics by brute force, verdicts on planted outliers."""
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import quality_rules as Q

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = W.findall(t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    covered = {j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if W.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def corpus():
    rnd = random.Random(4)
    voc = [a + b for a in "abcdefghij" for b in ("ao", "éro", "xx", "tions")]
    clean = [" ".join(rnd.choice(voc) for _ in range(rnd.randrange(20, 300))) for _ in range(300)]
    odd = ["### ".join(rnd.choice(voc) for _ in range(80)) for _ in range(20)]
    edge = [None, "", " \n\t ", "a a a a a a a a a a a a", "one two three four five\n" * 4, "x\n\nx\n \nx", "\x0b\x0c\x1f    ",
            "a b c d e f a b c d e f a b c d e", "a|b <c> #", "p q r s t u v w x y p q r s t", " ".join(voc) * 400]
    return clean, odd, edge


def test_statistics_match_brute_force(spark):
    clean, odd, edge = corpus()
    texts = clean[:40] + odd[:3] + edge
    rows = [(i, t, None, "s", 1, "z") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, w string")
    got = {r.doc_id: tuple(r)[1:] for r in Q.statistics(df).withColumn("base_failed", Q.base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t), t


def test_outliers_go_and_clean_rows_stay(spark, tmp_path):
    clean, odd, edge = corpus()
    rows = [(i, t, "en", "s1") for i, t in enumerate(clean)]
    rows += [(1000 + i, t, "en", "s1" if i % 2 else None) for i, t in enumerate(odd)]
    rows += [(None, edge[-1], None, None), (2000, None, None, "s2"), (0, clean[0], "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("d2", F.lit("x"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op1_quality_rules(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert all(r.kept for r in got if r.doc_id is not None and r.doc_id < 1000)
    assert not any(r.kept for r in got if r.doc_id is not None and r.doc_id >= 1000)
    left = Q.reject_outliers(df)
    assert left.columns == df.columns
    assert left.count() == sum(r.kept for r in got)


def test_determinant_matches_numpy_concentration(spark):
    """The last concentration's centre is near the clean rows' mean although a fifth is far off."""
    rnd = np.random.default_rng(1)
    x = np.vstack([rnd.normal(0, 1, (800, 4)), rnd.normal(8, 1, (200, 4))])
    df = spark.createDataFrame([("g", i % Q.SALTS, *map(float, r)) for i, r in enumerate(x)],
                               "grp string, salt int, " + ", ".join(f"{f} double" for f in Q.FEATURES))
    p = Q._estimate(df).first()
    assert max(abs(p[f"m{i}"]) for i in range(4)) < 0.2
    assert all(0.7 < p[f"l{i}{i}"] < 1.6 for i in range(4))


def test_small_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert Q.op1_quality_rules(spark, str(tmp_path)).collect() == []
    few = spark.createDataFrame([(1, "### " * 3 + "a b c d e f g h i j", "en", "s")], schema)
    assert [r.kept for r in Q.judged(few).collect()] == [True]


def test_small_groups_have_their_own_estimate(spark):
    """60 rows of a style of their own stay, their outlier goes; one row more changes little; a table of 60 is judged."""
    rnd = random.Random(6)
    voc = [a + b for a in "abcdefghij" for b in ("ao", "éro", "xx", "tions")]
    long = [w + "en" for w in voc]
    text = lambda v: " ".join(rnd.choice(v) for _ in range(rnd.randrange(60, 300)))
    bad = "### ".join(rnd.choice(long) for _ in range(80))
    rows = [(i, text(voc), "en", "big") for i in range(400)] + [(1000 + i, text(long), "en", "small") for i in range(60)] + [(2000, bad, "en", "small")]
    rows += [(3000 + i, text(long), "en", "mid") for i in range(200)]
    verdicts = lambda some: {r.doc_id: r for r in Q.judged(spark.createDataFrame(some, "doc_id long, text string, lang string, source string")).collect()}
    full = verdicts(rows)
    assert [i for i in full if not full[i].kept] == [2000]
    less = verdicts(rows[:-1])
    assert max(abs(np.sqrt(full[i].d2) - np.sqrt(less[i].d2)) for i in range(3000, 3199)) < 0.5
    few = verdicts([r for r in rows if r[3] == "small"])
    assert [i for i in few if not few[i].kept] == [2000]


def test_every_statistic_can_reject_alone(spark):
    """Duplicate lines, repeated words and symbols, each over clean rows without any."""
    rnd = random.Random(7)
    words = iter(range(10 ** 6))
    line = lambda n: " ".join(f"w{next(words):06d}" for _ in range(n))
    clean = ["\n".join(line(rnd.randrange(6, 12)) for _ in range(rnd.randrange(8, 30))) for _ in range(250)]
    lines = "\n".join(f"{x}\n{line(8)}" for x in ["menu item"] * 20)                     # a third and more, no window of five repeated
    window = line(9)
    repeats = "\n".join([window, window, line(90)])                                       # 18 of 108 words
    symbols = "\n".join(line(9) + " #|" for _ in range(20))
    faint = ["\n".join([*[line(8) for _ in range(30)], "menu item", line(8), "menu item"]), line(200) + " #", "\n".join([*[line(10) for _ in range(20)], *["five words of one line"] * 2])]
    rows = [(i, t, "en", "s") for i, t in enumerate([*clean, *faint, lines, repeats, symbols])]
    got = {r.doc_id: r for r in Q.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i].base_failed for i in got)
    assert [i for i in got if not got[i].kept] == [253, 254, 255]
