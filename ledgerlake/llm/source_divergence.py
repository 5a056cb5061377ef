"""Source divergence audit by Gustavson row accumulation.

For every (lang, source) group: how far its word rates lie from those of each
other source of the language (part ``pair``), and which words it overuses most
against the language as a whole (part ``term``).

Terms are runs of letters (ASCII letters lower-cased, every code point from 128
on counts as a letter). A language keeps the V terms that occur in at least
``MIN_DOCS`` of its documents. A group gives a kept term with count c the rate
p = 1 + floor(10^9 (c + 1) / (N + V)), N its count over kept terms, and the
distance of two rates is f(p, q) = floor((p - q)^2 / q). A pair's value sums f
over all V terms, those without an occurrence in either group too.

The sum is a sparse matrix product under another ring, so it is computed as
Gustavson multiplies rows: the term-major index (term -> its groups' rates) is
cut into blocks of terms; inside a block each group's row scatters its terms
through the index into a dense accumulator with one cell per peer. No pair of
postings ever leaves a task. A cell first holds the sum as if the peer had no
occurrence at all and as if the group had none at the peer's terms; a common
term then adds

    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

with p0, q0 the rates of a count of zero, which corrects both zero baselines.
All numbers are 64-bit integers: rates are at most 10^9 + 1 and a block's sums at
most (2 * 10^9 + V)^2.

At scale:

* one pass over the texts; a task adds up (lang, source, term) in a bounded
  table before it sends anything, and the shuffle is by (lang, term), so a
  source with a third of the rows is spread over its terms;
* the term-major index has one row per kept term, whose postings are at most
  one per source. A block takes ``BLOCK`` postings, or the square of the number of
  sources where that is more, so the rows that blocks return are never more
  than the postings they read;
* the top words of a group are cut on the map side (window group limit).

Defined results: null text, lang and source are read as empty text, also as a
group of their own; a row repeated whole is a document each time; groups
without terms are listed with every peer (and languages with V = 0 with value 0);
a group that is alone in its language has no ``pair`` rows; equal values rank by
the item's UTF-8 bytes; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

MIN_DOCS = 3              # documents of a language that a kept term occurs in
SCALE = 1_000_000_000     # rates are parts of this
TOP = 200                 # ranks of part ``term``
BLOCK = 500_000           # postings of a block of the index, at least
HELD = 200_000            # (group, term) cells a task holds before it sends them on
SALTS = 16                # a source's postings are joined to its totals in so many parts

# ASCII letters lower-cased, bytes of other code points kept, all else a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


# ------------------------------------------------------------------------ counts
_COUNTS = "lang string, source string, term string, n long, docs long"


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term) of the task's rows, sent
    on whenever ``HELD`` cells are held. A row with a null term names a group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    named: set[tuple[str, str]] = set()

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            words = list(n)
            for i in range(0, len(words), 50_000):
                w = words[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(w), pa.string()), pa.array([source] * len(w), pa.string()), pa.array(w, pa.binary()).cast(pa.string()),
                     pa.array([n[x] for x in w], pa.int64()), pa.array([docs[x] for x in w], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
        held.clear()

    cells = 0
    for b in batches:
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
            if (lang, source) not in named:
                named.add((lang, source))
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([source]), pa.array([None], pa.string()),
                                                  pa.array([0]), pa.array([0])], names=["lang", "source", "term", "n", "docs"])
            if (lang, source) not in held:
                held[lang, source] = (Counter(), Counter())
            n, docs = held[lang, source]
            here = Counter(terms(text))
            cells -= len(n)
            n.update(here)
            cells += len(n)
            docs.update(here.keys())
            if cells >= HELD:
                yield from flush()
                cells = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs); one row with a null term per group."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
    rows = docs.select(text("lang"), text("source"), text("text")).mapInArrow(_count_rows, _COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ------------------------------------------------------------------ term-major index
def _rate(count: str, total: str, kept: str):
    """1 + floor(10^9 (count + 1) / (total + kept)), exact whatever the counts."""
    return F.expr(f"1 + (cast({SCALE} as decimal(20,0)) * cast({count} + 1 as decimal(18,0))) div cast({total} + {kept} as decimal(20,0))").cast("long")


def index_tables(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(postings, groups), both stored. Postings: lang, term, source, n, p and the
    language's rate q; groups: lang, source, number of its language, rate of zero, V."""
    counts = stored(term_counts(docs), "divergence-counts")
    index = (counts.filter("term is not null").groupBy("lang", "term")
             .agg(F.collect_list(F.struct("source", "n")).alias("postings"), F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
             .filter(F.col("docs") >= min_docs).drop("docs"))
    index = stored(index, "divergence-index")
    by_lang = index.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("lang_total"),
                                        F.sum(F.size("postings")).alias("held"))
    flat = index.select("lang", "term", "n_lang", F.explode("postings").alias("x")).select("lang", "term", "n_lang", "x.source", "x.n")
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left")
              .join(by_lang, "lang", "left"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "lang_total", "held")]
    groups = groups.select("lang", "source", *zero)
    numbered = (groups.withColumn("g", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1)
                .withColumn("sources", F.count(F.lit(1)).over(W.partitionBy("lang"))))
    blocks = F.ceil(F.col("held") / F.greatest(F.lit(BLOCK), F.col("sources") * F.col("sources")))
    groups = stored(numbered.withColumn("blocks", F.greatest(F.lit(1), blocks).cast("long"))
                    .withColumn("p0", F.when(F.col("v") > 0, _rate("0L", "total", "v"))), "divergence-groups")
    # a source with most of the postings meets its totals in SALTS tasks
    sides = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    postings = (flat.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
                .join(sides, ["lang", "source", "salt"])
                .select("lang", "term", "source", "g", "n", "p0", _rate("n", "total", "v").alias("p"),
                        _rate("n_lang", "lang_total", "v").alias("q"), F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")))
    return stored(postings, "divergence-postings"), groups


# -------------------------------------------------------------- row accumulation
def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def accumulate(term: np.ndarray, group: np.ndarray, rate: np.ndarray, zero: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, sum of f over the block's terms against every peer) for all groups.

    ``term``, ``group`` and ``rate`` are the block's postings, ``zero`` the rate of
    every group without an occurrence."""
    peers = len(zero)
    order = np.argsort(term, kind="stable")                # the term-major index of the block
    _, first, size = np.unique(term[order], return_index=True, return_counts=True)
    col, val = group[order], rate[order]
    rows = np.argsort(col, kind="stable")                  # the same postings by group
    start = np.searchsorted(col[rows], np.arange(peers + 1))
    row_of = np.repeat(np.arange(len(first)), size)        # term of each posting of the index
    # what a peer's own terms give against a group that has none of them, by distinct rate
    # distinct rates of every group's own terms and how often each occurs
    own = [np.unique(val[rows[start[h]:start[h + 1]]], return_counts=True) for h in range(peers)]
    peer = np.repeat(np.arange(peers), [len(q) for q, _ in own])
    q_all, k_all = (np.concatenate([x[i] for x in own]) for i in (0, 1))
    for g in range(peers):
        mine = rows[start[g]:start[g + 1]]
        flat = distance(zero[g], zero)                     # neither group has the term
        acc = flat * len(first)
        for p, k in zip(*own[g]):                          # the group has it, the peer may not
            acc += k * (distance(p, zero) - flat)
        np.add.at(acc, peer, k_all * (distance(zero[g], q_all) - flat[peer]))   # the peer has it
        at = 0
        while at < len(mine):                              # scatter the row, a bounded part at a time
            t = row_of[mine[at:at + 4096]]
            n = size[t]
            to = np.repeat(first[t] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            p, q, h = np.repeat(val[mine[at:at + 4096]], n), val[to], col[to]
            np.add.at(acc, h, distance(p, q) - distance(p, zero[h]) - distance(zero[g], q) + flat[h])
            at += 4096
        yield g, acc


def _block_sums(key: tuple, postings: pa.Table, groups: pa.Table) -> pa.Table:
    lang, peers = key[0].as_py(), groups.num_rows
    rows = [pa.table({"g": pa.array([], pa.int32()), "h": pa.array([], pa.int32()), "value": pa.array([], pa.int64())})]

    def add(g: int, acc: np.ndarray) -> None:
        other = np.flatnonzero(np.arange(peers) != g).astype(np.int32)
        rows.append(pa.table({"g": np.full(len(other), g, dtype=np.int32), "h": other, "value": acc[other]}))

    if postings.num_rows:
        zero = np.empty(peers, dtype=np.int64)
        zero[groups.column("g").to_numpy()] = groups.column("p0").to_numpy()
        term = postings.column("term").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        for g, acc in accumulate(term, postings.column("g").to_numpy().astype(np.int64), postings.column("p").to_numpy(), zero):
            add(g, acc)
    else:
        for g in range(peers):                             # a block without terms: every peer is still named
            add(g, np.zeros(peers, dtype=np.int64))
    out = pa.concat_tables(rows)
    return pa.table({"lang": pa.array([lang] * out.num_rows, pa.string()), **{c: out.column(c) for c in ("g", "h", "value")}})


def pair_values(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    sides = groups.select("lang", "g", "p0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    blocks = (postings.select("lang", "block", "term", "g", "p").groupBy("lang", "block")
              .cogroup(sides.groupBy("lang", "block")).applyInArrow(_block_sums, "lang string, g int, h int, value long"))
    sums = blocks.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    name = lambda number, of: groups.select("lang", F.col("g").alias(number), F.col("source").alias(of))
    return (sums.join(name("g", "source"), ["lang", "g"]).join(name("h", "item"), ["lang", "h"])
            .select("lang", "source", "item", "value"))


def divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of all groups."""
    postings, groups = index_tables(docs, min_docs)
    pairs = pair_values(postings, groups)
    over = postings.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    w = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [df.withColumn("rank", F.row_number().over(w)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
              for part, df in (("pair", pairs), ("term", over))]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         row_number() OVER () AS r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM words
  GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n
        FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cnt GROUP BY lang, source),
rates AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + s.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (s.total + s.v) AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN sizes s ON g.lang = s.lang
  LEFT JOIN tot t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN rates x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN rates y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
over_used AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM rates WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM over_used) z
  WHERE rank <= 200)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""
