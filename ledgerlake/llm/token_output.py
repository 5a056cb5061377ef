"""Token ids in a byte-aligned variable-length file format.

Format, a Parquet folder of blocks in ascending document order. Ids are
replaced by their frequency rank over the whole corpus (0 is the most
frequent; ties by id), so frequent ids take one byte. Per four ranks there is
one control byte, two bits a rank for its length of one to four bytes; control
bytes and data bytes are kept apart. Every document's stream starts on a byte
of its own, so a block is the concatenation of its documents' control bytes
and of their data bytes, and a document can be decoded alone. A block row holds
``part, block`` (their order is the order of documents), ``doc_ids``,
``n_tokens`` per document, ``control`` and ``data``. Beside it, ``ranks`` lists
the id of every rank. Decoding looks the four lengths of a control byte up in
a table of 256 rows, and gathers bytes with numpy.

At scale: texts are tokenized once; a worker keeps the ids of the words and pieces
of words it has met (the tokenizer never joins text across white space or across
its own cuts, so a text's ids are its pieces' ids in a row) in caches of ``CACHE`` each. The ids go to the
shared folder; counts by id, at most a vocabulary of them, are all that reach
the driver. Documents are dealt out by ranges of (id, text hash) and sorted
inside a range, so repeated ids don't meet in one task. Running starts are
prefix sums of block totals, in two levels.

Defined results: a null or empty text has only the end id; documents with a
null doc_id come first; repeated ids follow one another in the order of a hash
of their text, and equal rows in any order; an empty table writes an empty
folder and gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import output_path
from .common import row_hash, slices, table

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
CACHE = 1_000_000         # words, and pieces of words, that a worker remembers
BLOCK_IDS = 1_000_000     # ids after which a block ends
RANGE_BYTES = 32 << 20    # bytes of ids in one range of documents

# Lengths of the four ranks of a control byte, by table.
_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


# ------------------------------------------------------------------------ coding
def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    r = ranks.astype("<u4")
    length = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    code = np.zeros(-(-len(r) // 4) * 4, dtype=np.uint8)
    code[:len(r)] = length - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < length[:, None]
    return control.astype(np.uint8).tobytes(), r.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """Ranks of consecutive streams with ``counts`` ranks each."""
    counts = np.asarray(counts, dtype=np.int64)
    lengths = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()
    slots = -(-counts // 4) * 4                      # padded to whole control bytes
    first = np.cumsum(slots) - slots
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths = lengths[np.repeat(first, counts) + nth].astype(np.int64)
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, 4):
        longer = lengths > k
        if not longer.any():
            break
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# -------------------------------------------------------------------- tokenizing
# How the word tokenizer normalises and cuts; what its cuts are for texts of
# characters up to U+012F (which NFC leaves alone and Python lower-cases like the
# tokenizer), and which texts and words those are.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIMPLE_TEXT = re.compile(r"[\t\n\r !-~¡-į]*")
_SIMPLE = re.compile(r"[!-~¡-į]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-į]+|[0-9²³¹¼-¾]|[^\t\n\r a-zªµºß-öø-į0-9²³¹¼-¾]+")


def _cuts_like_this(config: dict) -> bool:
    """Whether a tokenizer lower-cases, cuts by ``CUTS`` and marks the end of a piece."""
    steps = lambda part, key: [s for s in ((config.get(part) or {}).get(key) or [])]
    normal = [s.get("type") for s in steps("normalizer", "normalizers")]
    cut = [(s.get("pattern") or {}).get("Regex") for s in steps("pre_tokenizer", "pretokenizers") if s.get("type") == "Split"]
    return normal == ["NFC", "Replace", "Lowercase"] and cut == [CUTS] and config["model"].get("end_of_word_suffix") == "</w>"


class WordEncoder:
    """Ids of texts as little-endian bytes of the narrowest type for the vocabulary.

    A text of ``_SIMPLE_TEXT`` characters is cut into the pieces that the tokenizer
    cuts it into (letters, single digits, other marks), and the ids of every piece
    are remembered: ``Word``, ``word,`` and ``words.`` share theirs. Pieces not met
    before are encoded many to a call; the end-of-word suffix of their last token tells
    them apart again. Other texts go word by word between white space, and words of other
    characters, like all words of tokenizers that cut otherwise, are encoded whole.
    """

    def __init__(self, path: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.size = max(self.tok.get_vocab_size(with_added_tokens=True), END_ID + 1)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        added = sorted(self.tok.get_added_tokens_decoder().items())
        self.marks = re.compile("|".join(re.escape(a.content) for _, a in added)) if added else None
        # a mark that is always one id of its own separates words in one call
        self.mark, self.mark_id = (added[-1][1].content, added[-1][0]) if added else (None, None)
        self.ends = np.zeros(self.size, dtype=bool)
        self.by_piece = _cuts_like_this(json.loads(self.tok.to_str()))
        for token, i in (self.tok.get_vocab(with_added_tokens=False).items() if self.by_piece else ()):
            self.ends[i] = token.endswith("</w>")
        self.cache: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.most = cache

    def _whole(self, words: list[str]) -> None:
        """Encode words as they are, many to a call if a mark can separate them."""
        odd = [w for w in words if self.mark is None or self.marks.search(w)]
        for w, e in zip(odd, self.tok.encode_batch_fast(odd, add_special_tokens=False)):
            self.cache[w] = np.array(e.ids, dtype=self.kind).tobytes()
        if len(odd) < len(words):
            skip = set(odd)
            plain = [w for w in words if w not in skip]
            groups = [plain[i:i + 256] for i in range(0, len(plain), 256)]
            glue = f"\n{self.mark}\n"
            for g, e in zip(groups, self.tok.encode_batch_fast([glue.join(g) for g in groups], add_special_tokens=False)):
                ids = np.array(e.ids, dtype=self.kind)
                cut = np.flatnonzero(ids == self.mark_id)
                self._keep(self.cache, g, ids, [0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)])

    def _keep(self, cache: dict[str, bytes], keys: list[str], ids: np.ndarray, begin: list[int], end: list[int]) -> None:
        raw, w = ids.tobytes(), self.kind.itemsize
        for key, a, b in zip(keys, begin, end):
            cache[key] = raw[a * w:b * w]

    def _learn_pieces(self, met: set[str]) -> None:
        new = met.difference(self.pieces)
        if len(self.pieces) + len(new) > self.most:      # full: go on with what these texts share with it
            self.pieces = {p: self.pieces[p] for p in met if p in self.pieces}
        pieces = list(new)
        groups = [pieces[i:i + 1000] for i in range(0, len(pieces), 1000)]
        for g, e in zip(groups, self.tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype=self.kind)
            end = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(end) != len(g) or end[-1] != len(ids):
                raise RuntimeError("the tokenizer cuts words otherwise than its configuration says")
            self._keep(self.pieces, g, ids, [0, *end[:-1]], end)

    def _learn(self, words: list[str]) -> None:
        cut = {w: _PIECES.findall(w.lower()) for w in words if self.by_piece and _SIMPLE.fullmatch(w) and not self.marks.search(w)}
        if cut:
            self._learn_pieces(set().union(*cut.values()))
        get = self.pieces.__getitem__
        for w, p in cut.items():
            self.cache[w] = b"".join(map(get, p))
        if len(cut) < len(words):
            self._whole([w for w in words if w not in cut])

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        met = set().union(*split)
        new = met.difference(self.cache)
        if len(self.cache) + len(new) > self.most:
            self.cache = {w: self.cache[w] for w in met if w in self.cache}
            new = met.difference(self.cache)
        if new:
            self._learn(list(new))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        split = [_PIECES.findall(t.lower()) for t in texts]
        self._learn_pieces(set().union(*split))
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in split]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        simple = [self.by_piece and t is not None and _SIMPLE_TEXT.fullmatch(t) is not None and not self.marks.search(t) for t in texts]
        pieces = iter(self._by_pieces([t for t, ok in zip(texts, simple) if ok]))
        words = iter(self._by_words([t or "" for t, ok in zip(texts, simple) if not ok]))
        end = np.array([END_ID], dtype=self.kind).tobytes()
        return [next(pieces if ok else words) + end for ok in simple]


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """The worker's encoder: one task after another goes on with its cache."""
    return WordEncoder(path)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, tie, ids) with the end id appended, ids as little-endian bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        for b in batches:
            for lo, hi in slices(b, "text"):
                s = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), s.column("tie"), pa.array(enc.encode(s.column("text").to_pylist()), pa.binary())],
                    names=["doc_id", "tie", "ids"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(["text"]).alias("tie"),
                      F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, tie long, ids binary")


def rank_table(ids: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """Token id of every rank: by falling count, then by id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), dtype=kind), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["id", "n"])

    counts = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(size, dtype=np.int64)
    n[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    return np.lexsort((np.arange(size), -n)).astype(np.uint32)


# ----------------------------------------------------------------------- writing
_BLOCK = "part long, block long, doc_ids array<bigint>, n_tokens array<bigint>, control binary, data binary"
_BLOCK_TYPE = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                         ("n_tokens", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])


def _block_rows(batches: Iterator[pa.RecordBatch], rank: np.ndarray, kind: np.dtype, block_ids: int) -> Iterator[pa.RecordBatch]:
    """The sorted documents of a range as blocks of coded streams."""
    part, block = TaskContext.get().partitionId(), 0
    docs: list[tuple] = []
    total = 0

    def packed():
        ids, n, control, data = zip(*docs)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([n], pa.list_(pa.int64())), pa.array([b"".join(control)], pa.binary()), pa.array([b"".join(data)], pa.binary())],
            schema=_BLOCK_TYPE)

    for b in batches:
        for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
            ranks = rank[np.frombuffer(raw, dtype=kind)]
            docs.append((doc_id, len(ranks), *encode_ranks(ranks)))
            total += len(ranks)
            if total >= block_ids:
                yield packed()
                docs, total, block = [], 0, block + 1
    if docs:
        yield packed()


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write ``docs`` in the format under ``path`` and return its block rows read back."""
    spark = docs.sparkSession
    enc = WordEncoder(tokenizer)
    kind, size = enc.kind, enc.size
    first = f"{path}/ids"
    tokenized(docs, tokenizer).write.option("compression", "zstd").parquet(first)
    ids = spark.read.schema("doc_id long, tie long, ids binary").parquet(first)
    id_of = rank_table(ids, kind, size)
    rank = np.empty(size, dtype=np.uint32)
    rank[id_of] = np.arange(size, dtype=np.uint32)
    rank_of = spark.sparkContext.broadcast(rank)
    spark.createDataFrame(pa.table({"rank": pa.array(range(size), pa.int64()), "id": pa.array(id_of, pa.int64())})).coalesce(1).write.parquet(f"{path}/ranks")
    held = ids.agg(F.sum(F.length("ids"))).first()[0] or 0
    ranges = max(spark.sparkContext.defaultParallelism, -(-held // RANGE_BYTES))
    blocks = (ids.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "tie")
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "ids")
              .mapInArrow(lambda it: _block_rows(it, rank_of.value, kind, block_ids), _BLOCK))
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")
    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks")


# ----------------------------------------------------------------------- reading
def read_tokens(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """What the files hold: documents (doc_id, part, block, at, n_tokens, ids),
    ids as little-endian unsigned 32-bit numbers, ``at`` counted from the block's
    start; and (part, block, start), the ids before each block. Apart, so that
    the ids need not be shuffled to get their starts."""
    id_of = spark.sparkContext.broadcast(
        spark.read.parquet(f"{path}/ranks").orderBy("rank").toArrow().column("id").to_numpy().astype("<u4"))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    totals = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    by_part = totals.groupBy("part").agg(F.sum("n").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    by_part = by_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = (totals.withColumn("in_part", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(by_part, "part").select("part", "block", (F.col("base") + F.col("in_part")).alias("start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = id_of.value
        for b in batches:
            for r in b.to_pylist():
                n = np.array(r["n_tokens"], dtype=np.int64)
                ids = table_[decode_ranks(r["control"], r["data"], n)]
                end = np.cumsum(n)
                cut = [ids[x:y].tobytes() for x, y in zip((end - n).tolist(), end.tolist())]
                for i in range(0, len(n), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r["doc_ids"][i:i + 500], pa.int64()), pa.array([r["part"]] * len(n[i:i + 500]), pa.int64()),
                         pa.array([r["block"]] * len(n[i:i + 500]), pa.int64()), pa.array((end - n)[i:i + 500]), pa.array(n[i:i + 500]),
                         pa.array(cut[i:i + 500], pa.binary())], names=["doc_id", "part", "block", "at", "n_tokens", "ids"])

    rows = blocks.mapInArrow(run, "doc_id long, part long, block long, at long, n_tokens long, ids binary")
    return rows, starts


def digest_rows(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    rows, starts = read_tokens(spark, path)
    small = rows.select("doc_id", "part", "block", "at", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return (small.join(starts, ["part", "block"])
            .select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def token_output(docs: DataFrame, *, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Encode, write, read back: one digest row per document."""
    import public_tokenizers

    spark = docs.sparkSession
    path = path or output_path(spark, "llm-tokens")
    write_tokens(docs, path, tokenizer=tokenizer or public_tokenizers.path(TOKENIZER))
    return digest_rows(spark, path)


def op6_token_output(spark, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))
