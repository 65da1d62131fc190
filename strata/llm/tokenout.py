"""Operator 8, token-ID output: ids of every document in range-coded blocks.

``write`` encodes texts with a public tokenizer, appends an end id to each,
orders the documents by id over range partitions, and writes blocks of at most
``BLOCK`` ids. A block is one frame of bytes: magic, counts, position, the
documents it holds a part of, checksums, and the range coder's payload; it
decodes without any other block. Frames are the rows of a Parquet table, so
that any store Spark writes to takes part in the commit of its tasks; the tree
of frequencies (of all ids, and of what follows the most frequent ones, from the
counts of all ids and pairs) is a small table beside them.

``read`` decodes the frames wherever they lie, checks both checksums of each,
and puts each document's parts together by the checksum of a concatenation.

Memory of a task is bounded by ``LANES * BLOCK`` ids, whatever a document's or
partition's length: a long document spans many blocks, its parts are joined by
numbers alone.

Defined results
  null and empty texts: the end id alone; null ids: first; equal ids: ordered by
  text hash; repeated rows: each written; empty table: no frames, and ``read``
  gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import as_text, cut, shared_path, small_batches

#: Ids of a block; blocks coded side by side, at most; and how many a partition is meant to hold:
#: the more blocks share a step, the less a step costs each, and one batch beats one and a bit.
BLOCK, LANES, PART_BLOCKS = 4096, 8192, 6144
#: Blocks that a task is worth while some of the cluster's cores would have none.
LEAST_BLOCKS = 1200
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
MAGIC, VERSION = b"STRC", 2
#: magic, version, ids, documents, first id of the block and first document within
#: the partition, checksum of the ids, payload bytes
HEAD = struct.Struct("<4sBIIQQII")
#: Pieces whose ids a worker remembers: so many new ones, and as many that it met before them.
REMEMBERED = 400_000
#: Characters whose pieces are looked up together, as far as documents allow.
TOGETHER = 4_000_000
#: A piece of letters, and perhaps marks after them, is one or two words to a tokenizer
#: that splits letters from marks.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
SIMPLE = re.compile(f"[{LETTERS}]+([.,;:!?]*)")
#: What lower case leaves of them; as bytes written as characters, that is what such a tokenizer's model takes.
LOWER = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: Where such a tokenizer always ends a word: a blank there changes nothing.
BEFORE_MARKS = rf"([{LETTERS}])([.,;:!?$%&*#@=+~^_/\\()\[\]{{}}\"-])"
_ENCODERS: dict[tuple, "Encoder"] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def id_kind(tokenizer, end_id: int) -> str:
    """Two bytes an id where the vocabulary allows, else four."""
    return "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


class Encoder:
    """Ids of whole texts as little-endian bytes. Pieces between blanks and line ends are
    encoded once and remembered: the tokenizer's words never cross white space, and its
    normalizer changes nothing across it, so the ids are those of the whole text. Where the
    tokenizer lower-cases, texts of Latin-1 are lower-cased first and marks cut off their words,
    so that a word is one piece however it is written."""

    def __init__(self, path: str, end_id: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_kind(self.tokenizer, end_id)
        self.end = np.array([end_id], self.kind).tobytes()
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}  # what was known when there was last too much of it
        self.model = self.tokenizer.model
        self.bytewise = self._bytewise()
        self.ends = self._word_ends()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.folds = self._folds()

    @classmethod
    def of(cls, path: str, end_id: int) -> Encoder:
        """The worker's encoder: Spark gives a worker many tasks, and they share its pieces."""
        if (path, end_id) not in _ENCODERS:
            _ENCODERS[path, end_id] = cls(path, end_id)
        return _ENCODERS[path, end_id]

    @staticmethod
    def forget() -> None:
        """Make room in a worker that has no more texts to encode."""
        _ENCODERS.clear()

    def _word_ends(self) -> np.ndarray | None:
        """Whether an id ends a word, if this tokenizer marks the ends of its words."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        probe = [self.tokenizer.encode(t, add_special_tokens=False).tokens for t in ("ab", "ab cd", "ab.,", "\u00e9a!")]
        if not suffix or [sum(t.endswith(suffix) for t in p) for p in probe] != [1, 2, 2, 2]:
            return None
        out = np.zeros(self.tokenizer.get_vocab_size(), bool)
        out[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        return out

    @staticmethod
    def _bytewise() -> str:
        """The character that a byte-level model reads for each byte."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        return "".join(chr(b) if b in plain else chr(next(other)) for b in range(256))

    def _folds(self) -> bool:
        """Whether the tokenizer lower-cases, parts marks from letters, and gives a word of such letters as its model does."""
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        apart = not any(re.search(BEFORE_MARKS, t) for t in self.special)
        return self.ends is not None and apart and ids("ABc D\u00c9. x,;y") == ids("abc d\u00e9 . x ,;y") and all(
            self._model_ids(w) == ids(w) for w in ("a", "the", "abcdefghijklmnopqrstuvwxyz", "\u00e9t\u00e9", *(
                f"{a}{chr(c)}{b}" for c in range(0xdf, 0x100) if c != 0xf7 for a, b in (("", ""), ("s", ""), ("e", "s")))))

    def _model_ids(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", self.bytewise)[0])]

    def _folded(self, text: str) -> str:
        """The text in lower case, where that is what the tokenizer makes of it: beyond Latin-1, its
        own normalizer works on characters in their context, and special tokens are read as written."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        low = text.lower()
        return text if any(t in low for t in self.special) else low

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces. Words in lower case go through the tokenizer's model alone, other simple ones
        through the tokenizer together, a blank between two, and are told apart by the ids that end words."""
        if self.folds:
            lower = list(map(LOWER.fullmatch, pieces))
            words = [p for p, m in zip(pieces, lower) if m]
            pieces = [p for p, m in zip(pieces, lower) if not m]
            ids, stops, size = [], [0], np.dtype(self.kind).itemsize
            for p in words:
                ids += self._model_ids(p)
                stops.append(size * len(ids))
            raw = np.array(ids, self.kind).tobytes()
            self.known.update((p, raw[x:y]) for p, x, y in zip(words, stops, stops[1:]))
        rest = pieces
        if self.ends is not None:
            shapes = [SIMPLE.fullmatch(p) for p in pieces]
            simple = [(p, 2 if m[1] else 1) for p, m in zip(pieces, shapes) if m]
            rest = [p for p, m in zip(pieces, shapes) if not m]
            for at in range(0, len(simple), 2000):
                some = simple[at:at + 2000]
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(p for p, _ in some)], add_special_tokens=False)[0].ids)
                last = np.flatnonzero(self.ends[ids])
                upto = np.cumsum([n for _, n in some])
                if len(last) != upto[-1]:
                    rest += [p for p, _ in some]
                    continue
                raw, size = ids.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
                stops = ((last[upto - 1] + 1) * size).tolist()
                for (p, _), x, y in zip(some, [0, *stops], stops):
                    self.known[p] = raw[x:y]
        for at in range(0, len(rest), 10_000):
            some = rest[at:at + 10_000]
            for p, got in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[p] = np.array(got.ids, self.kind).tobytes()

    def batch(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known, self.before = {"": b""}, self.known
        known, before = self.known, self.before
        blanks = pc.replace_substring(pa.array([self._folded(t or "") if self.folds else t or "" for t in texts], pa.large_string()), "\n", " ")
        cuts = pc.split_pattern(pc.replace_substring_regex(blanks, BEFORE_MARKS, r"\1 \2") if self.folds else blanks, " ")
        coded = cuts.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(known.get, pieces))
        new = [k for k, ids in enumerate(found) if ids is None]
        if before:
            known.update((p, ids) for p in (pieces[k] for k in new) if (ids := before.get(p)) is not None)
        self._learn([p for k in new if (p := pieces[k]) not in known])
        for k in new:
            found[k] = known[pieces[k]]
        raw = pa.array(found, pa.large_binary()).take(coded.indices)
        _, at, data = raw.buffers()
        ends = np.frombuffer(at, np.int64)[cuts.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [data[x:y].tobytes() + self.end for x, y in zip(ends, ends[1:])]


def tokens(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """doc_id, text hash and ids (little-endian, of ``id_kind``) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, held, size = Encoder.of(path, end_id), [], 0

        def coded():
            pdf = pd.concat(held, ignore_index=True)
            return pd.DataFrame({"doc_id": pdf["doc_id"], "h": pdf["h"], "ids": encoder.batch(list(pdf["t"]))})

        for pdf in batches:
            held.append(pdf)
            size += int(pdf["t"].str.len().sum())
            if size >= TOGETHER:
                yield coded()
                held, size = [], 0
        if held:
            yield coded()

    rows = docs.select(as_text(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("t"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    return rows.mapInPandas(run, "doc_id string, h long, ids binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def id_counts(found: DataFrame, kind: str) -> DataFrame:
    """symbol, count over all ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1, np.int64)
        for pdf in batches:
            part = np.bincount(np.frombuffer(b"".join(pdf["ids"]), kind))
            total = np.pad(total, (0, max(0, len(part) - len(total))))
            total[:len(part)] += part
        at = total.nonzero()[0]
        yield pd.DataFrame({"symbol": at, "n": total[at]})

    return found.select("ids").mapInPandas(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


#: Pairs of ids that a task counts at once.
PAIRS = 1 << 21


def pair_counts(found: DataFrame, kind: str, end_id: int, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Arrays of last, symbol, count and the count of last, over all ids that follow one of the most frequent;
    an end id precedes each document. Pairs too rare for the tree's scale stay behind."""
    from strata.llm.rangecoder import SCALE, branches, by_rank
    spark = found.sparkSession
    top = by_rank(symbols, counts)[:branches(len(symbols))]
    sent = spark.sparkContext.broadcast((np.sort(symbols), top))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbols, top = sent.value
        n = len(symbols)
        number, row = np.zeros(int(symbols[-1]) + 1, np.int64), np.full(int(symbols[-1]) + 1, len(top), np.int64)
        number[symbols], row[top] = np.arange(n), np.arange(len(top))
        row *= n
        total, held, size = np.zeros((len(top) + 1) * n, np.int64), [], 0
        end = np.array([end_id], kind).tobytes()

        def add():
            ids = np.frombuffer(b"".join(held), kind)
            key = row.take(ids[:-1])
            key += number.take(ids[1:])
            total[:] += np.bincount(key, minlength=len(total))

        for pdf in batches:
            for raw in pdf["ids"]:
                held.append(raw)
                size += len(raw)
                if size >= PAIRS * len(end):
                    held.insert(0, end)
                    add()
                    held, size = [], 0
        if held:
            held.insert(0, end)
            add()
        at = total[:len(top) * n].nonzero()[0]
        yield pd.DataFrame({"last": top[at // n], "symbol": symbols[at % n], "n": total[at]})

    by_symbol = np.argsort(symbols)
    whole = counts[by_symbol][np.searchsorted(symbols[by_symbol], top)]
    often = spark.createDataFrame(list(zip(top.tolist(), whole.tolist())), "last long, whole long")
    rows = (found.select("ids").mapInPandas(run, "last long, symbol long, n long").groupBy("last", "symbol").agg(F.sum("n").alias("n"))
            .join(F.broadcast(often), "last").filter(F.col("n") * F.lit(1 << SCALE) >= F.col("whole")).toArrow())
    return tuple(rows[c].to_numpy() for c in ("last", "symbol", "n", "whole"))


def frame(ids: np.ndarray, payload: bytes, first: int, first_doc: int, docs: list[tuple]) -> bytes:
    """docs: (id or None, ids in this block, whether it begins here, whether it ends here)."""
    head = HEAD.pack(MAGIC, VERSION, len(ids), len(docs), first, first_doc,
                     zlib.crc32(ids.astype("<u4").tobytes()), len(payload))
    listed = b"".join(struct.pack("<BqI", (d is None) | b << 1 | e << 2, d or 0, n) for d, n, b, e in docs)
    body = head + listed + payload
    return body + zlib.crc32(body).to_bytes(4, "little")


def parse(data: bytes) -> tuple[int, int, int, int, list[tuple], bytes]:
    """ids, first, first_doc, checksum of the ids, docs and payload of a frame; raises if damaged."""
    if len(data) < HEAD.size + 4 or zlib.crc32(data[:-4]) != int.from_bytes(data[-4:], "little"):
        raise ValueError("damaged frame")
    magic, version, n, k, first, first_doc, crc, size = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a frame of this version")
    at = HEAD.size
    listed = [(None if f & 1 else d, c, bool(f & 2), bool(f & 4)) for f, d, c in struct.iter_unpack("<BqI", data[at:at + 13 * k])]
    return n, first, first_doc, crc, listed, data[at + 13 * k:at + 13 * k + size]


def _block_writer(tree_table, kind: str, block: int, lanes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from strata.llm.rangecoder import Tree, encode_blocks
        from pyspark import TaskContext
        Encoder.forget()
        tree, part = Tree(*tree_table.value), TaskContext.get().partitionId()
        ready, current, listed, room = [], [], [], block
        first, doc, first_doc, number = 0, 0, 0, 0

        def close():
            nonlocal current, listed, room, first, first_doc
            ids = np.concatenate(current)
            ready.append((ids, first, first_doc, listed))
            first, first_doc = first + len(ids), doc
            current, listed, room = [], [], block
            return len(ready) == lanes

        def flush():
            nonlocal number
            coded = encode_blocks(tree, [r[0] for r in ready])
            rows = [(part, number + i, len(r[0]), frame(r[0], c, *r[1:])) for i, (r, c) in enumerate(zip(ready, coded))]
            number += len(rows)
            ready.clear()
            return pd.DataFrame(rows, columns=["part", "block", "ids", "frame"])

        for pdf in batches:
            for doc_id, raw in zip(pdf["doc_id"], pdf["ids"]):
                ids, at = np.frombuffer(raw, kind), 0
                while at < len(ids):
                    take = min(room, len(ids) - at)
                    if not take:
                        if close():
                            yield flush()
                        continue
                    current.append(ids[at:at + take])
                    ends = at + take == len(ids)
                    listed.append((None if pd.isna(doc_id) else int(doc_id), take, at == 0, ends))
                    room -= take
                    at += take
                    doc += ends
        if current:
            close()
        if ready:
            yield flush()
    return run


def partitions(ids: int, block: int, cores: int) -> int:
    """Range partitions for so many ids: about ``PART_BLOCKS`` blocks each, fewer where cores would idle."""
    blocks = -(-ids // block)
    return max(1, -(-blocks // PART_BLOCKS), min(cores, blocks // LEAST_BLOCKS))


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
          tokenizer: str | None = None, end_id: int = END_ID, block: int = BLOCK, lanes: int = LANES) -> None:
    """Write the documents' ids to ``path``: frames in ``path/blocks``, the tree in ``path/tree``."""
    spark = docs.sparkSession
    from tokenizers import Tokenizer
    tokenizer = tokenizer or tokenizer_path()
    kind = id_kind(Tokenizer.from_file(tokenizer), end_id)
    found = cut(tokens(docs, id_col, text_col, tokenizer, end_id), "tokens")
    seen = id_counts(found, kind).toPandas()  # at most one row per id of the vocabulary
    from strata.llm.rangecoder import Tree
    symbols, counts = seen["symbol"].to_numpy(np.int64), seen["n"].to_numpy(np.int64)
    tree = Tree.of_counts(symbols, counts, pair_counts(found, kind, end_id, symbols, counts) if len(symbols) else None)
    packed = tuple(x.astype("<i4").tobytes() for x in tree.rows)  # in one row: their order counts
    spark.createDataFrame([packed], TREE).coalesce(1).write.parquet(f"{path}/tree")
    sent = spark.sparkContext.broadcast(tree.rows)
    keys = [F.col("doc_id").asc_nulls_first(), F.col("h").asc()]
    placed = found.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(
        partitions(int(seen["n"].sum()), block, spark.sparkContext.defaultParallelism), *keys, "tie")
    (placed.sortWithinPartitions(*keys, "tie").select(as_text(F.col("doc_id")).alias("doc_id"), "ids")
     .mapInPandas(_block_writer(sent, kind, block, lanes), "part int, block long, ids long, frame binary")
     .write.parquet(f"{path}/blocks"))


TREE = "last binary, symbol binary, freq binary"
POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the checksum's, bits reflected."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (POLY if b & 1 else 0)
    return out


def _powers() -> list[int]:
    """x to the powers of two: what the bits of a length, counted in bits, multiply a checksum by."""
    out = [0x40000000]
    while len(out) < 64:
        out.append(_times(out[-1], out[-1]))
    return out


POWERS = _powers()


def joined_crc(first: int, second: int, length: int) -> int:
    """Checksum of two byte strings one after the other, the second ``length`` bytes long."""
    n, k = 8 * length, 0
    while n and first:
        if n & 1:
            first = _times(POWERS[k], first)
        n, k = n >> 1, k + 1
    return first ^ second


def _parts_reader(tree_table, lanes: int):
    def parts(frames: list[tuple]) -> pd.DataFrame:
        from strata.llm.rangecoder import Tree, decode_blocks
        tree = Tree(*tree_table.value)
        parsed = [parse(f) for _, _, f in frames]
        blocks = decode_blocks(tree, [p[5] for p in parsed], [p[0] for p in parsed])
        rows = []
        for (part, block, _), (n, first, doc, crc, listed, _), ids in zip(frames, parsed, blocks):
            raw, at = memoryview(ids.astype("<u4").tobytes()), 0
            if zlib.crc32(raw) != crc:
                raise ValueError("ids differ from their checksum")
            for doc_id, k, begins, ends in listed:
                rows.append((part, doc, None if doc_id is None else str(doc_id), first + at, k, zlib.crc32(raw[4 * at:4 * (at + k)]), begins and ends))
                at, doc = at + k, doc + ends
        return pd.DataFrame(rows, columns=["part", "doc", "doc_id", "at", "n", "crc", "whole"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for pdf in batches:
            for row in zip(pdf["part"], pdf["block"], pdf["frame"]):
                held.append(row)
                if len(held) == lanes:
                    yield parts(held)
                    held = []
        if held:
            yield parts(held)
    return run


def read(spark: SparkSession, path: str, lanes: int = LANES) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document."""
    small_batches(spark)
    tree = spark.read.schema(TREE).parquet(f"{path}/tree").first()
    sent = spark.sparkContext.broadcast(tuple(np.frombuffer(x, "<i4") for x in tree))
    frames = spark.read.parquet(f"{path}/blocks")
    pieces = cut(frames.select("part", "block", "frame").mapInPandas(
        _parts_reader(sent, lanes), "part int, doc long, doc_id string, at long, n long, crc long, whole boolean")
        .withColumn("doc_id", F.col("doc_id").cast("long")), "parts")

    @F.pandas_udf("long")
    def fold(rows: pd.Series) -> pd.Series:
        out = []
        for row in rows:
            crc = 0
            for p in row:
                crc = joined_crc(crc, int(p["crc"]), 4 * int(p["n"]))
            out.append(crc)
        return pd.Series(out)

    one = pieces.filter("whole").select("part", "doc_id", "at", "n", "crc")
    # a list entry for each block of a document that spans several
    many = (pieces.filter("not whole").groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("list"))
        .select("part", "doc_id", "at", "n", fold("list").alias("crc")))
    sizes = frames.groupBy("part").agg(F.sum("ids").alias("ids"))
    from pyspark.sql import Window
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    starts = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return one.unionByName(many).join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    path = shared_path(docs.sparkSession, "token-blocks")
    write(docs, path, **options)
    return read(docs.sparkSession, path)
