"""Operator 12, packing: documents in the order of a space-filling curve, cut into sequences.

A document's ids are hashed into a vector (square roots of the counts, unit length), a fixed
random projection takes it to ``DIMS`` numbers, each is quantised, and the Hilbert key of the
cell places the document on one curve: documents of like vocabulary become neighbours. The
curve is cut into ranges of near-equal token counts; one shuffle brings each range's ids
together in curve order, and the running sum of tokens says where every document lies. Sequences
are the stretches of ``length`` tokens of that line, so a document is cut where a sequence
ends. What is left at the end is cut into falling powers of two, which need no padding.

The ids are encoded once and written once to the shared folder; the shuffle of the ids is the
only other time that they move. ``pieces`` has them (``ids``), for whoever writes sequences.

Memory of a task is one Arrow batch of documents; a range of the curve streams through. Copies
share a cell: within it a hash of the row decides, so that any number of them spreads over
ranges. Ranges are drawn from quantiles of the places, which changes their sizes alone.

Defined results
  null and empty texts: the end id alone, in the origin's cell; null ids: packed like others;
  repeated rows: each packed, in the order of their row numbers; very long texts: encoded whole,
  a piece in each sequence they pass through; empty table: no pieces; extra columns are ignored,
  whatever their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, cut, shuffle_partitions, small_batches

LENGTH, END_ID = 2048, 1
TOKENIZER = "byte_bpe_50k.json"
#: Length of a hashed vector, numbers it is projected to, bits of each.
BUCKETS, DIMS, BITS = 2048, 4, 10
#: Numbers of the projection beyond so many standard deviations fall into the outermost cells.
SPREAD = 4.0
#: Bits of a row's hash below the Hilbert key.
LOW = 22
#: Pieces whose ids a worker remembers, at most.
REMEMBERED = 1_200_000
#: A piece of ASCII letters, and marks after them: two parts to the tokenizer, the same in its alphabet.
SIMPLE = re.compile(r"([A-Za-z]+)([.,;:!?]*)")
BLANK = re.compile(r"\s")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    """The parts that byte-level tokenizers cut texts into."""
    import public_tokenizers
    return public_tokenizers.PATTERN


class Encoder:
    """Ids of whole texts. A byte-level tokenizer cuts before a single blank, and around a single
    line end, that stands between two words, and nothing it does crosses these places: the
    pieces between are encoded once and remembered. A new piece is cut into parts by the
    tokenizer's pattern and spelt in its alphabet, which has a letter for each byte; the ids
    of a part come from the tokenizer's model. Texts with longer runs of white space, or some
    at their ends, are encoded as they are."""

    _of: dict[str, Encoder] = {}

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.kind, self.code = ("<u2", "H") if self.size <= 1 << 16 else ("<u4", "I")
        self.pattern, self.letters = regex.compile(pattern()), {}
        # characters that hold, among them, every byte of UTF-8: one, two (all second bytes), three and four bytes long
        some = [*range(128), *range(0x80, 0xC0), *range(0xC0, 0x800, 64), 0x800, *range(0x1000, 0x10000, 0x1000), 0x10000, *range(0x40000, 0x110000, 0x40000)]
        for c in map(chr, some):
            spelt = "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c))
            self.letters.update(zip(c.encode(), spelt))
        self.model, self.blank = self.tokenizer.model, self.letters[ord(" ")]
        self.line_end = self._raw(["\n"])[0]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder: its tasks share the pieces."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def forget(self) -> None:
        self.known: dict[str, bytes | None] = {}  # by piece: after a blank, or with the line end before it
        self.parts: dict[str, bytes] = {"": b""}  # by part, in the tokenizer's alphabet

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        """The ids of a part spelt in the tokenizer's alphabet."""
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = self._bytes([x.id for x in self.model.tokenize(part)])
        return ids

    def _learn(self, piece: str) -> bytes | None:
        """The ids of a piece; None if white space in it or beside it needs the whole text."""
        after_line = piece[:1] == "\n"
        body = piece[1:] if after_line else piece
        if not body or BLANK.search(body):
            return None
        head, blank = (self.line_end, "") if after_line else (b"", self.blank)
        if m := SIMPLE.fullmatch(body):
            return head + self._part(blank + m[1]) + (self._part(m[2]) if m[2] else b"")
        body = body if after_line else " " + body
        if any(x in body for x in self.special):
            return head + self._raw([body])[0]
        spell = self.letters.__getitem__
        return head + b"".join([self._part("".join(map(spell, x.encode()))) for x in self.pattern.findall(body)])

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of ``kind``."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        cuts = [t.replace("\n", " \n").split(" ") for t in texts]
        heads = self._raw([c.pop(0) for c in cuts])
        for p in set().union(*cuts).difference(known):
            known[p] = self._learn(p)
        out = []
        for t, head, pieces in zip(texts, heads, cuts):
            try:
                out.append(head + b"".join(map(known.__getitem__, pieces)))
            except TypeError:  # a piece without ids of its own
                out += self._raw([t])
        return out


def projection(seed: int = 12) -> np.ndarray:
    """Of hashed vectors to ``DIMS`` numbers: the same on every worker."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMS))


def buckets(vocabulary: int) -> np.ndarray:
    """The bucket of every id, by multiplicative hashing."""
    ids = np.arange(vocabulary, dtype=np.uint64)
    return ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def coordinates(ids: np.ndarray, bucket: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The document's cell: ``DIMS`` numbers of ``BITS`` bits."""
    counts = np.bincount(bucket[ids], minlength=BUCKETS)
    at = np.flatnonzero(counts)
    weights = np.sqrt(counts[at])
    x = weights @ matrix[at] / np.sqrt(max(1, counts.sum())) if len(at) else np.zeros(DIMS)
    return np.clip(np.floor((x / SPREAD + 1) * (1 << (BITS - 1))), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of cells (one a row). From the highest bit down, each
    step undoes the rotation that the curve's smaller copies have; the axes' bits, in turns,
    are then the Gray code of the place."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = np.int64((1 << b) - 1)
        for i in range(dims):
            turned = (x[i] >> b) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[dims - 1] >> b) & 1 == 1, flip ^ ((1 << b) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Of every row: its number, doc_id, its place on the curve, its token count and its ids."""
    small_batches(docs.sparkSession)
    path = tokenizer_path(tokenizer)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), as_text(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, matrix = Encoder.of(path), projection()
        bucket = buckets(max(encoder.size, end_id + 1))
        end = np.array([end_id], encoder.kind).tobytes()
        for pdf in batches:
            raw = encoder.batch([t or "" for t in pdf["t"]])
            ids = [np.frombuffer(x, encoder.kind) for x in raw]
            keys = hilbert(np.stack([coordinates(i, bucket, matrix) for i in ids])) if len(ids) else np.zeros(0, np.int64)
            yield pd.DataFrame({"row": pdf["row"], "doc_id": pdf["doc_id"], "key": keys,
                                "n": [len(i) + 1 for i in ids], "ids": [x + end for x in raw]})

    out = rows.mapInPandas(run, "row long, doc_id string, key long, n long, ids binary")
    place = F.shiftleft(F.col("key"), LOW) + F.xxhash64("row").bitwiseAND(F.lit((1 << LOW) - 1))
    return cut(out.select("row", "doc_id", place.alias("place"), "n", "ids"), "packing-ids")


def ranges(tokens: DataFrame, parts: int) -> list[int]:
    """Upper places of all ranges but the last: quantiles, at most ``parts`` numbers."""
    if parts < 2:
        return []
    found = tokens.select(F.percentile_approx("place", F.array(*[F.lit(k / parts) for k in range(1, parts)]), 20 * parts)).first()[0]
    return sorted(set(found or []))


def limits(total: int, length: int) -> tuple[int, list[int]]:
    """The number of full sequences, and where the last, shorter ones end: their lengths are
    the powers of two that make up the rest."""
    ends, at = [], total // length * length
    for b in range(length.bit_length(), -1, -1):
        if (total - total // length * length) >> b & 1:
            at += 1 << b
            ends.append(at)
    return total // length, ends


def pieces(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, tokenizer: str = TOKENIZER,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its
    ``ids`` (little-endian unsigned 32-bit) if asked for."""
    if length < 1:
        raise ValueError("length must be positive")
    spark = docs.sparkSession
    tokens = encoded(docs, tokenizer, end_id, id_col, text_col)
    parts = shuffle_partitions(spark)
    bounds = ranges(tokens, parts)
    # a row's range is the number of bounds below its place: the same search in SQL and in the tasks
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), lambda b: b < F.col("place")))
    sums = {r["part"]: r["n"] for r in tokens.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).collect()}  # one row a range
    base, total = {}, 0
    for k in sorted(sums):
        base[k], total = total, total + sums[k]
    full, ends = limits(total, length)
    kind = "<u2" if end_id < 1 << 16 and _small_vocabulary(tokenizer) else "<u4"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at = None, 0
        for pdf in batches:
            out = []
            for p, doc, n, raw in zip(pdf["part"], pdf["doc_id"], pdf["n"], pdf["ids"]):
                if p != part:
                    part, at = p, base[p]
                ids, start = np.frombuffer(raw, kind).astype("<u4"), 0
                while start < n:
                    if at < full * length:
                        seq, begin = at // length, at // length * length
                        end = begin + length
                    else:
                        k = next(i for i, e in enumerate(ends) if at < e)
                        seq, begin, end = full + k, ends[k - 1] if k else full * length, ends[k]
                    size = min(n - start, end - at)
                    own = ids[start:start + size].tobytes()
                    out.append((doc, start, size, zlib.crc32(own), n, seq, at - begin, *([own] if with_ids else [])))
                    start, at = start + size, at + size
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])])

    schema = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    out = (tokens.withColumn("part", part).repartitionById(parts, "part").sortWithinPartitions("part", "place", "row")
           .select("part", "doc_id", "n", "ids").mapInPandas(run, schema + (", ids binary" if with_ids else "")))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _small_vocabulary(tokenizer: str) -> bool:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path(tokenizer)).get_vocab_size() <= 1 << 16
