"""Byte-level BPE encoding and decoding in two tiers.

A text is cut into pre-tokens by a pattern. A minimal perfect hash over the vocabulary resolves those that are entries
as a whole, all distinct ones of a block at once. The others are merged: a heap holds the mergeable neighbours by rank
and place, over a doubly linked list of byte ranges, and entries that no longer stand are skipped. Decoding gathers the
entries' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.bpe import byte_letters
from tramline.llm.common import CHUNK_BYTES, cut, doc_texts, flat, mixed, table

FILE = "byte_bpe_50k.tiktoken"
#: Pre-tokens that a numpy step works on, in a text too long for a block.
STEP = 1 << 18
#: Merged pre-tokens that a Python worker remembers, and as many from before.
REMEMBERED = 300_000
#: FNV-1a (fixed values), and the step between displacements.
FNV_START, FNV_PRIME, STRIDE = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same of the next."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def hashed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each byte range; one step for each byte of the longest."""
    order = np.argsort(-lengths, kind="stable")
    at, size = starts[order], lengths[order]
    h = np.full(len(at), FNV_START ^ np.uint64(seed))
    for p in range(int(size[0]) if len(size) else 0):
        k = int(np.searchsorted(-size, -p, side="left"))  # those longer than p
        h[:k] = (h[:k] ^ data[at[:k] + p]) * FNV_PRIME
    out = np.empty_like(h)
    out[order] = mixed(h)
    return out


class MinimalHash:
    """n byte strings in n slots: hash to a bucket, whose displacement sends each of its strings to a slot of its own.

    A bucket with one string names its slot itself, as -1 - slot. What isn't among the strings is told by its bytes.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n, lengths = len(keys), np.array([len(k) for k in keys], np.int64)
        data, starts = np.frombuffer(b"".join(keys), np.uint8), np.cumsum(lengths) - lengths
        self.seed, self.longest = 0, int(lengths.max(initial=0))
        while len(np.unique(h := hashed(data, starts, lengths, self.seed))) < n:
            self.seed += 1  # equal strings never end this
            if self.seed > 64:
                raise ValueError("repeated strings")
        self.n, self.buckets = n, max(1, n // 4)
        self.moves = np.zeros(self.buckets, np.int64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        sizes, order = np.bincount(bucket, minlength=self.buckets), np.argsort(bucket, kind="stable")
        firsts, taken, slots = np.cumsum(sizes) - sizes, np.zeros(n, bool), np.empty(n, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            own = order[firsts[b] : firsts[b] + sizes[b]]
            if len(own) < 2:
                break
            at = 0
            while True:
                tried = self.displaced(h[own][None], np.arange(at, at + 64)[:, None])
                ordered = np.sort(tried, axis=1)
                good = np.flatnonzero(~taken[tried].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1))
                if len(good):
                    break
                at += 64
            self.moves[b] = at + good[0]
            slots[own] = tried[good[0]]
            taken[slots[own]] = True
        alone = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~taken)
        slots[order[firsts[alone]]] = free
        self.moves[alone] = -1 - free
        by_slot = np.argsort(slots)
        self.values, self.lengths = np.array(values, np.int32)[by_slot], lengths[by_slot]
        self.data = data[ranges(starts[by_slot], self.lengths)]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def displaced(self, h: np.ndarray, moves: np.ndarray) -> np.ndarray:
        return (mixed(h + (moves.astype(np.uint64) + np.uint64(1)) * STRIDE) % np.uint64(self.n)).astype(np.int64)

    def found(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The value of each byte range, -1 for those that are no key."""
        out = np.full(len(starts), -1, np.int32)
        some = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        if self.n == 0 or len(some) == 0:
            return out
        h = hashed(data, starts[some], lengths[some], self.seed)
        moves = self.moves[(h % np.uint64(self.buckets)).astype(np.int64)]
        slots = np.where(moves < 0, -1 - moves, self.displaced(h, np.maximum(moves, 0)))
        same = np.flatnonzero(self.lengths[slots] == lengths[some])
        some, slots = some[same], slots[same]
        size = lengths[some]
        if len(some):
            differ = data[ranges(starts[some], size)] != self.data[ranges(self.starts[slots], size)]
            same = np.flatnonzero(~np.logical_or.reduceat(differ, np.cumsum(size) - size))
            out[some[same]] = self.values[slots[same]]
        return out


class ByteBpe:
    """A byte-level vocabulary whose ids are the ranks of its merges, as plain tables."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.words = MinimalHash(list(ranks), list(ranks.values()))
        size = np.zeros(1 + max(ranks.values(), default=-1), np.int64)
        size[list(ranks.values())] = [len(k) for k in ranks]
        self.sizes, self.starts = size, np.cumsum(size) - size
        self.data = np.frombuffer(b"".join(k for k, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)
        self.base, self.single = len(size), [ranks[bytes([b])] for b in range(256)] if ranks else []
        #: Ids side by side that together spell an entry, and the entry's id, which is its rank.
        self.pairs = {a * self.base + b: rank for x, rank in ranks.items() for k in range(1, len(x)) if (a := ranks.get(x[:k])) is not None and (b := ranks.get(x[k:])) is not None}
        self.key = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
        self.matches: regex.Pattern | None = None
        self.new: dict[bytes, list[int]] = {}
        self.old: dict[bytes, list[int]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Merges the neighbours of least rank, the leftmost of equals, until none is left."""
        n, base, rank_of = len(piece), self.base, self.pairs.get
        symbols = [self.single[b] for b in piece]
        found = [rank_of(a * base + b) for a, b in pairwise(symbols)]
        found.append(None)
        queue = [rank * n + i for i, rank in enumerate(found) if rank is not None]
        if not queue:
            return symbols
        heapq.heapify(queue)
        right, left = list(range(1, n + 1)), list(range(-1, n))  # the places beside; n stands for the end
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            if found[i] != rank:  # stale: one of the two has merged with another
                continue
            j = right[i]
            symbols[i], symbols[j], found[j] = rank, -1, None
            right[i] = after = right[j]
            left[after] = i
            found[i] = new = rank_of(rank * base + symbols[after]) if after < n else None
            if new is not None:
                heapq.heappush(queue, new * n + i)
            before = left[i]
            if before >= 0:
                found[before] = new = rank_of(symbols[before] * base + rank)
                if new is not None:
                    heapq.heappush(queue, new * n + before)
        return [x for x in symbols if x >= 0]

    def remembered(self, piece: bytes) -> list[int]:
        out = self.new.get(piece)
        if out is None:
            if len(self.new) >= REMEMBERED:
                self.old, self.new = self.new, {}
            out = self.new[piece] = self.old.get(piece) or self.merged(piece)
        return out

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, and how many each has."""
        distinct = pa.array(pieces, pa.large_string()).dictionary_encode()
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        data, offsets = flat(distinct.dictionary)
        starts, lengths = offsets[:-1], np.diff(offsets)
        whole = self.words.found(data, starts, lengths)
        missed = np.flatnonzero(whole < 0)
        bytes_ = data.tobytes()
        lists = [self.remembered(bytes_[a:b]) for a, b in zip(offsets[missed].tolist(), offsets[missed + 1].tolist(), strict=True)]
        counts = np.ones(len(whole), np.int64)
        counts[missed] = [len(x) for x in lists]
        at = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.int32)
        ids[at[whole >= 0]] = whole[whole >= 0]
        if len(missed):
            ids[ranges(at[missed], counts[missed])] = np.fromiter(chain.from_iterable(lists), np.int32)
        of = counts[codes]
        return ids[ranges(at[codes], of)], of

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and n + 1 offsets into them. A long text is matched in steps of STEP pre-tokens."""
        self.matches = self.matches or regex.compile(self.pattern)
        if len(texts) == 1 and len(texts[0]) > CHUNK_BYTES // 2:
            found, parts = self.matches.finditer(texts[0]), []
            while pieces := [m.group() for m in islice(found, STEP)]:
                parts.append(self.ids_of(pieces)[0])
            ids = np.concatenate(parts)
            return ids, np.array([0, len(ids)])
        pieces, ends = [], [0]
        for text in texts:
            pieces += self.matches.findall(text)
            ends.append(len(pieces))
        ids, of = self.ids_of(pieces)
        return ids, np.concatenate(([0], np.cumsum(of)))[ends]

    def decoded(self, ids: np.ndarray) -> bytes:
        """The entries' bytes in a row; an id without an entry has none."""
        ids = ids[(ids >= 0) & (ids < len(self.sizes))]
        return b"".join(self.data[ranges(self.starts[part], self.sizes[part])].tobytes() for part in (ids[i : i + STEP] for i in range(0, len(ids), STEP)))

    def kept(self) -> ByteBpe:
        """The worker's own copy, so that remembered pre-tokens outlast a task."""
        if self.key not in _opened:
            _opened.clear()
            _opened[self.key] = self
        return _opened[self.key]


_opened: dict[str, ByteBpe] = {}


def rank_file(path: str, pattern: str) -> ByteBpe:
    """Lines of an entry in base64 and its rank."""
    with open(path, "rb") as f:
        return ByteBpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}, pattern)


def merges_file(path: str, pattern: str) -> ByteBpe:
    """A tokenizer file of byte letters and merges; its ids must follow the order of the merges, so that they are ranks. Special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(made):
        raise ValueError("ids don't follow the order of the merges")
    entries = [x for x in model["vocab"] if len(x) == 1] + [a + b for a, b in pairs]
    return ByteBpe({bytes(byte_of[c] for c in x): model["vocab"][x] for x in dict.fromkeys(entries)}, pattern)


@cache
def public_ranks(name: str = FILE) -> ByteBpe:
    import public_tokenizers

    return rank_file(public_tokenizers.path(name), public_tokenizers.PATTERN)


def encoded(docs: DataFrame, bpe: ByteBpe) -> DataFrame:
    """doc_id and ids of each row. Null text counts as empty and has no ids; null ids and repeated rows pass through."""
    rows = doc_texts(docs)
    held = rows.sparkSession.sparkContext.broadcast(bpe)  # as large as the vocabulary file

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value.kept()
        for batch in cut(batches):
            ids, offsets = own.encoded(batch.column("text").to_pylist())
            lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids, pa.int32())).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, bpe: ByteBpe) -> DataFrame:
    """doc_id and the bytes (content) of each row's ids; null ids have none, and ids without an entry are left out."""
    rows = rows.select("doc_id", "ids")
    held = rows.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value.kept()
        for batch in batches:
            content = [own.decoded(np.array([i for i in x.as_py() or () if i is not None], np.int32)) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(content, pa.binary())], names=["doc_id", "content"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, content binary")


def digests(docs: DataFrame, bpe: ByteBpe) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids (little-endian, 32 bits each) and of the bytes that they decode to.

    Null text counts as empty; null ids and repeated rows pass through; an empty table gives an empty result; columns
    other than doc_id and text are not looked at.
    """
    rows = doc_texts(docs)
    held = rows.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value.kept()
        for batch in cut(batches):
            ids, offsets = own.encoded(batch.column("text").to_pylist())
            each = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            shas = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]
            back = own.decoded(ids)
            ends = np.concatenate(([0], np.cumsum(own.sizes[ids])))[offsets].tolist()
            content = [hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(shas, pa.string()), pa.array(content, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text, null as empty, by the public ranks; see digests."""
    return digests(table(spark, sf_dir, "documents"), public_ranks())
