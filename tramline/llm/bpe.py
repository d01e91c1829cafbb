"""BPE encoding and decoding with a public tokenizer's vocabulary.

A word's symbols form a doubly linked list; a priority queue holds the mergeable pairs by rank and place. A popped pair
that no longer stands is skipped. Decoding concatenates vocabulary strings.

A worker remembers runs of text by their ids alone. A batch's decimals and decoded texts are taken from Arrow columns by id.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import cut, doc_texts, flat, lists, table, tidy

FILE = "word_bpe_49k.json"
#: Encoded words that a Python worker remembers, and as many from before; as many runs without white space. Characters
#: of the longest that it remembers.
REMEMBERED, LONGEST = 100_000, 64
#: Ids of one text whose strings are joined at a time.
PIECE = 1 << 24
#: Unicode white space (fixed values), which regular expressions of other libraries call \s.
SPACE = "\t-\r \x85\xa0  -     　"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(0x100 + extra)
            extra += 1
    return out


#: Characters at which str.split() splits beside SPACE (fixed values).
ODD_SPACE = "\x1c\x1d\x1e\x1f"


class Memory:
    """The newest values by key, between `most` and twice as many; those of keys of over LONGEST characters are made each time."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def found(self, key: str) -> bytes:
        out = self.new.get(key)
        if out is None:
            if len(key) > LONGEST:
                return self.make(key)
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            out = self.old.get(key)
            self.new[key] = out = self.make(key) if out is None else out
        return out


class Tokenizer:
    """What a tokenizer file of this kind says, as plain tables: byte-level BPE with word ends, NFC and lower case."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        ids = range(1 + max(self.strings, default=0))
        self.columns = pa.array([str(i) for i in ids], pa.string()), pa.array([self.strings.get(i, "") for i in ids], pa.string())
        # the rank of each pair of ids, as one number, and what the pair of each rank becomes
        self.base = 1 + max(self.ids.values(), default=0)
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.ranks = {self.ids[a] * self.base + self.ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        self.letters = byte_letters()
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}"))
        self.gaps = regex.compile(f"[{SPACE}]+")
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known, self.chunks = Memory(self.word, REMEMBERED), Memory(self.chunk, REMEMBERED)

    def merged(self, symbols: list[int]) -> list[int]:
        """Merges the pair of least rank, the leftmost of equals, until none is left."""
        n, base, rank_of = len(symbols), self.base, self.ranks.get
        found = [rank_of(a * base + b) for a, b in pairwise(symbols)]
        queue = [rank * n + i for i, rank in enumerate(found) if rank is not None]
        if not queue:
            return symbols
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = right[i]
            if j < 0 or found[i] != rank:  # stale: one of the pair has merged with another
                continue
            symbols[i] = new = self.made[rank]
            symbols[j] = -1
            right[i] = after = right[j]
            if j < n - 1:
                found[j] = None
            if after >= 0:
                left[after] = i
                found[i] = rank = rank_of(new * base + symbols[after])
                if rank is not None:
                    heapq.heappush(queue, rank * n + i)
            before = left[i]
            if before >= 0:
                found[before] = rank = rank_of(symbols[before] * base + new)
                if rank is not None:
                    heapq.heappush(queue, rank * n + before)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> bytes:
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] += self.suffix
        return array("i", self.merged([self.ids[x] for x in letters if x in self.ids])).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """A run without white space."""
        low = chunk.lower() if "Σ" not in chunk else "".join(c.lower() for c in chunk)
        if low.isalpha():  # one word
            return self.known.found(low)
        return b"".join([self.known.found(m) for m in self.words.findall(low)])

    def packed(self, text: str) -> bytes:
        """The text's ids as 32-bit numbers; special tokens written in it are runs of their own."""
        if self.marks is None or not any(x in text for x in self.special):
            return self.plain(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [self.plain(text[at : m.start()]), array("i", [self.special[m.group()]]).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def plain(self, text: str) -> bytes:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        chunks = text.split() if not any(x in text for x in ODD_SPACE) else filter(None, self.gaps.split(text))
        return b"".join(map(self.chunks.found, chunks))

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        return np.frombuffer(self.packed(text), np.int32)

    def digests(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[str], np.ndarray]:
        """Number of ids of each text, SHA-256 of the ids (decimal, joined by spaces) and of what they decode to, and all ids."""
        packed = list(map(self.packed, texts))
        counts, ids = np.array([len(x) // 4 for x in packed]), np.frombuffer(b"".join(packed), np.int32)
        return counts, *[joined_sha256(column, ids, counts) for column in self.columns], ids

    def decode(self, ids: Iterable[int]) -> str:
        """Vocabulary strings with a space between, as a file without a decoder asks for; unknown ids are left out."""
        strings = self.strings
        return " ".join([strings[i] for i in ids if i in strings])


def joined_sha256(column: pa.Array, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Of each text, the SHA-256 of its ids' strings joined by spaces. A batch is small, or one text of any length."""
    if len(counts) == 1 and len(ids) > PIECE:
        whole = hashlib.sha256()
        for at in range(0, len(ids), PIECE):
            part = ids[at : at + PIECE]
            whole.update(b" " * (at > 0))
            whole.update(joined(column, part, np.array([len(part)]))[0])
        return [whole.hexdigest()]
    data, offsets = joined(column, ids, counts)
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in pairwise(offsets.tolist())]


def joined(column: pa.Array, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of `column` by id, joined by spaces within each text: all bytes, and n + 1 offsets."""
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
    return flat(pc.binary_join(pa.ListArray.from_arrays(offsets, column.take(pa.array(ids))), " "))


_opened: dict[str, Tokenizer] = {}


def opened(text: str) -> Tokenizer:
    """One tokenizer for each worker process and file, so that remembered words outlast a task."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _opened:
        _opened.clear()
        _opened[key] = Tokenizer(text)
    return _opened[key]


def public_file(name: str = FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def mapped(rows: DataFrame, path: str, columns: list[str], made: str, make: Callable[[Tokenizer, pa.RecordBatch], list[pa.Array]], text: str | None = "text") -> DataFrame:
    """`columns` of rows, and what make gives for each batch. The file (some MB) is read by the driver."""
    with open(path, encoding="utf-8") as f:
        held = rows.sparkSession.sparkContext.broadcast(f.read())
    names = [x.split()[0] for x in made.split(", ")]

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = opened(held.value)
        for batch in cut(batches) if text else batches:
            yield pa.RecordBatch.from_arrays([*batch.select(columns).columns, *make(tokenizer, batch)], names=[*columns, *names])

    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in columns)
    return rows.mapInArrow(run, kinds + made)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of each row; null text counts as empty and has no ids; null ids and repeated rows pass through."""
    return mapped(doc_texts(docs), path, ["doc_id"], "ids array<int>", lambda t, batch: [pa.array([t.encode(x) for x in batch.column("text").to_pylist()], pa.list_(pa.int32()))])


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of each row's ids (doc_id, ids); null ids decode to empty text."""

    def run(t: Tokenizer, batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([t.decode(x or ()) for x in batch.column("ids").to_pylist()], pa.string())]

    return mapped(rows, path, ["doc_id"], "text string", run, None)


def digests(docs: DataFrame, path: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids (decimal, joined by spaces) and of the decoded text, and the ids themselves if asked for.

    Null text counts as empty; null ids and repeated rows pass through; an empty table gives an empty result.
    """

    def make(t: Tokenizer, batch: pa.RecordBatch) -> list[pa.Array]:
        counts, of_ids, of_strings, held = t.digests(batch.column("text").to_pylist())
        out = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_strings, pa.string())]
        return [*out, lists(held, counts, pa.int32())] if ids else out

    return mapped(doc_texts(docs), path, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids, make)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_file())
