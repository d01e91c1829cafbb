"""Small tables with every odd case, and plain versions of what several operators compute."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

DATA = "/root/testdata/sf0.001"
#: Extra columns have names that the operators use within.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th int, row string, spans string, u double"

PROSE = "The quick brown fox jumps over the lazy dog while Seven wizards brew tea, and nobody minds the rain at all."
TEXTS = [
    (1, PROSE),
    (2, PROSE),
    (2, PROSE),  # a repeated row
    (3, None),
    (4, ""),
    (5, " \t\n\v\f\r "),
    (6, "one"),
    (7, "two words"),
    (8, "Ärger über Öl   naïve Café ΑΣ Σίσυφος 東京 \U0001f600 é"),
    (9, "aaaa " * 50),
    (9, "another text under the same id"),
    (None, PROSE + " And then the evening came."),
    (None, None),
    (10, " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))),
    (11, "x" * 50_000),
    (12, "intro " + PROSE.lower() + " outro"),
    (-7, "<|endoftext|> marks, <|startoftext|>and   gaps"),
]


def docs(spark: SparkSession, texts: list[tuple] = TEXTS) -> DataFrame:
    rows = [(i, t, "en", None if k % 5 == 4 else f"s{k % 3}", None if t is None else len(t), 7, "r", "s", 0.5) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def random_texts(n: int, words: list[str], longest: int, seed: int) -> list[tuple]:
    """Texts of few kinds of words, so that passages recur by chance, in part and as a whole."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        text = " ".join(rng.choices(words, k=rng.randrange(longest)))
        if out and rng.random() < 0.3:
            text += " " + (rng.choice(out)[1] or "")
        out.append((k, text))
    return out


def collected(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def table_texts(spark: SparkSession, sf_dir: str = DATA) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def crc(doc_id: int | None) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    if lower:
        data = re.sub(rb"[A-Z]", lambda m: m.group().lower(), data)
    return re.findall(rb"[^\x20\x09-\x0D]+", data)


def covered(sequences: list, width: int) -> list[list[bool]]:
    """For each sequence, which of its items a run of `width` covers that starts twice or more."""
    runs = Counter(hash(x[i : i + width]) for x in sequences for i in range(len(x) - width + 1))
    out = []
    for x in sequences:
        flags, until = [], 0
        for i in range(len(x)):
            if i + width <= len(x) and runs[hash(x[i : i + width])] > 1:
                until = i + width
            flags.append(i < until)
        out.append(flags)
    return out


def least_linked(fps: list[int], names: list, distance: int) -> list:
    """Each row's least name among all rows that chains of links reach; plain comparison of all kinds of fingerprints."""
    kinds = sorted(set(fps))
    parent = {x: x for x in kinds}

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[top(a)] = top(b)
    least: dict = {}
    for fp, name in zip(fps, names, strict=True):
        if name is not None:
            least[top(fp)] = min(name, least.get(top(fp), name))
    return [least.get(top(fp)) for fp in fps]
