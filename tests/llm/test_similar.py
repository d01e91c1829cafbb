"""The pipeline's near-dedup stage against brute force over five-word shingles."""

import random

import numpy as np
from corpus_pipeline import near_dedup
from fixtures import DATA, TEXTS, docs, words_of

from tramline.llm import common, repeats, similar
from tramline.llm.common import Scratch, keyed_texts
from tramline.llm.simhash import fingerprint


def plain_kept(texts: list[tuple]) -> list:
    """The least id of each component of pairs with Jaccard similarity of 0.8 or more."""
    sets = []
    for _, t in texts:
        w = words_of(t, lower=True)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                parent[top(i)] = top(j)
    least: dict = {}
    for i, (name, _) in enumerate(texts):
        least[top(i)] = min(least.get(top(i), (True, 0)), (name is None, name or 0))
    return sorted(least.values())


def kept(df) -> list:
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())


def edited(n: int, group: int, seed: int) -> list[tuple]:
    """Texts in groups about a text each, with single words changed, so that similarities lie on both sides of 0.8."""
    rng, out = random.Random(seed), []
    for k in range(n):
        if k % group == 0:
            base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 200))]
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append((k, " ".join(words)))
    return out


def test_near_copies_against_brute_force(spark):
    texts = edited(240, 4, 1)
    df = near_dedup(spark, docs(spark, texts), DATA)
    assert df.columns == docs(spark).columns
    assert kept(df) == plain_kept(texts)


def test_crowded_groups(spark, monkeypatch):
    monkeypatch.setattr(similar, "PAIRED_MOST", 3)
    monkeypatch.setattr(similar, "PIVOT_ROUNDS", 1)
    texts = edited(120, 40, 2)
    assert kept(near_dedup(spark, docs(spark, texts), DATA)) == plain_kept(texts)


def test_copies_of_one_text_and_passages_that_many_share(spark, monkeypatch):
    """Copies that are near their original but not each other, and unlike texts about one passage."""
    monkeypatch.setattr(similar, "PAIRED_MOST", 3)
    rng = random.Random(4)
    base, passage = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (150, 60)]
    texts = [(0, " ".join(base))]
    for k in range(1, 60):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append((k, " ".join(words)))
    texts += [(k, " ".join([f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 40))] + passage)) for k in range(60, 110)]
    expected = plain_kept(texts)
    assert 3 < len(expected) < 60
    assert kept(near_dedup(spark, docs(spark, texts), DATA)) == expected


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 20, n)) for n in (0, 1, 50, 400, 3000)]
    sets += [np.unique(np.append(sets[3][:-k], rng.integers(0, 1 << 20, k))) for k in (1, 7, 60)]
    signs = similar.signatures(np.concatenate(sets).astype(np.int64), np.cumsum([0, *map(len, sets)]))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differ = int(np.bitwise_count((signs[:, i] ^ signs[:, j]).astype(np.uint64)).sum())
            assert differ <= len(np.setxor1d(a, b)) and (differ > 0 or len(np.setxor1d(a, b)) % 2 == 0)


def test_fingerprints_join_near_copies_by_themselves(spark, monkeypatch):
    """Without the links by shingles, what is left is what SimHash links and the check confirms."""
    rng, texts = random.Random(5), []
    for k in range(60):
        if k % 6 == 0:
            base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        words = list(base)
        for _ in range(k % 6 % 3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append((k, " ".join(words)))
    prints = [fingerprint(words_of(t, lower=True), similar.SHINGLE) for _, t in texts]
    least = list(range(60))
    for _ in texts:
        least = [min(least[j] for j in range(60) if (prints[i] ^ prints[j]).bit_count() <= 2 and i // 6 == j // 6) for i in range(60)]
    expected = [(False, i) for i in sorted(set(least))]
    assert 10 <= len(expected) < 40 and len(set(prints)) > 12
    monkeypatch.setattr(similar, "links", lambda sets, scratch, known: known)
    assert kept(near_dedup(spark, docs(spark, texts), DATA)) == expected


def test_texts_that_cannot_be_similar_are_not_compared(spark):
    """Copies of one text that each differ from it in too much to be near each other share shingles, but make no rows to compare."""
    rng = random.Random(6)
    base, texts = [f"w{k}" for k in range(300)], []
    for k in range(80):
        words = list(base)
        for j in range(9):  # 45 of 296 shingles are the text's own, where two similar sets of this size can have 32 each at most
            words[5 + 30 * j + rng.randrange(20)] = f"x{k}-{j}"
        texts.append((k, " ".join(words)))
    scratch = Scratch(spark, "test")
    sets = scratch.keep(similar.shingle_sets(keyed_texts(docs(spark, texts)), [], True), "sets")
    none = spark.createDataFrame([], "a long, b long")
    assert similar.links(sets, scratch, none).count() == 0
    assert spark.read.parquet(f"{scratch.root}/first").count() == 0
    assert kept(near_dedup(spark, docs(spark, texts), DATA)) == plain_kept(texts) == [(False, k) for k in range(80)]


def test_near_copies_odd_cases(spark):
    assert kept(near_dedup(spark, docs(spark), DATA)) == plain_kept(TEXTS)
    assert near_dedup(spark, docs(spark).filter("false"), DATA).collect() == []


def test_near_copies_of_table(spark):
    sf_dir = DATA.replace("0.001", "0.01")
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert kept(near_dedup(spark, table, sf_dir)) == plain_kept(texts)


def test_workers_give_memory_back():
    def anonymous() -> float:
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) / 1024

    pins = []

    def work(batches):
        repeats.powers_of(repeats.BASES[1], 10)
        held = [np.ones(8_000) for _ in range(4000)]
        pins.append(np.ones(8_000))  # what stays above the freed arrays
        del held
        yield from batches

    before = anonymous()
    assert list(common.tidy(work)([1, 2])) == [1, 2]
    assert not repeats._powers
    assert anonymous() < before + 100
