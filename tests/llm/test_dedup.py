"""Near-duplicates, repeated phrases and repeated strings against plain versions."""

import random
import zlib

import pytest
import xxhash
from fixtures import DATA, TEXTS, collected, covered, docs, least_linked, random_texts, sha, table_texts, words_of

from tramline.llm.common import Scratch
from tramline.llm.mixture import mixed_texts
from tramline.llm.phrases import op5_repeated_phrases, phrase_dedup
from tramline.llm.simhash import components, keep_one, links, near_duplicates, op3_simhash_near_dedup, subspaces
from tramline.llm.similar import keep_one_similar
from tramline.llm.substrings import dedup_texts, op8_suffix_dedup, substring_dedup


def plain_fingerprint(text: str | None) -> int:
    words = words_of(text, lower=True)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_near(texts: list[tuple]) -> list[tuple]:
    fps = [plain_fingerprint(t) for _, t in texts]
    roots = least_linked(fps, [i for i, _ in texts], 2)
    return sorted(((i, f"{fp:016x}", root) for (i, _), fp, root in zip(texts, fps, roots, strict=True)), key=str)


def plain_phrases(texts: list[tuple], window: int) -> list[tuple]:
    words = [tuple(words_of(t)) for _, t in texts]
    out = []
    for (i, _), w, gone in zip(texts, words, covered(words, window), strict=True):
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return sorted(out, key=str)


def plain_strings(texts: list[tuple], width: int) -> list[tuple]:
    data = [(t or "").encode() for _, t in texts]
    out = []
    for (i, _), d, gone in zip(texts, data, covered(data, width), strict=True):
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        out.append((i, len(d), sum(gone), spans, sha(bytes(x for x, g in zip(d, gone, strict=True) if not g))))
    return sorted(out, key=str)


def phrases(df, window):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept"].encode())) for r in phrase_dedup(df, window, 2).collect()), key=str)


def strings(df, width, gram=None):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in substring_dedup(df, width, gram).collect()), key=str)


def test_near_odd_cases(spark):
    assert collected(near_duplicates(docs(spark))) == plain_near(TEXTS)


def test_near_query(spark):
    assert collected(op3_simhash_near_dedup(spark, DATA)) == plain_near(table_texts(spark))


@pytest.mark.parametrize(("crowd", "parts"), [(20, None), (400, None), (20, 6), (20, 11)])
def test_links_in_crowded_cells(spark, crowd, parts):
    rng = random.Random(crowd)
    fps = {0, (1 << 64) - 1}
    for base in (rng.getrandbits(64), rng.getrandbits(64) | 1 << 63):
        for _ in range(crowd):
            fps.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    chain = rng.getrandbits(64)
    for k in range(0, 40, 2):  # each linked with the next only
        chain ^= 3 << k
        fps.add(chain)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    scratch = Scratch(spark, "test")
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r["node"]: r["root"] for r in components(links(frame, scratch, parts=parts), scratch).collect()}
    assert [found.get(x, x) for x in signed] == least_linked(fps, signed, 2)


def test_keep_one(spark):
    kept = keep_one(docs(spark))
    assert kept.columns == docs(spark).columns
    roots = {root for _, _, root in plain_near(TEXTS)}
    assert {r["doc_id"] for r in kept.collect()} == roots
    fps = [plain_fingerprint(t) for _, t in TEXTS]
    assert kept.count() == len(set(least_linked(fps, fps, 2)))


def test_phrases_odd_cases(spark):
    for window in (3, 20):
        assert phrases(docs(spark), window) == plain_phrases(TEXTS, window)


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_at_random(spark, seed):
    texts = random_texts(60, ["a", "b", "cc", "d"], 60, seed)
    assert phrases(docs(spark, texts), 5) == plain_phrases(texts, 5)


def test_phrases_query(spark):
    assert collected(op5_repeated_phrases(spark, DATA)) == plain_phrases(table_texts(spark), 35)


def test_strings_odd_cases(spark):
    for width in (9, 60):
        assert strings(docs(spark), width) == plain_strings(TEXTS, width)


@pytest.mark.parametrize("seed", [1, 2])
def test_strings_at_random(spark, seed):
    texts = random_texts(60, ["a", "ab", "é"], 50, seed)
    assert strings(docs(spark, texts), 12, 6) == plain_strings(texts, 12)


def test_cells_become_finer():
    parts = [subspaces(n, 2) for n in (1, 10**6, 10**8, 10**9, 10**11)]
    assert parts == sorted(parts) and parts[0] == 4 and parts[-1] > 6


@pytest.mark.parametrize("width", [3, 20])
def test_words_that_recur(spark, width):
    texts = TEXTS + random_texts(60, ["a", "b", "cc", "d"], 40, 3)
    words = [tuple(words_of(t)) for _, t in texts]
    plain = [(i, [x for x, g in zip(w, gone, strict=True) if not g]) for (i, _), w, gone in zip(texts, words, covered(words, width), strict=True)]
    out = dedup_texts(docs(spark, texts), width, words=True)
    got = [(r["doc_id"], words_of(r["text"])) for r in out.collect()]
    assert sorted(got, key=str) == sorted(plain, key=str)
    assert out.filter("text IS NULL").count() == sum(t is None for _, t in texts)


#: Two texts of one CRC-32.
COLLIDING = [(None, "plumless"), (None, "buckeroo")]


def test_texts_of_one_crc(spark):
    assert len({zlib.crc32(t.encode()) for _, t in COLLIDING}) == 1
    rows = docs(spark, COLLIDING)
    for kept in (keep_one(rows), keep_one_similar(rows), mixed_texts(rows), dedup_texts(rows, 3)):
        assert {r["text"] for r in kept.collect()} == {t for _, t in COLLIDING}
    longer = [(None, "a b c d " + t) for _, t in COLLIDING] + [(1, "a b c d")]
    assert phrases(docs(spark, longer), 3) == plain_phrases(longer, 3)
    assert strings(docs(spark, longer), 5) == plain_strings(longer, 5)


def test_strings_query(spark):
    assert collected(op8_suffix_dedup(spark, DATA)) == plain_strings(table_texts(spark), 400)


def test_cut_texts_keep_whole_characters(spark):
    texts = [(1, "é" * 30 + "b"), (2, "é" * 30 + "c"), (3, "short")]
    out = dedup_texts(docs(spark, texts), 9)
    assert out.columns == docs(spark, texts).columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "b"), (2, "c"), (3, "short")]


def test_empty_tables(spark):
    none = docs(spark).filter("false")
    assert near_duplicates(none).collect() == keep_one(none).collect() == phrase_dedup(none).collect() == substring_dedup(none).collect() == dedup_texts(none).collect() == []
