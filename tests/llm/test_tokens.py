"""Byte-level BPE against tiktoken, alignment against the tokenizers' libraries, vector codes against SQL and a loop."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from compare import database, rows
from fixtures import DATA, TEXTS, collected, docs, sha, table_texts
from tokenizers import Tokenizer

from tramline.llm import byte_bpe
from tramline.llm.alignment import FILE_A, FILE_B, Pieces, aligned, alignment, distinct_units, op12_token_alignment
from tramline.llm.byte_bpe import MinimalHash, decoded, digests, encoded, merges_file, op11_byte_bpe, public_ranks
from tramline.llm.vector_codes import OP13_SQL, coded, op13_vector_codes, part_bounds, with_label_error

ODD = [" ", "  ", " ", "\n", "\t", "a", "b", "the", "Ünï", "日", "▁", "😀", "\x1c", "\x85", "　", "́", "é", ".", "'s", "1", "<s>", "<0x41>", "<|endoftext|>", "ﬁ", "\xa0", "\0", "​", "\r"]


def odd_strings(n: int, seed: int = 0) -> list[str]:
    rng = random.Random(seed)
    return [*("".join(rng.choices(ODD, k=rng.randrange(1, 30))) for _ in range(n)), *ODD, "a ", " a", "a  ", "x" * 5000, " " * 3000 + "x"]


# byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(byte_bpe.FILE), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected_digests(library, texts: list[tuple]) -> list[tuple]:
    out = []
    for i, t in texts:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode_bytes(ids))))
    return sorted(out, key=str)


def test_byte_bpe_odd_cases_and_query(spark, library):
    assert collected(digests(docs(spark), public_ranks())) == expected_digests(library, TEXTS)
    assert collected(op11_byte_bpe(spark, DATA)) == expected_digests(library, table_texts(spark))
    assert digests(docs(spark).limit(0), public_ranks()).count() == 0


def test_byte_bpe_round_trip(spark):
    ids = encoded(docs(spark), public_ranks())
    assert collected(decoded(ids, public_ranks()).selectExpr("doc_id", "decode(content, 'UTF-8')")) == sorted(((i, t or "") for i, t in TEXTS), key=str)
    assert collected(decoded(spark.createDataFrame([(1, None), (2, [-1, 65, None, 10**9])], "doc_id long, ids array<int>"), public_ranks()))[0][1] == b""


def test_byte_bpe_of_odd_strings(library, monkeypatch):
    bpe, texts = public_ranks(), odd_strings(300)
    ids, offsets = bpe.encoded(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [library.encode_ordinary(x) for x in texts]
    monkeypatch.setattr(byte_bpe, "CHUNK_BYTES", 100)  # a long text in steps
    monkeypatch.setattr(byte_bpe, "STEP", 7)
    long = "".join(texts)
    assert bpe.encoded([long])[0].tolist() == library.encode_ordinary(long)
    assert bpe.decoded(bpe.encoded([long])[0]) == long.encode()


def test_every_entry_is_what_its_bytes_merge_to(ranks):
    bpe = public_ranks()
    assert all(bpe.merged(x) == [rank] for x, rank in ranks.items())
    assert merges_file(public_tokenizers.path(FILE_A), public_tokenizers.PATTERN).ranks == ranks


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000])
def test_minimal_hash(n):
    keys = sorted({random.Random(k).randbytes(k % 9 + 1) for k in range(n)})
    words = MinimalHash(keys, list(range(len(keys))))
    assert len(words.values) == len(keys) == len(set(words.values.tolist()))  # as many slots as keys
    asked = [*keys, b"", b"not a key", b"x" * 300]
    lengths = np.array([len(k) for k in asked])
    got = words.found(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(lengths) - lengths, lengths)
    assert got.tolist() == [*range(len(keys)), -1, -1, -1]


# alignment


@pytest.fixture(scope="module")
def models():
    with open(public_tokenizers.path(FILE_B), "rb") as f:
        model = f.read()
    return merges_file(public_tokenizers.path(FILE_A), public_tokenizers.PATTERN), model


def plain_alignment(texts: list[tuple]) -> list[tuple]:
    """By the libraries, link by link."""
    a = Tokenizer.from_file(public_tokenizers.path(FILE_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(FILE_B))
    letters = {c: k for k, c in enumerate(byte_bpe.byte_letters())}
    groups_of = []
    for _, text in texts:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
            groups_of.append([])
            continue
        ends = [np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b)]
        common, groups, i, j = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
        for end in common:
            m, n = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append((ids_a[i:m], ids_b[j:n]))
            i, j = m, n
        groups_of.append(groups)
    count, best = Counter(), defaultdict(int)
    for groups in groups_of:
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    for (x, _), c in count.items():
        best[x] = max(best[x], c)
    out = []
    for (i, _), groups in zip(texts, groups_of, strict=True):
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_a, n_b = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups)
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha(text.encode()) if groups else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("by_word", [True, False])
def test_alignment_odd_cases(spark, models, by_word):
    assert collected(alignment(docs(spark), *models, by_word=by_word)) == plain_alignment(TEXTS)
    assert alignment(docs(spark).limit(0), *models, by_word=by_word).count() == 0


def test_alignment_of_odd_strings(spark, models):
    texts = list(enumerate(odd_strings(400, 1)))
    got = alignment(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), *models, by_word=True)
    assert collected(got) == plain_alignment(texts)


def test_alignment_query(spark):
    assert collected(op12_token_alignment(spark, DATA)) == plain_alignment(table_texts(spark))


def test_units_of_a_long_text(models, monkeypatch):
    text = " ".join(odd_strings(200, 2))
    short = distinct_units([text, "", "b"], True)
    bpe, pieces = models[0], Pieces(models[1])
    whole = aligned([text, "", "b"], bpe, pieces)
    monkeypatch.setattr("tramline.llm.alignment.STEP", 10)
    long = distinct_units([text, "", "b"], True)
    assert "".join(long[0][u] for u in long[1][: long[2][1]]) == " " + text
    assert [[x[0][u] for u in x[1]] for x in (short, long)][0] == [long[0][u] for u in long[1]]
    assert aligned([text, "", "b"], bpe, pieces, True).digests == whole.digests


# vector codes


def test_codes_query(spark):
    got = op13_vector_codes(spark, DATA)
    assert rows(got.toPandas()) == rows(database(DATA).execute(OP13_SQL).df())


def plain_codes(vectors: list[tuple], parts: int, entries: int, rounds: int) -> tuple[list[tuple], list]:
    """vec_id, label, code and error, in Python's integers; the codebooks."""
    from fractions import Fraction
    from math import floor, isfinite

    kept = [(i, label, [floor(4096 * Fraction(x)) for x in v], v) for i, v, label in vectors if v is not None and all(x is not None and isfinite(x) for x in v)]
    if not kept:
        return [], []
    sizes = Counter(len(v) for _, _, v, _ in kept)
    width = min(sizes, key=lambda n: (-sizes[n], n))
    kept = sorted((x for x in kept if len(x[2]) == width), key=lambda x: (x[0] is None, x[0] or 0, x[3]))
    bounds = part_bounds(width, parts)
    books = [[v[a:b] for _, _, v, _ in kept[:entries]] for a, b in bounds]

    def nearest(book: list, x: list) -> tuple[int, int]:
        return min((sum((p - q) ** 2 for p, q in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(bounds):
            of = defaultdict(list)
            for _, _, v, _ in kept:
                of[nearest(books[p], v[a:b])[1]].append(v[a:b])
            books[p] = [[sum(c) // len(c) for c in zip(*of[e], strict=True)] if of[e] else books[p][e] for e in range(len(books[p]))]
    out = []
    for i, label, v, _ in kept:
        found = [nearest(books[p], v[a:b]) for p, (a, b) in enumerate(bounds)]
        error = sum(d for d, _ in found)
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error if error < 1 << 63 else None))
    return sorted(out, key=str), books


SMALL = [(k if k % 9 else None, [random.Random(k * 11 + j).gauss(0, 1) for j in range(10)], k % 3 or None) for k in range(60)]
CASES = {
    "plain": SMALL,
    "odd": [*SMALL, (3, [9.0] * 10, 1), (3, [9.0] * 10, 1), (4, None, 1), (5, [None] * 10, 1), (6, [float("nan")] * 10, 2), (7, [float("inf")] * 10, 2), (8, [], 0), (9, [1.0], 0), (-1, [0.0] * 10, None)],
    "huge": [(1, [1e300, -3.0, 5.5, 2.0], 1), (2, [5e-324, -1e200, 3e9, 0.1], 1), (3, [70000.25, -70000.25, 1.5, 2.5], None)],
    "few": SMALL[:3],
    "none": [(1, None, 1)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_codes_odd_cases(spark, case):
    table = spark.createDataFrame([(*r, "x", b"y") for r in CASES[case]], "vec_id long, embedding array<double>, label int, code string, numbers binary").repartition(3)
    got, books = coded(table, parts=4, entries=5, rounds=3)
    expected, plain_books = plain_codes(CASES[case], 4, 5, 3)
    assert collected(got) == expected
    assert [b.tolist() for b in books] == plain_books
    assert with_label_error(got).count() == len(expected)


def test_label_errors(spark):
    got = with_label_error(spark.createDataFrame([(1, 1, "", 5), (2, 1, "", 6), (3, None, "", 7), (4, None, "", 8), (5, 2, "", (1 << 63) - 1), (6, 2, "", 1)], "vec_id long, label int, code string, error long"))
    assert [r["label_error"] for r in got.orderBy("vec_id").collect()] == [11, 11, 15, 15, None, None]


def test_codebook_digest():
    from tramline.llm.vector_codes import codebook_digest

    assert codebook_digest([np.array([[1, -2]]), np.array([[3, 4]])]) == hashlib.sha256(b"1,-2,3,4").hexdigest()
