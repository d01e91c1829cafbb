"""Near copies by SimHash (see simhash), checked and completed by the exact similarity of their word shingles.

A text is the set of its shingles' hashes; two texts are near copies if their sets' Jaccard similarity is LEAST or more.
Every text's fingerprint is linked first, by the grid over segment popcounts, and links of similar sets hold. Pairs of
less similar texts lie at larger Hamming distances, up to any, so what fingerprints can't join is found by shingles:
sets that are so similar share shingles early in any order of all shingles (prefix filter), so texts too few of whose
first shingles recur go at once; of the others, texts that share a shingle among their first in the order from rare to
common are compared as whole sets, where the shingles from there on can be enough (positional filter). Where many texts
share a shingle, the one with the commonest shingles comes first, as it is what the others are copies of, and only pairs
whose bit signatures are near are compared at all. Shingles and equal sets are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import LOWER, Scratch, cut, flat, keyed_texts, lists, mixed, same_doc, tidy, unpacked, word_bounds
from tramline.llm.repeats import BASES, BYTE_VALUES, Rolling
from tramline.llm import simhash
from tramline.llm.simhash import components, fingerprints

SHINGLE = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: In groups of more texts than this, texts are first compared with one of the group; then those not yet joined in pairs.
PAIRED_MOST = 32
PIVOT_ROUNDS = 2
#: 64-bit words of a set's signature: of each bit, whether an odd number of the set's shingles fall on it.
WORDS = 8
SIGNATURE = [f"s{i}" for i in range(WORDS)]


def at_least(n: np.ndarray) -> np.ndarray:
    """The least number of shingles that a set of n has in common with one as similar, and the least size of that."""
    return -(-n * LEAST[0] // LEAST[1])


def spare(n: np.ndarray) -> np.ndarray:
    """How many common shingles the first n - at_least(n) + spare(n) of a set must have with those of one as large or larger."""
    return -(-n // 5)


def shingles(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles' hashes in ascending order, and n + 1 offsets; all words of a shorter text are one shingle."""
    starts, ends, at = word_bounds(data, offsets)
    words = Rolling(BYTE_VALUES[LOWER[data]], BASES[1])(starts, ends)
    size = np.diff(at)
    number = np.where(size > 0, np.maximum(size - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(len(size)), number)
    first = at[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    found = Rolling(words, BASES[2])(first, np.minimum(first + shingle, at[doc + 1])).view(np.int64)
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    return found[new], np.append(0, np.cumsum(np.bincount(doc[new], minlength=len(size))))


def signatures(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(WORDS, n) signatures. Two sets' signatures differ in no more bits than there are shingles in just one of the sets."""
    bits = 64 * WORDS
    place = np.repeat(np.arange(len(at) - 1), np.diff(at)) * bits + (mixed(found.view(np.uint64)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=(len(at) - 1) * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(-1, WORDS).T


def shingle_sets(docs: DataFrame, columns: list[str], whole: bool, shingle: int = SHINGLE) -> DataFrame:
    """`columns` of docs with k, a name of the text's set; n, its size; and its first shingles in order of hash. whole: all of them, and the signature."""

    @tidy
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            found, at = shingles(*flat(batch.column("text")), shingle)
            n = np.diff(at)
            sums = np.append(np.uint64(0), np.cumsum(mixed(found.view(np.uint64))))
            k = mixed(sums[at[1:]] - sums[at[:-1]] + n.astype(np.uint64)).view(np.int64)
            held = n if whole else np.minimum(n, n - at_least(n) + spare(n))
            place = np.arange(held.sum()) + np.repeat(at[:-1] - (np.cumsum(held) - held), held)
            out = batch.select(columns)
            signs = [pa.array(np.ascontiguousarray(s)) for s in signatures(found, at)] if whole else []
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(k), pa.array(n), lists(found[place], held, pa.int64()), *signs], names=[*columns, "k", "n", "found", *(SIGNATURE if whole else [])])

    schema = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in columns)
    more = "".join(f", {s} long" for s in SIGNATURE) if whole else ""
    return docs.select(*columns, "text").mapInArrow(find, f"{schema}k long, n long, found array<long>{more}")


def recurring(rows: DataFrame) -> DataFrame:
    """The (k, n) of the sets enough of whose first shingles other sets have among theirs."""
    by = Window.partitionBy("h")
    shared = rows.select("k", F.explode("found").alias("h")).select("k", "h", (F.min("k").over(by) < F.max("k").over(by)).alias("more"))
    shared = shared.filter("more").select("k", "h").distinct().groupBy("k").agg(F.count("*").alias("shared"))
    least = f"(n * {LEAST[0]} + {LEAST[1] - 1}) div {LEAST[1]}"
    return rows.select("k", "n").distinct().join(shared, "k").filter(f"shared >= ({least} + 4) div 5").select("k", "n")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of sets that are similar enough."""
    a, b = (sets.select(F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("found").alias(f"f{x}")) for x in "ab")
    common = F.size(F.array_intersect("fa", "fb"))
    return pairs.join(a, "a").join(b, "b").filter(common * sum(LEAST) >= (F.col("na") + F.col("nb")) * LEAST[0]).select("a", "b")


def near_signatures() -> Column:
    """Whether sets a and b may be similar, by sizes and signatures: similar sets have few enough shingles that are in just one of them."""
    differ = sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in SIGNATURE), F.lit(0))
    return differ * sum(LEAST) <= (F.col("a.n") + F.col("b.n")) * (LEAST[1] - LEAST[0])


def reaches(row: str, n: Column) -> Column:
    """Whether a set's shingles from its turn on are enough to be as similar to a set of n, if none before is in that too."""
    return (F.col(f"{row}n") - F.col(f"{row}turn") + 1) * sum(LEAST) >= (F.col(f"{row}n") + n) * LEAST[0]


def alike(rows: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) of similar sets whose texts' fingerprints are equal or linked, from each row's set k and fingerprint fp.

    Of the sets with one fingerprint the least stands for it: the others are compared with it, and it with those of
    linked fingerprints.
    """
    marks = scratch.keep(rows.select("k", "fp").distinct(), "marks")
    fps = scratch.keep(marks.groupBy("fp").agg(F.min("k").alias("least")), "fps")
    found = simhash.links(fps.select("fp"), Scratch(rows.sparkSession, "simhash"))
    same = marks.join(fps, "fp").filter("k <> least").select(F.col("k").alias("a"), F.col("least").alias("b"))
    a, b = (fps.select(F.col("fp").alias(x), F.col("least").alias(f"least_{x}")) for x in "ab")
    near = found.join(a, "a").join(b, "b").filter("least_a <> least_b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    pairs = same.union(near).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return scratch.keep(similar(pairs, sets), "alike")


def links(sets: DataFrame, scratch: Scratch, known: DataFrame) -> DataFrame:
    """Edges (a, b), with the known ones, whose components are those of all pairs of similar sets.

    A group is the sets with one shingle among their first, without those that can't be as similar to the group's
    smallest if this shingle is the first in common. All pairs of a small group are compared. In a large one
    each is compared with one of the group, for PIVOT_ROUNDS rounds: first with that whose shingles are the commonest,
    which is the one that near copies were made from, as changes make rare shingles; then with others. After that, pairs
    that no chain of links joins yet and whose signatures are near are compared.
    """
    flat_ = sets.select("k", "n", F.explode("found").alias("h"))
    flat_ = flat_.withColumn("c", F.count("*").over(Window.partitionBy("h")))
    of_set = Window.partitionBy("k")
    flat_ = flat_.withColumn("turn", F.row_number().over(of_set.orderBy("c", "h"))).withColumn("common", F.avg(F.log2("c")).over(of_set))
    first = flat_.filter(f"turn <= n - (n * {LEAST[0]} + {LEAST[1] - 1}) div {LEAST[1]} + 1 AND c > 1").select("h", "k", "n", "turn", "common")
    of_shingle = Window.partitionBy("h")
    first = first.withColumn("least", F.min("n").over(of_shingle)).filter(reaches("", F.col("least"))).drop("least")
    first = first.withColumn("c", F.count("*").over(of_shingle)).filter("c > 1")
    first = scratch.keep(first, "first")
    ordered = reaches("a.", F.col("b.n")) & reaches("b.", F.col("a.n"))  # holds at the first shingle that two similar sets share
    sizes = F.least("a.n", "b.n") * LEAST[1] >= F.greatest("a.n", "b.n") * LEAST[0]

    def paired(groups: DataFrame, others: DataFrame, when: Column) -> DataFrame:
        both = groups.alias("a").join(others.alias("b"), (F.col("a.h") == F.col("b.h")) & sizes & when)
        return both.select(F.greatest("a.k", "b.k").alias("a"), F.least("a.k", "b.k").alias("b")).distinct()

    few = first.filter(f"c <= {PAIRED_MOST}").select("h", "k", "n", "turn")
    pairs = scratch.keep(paired(few, few, (F.col("a.k") > F.col("b.k")) & ordered), "pairs")
    edges = known.union(scratch.keep(similar(pairs.join(known, ["a", "b"], "left_anti"), sets), "similar"))
    crowded = first.filter(f"c > {PAIRED_MOST}").select("h", "k", "n", "turn", "common").join(sets.select("k", *SIGNATURE), "k")
    crowded = scratch.keep(crowded, "crowded")
    for turn in range(PIVOT_ROUNDS + 1):
        if crowded.isEmpty():
            break
        roots = components(edges, scratch, f"joined-{turn}").withColumnRenamed("node", "k")
        labelled = crowded.join(roots, "k", "left").withColumn("root", F.coalesce("root", "k"))
        # groups that aren't joined as a whole
        open_ = labelled.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("h")
        live = scratch.keep(labelled.join(open_, "h", "left_semi"), f"live-{turn}")
        other, when = live, (F.col("a.k") > F.col("b.k")) & ordered
        if turn < PIVOT_ROUNDS:
            when = F.lit(True)
            order = F.struct(F.col("common") if turn == 0 else F.lit(0.0), F.xxhash64("k", F.lit(turn)))
            other = live.groupBy("h").agg(F.max_by(F.struct("k", "n", "root", *SIGNATURE), order).alias("p")).select("h", "p.*")
        pairs = scratch.keep(paired(live, other, when & (F.col("a.root") != F.col("b.root")) & near_signatures()), f"pairs-{turn}")
        edges = edges.union(scratch.keep(similar(pairs, sets), f"similar-{turn}"))
        crowded = live.drop("root")
    return edges


def keep_one_similar(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs with one row of each component of near copies: that with the least doc_id (nulls last; of repeated ids the least text key).

    Words are in ASCII lower case. Texts without words are copies of each other.
    """
    scratch = Scratch(docs.sparkSession, "similar")
    texts = keyed_texts(docs, rest=True).withColumn("place", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th").alias("th")))
    marked = fingerprints(texts, ["place", "text"], shingle)
    rows = scratch.keep(shingle_sets(marked, ["place", "fp"], False, shingle), "rows")
    named = scratch.keep(rows.groupBy("k").agg(F.min("place").alias("place"), F.first("n").alias("n")), "named")
    able = scratch.keep(recurring(rows).join(named.select("k", "place"), "k").select(F.col("place.id").alias("doc_id"), F.col("place.th").alias("th")), "able")
    sets = shingle_sets(same_doc(texts.select("doc_id", "th", "text"), able, "left_semi"), [], True, shingle)
    sets = scratch.keep(sets.dropDuplicates(["k"]), "sets")
    found = scratch.keep(components(links(sets, scratch, alike(rows, sets, scratch)), scratch), "found")
    joined = named.join(found.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    kept = joined.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.id").alias("doc_id"), F.col("place.th").alias("th"))
    out = same_doc(texts.drop("place"), kept, "left_semi")
    return unpacked(out.dropDuplicates(["doc_id", "th"]), docs)
