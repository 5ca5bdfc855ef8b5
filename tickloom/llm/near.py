"""Near duplicates by b-bit MinHash.

A document's set is its distinct word shingles. Of 128 minima per set, bands of
five give bucket keys, and the two low bits of all of them make a packed
signature of 256 bits. Documents with equal sets are one node from the start.
Nodes that share a bucket are candidates; bit counts of their signatures give an
estimate, corrected for the chance agreement of two-bit values, and candidates
far below the threshold are dropped. The others are confirmed on full sets.

Only whether documents are connected matters, so not every pair of a large group
is looked at: (1) in a few passes, bucket members in signature order are compared
with those just before them in other components, and each node's best few are
confirmed; (2) in buckets that then still hold several components, members
outside the bucket's largest one are compared with all members of other
components by longer signatures (1024 minima), which tell close pairs from links
well enough that few false ones are left to confirm. A pair is put out by the
first bucket it shares only. At a similarity of 0.85 two documents share no
bucket with probability 4e-7 (at 0.8: 5e-5), and the cut of an estimate loses
them with about 1e-6.

Defined cases: null texts and texts without words have an empty set and are
linked with nothing. Documents without an id are linked with nothing, have no
component and are kept. Texts under one id are told apart by their sets, each is
linked by its own; the component of an id then joins what any of its texts is
linked with (they share all links). ``one_of_each`` looks at the texts: one that is
linked with nothing stays, whatever else goes by its id. Empty tables give empty
results. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import U64, WordHashes, arrow_map, likely, materialise, mixed, run_hashes
from tickloom.llm.components import components

MINIMA = 128
BAND = 5
BANDS = MINIMA // BAND
BITS = 2
WORDS = MINIMA * BITS // 64
#: A candidate must agree in as many values as a pair at the threshold less so many deviations.
DEVIATIONS = 5.5
#: Best candidates of a node that are confirmed before whole components are told apart.
BEST = 3
LOOK_BACK = 3
#: Shingles of texts that a task remembers while it confirms pairs.
HELD_SHINGLES = 1 << 20
#: Rows that go to a Python worker at a time; texts may be long, and pairs carry two.
BATCH_ROWS = 512
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
PASSES = 3
#: Minima of the longer signatures.
FINE_MINIMA = 1024

SIGNATURE = [f"s{i}" for i in range(WORDS)]
FINE = [f"f{i}" for i in range(FINE_MINIMA * BITS // 64)]
_RANDOM = np.random.default_rng(20260101)
FACTORS = _RANDOM.integers(0, 1 << 63, FINE_MINIMA, dtype=np.uint64) * U64(2) + U64(1)
OFFSETS = _RANDOM.integers(0, 1 << 63, FINE_MINIMA, dtype=np.uint64)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back, with small Arrow batches meanwhile, so that few texts are in memory at once."""
    conf = df.sparkSession.conf
    before = conf.get(ARROW_ROWS)
    conf.set(ARROW_ROWS, BATCH_ROWS)
    try:
        return materialise(df, name)
    finally:
        conf.set(ARROW_ROWS, before)


def shingle_set(text: str | None, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than ``size`` are one shingle."""
    words = hashes.of((text or "").encode().lower().split())
    return np.unique(run_hashes(words, min(size, len(words)))) if len(words) else np.empty(0, dtype=U64)


def minima(shingles: np.ndarray, n: int = MINIMA) -> np.ndarray:
    least = np.full(n, np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(shingles), 256):
        part = shingles[at : at + 256, None] * FACTORS[None, :n] + OFFSETS[None, :n]
        np.minimum(least, part.min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the (mixed) minima, packed into signed 64-bit words."""
    low = (mixed(least) & U64((1 << BITS) - 1)).astype(np.uint8)
    bits = ((low[:, None] >> np.arange(BITS, dtype=np.uint8)) & 1).ravel()
    return np.packbits(bits, bitorder="little").view("<i8")


def bucket_keys(least: np.ndarray) -> np.ndarray:
    keys = least[: BANDS * BAND].reshape(BANDS, BAND)
    out = np.arange(1, BANDS + 1, dtype=U64)
    for column in range(BAND):
        out = mixed(out * U64(0x9E3779B97F4A7C15) + keys[:, column])
    return out.view(np.int64)


def agreeing(left: str, right: str) -> Column:
    """How many two-bit values of two long signatures agree."""
    differ = []
    for name in FINE:
        x = f"({left}.{name} ^ {right}.{name})"
        differ.append(f"bit_count(({x} | shiftright({x}, 1)) & 6148914691236517205L)")
    return F.expr(f"{FINE_MINIMA} - ({' + '.join(differ)})")


def least_agreeing(similarity: int, n: int) -> int:
    """Values of ``n`` that a pair of the given similarity (in percent) agrees in, with a wide margin.

    Values of different minima agree by chance too, one in four of two bits each.
    """
    chance = 1 / (1 << BITS)
    share = similarity / 100 * (1 - chance) + chance
    return int(n * share - DEVIATIONS * (n * share * (1 - share)) ** 0.5)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature words, bucket keys."""

    def signed(found: Iterator[tuple]) -> Iterable[tuple]:
        hashes = WordHashes()
        for doc_id, text in found:
            shingles = shingle_set(text, hashes, size)
            if not len(shingles):
                yield doc_id, 0, None, *[None] * WORDS, None
                continue
            least = minima(shingles)
            yield doc_id, len(shingles), digest_of(shingles), *packed(least).tolist(), bucket_keys(least).tolist()

    fields = ["doc_id long", "n_shingles long", "digest binary", *[f"{s} long" for s in SIGNATURE], "keys array<long>"]
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), signed, ", ".join(fields))


def bucket_members(nodes: DataFrame) -> DataFrame:
    """bucket, node, signature for buckets of two or more nodes."""
    places = nodes.select("node", F.explode("keys").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return places.join(shared, "bucket").join(nodes.select("node", *SIGNATURE), "node")


def in_parts(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``members`` with the component they are in."""
    if labels is None:
        return members.withColumn("part", F.col("node"))
    placed = members.join(labels.withColumnRenamed("root", "part"), "node", "left")
    return placed.withColumn("part", F.coalesce("part", "node"))


def adjacent(members: DataFrame, turn: int, agree: int) -> DataFrame:
    """a, b, agreed of members of different parts that follow each other closely in a bucket.

    The order is that of the signatures, from word ``turn`` on. Rows are ranged over
    (bucket, signature), so a large bucket spreads over tasks.
    """
    signature = SIGNATURE[turn % WORDS :] + SIGNATURE[: turn % WORDS]
    order = ["bucket", *signature, "node"]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = members.select(*order, "part").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    odd = 0x5555555555555555

    def compared(found: Iterator[tuple]) -> Iterable[tuple]:
        bucket, last = None, []
        for row in found:
            *words, node, part = row[1:]
            if row[0] != bucket:
                bucket, last = row[0], []
            for other, at, its in last:
                if its != part:
                    differ = sum((((x := a ^ b) | x >> 1) & odd).bit_count() for a, b in zip(words, other, strict=True))
                    if MINIMA - differ >= agree:
                        yield max(node, at), min(node, at), MINIMA - differ
            last = [*last[-LOOK_BACK + 1 :], (words, node, part)]

    return arrow_map(ranged, compared, "a long, b long, agreed int").distinct()


def best_of(candidates: DataFrame) -> DataFrame:
    rank = Window.partitionBy("a").orderBy(F.col("agreed").desc(), "b")
    return candidates.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= BEST).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """a, b, linked: whether 100 * intersection >= similarity * union of the full sets.

    ``texts`` has (id, text) of every id in ``pairs``, and may have others.
    """
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    rights = likely(texts, "id", pairs.select("b")).withColumnsRenamed({"id": "b", "text": "right"})
    lefts = likely(texts, "id", pairs.select("a")).withColumnsRenamed({"id": "a", "text": "left"})

    def measured(found: Iterator[tuple]) -> Iterable[tuple]:
        hashes, held, size_held = WordHashes(), {}, 0

        def set_of(text: str) -> np.ndarray:
            nonlocal size_held
            key = hashlib.blake2b((text or "").encode(), digest_size=16).digest()
            if (found := held.get(key)) is None:
                if size_held > HELD_SHINGLES:
                    held.clear()
                    size_held = 0
                found = held[key] = shingle_set(text, hashes, size)
                size_held += len(found)
            return found

        for a, b, left, right in found:
            mine, other = set_of(left), set_of(right)
            common = len(np.intersect1d(mine, other, assume_unique=True))
            yield a, b, common > 0 and 100 * common >= similarity * (len(mine) + len(other) - common)

    both = pairs.join(rights, "b").join(lefts, "a").select("a", "b", "left", "right")
    rows = arrow_map(both, measured, "a long, b long, linked boolean")
    return written(rows.groupBy("a", "b").agg(F.max("linked").alias("linked")), "confirmed")


def fine_signatures(ids: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """node and long signature of the given nodes (and maybe of others), from their texts."""

    def signed(found: Iterator[tuple]) -> Iterable[tuple]:
        hashes = WordHashes()
        for node, text in found:
            yield node, *packed(minima(shingle_set(text, hashes, size), FINE_MINIMA)).tolist()

    rows = arrow_map(likely(texts, "id", ids), signed, ", ".join(["node long", *[f"{f} long" for f in FINE]]))
    # The texts of a node have one set, so the rows of a node are equal.
    return written(rows.dropDuplicates(["node"]), "fine-signatures")


def across(members: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, agree: int) -> DataFrame:
    """a, b of candidates in different parts, from buckets that hold several.

    Members of a bucket's largest part are connected already, so only the others
    are compared, with every member of another part.
    """
    sizes = members.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    mixed_buckets = (
        sizes.groupBy("bucket")
        .agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("bucket", "largest")
    )
    open_ = written(members.select("bucket", "node", "part").join(mixed_buckets, "bucket"), "open-buckets")
    fine = fine_signatures(open_.select("node"), texts, size)
    open_ = written(open_.join(nodes.select("node", "keys"), "node").join(fine, "node"), "open-members")
    few, every = open_.where("part != largest").alias("x"), open_.alias("y")
    first = F.expr("get(filter(x.keys, k -> array_contains(y.keys, k)), 0) = x.bucket")
    return few.join(
        every,
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.part") != F.col("y.part"))
        & ((F.col("y.part") == F.col("y.largest")) | (F.col("x.node") > F.col("y.node")))
        & (agreeing("x", "y") >= agree)
        & first,
    ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def digest_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def digests(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (id, text) with the digest of the text's set, null if that is empty."""

    def signed(found: Iterator[tuple]) -> Iterable[tuple]:
        hashes = WordHashes()
        for doc_id, text in found:
            yield doc_id, text, digest_of(shingle_set(text, hashes, size))

    return arrow_map(rows.select("id", "text"), signed, "id long, text string, digest binary")


class Groups(NamedTuple):
    """What near_duplicates and one_of_each make their answers from.

    ``signed`` has (doc_id, n_shingles, digest) of every row, ``roots`` (digest, id, root) of every set with its
    smallest id, ``repeated`` (doc_id, keeper) of the ids with several sets, or is None if there are none.
    """

    signed: DataFrame
    roots: DataFrame
    repeated: DataFrame | None


def groups(docs: DataFrame, size: int, similarity: int) -> Groups:
    signed = written(signatures(docs, size), "signatures")
    known = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    spread = known.groupBy("doc_id").agg(F.min("digest").alias("keeper"), F.max("digest").alias("last"))
    repeated = written(spread.where("keeper != last").select("doc_id", "keeper"), "repeated-ids")
    if repeated.isEmpty():
        repeated = None
    # A node is a set, named by its smallest id; the further sets of an id get names of their own.
    equal = known.groupBy("digest").agg(F.min("doc_id").alias("id"))
    if repeated is None:
        equal = equal.withColumn("node", F.col("id"))
    else:
        further = F.col("digest") != F.col("keeper")
        equal = equal.join(repeated.withColumnRenamed("doc_id", "id"), "id", "left").select(
            "digest", "id", F.when(further, F.xxhash64("id", "digest")).otherwise(F.col("id")).alias("node")
        )
    equal = written(equal, "equal-sets")
    nodes = written(
        known.join(equal, "digest").where("doc_id = id").select("node", *SIGNATURE, "keys").distinct(), "nodes"
    )
    members = written(bucket_members(nodes), "bucket-members")
    # The texts that any later step looks at; they are told apart without moving the others.
    whole = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = likely(whole, "id", members.select("node"))
    if repeated is not None:
        several = repeated.select(F.col("doc_id").alias("id"))
        theirs = digests(likely(whole, "id", several).join(several, "id", "left_semi"), size)
        own = theirs.join(equal, ["id", "digest"]).select(F.col("node").alias("id"), "text").dropDuplicates(["id"])
        texts = texts.join(several, "id", "left_anti").unionByName(own)
    texts = written(texts, "texts")
    labels, links = None, None
    for turn in range(PASSES + 1):
        placed = written(in_parts(members, labels), "placed")
        if turn < PASSES:
            pairs = best_of(adjacent(placed, turn, least_agreeing(similarity, MINIMA)))
        else:
            pairs = across(placed, nodes, texts, size, least_agreeing(similarity, FINE_MINIMA))
        new = confirmed(pairs, texts, size, similarity).where("linked").select("a", "b")
        if labels is None or not new.isEmpty():
            links = new if links is None else links.union(new)
            labels = components(links)
    roots = equal.join(labels, "node", "left").select("digest", "id", F.coalesce("root", "node").alias("root"))
    return Groups(signed, roots, repeated)


def near_duplicates(docs: DataFrame, size: int, similarity: int) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    ``size`` is the words of a shingle, ``similarity`` a percentage of 80 or more.
    """
    signed, roots, repeated = groups(docs, size, similarity)
    if repeated is None:
        roots = roots.select("digest", F.col("root").alias("component_id"))
    else:
        # Rows that share an id share all links; a component has the name of its smallest id.
        known = signed.where("digest IS NOT NULL").select("doc_id", "digest").distinct().join(repeated, "doc_id")
        held = written(known.join(roots, "digest").select("doc_id", "root").distinct(), "roots-of-ids")
        least = held.groupBy("doc_id").agg(F.min("root").alias("b"))
        merged = components(held.join(least, "doc_id").select(F.col("root").alias("a"), "b"))
        merged = merged.select(F.col("node").alias("root"), F.col("root").alias("joined"))
        roots = written(
            roots.join(merged, "root", "left").select("digest", "id", F.coalesce("joined", "root").alias("root")), "roots"
        )
        names = roots.groupBy("root").agg(F.min("id").alias("component_id"))
        roots = roots.join(names, "root").select("digest", "component_id")
    held = signed.select("doc_id", "n_shingles", "digest").join(roots, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return held.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each(docs: DataFrame, size: int, similarity: int) -> DataFrame:
    """``docs`` without all but the first document of each group, and one row per id and set.

    The rows that go are told by narrow tables; texts move once, to meet the ids that go.
    """
    signed, roots, _ = groups(docs.select("doc_id", "text"), size, similarity)
    best = roots.groupBy("root").agg(F.min(F.struct("id", "digest")).alias("best"))
    firsts = roots.join(best, "root").select("digest", F.col("best.id").alias("_id"), F.col("best.digest").alias("_of"))
    first = F.col("digest").isNull() | ((F.col("doc_id") == F.col("_id")) & (F.col("digest") == F.col("_of")))
    verdicts = written(
        signed.where("doc_id IS NOT NULL")
        .select("doc_id", "digest")
        .join(firsts, "digest", "left")
        .select("doc_id", "digest", first.alias("kept")),
        "verdicts",
    )
    by_id = verdicts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("any"))
    by_id = written(by_id.where("n > 1 OR NOT any").select(F.col("doc_id").alias("_gone"), "any"), "ids-not-whole")
    key = docs["doc_id"].cast("long")
    rest = docs.join(by_id.select("_gone"), key == F.col("_gone"), "left_anti")
    twice = by_id.where("any").select("_gone")
    if twice.isEmpty():
        return rest
    # Of rows that share an id, one of each kept set stays: the one whose text has the smallest hash.
    text_key = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    several = twice.select(F.col("_gone").alias("id"))
    narrow = likely(docs.select(key.alias("id"), "text"), "id", several).join(several, "id", "left_semi")
    keyed = digests(narrow, size).select(F.col("id").alias("doc_id"), "digest", text_key.alias("_key"))
    kept = verdicts.where("kept").distinct().select(F.col("doc_id").alias("_id"), F.col("digest").alias("_of"))
    chosen = keyed.join(kept, (F.col("doc_id") == F.col("_id")) & F.col("digest").eqNullSafe(F.col("_of"))).groupBy(
        "_id", "_of"
    ).agg(F.min("_key").alias("_chosen"))
    chosen = written(chosen.select("_id", "_chosen"), "chosen-texts")
    stays = (key == F.col("_id")) & (text_key == F.col("_chosen"))
    single = docs.join(chosen, stays).dropDuplicates(["_id", "_chosen"]).select(*[docs[c] for c in docs.columns])
    return rest.unionByName(single)
