"""Repeated passages across documents, found with Aho-Corasick automata.

A passage is a run of ``WINDOW`` words. From every window the phrase of
``PHRASE`` words with the smallest hash is picked, so equal windows pick equal
phrases; phrases picked in two or more documents are confirmed as recurring, and the
text that holds one first supplies its words. A document without such a phrase holds
no repeated window. The others are dealt to shards of about ``SHARD_CHARS`` characters
by a hash, and each confirmed phrase goes to the shards whose documents pick it. A shard compiles
an automaton over the words of its phrases, streams its documents through it and gets
every place of a phrase; all windows around these places are then compared over all
documents by 128-bit hashes. A word goes if a window that covers it also starts in a
document with a smaller id.

Documents of equal words are compared once: all but the smallest id lose every
word if they hold a window at all. So a large group of copies costs nothing, and
phrase and window tables are only ever grouped by hash, counting before the shuffle.

Defined cases: null texts and texts shorter than a window lose nothing. Rows
without an id neither lose words nor make others lose them. Rows that share an id
do not make each other lose words. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import WordHashes, arrow_map, clear_of, materialise, run_hashes

WINDOW = 50
PHRASE = 10
#: Characters of the documents of a shard.
SHARD_CHARS = 4 << 20
#: A key is hot if it holds more than one in this many rows.
HOT = 10_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def picked(hashes: np.ndarray) -> np.ndarray:
    """For each window, the start of its phrase of smallest hash, the first of equals."""
    phrases = run_hashes(hashes, PHRASE)
    inside = WINDOW - PHRASE + 1
    out = np.empty(len(hashes) - WINDOW + 1, dtype=np.int64)
    for at in range(0, len(out), 1 << 14):
        part = phrases[at : at + (1 << 14) + inside - 1]
        least = np.lib.stride_tricks.sliding_window_view(part, inside).argmin(axis=1)
        n = min(len(least), len(out) - at)
        out[at : at + n] = at + np.arange(n) + least[:n]
    return out


def described(docs: DataFrame) -> DataFrame:
    """doc_id, digest and number of the words, checksum of the words joined, picked phrases."""

    def rows(found: Iterator[tuple]) -> Iterable[tuple]:
        hashes = WordHashes()
        for doc_id, text in found:
            words = words_of(text)
            phrases = []
            if len(words) >= WINDOW and doc_id is not None:
                own = hashes.of(words)
                phrases = np.unique(run_hashes(own, PHRASE)[picked(own)]).view(np.int64).tolist()
            joined = b" ".join(words)
            yield doc_id, digest_of(words), len(words), hashlib.sha256(joined).hexdigest(), phrases

    fields = "doc_id long, digest binary, n_words long, sha string, phrases array<long>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), rows, fields)


def sharing(rows: DataFrame, counted: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` joined to ``counted``, whose ``n`` tells how many of the ``total`` rows have a key.

    Keys that hold more than one in ``HOT`` rows are sent to all tasks, fewer than ``HOT``
    keys by arithmetic; so the rows of a hot key stay where they are.
    """
    hot = F.broadcast(counted.where(F.col("n") > total // HOT))
    rest = counted.where(F.col("n") <= total // HOT)
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(rest, keys)).drop("n")


def seen_in_two(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ``low`` (smallest doc_id) and ``n`` (rows) of the keys that two documents hold."""
    low, high = F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    return rows.groupBy(*keys).agg(low, high, F.count("*").alias("n")).where("low != high").drop("high")


def recurring(nodes: DataFrame) -> DataFrame:
    """doc_id, digest, the phrases that another document holds as well, and those first held here."""
    held = nodes.select("doc_id", "digest", F.explode("phrases").alias("phrase"))
    total = nodes.agg(F.coalesce(F.sum(F.size("phrases")), F.lit(0))).first()[0]
    shared = materialise(seen_in_two(held, ["phrase"]), "phrases")
    return sharing(held, shared, ["phrase"], total).groupBy("doc_id", "digest").agg(
        F.collect_list("phrase").alias("phrases"),
        F.collect_list(F.when(F.col("doc_id") == F.col("low"), F.col("phrase"))).alias("first"),
    )


def confirmed(holders: DataFrame) -> DataFrame:
    """phrase, words of each recurring phrase, from the text that holds it first."""

    def rows(found: Iterator[tuple]) -> Iterable[tuple]:
        memory = WordHashes()
        for text, digest, wanted in found:
            words = words_of(text)
            if digest_of(words) == bytes(digest):  # not another text under the same id
                hashes = run_hashes(memory.of(words), PHRASE).view(np.int64)
                places = np.flatnonzero(np.isin(hashes, np.array(wanted, dtype=np.int64)))
                values, first = np.unique(hashes[places], return_index=True)
                for value, at in zip(values.tolist(), places[first].tolist(), strict=True):
                    yield value, b" ".join(words[at : at + PHRASE]).decode()

    owners = holders.where(F.size("first") > 0).select("text", "digest", "first")
    found = arrow_map(owners, rows, "phrase long, words string")
    return found.groupBy("phrase").agg(F.min("words").alias("words"))  # texts under one id may share one


class Shard:
    """An automaton over the word sequences of confirmed phrases."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)

    def add(self, words: list[bytes]) -> None:
        self.automaton.add_word(tuple([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Starts of all phrases in a document."""
        if not len(self.automaton):
            return np.empty(0, dtype=np.int64)
        if self.automaton.kind != ahocorasick.AHOCORASICK:
            self.automaton.make_automaton()
        get = self.numbers.get
        ends = [end for end, _ in self.automaton.iter(tuple([get(w, 0) for w in words]))]
        return np.array(ends, dtype=np.int64) - (PHRASE - 1)


def around(places: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows that hold a phrase found at one of ``places``."""
    n = n_words - WINDOW + 1
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.clip(places - (WINDOW - PHRASE), 0, n), 1)
    np.add.at(edge, np.clip(places + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(edge)[:-1] > 0)


def candidate_windows(phrases: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, digest and starts and hashes (h1, h2) of the windows around confirmed phrases."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(phrases, "doc_id")
    holders = materialise(texts, "holders")
    n = -(-holders.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // SHARD_CHARS) or 1
    placed = holders.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(n)))
    dealt = placed.select("shard", F.explode("phrases").alias("phrase")).distinct()
    patterns = dealt.join(confirmed(holders), "phrase").select(
        "shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("digest"), F.col("words").alias("text"),
    )
    stream = placed.select("shard", F.lit(1).alias("kind"), "doc_id", "digest", "text")

    def rows(found: Iterator[tuple]) -> Iterable[tuple]:
        memory = WordHashes()
        for _, part in groupby(found, key=itemgetter(0)):
            shard = Shard()
            for _, kind, doc_id, digest, text in part:
                words = words_of(text)
                if kind == 0:
                    shard.add(words)
                elif digest_of(words) == bytes(digest):
                    starts = around(shard.places(words), len(words))
                    if len(starts):
                        hashes = memory.of(words)
                        first, second = (run_hashes(hashes, WINDOW, seed)[starts].view(np.int64) for seed in (0, 77))
                        yield doc_id, digest, starts, first, second

    # Phrases of a shard come ahead of its documents, so these are streamed.
    sorted_rows = patterns.unionByName(stream).repartition("shard").sortWithinPartitions("shard", "kind")
    fields = "doc_id long, digest binary, start array<int>, h1 array<long>, h2 array<long>"
    return arrow_map(sorted_rows, rows, fields, rows=64)


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_words, sha and what to remove: ``all`` of it, or windows from ``starts`` (null: none)."""
    rows = materialise(described(docs), "described")
    long = rows.where((F.col("n_words") >= WINDOW) & F.col("doc_id").isNotNull())
    owners = materialise(long.groupBy("digest").agg(F.min("doc_id").alias("owner")), "owners")
    nodes = (
        long.join(owners, "digest").where("doc_id = owner").select("doc_id", "digest", "phrases")
        .dropDuplicates(["digest"])
    )
    found = materialise(candidate_windows(recurring(materialise(nodes, "nodes")), docs), "windows")
    total = found.agg(F.coalesce(F.sum(F.size("start")), F.lit(0))).first()[0]
    windows = found.select("doc_id", "digest", F.explode(F.arrays_zip("start", "h1", "h2")).alias("w")).select(
        "doc_id", "digest", "w.start", "w.h1", "w.h2"
    )
    first = materialise(seen_in_two(windows, ["h1", "h2"]), "first")
    cuts = (
        sharing(windows, first, ["h1", "h2"], total)
        .where("doc_id > low")
        .groupBy("doc_id", "digest")
        .agg(F.sort_array(F.collect_list("start")).alias("starts"))
    )
    held = rows.drop("phrases").join(owners, "digest", "left")
    return materialise(
        held.join(cuts, ["doc_id", "digest"], "left").withColumn(
            "all", F.coalesce(F.col("doc_id") > F.col("owner"), F.lit(False))
        ).drop("owner"),
        "removals",
    )


def kept_words(words: list[bytes], starts: list[int]) -> list[bytes]:
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.array(starts)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + WINDOW, -1)
    gone = np.cumsum(gone)[:-1] > 0
    return [w for w, out in zip(words, gone.tolist(), strict=True) if not out]


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    found = removals(docs)

    def rows(pairs: Iterator[tuple]) -> Iterable[tuple]:
        for doc_id, text, digest, starts, n_words in pairs:
            words = words_of(text)
            if digest_of(words) == bytes(digest):
                kept = kept_words(words, starts)
                yield doc_id, n_words, n_words - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    # One row per text under an id; the digest tells which of the id's rows it belongs to.
    partly = found.where("starts IS NOT NULL AND NOT all").select("doc_id", "digest", "starts", "n_words").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(partly, "doc_id")
    changed = arrow_map(
        texts.select("doc_id", "text", "digest", "starts", "n_words"), rows,
        "doc_id long, n_words long, n_removed long, kept_sha256 string",
    )
    nothing = hashlib.sha256(b"").hexdigest()
    rest = found.where("starts IS NULL OR all").select(
        "doc_id",
        "n_words",
        F.when(F.col("all"), F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(F.col("all"), F.lit(nothing)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    return rest.unionByName(changed)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; ``n_chars`` follows if there is one.

    A text that loses words becomes its kept words joined by one space; the others
    stay as they are.
    """
    found = removals(docs).where("starts IS NOT NULL OR all").select("doc_id", "digest", "starts", "all")
    by_id = found.groupBy("doc_id").agg(F.collect_set(F.struct("digest", "starts", "all")).alias("_cuts"))
    held = clear_of(docs, "_cuts", "_id").withColumn("_id", F.col("doc_id").cast("long"))
    joined = held.join(by_id.withColumnRenamed("doc_id", "_id"), "_id", "left")

    @F.pandas_udf("string")
    def cut(texts, cuts):
        import pandas as pd

        out = []
        for text, options in zip(texts, cuts, strict=True):
            if options is not None:
                words = words_of(text)
                own = digest_of(words)
                for option in options:
                    if bytes(option["digest"]) == own:
                        kept = [] if option["all"] else kept_words(words, list(option["starts"]))
                        text = b" ".join(kept).decode()
                        break
            out.append(text)
        return pd.Series(out, dtype=object)

    result = joined.withColumn("text", F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(cut("text", "_cuts")))
    if "n_chars" in docs.columns:
        kept = F.when(F.col("_cuts").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        result = result.withColumn("n_chars", kept.cast(docs.schema["n_chars"].dataType))
    return result.select(*docs.columns)
