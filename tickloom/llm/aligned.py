"""Alignment of two tokenizers' tokens by interval coalescing.

Tokens are intervals of bytes of the text with a space before it. All tokens of
both kinds of a batch of texts are sorted by start (``lexsort``), a running
maximum of their ends (``maximum.accumulate``) is taken, and a group ends where
the next start reaches that maximum: there, tokens of both kinds end. Within a
group the overlapping pairs are expanded; each is a link.

``align`` gives the groups of every text. ``summary`` also counts how often an id
pair is linked in the whole corpus. For that, texts go into blocks of about
``BLOCK_CHARS`` characters; a block keeps its links as places in a list of its
different pairs, compressed. Only those lists are added up over the corpus and
sent back to their blocks: a pair that is linked everywhere costs one row a
block, and no row carries a link.

Defined cases: null and empty texts, and texts whose tokens do not spell the
space and the text (a U+2581 in the text, say), have no tokens and no groups.
Repeated rows and ids are aligned each for itself and count each time; null ids
stay. Columns that share a name with a result are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tickloom.llm.common import clear_of, materialise, rows_of

#: Characters whose tokens are aligned at a time.
BATCH_CHARS = 1 << 19
#: Characters of the texts of a block; a longer text is a block of its own.
BLOCK_CHARS = 8 << 20
#: Longer texts are encoded by the library that reads the vocabulary file itself.
LONG = 100_000
MARK = "▁"
#: After a token: the next is of its kind and group, of its group, of its text, or there is none.
SEPARATORS = (b",", b"|", b";", b"")


class ByteTokens:
    """Byte-level tokens: ids of texts and the bytes of every id.

    If ids follow the order of the merges, texts are encoded from the ranks (a
    faster way to the same ids), very long ones by the vocabulary file's library.
    """

    def __init__(self, file: str, pattern: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.whole.encode_special_tokens = True
        model = json.loads(self.whole.to_str())["model"]
        letters = byte_letters()
        vocabulary = {bytes(letters[c] for c in name): i for name, i in model["vocab"].items() if set(name) <= set(letters)}
        self.raw = [b""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            self.raw[i] = name
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        ranks = {name: i for name, i in vocabulary.items() if name.decode("utf-8", "replace") not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.ranked = Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if (
            merged == sorted(merged) and len(merged) + 256 == len(ranks)
        ) else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [
            self.ranked.encode_ordinary(t)
            if self.ranked and len(t) <= LONG
            else self.whole.encode(t, add_special_tokens=False).ids
            for t in texts
        ]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class PieceTokens:
    """Pieces of a sentencepiece model, likewise; the model adds the space itself."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        self.raw = []
        for i in range(self.model.get_piece_size()):
            name = self.model.id_to_piece(i)
            self.raw.append(
                bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(MARK, " ").encode()
            )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Pair:
    """The two tokenizers of an alignment."""

    def __init__(self, byte_file: str, piece_model: str, pattern: str):
        self.a, self.b = ByteTokens(byte_file, pattern), PieceTokens(piece_model)
        self.a_sizes, self.b_sizes = (np.array([len(r) for r in v.raw], dtype=np.int64) for v in (self.a, self.b))
        most = max(len(self.a.raw), len(self.b.raw))
        self.spelled = [str(i).encode() + s for i in range(most) for s in SEPARATORS]


@lru_cache(maxsize=1)
def pair_of(byte_file: str, piece_model: str, pattern: str) -> Pair:
    return Pair(byte_file, piece_model, pattern)


def expanded(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (n[0] of them), then the same of the next."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def upto(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)])


class Alignment:
    """Tokens, groups and links of the texts of a batch.

    ``ids``, ``kinds`` (0: A, 1: B), ``groups``: of all tokens, by group, A before B.
    ``pairs``: A id * 2^32 + B id of every link. ``n_*``: numbers by text.
    """

    def __init__(self, texts: list[str | None], pair: Pair):
        found = [" " + t if t else "" for t in texts]
        a, b = pair.a.encode(found), pair.b.encode([t or "" for t in texts])
        for i, text in enumerate(found):
            whole = text.encode("utf-8", "surrogatepass")
            if not text or not (
                b"".join(map(pair.a.raw.__getitem__, a[i])) == whole == b"".join(map(pair.b.raw.__getitem__, b[i]))
            ):
                a[i], b[i] = [], []
        self.n_a, self.n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a, b))
        a_ids, b_ids = (
            np.fromiter((x for ids in found for x in ids), dtype=np.int64, count=int(n.sum()))
            for found, n in ((a, self.n_a), (b, self.n_b))
        )
        # Each text's tokens of either kind cover the same bytes, so texts follow one another alike.
        a_ends, b_ends = np.cumsum(pair.a_sizes[a_ids]), np.cumsum(pair.b_sizes[b_ids])
        a_starts, b_starts = a_ends - pair.a_sizes[a_ids], b_ends - pair.b_sizes[b_ids]
        starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
        kinds = np.repeat(np.array([0, 1]), [len(a_ids), len(b_ids)])
        order = np.lexsort((kinds, starts))
        reached = np.maximum.accumulate(ends[order]) if len(order) else ends
        groups = np.empty(len(order), dtype=np.int64)
        groups[order] = np.cumsum(np.concatenate([[True], starts[order][1:] >= reached[:-1]])) - 1 if len(order) else 0
        by_group = np.lexsort((starts, kinds, groups))
        self.ids, self.kinds, self.groups = (x[by_group] for x in (np.concatenate([a_ids, b_ids]), kinds, groups))
        # The tokens of A that overlap each token of B lie side by side.
        first = np.searchsorted(a_ends, b_starts, side="right")
        n = np.searchsorted(a_starts, b_ends, side="left") - first
        self.pairs = (a_ids[expanded(first, n)] << 32) | np.repeat(b_ids, n)
        self.tokens_upto = upto(self.n_a + self.n_b)
        groups_upto = np.append(self.groups, self.groups[-1] + 1 if len(self.groups) else 0)[self.tokens_upto]
        self.n_groups = np.diff(groups_upto)
        self.n_links = np.diff(upto(n)[upto(self.n_b)])
        self.spelled = pair.spelled

    def digests(self) -> list[str]:
        """Per text, SHA-256 of its groups as `a,a|b;a|b,b`; '' without tokens."""
        separator = np.full(len(self.ids), 2)
        same = self.groups[1:] == self.groups[:-1]
        separator[:-1][same] = 1
        separator[:-1][same & (self.kinds[1:] == self.kinds[:-1])] = 0
        bounds = self.tokens_upto
        separator[bounds[1:][np.diff(bounds) > 0] - 1] = 3
        parts = list(map(self.spelled.__getitem__, (self.ids * 4 + separator).tolist()))
        return [
            hashlib.sha256(b"".join(parts[i:j])).hexdigest() if j > i else ""
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]

    def lists(self) -> list[list[dict[str, list[int]]]]:
        """Per text, its groups with the ids of either kind."""
        out = []
        for i, j in zip(self.tokens_upto[:-1].tolist(), self.tokens_upto[1:].tolist(), strict=True):
            groups: dict[int, tuple[list[int], list[int]]] = {}
            for token, kind, group in zip(
                self.ids[i:j].tolist(), self.kinds[i:j].tolist(), self.groups[i:j].tolist(), strict=True
            ):
                groups.setdefault(group, ([], []))[kind].append(token)
            out.append([{"a": a, "b": b} for a, b in groups.values()])
        return out


def in_batches(rows: Iterator[tuple], most: int) -> Iterator[list[tuple]]:
    """Rows (any, text) in groups of about ``most`` characters, a longer text alone."""
    held, size = [], 0
    for row in rows:
        n = len(row[1] or "")
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield held


def align(docs: DataFrame, byte_file: str, piece_model: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``groups``: of each, the ids of A (``a``) and of B (``b``)."""
    held = clear_of(docs, "groups") if text.lower() != "groups" else docs
    fields = [f for f in held.schema.fields if f.name != text]
    names = [f.name for f in fields]
    ids = ArrayType(IntegerType())
    kind = ArrayType(StructType([StructField("a", ids), StructField("b", ids)]))
    schema = StructType([*fields, StructField("groups", kind)])
    cells = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_file, piece_model, pattern)
        for batch in found:
            texts = ((i, t) for i, (t,) in enumerate(rows_of(batch.select([text]))))
            for group in in_batches(texts, BATCH_CHARS):
                lists = Alignment([t for _, t in group], pair).lists()
                part = batch.slice(group[0][0], len(group))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(lists, cells)], names=[*names, "groups"]
                )

    return held.select(*names, text).mapInArrow(run, schema)


def squeezed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def loosened(cell: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), dtype=kind)


BLOCK_FIELDS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "sha array<string>, pairs binary, counts binary, links binary"
)


def blocks(docs: DataFrame, byte_file: str, piece_model: str, pattern: str) -> DataFrame:
    """A row per block: numbers and digests by text, different pairs, their counts, links as places in them."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    struct = _parse_datatype_string(BLOCK_FIELDS)

    def run(found: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        pair = pair_of(byte_file, piece_model, pattern)
        number = TaskContext.get().partitionId() << 32
        rows = (row for batch in found for row in rows_of(batch))
        for members in in_batches(rows, BLOCK_CHARS):
            parts = []
            for group in in_batches(iter(members), BATCH_CHARS):
                whole = Alignment([t for _, t in group], pair)
                parts.append((whole.n_a, whole.n_b, whole.n_groups, whole.n_links, whole.digests(), whole.pairs))
            sums = [np.concatenate([p[k] for p in parts]).tolist() for k in range(4)]
            digests = [d for p in parts for d in p[4]]
            pairs, places, counts = np.unique(
                np.concatenate([p[5] for p in parts]), return_inverse=True, return_counts=True
            )
            cells = (
                squeezed(np.diff(pairs, prepend=0)), squeezed(counts.astype("<u4")), squeezed(places.astype("<u4"))
            )
            row = (number, [i for i, _ in members], *sums, digests, *cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema
            )
            number += 1

    schema = to_arrow_schema(struct)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, struct)


def block_pairs(cells: DataFrame) -> DataFrame:
    """block, place, pair and n: the different pairs of every block."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for block, pairs, counts in rows_of(batch):
                pairs = np.cumsum(loosened(pairs, "<i8"))
                counts = loosened(counts, "<u4").astype(np.int64)
                if len(pairs):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": pa.array(np.full(len(pairs), block, dtype=np.int64)),
                            "place": pa.array(np.arange(len(pairs), dtype=np.int32)),
                            "pair": pa.array(pairs),
                            "n": pa.array(counts),
                        }
                    )

    return cells.select("block", "pairs", "counts").mapInArrow(run, "block long, place int, pair long, n long")


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, count and best (its B id has no pair of a higher count) over all blocks.

    The table of B ids is as long as B's vocabulary at most, so it may go to all tasks.
    """
    totals = materialise(found.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    by_piece = totals.groupBy((F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))).alias("piece"))
    most = by_piece.agg(F.max("count").alias("most"))
    joined = totals.join(F.broadcast(most), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("piece"))
    return joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def summary(docs: DataFrame, byte_file: str, piece_model: str, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row of ``docs``."""
    cells = materialise(blocks(docs, byte_file, piece_model, pattern), "aligned")
    found = block_pairs(cells)
    judged = found.select("block", "place", "pair").join(pair_counts(found), "pair").select("block", "place", "count", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(key, block: pa.Table, values: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        places = loosened(row["links"], "<u4")
        at = values.column("place").to_numpy()
        counts, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        counts[at] = values.column("count").to_numpy()
        best[at] = values.column("best").to_numpy()
        links = upto(np.array(row["n_links"], dtype=np.int64))
        best, counts = (np.diff(upto(v[places])[links]) for v in (best, counts))
        columns = [
            pa.array(row["doc_id"], pa.int64()),
            *(pa.array(row[c], pa.int64()) for c in names[1:5]),
            pa.array(best.astype(np.int64)),
            pa.array(counts.astype(np.int64)),
            pa.array(row["sha"], pa.string()),
        ]
        return pa.Table.from_arrays(columns, names=names)

    return (
        cells.drop("pairs", "counts")
        .groupBy("block")
        .cogroup(judged.groupBy("block"))
        .applyInArrow(
            run,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string",
        )
    )
