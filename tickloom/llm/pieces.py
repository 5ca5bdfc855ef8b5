"""SentencePiece encoding and decoding by suffix-array matching.

Texts are cut into segments that no piece can cross. A worker remembers the ids of
segments, up to a bound; the segments of a batch that it does not know yet are laid
end to end. A suffix array indexes that text as deep as the longest piece, a binary
search gives every piece its range of occurrences, and the occurrences, laid out by
position and length, are the edges along which symbols are joined. The vocabulary is
a BPE model, so relaxing means joining in the model's order: in every segment the
pair whose edge has the best score, the leftmost of equals, until no pair has an
edge. The ids equal those of the sentencepiece library.

Defined cases: null and empty texts have no ids and decode to the empty text.
Characters without a piece become their UTF-8 bytes. A space and U+2581 are the
same to the model, so both decode to a space. Repeated rows get equal ids; input
columns that share a name with a result are replaced. A long text is cut into
segments a stretch at a time.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tickloom.llm.common import batches, clear_of, rows_of

MARK = "▁"
#: Segments longer than this are joined with a heap, one at a time.
LONG = 256
NONE = np.iinfo(np.int64).max
#: Segments a worker remembers, their characters, and the longest that is worth it.
HELD = 1 << 18
HELD_CHARS = 8 << 20
#: Segments looked up at a time, and characters of a text cut at a time.
FLUSH = 1 << 18
STRETCH = 1 << 20


class Vocabulary:
    """Pieces of a model as sorted byte keys, with scores and byte pieces."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = [
            i
            for i in range(len(names))
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        ]
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.raw = [b""] * len(names)
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.raw[i] = bytes([int(name[3:5], 16)])
            elif not sp.is_control(i):
                self.raw[i] = name.replace(MARK, " ").encode()
        self.depth = max(len(names[i]) for i in plain)
        # Characters as dense symbols: 0 parts segments, 1 is any character without a piece.
        chars = sorted({c for i in plain for c in names[i]})
        self.symbols = np.ones(0x110000, dtype=np.uint16)
        self.symbols[[ord(c) for c in chars]] = np.arange(2, len(chars) + 2)
        # Marks begin a segment; a character that no longer piece has is one of its own.
        joined = "".join(re.escape(c) for c in sorted({c for i in plain if len(names[i]) > 1 for c in names[i]} - {MARK}))
        self.segment = re.compile(f"{MARK}+[{joined}]*|[{joined}]+|.", re.DOTALL)
        self.raw_sizes = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.raw_at = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.raw_bytes = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        self.forget()
        self.ids = np.array(plain, dtype=np.int64)
        self.lengths = np.array([len(names[i]) for i in plain], dtype=np.int64)
        low = np.zeros((len(plain), self.depth), dtype=np.uint16)
        high = np.full((len(plain), self.depth), 0xFFFF, dtype=np.uint16)
        for row, i in enumerate(plain):
            code = self.symbols[[ord(c) for c in names[i]]]
            low[row, : len(code)] = high[row, : len(code)] = code
        self.low, self.high = as_keys(low), as_keys(high)
        # Joining order: best score first, as whole ranks; equal scores share a rank.
        scores = np.array([sp.get_score(i) for i in range(len(names))])
        self.ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int64)

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.chars = 0
        self.pool = np.empty(0, dtype=np.int32)
        self.sizes = np.empty(0, dtype=np.int64)

    def numbered(self, segments: list[str]) -> np.ndarray:
        """The place of each segment in ``sizes``, after encoding those not known yet."""
        distinct = set(segments)
        new = sorted(distinct - self.numbers.keys())
        if len(self.numbers) + len(new) > HELD or self.chars > HELD_CHARS:
            self.forget()
            new = sorted(distinct)
        if new:
            ids, sizes = encode_segments(new, self)
            self.numbers.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
            self.chars += sum(map(len, new))
            self.pool, self.sizes = np.concatenate([self.pool, ids]), np.concatenate([self.sizes, sizes])
        return np.fromiter(map(self.numbers.__getitem__, segments), dtype=np.int64, count=len(segments))


def as_keys(matrix: np.ndarray) -> np.ndarray:
    """Rows of symbols as big-endian byte strings, whose order is that of the symbols."""
    held = np.ascontiguousarray(matrix, dtype=">u2")
    return held.view(f"S{held.shape[1] * 2}").ravel()


@lru_cache(maxsize=1)
def vocabulary_of(model: str) -> Vocabulary:
    return Vocabulary(model)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` symbols, by doubling."""
    rank, width = symbols.astype(np.int64) + 1, 1
    while True:
        behind = np.zeros_like(rank)
        behind[:-width] = rank[width:]
        key = rank * (int(rank.max()) + 1) + behind
        order = np.argsort(key, kind="stable")
        width *= 2
        if width >= depth:
            return order
        sorted_key = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) + 1


def edges(symbols: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Piece ids by (position, length - 1), -1 where no piece lies."""
    depth = vocabulary.depth
    order = suffix_array(symbols, depth)
    padded = np.concatenate([symbols, np.zeros(depth, dtype=symbols.dtype)])
    keys = as_keys(np.lib.stride_tricks.sliding_window_view(padded, depth)[order])
    first = np.searchsorted(keys, vocabulary.low, side="left")
    last = np.searchsorted(keys, vocabulary.high, side="right")
    n = last - first
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    table = np.full(len(symbols) * depth, -1, dtype=np.int32)
    table[order[at] * depth + np.repeat(vocabulary.lengths - 1, n)] = np.repeat(vocabulary.ids, n)
    return table


def join_all(starts: np.ndarray, ends: np.ndarray, table: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(position, length) of the symbols left in all segments; one join per segment and round."""
    n = ends - starts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    length, owner = np.ones(len(at), dtype=np.int64), np.repeat(np.arange(len(n)), n)
    done_at, done_length = [], []
    while len(at):
        best = np.full(len(at), NONE)
        size = length[:-1] + length[1:]
        pair = np.flatnonzero((owner[:-1] == owner[1:]) & (size <= v.depth))
        found = table[at[pair] * v.depth + size[pair] - 1]
        pair, found = pair[found >= 0], found[found >= 0]
        best[pair] = v.ranks[found] * len(at) + pair
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        least = np.minimum.reduceat(best, heads)
        active = least < NONE
        join = least[active] % len(at)
        spans = np.diff(np.append(heads, len(at)))
        stays = np.repeat(active, spans)
        done_at.append(at[~stays])
        done_length.append(length[~stays])
        length[join] += length[join + 1]
        stays[join + 1] = False
        at, length, owner = at[stays], length[stays], owner[stays]
    if not done_at:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at, length = np.concatenate(done_at), np.concatenate(done_length)
    order = np.argsort(at, kind="stable")
    return at[order], length[order]


def join_long(start: int, end: int, table: np.ndarray, v: Vocabulary) -> tuple[list[int], list[int]]:
    """As ``join_all`` for one segment, with a heap of pairs."""
    size, after, before = {}, {}, {}
    for i in range(start, end):
        size[i], after[i], before[i] = 1, i + 1, i - 1
    heap: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < end and (n := size[left] + size[right]) <= v.depth:
            piece = table[left * v.depth + n - 1]
            if piece >= 0:
                heapq.heappush(heap, (int(v.ranks[piece]), left, n))

    for i in range(start, end - 1):
        offer(i)
    while heap:
        _, left, n = heapq.heappop(heap)
        if left not in size or after[left] >= end or size[left] + size[after[left]] != n:
            continue
        right = after[left]
        size[left], after[left] = n, after[right]
        del size[right]
        if after[left] < end:
            before[after[left]] = left
        offer(left)
        if before[left] >= start:
            offer(before[left])
    places = sorted(size)
    return places, [size[i] for i in places]


def encode_segments(segments: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All ids of different segments, one after another, and how many each has."""
    n = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
    offsets = np.cumsum(n + 1) - (n + 1)
    text = np.frombuffer("\0".join([*segments, ""]).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    symbols = v.symbols[text]
    symbols[offsets + n] = 0
    table = edges(symbols, v)
    short = n <= LONG
    at, length = join_all(offsets[short], (offsets + n)[short], table, v)
    for k in np.flatnonzero(~short):
        more = join_long(int(offsets[k]), int(offsets[k] + n[k]), table, v)
        at, length = np.concatenate([at, more[0]]), np.concatenate([length, more[1]])
    order = np.argsort(at, kind="stable")
    at, length = at[order], length[order]
    ids = table[at * v.depth + length - 1].astype(np.int32)
    # A single character without a piece becomes its bytes.
    counts = np.ones(len(ids), dtype=np.int64)
    bare = np.flatnonzero(ids < 0)
    spelled = [v.byte_ids[list(chr(c).encode())] for c in text[at[bare]].tolist()]
    counts[bare] = [len(s) for s in spelled]
    pool = np.repeat(ids, counts)
    if len(bare):
        pool[np.repeat(np.isin(np.arange(len(ids)), bare), counts)] = np.concatenate(spelled)
    owner = np.searchsorted(offsets, at, side="right") - 1
    return pool, np.bincount(owner, weights=counts, minlength=len(n)).astype(np.int64)


def segments_of(text: str, v: Vocabulary) -> Iterator[list[str]]:
    """The segments of a text, a stretch at a time; a segment at the end of a stretch goes on in the next."""
    at, width = 0, STRETCH
    while at < len(text):
        found = v.segment.findall(text, at, at + width)
        if at + width < len(text):
            if len(found) == 1:
                width *= 2
                continue
            at -= len(found.pop())
        at, width = at + width, STRETCH
        yield found


def laid_out(pool: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of ``pool``, one behind another."""
    return pool[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def encode_batch(texts: list[str | None], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, one after another, and how many each text has."""
    done, counts = [np.empty(0, dtype=np.int32)], np.zeros(len(texts), dtype=np.int64)
    held: list[str] = []
    owners: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        numbers = v.numbered(held)
        n = v.sizes[numbers]
        done.append(laid_out(v.pool, (np.cumsum(v.sizes) - v.sizes)[numbers], n))
        np.add.at(counts, np.repeat(owners, sizes), n)
        for x in (held, owners, sizes):
            x.clear()

    for i, text in enumerate(texts):
        if text:
            for found in segments_of((MARK + text).replace(" ", MARK), v):
                held += found
                owners.append(i)
                sizes.append(len(found))
                if len(held) >= FLUSH:
                    flush()
    if held:
        flush()
    return np.concatenate(done), counts


def decode_batch(ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> list[str]:
    """The texts that ``counts`` ids each stand for; bytes of all ids by one lookup."""
    data = laid_out(v.raw_bytes, v.raw_at[ids], v.raw_sizes[ids]).tobytes()
    ends = np.concatenate([[0], np.cumsum(v.raw_sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    texts = [data[i:j].decode("utf-8", "replace") for i, j in zip(ends[:-1], ends[1:], strict=True)]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def _per_text(docs: DataFrame, model: str, text: str, added: list[StructField], make) -> DataFrame:
    """``docs`` without ``text``, with the columns that ``make(texts, vocabulary)`` gives for a batch of texts."""
    held = clear_of(docs, *(f.name for f in added if f.name != text))
    fields = [f for f in held.schema.fields if f.name != text]
    names = [f.name for f in fields]
    schema = StructType([*fields, *added])

    def run(found: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        v = vocabulary_of(model)
        for whole in found:
            places = ((i, t) for i, (t,) in enumerate(rows_of(whole.select([text]))))
            for group in batches(places):
                part = whole.slice(group[0][0], len(group))
                new = make([t for _, t in group], v)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *new], names=schema.names)

    return held.select(*names, text).mapInArrow(run, schema)


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the ids of each text."""

    def make(texts: list[str | None], v: Vocabulary) -> list[pa.Array]:
        ids, counts = encode_batch(texts, v)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]

    return _per_text(docs, model, text, [StructField("ids", ArrayType(IntegerType()))], make)


def digests(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the number and checksum of its ids and the checksum of the text they stand for.

    ids_crc32 covers the ids as little-endian 32-bit integers, text_crc32 the decoded text in UTF-8.
    """

    def make(texts: list[str | None], v: Vocabulary) -> list[pa.Array]:
        ids, counts = encode_batch(texts, v)
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.concatenate([[0], np.cumsum(counts)])).tolist()
        return [
            pa.array(counts),
            pa.array([zlib.crc32(raw[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.int64()),
            pa.array([zlib.crc32(t.encode()) for t in decode_batch(ids, counts, v)], pa.int64()),
        ]

    added = [StructField(n, LongType()) for n in ("n_tokens", "ids_crc32", "text_crc32")]
    return _per_text(docs, model, text, added, make)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` without ``ids``, with the text they stand for."""
    held = clear_of(encoded, "text")
    fields = [f for f in held.schema.fields if f.name != "ids"]
    names = [f.name for f in fields]
    schema = StructType([*fields, StructField("text", StringType())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        v = vocabulary_of(model)
        for whole in found:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                lists = part.column("ids")
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = decode_batch(ids, counts, v)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(texts, pa.string())], names=schema.names
                )

    return held.select(*names, "ids").mapInArrow(run, schema)
