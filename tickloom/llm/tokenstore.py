"""Token ids in binary shards with a minimal perfect hash index per shard.

Documents are ranged by id, tokenised where they then lie, and each range
partition becomes one shard file: a header, the keys, the ends of the documents
in the payload, the index, and the raw ids (two bytes each if the vocabulary
allows, else four). The index maps a key in constant time to a slot that holds a
fingerprint, the first document of that key and how many there are. A key that
is not in the shard almost always meets another fingerprint; the stored key then
settles it.

Defined cases: a null or empty text holds the end id only. Null keys come first,
have no slot and are read in order. Documents of one key lie side by side, in the
order of their text's hash; a lookup of that key returns all of them. An empty table gives a
store without shards. Columns besides key and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.cells import read_cells, write_cells
from tickloom.llm.common import U64, arrow_map, batches, materialise, mixed

MAGIC = b"TOKS"
HEADER = struct.Struct("<4sBQQQQ")  # magic, bytes of an id, documents, null keys, ids, bytes of the index
END_ID = 1
#: Bytes of text that go to one shard, about.
SHARD_TEXT = 24 << 20
#: Words whose ids a Python worker remembers.
HELD = 600_000
GAMMA = 2
RANK_STEP = 512


class Encoder:
    """Ids of whole texts, by way of their words.

    The tokenizer splits at white space before anything else crosses it, so the
    ids of a text are those of its blank-separated words, one after another. Words
    of a batch are told apart by 64-bit hashes in array operations, and each new
    word is encoded once and remembered. Lower-casing (in texts of Latin-1 letters)
    and the split before a closing stop or comma are done ahead, as the tokenizer
    would do them itself, so that fewer different words remain.
    """

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(names.values()) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.closes = np.zeros(max(names.values()) + 1, dtype=bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.closes[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def lowered(text: str | None) -> bytes:
        if not text:
            return b""
        raw = text.encode()
        if "<|" in text:  # may spell a special token, which is told apart by case
            return raw
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return raw
        return text.lower().encode()

    def learn(self, new: list[bytes]) -> None:
        """Encode words not seen yet: runs of letters in one call, the rest one by one."""
        words = [(w, w.decode()) for w in new]
        plain = [(w, t) for w, t in words if t.isalpha()]
        if plain:
            whole = " ".join([t for _, t in plain])
            found = self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)
            ids = np.array(found[0].ids, dtype=self.kind)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(plain):  # every run of letters ends in a token that closes a word
                packed, at = ids.tobytes(), 0
                for (w, _), end in zip(plain, (ends * self.width).tolist(), strict=True):
                    self.known[w] = packed[at:end]
                    at = end
            else:
                plain = []
        held = {w for w, _ in plain}
        rest = [(w, t) for w, t in words if w not in held]
        if rest:
            found = self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)
            for (w, _), one in zip(rest, found, strict=True):
                self.known[w] = np.array(one.ids, dtype=self.kind).tobytes()

    def encode(self, texts: list[str | None]) -> tuple[bytes, np.ndarray]:
        """Packed ids of the texts, each with the end id, and how many each text has."""
        raws = [self.lowered(t) for t in texts]
        blob = b"\n".join([*raws, b""])
        data = np.frombuffer(blob, dtype=np.uint8)
        starts, ends = word_spans(data)
        words = [blob[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        number: dict[bytes, int] = {}
        which = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
        if len(self.known) > HELD:
            self.known.clear()
        self.learn([w for w in number if w not in self.known])
        found = [self.known[w] for w in number]
        # Lay each word's ids, and an end id behind each text, at their places.
        pool = np.frombuffer(b"".join(found), dtype=self.kind)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.width
        pool_at = np.cumsum(sizes) - sizes
        text_ends = np.cumsum([len(r) + 1 for r in raws])
        text_of = np.searchsorted(text_ends, starts, side="right")
        n = sizes[which]
        upto = np.cumsum(n)
        out = np.full((int(upto[-1]) if len(n) else 0) + len(texts), END_ID, dtype=self.kind)
        place = upto - n + text_of
        inner = np.arange(int(upto[-1]) if len(n) else 0) - np.repeat(upto - n, n)
        out[np.repeat(place, n) + inner] = pool[np.repeat(pool_at[which], n) + inner]
        return out.tobytes(), np.bincount(text_of, weights=n, minlength=len(texts)).astype(np.int64) + 1


BLANKS = np.zeros(256, dtype=bool)
BLANKS[[32, 9, 10, 11, 12, 13]] = True
SMALL = np.zeros(256, dtype=bool)
SMALL[97:123] = True
def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of blank-separated words; a stop or comma between a small letter and a blank stands alone.

    ``data`` ends with a blank.
    """
    blank = BLANKS[data]
    before = np.concatenate([[True], blank[:-1]])
    after = np.concatenate([blank[1:], [True]])
    closing = ((data == 46) | (data == 44)) & after
    closing[0] = False
    letter = SMALL[data]
    accented = (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
    accented[1:] &= data[:-1] == 0xC3
    accented[0] = False
    closing[1:] &= (letter | accented)[:-1]
    starts = np.flatnonzero(~blank & (before | closing))
    ends = np.flatnonzero(~blank & (after | np.concatenate([closing[1:], [False]]))) + 1
    return starts, ends


@lru_cache(maxsize=1)
def encoder_of(vocabulary: str) -> Encoder:
    """The Python worker's encoder: a reused worker keeps its words from task to task."""
    return Encoder(vocabulary)


class KeyIndex:
    """Minimal perfect hash of distinct keys: bit levels, ranks, and a slot per key."""

    SLOT = np.dtype([("print", "<u4"), ("first", "<u8"), ("count", "<u4")])

    def __init__(self, levels: list[np.ndarray], slots: np.ndarray):
        self.levels, self.slots = levels, slots
        self.sizes = [len(x) * 8 for x in levels]
        ones = [np.unpackbits(x, bitorder="little").astype(np.int64) for x in levels]
        self.bits = ones
        self.ranks, at = [], 0
        for level in ones:
            sums = np.concatenate([[0], np.cumsum(level)])
            self.ranks.append(at + sums[::RANK_STEP])
            at += int(sums[-1])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys.astype(U64) + U64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))) % U64(size)).astype(np.int64)

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(U64) ^ U64(0xA5A5A5A5A5A5A5A5)) >> U64(32)).astype(np.uint32)

    @classmethod
    def build(cls, keys: np.ndarray, first: np.ndarray, count: np.ndarray) -> KeyIndex:
        levels, left = [], keys
        while len(left):
            size = (max(64, GAMMA * len(left)) + 7) // 8 * 8
            at = cls.place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone.astype(np.uint8), bitorder="little"))
            left = left[~alone[at]]
        index = cls(levels, np.zeros(len(keys), dtype=cls.SLOT))
        slots = index.slot(keys)
        index.slots["print"][slots] = cls.fingerprint(keys)
        index.slots["first"][slots] = first
        index.slots["count"][slots] = count
        return index

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that no level holds."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for n, (bits, ranks, size) in enumerate(zip(self.bits, self.ranks, self.sizes, strict=True)):
            at = self.place(keys[open_], n, size)
            hit = bits[at] == 1
            for i, p in zip(open_[hit], at[hit], strict=True):
                block = p // RANK_STEP
                out[i] = ranks[block] + bits[block * RANK_STEP : p].sum()
            open_ = open_[~hit]
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, count) per key; count 0 where the fingerprint says the key is absent."""
        slots = self.slot(keys)
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        got = self.slots[np.maximum(slots, 0)]
        here = (slots >= 0) & (got["print"] == self.fingerprint(keys))
        return got["first"].astype(np.int64), np.where(here, got["count"], 0).astype(np.int64)

    def pack(self) -> bytes:
        head = struct.pack(f"<I{len(self.levels)}Q", len(self.levels), *map(len, self.levels))
        return head + b"".join(x.tobytes() for x in self.levels) + self.slots.tobytes()

    @classmethod
    def unpack(cls, data: memoryview) -> KeyIndex:
        (n,) = struct.unpack_from("<I", data)
        sizes, at, levels = struct.unpack_from(f"<{n}Q", data, 4), 4 + 8 * n, []
        for size in sizes:
            levels.append(np.frombuffer(data[at : at + size], dtype=np.uint8))
            at += size
        return cls(levels, np.frombuffer(data[at:], dtype=cls.SLOT))


def pack_shard(keys: list[int | None], payloads: list[bytes], sizes: np.ndarray, width: int) -> bytes:
    """A shard of documents in key order, null keys first; ``sizes`` counts each document's ids."""
    nulls = sum(k is None for k in keys)
    held = np.array([k or 0 for k in keys], dtype="<i8")
    distinct, first, count = np.unique(held[nulls:], return_index=True, return_counts=True)
    index = KeyIndex.build(distinct, first + nulls, count).pack()
    ends = np.cumsum(sizes).astype("<u8")
    head = HEADER.pack(MAGIC, width, len(keys), nulls, int(ends[-1]) if len(keys) else 0, len(index))
    return b"".join([head, held.tobytes(), ends.tobytes(), index, *payloads])


class Shard:
    """A shard's bytes, opened: keyed access to raw ids."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.width, self.n, self.nulls, self.ids, index = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEADER.size
        self.keys = np.frombuffer(view[at : at + 8 * self.n], dtype="<i8")
        at += 8 * self.n
        self.ends = np.frombuffer(view[at : at + 8 * self.n], dtype="<u8")
        at += 8 * self.n
        self.index = KeyIndex.unpack(view[at : at + index])
        at += index
        self.payload = view[at : at + self.ids * self.width]

    def document(self, ordinal: int) -> np.ndarray:
        begin = int(self.ends[ordinal - 1]) if ordinal else 0
        raw = self.payload[begin * self.width : int(self.ends[ordinal]) * self.width]
        return np.frombuffer(raw, dtype=f"<u{self.width}")

    def start(self, ordinal: int) -> int:
        return int(self.ends[ordinal - 1]) if ordinal else 0

    def ordinals(self, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """(key, document) of each document under the given distinct keys, by the index."""
        first, count = self.index.find(keys)
        for key, at, n in zip(keys.tolist(), first.tolist(), count.tolist(), strict=True):
            if n and self.keys[at] == key:
                yield from ((key, at + i) for i in range(n))


def write_store(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text") -> None:
    """Tokenise ``docs`` and write the shards below ``path``."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, -(-size // SHARD_TEXT)), F.col("key").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"))

    def shards(found: Iterator[tuple]) -> Iterable[tuple]:
        encoder, keys, payloads, sizes = encoder_of(vocabulary), [], [], []
        for group in batches(found):
            payload, n = encoder.encode([t for _, t in group])
            keys += [k for k, _ in group]
            payloads.append(payload)
            sizes.append(n)
        if keys:
            yield (pack_shard(keys, payloads, np.concatenate(sizes), encoder.width),)

    write_cells(arrow_map(ordered, shards, "value binary"), path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store: key, start (ids of all before it), n_tokens, ids_crc32.

    Documents are fetched by key through each shard's index; the shards' totals
    give the offsets.
    """

    def documents(found: Iterator[tuple]) -> Iterable[tuple]:
        for file, content in found:
            shard = Shard(content)
            keys = np.unique(shard.keys[shard.nulls :])
            places = [(None, i) for i in range(shard.nulls)] + list(shard.ordinals(keys))
            least = places[0][0] if places else None
            for key, at in places:
                ids = shard.document(at)
                yield (
                    file, least, shard.ids, key, shard.start(at), len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                    at == 0,
                )

    fields = "file string, least long, ids long, key long, local long, n_tokens long, ids_crc32 long, leads boolean"
    read = materialise(arrow_map(read_cells(spark, path), documents, fields), "token-documents")
    before = Window.orderBy(F.col("least").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = read.where("leads").select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    return read.join(offsets, "file").select(
        "key", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """key, ids of the documents under a given list of keys, by each shard's index."""
    wanted = np.unique(np.array(keys, dtype=np.int64))

    def documents(found: Iterator[tuple]) -> Iterable[tuple]:
        for _, content in found:
            shard = Shard(content)
            for key, at in shard.ordinals(wanted):
                yield key, shard.document(at).tolist()

    return arrow_map(read_cells(spark, path), documents, "key long, ids array<long>")
