"""Document fingerprints by Order MinHash, in SQL functions only.

A text is cut into tokens, and every run of ``K`` tokens is a k-mer (the last
ones, cut short by the end of the text, too). Equal k-mers are numbered by
occurrence: a sort of hashes, each with its place in its low bits, lays equal
ones side by side, and the distance to the first of them is the number. The hash
of (k-mer, number) deals it to one of ``BINS`` bins. In every bin the two
smallest are selected, put back into the order of the text and hashed as a pair
(one hash permutation, cut into bins, stands for one permutation a component).
A component of the fingerprint is its bin and the low bits of that hash, so it
stays as long as both k-mers and their order do. The likeness of two
fingerprints is the share of the bins filled in either whose components agree.

Everything runs inside the row of a text in time n log n; a text may be of any
length. Only ``with_next`` moves texts, once.

Defined cases: null texts count as empty. Blanks only part tokens; a run without
blanks is cut into tokens of ``TOKEN`` characters, and ideographs and kana are
tokens of their own. A text without tokens has the empty fingerprint; two empty
ones are alike (1), an empty and another are not (0). Null ids come first in the
order of documents; columns named as results are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tickloom.llm.common import clear_of

#: Tokens in a k-mer.
K = 2
#: Characters in a token at most.
TOKEN = 16
#: Bins, a component each; a power of two.
BIN_BITS = 6
BINS = 1 << BIN_BITS
#: Low bits of a pair's hash that a component keeps.
KEPT_BITS = 18
#: A sorted key is the high bits of a hash above a place in the text.
PLACE_BITS = 31
#: Ranges per shuffle partition that the order of documents is cut into.
RANGES = 4

#: Ranges of kana and ideographs, which are written without blanks.
SINGLE = r"\\u3040-\\u30ff\\u3400-\\u9fff\\uf900-\\ufaff\\x{20000}-\\x{3ffff}"
TOKENS = rf"[^\\s{SINGLE}]{{1,{TOKEN}}}|[{SINGLE}]"
PLACE = (1 << PLACE_BITS) - 1


def packed(hashed: str, place: str) -> str:
    return f"((({hashed}) & ~{PLACE}L) | cast({place} AS BIGINT))"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` evaluated once under a name (a one-element array serves as the binding)."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def kmers(tokens: str) -> str:
    """Sorted keys of the k-mers that start at each token."""
    run = ", ".join(["_w"] + [f"get({tokens}, _i + {j})" for j in range(1, K)])
    return f"sort_array(transform({tokens}, (_w, _i) -> {packed(f'xxhash64({run})', '_i')}))"


def numbered(keys: str) -> str:
    """Sorted keys of the k-mers told apart by occurrence, from their sorted keys.

    The first of equal ones is found by halving the stretch before, where there is one at all.
    """
    high = f"shiftright(_x, {PLACE_BITS})"
    middle = "cast((_s.low + _s.high) DIV 2 AS INT)"
    below = f"shiftright(get({keys}, {middle}), {PLACE_BITS}) < {high}"
    first = (
        "aggregate(sequence(1, cast(ceil(log2(_j + 1)) AS INT) + 1), named_struct('low', 0, 'high', _j), "
        f"(_s, _t) -> if(_s.low >= _s.high, _s, if({below}, "
        f"named_struct('low', {middle} + 1, 'high', _s.high), named_struct('low', _s.low, 'high', {middle}))), "
        "_s -> _s.low)"
    )
    repeats = f"_j > 0 AND shiftright(get({keys}, _j - 1), {PLACE_BITS}) = {high}"
    number = f"if({repeats}, _j - {first}, 0)"
    hashed = f"xxhash64({high}, {number})"
    return f"sort_array(transform({keys}, (_x, _j) -> {packed(hashed, f'_x & {PLACE}L')}))"


def components(keys: str) -> str:
    """Components of the fingerprint, by bin, from sorted keys of numbered k-mers."""
    shift = 64 - BIN_BITS
    bin_of = f"shiftright({{}}, {shift})"
    new = f"(_j = 0 OR {bin_of.format(f'get({keys}, _j - 1)')} != {bin_of.format('_x')})"
    # The smallest of a bin and the one behind it, if it is in the bin as well.
    second = f"get({keys}, _j + 1)"
    paired = f"if({bin_of.format(second)} = {bin_of.format('_x')}, {second}, NULL)"
    chosen = (
        f"filter(transform({keys}, (_x, _j) -> if({new}, named_struct('a', _x, 'b', {paired}), NULL)), "
        "_p -> _p IS NOT NULL)"
    )
    value = f"shiftright({{}}, {PLACE_BITS})"
    a, b = value.format("_p.a"), value.format("_p.b")
    in_order = f"_p.b IS NULL OR (_p.a & {PLACE}L) < (_p.b & {PLACE}L)"
    pair = f"if({in_order}, xxhash64({a}, {b}), xxhash64({b}, {a}))"
    own = f"shiftleft({bin_of.format('_p.a')} + {BINS // 2}, {KEPT_BITS})"
    return (
        f"transform({chosen}, _p -> cast({own} | (({pair}) & {(1 << KEPT_BITS) - 1}L) AS INT))"
    )


def fingerprint(text: str) -> Column:
    """The components of a text's fingerprint, an array of ints by bin; ``text`` is a SQL expression."""
    tokens = f"regexp_extract_all(coalesce({text}, ''), '{TOKENS}', 0)"
    return F.expr(
        let("_tokens", tokens, let("_keys", kmers("_tokens"), let("_all", numbered("_keys"), components("_all"))))
    )


def as_text(components: Column) -> Column:
    """A fingerprint as a string: six hexadecimal digits a component."""
    return F.array_join(F.transform(components, lambda c: F.lpad(F.lower(F.hex(c)), 6, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Share of the bins filled in either fingerprint whose components agree."""

    def bins(c: Column) -> Column:
        return F.transform(c, lambda x: F.shiftright(x, KEPT_BITS))

    filled = F.size(F.array_union(bins(one), bins(other)))
    agree = F.size(F.array_intersect(one, other))
    return F.when(filled == 0, F.lit(1.0)).otherwise(agree / filled).cast("double")


def with_next(docs: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>`` of the document that follows in the order of ``by``.

    The first follows the last. ``by`` must tell rows apart and be the same each
    time ``docs`` is read (an id and the place in a file, say), nulls first. The
    order is cut into ranges by a sort of ``by`` alone, whose least keys (a few per
    shuffle partition) come to the driver; every row then goes to its range, the
    least row of a range to the range before it as well.
    """
    spark = docs.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"next_{c}" for c in columns]
    held = clear_of(docs, *names, "_key", "_at", "_to", "_range", "_extra")
    keyed = held.withColumn("_key", F.struct(*by))
    parts = keyed.select("_key").repartitionByRange(ranges, "_key").groupBy(F.spark_partition_id().alias("_part"))
    least = parts.agg(F.min("_key").alias("_key")).agg(F.to_json(F.sort_array(F.collect_list("_key")))).first()[0]
    kind = keyed.schema["_key"].dataType
    bounds = F.from_json(F.lit(least), ArrayType(kind))
    count = len(json.loads(least))
    # The number of bounds that are not above the key, less one, by halving.
    at = F.aggregate(
        F.sequence(F.lit(0), F.lit(count.bit_length())),
        F.expr(f"named_struct('low', 0, 'high', {count})"),
        lambda s, _: F.when(s.low >= s.high, s).otherwise(
            F.when(
                F.get(bounds, F.floor((s.low + s.high) / 2).cast("int")) <= F.col("_key"),
                F.struct((F.floor((s.low + s.high) / 2).cast("int") + 1).alias("low"), s.high.alias("high")),
            ).otherwise(F.struct(s.low.alias("low"), F.floor((s.low + s.high) / 2).cast("int").alias("high")))
        ),
        lambda s: s.low - 1,
    )
    own = F.struct(F.col("_at").alias("range"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("_at") - 1, F.lit(max(count, 1))).alias("range"), F.lit(True).alias("extra"))
    leads = F.get(bounds, F.col("_at")) == F.col("_key")
    window = Window.partitionBy("_range").orderBy("_extra", "_key")
    return (
        keyed.withColumn("_at", at)
        .withColumn("_to", F.explode(F.when(leads, F.array(own, before)).otherwise(F.array(own))))
        .withColumns({"_range": F.col("_to.range"), "_extra": F.col("_to.extra")})
        .withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
        .where(~F.col("_extra"))
        .drop("_key", "_at", "_to", "_range", "_extra")
    )


def edits(docs: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the fingerprints of each text, of its edited text and of the next.

    The edited text is the first half of the text (the longer one) and the start of the
    next document's, as long as the other half or all of it. Added: n_chars, edited,
    components, edited_components, next_components.
    """
    held = clear_of(docs, "n_chars", "edited", "components", "edited_components", "next_components", "_text")
    whole = held.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).drop(text)
    printed = whole.withColumn("components", fingerprint("_text"))
    followed = with_next(printed, by, ["_text", "components"])
    edited = F.expr(
        "concat(left(_text, cast(n_chars - n_chars DIV 2 AS INT)), left(next__text, cast(n_chars DIV 2 AS INT)))"
    )
    return (
        followed.withColumn("n_chars", F.char_length("_text"))
        .withColumn("edited", edited)
        .withColumn("edited_components", fingerprint("edited"))
        .withColumn("n_chars", F.col("n_chars").cast("long"))
        .drop("_text", "next__text")
    )
