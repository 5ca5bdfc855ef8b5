"""Alignment of two tokenizers against plain Python over the libraries."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import aligned, queries
from tickloom.llm.paths import vocabulary, word_pattern

SF = "/root/testdata/sf0.001"
FILES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), word_pattern()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    letters = aligned.byte_letters()
    a_raw = {i: bytes(letters[c] for c in a.id_to_token(i)) for i in range(50_256)}
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    b_raw = {
        i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    }
    return a, a_raw, b, b_raw


def spans(ids, raw):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(raw[i]), i))
        at += len(raw[i])
    return out


def plain(text, libraries):
    """ids of both kinds, groups as text, links as id pairs."""
    a, a_raw, b, b_raw = libraries
    if not text:
        return [], [], "", []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if any(b"".join(raw[i] for i in ids) != whole for ids, raw in ((ids_a, a_raw), (ids_b, b_raw))):
        return [], [], "", []
    one, two = spans(ids_a, a_raw), spans(ids_b, b_raw)
    ends = sorted({e for _, e, _ in one} & {e for _, e, _ in two})
    groups, i, j = [], 0, 0
    for end in ends:
        left, right = [], []
        while i < len(one) and one[i][1] <= end:
            left.append(str(one[i][2]))
            i += 1
        while j < len(two) and two[j][1] <= end:
            right.append(str(two[j][2]))
            j += 1
        groups.append(",".join(left) + "|" + ",".join(right))
    links, low = [], 0
    for start, end, x in two:
        while one[low][1] <= start:
            low += 1
        k = low
        while k < len(one) and one[k][0] < end:
            links.append((one[k][2], x))
            k += 1
    return ids_a, ids_b, ";".join(groups), links


def expected(texts, libraries):
    done = [plain(t, libraries) for t in texts]
    counts = Counter(p for *_, links in done for p in links)
    most = {}
    for (_, x), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (
            len(a), len(b), groups.count(";") + bool(groups), len(links),
            sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for a, b, groups, links in done
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_registered_query_equals_plain_python(spark, libraries):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], expected([r.text for r in rows], libraries), strict=True))
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in queries.op13_token_alignment(spark, SF).collect()}
    assert got == want and any(n for n, *_ in want.values())


ODD = [
    "<|endoftext|> in a text, </s> and <0x41> too", "holds ▁ itself", "  blanks  at both ends \n\n", "日本語 and 😀 é ﬁ",
    "x" * 5000, "\x00 \x01", " ", "word", "tab\tand\r\nlines", "á ‍", "antidisestablishmentarianism " * 50,
    " " * 3000 + "far", "the cat " * 15_000,
]


def test_odd_texts(spark, odd, none, libraries):
    texts = [(r.doc_id, r.text) for r in odd.collect()] + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    more = docs.withColumns({"N_A": F.lit("x"), "block": F.lit(0), "groups": F.lit(1)})
    got = sorted(
        ((r.doc_id, *(r[c] for c in NAMES)) for r in aligned.summary(more, *FILES).collect()), key=repr
    )
    want = expected([t for _, t in texts], libraries)
    assert got == sorted(((i, *w) for (i, _), w in zip(texts, want, strict=True)), key=repr)
    assert any(len(t) > aligned.LONG for t in ODD)
    assert aligned.summary(none, *FILES).count() == 0


def test_groups_as_rows(spark, libraries):
    docs = spark.createDataFrame([(1, "unbelievable tokenizations", "k"), (2, None, "k")], "doc_id long, text string, groups string")
    got = {r.doc_id: r.groups for r in aligned.align(docs, *FILES).collect()}
    spelled = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in got[1])
    assert spelled == plain("unbelievable tokenizations", libraries)[2] and got[2] == []


def test_counts_add_up_over_blocks(spark, libraries, monkeypatch):
    monkeypatch.setattr(aligned, "BLOCK_CHARS", 40)
    texts = [f"shared words and number {i % 7}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert aligned.blocks(docs, *FILES).count() > 20
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in aligned.summary(docs, *FILES).collect()}
    assert got == dict(enumerate(expected(texts, libraries)))
