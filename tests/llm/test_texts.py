"""Quality rules, main text, tokens, pieces and toxicity against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import html, pieces, quality, queries, tokenstore, toxicity
from tickloom.llm.common import scratch_path
from tickloom.llm.paths import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_plain_python(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    for r in quality.judge(docs.withColumn("N_WORDS", F.lit(1)).withColumn("kept", F.lit("x"))).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_a_filter_on_the_verdict_stays_above_the_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = quality.judge(docs)
    assert judged.where("kept").count() == sum(r.kept for r in judged.collect()) > 0


def test_quality_of_nothing(none):
    assert quality.judge(none).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<script>if (a < b) x = '<p>no</p>';</script>", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<body><nav><a href=x>Menu</a></nav><article><h1>T</h1><p>a <b>b</b>old<p>two<br>x</article><footer>f</footer>", "T a bold two x"),
        ("<article><p>One</p><div class='ad'>buy</div><div id=comments><p>me too</p></div></article>", "One"),
        ("<div class='cookie-notice'>ok?</div><p>" + "words and more " * 20 + "</p><ul><li><a href=x>l</a></ul>", ("words and more " * 20).strip()),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_main_text_of_whole_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit("old")).withColumn("n_chars", F.lit("old"))
    rows = html.extract(pages).collect()
    raw = {r.page_id: r.html for r in pages.collect()}
    assert len(rows) == len(raw)
    for r in rows:
        inner = re.search("<article>(.*)</article>", raw[r.page_id], re.S)[1]
        import html as entities

        plain = entities.unescape(re.sub("</?(p|br|h1)>", " ", re.sub("<!--.*?-->|</?b>", "", inner)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


LONG = ["All of this is text of the page, " * n for n in (4, 6, 5, 7)]
BODY = "".join(f"<p>{x}</p>" for x in LONG)
CARD = "<article><h3>Read this next</h3><p>A short teaser.<a href=x>More</a></article>"
REFERENCES = "<ol>" + "".join(f"<li><a href=x>Author, title of the cited work, {n}</a></li>" for n in range(3)) + "</ol>"
MENU = "<ul><li><a href=x>Home</a></li><li><a href=x>All topics</a></li><li><a href=x>Us</a></li></ul>"
WHOLE = " ".join(" ".join(LONG).split())
CITED = " ".join(f"Author, title of the cited work, {n}" for n in range(3))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><div id=a>{MENU}</div><div><h1>Title</h1>{BODY}</div>{CARD}</body>", f"Title {WHOLE}"),
        (f"<body>{CARD}<div><h1>Title</h1>{BODY}</div></body>", f"Title {WHOLE}"),
        (f"<body><main><h1>Title</h1><div>{BODY}</div>{CARD}</main></body>", f"Title {WHOLE}"),
        (f"<body>{MENU}<div><h1>Title</h1>{BODY}<h2>Cited</h2>{REFERENCES}</div>{MENU}</body>", f"Title {WHOLE} Cited {CITED}"),
        (f"<body>{MENU}<h1>Title</h1>{BODY}{REFERENCES}{BODY}<p>End.</p>{MENU}</body>", f"Title {WHOLE} {CITED} {WHOLE} End."),
        (f"<body>{MENU}<article><h1>Title</h1>{BODY}{REFERENCES}</article>{CARD}</body>", f"Title {WHOLE} {CITED}"),
        (f"<body><article>{BODY}</article><article>{BODY}</article>{MENU}</body>", f"{WHOLE} {WHOLE}"),
    ],
)
def test_main_text_is_chosen_by_ratios_and_marks_only_bound_it(page, text):
    assert html.main_text(page) == text


SIDE = "<div class='right-sidebar'><p>Beside the text.</p></div>"
THREAD = "<ol class=comment-list>" + f"<li><article class=comment-body><p>{LONG[0]}</p></article></li>" * 9 + "</ol>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='content has-sidebar'><article>{BODY}</article>{SIDE}</div>", WHOLE),
        (f"<div id=with-sidebar><article>{BODY}</article></div>{SIDE}", WHOLE),
        (f"<article><header class=entry-header><h1>T</h1></header>{BODY}</article>{SIDE}", f"T {WHOLE}"),
        (f"<article><div class=header><h1 class=banner>T</h1></div>{BODY}</article>{SIDE}", f"T {WHOLE}"),
        (f"<article>{BODY}<section class=legal-notice><p>The law.</p></section></article>", f"{WHOLE} The law."),
        (f"<article>{BODY}<div class=share-price-table><p>Up by one.</p></div></article>", f"{WHOLE} Up by one."),
        (f"<div class=sidebar><h1>T</h1>{BODY}</div>{SIDE}", f"T {WHOLE}"),
        (f"<article><h1>T</h1><div class=widget>{BODY}</div>{SIDE}</article>", f"T {WHOLE}"),
        (f"<div id=overlay><article>{BODY}<div class=ads>Buy</div></article></div>", WHOLE),
        # What names still keep out.
        (f"<article><p>Text of it.</p></article><div class=sidebar>{BODY}</div>", "Text of it."),
        (f"<article><p>Text of it.</p></article>{THREAD}", "Text of it."),
        (f"<div class='site-header'>S</div>{SIDE}<div class='Main_Nav'>M</div><p>{LONG[3]}</p><p>x <b class=ad-300x250>buy</b> y</p>", f"{LONG[3].strip()} x y"),
        (f"<article>{BODY}<div class='entry-share social-links'>Tell</div><p class=post-comments>9</p></article>", WHOLE),
        *(
            (f"<article>{BODY}<div class={name}><p>me too</p></div></article>", WHOLE)
            for name in (
                "user-comments", "reader-comments", "fb-comments", "commentSection", "inline-ad", "adBanner",
                "gdpr-notice", "site-notice", "notice", "sponsoredBox", "ad-2",
            )
        ),
        # Names that only hold such a word, or say what an element has or lacks.
        *(
            (f"<article>{BODY}<div class={name}><p>It stays.</p></div></article>", f"{WHOLE} It stays.")
            for name in ("ad-free-reading", "no-comments", "has-ads", "comment-free-zone", "notice-period-table", "public-notice", "market-share")
        ),
        (f"<div class=notice><h1>T</h1>{BODY}</div>{SIDE}", f"T {WHOLE}"),
    ],
)
def test_main_text_and_names_of_boilerplate(page, text):
    assert html.main_text(page) == text


def test_main_text_of_pages_without_a_mark(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        assert html.main_text(re.sub("</?article>", "", r.html)) == html.main_text(r.html)


def test_token_store_round_trip(spark, odd):
    from tokenizers import Tokenizer

    docs = odd.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 100, "text"))
    path = scratch_path(spark, "tokens")
    tokenstore.write_store(docs, path, vocabulary("word_bpe_49k.json"))
    got = sorted((r.start, r.key, r.n_tokens, r.ids_crc32) for r in tokenstore.read_store(spark, path).collect())
    tokenizer, start = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), 0
    wanted = {}
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        wanted.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [k for _, k, *_ in got] == sorted((k for k in wanted for _ in wanted[k]), key=lambda k: -1 if k is None else k)
    for at, key, n, crc in got:
        assert at == start and (n, crc) in wanted[key]
        start += n
    found = tokenstore.lookup(spark, path, [6, 8, 12345]).collect()
    assert sorted(r.key for r in found) == [6, 6, 8]


def test_token_store_of_nothing(spark, none):
    path = scratch_path(spark, "tokens")
    tokenstore.write_store(none, path, vocabulary("word_bpe_49k.json"))
    assert tokenstore.read_store(spark, path).count() == 0


def test_key_index_is_minimal_and_knows_absent_keys():
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5_000))
    index = tokenstore.KeyIndex.build(keys, np.arange(len(keys)), np.ones(len(keys), dtype=int))
    again = tokenstore.KeyIndex.unpack(memoryview(index.pack()))
    assert sorted(again.slot(keys).tolist()) == list(range(len(keys)))
    assert (again.find(keys)[0] == np.arange(len(keys))).all()
    assert (again.find(keys + 1)[1] == 0).sum() > len(keys) - 5


def doubled(n):
    """Two different words of 2^n letters whose polynomial hashes are equal modulo 2^64 for every odd base."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


LONG_TEXTS = [
    *doubled(10), " ".join(doubled(11)), "x" * 70_000, "日本語" * 9_000, "é" * 30_000 + " and " + "\u2581" * 5, "  a   b ",
    "a\n\n\tb\r c", "\x00z", "word " * 30_000,
]


@pytest.mark.parametrize("stretch", [None, 7])
def test_pieces_equal_the_library(spark, odd, monkeypatch, stretch):
    from sentencepiece import SentencePieceProcessor

    if stretch:
        monkeypatch.setattr(pieces, "STRETCH", stretch)
        monkeypatch.setattr(pieces, "HELD", 50)
    model = vocabulary("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=model)
    v = pieces.Vocabulary(model)
    texts = LONG_TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    ids, counts = pieces.encode_batch(texts, v)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == sp.encode(texts)
    assert pieces.decode_batch(ids, counts, v) == [sp.decode(x).replace("\u2581", " ") for x in sp.encode(texts)]


def test_encoded_and_decoded_rows(spark, odd):
    from sentencepiece import SentencePieceProcessor

    model = vocabulary("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=model)
    more = spark.createDataFrame([(100 + i, t, "xx", "l") for i, t in enumerate(LONG_TEXTS)], odd.schema)
    docs = odd.union(more).union(spark.read.parquet(f"{SF}/documents.parquet").select(*odd.columns))
    docs = docs.withColumn("again", F.col("text")).withColumn("ids", F.lit("old"))
    encoded = pieces.encode(docs, model)
    rows = encoded.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == sp.encode(r.again or "")
    for r in pieces.decode(encoded, model).collect():
        assert r.text == sp.decode(sp.encode(r.again or "")).replace("\u2581", " ")
    assert pieces.encode(odd.where("false"), model).count() == 0


def test_registered_piece_digests_equal_the_library(spark):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op6_sentencepiece(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = sp.encode(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert got[doc_id].text_crc32 == zlib.crc32(sp.decode(ids).encode())


def test_words_of_equal_polynomial_hash_keep_their_ids(spark):
    from tokenizers import Tokenizer

    words = doubled(10)
    docs = spark.createDataFrame([(i, f"start {w} end") for i, w in enumerate(words)], "doc_id long, text string").coalesce(1)
    file = vocabulary("word_bpe_49k.json")
    path = scratch_path(spark, "equal-hashes")
    tokenstore.write_store(docs, path, file)
    library = Tokenizer.from_file(file)
    for r in tokenstore.read_store(spark, path).collect():
        ids = library.encode(f"start {words[r.key]} end", add_special_tokens=False).ids + [1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_toxicity_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    languages = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    toxic = Counter(languages[r.doc_id] for r in rows if r.toxic)
    found = Counter(languages[r.doc_id] for r in rows if r.toxic and r.predicted)
    assert found.total() >= 0.88 * toxic.total() and len(toxic) == 4
    assert all(found[lang] >= 0.75 * n for lang, n in toxic.items())
    clean = sum(not r.toxic for r in rows)
    assert sum(r.predicted > r.toxic for r in rows) <= 0.015 * clean


def test_toxic_rows_fill_half_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 40)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 20 == 0).cast("int").alias("toxic"))
    rows = toxicity.sample(docs, toxicity.labelled(labels)).collect()
    assert (len(rows), sum(r.toxic for r in rows)) == (40, 20)
    few = labels.where("toxic = 0 OR doc_id < 100")
    rows = toxicity.sample(docs, toxicity.labelled(few)).collect()
    assert len(rows) == 40 and 0 < sum(r.toxic for r in rows) <= 5


def test_toxicity_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score(odd, toxicity.fit(odd, labels)).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.0} and not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
