import math

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.operators import embedding, evaluation, lookups, neighbours, summaries
from tickloom.plans import prompts, retrieval
from tickloom.session import scratch_path
from tickloom.sources import corpus, news, tables

LIST_DOC = (
    "---\ntype: reference\ntitle: Companies we follow\ntype: list\nsource: elsewhere\n---\n\n# Companies we follow\n\n"
    "A paragraph before the list that every item would otherwise repeat.\n\n"
    + "".join(
        f"- **C{i}** - company number {i}, which makes goods of kind {i} and sells\n  them in region {i} of the world.\n"
        for i in range(17)
    )
)
SECTION_DOC = "---\ntitle: Table notes\n---\n# Table notes\n\n" + "".join(
    f"## Part {i}\n\nThis part explains column group {i} at a length that is enough to be kept as a chunk of its own.\n\n"
    for i in range(4)
)
FEW_BULLETS_DOC = "# How we work\n\n" + "".join(
    f"## Rule {i}\n\n- The first point of rule {i}, long enough to matter to a reader.\n- The second point of rule {i}.\n\n"
    for i in range(3)
)


def raw(spark, **docs):
    data = [(name.replace("_", ".", 1) if "." not in name else name, text) for name, text in docs.items()]
    return spark.createDataFrame(data, corpus.RAW)


@pytest.fixture(scope="module")
def shaped(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    for name, text in (("list.md", LIST_DOC), ("notes.md", SECTION_DOC), ("rules.md", FEW_BULLETS_DOC)):
        (folder / name).write_text(text, encoding="utf-8")
    (folder / "ignored.txt").write_text("not markdown", encoding="utf-8")
    (folder / "sub").mkdir()
    (folder / "sub" / "deeper.md").write_text("not read", encoding="utf-8")
    return corpus.parse_documents(corpus.read_markdown_corpus(spark, str(folder)))


def test_corpus_of_files(shaped):
    got = {r["source"]: r for r in rows(shaped)}
    assert set(got) == {"list.md", "notes.md", "rules.md"}
    assert got["list.md"]["metadata"] == {"type": "list", "title": "Companies we follow", "source": "list.md"}
    assert got["rules.md"]["metadata"] == {"source": "rules.md"}


def test_missing_folder_is_empty(spark, tmp_path):
    assert corpus.read_markdown_corpus(spark, str(tmp_path / "nowhere")).count() == 0


def test_documents_written_one_file_each(spark, tmp_path):
    """Texts come back as they are; rows of one source share its file, and nothing lies beside it."""
    texts = [("a.md", "one\ntwo\r\n"), ("b=/c", ""), ("d", None), ("e", "ä" * 100_000), ("f", "x"), ("f", "x")]
    corpus.write_markdown_corpus(spark.createDataFrame(texts, corpus.RAW), str(tmp_path / "c"))
    found = {d.name: [f.read_text(newline="") for f in d.iterdir()] for d in (tmp_path / "c").iterdir()}
    assert found == {
        "source=a.md": ["one\ntwo\r\n\n"], "source=b%3D%2Fc": ["\n"], "source=d": ["\n"], "source=e": ["ä" * 100_000 + "\n"],
        "source=f": ["x\nx\n"],
    }


def test_chunk_counts_and_shape(shaped):
    chunks = rows(corpus.chunk_corpus(shaped))
    per_source = {}
    for c in chunks:
        per_source.setdefault(c["source"], []).append(c)
        assert len(c["text"]) >= 80
        assert c["metadata"]["source"] == c["source"]
        assert c["id"] == f"{c['source']}#{c['chunk_no']}" and c["metadata"]["chunk"] == str(c["chunk_no"])
    assert {k: len(v) for k, v in per_source.items()} == {"list.md": 17, "notes.md": 4, "rules.md": 3}
    assert all(sorted(c["chunk_no"] for c in v) == list(range(len(v))) for v in per_source.values())
    first = next(c for c in per_source["list.md"] if c["chunk_no"] == 0)
    assert first["text"].startswith("Companies we follow\n\n- **C0**") and "A paragraph" not in first["text"]
    assert next(c for c in per_source["notes.md"] if c["chunk_no"] == 1)["text"].startswith("Table notes - Part 1\n\n")


def test_chunking_off(shaped):
    assert corpus.chunk_corpus(shaped, chunking=False).count() == 3


def test_short_document_stays_whole(spark):
    got = rows(corpus.chunk_corpus(corpus.parse_documents(raw(spark, a_md="## Title\r\n\r\nshort"))))
    assert len(got) == 1 and got[0]["id"] == "a.md" and got[0]["chunk_no"] is None


def test_short_bullets_are_dropped_before_numbering(spark):
    long = "x" * 100
    text = f"## H\n- {long}1\n- short\n- {long}2\n- {long}3\n"
    got = rows(corpus.chunk_corpus(corpus.parse_documents(raw(spark, a_md=text))).orderBy("chunk_no"))
    assert [c["id"] for c in got] == ["a.md#0", "a.md#1", "a.md#2"]
    assert [c["text"][-1] for c in got] == ["1", "2", "3"]


LINES = st.lists(st.sampled_from(["## ", "## A", "### B c", "- one", "- ", "text", "", " - x", "##none", "  "]), max_size=12)


def expected_sections(body):
    """Sections by walking the lines: brute force for bodies whose headings sit on one line."""
    out, heading, lines = [], "", []
    for line in body.split("\n"):
        words = line.lstrip("#")
        if line.startswith("##") and words[:1].isspace() and words.strip():
            out.append((heading, "\n".join(lines).strip()))
            heading, lines = words.strip(), []
        else:
            lines.append(line)
    out.append((heading, "\n".join(lines).strip()))
    return [(h, t) for h, t in out if t]


def test_heading_after_a_no_break_space(spark):
    df = spark.createDataFrame([("intro\n##\u00a0Head\nbody",)], "body string")
    got = df.select(X.sections(F.col("body")).alias("s")).first()["s"]
    assert [(s["heading"], s["text"]) for s in got] == [("", "intro"), ("Head", "body")]


@settings(max_examples=5, deadline=None)
@given(st.lists(LINES, min_size=20, max_size=40))
def test_sections_against_brute_force(spark, bodies):
    texts = ["\n".join(x for x in b if x != "## ") for b in bodies]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    got = df.select("i", X.sections(F.col("body")).alias("s")).collect()
    for r in got:
        assert [(s["heading"], s["text"]) for s in r["s"]] == expected_sections(texts[r["i"]])


def brute(corpus_rows, query_rows, k):
    out = {}
    for qid, q in query_rows:
        ranked = sorted((float(((np.array(v) - np.array(q)) ** 2).sum()), i) for i, v in corpus_rows)
        out[qid] = [(i, round(d, 9)) for d, i in ranked[:k]]
    return out


@pytest.mark.parametrize("limits", [{}, {"query_bytes": 200, "corpus_bytes": 900}, {"pivots": 3}])
@pytest.mark.parametrize("as_text", [True, False])
def test_nearest_against_brute_force(spark, limits, as_text):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(300, 5)).round(1)
    vectors[100:200] = vectors[0]
    key = (lambda i: f"v{i}") if as_text else int
    kind = "string" if as_text else "long"
    data = [(key(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    asked = [(key(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(23, 5)).round(1))] + [
        (key(99), [float(x) for x in vectors[0]])
    ]
    left = spark.createDataFrame(data, f"id {kind}, embedding array<double>").repartition(7)
    right = spark.createDataFrame(asked, f"query_id {kind}, embedding array<double>")
    got = {}
    for r in neighbours.nearest(left, right, 6, **limits).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], round(r["distance"], 9)))
    assert got == brute(data, asked, 6)


def test_nearest_with_more_k_than_rows(spark):
    left = spark.createDataFrame([("a", [0.0, 1.0]), ("b", None)], "id string, embedding array<float>")
    right = spark.createDataFrame([("q", [0.0, 0.0])], "query_id string, embedding array<float>")
    got = rows(neighbours.nearest(left, right, 6))
    assert got == [{"query_id": "q", "rank": 1, "id": "a", "distance": 1.0}]


@pytest.fixture(scope="module")
def topical(spark):
    return raw(
        spark,
        kafka_md="Kafka moves events through topics. " + "Consumer lag shows how far a streaming consumer is behind. " * 4,
        baking_md="Bread needs flour and water. " + "Sourdough proving times depend on the oven and the room. " * 4,
    )


def test_build_and_retrieve(spark, topical):
    index = scratch_path(spark, "index")
    built = retrieval.build_index(topical, index)
    assert built["docs_indexed"] == 2 and built["embedding_dim"] == 768 and built["stale_removed"] == 0
    asked = spark.createDataFrame([("q", "Kafka consumer lag and streaming throughput")], "query_id string, text string")
    got = rows(retrieval.retrieve(spark, index, asked, 2).orderBy("rank"))
    assert [r["source"] for r in got] == ["kafka.md", "baking.md"] and got[0]["distance"] < got[1]["distance"]


def test_reindexing_removes_stale_entries(spark, topical):
    index = scratch_path(spark, "reindex")
    retrieval.build_index(topical, index)
    again = retrieval.build_index(topical.filter("source = 'kafka.md'"), index)
    assert again["stale_removed"] == 1 and again["collection_count"] == again["docs_indexed"] == 1
    switched = retrieval.build_index(topical.filter("source = 'kafka.md'"), index, chunking=False)
    assert switched["stale_removed"] == 1
    assert [r.id for r in retrieval.collection_ids(spark, index).collect()] == ["kafka.md"]


def test_empty_corpus_and_missing_index(spark, topical):
    index = scratch_path(spark, "empty")
    assert retrieval.build_index(topical.limit(0), index)["docs_indexed"] == 0
    asked = spark.createDataFrame([("q", "x")], "query_id string, text string")
    assert retrieval.retrieve(spark, index, asked).count() == 0


def test_evaluate(spark, topical):
    asked = spark.createDataFrame(
        [("1", "consumer lag in kafka", "kafka.md"), ("2", "proving sourdough bread", "baking.md"), ("3", "x", "none.md")],
        "id string, question string, expected string",
    )
    got = rows(retrieval.evaluate(topical, asked))[0]
    assert got["questions"] == 3 and got["hit_at_1"] == 2 and got["corpus_documents"] == 2
    assert got["precision_at_1"] == 0.6667 and got["mrr"] == 0.6667


def test_scores(spark):
    ranks = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 5), (4, "b", None)], "id int, expected string, rank int")
    got = rows(evaluation.retrieval_scores(ranks))[0]
    assert (got["hit_at_1"], got["hit_at_3"], got["precision_at_1"], got["hit_rate_at_3"]) == (1, 2, 0.25, 0.5)
    assert got["mrr"] == round((1 + 0.5 + 0.2) / 4, 4)
    assert {r["k"]: r["hit_rate"] for r in rows(evaluation.hit_at_k(ranks, [1, 5]))} == {1: 0.25, 5: 0.75}


def test_question_set_checks(spark):
    asked = spark.createDataFrame(
        [("1", "what does the table hold about daily closing prices", "a.md"), ("2", "short one", "b.md"), ("2", "x", "zz.md")],
        "id string, question string, expected string",
    )
    docs = spark.createDataFrame(
        [("a.md", "It says: The table HOLD about daily closing prices."), ("b.md", "short one"), ("c.md", "")],
        "source string, text string",
    )
    assert [r["id"] for r in rows(lookups.quoted_questions(asked, docs))] == ["1"]
    assert [r["expected"] for r in rows(evaluation.missing_labels(asked, docs))] == ["zz.md"]
    assert [r["source"] for r in rows(evaluation.unasked_documents(docs, asked))] == ["c.md"]
    assert rows(summaries.duplicate_ids(asked)) == [{"id": "2", "count": 2}]
    assert all(r["too_few"] for r in rows(summaries.label_balance(asked, 3)))


def test_prompts_for_every_ticker(spark, topical):
    index = scratch_path(spark, "prompts")
    retrieval.build_index(topical, index)
    curated = spark.createDataFrame(
        [(f"2026-01-0{d}", t, 10.0 * d, None) for t in ("AAA", "BB") for d in range(1, 8)],
        "Date string, Ticker string, Close double, daily_return double",
    )
    got = {r["Ticker"]: r for r in rows(prompts.briefing_inputs(spark, curated, index, bars=2, k=1))}
    assert set(got) == {"AAA", "BB"}
    prompt = got["AAA"]["prompt"]
    assert "2026-01-07" in prompt and "2026-01-05" not in prompt and len(got["AAA"]["sources"]) == 1
    assert f"[{got['AAA']['sources'][0]}]\n" in prompt
    with pytest.raises(ValueError):
        prompts.briefing_inputs(spark, curated, index, bars=61)
    bare = prompts.assemble_prompt(
        spark.createDataFrame([("A", "t", None, None)], "Ticker string, bars string, context string, sources array<string>")
    )
    assert prompts.NO_CONTEXT in rows(bare)[0]["prompt"] and rows(bare)[0]["sources"] == []


def test_bar_table_is_aligned(spark):
    df = spark.createDataFrame([("2026-01-01", "A", 9.5), ("2026-01-02", "A", 10.25)], "Date string, Ticker string, Close double")
    text = rows(prompts.bars_text(df, ["Date", "Close"]))[0]["bars"]
    assert text == "      Date Close\n2026-01-01   9.5\n2026-01-02 10.25"


def test_briefings_join_the_corpus(spark, topical):
    path = scratch_path(spark, "briefings")
    assert corpus.read_briefings(spark, path).count() == 0
    data = [("MSFT", "  The shares rose. ", ["kafka.md", "a.md"], "2026-01-02T03:04:05"), ("NVDA", "Flat.", [], "2026-01-02T03:04:05")]
    df = spark.createDataFrame(data, "ticker string, text string, sources array<string>, t string")
    corpus.append_briefings(df.withColumn("generated_at", F.col("t").cast("timestamp")), path)
    both = corpus.union_corpus(topical, corpus.read_briefings(spark, path))
    docs = {r["id"]: r for r in rows(corpus.parse_documents(both))}
    assert docs["MSFT_20260102T030405.md"]["text"] == "The shares rose."
    assert docs["MSFT_20260102T030405.md"]["metadata"]["sources"] == "kafka.md, a.md"
    assert docs["NVDA_20260102T030405.md"]["metadata"]["sources"] == "none"
    assert len(docs) == 4


def test_upsert(spark):
    index = scratch_path(spark, "upsert")
    schema = "id string, embedding array<double>"
    retrieval.upsert_vectors(spark, index, spark.createDataFrame([("a", [1.0]), ("b", [2.0])], schema))
    retrieval.upsert_vectors(spark, index, spark.createDataFrame([("b", [3.0]), ("c", [4.0])], schema))
    stored = retrieval.collection(spark, index)
    assert {r.id: r.embedding for r in stored.collect()} == {"a": [1.0], "b": [3.0], "c": [4.0]}


def test_currency_is_escaped(spark):
    text = "It held around the $510 level and the $500 mark."
    got = rows(spark.createDataFrame([(text,)], "t string").select(X.escape_dollar(F.col("t")).alias("t")))[0]["t"]
    assert got == "It held around the \\$510 level and the \\$500 mark."


def test_five_word_runs(spark):
    df = spark.createDataFrame([("One, two three-four FIVE six",), ("too few words",), (None,)], "t string")
    got = [r["g"] for r in rows(df.select(X.n_grams(F.col("t")).alias("g")))]
    assert got == [["one two three four five", "two three four five six"], [], []]


def test_news_shapes(spark):
    items = [
        ("A", 1, '{"content":{"title":"T","provider":{"displayName":"P"},"clickThroughUrl":{"url":"u"}}}'),
        ("A", 2, '{"title":"T2","provider":"P","canonicalUrl":"c"}'),
        ("A", 3, '{"clickThroughUrl":null,"canonicalUrl":"c"}'),
        ("A", 4, '{"title":"fourth"}'),
        ("B", 1, '{"content":{"clickThroughUrl":{},"provider":{}}}'),
    ]
    got = rows(news.flatten_news(spark.createDataFrame(items, "ticker string, position int, item string")))
    assert sorted((r["ticker"], r["position"], r["title"], r["publisher"], r["link"]) for r in got) == [
        ("A", 1, "T", "P", "u"),
        ("A", 2, "T2", "Unknown source", "c"),
        ("A", 3, "No title", "Unknown source", "#"),
        ("B", 1, "No title", "Unknown source", "#"),
    ]


def test_distance_expression(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<float>, b array<float>")
    from tickloom.functions.columns import l2_squared

    assert math.isclose(df.select(l2_squared(F.col("a"), F.col("b")).alias("d")).first()["d"], 25.0)


def test_nearest_passes_over_broken_vectors_and_keeps_ids(spark):
    nan, inf = float("nan"), float("inf")
    data = [("a", [1.0, 0.0]), ("c\0", [0.0, 1.0]), ("n", [nan, 0.0]), ("i", [inf, 0.0]), ("z", [None, 1.0]), (None, [1.0, 0.0]), ("w", None)]
    held = spark.createDataFrame(data, "id string, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 0.1]), (None, [0.0, 2.0]), (3, [nan, 1.0])], "query_id long, embedding array<double>")
    got = sorted((r.query_id or 0, r.rank, r.id) for r in neighbours.nearest(held, asked, 2).collect())
    assert got == [(0, 1, "c\0"), (0, 2, "a"), (1, 1, "a"), (1, 2, "c\0")]


def test_nearest_leaves_out_vectors_of_another_length(spark):
    data = [(1, [1.0, 2.0, 3.0]), (2, [4.0, 5.0, 6.0]), (3, [4.0, 5.0, 6.0, 7.0, 8.0]), (4, []), (5, [9.0, 9.0, 9.0])]
    held = spark.createDataFrame(data, "id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "query_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.id, r.distance) for r in neighbours.nearest(held, asked, 5).orderBy("rank").collect()]
    assert got == [(1, 1, 1, 0.0), (1, 2, 2, 27.0), (1, 3, 5, 149.0)]


def test_queries_visit_only_cells_that_can_hold_a_neighbour(spark, monkeypatch):
    """Far clusters: the second visit has nothing left to compare."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 6)) * 1000
    vectors = (centres[:, None, :] + rng.normal(size=(20, 40, 6))).reshape(-1, 6)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    held = spark.createDataFrame(data, "id long, embedding array<double>")
    asked = held.where("id % 7 = 0").withColumnRenamed("id", "query_id")
    tables, write = {}, neighbours.materialise
    monkeypatch.setattr(neighbours, "materialise", lambda df, name: tables.setdefault(name, write(df, name)))
    got = {}
    for r in neighbours.nearest(held, asked, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.distance, 9)))
    assert got == brute(data, [(i, v) for i, v in data if i % 7 == 0], 3)
    visited = tables["further"].selectExpr("avg(size(cells)) AS n").first().n
    assert visited < 0.25 * tables["cells"].select("cell").distinct().count()


def test_small_blocks_do_not_multiply_what_is_sent(spark, monkeypatch):
    """Vectors all as far from each other: no cell is passed over, yet a query goes to a bounded number of rooms."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(600, 16))
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors / np.linalg.norm(vectors, axis=1)[:, None])]
    held = spark.createDataFrame(data, "id long, embedding array<double>")
    asked = held.where("id % 5 = 0").withColumnRenamed("id", "query_id")
    tables, write = {}, neighbours.materialise
    monkeypatch.setattr(neighbours, "materialise", lambda df, name: tables.setdefault(name, write(df, name)))
    got = {}
    for r in neighbours.nearest(held, asked, 6, query_bytes=128, corpus_bytes=128).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.distance, 9)))
    assert got == brute(data, [(i, v) for i, v in data if i % 5 == 0], 6)
    assert tables["beyond"].count() <= 120 * 6 * (2 * 16 + 1)


def test_finite_vectors_are_told_without_a_lambda_per_element(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [nan, 0.0]), (3, [inf, 0.0]), (4, [-inf, 0.0]), (5, [None, 1.0]), (6, None), (7, [-1.0, 2.0]), (8, [None, inf])]
    for kind in ("float", "double"):
        df = spark.createDataFrame(data, f"id long, embedding array<{kind}>").repartition(2)
        kept = df.filter(neighbours._finite(df))
        assert sorted(r.id for r in kept.collect()) == [1, 7]
        assert "lambda" not in kept._jdf.queryExecution().executedPlan().toString()


def test_checksum_against_plain_sums(spark):
    from catalog.retrieving import checksum

    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=n)]) for i, n in enumerate([4, 1, 0, 7])] + [(9, None)]
    df = spark.createDataFrame(data, "id int, embedding array<double>")
    got = {r.id: (r.dim, r.norm, r.checksum) for r in checksum(df, "id").collect()}
    want = {i: (len(v), round(math.sqrt(sum(x * x for x in v)), 4), round(sum(p * x for p, x in enumerate(v)), 4)) for i, v in data[:4]}
    assert got == {**want, 9: (None, None, None)}
    assert "lambda" not in checksum(df, "id")._jdf.queryExecution().executedPlan().toString()


def test_embed_corpus_counts_words_once(spark, tmp_path, monkeypatch):
    from catalog import retrieving

    docs = [(i, f"Kafka moves events, lag {i} " * 8, "en", "src1", 100) for i in range(6)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    counted, count = [], embedding.count_words
    monkeypatch.setattr(embedding, "count_words", lambda *a: counted.append(1) or count(*a))
    done = retrieving.embed_corpus(spark, str(tmp_path))
    assert {r.dim for r in done.collect()} == {768} and len(counted) == 1
    assert "crc32" not in done._jdf.queryExecution().executedPlan().toString()


def test_rooms_are_met_without_sending_vectors_to_each(spark, monkeypatch):
    """Vectors all as far from each other, in small blocks: rows of either side are shuffled once, to be packed."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(400, 8))
    data = [(f"v{i}", [float(x) for x in v]) for i, v in enumerate(vectors / np.linalg.norm(vectors, axis=1)[:, None])]
    held = spark.createDataFrame(data, "id string, embedding array<double>").repartition(3)
    asked = held.where("id LIKE '%3'").withColumnRenamed("id", "query_id")
    plans, write = {}, neighbours.materialise

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(neighbours, "materialise", watched)
    got = {}
    for r in neighbours.nearest(held, asked, 4, query_bytes=256, corpus_bytes=256).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.distance, 9)))
    assert got == brute(data, [(i, v) for i, v in data if i.endswith("3")], 4)
    assert "Exchange" not in plans["near"] and "Exchange" not in plans["beyond"]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_few_query_vectors_are_asked_in_one_pass(spark, monkeypatch, kind):
    """Sixty queries of four vectors, far from the origin: one pass compares the four with every row."""
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(90, 5)).round(1) + 4096).astype("float32")
    vectors[30:60] = vectors[3]
    data = [(f"v{i:02}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    asked = [(i, data[i % 4][1]) for i in range(60)]
    held = spark.createDataFrame(data + [("short", [1.0])], f"id string, embedding array<{kind}>").repartition(5)
    tables, write = {}, neighbours.materialise
    monkeypatch.setattr(neighbours, "materialise", lambda df, name: tables.setdefault(name, write(df, name)))
    got = {}
    queries = spark.createDataFrame([*asked, (99, [1.0])], f"query_id int, embedding array<{kind}>")
    for r in neighbours.nearest(held, queries, 6).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.distance, 9)))
    assert got == brute(data, asked, 6)
    assert tables["vectors"].count() == 5 and "scanned" in tables and "cells" not in tables


def test_briefings_go_through_the_bars_once(spark, topical, monkeypatch):
    index = scratch_path(spark, "once")
    retrieval.build_index(topical, index)
    curated = spark.createDataFrame([("2026-01-01", "AAA", 1.0), ("2026-01-02", "AAA", 2.0)], "Date string, Ticker string, Close double")
    names, write = [], prompts.materialise
    monkeypatch.setattr(prompts, "materialise", lambda df, name: names.append(name) or write(df, name))
    done = prompts.briefing_inputs(spark, curated, index, bars=1, k=1)
    assert names == ["recent"] and "ExistingRDD" not in done._jdf.queryExecution().executedPlan().toString()
    assert "2026-01-02" in next(r.prompt for r in done.collect() if r.Ticker == "AAA")


def test_small_files_are_read_by_tasks(spark, tmp_path):
    """The same rows as Spark's reader, without a list of the files in the plan."""
    for folder in ("source=a b", "source=ü%20x", "source=q'&+(~)", "plain"):
        (tmp_path / folder).mkdir()
        for name, text in (("p 1.txt", b"t\r\nx" + folder.encode()), (".h.txt", b"no"), ("_h.txt", b"no"), ("empty.txt", b""), ("o.md", b"no")):
            (tmp_path / folder / name).write_bytes(text)
    (tmp_path / "plain" / "sub").mkdir()
    (tmp_path / "plain" / "sub" / "z.txt").write_text("not read")
    (tmp_path / "top.txt").write_text("top")
    (tmp_path / "_top.txt").write_text("no")
    place, path = F.concat_ws("|", "_metadata.file_path", "_metadata.file_name"), f"{tmp_path}/*"
    theirs = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt").select(place.alias("source"), X.plain_newlines(F.col("value")).alias("raw"))
    ours = corpus.read_markdown_corpus(spark, path, "*.txt", place)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect())) and ours.count() == 5
    assert not ours.inputFiles() and "FileScan" not in ours._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_as_the_model_counts_them(spark):
    """Every character, and the counts of texts, against the model's own stages; words are not counted by the JVM."""
    every = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x110000))]
    texts = ["".join(every[i : i + 2048]) + " ".join(every[i : i + 2048 : 7]) for i in range(0, len(every), 2048)]
    texts += ["", "ΑΣ Σ. ΣΑΣ İI", "One two, two three_three 4½", "“Größe” – naïve… ㊿ 9鿿x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    theirs = df
    for stage in embedding._counting(768):
        theirs = stage.transform(theirs)
    ours = embedding.count_words(df, 768)
    assert dict(map(tuple, ours.select("i", "_counts").collect())) == dict(map(tuple, theirs.select("i", "_counts").collect()))
    assert "regexp_extract_all" not in ours._jdf.queryExecution().executedPlan().toString()
