"""Order MinHash against a plain version, and its behaviour under edits."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from tickloom.llm import ordered, queries

SF = "/root/testdata/sf0.001"
ALONE = "぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
TOKEN = re.compile(f"[^ \t\n\x0b\f\r{ALONE}]{{1,16}}|[{ALONE}]")


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(*values):
    """The hash of several values in turn: strings, 64-bit numbers, or (32-bit number,)."""
    seed = 42
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(4, "little") if isinstance(v, tuple) else (
            v.to_bytes(8, "little", signed=True))
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return signed(seed)


def plain(text):
    tokens = TOKEN.findall(text or "")
    seen, bins = {}, {}
    for i, token in enumerate(tokens):
        kmer = chained(token, tokens[i + 1] if i + 1 < len(tokens) else None) >> 31
        number = seen[kmer] = seen.get(kmer, -1) + 1
        value = chained(kmer, (number,)) >> 31
        bins.setdefault(value >> 27, []).append((value, i))
    out = []
    for place in sorted(bins):
        pair = sorted(sorted(bins[place])[:2], key=lambda x: x[1])
        out.append(((place + 32) << 18) | (chained(*(v for v, _ in pair)) & ((1 << 18) - 1)))
    return out


def likeness(one, other):
    filled = {c >> 18 for c in one} | {c >> 18 for c in other}
    return len(set(one) & set(other)) / len(filled) if filled else 1.0


def test_registered_query_equals_plain_python(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.op12_order_minhash(spark, SF).collect()}
    assert len(got) == len(docs)
    for at, (doc_id, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        one, two, three = plain(text), plain(edited), plain(after)
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{c:06x}" for c in one)
        assert r.edited_fingerprint == "".join(f"{c:06x}" for c in two)
        assert (r.near_edited, r.near_next) == (likeness(one, two), likeness(one, three))


def test_plan_runs_no_python(spark):
    plan = queries.op12_order_minhash(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_odd_rows(spark, odd, none):
    texts = [(*r[:2], at) for at, r in enumerate(odd.select("doc_id", "text").collect())]
    more = spark.createDataFrame(texts, "doc_id long, text string, row int").withColumns(
        {"n_chars": F.lit(-1), "EDITED": F.lit("x"), "_key": F.lit(1), "components": F.lit(2)}
    )
    got = ordered.edits(more, ["doc_id", "row"])
    assert sorted(got.columns) == ["components", "doc_id", "edited", "edited_components", "n_chars", "next_components", "row"]
    got = {r.row: r for r in got.collect()}
    rows = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert len(got) == len(rows)
    for at, (doc_id, text, row) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        r = got[row]
        assert (r.doc_id, r.n_chars, r.edited) == (doc_id, len(text), text[: len(text) - half] + after[:half])
        assert (r.components, r.next_components) == (plain(text), plain(after))
        assert r.edited_components == plain(r.edited)
    assert ordered.edits(none, ["doc_id"]).count() == 0


def test_one_document_follows_itself(spark):
    one = spark.createDataFrame([(1, "ab cd ef gh")], "doc_id long, text string")
    (r,) = ordered.edits(one, ["doc_id"]).collect()
    assert r.edited == "ab cd ab cd " [:11] and list(r.next_components) == list(r.components)


def test_order_of_documents_over_many_ranges(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = {r.doc_id: r.next_text for r in ordered.with_next(docs.repartition(7), ["doc_id"], ["text"]).collect()}
    assert got == {i: str((i + 1) % 1000) for i in range(1000)}


def test_likeness_follows_order_and_edits(spark):
    words = [f"w{hashlib.md5(str(i).encode()).hexdigest()[:5]}" for i in range(2000)]
    swapped = words[1000:] + words[:1000]
    shuffled = sorted(words)
    few = [w if i % 100 else "edited" for i, w in enumerate(words)]
    texts = [words, few, swapped, shuffled]
    df = spark.createDataFrame([(" ".join(t),) for t in texts], "text string").select(ordered.fingerprint("text").alias("c"))
    first, few, swapped, shuffled = (list(r.c) for r in df.collect())
    assert 1 > likeness(first, few) > 0.7 > likeness(first, swapped) > 0.3 > likeness(first, shuffled)
