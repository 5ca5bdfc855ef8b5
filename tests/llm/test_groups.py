"""Near duplicates, repeated passages, the mix, archives and neighbours against plain Python."""

import base64
import gzip
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import ann, mixing, near, repeats, warc
from tickloom.llm.cells import read_cells
from tickloom.llm.common import scratch_path

SF = "/root/testdata/sf0.001"


def texts(seed=0):
    """Copies, near copies in chains, shared passages and unrelated texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3_000)]
    rows, base = [], rng.choices(words, k=200)
    passage = rng.choices(words, k=70)
    for i in range(120):
        if i % 3 == 0:
            base = [rng.choice(words) if rng.random() < 0.01 else w for w in base]
            rows.append((i, " ".join(base)))
        elif i % 3 == 1:
            own = rng.choices(words, k=rng.choice([0, 1, 2, 30, 120]))
            rows.append((i, " ".join([*own, *passage[rng.randrange(10) :], *own[:5]])))
        else:
            rows.append((i, rows[rng.randrange(len(rows))][1].upper() if rng.random() < 0.5 else rows[-1][1]))
    return rows


def components_of(rows, size, similarity):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and (common := len(sets[i] & sets[j])) and 100 * common >= similarity * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_near_duplicates_equal_all_pairs(spark):
    rows = [*texts(), (500, None), (501, ""), (502, "a"), (503, "A"), (504, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit(1))
    for size, similarity in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(docs, size, similarity).collect()}
        assert got == components_of(rows, size, similarity)


def test_near_duplicates_of_odd_rows(odd, none):
    rows = near.near_duplicates(odd, 3, 85).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[None].kept and by[None].component_id is None and by[7].component_id == 6 and by[3].n_shingles == 0
    left = near.one_of_each(odd, 3, 85)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 4, 5, 6, 8, 9, 10] and left.columns == odd.columns
    assert near.near_duplicates(none, 3, 85).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(3_000)]
    a, b, c, d = (rng.choices(words, k=200) for _ in range(4))
    near_a, near_b = [*a[:-1], "x"], [*b[:-1], "y"]
    rows = [(1, a), (2, near_a), (2, b), (3, near_b), (3, c), (4, d), (4, d), (4, c), (5, []), (5, d), (6, a), (6, near_a)]
    rows = [(i, " ".join(w)) for i, w in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.component_id) for r in near.near_duplicates(docs, 3, 85).collect()}
    assert got == {(i, 1) for i in range(1, 7)} | {(5, 5)}  # an empty text is linked with nothing
    left = sorted((r.doc_id, r.text) for r in near.one_of_each(docs, 3, 85).collect())
    assert left == sorted([(1, rows[0][1]), (2, rows[2][1]), (3, rows[4][1]), (4, rows[5][1]), (5, "")])


def test_every_text_of_an_id_is_linked(spark):
    rng = random.Random(4)
    words = [f"u{i}" for i in range(3_000)]
    rows = []
    for i in range(40):
        one, other = rng.choices(words, k=120), rng.choices(words, k=120)
        rows += [(i, one), (i, other), (1_000 + i, [*one[:-1], "x"]), (2_000 + i, [*other[:-1], "y"])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs, 3, 85).collect()}
    assert got == {i: i % 1_000 for i, _ in rows}
    shared = near.groups(docs, 3, 85)
    assert shared.roots.count() == 160 and shared.roots.select("root").distinct().count() == 80
    assert sorted(r.doc_id for r in near.one_of_each(docs, 3, 85).collect()) == sorted([*range(40)] * 2)


def cut(rows):
    split, seen, out = {i: (t or "").encode().split() for i, t in rows}, {}, {}
    for i in sorted(split):
        w, gone = split[i], set()
        runs = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        for k, run in enumerate(runs):
            if seen.setdefault(run, i) < i:
                gone.update(range(k, k + 50))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_repeated_passages_equal_all_windows(spark):
    rows = [*texts(1), (500, None), (501, ""), (502, "a " * 300), (503, "a " * 49)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.summary(docs).collect()}
    assert got == cut(rows)
    for r in repeats.without_repeats(docs.withColumn("starts", F.lit(1))).collect():
        assert hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest() == got[r.doc_id][2]


def test_automata_report_every_place_and_the_windows_around():
    rng = random.Random(6)
    words = [bytes([rng.choice(b"abc")]) for _ in range(400)]
    phrases = {tuple(words[i : i + 10]) for i in (3, 77, 78, 200, 390)}
    shard = repeats.Shard()
    assert not len(shard.places(words))
    for phrase in phrases:
        shard.add(list(phrase))
    other = [*words[60:120], b"?", *words[195:215], *words[3:13]]
    for text in (words, other, other[:9], []):
        places = [i for i in range(len(text) - 9) if tuple(text[i : i + 10]) in phrases]
        assert shard.places(text).tolist() == places
        windows = [s for s in range(len(text) - 49) if any(s <= p <= s + 40 for p in places)]
        if len(text) >= 50:
            assert repeats.around(np.array(places, dtype=np.int64), len(text)).tolist() == windows


def test_a_passage_of_most_rows_is_hot_and_joined_alike(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3_000)]
    passage = rng.choices(words, k=90)
    rows = [(i, " ".join([*rng.choices(words, k=i % 40), *passage[i % 7 :], *rng.choices(words, k=9)])) for i in range(150)]
    rows += [(i, " ".join(rng.choices(words, k=60))) for i in range(150, 180)]
    rows += [(200, rows[160][1] + " end"), (201, rows[160][1] + " stop")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot, chars in ((1, 4 << 20), (50, 2_000), (10_000, 500)):  # no key, the passage, every key is hot
        monkeypatch.setattr(repeats, "HOT", hot)
        monkeypatch.setattr(repeats, "SHARD_CHARS", chars)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.summary(docs).collect()}
        assert got == cut(rows)


def test_repeated_passages_of_odd_rows(odd, none):
    rows = repeats.summary(odd).collect()
    assert len(rows) == odd.count() and not any(r.n_removed for r in rows)
    assert repeats.without_repeats(odd).count() == odd.count() and repeats.summary(none).count() == 0


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs).collect()
    total = sum(r.size for r in rows)
    by = {r.source: (r.source_size, r.target) for r in rows}
    assert abs(sum(t for _, t in by.values()) - 1.5 * total) < 1e-3
    largest = max(r.size for r in rows)
    for source, (size, target) in by.items():
        assert target <= 2 * size + 1e-6
        assert abs(sum(r.taken for r in rows if r.source == source) - target) <= largest
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)
    again = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    assert mixing.mixed_documents(docs).count() == sum(r.taken // r.size for r in rows if r.size)


def test_mix_of_odd_rows(odd, none):
    rows = mixing.mix(odd.withColumn("taken", F.lit("x")).withColumn("weight", F.lit(1))).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mixed_documents(none).count() == 0


def test_archives_round_trip(spark):
    rows = [(1, "http://a/ b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c\n", ""), (4, "d", None), (None, "e", "é" * 9), (6, "f", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1)).repartition(2)
    streams, archives = scratch_path(spark, "streams"), scratch_path(spark, "warc")
    warc.write_streams(pages, streams)
    warc.normalise(spark, streams, archives)
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(spark, archives).collect()}
    later = {"<p>x</p>": 2, "": 4}
    wanted = set()
    for i, _, h in rows:
        raw = (h or "").encode()
        keeper = later.get(h or "", i)
        kind = ("response", None) if keeper == i else ("revisit", keeper)
        wanted.add((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind))
    assert got == wanted
    index = warc.read_index(spark, archives).collect()
    assert len(index) == len(rows)
    for r in read_cells(spark, f"{archives}/kind=warc").collect():
        whole = gzip.decompress(bytes(r.content))  # any reader of gzip takes the archive
        assert whole.count(b"WARC/1.1\r\n") >= 1


def test_archives_are_bounded_by_bytes_and_still_match_their_sidecars(spark):
    rng = random.Random(2)
    rows = [(i, f"http://p/{i}", "".join(rng.choices("abcdefgh <>/", k=20_000))) for i in range(60)]
    rows += [(100 + i, None, rows[i][2]) for i in range(10)] + [(5, "again", rows[5][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    streams, archives = scratch_path(spark, "streams"), scratch_path(spark, "warc")
    warc.write_streams(pages, streams, stream_bytes=50_000)
    sizes = [len(r.content) for r in read_cells(spark, streams).collect()]
    assert len(sizes) > 8 and max(sizes) < 50_000 + 40_000
    warc.normalise(spark, streams, archives)
    assert read_cells(spark, f"{archives}/kind=warc").count() == len(sizes)
    got = {(r.page_id, r.url, r.record_type, r.refers_to) for r in warc.read_records(spark, archives).collect()}
    assert got == {
        (i, u, *(("revisit", i + 100) if i < 10 else ("response", None))) for i, u, _ in rows
    }


def test_archives_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    streams, archives = scratch_path(spark, "streams"), scratch_path(spark, "warc")
    warc.write_streams(pages, streams)
    warc.normalise(spark, streams, archives)
    assert warc.read_records(spark, archives).count() == 0


def test_neighbours_find_most_of_the_nearest(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1_500, 16)).tolist()
    vectors[50] = vectors[100] = vectors[101] = vectors[102]
    rows = [*enumerate(vectors), (2_000, None), (2_050, [0.0] * 16), (2_100, [float("nan")] * 16), (2_150, [None] * 16), (2_200, [1.0]), (None, vectors[0])]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 50, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1_500, 50))
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    hits = 0
    for q, found in got.items():
        near_ = unit @ unit[q]
        near_[q] = -9
        best = sorted(range(1_500), key=lambda i: (-near_[i], i))[:5]
        hits += len({v for _, v, _ in found} & set(best))
        assert [rank for rank, *_ in sorted(found)] == [1, 2, 3, 4, 5]
        assert all(abs(s - near_[v]) < 1e-12 for _, v, s in found)
    assert hits >= 0.9 * 5 * len(got)
    assert [v for _, v, _ in sorted(got[50])][:3] == [100, 101, 102]


def test_neighbours_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty, 50, 5).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(one, 50, 5).count() == 0


def test_very_large_and_very_small_vectors_take_part(spark):
    data = [(0, [1e200, 1e200]), (50, [1e-200, 0.0]), (3, [1.0, 1.1]), (4, [5e-324, 0.0]), (5, [0.0, 0.0]), (6, [1e308, -1e308])]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>").coalesce(1)
    got = {(r.query_id, r.rank): (r.vec_id, round(r.score, 6)) for r in ann.nearest(rows, every=50, k=2).collect()}
    assert got == {
        (0, 1): (3, 0.998868), (0, 2): (4, 0.707107), (50, 1): (4, 1.0), (50, 2): (0, 0.707107)
    }
