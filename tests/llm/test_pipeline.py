"""The whole pipeline, stage by stage, against plain Python over a small table."""

import hashlib
import random
import re

import corpus_pipeline
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tickloom.llm import quality
from tickloom.llm.common import materialise
from tickloom.llm.paths import vocabulary

from .test_groups import components_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Good texts, junk, copies, near copies and passages that texts share."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2_000)] + ["the", "and", "of", "with"] * 150
    passage = rng.choices(words, k=65)
    texts = []
    for i in range(90):
        kind = i % 6
        if kind == 0 or i < 6:
            texts.append(" ".join([*rng.choices(words, k=180), "the", "and"]))
        elif kind == 1:
            texts.append(" ".join([*rng.choices(words, k=40), *passage, *rng.choices(words, k=20), "the", "and"]))
        elif kind == 2:
            texts.append(rng.choice(texts))
        elif kind == 3:
            near = (texts[i - 3] or "").split()
            texts.append(" ".join([*near[:-1], f"x{i}"]))
        elif kind == 4:
            texts.append(rng.choice(["too short", "# " * 60, "again and again " * 30, None, "", "word " * 3 + "\n" * 5]))
        else:
            texts.append(" ".join(rng.choices(words, k=rng.choice([12, 30, 300]))) + " the and of")
    sources = ["s1", "s2", None, "s3"]
    return [(i, t, "en", sources[(i * i) % 4], len(t or "")) for i, t in enumerate(texts)]


def keeps(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(i, i + 5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return False
    return (
        100 * sum(map(len, words)) <= 2500 * len(words)
        and 100 * sum(c in "#*$%&|<>" for c in text) <= 30 * len(words)
        and 100 * (len(lines) - len(set(lines))) <= 50 * len(lines)
        and 100 * sum(x.endswith(("...", "…")) for x in lines) <= 30 * len(lines)
        and (len(set(words) & set(quality.STOP_WORDS)) >= 2 or len(words) <= 50)
    )


def without_passages(rows):
    seen, out = {}, []
    for i, text, *rest in sorted(rows):
        words, gone = WORD.findall(text), set()
        for k in range(len(words) - 49):
            if seen.setdefault(tuple(words[k : k + 50]), i) < i:
                gone.update(range(k, k + 50))
        if gone:
            text = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, text, *rest[:-1], len(text)))
    return out


def mixed(rows):
    sizes, sources = {}, {}
    for i, text, _, source, _ in rows:
        sizes[i] = len(WORD.findall(text))
        sources.setdefault(source, []).append(i)
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    size = {s: sum(sizes[i] for i in ids) for s, ids in sources.items()}
    full, budget = set(), 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in full]
        level = (budget - sum(2 * size[s] for s in full)) / sum(weight[s] for s in free)
        more = {s for s in free if weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    target = {s: 2.0 * size[s] if s in full else weight[s] * level for s in order}
    copies = []
    for s, ids in sources.items():
        upto = 0
        for key, i in sorted((hashlib.md5(f"mix{i}".encode()).hexdigest(), i) for i in ids):
            upto += sizes[i]
            if sizes[i]:
                copies += [((turn * size[s] + upto) / target[s], key, turn, i) for turn in (0, 1)]
    taken, total = [], 0
    for *_, i in sorted(copies):
        total += sizes[i]
        if total > int(sum(target.values()) + 1e-6):
            break
        taken.append(i)
    return sorted(taken)


def test_every_stage_equals_plain_python(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, str(tmp_path)), name)
        done[name] = [tuple(r) for r in docs.collect()]
        if name != "token_ids":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = [r for r in rows if keeps(r[1])]
    assert sorted(done["quality_rules"]) == sorted(good) and len(good) < len(rows)
    groups = components_of([r[:2] for r in good], 5, 80)
    single = [r for r in good if groups[r[0]][2]]
    assert sorted(done["near_dedup"]) == sorted(single) and len(single) < len(good)
    cut = without_passages(single)
    assert sorted(done["substring_dedup"]) == cut and sorted(single) != cut
    taken, by_id = mixed(cut), {r[0]: r for r in cut}
    assert sorted(done["source_mix"]) == sorted(by_id[i] for i in taken)
    sp = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    ids = sorted((i, by_id[i][3] or "", sp.encode(by_id[i][1])) for i in taken)
    assert sorted((i, s or "", list(x)) for i, s, x in done["token_ids"]) == ids
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.source or "", list(r.ids)) for r in whole) == ids


def test_pipeline_of_odd_rows(spark, odd, none, tmp_path):
    for name, docs in (("odd", odd), ("none", none)):
        docs.withColumns({"n_chars": F.length("text"), "size": F.lit("x")}).write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {r.doc_id for r in rows} <= {None, 6, 7, 9, 10}
