"""The stages of the pipeline on a small folder, each against a plain version."""

import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from aeroledger.llm.queries import piece_model

ENGLISH = "the with which thing that where think other through weather though whether".split()
FRENCH = "quoi eaux mais aussi dans pour leur nous vous oiseau beaucoup chaque".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def near(a, b):
    a, b = ({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in (words(a), words(b)))
    return bool(a) and 100 * len(a & b) >= 75 * len(a | b)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(11)
    texts = [(" ".join(rng.choice(ENGLISH if i % 2 else FRENCH, 60)), "en" if i % 2 else "fr") for i in range(40)]
    texts += [(texts[0][0].upper(), "fr"), (texts[1][0], "en"), (texts[1][0] + " end", "en"), ("begin " + texts[2][0], "fr"),
              (None, None), ("", None), ("12 345 !?", None), (texts[2][0] + " fin", None)]
    rows = [(i, t, lang, ["a", "b", None][i % 3], len(t or "")) for i, (t, lang) in enumerate(texts)] + [(None, texts[3][0], "en", "a", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_match_plain_versions(spark, folder):
    import sentencepiece

    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns, before = docs.columns, docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, folder).cache()
    # Every document with letters is in a known language here, all others go.
    assert kept.columns == columns
    assert sorted(r.text for r in kept.collect()) == sorted(r.text for r in before if re.search("[A-Za-z]", r.text or ""))

    single = stages["exact_dedup"](spark, kept, folder).cache()
    groups = {}
    for r in kept.collect():
        groups.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), r.text), []).append(r.doc_id)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(max(i for i in g if i is not None) for g in groups.values())

    apart = stages["jaccard_join"](spark, single, folder).cache()
    left, out = single.collect(), apart.collect()
    component = {r.doc_id: r.doc_id for r in left}
    for _ in left:
        for a in left:
            for b in left:
                if near(a.text, b.text):
                    component[a.doc_id] = component[b.doc_id] = min(component[a.doc_id], component[b.doc_id])
    assert apart.columns == columns and sorted(component[r.doc_id] for r in out) == sorted(set(component.values()))

    mix = stages["balanced_mix"](spark, apart, folder).cache()
    sizes = {r.doc_id: len(words(r.text)) for r in out}
    taken = {}
    for r in mix.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert mix.columns == columns and set(taken) <= set(sizes) and max(taken.values()) <= 3
    per_source = {s: sum(sizes[r.doc_id] * taken.get(r.doc_id, 0) for r in out if r.source == s) for s in ("a", "b", None)}
    total = sum(sizes.values())
    for (source, got), weight in zip(per_source.items(), (1, 2, 3)):
        own = sum(sizes[r.doc_id] for r in out if r.source == source)
        assert abs(got - min(total * weight / 6, 3 * own)) <= 130  # about two documents

    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = []
    for r in mix.collect():
        ids = model.encode(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    digests = stages["sentencepiece"](spark, mix, folder)
    assert sorted(map(tuple, digests.collect())) == sorted(want)


def test_whole_run_gives_a_row_per_taken_document(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() > 0 and got.where("doc_id IS NULL OR n_tokens = 0").count() == 0
