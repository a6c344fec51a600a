"""Cross-tokenizer alignment against a plain version over byte offsets, and the sparse products below it."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from aeroledger.llm import token_alignment as ta
from aeroledger.llm.queries import byte_model, piece_model

ODD = [None, "", " ", "a", "a▁b", "▁", "日本語 \0 x", " lead  trail ", "😀 \t\n", "<s> <0x0A> <|endoftext|> </s>", "don't we're I'LL",
       "word " * 40, "éé" * 30, "1234567890 " * 5, "\r\n\r\n   x", "ﬁ ① Ａ é", "q" * 3000, "don't we're I'LL"]


def plainly(texts):
    """The columns of the contract by offsets, from both libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(byte_model())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    letters = ta.byte_alphabet()
    docs = []
    for text in texts:
        whole = b" " + (text or "").encode()
        a, b = first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or "")
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        cuts, groups = sorted(set(ends_a) & set(ends_b)), []
        for low, high in zip([0, *cuts], cuts):
            groups.append(([i for i, e in zip(a, ends_a) if low < e <= high], [i for i, e in zip(b, ends_b) if low < e <= high]))
        docs.append(groups)
    count, best = Counter(), defaultdict(int)
    for groups in docs:
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        name = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(name.encode()).hexdigest() if groups else ""))
    return out


@pytest.mark.parametrize("chunk_bytes", [1, 200, 4 << 20])
def test_alignment_matches_offsets(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(ta, "CHUNK_BYTES", chunk_bytes)  # read when the query is built, hence sent along with the task
    rng = np.random.default_rng(3)
    letters = list("abcdefghij éß日本 .,'0123\n")
    texts = [*ODD, *["".join(rng.choice(letters, rng.integers(1, 200))) for _ in range(30)]]
    rows = [(i if i != 3 else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_a string").repartition(3)
    got = ta.alignment(docs, byte_model(), piece_model())
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(((i, *w) for (i, _, _), w in zip(rows, plainly(texts))), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    assert sum(w[1] == 0 for w in want) >= 4 and any(w[5] < w[4] for w in want)


def test_empty_table(spark):
    assert ta.alignment(spark.createDataFrame([], "doc_id bigint, text string"), byte_model(), piece_model()).count() == 0


def test_overlap_links_and_groups_of_a_text(spark):
    docs = spark.createDataFrame([(1, "unbelievable things"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in ta.token_groups(docs, byte_model(), piece_model()).collect()}
    r, aligner = got[1], ta.Aligner(byte_model(), piece_model())
    ends = [np.cumsum(v.sizes[np.array(ids)]) for v, ids in ((aligner.a.vocabulary, r.ids_a), (aligner.b.vocabulary, r.ids_b))]
    want = {}
    for i, e in enumerate(ends[0]):
        for j, f in enumerate(ends[1]):
            shared = min(e, f) - max(e - aligner.a.vocabulary.sizes[r.ids_a[i]], f - aligner.b.vocabulary.sizes[r.ids_b[j]])
            if shared > 0:
                want[i, j] = shared
    assert dict(zip(zip(r.link_a, r.link_b), r.shared_bytes)) == want
    assert all(r.group_a[i] == r.group_b[j] for i, j in want)
    assert got[2].ids_a == got[2].link_a == []


def test_products_match_dense_ones(monkeypatch):
    monkeypatch.setattr(ta, "MOST_WORK", 7)
    rng = np.random.default_rng(5)

    def rows(dense):
        r, c = np.nonzero(dense)
        return ta.Rows(ta.begins(np.bincount(r, minlength=len(dense))), c, dense[r, c], dense.shape[1])

    for _ in range(40):
        n, k, m = rng.integers(1, 9, 3)
        x, y = rng.integers(0, 4, (n, k)) * (rng.random((n, k)) < .5), rng.integers(1, 4, (k, m)) * (rng.random((k, m)) < .5)
        got = ta.product(rows(x), rows(y))
        dense = np.zeros((n, m), int)
        dense[np.repeat(np.arange(n), got.sizes()), got.columns] = got.values
        assert (dense == x @ y).all() and len(got) == n


def test_groups_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(ta, "row_hash", lambda starts, ids, step: np.zeros(len(starts) - 1, np.uint64))
    starts, a, b = np.array([0, 2, 3, 5, 6]), np.array([1, 2, 3, 1, 2, 3]), np.array([7, 7, 8, 7, 7, 9])
    example, kind = ta.distinct_groups(starts, a, starts, b)
    assert kind.tolist() == [0, 1, 0, 2] and example.tolist() == [0, 1, 3]


def test_vocabulary_file_encodes_as_its_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_model())
    library.encode_special_tokens = True
    own = ta.ByteTokens(byte_model())
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [t or "" for t in ODD] + [f"a{c}b {c}1{c} {c}{c}.{c} '{c}s" for c in points]
    assert [x.tolist() for x in own(texts)] == [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_runs_join_to_what_one_run_gives(monkeypatch):
    aligner, texts = ta.Aligner(byte_model(), piece_model()), [t or "" for t in ODD]
    whole = aligner.align(texts)
    for most in (1, 7, 50, 10_000):
        monkeypatch.setattr(ta, "ALIGN_CHARACTERS", most)
        parts = aligner(texts)
        for name in ("ids_a", "ids_b", "bounds_a", "bounds_b", "group_a", "group_b"):
            assert getattr(parts, name).tolist() == getattr(whole, name).tolist()
        for name in ("starts", "columns", "values"):
            assert getattr(parts.links, name).tolist() == getattr(whole.links, name).tolist()
