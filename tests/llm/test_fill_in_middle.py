"""Fill-in-middle against a plain version over code points, and the bit arithmetic below it."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroledger.llm import fill_in_middle as fim

TEXT = st.text(alphabet=st.characters(codec="utf-8"), max_size=60)


def plainly(key, text):
    """(n, form, prefix_chars, middle_chars, output) by slicing the decoded text."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_marks_and_selects_match_decoding(texts):
    data = "".join(texts).encode()
    points = fim.CodePoints(np.frombuffer(data, np.uint8))
    ends = np.cumsum([0, *[len(c.encode()) for c in "".join(texts)]])
    assert points.end_of(np.arange(len(ends))).tolist() == ends.tolist()
    assert points.up_to(ends).tolist() == list(range(len(ends)))


def test_forms_match_slices_of_decoded_texts(spark):
    texts = [None, "", "a", "é", "日本語", "😀" * 9, "plain <P> text", "<S>", "a<M", "<", "P>", "x" * 7, "y" * 8, "z" * 9,
             "mixed é日😀 " * 30, "\0\0", "long 日本 " * 200_000, "a퟿\U0010ffff"]
    rows = [(i * 7 + k, t, "clash") for k, t in enumerate(texts) for i in range(9)] + [(None, "null id, cut", "c"), (5, "again", "c"), (5, "again", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, output string").repartition(4)
    made = fim.transform(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect()), key=key)
    want = sorted(((i, *plainly(i, t), t or "") for i, t, _ in rows), key=key)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    again = fim.transform(docs.repartition(1))
    assert made.drop("back").exceptAll(again).isEmpty() and again.exceptAll(made.drop("back")).isEmpty()


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("most", [1, 10, 1000])
def test_runs_cover_every_text_once(most):
    offsets = np.cumsum([3, 0, 5, 40, 0, 0, 7, 2])
    found = list(fim.runs(offsets, most))
    assert [k for a, b in found for k in range(a, b)] == list(range(len(offsets) - 1))
    assert all(b - a == 1 or offsets[b] - offsets[a] <= most for a, b in found)
