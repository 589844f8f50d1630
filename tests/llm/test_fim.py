"""Frames, cuts and digests against plain strings."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import fim

CHARS = st.text(alphabet="ab<>PSMé€\U0001f600 \n", max_size=60)


def plain_output(doc_id, text: str, seed: int = 1) -> tuple[str, int, int, str]:
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted(v % (len(text) + 1) for v in h[:2])
    p, m, s = text[:i], text[i:j], text[j:]
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return ("spm" if h[3] % 100 < 20 else "psm"), i, j - i, out


@settings(max_examples=200, deadline=None)
@given(CHARS, st.integers(1, 7), st.integers(0, 70), st.integers(0, 70))
def test_cuts_open_one_frame(text, units, a, b):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    frames = fim.Frames.of(text.encode(), units)
    assert frames.units == len(text) and all(n <= units for n in map(int.__sub__, frames.until, [0, *frames.until]))
    left, right = frames.cut(a)
    assert b"".join(left.stream()).decode() == text[:a] and b"".join(right.stream()).decode() == text[a:]
    assert left.units == a and right.units == len(text) - a
    whole = set(frames.data)
    assert sum(f not in whole for f in (*left.data, *right.data)) <= 2
    raw = text.encode()
    assert b"".join(frames.stream(a, b)) == raw[a:b] and b"".join(frames.stream(a)) == raw[a:]
    for mark in (b"<P>", b"ab", "é€".encode()):
        assert frames.find(mark, min(a, len(raw))) == raw.find(mark, min(a, len(raw)))


@settings(max_examples=200, deadline=None)
@given(CHARS, st.integers(1, 7), st.integers(0, 70), st.integers(0, 70), st.sampled_from(["psm", "spm", "plain"]))
def test_output_goes_back(text, units, a, b, form):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    text = text.replace("<P>", "").replace("<S>", "").replace("<M>", "")
    a, b = min(a, len(text)), min(b, len(text))
    if any(m in text for m in ("<P>", "<S>", "<M>")):
        return
    output = fim.arrange(fim.Frames.of(text.encode(), units), form, a, b)
    p, m, s = text[:a], text[a:b], text[b:]
    assert b"".join(output.stream()).decode() == {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    assert b"".join(fim.restore(output, form)).decode() == text


def test_a_text_of_another_form_is_refused():
    with pytest.raises(ValueError):
        list(fim.restore(fim.Frames.of(b"no sentinel"), "psm"))


def test_bytes_that_are_no_text_come_back():
    raw = b"\x80\x81ab\xff\xc3(\xe2\x82"
    frames = fim.Frames.of(raw, 2)
    assert b"".join(frames.stream()) == raw
    assert b"".join(fim.restore(fim.arrange(frames, "psm", 1, 3), "psm")) == raw
    assert b"".join(fim.Frames.of(b"\x80\x80").stream()) == b"\x80\x80"


@pytest.mark.parametrize("units", [3, 1 << 15])
def test_messy_rows(messy, units):
    store = fim.to_frames(messy, units=units)
    told = fim.digests(fim.fill_in_middle(store)).collect()
    want = {}
    for r in messy.collect():
        text = r["text"] or ""
        form, p, m, out = plain_output(r["doc_id"], text)
        want.setdefault((r["doc_id"], text), (len(text), form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = sorted((r["n"], r["form"], r["prefix_chars"] if r["prefix_chars"] is not None else -1, r["middle_chars"] if r["middle_chars"] is not None else -1, r["output_sha256"], r["restored_sha256"]) for r in told)
    every = [want[r["doc_id"], r["text"] or ""] for r in messy.collect()]
    assert got == sorted((n, f, -1 if p is None else p, -1 if m is None else m, o, t) for n, f, p, m, o, t in every)
    assert {r["form"] for r in told} == {"plain", "psm", "spm"}
    # Other columns are what they were.
    assert sorted(map(str, (r["row"].asDict() for r in told))) == sorted(str({k: v for k, v in r.asDict().items() if k != "text"}) for r in messy.collect())


def test_sentinels_in_texts_and_steps(spark, monkeypatch):
    monkeypatch.setattr(fim, "STEP_BYTES", 64)
    texts = ["a <P> b", "<S>", "x<M>", "<P", "S>", "<", "<<P", ">" * 9] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    outputs = fim.fill_in_middle(fim.to_frames(docs))
    got = {r["row"]["doc_id"]: (r["form"], r["output"]) for r in fim.texts(outputs).collect()}
    for i, t in enumerate(texts):
        form, _, _, out = plain_output(i, t)
        assert got[i] == (form, out)


def test_no_documents(nothing):
    assert fim.digests(fim.fill_in_middle(fim.to_frames(nothing))).collect() == []


def test_shares_are_parameters(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text to cut").alias("text"))
    store = fim.to_frames(docs).cache()
    assert {r["form"] for r in fim.fill_in_middle(store, transformed_percent=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.fill_in_middle(store, transformed_percent=100, spm_percent=100).collect()} == {"spm"}
    first, second = ({(r["row"]["doc_id"], r["form"], r["prefix_chars"]) for r in fim.fill_in_middle(store, seed=s).collect()} for s in (1, 2))
    assert first != second and len(first) == 400
