"""Fill-in-middle against plain Python, and its exact round trip."""

import hashlib
import re

import pytest

from missivelake.llm import fill_in_middle as fim


def plain(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in fim.SENTINELS) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    pre, mid, suf = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    out = f"<S>{suf}<P>{pre}<M>{mid}" if h4 % 100 < spm else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, "spm" if h4 % 100 < spm else "psm", len(pre), len(mid), out


TEXTS = [
    (1, None), (2, ""), (3, "one line"), (4, "\n"), (5, "\n\n\n"), (6, "a\nb\nc\nd\ne\nf"), (7, "é\n漢字\n😀\r\n\x00x\n"), (8, "holds <S> itself\nx\n"), (9, "<P>"), (10, "near <M\n>\nx<S\n"),
    (11, "line   still\x0bone\x85line\nx"), (12, "same\nsame\nsame\n"), (12, "same\nsame\nsame\n"), (None, "no id\nx\n"), (-5, "negative\nid\n"), (13, "w" * 3_000_000 + "\n" + "é" * 100_000), (14, "x\n" * 200_000),
]


@pytest.mark.parametrize("rate", [100, 50, 0])
def test_matches_plain_python_and_round_trips(docs_of, rate):
    texts = TEXTS + [(100 + i, "\n".join("abcdefg"[: i % 8])) for i in range(200)]
    got = fim.restore(fim.transform(docs_of(texts), rate=rate)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((plain(i, t, rate) for i, t in texts), key=str)
    assert all(r.restored == r.output if r.form == "plain" else True for r in got)
    assert sorted((str(r.doc_id), r.restored) for r in got) == sorted((str(i), t or "") for i, t in texts)


def test_other_sentinels_and_slices(docs_of):
    marks = ("[pre]", "{suf}", "(mid)")
    got = fim.restore(fim.transform(docs_of(TEXTS), sentinels=marks, spm=0), sentinels=marks).collect()
    assert sorted((str(r.doc_id), r.restored) for r in got) == sorted((str(i), t or "") for i, t in TEXTS)
    assert {r.form for r in got if r.doc_id not in (1, 2)} == {"psm"}
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("aa", "b", "c"), ("ab", "b", "c")):
        with pytest.raises(ValueError):
            fim.transform(docs_of([]), sentinels=bad)


def test_empty_table(docs_of):
    out = fim.restore(fim.transform(docs_of([])))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"] and out.count() == 0


def test_slices_by_bytes():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["aaa", "b", "", "cccccc", "d", "e"])], names=["text"])
    assert [s.column(0).to_pylist() for s in fim.by_bytes(batch, "text", 4)] == [["aaa", "b", ""], ["cccccc"], ["d", "e"]]
    assert [s.num_rows for s in fim.by_bytes(batch.slice(1, 3), "text", 100)] == [3]
