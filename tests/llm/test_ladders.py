"""Words and phrases said over and over: few rows, and the same cuts."""

import numpy as np
import pytest

from hirelattice.llm import passages


def _own(name: str, n: int) -> list[str]:
    return [f"{name}{i}" for i in range(n)]


TAIL = _own("tail", 30)
TEXTS = {
    1: _own("a", 10) + ["w"] * 120 + _own("b", 10),
    **{k: _own(f"c{k}x", 10) + ["w"] * 300 + _own(f"d{k}x", 10) for k in (2, 3, 4)},
    5: ["u", "v", "z"] * 60,
    6: _own("e", 7) + ["u", "v", "z"] * 100,
    # a passage, one word put for another, and repeats: both under the least length alone
    7: TAIL + ["one"] + ["q"] * 36,
    8: TAIL + ["two"] + ["q"] * 60,
}
CUTS = {2: [(10, 310)], 3: [(10, 310)], 4: [(10, 310)], 6: [(7, 307)], 8: [(0, 67)]}


@pytest.fixture
def documents(spark):
    return spark.createDataFrame([(k, " ".join(words)) for k, words in TEXTS.items()], "doc_id long, text string")


def test_repeated_words_make_few_rows(documents, monkeypatch):
    counts, kept = {}, passages.stored

    def counted(df, name):
        out = kept(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(passages, "stored", counted)
    passages.repeated_spans(documents)
    # five documents repeat words of a lower one: in each two ends and what lies about as far from the end
    assert counts["runs"] <= 150 and counts["spans"] <= 150


def test_repeated_words_are_cut(documents):
    report = {r["doc_id"]: r for r in passages.repeat_report(documents).collect()}
    assert {k: [(s["start"], s["stop"]) for s in r["removed_spans"]] for k, r in report.items() if r["removed_spans"]} == CUTS
    assert {k: r["owners"] for k, r in report.items() if r["owners"]} == {2: [1], 3: [1], 4: [1], 6: [5], 8: [7]}


def test_ladders():
    keys = np.array([9, 5, 5, 5, 5, 7, 7, 7, 5, 5], np.uint64)
    gaps = np.array([0, 1, 2, 2, 2, 3, 4, 5, 0, 2], np.uint64)
    new = np.array([1, 0, 0, 0, 0, 0, 0, 0, 1, 0], bool)
    inner, rest = passages.ladders(keys, gaps, new)
    assert inner.tolist() == [False, False, True, True, False, False, False, False, False, False]
    assert rest.tolist() == [0, 3, 2, 1, 0, 1, 1, 0, 1, 0]
    assert [x.tolist() for x in passages.ladders(keys[:0], gaps[:0], new[:0])] == [[], []]


def test_repeats():
    text, start, value = np.array([0, 0, 0, 0, 1, 1]), np.array([0, 1, 2, 90, 3, 4]), np.array([8, 8, 8, 8, 8, 6], np.uint64)
    assert [x.tolist() for x in passages._repeats(text, start, value)] == [[0, 0, 1, 1], [0, 90, 4, 3], [8, 8, 6, 8], [2, 0, 0, 0]]
