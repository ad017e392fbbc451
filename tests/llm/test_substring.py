"""Repeated passages against brute force on word windows, not on the operator's own units."""

import re
from collections import defaultdict

import pytest

from odd_tables import docs_of  # noqa: E402,F401
from vigil.llm.common import table
from vigil.llm.substring import op7_substring, repeated_spans, substring_dedup

MID = "/root/testdata/sf0.01"


def test_words_known_from_unrelated_documents_stay(docs_of):
    """Each capitalised word of the last text stands in some earlier document, but their sequence stands nowhere."""
    names = [f"Name{i}x" for i in range(60)]
    docs = docs_of([(i, f"{x} was here today number{i}") for i, x in enumerate(reversed(names))] + [(i + 100, x) for i, x in enumerate(names)]
                   + [(1000, " ".join(names)), (1001, "so " + " ".join(names) + " Other")])
    spans = repeated_spans(docs).collect()
    assert [(r.doc_id, r.kept_id, r.start, r.n_words) for r in spans if r.doc_id >= 1000] == [(1001, 1000, 3, 60)]
    texts = {r.doc_id: r.text for r in substring_dedup(docs).collect()}
    assert texts[1000] == " ".join(names) and texts[1001] == "so  Other"


def test_a_circle_keeps_its_first_round(docs_of):
    """Windows that overlap the kept one are repeats as well."""
    text = "Go there now. " * 100
    docs = docs_of([(1, text)])
    assert [(r.start, r.end, r.kept_start) for r in repeated_spans(docs).collect()] == [(14, len(text.rstrip()), 0)]
    assert [r.text.strip() for r in substring_dedup(docs).collect()] == ["Go there now."]


def test_short_passages_and_lines(docs_of):
    """Units of 11, 14 and 14 words inside two texts, and whole lines of a few words."""
    middle = " ".join(" ".join([f"Start{n}x", *(f"w{n}x{i}" for i in range(n - 1))]) + "." for n in (11, 14, 13))
    docs = docs_of([(1, f"One head {middle} tail one\nAll rights reserved\nno"), (2, f"Another head {middle} tail two\nall  rights reserved\nyes, no"),
                    (3, "he said All rights reserved then"), (4, "Yes, No")])
    texts = {r.doc_id: r.text for r in substring_dedup(docs).collect()}
    assert texts[1].startswith("One head Start11x") and texts[1].endswith("no")
    assert texts[2].split() == "Another head tail two yes, no".split()
    assert texts[3] == "he said All rights reserved then" and texts[4] == ""


@pytest.fixture(scope="module")
def mid(spark):
    spans = defaultdict(list)
    for r in op7_substring(spark, MID).collect():
        spans[r.doc_id].append((r.start, r.end))
    return {r.doc_id: r.text or "" for r in table(spark, MID, "documents").collect()}, spans


def test_recall_on_word_windows(mid):
    """Stretches whose 50-word windows all stand in earlier documents."""
    texts, spans = mid
    seen, found, touched, words, gone = set(), 0, 0, 0, 0
    for i in sorted(texts):
        w = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"\S+", texts[i])]
        own = [" ".join(x[0] for x in w[k:k + 50]) for k in range(len(w) - 49)]
        k = 0
        while k < len(own):
            end = k
            while end < len(own) and own[end] in seen:
                end += 1
            part = w[k:end + 49] if end > k else []
            if len({x[0] for x in part}) > 0.3 * len(part):
                cut = sum(any(s <= x[1] and x[2] <= e for s, e in spans[i]) for x in part)
                found, touched, words, gone = found + 1, touched + (cut > 0), words + len(part), gone + cut
            k = max(k + 1, end)
        seen.update(own)
    assert found > 100 and touched > 0.95 * found and gone > 0.9 * words


def test_repeated_lines_go(mid):
    texts, spans = mid
    seen, n = set(), 0
    for i in sorted(texts):
        at = 0
        for line in texts[i].split("\n"):
            key = tuple(line.lower().split())
            if key and key in seen:
                n += 1
                first = at + len(line) - len(line.lstrip())
                assert any(s <= first and at + len(line.rstrip()) <= e for s, e in spans[i])
            seen.add(key)
            at += len(line) + 1
    assert n > 50
