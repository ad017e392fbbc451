"""Pairs that the line deduplication need not compare."""

import random

from odd_tables import docs_of  # noqa: E402,F401
from vigil.llm import linededup


def test_lines_that_are_not_similar_enough_are_ruled_out_by_their_sketches(docs_of, monkeypatch):
    """Variants of one text, each two of them about 0.67 alike: few of their pairs are left to be compared by words."""
    kept = linededup.write_table
    pairs = []

    def counted(df, name, **more):
        out = kept(df, name, **more)
        if name == "line-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(linededup, "write_table", counted)
    draw = random.Random(5)
    rows = [(i, " ".join(draw.sample([f"same{k}" for k in range(60)], 53) + [f"own{i}x{k}" for k in range(7)])) for i in range(60)]
    found = linededup.removed_lines(docs_of(rows + [(100, rows[7][1] + " one more"), (101, rows[8][1])])).collect()
    sets = [set(t.split()) for _, t in rows]
    want = {i for i in range(60) if any(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(i))}
    assert {(r.d, r.exact) for r in found} == {(i, False) for i in want} | {(100, False), (101, True)}
    assert pairs[0] < 120, pairs


def test_words_that_long_lines_share_do_not_hide_the_others(docs_of, monkeypatch):
    """Lines of 150 words, each two of them about 0.65 alike: a sketch in which their shared words fill the bits would leave most pairs."""
    kept = linededup.write_table
    met = []

    def counted(df, name, **more):
        out = kept(df, name, **more)
        if name == "line-meetings":
            met.append(out.count())
        return out

    monkeypatch.setattr(linededup, "write_table", counted)
    draw = random.Random(7)
    rows = [(i, " ".join(draw.sample([f"same{k}" for k in range(150)], 133) + [f"own{i}x{k}" for k in range(17)])) for i in range(60)]
    found = linededup.removed_lines(docs_of(rows + [(100, rows[7][1] + " one more"), (101, rows[8][1])])).collect()
    sets = [set(t.split()) for _, t in rows]
    assert not any(5 * len(a & b) >= 4 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert {(r.d, r.exact) for r in found} == {(100, False), (101, True)}
    assert met[0] < 60, met
