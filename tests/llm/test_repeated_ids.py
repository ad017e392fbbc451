"""Rows that share an id and have different texts."""

from odd_tables import docs_of  # noqa: E402,F401
from vigil.llm.linededup import line_dedup
from vigil.llm.simhash import keep_one
from vigil.llm.substring import substring_dedup

ONE, TWO, THREE = (" ".join(f"{x}{i}" for i in range(40)) for x in ("one", "two", "three"))


def test_near_duplicates_keep_each_component(docs_of):
    docs = docs_of([(1, ONE), (1, TWO), (1, TWO), (2, ONE), (3, TWO), (4, THREE), (None, ONE)], extra=True)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, ONE), (1, ONE), (1, TWO), (4, THREE)])


def test_lines_are_cut_from_their_own_row(docs_of):
    docs = docs_of([(0, ONE), (1, f"{ONE}\nend"), (1, f"{TWO}\nother"), (None, ONE), (2, f"{THREE}\n{TWO}")], extra=True)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in line_dedup(docs).collect()) == sorted(
        [(-1, ONE), (0, ONE), (1, "end"), (1, f"{TWO}\nother"), (2, THREE)])


def test_passages_are_cut_from_their_own_row(docs_of):
    rows = [(0, ONE), (1, f"Head one.\n{ONE}"), (1, f"{TWO}\nEnd."), (None, f"{THREE}\nHere."), (None, f"A b.\n{THREE}"), (None, f"Or so.\n{TWO}")]
    docs = docs_of(rows, extra=True)
    assert substring_dedup(docs).columns == docs.columns
    got = [(r.doc_id, r.text) for r in substring_dedup(docs).collect()]
    named = sorted(x for x in got if x[0] is not None)
    assert named == [(0, ONE), (1, "Head one.\n"), (1, f"{TWO}\nEnd.")]
    none = sorted(x[1] for x in got if x[0] is None)
    assert none in (sorted([f"{THREE}\nHere.", "A b.\n", "Or so.\n"]), sorted(["\nHere.", f"A b.\n{THREE}", "Or so.\n"]))
