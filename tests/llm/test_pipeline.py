"""The pipeline against a brute-force version of every stage on its own input."""

from collections import Counter

import pytest

from odd_tables import docs_of  # noqa: E402,F401
import corpus_pipeline
from test_brute import WORD, slow_components, slow_fingerprint, slow_targets
from vigil.llm.common import table
from vigil.llm.quality import op8_quality
from vigil.session import write_table

SMALL = "/root/testdata/sf0.001"


def slow_lines(docs):
    """doc_id -> text without lines that an earlier line is similar to."""
    seen, out = [], {}
    for i in sorted(docs):
        kept = []
        for line in docs[i].split("\n"):
            s = frozenset(WORD.findall(line))
            if not s or not any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                kept.append(line)
            if s:
                seen.append(s)
        out[i] = "\n".join(kept)
    return out


@pytest.fixture(scope="module")
def stages(spark):
    outs, docs = {}, table(spark, SMALL, "documents")
    outs["in"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = outs[name] = write_table(stage(spark, docs, SMALL), f"test-{name}")
    return outs


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "mixing", "bpe"]
    assert all(stages[n].columns == stages["in"].columns for n in names[:-1])
    given = texts(stages["in"])
    kept = {r.doc_id for r in op8_quality(spark, SMALL).collect() if r.kept}
    good = texts(stages["quality"])
    assert good == {i: t for i, t in given.items() if i in kept}
    lined = texts(stages["lines"])
    assert lined == slow_lines(good)
    assert all(r.n_chars == len(r.text) for r in stages["lines"].collect())
    ids = sorted(lined)
    component = slow_components([(i, slow_fingerprint(lined[i])) for i in ids])
    single = texts(stages["near_duplicates"])
    assert single == {i: lined[i] for i, c in zip(ids, component, strict=True) if i == c}
    mixed = stages["mixing"].collect()
    sizes, taken, source = Counter(), Counter(), {r.doc_id: r.source for r in stages["near_duplicates"].collect()}
    for i, t in single.items():
        sizes[source[i]] += len(WORD.findall(t))
    for r in mixed:
        assert r.text == single[r.doc_id]
        taken[r.source] += len(WORD.findall(r.text))
    longest = max(len(WORD.findall(t)) for t in single.values())
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    assert all(abs(taken[s] - t) <= longest for s, t in slow_targets(sizes).items())
    assert sorted(r.doc_id for r in stages["bpe"].collect()) == sorted(r.doc_id for r in mixed)


def test_run_agrees_with_the_stages(spark, stages):
    got = sorted(map(str, corpus_pipeline.run(spark, SMALL).collect()))
    assert got == sorted(map(str, stages["bpe"].collect()))


def test_odd_documents(spark, docs_of):
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(1, base), (1, base), (2, base), (None, base + " end"), (3, None, None), (4, ""), (5, "y " * 40_000, "src1"), (6, base.replace("word3", "w"), None)]
    for docs in (docs_of(rows, extra=True), docs_of(rows).limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = write_table(stage(spark, docs, SMALL), f"odd-{name}")
            assert docs.columns == columns or name == "bpe"
