"""Lines whose words share 32-bit hashes."""

from pyspark.sql import functions as F

from odd_tables import docs_of  # noqa: E402,F401
from vigil.llm.linededup import line_dedup, removed_lines

CLASHES = [("w254943", "w267111"), ("w70601", "w210596"), ("w214580", "w230738")]


def test_words_with_one_hash_are_different_words(spark, docs_of):
    for a, b in CLASHES:
        row = spark.range(1).select(F.hash(F.lit(a)).alias("a"), F.hash(F.lit(b)).alias("b")).first()
        assert row.a == row.b
    shared = " ".join(f"same{i}" for i in range(6))
    one, two = (f"{shared} {' '.join(c[k] for c in CLASHES)}" for k in (0, 1))
    docs = docs_of([(1, one), (2, two), (3, one + " more"), (4, f"{CLASHES[0][0]} {CLASHES[0][1]} {shared}"), (5, f"{CLASHES[0][1]} {CLASHES[0][0]} {shared} x")])
    assert sorted((r.d, r.exact) for r in removed_lines(docs).collect()) == [(3, False), (5, False)]
    assert {r.doc_id: r.text for r in line_dedup(docs).collect()}[2] == two
