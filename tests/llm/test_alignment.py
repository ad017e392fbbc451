"""Cross-tokenizer alignment against brute force on whole texts."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from odd_tables import docs_of  # noqa: E402,F401
from vigil.llm.alignment import FIRST, SECOND, Aligner, align_tokens, hot_pairs, link_counts, op13_alignment, pair_counts
from vigil.llm.bpe import byte_alphabet, tokenizer_path
from vigil.llm.common import table
from vigil.session import write_table

SMALL = "/root/testdata/sf0.001"
ODD = ["", None, " ", "  two  blanks ", "a\n b\t c\n\nd ", "no<|endoftext|>special </s><s> <unk> <0x41>", "a▁b is not given back", "é è ñ ß 漢字かな交じり文 👩‍👩‍👧 ́x",
       "x" * 30_000, "a " * 5_000, " " * 3_000, "漢字" * 2_000, "it's we'll THEY'RE 3.14 (x) [y] {z}\r\nend", "\x00\x01 ﻿   z", "same text here", "same text here",
       "tail blank \n", "\nhead", "a .b ,c!? d…e … f", "ﬁne ½ ™ Å Å"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(tokenizer_path(FIRST))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(SECOND))
    byte = {c: i for i, c in enumerate(byte_alphabet())}

    def tokens(text):
        """Ids and bytes of both, each text tokenized whole by the libraries."""
        if not text:
            return [], []
        x = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
        raw = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == b"".join(t for _, t in y) == raw else ([], [])
    return tokens


def spans(tokens):
    at, out = 0, []
    for i, t in tokens:
        out.append((at, at + len(t), i))
        at += len(t)
    return out


def slow(tools, texts):
    rows, counts = [], Counter()
    for text in texts:
        a, b = map(spans, tools(text))
        links, k = [], 0
        for s, e, i in a:
            while k and b[k - 1][1] > s:
                k -= 1
            while k < len(b) and b[k][0] < e:
                if b[k][1] > s:
                    links.append((i, b[k][2]))
                k += 1
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [([], []) for _ in ends]
        for side, held in ((0, a), (1, b)):
            g = 0
            for _, e, i in held:
                while ends[g] < e:
                    g += 1
                groups[g][side].append(i)
        rows.append((len(a), len(b), groups, links))
        counts.update(set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for n_a, n_b, groups, links in rows:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def test_given_table(spark, tools):
    docs = table(spark, SMALL, "documents").collect()
    want = sorted((r.doc_id, *x) for r, x in zip(docs, slow(tools, [r.text for r in docs]), strict=True))
    assert sorted(map(tuple, op13_alignment(spark, SMALL).collect())) == want


@pytest.mark.parametrize("limit", [1 << 18, 40, 0])
def test_odd_texts_and_any_number_of_hot_pairs(spark, tools, docs_of, limit):
    """Null and repeated ids, equal rows, clashing columns; the pairs are looked up, joined, or both."""
    ids = [None if i % 7 == 3 else i // 2 for i in range(len(ODD))]
    docs = docs_of(list(zip(ids, ODD, strict=True)), extra=True).repartition(3)
    aligned = write_table(align_tokens(docs, tokenizer_path(FIRST), tokenizer_path(SECOND)).selectExpr(
        "*", "monotonically_increasing_id() as row"), "test-alignment")
    counts = pair_counts(aligned)
    assert len(hot_pairs(counts, limit)[0]) <= limit
    got = link_counts(aligned, counts, limit).collect()
    want = [(i, *x) for i, x in zip(ids, slow(tools, ODD), strict=True)]
    made = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in got]
    assert sorted(made, key=str) == sorted(want, key=str)
    assert sum(r.n_a == 0 for r in got) >= 3


def test_empty_table(spark, docs_of):
    docs = docs_of([(1, "x")]).limit(0)
    aligned = write_table(align_tokens(docs, tokenizer_path(FIRST), tokenizer_path(SECOND)).selectExpr("*", "monotonically_increasing_id() as row"), "test-alignment")
    assert link_counts(aligned, pair_counts(aligned)).count() == 0


def test_kept_windows_change_nothing(tools):
    """A table that holds next to nothing, and whole texts instead of runs, give the same."""
    texts = [t for t in ODD if t] * 2
    own, small, whole = (Aligner(tokenizer_path(FIRST), tokenizer_path(SECOND)) for _ in range(3))
    assert own.by_runs
    small.runs.limit = small.kept.limit = 1
    whole.by_runs = False
    plain = [[(a, b, g, n.tolist(), t) for a, b, g, n, t in x.align(texts)] for x in (own, small, whole)]
    assert plain[0] == plain[1] == plain[2] and [[*x[:3], *x[3:]] for x in own.align(texts)][0][0] == plain[0][0][0]
