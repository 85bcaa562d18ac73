"""Token alignment against a plain walk over all tokens with the libraries."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from vulnsift.llm import alignment
from vulnsift.llm.common import stored
from vulnsift.llm.queries import BYTE_BPE_JSON, PIECE_BPE, op12_token_alignment
from vulnsift.llm.wordbpe import byte_letters

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def tokens():
    """Ids and bytes of the tokens of both libraries for a whole text."""
    a = Tokenizer.from_file(BYTE_BPE_JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    byte_of = {chr(c): x for x, c in byte_letters().items()}

    def of(text):
        whole = (" " + text).encode()
        x, y = a.encode(" " + text, add_special_tokens=False), b.encode(text)
        xs = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(x.ids, x.tokens)]
        ys = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, b.id_to_piece(i)) for i in y)]
        same = b"".join(t for _, t in xs) == whole == b"".join(t for _, t in ys)
        return (xs, ys) if same and text else ([], [])

    return of


def ends(tokens):
    at = 0
    for i, t in tokens:
        at += len(t)
        yield at, i


def plain(rows, tokens):
    """Every column by its definition."""
    links, seen, counts = {}, [], Counter()
    for doc_id, text in rows:
        xs, ys = tokens(text or "")
        ea, eb = defaultdict(list), defaultdict(list)
        for e, i in ends(xs):
            ea[e].append(i)
        for e, i in ends(ys):
            eb[e].append(i)
        cuts = sorted(ea.keys() & eb.keys())
        pairs = [(i, j) for e in cuts for i in ea[e] for j in eb[e]]
        groups = [([], []) for _ in cuts]
        for side, tokens_of in enumerate((xs, ys)):
            for e, i in ends(tokens_of):
                groups[bisect_left(cuts, e)][side].append(str(i))
        text_of = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        counts.update(pairs)
        seen.append((doc_id, len(xs), len(ys), len(cuts), pairs, hashlib.sha256(text_of.encode()).hexdigest() if xs else ""))
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (d, a, b, g, len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest)
        for d, a, b, g, pairs, digest in seen
    ]


def by_operator(docs):
    aligned = alignment.align_documents(docs, BYTE_BPE_JSON, PIECE_BPE)
    kept = stored(aligned, "aligned")
    found = alignment.with_link_counts(kept, ["doc_id", "n_a", "n_b", "n_groups", "groups"])
    return [
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
        for r in found.collect()
    ]


def noise(n, seed):
    rng = random.Random(seed)
    signs = ["a", "b", "the", " ", "  ", "   ", "\n", "\t", " \n ", ".", "'s", "é", "ß ", "\xa0", "\xa0  ", "　", "日本", "🙂", "▁", "ﬁ", "<s>", "<|endoftext|>", "1", "£", "́", "­", "\r\n"]
    return ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(n)]


def differences(found, expected):
    """The first few rows that only one side has (a whole diff would take minutes)."""
    x, y = Counter(found), Counter(expected)
    return list((x - y).elements())[:3], list((y - x).elements())[:3]


NONE = ([], [])


def test_odd_and_random_texts(spark, odd_docs, tokens):
    texts = [(10_000 + i, t) for i, t in enumerate(noise(1500, 5))]
    docs = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame(texts, "doc_id long, text string")).repartition(4)
    rows = [tuple(r) for r in docs.collect()]
    assert differences(by_operator(docs), plain(rows, tokens)) == NONE


def test_query_over_the_whole_table(spark, tokens):
    found = op12_token_alignment(spark, SF_SMALL)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [(r.doc_id, *[r[c] for c in COUNTS], r.groups_sha256) for r in found.collect()]
    assert differences(got, plain(rows, tokens)) == NONE


def test_empty_table_and_clashing_columns(spark, no_docs, tokens):
    assert by_operator(no_docs) == []
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_a long, block string")
    assert by_operator(docs) == plain([(1, "a b")], tokens)


@pytest.mark.parametrize("n_a, n_b", [(1, 1), (40, 1), (200, 170), (3000, 2500)])
def test_cuts_are_all_shared_ends(n_a, n_b):
    rng = np.random.default_rng(n_a + n_b)
    for _ in range(20):
        at, all_a, all_b = 0, [], []
        off_a, off_b = [0], [0]
        for _ in range(5):  # texts one after another, one without tokens
            size = int(rng.integers(0, 4)) and 10 * max(n_a, n_b)
            if size:
                for n, out in ((n_a, all_a), (n_b, all_b)):
                    out += sorted({*(at + rng.choice(np.arange(1, size), min(n, size - 1), replace=False)).tolist(), at + size})
                at += size
            off_a.append(len(all_a))
            off_b.append(len(all_b))
        if not all_a:
            continue
        a, b = np.asarray(all_a), np.asarray(all_b)
        cut_a, cut_b = alignment.shared_cuts(a, b, np.asarray(off_a), np.asarray(off_b))
        shared = np.intersect1d(a, b)
        assert a[cut_a].tolist() == shared.tolist() == b[cut_b].tolist()


def test_a_long_text_without_a_cut():
    a, b = np.arange(1, 400_000, 2), np.arange(2, 400_001, 2)
    a = np.append(a, 400_000)
    cut_a, cut_b = alignment.shared_cuts(a, b, np.asarray([0, len(a)]), np.asarray([0, len(b)]))
    assert cut_a.tolist() == [len(a) - 1] and cut_b.tolist() == [len(b) - 1]
