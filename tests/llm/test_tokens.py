"""Tokenised operators against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF_SMALL
from tokenizers import Tokenizer

from vulnsift.llm import bytebpe, packing, tokenfiles
from vulnsift.llm.common import shared_path
from vulnsift.llm.queries import BYTE_BPE, WORD_BPE, op2_token_files, op7_byte_bpe, op9_packing
from vulnsift.llm.wordbpe import WordBpe

END = 1


@pytest.fixture(scope="module")
def word_ids():
    tok = Tokenizer.from_file(WORD_BPE)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def byte_ids():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=bytebpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: enc.encode_ordinary(text or "")


def noise(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices("abT \n\t'ts.é1ß-_ \xa0ñÉ日", k=rng.randint(0, 60))) for _ in range(n)]


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_word_ids_equal_the_library(word_ids, odd_docs):
    texts = noise(800, 1) + [t for _, t in rows_of(odd_docs)]
    flat, offsets = WordBpe(WORD_BPE).encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [word_ids(t) for t in texts]


def test_word_ids_survive_a_full_table(word_ids):
    bpe = WordBpe(WORD_BPE)
    bpe.table.limit = 50
    for seed in range(4):
        texts = noise(40, seed)
        flat, offsets = bpe.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [word_ids(t) for t in texts]


def test_byte_ids_equal_the_library(byte_ids, odd_docs):
    rng = random.Random(5)
    texts = noise(1500, 2) + [t for _, t in rows_of(odd_docs)] + ["".join(rng.choices("abcdefthing", k=3000)), "ab" * 4000, " \n \n\n  x", "x  "]
    flat, offsets = bytebpe.ByteBpe(BYTE_BPE).encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [byte_ids(t) for t in texts]


def test_rank_queue_gives_lowest_first():
    q = bytebpe.RankQueue(50_000)
    rng = random.Random(3)
    pushed = [(rng.randrange(50_000), rng.randrange(10**6)) for _ in range(3000)]
    for r, p in pushed:
        q.push(r, p)
    want = defaultdict(list)
    for r, p in pushed:
        want[r].append(p)
    for r in sorted(want):
        assert q.lowest() == r
        assert list(q.take(r)) == sorted(want[r])
    assert q.lowest() == -1


LONG_WORD = """
import random, resource, sys
sys.path.insert(0, {root!r})
from vulnsift.llm import bytebpe
from vulnsift.llm.queries import BYTE_BPE
import pyarrow as pa
bpe = bytebpe.ByteBpe(BYTE_BPE)
bpe.encode(pa.array(["warm up"]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = "".join(random.Random(5).choices("etaoinshrdlucmfwypvbgkjqxz", k={size}))
ids, _ = bpe.encode(pa.array([text]))
assert bpe.decode(ids) == text.encode()
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""


def test_a_long_pre_token_fits_in_memory():
    size, root = 8 << 20, str(Path(__file__).resolve().parents[2])
    grown = float(subprocess.run([sys.executable, "-c", LONG_WORD.format(root=root, size=size)], check=True, capture_output=True, text=True).stdout)
    print(f"{size >> 20} MB in one pre-token: {grown:.0f} MB")
    assert grown < 400


def packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def test_byte_ids_and_round_trip(spark, odd_docs, no_docs, byte_ids):
    decoded = bytebpe.decode_documents(bytebpe.encode_documents(odd_docs, BYTE_BPE), BYTE_BPE)
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["bytes"])) for r in decoded.collect())
    assert got == Counter((d, packed(byte_ids(t)), (t or "").encode()) for d, t in rows_of(odd_docs))
    assert bytebpe.decode_documents(bytebpe.encode_documents(no_docs, BYTE_BPE), BYTE_BPE).count() == 0


def test_queries_derive_their_digests(spark, word_ids, byte_ids):
    docs = rows_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    want = {(d, len(i), hashlib.sha256(packed(i)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t in docs for i in [byte_ids(t)]}
    assert {tuple(r) for r in op7_byte_bpe(spark, SF_SMALL).collect()} == want
    rows = sorted(op2_token_files(spark, SF_SMALL).collect())
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows] == [(d, len(i), crc(i)) for d, t in sorted(docs) for i in [[*word_ids(t), END]]]
    pieces = op9_packing(spark, SF_SMALL).collect()
    ids = {d: [*word_ids(t), END] for d, t in docs}
    assert all(r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]) for r in pieces)


def check_files(got, docs, word_ids):
    docs = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    rows = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [d for d, _ in docs]
    at = 0
    pool = defaultdict(list)
    for d, t in docs:
        ids = [*word_ids(t), END]
        pool[d].append((len(ids), packed(ids)))
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        pool[r["doc_id"]].remove((r["n_tokens"], bytes(r["ids"])))


def test_token_files(spark, odd_docs, no_docs, word_ids):
    folder = shared_path(spark, "t")
    tokenfiles.write_token_files(odd_docs, folder, WORD_BPE, container_bytes=200)
    check_files(tokenfiles.read_token_files(spark, folder).collect(), rows_of(odd_docs), word_ids)
    assert tokenfiles.read_document(spark, folder, 9) == [*word_ids(" ".join([f"Wort{i}" for i in range(40)] * 500)), END]
    assert tokenfiles.read_document(spark, folder, 99) is None
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in tokenfiles.read_token_files(spark, folder).collect()}
    assert ids[8] == [*word_ids("x" * 30_000), END]
    empty = shared_path(spark, "t")
    tokenfiles.write_token_files(no_docs, empty, WORD_BPE)
    assert tokenfiles.read_token_files(spark, empty).count() == 0


def test_token_files_share_a_trained_dictionary(spark, word_ids):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    folder = shared_path(spark, "t")
    tokenfiles.write_token_files(docs, folder, WORD_BPE)
    check_files(tokenfiles.read_token_files(spark, folder).collect(), rows_of(docs), word_ids)
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"])
    content = bytes(spark.read.parquet(f"{folder}/shards").first()["content"])
    assert dictionary and tokenfiles.Reader(content, dictionary)
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfiles.Reader(content, dictionary + b"x")


def check_packing(rows, docs, word_ids, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for rows_ in sequences.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    want = Counter()
    for d, t in docs:
        ids = [*word_ids(t), END]
        want[d] += len(ids)
    assert {d: sum(r["length"] for r in p) for d, p in pieces.items()} == dict(want)
    for d, t in docs:
        ids = [*word_ids(t), END]
        for r in pieces[d]:
            if r["doc_tokens"] == len(ids) and Counter(x for x, _ in docs)[d] == 1:
                assert bytes(r["ids"]) == packed(ids[r["start"] : r["start"] + r["length"]])


@pytest.mark.parametrize("capacity,group", [(64, 500), (2048, 1 << 20)])
def test_packing(odd_docs, no_docs, word_ids, capacity, group):
    rows = packing.pack_documents(odd_docs, WORD_BPE, capacity=capacity, group_tokens=group).collect()
    check_packing(rows, rows_of(odd_docs), word_ids, capacity)
    assert packing.pack_documents(no_docs, WORD_BPE).count() == 0


def test_packing_balances_cost():
    rng = random.Random(2)
    lengths = [rng.choice([5, 40, 300, 2000, 9000]) for _ in range(400)]
    rows = packing.pack(lengths, 2048)
    cost, fill = defaultdict(float), Counter()
    for _, _, n, k, _ in rows:
        cost[k] += packing.piece_cost(n, 1.0, 1 / 1024)
        fill[k] += n
    full = [cost[k] for k in fill if fill[k] == 2048]
    short = sum(1 for n in lengths if n < 2048)
    one_by_one = packing.piece_cost(2048, 1.0, 1 / 1024)
    assert max(full) <= one_by_one + 1e-6 and short
    assert sum(fill.values()) == sum(lengths)
    assert packing.pack([], 2048) == [] and packing.pack([0, 0], 8) == []


def test_groups_pool_what_they_have_left(spark, word_ids):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = packing.pack_documents(docs.repartition(60), WORD_BPE, capacity=256).collect()
    check_packing(rows, rows_of(docs), word_ids, 256)
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    short = sum(1 for n in fill.values() if n < 256)
    assert short <= 8 and len(fill) > 300  # one pool: a sequence for each bit of the rest
    few = packing.pack_documents(docs.repartition(60), WORD_BPE, capacity=256, group_tokens=3000).collect()
    check_packing(few, rows_of(docs), word_ids, 256)
