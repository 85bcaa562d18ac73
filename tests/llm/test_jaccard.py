"""The similarity join against brute force over all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL

from vulnsift.llm import jaccard
from vulnsift.llm.components import connected_components


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    places = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            places[g].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in places[g] if j > i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def answer(df):
    return Counter(tuple(r) for r in jaccard.near_duplicates(df).collect())


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=140)
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(200):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8, 12])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.choice([2, 5, 15, 30]))) for _ in range(150)]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(0, 8))) for _ in range(100)]
    texts += [t.upper().replace(" ", "  ") for t in rng.choices(texts, k=30)]
    return list(enumerate(texts))


@pytest.mark.parametrize("small,block", [(32, 512), (4, 32)])
def test_equals_brute_force(spark, groups, monkeypatch, small, block):
    monkeypatch.setattr(jaccard, "SMALL_LIST", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    df = spark.createDataFrame(groups, "doc_id long, text string").repartition(3)
    assert answer(df) == brute(groups)


def brute_links(rows):
    """Per row the number of other rows that link with it; the linked pairs of sets."""
    sets = [shingles(t) for _, t in rows]
    counts, pairs = [0] * len(rows), set()
    places = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            places[g].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in places[g] if j > i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                counts[i] += 1
                counts[j] += 1
                if s != sets[j]:
                    pairs.add(frozenset([s, sets[j]]))
    return Counter((d, n) for (d, _), n in zip(rows, counts)), pairs


@pytest.mark.parametrize("links,block", [(2048, 512), (40, 16)])
def test_every_link_counts(spark, groups, monkeypatch, links, block):
    monkeypatch.setattr(jaccard, "LINK_BLOCK", links)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = groups + [(1000, groups[0][1]), (1001, groups[0][1]), (None, groups[3][1]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts, want = brute_links(rows)
    got = jaccard.near_duplicates_with_links(df).collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == counts
    assert Counter(tuple(r)[:3] for r in got) == brute(rows)
    pairs, members = jaccard.linked_pairs(df)
    texts = {r["text"]: shingles(dict(rows)[r["doc_id"]]) for r in members.where("doc_id is not null").collect()}
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len(want) and {frozenset([texts[a], texts[b]]) for a, b in found} == want and all(a < b for a, b in found)


def boilerplate(n=1200, passages=60, each=6, seed=3):
    """Texts of a few of many passages in random order: no two link, nearly all share something."""
    rng = random.Random(seed)
    known = [" ".join(f"p{k}w{i}" for i in range(30)) for k in range(passages)]
    return [(d, " ".join(rng.sample(known, each))) for d in range(n)]


def test_boilerplate_meets_only_where_prefixes_do(spark, monkeypatch):
    rows = boilerplate()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen = []
    monkeypatch.setattr(jaccard, "list_shapes", lambda large, shapes=jaccard.list_shapes: seen.append(shapes(large)) or seen[-1])
    assert answer(df) == brute(rows)
    compared = seen[0][1].selectExpr("sum(size * outside)").first()[0]
    nodes = jaccard.shared_shingles(df).where("prefix is not null").select("node", "prefix").collect()
    met = defaultdict(set)
    for r in nodes:
        for k in r["prefix"]:
            met[k].add(r["node"])
    together = len({(a, b) for texts in {frozenset(t) for t in met.values()} for a in texts for b in texts if a != b})
    assert compared <= 8 * together and together < len(nodes) ** 2 / 3


def test_a_list_of_many_copies_is_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_PART", 50)
    entries = spark.range(500).selectExpr("7L as key", "500L as size", "id as node", "id % 3 as comp").unionAll(
        spark.range(500).selectExpr("9L", "500L", "id", "id % 3")
    )
    parts = jaccard._dealt(entries).groupBy("key", "part").count().agg({"count": "max"}).first()[0]
    assert parts < 100
    kept, shapes = jaccard.list_shapes(entries)
    assert kept.count() == 500 and [tuple(r) for r in shapes.collect()] == [(7, 500, 1, 333)]


def test_odd_documents(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert answer(odd_docs) == brute(rows)
    assert answer(no_docs) == Counter()


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert answer(docs) == brute([tuple(r) for r in docs.collect()])


def test_packed_keys_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000):
        keys = np.sort(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        assert jaccard.unpack_sorted(jaccard.pack_sorted(keys)).tolist() == keys.tolist()


def test_frequent_shingles_go_out_as_counts():
    chunk = jaccard._Chunk(0, 3)
    common = np.arange(5, dtype=np.uint64) << np.uint64(40)
    for i in range(jaccard.LOCAL + 6):
        chunk.add(i, np.sort(np.concatenate([common, np.array([(i + 1) << 20], np.uint64)])))
    rows = chunk.rows()
    asked = [r for r in rows if r[2] == jaccard.ENTRIES]
    counts = np.concatenate([np.frombuffer(r[5], "<u4") for r in asked])
    assert counts.tolist() == [jaccard.LOCAL + 6] * 5
    assert sum(len(jaccard.unpack_sorted(r[3])) for r in asked) == 5 + jaccard.LOCAL + 6


def test_listings_stay_out_of_the_key_ranges():
    routes = []
    for task in range(300):
        chunk = jaccard._Chunk(task << 32, 64)
        for i in range(jaccard.LOCAL + 6):
            chunk.add(i, np.array([5 << 40, (i + 6) << 40], np.uint64))
        routes += [r[0] for r in chunk.rows() if r[2] != jaccard.ENTRIES]
    assert len(routes) == len(set(routes)) == 600
    assert all(-(1 << 31) <= r < 0 for r in routes)


def test_prefix_grows_where_it_pays():
    none = np.zeros(0, np.int64)
    assert jaccard.adaptive_prefix(100, none, 12.5) == (1, 0)
    assert jaccard.adaptive_prefix(100, np.full(74, 9), 12.5)[1] == 0
    matches, length = jaccard.adaptive_prefix(100, np.full(100, 2), 12.5)
    assert length == 25 + matches and matches > 1


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tokens_begin_with_the_prefix(spark):
    """Six bytes a shingle, the greatest and the least hash too; a prefix is how they begin."""
    keys = np.array([(1 << 48) - 1, 0, 1, 1 << 47, 255], np.int64)
    packed = jaccard.pack_tokens(keys)
    assert len(packed) == 30 and jaccard.unpack_tokens(packed).tolist() == keys.tolist()
    assert jaccard.unpack_tokens(packed[:12]).tolist() == keys[:2].tolist() and not len(jaccard.unpack_tokens(b""))
    words = [f"w{i}" for i in range(80)]
    df = spark.createDataFrame([(i, " ".join(words + [f"own{i}"] * 3)) for i in range(6)] + [(7, None), (8, "one two")], "doc_id long, text string")
    rows = jaccard.shared_shingles(df).where("prefix is not null").collect()
    assert len(rows) == 6
    for r in rows:
        assert len(r["tokens"]) == 6 * r["shared"] and jaccard.unpack_tokens(r["tokens"])[: len(r["prefix"])].tolist() == r["prefix"]
