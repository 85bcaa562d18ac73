"""N-gram Jaccard join with adaptive multi-match prefixes (operator 5)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnsift.llm.common import bounded_batches, held, map_batches, ship_package, stored
from vulnsift.llm.components import connected_components
from vulnsift.llm.pieces import mix, split

WORDS = 5
NUM, DEN = 3, 4  # a link: DEN * intersection >= NUM * union
CHUNK = 1_000_000  # shingles of one chunk of documents
CHUNK_DOCS = 60_000
LOCAL = 64  # a shingle in more texts of a chunk goes out as one count
AGGREGATE = 0xFFFF  # stands for a text's number in such a count
MOST_MATCHES = 8
ROUTES = 8  # key ranges for each shuffle partition: small groups, dealt evenly
SMALL_LIST = 32
LIST_PART = 1024  # entries of a list that one task of a join reads
BLOCK = 512
LINK_BLOCK = 2048
LINK_BYTES = 12 << 20
TOKEN_BYTES = 6  # of a shingle's 48-bit hash
_STEP = np.uint64(0x9E3779B97F4A7C15)


# --- shingle sets -----------------------------------------------------------------


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct word shingles."""
    p = split(texts, fold=True)
    h = mix(p.hashes)
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * _STEP + h[k : len(h) - words + 1 + k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(p.offsets[:-1].tolist(), p.offsets[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            value = np.uint64(b - a)
            for x in h[a:b]:
                value = np.uint64((int(value) * int(_STEP) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([value])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(keys: np.ndarray) -> int:
    """A 64-bit hash of a set: the sum of its scrambled members, with the size."""
    total = int(mix(keys ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return int(mix(np.array([(total + len(keys) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF], np.uint64)).astype(np.int64)[0])


# --- packed columns ---------------------------------------------------------------


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending whole numbers as byte planes of their differences."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([planes]) + steps.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    planes = raw[0]
    data = np.frombuffer(raw, np.uint8, offset=1).reshape(planes, -1)
    wide = np.zeros((data.shape[1], 8), np.uint8)
    wide[:, :planes] = data.T
    return np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64)


def pack_tokens(keys: np.ndarray) -> bytes:
    """48-bit numbers in their order, so that a beginning can be cut off."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def unpack_tokens(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // TOKEN_BYTES, 8), np.uint8)
    wide[:, :TOKEN_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, TOKEN_BYTES)
    return wide.view("<i8")[:, 0]


# --- document frequencies ---------------------------------------------------------

ENTRY = "route int, chunk long, kind int, keys binary, ords binary, counts binary"
HIT = "chunk long, kind int, keys binary, ords binary, counts binary"
ENTRIES, DOCUMENTS, FREQUENT = 0, 1, 2
_ENTRY_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _rows(rows: list[tuple], schema: str, types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_names(schema))


class _Chunk:
    """Documents of one chunk: distinct texts by number, their shingles, and which
    document has which text."""

    def __init__(self, number: int, routes: int):
        self.number, self.routes = number, routes
        self.docs: list[tuple[int | None, int, int, int]] = []  # id, shingles, node, text's number
        self.texts: dict[int, int] = {}
        self.keys: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, keys: np.ndarray) -> None:
        node = fingerprint(keys) if len(keys) else 0
        number = -1
        if len(keys):
            number = self.texts.setdefault(node, len(self.texts))
            if number == len(self.keys):
                self.keys.append(keys >> np.uint64(16))
                self.held += len(keys)
        self.docs.append((doc_id, len(keys), node, number))

    def full(self) -> bool:
        return self.held >= CHUNK or len(self.docs) >= CHUNK_DOCS

    def rows(self) -> list[tuple]:
        """The documents, the frequent shingles with their texts, and for every key
        range the entries (key, text) whose frequency is asked for."""
        listing = np.array([(0 if d is None else d, d is None, n, node, k) for d, n, node, k in self.docs], "<i8")
        out = [(_aside(self.number, DOCUMENTS), self.number, DOCUMENTS, b"", listing.T.tobytes(), b"")]
        if not self.keys:
            return out
        keys = np.concatenate(self.keys)
        ords = np.repeat(np.arange(len(self.keys)), [len(k) for k in self.keys]).astype("<u2")
        order = np.argsort(keys, kind="stable")
        keys, ords = keys[order], ords[order]
        begins = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        lengths = np.diff(np.append(begins, len(keys)))
        many = lengths > LOCAL
        counts = np.zeros(0, "<u4")
        if many.any():
            inside = np.repeat(many, lengths)
            out.append((_aside(self.number, FREQUENT), self.number, FREQUENT, pack_sorted(keys[inside]), ords[inside].tobytes(), b""))
            keep = ~inside
            keep[begins[many]] = True
            ords[begins[many]] = AGGREGATE
            keys, ords, counts = keys[keep], ords[keep], lengths[many].astype("<u4")
        cuts = np.searchsorted((keys * np.uint64(self.routes)) >> np.uint64(48), np.arange(self.routes + 1)) if self.routes < 1 << 16 else _wide_cuts(keys, self.routes)
        done = 0
        for route, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if b > a:
                n = int((ords[a:b] == AGGREGATE).sum())
                out.append((route, self.number, ENTRIES, pack_sorted(keys[a:b]), ords[a:b].tobytes(), counts[done : done + n].tobytes()))
                done += n
        return out


def _aside(number: int, kind: int) -> int:
    """A group beside the key ranges, for rows that no range has to read."""
    return -1 - (int(mix(np.array([(number << 2) + kind], np.uint64))[0]) >> 33)


def _wide_cuts(keys: np.ndarray, routes: int) -> np.ndarray:
    return np.searchsorted(keys, np.array([(r << 48) // routes for r in range(routes)] + [1 << 48], np.uint64))


def _entries(routes: int, words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("shingles", words, object)  # lets go of what other operators kept in this worker
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number, routes)
        for batch in bounded_batches(batches, "text"):
            for doc_id, keys in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), words)):
                chunk.add(doc_id, keys)
                if chunk.full():
                    yield _rows(chunk.rows(), ENTRY, _ENTRY_TYPES)
                    number += 1
                    chunk = _Chunk(number, routes)
        if chunk.docs:
            yield _rows(chunk.rows(), ENTRY, _ENTRY_TYPES)

    return run


def _frequencies(rows: pa.Table) -> pa.Table:
    """For one key range: the entries of shingles that occur in two or more texts,
    with that number, back to their chunks."""
    columns = {c: rows[c].to_pylist() for c in _names(HIT)}
    out, ask = [], []
    for i, kind in enumerate(columns["kind"]):
        if kind == ENTRIES:
            ask.append(i)
        else:
            out.append(tuple(columns[c][i] for c in _names(HIT)))
    if ask:
        keys = [unpack_sorted(columns["keys"][i]) for i in ask]
        ords = [np.frombuffer(columns["ords"][i], "<u2") for i in ask]
        every = np.concatenate(keys)
        weight = np.ones(len(every), np.int64)
        weight[np.concatenate(ords) == AGGREGATE] = np.concatenate([np.frombuffer(columns["counts"][i], "<u4") for i in ask])
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        begins = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]) != 0)
        sums = np.add.reduceat(weight[order], begins)
        df = np.empty(len(every), np.int64)
        df[order] = np.repeat(sums, np.diff(np.append(begins, len(ranked))))
        at = 0
        for i, own, number in zip(ask, keys, ords):
            found = df[at : at + len(own)]
            at += len(own)
            hit = found >= 2
            if hit.any():
                out.append((columns["chunk"][i], ENTRIES, pack_sorted(own[hit]), number[hit].tobytes(), found[hit].astype("<u4").tobytes()))
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_batches([_rows(out, HIT, types)])


# --- adaptive prefixes ------------------------------------------------------------

POSTING = "node long, n int, shared int, key long"
SETS = "doc_id long, n int, node long, shared int, matches int, prefix array<long>, tokens binary"


def adaptive_prefix(n: int, df: np.ndarray, verify: float) -> tuple[int, int]:
    """(matches, length): how many of a text's shared shingles, rarest first, it
    lists, and how many it must have in common there with a partner.

    A partner shares at least ceil(NUM/DEN * n) shingles. Of the first
    n - that + l in an order common to all texts it must share l. Unshared
    shingles come first and match nothing. A longer prefix reads more entries and
    asks for more matches, so fewer partners remain: the estimate is the entries of
    others read, plus ``verify`` for each of at most entries / l partners.
    """
    least = -(-NUM * n // DEN)
    base = n - least - (n - len(df))  # listed for no match
    most = min(MOST_MATCHES, least)
    if base + 1 <= 0:
        return 1, 0
    reads = np.concatenate([[0], np.cumsum(df - 1)])
    wanted = np.arange(1, most + 1)
    lengths = np.minimum(base + wanted, len(df))
    cost = reads[lengths] * (1 + verify / wanted)
    best = int(cost.argmin())
    return int(wanted[best]), int(lengths[best])


def _gather(rows: pa.Table) -> pa.Table:
    """For one chunk: each document with the shared shingles of its text."""
    columns = {c: rows[c].to_pylist() for c in _names(HIT)}
    keys, ords, dfs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    frequent: tuple[np.ndarray, np.ndarray] | None = None
    totals: list[tuple[np.ndarray, np.ndarray]] = []
    listing = np.zeros((5, 0), np.int64)
    for i, kind in enumerate(columns["kind"]):
        if kind == DOCUMENTS:
            listing = np.frombuffer(columns["ords"][i], "<i8").reshape(5, -1)
        elif kind == FREQUENT:
            frequent = unpack_sorted(columns["keys"][i]), np.frombuffer(columns["ords"][i], "<u2").astype(np.int64)
        else:
            k, o, d = unpack_sorted(columns["keys"][i]), np.frombuffer(columns["ords"][i], "<u2"), np.frombuffer(columns["counts"][i], "<u4")
            one = o != AGGREGATE
            keys.append(k[one])
            ords.append(o[one].astype(np.int64))
            dfs.append(d[one].astype(np.int64))
            totals.append((k[~one], d[~one].astype(np.int64)))
    if frequent is not None:
        at, df = np.concatenate([t[0] for t in totals]), np.concatenate([t[1] for t in totals])
        order = np.argsort(at)
        keys.append(frequent[0])
        ords.append(frequent[1])
        dfs.append(df[order][np.searchsorted(at[order], frequent[0])])
    key, owner, df = np.concatenate(keys), np.concatenate(ords), np.concatenate(dfs)
    order = np.lexsort((key, df, owner))
    key, df = key[order].astype(np.int64), df[order]
    texts = int(listing[4].max(initial=-1)) + 1
    cuts = np.searchsorted(owner[order], np.arange(texts + 1))
    done: dict[int, tuple] = {}
    out = []
    for doc, missing, n, node, k in listing.T.tolist():
        if k < 0:
            out.append((None if missing else doc, 0, None, 0, None, None, None))
            continue
        if k not in done:
            own, own_df = key[cuts[k] : cuts[k + 1]], df[cuts[k] : cuts[k + 1]]
            matches, length = adaptive_prefix(n, own_df, n / 8)
            done[k] = (len(own), matches, own[:length].tolist(), pack_tokens(own)) if length > 0 else (len(own), None, None, None)
        out.append((None if missing else doc, n, node, *done[k]))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
    return pa.Table.from_batches([_rows(out, SETS, types)])


# --- pairs ------------------------------------------------------------------------


def _can_link(a: str, b: str) -> Column:
    """Whether sizes and shared shingles of two texts leave room for a link: the
    intersection must be at least NUM / (NUM + DEN) of the sizes' sum, and lies
    within the shared shingles of either."""
    n, m = F.col(f"{a}n").cast("long"), F.col(f"{b}n").cast("long")
    least = F.least(F.col(f"{a}shared"), F.col(f"{b}shared"), n, m).cast("long")
    return least * (NUM + DEN) >= (n + m) * NUM


def _overlap(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(unpack_tokens(a), unpack_tokens(b), assume_unique=True))


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with enough common shingles in their prefixes, then in all."""
    for batch in batches:
        c = {name: batch.column(name).to_pylist() for name in batch.schema.names if name not in ("a_prefix", "b_prefix")}
        first, second = [], []
        for i in range(batch.num_rows):
            wanted = min(c["a_matches"][i], c["b_matches"][i])
            size = c["a_listed"][i] * TOKEN_BYTES, c["b_listed"][i] * TOKEN_BYTES
            if _overlap(c["a_tokens"][i][: size[0]], c["b_tokens"][i][: size[1]]) < wanted:
                continue
            both = _overlap(c["a_tokens"][i], c["b_tokens"][i])
            if DEN * both >= NUM * (c["a_n"][i] + c["b_n"][i] - both):
                first.append(c["a"][i])
                second.append(c["b"][i])
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["a", "b"])


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefix entries (node, n, shared, key) of texts (node, n, shared, listed, tokens)."""
    for batch in bounded_batches(batches, "tokens"):
        listed = batch.column("listed").to_numpy()
        keys = [unpack_tokens(t[: k * TOKEN_BYTES]) for t, k in zip(batch.column("tokens").to_pylist(), listed.tolist())]
        facts = [pa.array(np.repeat(batch.column(c).to_numpy(), listed)) for c in ("node", "n", "shared")]
        yield pa.RecordBatch.from_arrays([*facts, pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))], names=_names(POSTING))


def _links_of(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that link."""
    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "matches", "listed", "tokens")])
        pairs = pairs.join(own, side)
    return map_batches(pairs, _verified, "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each text of one side shares with each of the other, as one
    product of 0/1 matrices over the shingles that both sides have."""
    common = np.intersect1d(*[np.unique(np.concatenate(s)) for s in (left, right)])
    overlaps = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(common), 4096):
        part = common[begin : begin + 4096]
        dense = []
        for side in (left, right):
            m = np.zeros((len(side), len(part)), np.float32)
            for i, tokens in enumerate(side):
                at = np.searchsorted(part, tokens)
                ok = at < len(part)
                ok[ok] = part[at[ok]] == tokens[ok]
                m[i, at[ok]] = 1
            dense.append(m)
        overlaps += dense[0] @ dense[1].T
    return overlaps.astype(np.int64)


def _block_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between two blocks of texts, as a forest. Texts of different components
    with enough common shingles in their prefixes are candidates; only these
    are compared whole."""
    names = ["a", "b"]
    empty = pa.table([pa.array([], pa.int64())] * 2, names=names)
    if not left.num_rows or not right.num_rows:
        return empty
    sides = []
    for t in (left, right.rename_columns(left.column_names)):
        tokens = [unpack_tokens(x) for x in t["tokens"].to_pylist()]
        numbers = {c: t[c].to_numpy().astype(np.int64) for c in ("node", "comp", "n", "shared", "matches", "listed")}
        sides.append((numbers, tokens))
    (x, x_tokens), (y, y_tokens) = sides
    prefixes = [[t[:k] for t, k in zip(tokens, c["listed"].tolist())] for c, tokens in sides]
    likely = _overlaps(*prefixes) >= np.minimum(x["matches"][:, None], y["matches"][None, :])
    likely &= x["comp"][:, None] != y["comp"][None, :]
    sizes = x["n"][:, None] + y["n"][None, :]
    least = np.minimum(np.minimum(x["n"], x["shared"])[:, None], np.minimum(y["n"], y["shared"])[None, :])
    likely &= least * (NUM + DEN) >= sizes * NUM
    rows, columns = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
    if not len(rows):
        return empty
    both = _overlaps([x_tokens[i] for i in rows], [y_tokens[j] for j in columns])
    linked = likely[np.ix_(rows, columns)] & (DEN * both >= NUM * (sizes[np.ix_(rows, columns)] - both))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in np.argwhere(linked).tolist():
        a, b = int(x["node"][rows[i]]), int(y["node"][columns[j]])
        if find(a) != find(b):
            root[find(a)] = find(b)
            out.append((a, b))
    return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=names)


def _dealt(entries: DataFrame) -> DataFrame:
    """List entries (key, size, node) with the part of their list that they are dealt to."""
    return entries.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / LIST_PART)).cast("int"))


def _parts(lists: DataFrame) -> DataFrame:
    """Each list (key, size) once for every part, to join what ``_dealt`` gives: no task
    of such a join reads more than a part, however long the list."""
    return lists.withColumn("part", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("size") / LIST_PART) - 1).cast("int"))))


def list_shapes(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (key, size, node, comp) of long lists → those of lists that differ, and for each of
    these (key, size) its largest component ``main`` and the texts outside of it.

    The shingles of one passage mostly have the same texts; of such lists one is enough.
    """
    prints = large.groupBy("key", "size").agg(*[F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (0, 1)])
    kept = prints.groupBy("size", "x0", "x1").agg(F.min("key").alias("key")).select("key", "size")
    entries = stored(_dealt(large).join(_parts(kept).drop("size"), ["key", "part"]).drop("part"), "members")
    sizes = entries.groupBy("key", "size", "comp").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key", "size").agg(F.max(F.struct("n", "comp")).alias("main"))
    return entries, main.select("key", "size", F.col("main.comp").alias("main"), (F.col("size") - F.col("main.n")).alias("outside"))


def _rest_of_large_lists(large: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links among texts that meet in lists of more than SMALL_LIST texts (key, size,
    node, comp). In each list the texts outside its largest component meet all texts, in
    blocks, so only texts with a common prefix shingle are held against each
    other, no pair across components is left out, and a list never lies in one task."""
    entries, shapes = list_shapes(large)
    shapes = shapes.where("outside > 0").withColumns(
        {"blocks": F.ceil(F.col("size") / BLOCK).cast("int"), "out_blocks": F.ceil(F.col("outside") / BLOCK).cast("int")}
    )
    facts = ["n", "shared", "matches", "listed", "tokens"]
    met = _dealt(entries).join(_parts(shapes).drop("size"), ["key", "part"])
    dealt = met.join(nodes.select("node", *facts), "node")
    hashed = F.xxhash64("node")
    to = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    outside = dealt.where("comp <> main").withColumn("x", F.pmod(hashed, F.col("out_blocks")).cast("int")).withColumn("y", to("blocks"))
    inside = dealt.withColumn("y", F.pmod(hashed, F.col("blocks")).cast("int")).withColumn("x", to("out_blocks"))
    columns = ["key", "x", "y", "node", "comp", *facts]
    other = [f"i_{c}" for c in columns]
    left, right = outside.select(columns), inside.select(columns).toDF(*other)
    return left.groupBy(columns[:3]).cogroup(right.groupBy(other[:3])).applyInArrow(_block_links, "a long, b long")


# --- all links of the classes ------------------------------------------------------

LINKED = "a long, b long, n_links long"


def _linked_group(rows: list[tuple], x: int, y: int, pairs: bool) -> Iterator[pa.RecordBatch]:
    """Of the texts (node, block, n, copies, tokens) of two blocks x <= y: the links
    between the blocks as (a, b), or per text as (a, null, copies linked with)."""
    left = [r for r in rows if r[1] == x]
    right = left if x == y else [r for r in rows if r[1] == y]
    counts = [np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)]
    for i in range(0, len(left), BLOCK):
        for j in range(i if x == y else 0, len(right), BLOCK):
            sides = left[i : i + BLOCK], right[j : j + BLOCK]
            both = _overlaps(*[[unpack_tokens(r[4]) for r in s] for s in sides])
            n, m = (np.array([r[2] for r in s], np.int64) for s in sides)
            linked = DEN * both >= NUM * (n[:, None] + m[None, :] - both)
            same = x == y and i == j
            if same:
                linked = np.triu(linked, 1)
            if pairs:
                nodes = [np.array([r[0] for r in s], np.int64) for s in sides]
                for k in range(len(nodes[0])):  # a text's links at a time
                    b = nodes[1][linked[k]]
                    if len(b):
                        a = np.full(len(b), nodes[0][k])
                        yield _linked_rows(np.minimum(a, b), np.maximum(a, b), None)
                continue
            copies = [np.array([r[3] for r in s], np.int64) for s in sides]
            counts[0][i : i + BLOCK] += linked @ copies[1]
            counts[0 if x == y else 1][j : j + BLOCK] += copies[0] @ linked
    if not pairs:
        sides = [left] if x == y else [left, right]
        for side, count in zip(sides, counts):
            some = count > 0
            yield _linked_rows(np.array([r[0] for r in side], np.int64)[some], None, count[some])


def _linked_rows(a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) if c is not None else pa.nulls(len(a), pa.int64()) for c in (a, b, n)]
    return pa.RecordBatch.from_arrays(columns, names=_names(LINKED))


def _linked(pairs: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("comp", "x", "y", "node", "own", "n", "copies", "tokens")]
            for comp, x, y, *row in zip(*columns):
                if group != (comp, x, y):
                    if rows:
                        yield from _linked_group(rows, *group[1:], pairs)
                    group, rows = (comp, x, y), []
                rows.append(tuple(row))
        if rows:
            yield from _linked_group(rows, *group[1:], pairs)

    return run


def _links_in_classes(sets: DataFrame, nodes: DataFrame, comps: DataFrame, pairs: bool) -> DataFrame:
    """Every link between different texts: both lie in one class, so each class
    compares all its texts, large ones in pairs of blocks of LINK_BLOCK texts or
    LINK_BYTES of shingles. The groups of a task come one after the other."""
    copies = sets.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"))
    facts = nodes.select("node", "n", "tokens").join(comps, "node").join(copies, "node")
    sizes = nodes.select("node", F.octet_length("tokens").alias("bytes")).join(comps, "node").groupBy("comp").agg(F.count("*").alias("size"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("size") / LINK_BLOCK, F.col("bytes") / LINK_BYTES)).cast("int")
    shape = sizes.where("size > 1").select("comp", F.greatest(blocks, F.lit(1)).alias("blocks"))
    own = facts.join(shape, "comp").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("comp", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "own", "n", "copies", "tokens")
    return map_batches(dealt.repartition("comp", "x", "y").sortWithinPartitions("comp", "x", "y"), _linked(pairs), LINKED)


def shared_shingles(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n (distinct shingles), node (its set), and of
    texts that may have a partner the shingles shared with other texts."""
    routes = ROUTES * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    entries = map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), _entries(routes, words), ENTRY)
    hits = entries.groupBy("route").applyInArrow(_frequencies, HIT)
    return hits.groupBy("chunk").applyInArrow(_gather, SETS)


def _classes(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows (doc_id, n_shingles, component_id, node), the sets of all rows, the
    texts that may have a partner, and the component of each linked text."""
    # The prefix is how the tokens begin, so its length is enough.
    listed = F.when(F.col("prefix").isNotNull(), F.size("prefix")).alias("listed")
    sets = stored(shared_shingles(docs, words).select("doc_id", "n", "node", "shared", "matches", listed, "tokens"), "sets")
    # Null tokens: no shared shingle in the prefix, hence no partner.
    nodes = sets.where("tokens is not null").dropDuplicates(["node"])
    nodes = stored(nodes.select("node", "n", "shared", "matches", "listed", "tokens"), "nodes")
    postings = map_batches(nodes.select("node", "n", "shared", "listed", "tokens"), _postings, POSTING)
    lists = postings.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct((F.col("n") - F.col("shared")).alias("alone"), "node", "n", "shared")).alias("p")).where("size > 1")
    lists = lists.select("key", "size", F.col("p.node").alias("p_node"), F.col("p.n").alias("p_n"), F.col("p.shared").alias("p_shared"))
    met = stored(postings.join(lists, "key"), "lists")
    own = met.withColumnRenamed("n", "q_n").withColumnRenamed("shared", "q_shared")
    pairs = own.where(F.col("node") != F.col("p_node")).where(_can_link("q_", "p_")).select(F.col("p_node").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_links_of(pairs, nodes), "links")
    comps = connected_components(links)

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    open_ = labelled(met.select("key", "size", "node", "n", "shared"))
    mixed = open_.groupBy("key", "size").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key", "size")
    rest = stored(_dealt(open_).join(_parts(mixed).drop("size"), ["key", "part"]).drop("part"), "rest")
    short = rest.where(F.col("size") <= SMALL_LIST)
    left = short.select("key", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "shared", "comp")])
    right = short.select(F.col("key").alias("y_key"), *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "shared", "comp")])
    across = (F.col("key") == F.col("y_key")) & (F.col("x_node") < F.col("y_node")) & (F.col("x_comp") != F.col("y_comp")) & _can_link("x_", "y_")
    more = left.join(right, across).select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()
    found = stored(_links_of(more, nodes), "links")
    all_links = links.unionByName(found)
    large = rest.where(F.col("size") > SMALL_LIST)
    if not large.isEmpty():
        all_links = all_links.unionByName(stored(_rest_of_large_lists(large.select("key", "size", "node", "comp"), nodes), "links"))
    comps = connected_components(all_links)
    least = labelled(sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc"))).select("node", "comp", "doc")
    named = least.groupBy("comp").agg(F.min("doc").alias("component_id"))
    names = least.join(named, "comp").select("node", "component_id")
    rows = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "node")
    named_rows = rows.join(names, "node", "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "node")
    return named_rows, sets, nodes, comps


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Classes of texts whose shingle sets have a Jaccard similarity of 0.75 or more,
    directly or through others: doc_id, n_shingles, component_id, one row for each
    row of ``docs`` (doc_id, text).

    A-Z count as a-z; words lie between white space. A text of fewer words than a
    shingle has its whole sequence as one; without words it is empty and links with
    nothing. ``component_id`` is the least doc_id of the class. Texts of one set,
    repeated rows included, are one node from the start and need no pairs. A null
    id takes the least id of its class, or null if there is none. An empty table
    gives no rows; other columns are ignored.

    1. Chunks of documents ask for the document frequency of each shingle. Only
       shingles of two or more texts come back, and only texts with such shingles
       in their prefix go on, with as long a prefix as their costs suggest.
    2. Each prefix entry's list compares its texts with one of them, the one with
       fewest shingles of its own. Most classes are complete after that.
    3. Lists that still hold texts of several components compare these: pairs
       in short lists, blocks in long ones. Candidates have the wanted number of
       common shingles in their prefixes; only they are compared whole.
    """
    return _classes(docs, words)[0].drop("node")


def near_duplicates_with_links(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``near_duplicates`` with n_links: how many other rows have a text
    that links with the row's own, copies (texts of one set) counted each. A text
    without words has none."""
    rows, sets, nodes, comps = _classes(docs, words)
    found = _links_in_classes(sets, nodes, comps, False).groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("others"))
    copies = sets.where("node is not null").groupBy("node").agg((F.count("*") - 1).alias("same"))
    counts = stored(copies.join(found, "node", "left").select("node", (F.col("same") + F.coalesce("others", F.lit(0))).alias("n_links")), "counts")
    return rows.join(counts, "node", "left").select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def linked_pairs(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """The links themselves: every pair (a, b) of different texts that link, a < b,
    once; and the membership (text, doc_id), one row for each row of ``docs`` with
    words. A text is named by a hash of its shingle set."""
    _, sets, nodes, comps = _classes(docs, words)
    return _links_in_classes(sets, nodes, comps, True).select("a", "b"), sets.where("node is not null").select(F.col("node").alias("text"), "doc_id")
