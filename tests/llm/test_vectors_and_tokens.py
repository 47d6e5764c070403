"""Hard negatives, BK-trees and token alignment against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tidepanel.llm import alignment, bktree, negatives

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- hard negatives

def python_mined(rows, every, positives=5, negatives_=3):
    whole = []
    width = max((len(v) for _, v, _ in rows if v), default=0)
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        # a null id is the last in ties
        whole.append((2**63 - 1 if i is None else i, n, [math.floor(256 * x) for x in v] + [0] * (width - len(v)), label))
    out = []
    for a, n, va, la in whole:
        if a == 2**63 - 1 or a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, vb)), b, m, lb) for b, m, vb, lb in whole if m != n)
        for s, p, _, _ in [r for r in scored if r[3] == la][:positives]:
            fits = [r for r in scored if r[3] != la and 50 * -s <= 100 * -r[0] <= 95 * -s]
            for rank, r in enumerate(fits[:negatives_], 1):
                out.append((a, p, rank, r[1], -s, -r[0]))
    return Counter(tuple(None if x == 2**63 - 1 else x for x in r) for r in out)


@pytest.mark.parametrize("shard, step", [(8192, 1024), (40, 8)])
def test_hard_negatives(spark, monkeypatch, shard, step):
    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "STEP", step)
    rnd = random.Random(11)
    near = [[rnd.gauss(0, 1) for _ in range(7)] for _ in range(6)]
    rows = [(n, [x + rnd.gauss(0, 0.4) for x in rnd.choice(near)], rnd.randint(0, 2)) for n in range(300)]
    rows += [(500 + n, near[0], n % 3) for n in range(150)]  # one vector that a third of all rows have
    rows += [(10, near[1], 0), (10, near[1], 0), (20, near[2], 1), (None, near[0], 0), (None, near[0], 1), (40, None, 1),
             (41, near[0], None), (50, [math.nan] + near[0][1:], 1), (60, [math.inf] * 7, 1), (70, [None] + near[0][1:], 1),
             (80, [], 1), (90, [0.0] * 7, 2), (100, near[3][:3], 2), (None, None, None)]
    rnd.shuffle(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]
    got = negatives.mined(table, anchors=F.col("vec_id") % 10 == 0)
    want = python_mined(as_float, 10)
    assert sum(want.values()) > 300 and Counter(tuple(r) for r in got.collect()) == want


def test_hard_negatives_odd(spark):
    kind = "vec_id long, embedding array<double>, label int, row int, shard string"
    none = spark.createDataFrame([], kind)
    assert negatives.mined(none, F.col("vec_id") % 2 == 0).count() == 0
    only = [(0, [1e30, -2.0], 1, 1, "a"), (1, [1e30, 3.0], 1, 2, "b"), (2, [0.8e30, 0.0], 2, 3, "c"), (3, [], 2, 4, None)]
    rows = spark.createDataFrame(only, kind)
    big = 2**63 - 1  # scores beyond a long end at its limit, and a window below it holds none of them
    assert [tuple(r) for r in negatives.mined(rows, F.col("vec_id") == 0).collect()] == []
    assert negatives.products(np.array([[1e30, 1.0], [-1e30, 1.0]]), np.array([1e30, 1.0])).tolist() == [big, -big]
    exact = np.array([[2.0**30 + 1, 3.0]])
    assert negatives.products(exact, np.array([2.0**30 + 1, 5.0])).tolist() == [(2**30 + 1) ** 2 + 15]


def test_multi_sequence_order():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        a, b = rnd.integers(0, 6, rnd.integers(1, 9)) / 2, rnd.integers(0, 6, rnd.integers(1, 9)) / 2
        seen = list(negatives.multi_sequence(a, b))
        assert [s for s, _, _ in seen] == sorted((x + y for x in a for y in b), reverse=True)
        assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(len(a)) for j in range(len(b))]


def test_visits_stop_when_certified():
    """Rows far from the anchor are not scored once the list is certain."""
    rnd = np.random.default_rng(4)
    vectors = np.concatenate([rnd.normal(size=(2000, 8)) + 40 * sign for sign in (1, -1)]).round()
    books = negatives.Codebooks((negatives.centres(vectors[:, :4], 8), negatives.centres(vectors[:, 4:], 8)))
    cells = []
    for n, part in enumerate(books.halves(vectors)):
        near, away = negatives.nearest(part, books.words[n])
        cells.append(near)
        np.maximum.at(books.reach[n], near, away)
    table = pa.table({"c1": cells[0], "c2": cells[1], "vec_id": np.arange(4000), "row": np.arange(4000),
                      "label": np.zeros(4000, np.int64), "vector": [v.tobytes() for v in vectors]})
    shard, scored = negatives.Shard(table, 8), []
    visit = shard.visit
    shard.visit = lambda *a: (scored.append(len(v[0])) or v for v in visit(*a))
    anchor = {"vector": vectors[0], "label": 0, "row": 0, "least": -math.inf}
    negatives.STEP, old = 50, negatives.STEP
    try:
        got = negatives.positives_in(shard, books, anchor, 5)
    finally:
        negatives.STEP = old
    scores = np.sort(vectors[1:] @ vectors[0])[::-1]
    assert [g[3] for g in got] == scores[:5].tolist() and sum(scored) <= 2000  # none of the other side


# ---- BK-trees

def python_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def python_groups(prints, radius):
    """The smallest place of each print's group."""
    codes = np.array(prints, np.uint64)
    label = np.arange(len(codes))
    pairs = [(i, j) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= radius)]
    while True:
        before = label.copy()
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if (before == label).all():
            return label


def near_prints(count, seed=3):
    rnd = random.Random(seed)
    own = [rnd.getrandbits(64) for _ in range(count)]
    for _ in range(3 * count):
        other = rnd.choice(own)
        for bit in rnd.sample(range(64), rnd.randint(1, 7)):
            other ^= 1 << bit
        own.append(other)
    return list(dict.fromkeys(own))


@pytest.mark.parametrize("blocks, tree", [(None, 2048), (5, 7), (6, 50), (8, 3)])
def test_links_of_trees(spark, blocks, tree):
    prints = near_prints(120)
    hot = 0x123456789ABCDEF0
    prints += [p for n in range(200) if (p := hot ^ (n * 0x9E3779B1 & 0xFFFF)) not in prints]  # all but 16 bits equal
    want = python_groups(prints, 4)
    table = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "print long")
    place = {int(np.uint64(p).astype(np.int64)): n for n, p in enumerate(prints)}
    label = np.arange(len(prints))
    found = [(place[x], place[y]) for x, y in bktree.links(table, 4, blocks, tree).collect()]
    assert len(found) < 40 * len(prints)
    for _ in range(len(prints)):
        before = label.copy()
        for i, j in found:
            label[i] = label[j] = min(label[i], label[j])
        if (before == label).all():
            break
    assert label.tolist() == want.tolist()


def test_trees_hold_edges_within_the_radius():
    prints = np.array(near_prints(60), np.uint64)
    group = np.arange(len(prints)) % 3
    forest = bktree.Forest(prints, group)
    assert sorted(np.concatenate([nodes for _, nodes in forest.levels])) == list(range(len(prints)))
    for radius in (0, 2, 4, 9):
        i, j = forest.near(prints, group, radius)
        gaps = np.bitwise_count(prints[:, None] ^ prints[None])
        want = np.argwhere((gaps <= radius) & (group[:, None] == group[None]))
        assert sorted(zip(i.tolist(), j.tolist())) == [tuple(w) for w in want.tolist()]


def test_bk_trees_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    prints = [python_fingerprint(t) for _, t in rows]
    label = python_groups(prints, 4)
    least = defaultdict(lambda: 2**63)
    for (d, _), n in zip(rows, label):
        least[n] = min(least[n], d)
    want = sorted((d, f"{p:016x}", least[n]) for (d, _), p, n in zip(rows, prints, label))
    assert sorted(tuple(r) for r in queries()["op12_bk_trees"](spark, "/root/testdata/sf0.01").collect()) == want


def test_bk_trees_odd(spark):
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [(1, "one two", "a", None), (1, "one two", "a", None), (None, None, None, None), (9, "", "x", 1), (None, "zz", "", 1),
            (3, long, "", 2), (4, long + " end", "", 2), (2, "ONE\ttwo", "", 2), (8, "  \n ", "", 2), (7, "É", "", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, print string, key int")
    got = sorted((tuple(r) for r in bktree.linked(table).collect()), key=str)
    zero = "0" * 16
    want = [(d, f"{python_fingerprint(t):016x}") for d, t, _, _ in rows]
    assert sorted(((r[0], r[1]) for r in got), key=str) == sorted(want, key=str)
    by = {(r[0], r[1]): r[2] for r in got}
    assert by[None, zero] == by[9, zero] == by[8, zero] == 8 and by[2, want[0][1]] == by[1, want[0][1]] == 1
    assert by[4, want[6][1]] == 3 and by[None, want[4][1]] is None
    assert bktree.linked(table.limit(0)).collect() == []


# ---- token alignment

def python_aligned(texts):
    """Groups of (ids of A, ids of B) of each text, or none; A by another library than the operator's."""
    side = Tokenizer.from_file(A)
    side.encode_special_tokens = True
    byte = alignment.byte_of_char()
    model = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        name = model.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()

    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = side.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        own_a = [bytes(byte[c] for c in side.id_to_token(i)) for i in a]
        own_b = [piece(i) for i in b]
        groups = []
        if text and b"".join(own_a) == whole and b"".join(own_b) == whole:
            ends_a, ends_b = np.cumsum([len(p) for p in own_a]).tolist(), np.cumsum([len(p) for p in own_b]).tolist()
            at_a, at_b = ({end: n for n, end in enumerate(ends, 1)} for ends in (ends_a, ends_b))
            i = j = 0
            for end in sorted(at_a.keys() & at_b.keys()):
                p, q = at_a[end], at_b[end]
                groups.append((a[i:p], b[j:q]))
                i, j = p, q
        out.append(groups)
    return out


def python_counted(rows):
    groups = python_aligned([t for _, t in rows])
    count = Counter((a[-1], b[-1]) for own in groups for a, b in own)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (d, _), own in zip(rows, groups):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        pairs = [(a[-1], b[-1]) for a, b in own]
        out.append((
            d, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(own),
            sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest() if own else "",
        ))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "a", "One  two\n\n\tthree   ", "▁x", "<s> </s> <|endoftext|> <0x41> <unk>", "漢字 かな \U0001f600‍\U0001f525 é",
    "x" * 30_000, " " * 5_000, "don't we'll I'VE", "\x00\x01\x7f\x85\xa0　", "one two three " * 20_000, "a", "12345.678 ½ ٣",
]


def test_alignment_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op13_token_alignment"](spark, "/root/testdata/sf0.01").select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(python_counted(rows))


def test_alignment_odd(spark):
    rows = [(n % 12, t) for n, t in enumerate(ODD)] + [(None, "a b"), (None, "a b"), (3, "a")]
    table = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, links string, n_a int")
    got = [tuple(r) for r in alignment.counted(table.repartition(3), A, B).select(COLUMNS).collect()]
    assert sorted(got, key=str) == sorted(python_counted(rows), key=str)
    assert alignment.counted(table.limit(0), A, B).collect() == []
    assert alignment.aligned(table.limit(0), A, B).collect() == []


def test_alignment_groups(spark):
    table = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    aligner, expected = alignment.Aligner(*alignment._files(A, B)), python_aligned(ODD)
    for row in alignment.aligned(table, A, B).collect():
        want = expected[row.doc_id]
        assert row.a_ids == [i for a, _ in want for i in a] and row.b_ids == [i for _, b in want for i in b]
        assert row.a_group == [n for n, (a, _) in enumerate(want) for _ in a]
        assert row.b_group == [n for n, (_, b) in enumerate(want) for _ in b]
        if len(row.a_ids) < 300:
            ends = [np.cumsum(aligner.width[n][ids]).tolist() if ids else [] for n, ids in enumerate((row.a_ids, row.b_ids))]
            begins = [[0, *e[:-1]] for e in ends]
            pairs = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
                     if begins[0][i] < ends[1][j] and begins[1][j] < ends[0][i]]
            assert list(zip(row.overlap_a, row.overlap_b)) == pairs


def test_linked_pairs_are_feasible():
    a, b = alignment.ByteLevel(open(A, "rb").read()).surface, alignment.Pieces(open(B, "rb").read()).surface
    pairs = alignment.feasible(a, b)
    assert len(pairs) <= sum(map(len, a)) + sum(map(len, b))
    some = random.Random(1).sample(range(len(pairs)), 2000)
    for p in pairs[some].tolist():
        x, y = a[p >> 32], b[p & 0xFFFFFFFF]
        assert x.endswith(y) or y.endswith(x)


def test_stored_links_are_small(spark, monkeypatch):
    """A row keeps its different pairs, however often it has them."""
    kept, settle = [], alignment.settle
    monkeypatch.setattr(alignment, "settle", lambda df, label: kept.append(settle(df, label)) or kept[-1])
    rows = [(1, "one two three " * 20_000), (2, None), (3, "one two"), (4, "")]
    got = alignment.counted(spark.createDataFrame(rows, "doc_id long, text string"), A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(python_counted(rows))
    size = {r.doc_id: (r.n_links, len(bytes(r.links))) for r in kept[0].select("doc_id", "n_links", "links").collect()}
    assert size[1][0] >= 60_000 and size[1][1] < 1_000 and size[2] == size[4] == (0, 0) and size[3][1] <= 4 * size[3][0]


def test_links_are_looked_up_in_parts():
    """Beside the batch, a task's memory does not follow the batch."""
    rng, size = np.random.default_rng(5), 324_300
    counts = rng.integers(0, 1_200, 10_000)
    counts[[0, 1, 2999, 9999]] = 0, 30_000, 0, 0
    links = rng.integers(0, size, counts.sum())
    links[: len(links) // 2] %= 5  # some pairs many times in a row
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(10_000)), "links": alignment._stored(links, counts, size)})
    assert len(batch.column("links").buffers()[2]) <= 4 * len(links)
    halves = [batch.slice(0, 2_500), batch.slice(2_500), batch.slice(0, 0)]
    tracemalloc.start()
    sums = alignment._sums(halves, size)
    totals = np.zeros(size, np.int64)
    totals[sums.column("pair").to_numpy()] = sums.column("n").to_numpy()
    best = totals % 3 == 0
    got = pa.Table.from_batches(list(alignment._looked(halves, totals, best)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20 < 8 * len(links)
    assert np.array_equal(totals, np.bincount(links, minlength=size))
    row = np.repeat(np.arange(10_000), counts)
    assert got["doc_id"].to_pylist() == list(range(10_000))
    assert got["n_best"].to_pylist() == np.bincount(row, best[links], 10_000).astype(int).tolist()
    assert got["count_sum"].to_pylist() == np.bincount(row, totals[links], 10_000).astype(int).tolist()
