"""Suffix-array dedup, n-gram join, SimHash, SentencePiece, context trees and page text against brute force."""

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from __spark_entry__ import queries
from tidepanel.llm import ctw, exchange, graph, ngram_join, pages, pieces, simhash, suffixes
from tidepanel.llm.vector import gram_hashes, text_bytes, word_bounds, word_hashes

NULL = -(2**63)
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, empty, repeated and very long texts, and columns named as the operators name theirs."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [(1, "one two", 1, "a", None), (1, "one two", 1, "a", None), (None, None, None, None, None),
            (None, "x", 2, "b", None), (2, "", 3, "c", None), (3, long, 4, "d", 5), (4, long + " end", 5, "e", 6),
            (4, "One  Two", 1, "a", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, _batch int, others string, n_chars long")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- suffix arrays

def test_suffix_array_order():
    rnd = random.Random(3)
    for _ in range(150):
        n, letters = rnd.randint(1, 300), rnd.choice([1, 2, 3, 20])
        text = np.array([rnd.randint(1, letters) for _ in range(n)] + [0], np.uint8)
        text[[rnd.randint(0, n) for _ in range(rnd.randint(0, 4))]] = 0
        order = suffixes.suffix_array(text, 56)
        assert sorted(order) == list(range(n + 1))
        data = text.tobytes()
        parts = [data[i : i + 56].ljust(56, b"\0") for i in order]
        assert all(a <= b for a, b in zip(parts, parts[1:]))


def python_repeats(docs, length=50):
    first = {}
    number = [NULL if d is None else d for d, _ in docs]
    for d, (_, t) in zip(number, docs):
        body = (t or "").encode()
        for i in range(len(body) - length + 1):
            first[body[i : i + length]] = min(first.get(body[i : i + length], 2**63), d)
    out = []
    for d, (own, t) in zip(number, docs):
        body = (t or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - length + 1):
            if first[body[i : i + length]] < d:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((own, len(body), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), kept))
    return out


@pytest.mark.parametrize("hot", [20_000, 1, 0])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "batched", lambda docs: exchange.batched(docs, size=3000))
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abcdé ") for _ in range(400)) for _ in range(5)]
    docs = []
    for _ in range(90):
        text = "".join(rnd.choice("xyzwé ") for _ in range(rnd.randint(0, 150)))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, 300)
            text += rnd.choice(base)[at : at + rnd.randint(20, 200)] + "".join(rnd.choice("pq") for _ in range(rnd.randint(0, 5)))
        docs.append((rnd.randint(0, 150), text))
    docs += [(None, base[0]), (None, None), (5, ""), (7, "a" * 500), (9, "a" * 300), (1000, docs[3][1]),
             (1000, docs[3][1]), (1001, docs[3][1]), (1002, "ab" * 100), (1003, "ba" * 90)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = python_repeats(docs)
    got = [tuple(r)[:5] for r in suffixes.repeats(rows, hot=hot).collect()]
    assert sorted(got, key=str) == sorted([(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in want], key=str)
    texts = [tuple(r) for r in suffixes.without_repeats(rows, hot=hot).collect()]
    clean = [(w[0], None if t is None else w[4].decode("utf-8", "ignore")) for w, (_, t) in zip(want, docs)]
    assert sorted(texts, key=str) == sorted(clean, key=str)


def test_repeats_keep_columns(odd):
    out = suffixes.without_repeats(odd)
    assert out.schema == odd.schema
    rows = {(r.doc_id, r.others): r for r in out.collect()}
    assert out.count() == odd.count() and rows[4, "e"].text == " end"[-len(rows[4, "e"].text):]
    assert rows[4, "e"].n_chars == len(rows[4, "e"].text) and rows[None, None].text is None


# ---- n-gram join

def python_components(docs, size=4, percent=85):
    sets = []
    for _, t in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        groups[root(i)].append(d)
    return [(d, len(s), min((x for x in groups[root(i)] if x is not None), default=None))
            for i, ((d, _), s) in enumerate(zip(docs, sets))]


def test_join(spark, monkeypatch, odd):
    monkeypatch.setattr(ngram_join, "batched", lambda docs: exchange.batched(docs, size=20_000))
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 10, 40, 120]))]
        for _ in range(rnd.choice([1, 2, 5, 30])):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            docs.append((len(docs) * 3 % 997, " ".join(text).upper() if rnd.random() < 0.1 else "\n".join(text)))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "One  TWO"), (2005, docs[0][1])]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r)[:3] for r in ngram_join.linked(rows).collect())
    assert got == sorted(python_components(docs))
    kept = {r.doc_id for r in ngram_join.one_of_each(rows).collect()}
    assert kept == {d for d, _, c in got if d == c}
    few = [(r.doc_id, r.text) for r in odd.collect()]
    got = [tuple(r)[:3] for r in ngram_join.linked(odd).collect()]
    assert sorted(got, key=str) == sorted(python_components(few), key=str)
    assert ngram_join.one_of_each(odd).columns == odd.columns


@pytest.mark.parametrize("part", [3, 1000])
def test_members_meet_once(spark, monkeypatch, part):
    """All pairs of a token's group, each once, also where the group is cut into parts; no part grows with it."""
    monkeypatch.setattr(ngram_join, "PART", part)
    rows = [(t, x, 5, 0, 0, x) for t, n in ((1, 40), (2, 1), (3, 3), (4, 4)) for x in range(n)]
    members = spark.createDataFrame(rows, "token long, x long, n_x long, own_x long, place_x int, component long")
    got = sorted((r.token, r.x, r.y) for r in ngram_join._met(members).select("token", "x", "y").collect())
    assert got == sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1])


def test_equal_rows_are_dealt_out(spark, odd):
    """Rows that agree in id and text do not meet in one batch when they are many; the others stay where they were."""
    text = "the same words again and again " * 3
    rows = spark.range(100_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS doc_id",
        f"CASE WHEN id % 9 = 1 THEN NULL ELSE '{text}' END AS text",
    )
    for table in (rows, rows.withColumn("doc_id", exchange.F.lit(None).cast("long")), rows.filter("text IS NULL")):
        size = 1 << 17
        dealt, total, count = exchange.batched(table, size=size)
        assert dealt.columns == table.columns + ["_batch"] and count > 5
        weights = dealt.groupBy("_batch").agg(exchange.F.expr("sum(coalesce(octet_length(text), 0) + 64)").alias("w")).collect()
        assert len(weights) == count and max(r.w for r in weights) <= 2 * size
        assert total == table.selectExpr("sum(octet_length(text))").first()[0] or not total
    assert exchange.batched(odd)[0].columns.count("_batch") == 1


def test_repeated_rows_give_the_same(spark, monkeypatch):
    """Operators over rows that are dealt out one by one, against one batch for all."""
    texts = [" ".join(f"w{k}x{i % 50}" for i in range(200)) for k in range(3)]
    data = [(7, texts[0])] * 60 + [(None, texts[1])] * 40 + [(8, texts[1]), (9, texts[2]), (3, texts[0][:900]), (None, None)]
    rows = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = []
    for size in (1 << 26, 5_000):
        for module in (ngram_join, suffixes, ctw):
            monkeypatch.setattr(module, "batched", lambda docs, size=None, s=size: exchange.batched(docs, size=s))
        parts = [ngram_join.linked(rows), ngram_join.one_of_each(rows), suffixes.repeats(rows), ctw.scored(rows)]
        found = [sorted((tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in p.collect()), key=str) for p in parts]
        got.append(found)
    assert got[0] == got[1]


def test_one_row_of_each_class(spark):
    """Repeated rows of a class's first document, ids with several texts, and classes of null ids."""
    text = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(6)]
    rows = [(1, text[0], "a")] * 5 + [(2, text[0], "a"), (None, text[0], "a"), (1, text[0] + " end", "a")]
    rows += [(None, text[1], "b")] * 3 + [(None, text[1] + " end", "b"), (None, text[2], "c"), (7, text[2], "c")]
    rows += [(1, text[3], "d"), (0, text[3], "d"), (None, text[4], "e"), (5, text[5], "f"), (5, text[5], "g")]
    rows += [(9, None, "n"), (9, None, "n"), (None, " ", "n")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(3)
    got = [tuple(r) for r in ngram_join.one_of_each(docs).collect()]
    found = Counter((d, s if s in "abcden" else "f") for d, _, s in got)
    assert found == {(1, "a"): 1, (None, "b"): 1, (7, "c"): 1, (0, "d"): 1, (None, "e"): 1, (5, "f"): 1, (9, "n"): 2, (None, "n"): 1}
    assert all(r in rows for r in got)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 103), (103, 101), (7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "x long, y long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100, 200: 200, 201: 200}


# ---- SimHash

def python_print(text):
    data = text_bytes(low(text))
    words = word_hashes(data, *word_bounds(data, terms=True))
    if not len(words):
        return bytes(16)
    counts = Counter(gram_hashes(np.r_[np.zeros(1, np.uint64), words, np.zeros(1, np.uint64)], 2).tolist())
    votes = np.zeros(128)
    for term, n in counts.items():
        lanes = np.array([term, simhash.mixed(np.uint64(term) ^ np.uint64(0x5851F42D4C957F2D))], np.uint64)
        votes += (1 + math.log(n)) * (2.0 * np.unpackbits(lanes.view(np.uint8)) - 1)
    return np.packbits(votes > 1e-4).tobytes()


def test_simhash_next_document(spark, odd):
    rnd = random.Random(2)
    docs = [(i * 3, " ".join(rnd.choice(["é", "b", "The", "x1"]) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(0, 60))))
            for i in range(1500)]
    for rows, data in ((spark.createDataFrame(docs, "doc_id long, text string").repartition(3), docs),
                       (odd, [(r.doc_id, r.text) for r in odd.collect()])):
        data = sorted(((d, t or "") for d, t in data), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
        want = []
        for (d, t), (_, after) in zip(data, [*data[1:], data[0]]):
            k = len(t) // 4
            new = t[: len(t) - k] + after[:k]
            a, b, c = (np.frombuffer(python_print(x), np.uint8) for x in (t, new, after))
            same = [1 - int(np.unpackbits(a ^ x).sum()) / 128 for x in (b, c)]
            want.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), *same))
        got = [tuple(r) for r in simhash.compared(rows).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_simhash_within_radius(spark):
    rnd = random.Random(4)
    base = [rnd.getrandbits(128) for _ in range(30)]
    prints = {b ^ sum(1 << k for k in rnd.sample(range(128), rnd.randint(0, 5))) for b in base for _ in range(8)}

    def halves(x):
        return struct.unpack(">qq", x.to_bytes(16, "big"))

    rows = spark.createDataFrame([halves(p) for p in prints] * 2, "f0 long, f1 long")
    ask = spark.createDataFrame([halves(b) for b in base], "f0 long, f1 long")
    got = {((r.q0, r.q1), (r.f0, r.f1), r.distance) for r in simhash.within(rows, ask, radius=3).collect()}
    want = {(halves(b), halves(p), (b ^ p).bit_count()) for b in base for p in prints if (b ^ p).bit_count() <= 3}
    assert got == want and len(want) > 50
    for blocks in (4, 5, 6):
        again = simhash.within(rows, ask, radius=3, blocks=blocks).collect()
        assert {((r.q0, r.q1), (r.f0, r.f1), r.distance) for r in again} == want
    assert [simhash.cheapest_blocks(10, n, n // 100) for n in (10**5, 10**9, 10**11)] == [11, 12, 13]
    found = simhash.fingerprints(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")).collect()
    assert found[0].fingerprint == python_print("a b").hex() and (found[1].f0, found[1].f1) == (0, 0)


def test_simhash_finds_near_copies(spark, odd):
    """Every hundredth document against all others, bit by bit; repeated ids and null ids count."""
    rnd = random.Random(8)
    docs = []
    for i in range(60):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([40, 300]))]
        docs.append((i * 100, " ".join(words)))
        for k in range(rnd.choice([0, 1, 6])):
            new = list(words)
            for _ in range(k):
                new[rnd.randrange(len(new))] = "edited"
            docs.append((rnd.choice([None, i * 100 + k + 1, i * 100]), " ".join(new)))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    caught = 0
    for table, data in ((rows, docs), (odd, [(r.doc_id, r.text) for r in odd.collect()])):
        prints = [int.from_bytes(python_print(t), "big") for _, t in data]
        want = []
        for i, (d, _) in enumerate(data):
            near = [((prints[i] ^ p).bit_count(), 2**63 if o is None else o) for j, (p, (o, _)) in enumerate(zip(prints, data)) if j != i]
            near = sorted(x for x in near if x[0] <= simhash.RADIUS)
            caught += sum(x[0] > 3 for x in near)
            asks = d is not None and d % 100 == 0
            bits, one = near[0] if near else (None, None)
            want.append((d, len(near), None if one == 2**63 else one, bits) if asks else (d, None, None, None))
        got = simhash.searched(table).select("doc_id", "near_count", "nearest_id", "nearest_bits").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert caught > 10  # also pairs beyond 3 bits


def test_simhash_radius_finds_nine_in_ten(spark):
    """Copies of given documents with one word replaced, searched among all documents."""
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    given = [(r.doc_id, r.text) for r in given if len((r.text or "").split()) >= 5]
    rnd = random.Random(3)
    copies = []
    for d, text in given:
        words = text.split(" ")
        words[rnd.choice([i for i, w in enumerate(words) if w.strip()])] = f"other{d}"
        copies.append((10**9 + 100 * d, " ".join(words)))
    rows = spark.createDataFrame(given + copies, "doc_id long, text string")
    prints = simhash.fingerprints(rows)
    ask = prints.filter("doc_id >= 1000000000")
    found = {(r.q0, r.q1, r.f0, r.f1) for r in simhash.within(prints, ask, simhash.RADIUS).collect()}
    own = {r.doc_id: (r.f0, r.f1) for r in prints.collect()}
    caught = sum((*own[10**9 + 100 * d], *own[d]) in found for d, _ in given)
    assert caught >= 0.9 * len(given)


def test_simhash_query_has_the_search(spark):
    assert {"near_count", "nearest_id"} <= set(queries()["op10_simhash"](spark, "/root/testdata/sf0.001").columns)


# ---- SentencePiece

def tricky():
    rnd = random.Random(1)
    letters = "ab  c\n\t▁éß漢字🙂\x00.,!<0x0A></s>  "
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200))) for _ in range(150)]
    return texts + ["", " ", "  ", "▁", " a", "a ", "\n", " " * 100, "x" * 300, "漢" * 3000, "the " * 3000, "thetheer" * 2000]


def test_pieces_equal_the_library(spark):
    texts = tricky()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.encoded(rows, MODEL).collect()}
    digests = {r.doc_id: r for r in pieces.encoded(rows, MODEL, digests=True).collect()}
    for i, text in [*enumerate(texts), (None, "")]:
        ids = library.encode(text, add_bos=True, add_eos=True)
        row, body = got[i], text.encode()
        assert list(row.ids) == ids and row.decoded == library.decode(ids)
        assert b"".join(body[a:b] for a, b in zip(row.begins, row.ends)) == body
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def charsmap(pairs):
    """A compiled map, built as a plain double array: each node's children at the first free offset."""
    texts, values = b"", {}
    for key, new in pairs.items():
        values[key], texts = len(texts), texts + new + b"\0"
    tree = {}
    for key in values:
        node = tree
        for byte in key:
            node = node.setdefault(byte, {})
        node[None] = values[key]
    units, used = [0] * 4096, {0}

    def place(node, at):
        labels = [0 if b is None else b for b in node]
        base = next(b for b in range(1, 3000) if not used & {at ^ b ^ x for x in labels} and b < 1 << 21)
        used.update(at ^ base ^ x for x in labels)
        units[at] |= base << 10 | (1 << 8 if None in node else 0)
        for byte, child in node.items():
            if byte is None:
                units[at ^ base] = child | 1 << 31
            else:
                units[at ^ base ^ byte] = byte
                place(child, at ^ base ^ byte)

    place(tree, 0)
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + texts


def test_longest_prefix_and_alignment():
    model = pieces.Model(open(MODEL, "rb").read())
    model.charsmap = pieces.Charsmap(charsmap({"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"<x>", b"\t": b" ", "é".encode(): b""}))
    assert model.charsmap.longest(b"abc", 0) == (b"<x>", 2) and model.charsmap.longest(b"zz", 0) is None
    text, align = model.normalised("aabﬁ\té c")
    assert text == "▁A<x>fi▁▁c"
    assert align.tolist() == [0, 0, 0, 0, 1, 1, 1, 3, 3, 6, 6, 6, 9, 9, 9, 10, 11]
    model.one_space = True
    text, align = model.normalised("  a \t b  ")
    assert text == "▁A▁b" and align.tolist() == [2, 2, 2, 2, 3, 3, 3, 6, 7]
    assert model.normalised(" \t")[0] == ""


# ---- context trees

def python_scores(docs, depth):
    train = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for d, _ in docs]
    count, node, words = Counter(), Counter(), Counter()
    for (_, t), used in zip(docs, train):
        body = b"\xff" * depth + low(t).encode() + b"\xff"
        if used:
            count.update((body[i - depth : i], body[i]) for i in range(depth, len(body)))
            words.update([*re.findall(rb"[^\x20\x09-\x0D]+", low(t).encode()), "end"])
    for (context, symbol), k in count.items():
        for d in range(depth + 1):
            for bit in range(8):
                node[context[depth - d :], 1 << bit | symbol >> 8 - bit, symbol >> 7 - bit & 1] += k
    below, weighted = defaultdict(set), {}
    for context, place, _ in list(node):
        below[context[1:], place].add(context) if context else None

    def estimate(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(z + o + 1)

    def log_weight(context, place):
        if (context, place) not in weighted:
            own = estimate(node[context, place, 0], node[context, place, 1])
            deeper = sum(log_weight(c, place) for c in below[context, place]) if len(context) < depth else own
            weighted[context, place] = np.logaddexp(own, deeper) - math.log(2) if len(context) < depth else own
        return weighted[context, place]

    def probability(context, place, bit):
        p = None
        for d in range(depth, -1, -1):
            c = context[depth - d :]
            z, o = node[c, place, 0], node[c, place, 1]
            own = ((o if bit else z) + 0.5) / (z + o + 1)
            w = 1 if p is None else math.exp(estimate(z, o) - log_weight(c, place) - math.log(2))
            p = own if p is None else w * own + (1 - w) * p
        return p

    total, different, out = sum(words.values()), len(words), []
    for (d, t), used in zip(docs, train):
        body = b"\xff" * depth + low(t).encode() + b"\xff"
        score = sum(math.log10(probability(body[i - depth : i], 1 << b | body[i] >> 8 - b, body[i] >> 7 - b & 1))
                    for i in range(depth, len(body)) for b in range(8))
        own = [*re.findall(rb"[^\x20\x09-\x0D]+", low(t).encode()), "end"]
        out.append((d, not used, len(own), sum(words[w] > 0 for w in own), total,
                    sum(math.log10((words[w] + 1) / (total + different + 1)) for w in own), score))
    return out


@pytest.mark.parametrize("depth", [2, 6])
def test_context_trees(spark, monkeypatch, depth):
    monkeypatch.setattr(ctw, "BATCH_BYTES", 400)
    rnd = random.Random(2)
    words = ["the", "of", "Ann", "é", "x1", "re\n"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30)))) for i in range(50)]
    docs += [(None, "The"), (77, None), (78, ""), (3, "the of"), (3, "the of")]
    got = [tuple(r)[:7] for r in ctw.scored(spark.createDataFrame(docs, "doc_id long, text string"), depth).collect()]
    want = python_scores(docs, depth)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-5)


def test_context_trees_beat_a_flat_model(spark):
    rnd = random.Random(3)
    docs = [(i, " ".join(rnd.choice(["sun", "moon", "star", "sky"]) for _ in range(50))) for i in range(200)]
    held = ctw.scored(spark.createDataFrame(docs, "doc_id long, text string")).filter("held_out").collect()
    assert held and all(r.bits_per_byte < 1 for r in held)  # four words of four letters and a space: 0.4 bits


# ---- pages

PAGE = (
    "<html><head><title>x</title></head><body><nav><ul><li><a href='/a'>A</a></li></ul></nav><!-- <p>c</p> -->"
    "<div class=\"ad\">buy<div>x</div></div><article><header><h1>T &amp; t</h1></header><p><b>One<br>two<p>three "
    "<i>fo</i>ur\n five</p><div class=\"reader-comments\"><p>c1</p></div><script>var t=\"</p>\";</script>&#x41;1 &lt;b&gt;"
    "</article><footer>&copy; z</footer>"
)


def test_blocks():
    main = [t for m, t in pages.blocks(PAGE) if m == "m"]
    assert main == ["T & t", "One two", "three four five", "A1 <b>"]
    assert {t for m, t in pages.blocks(PAGE) if m == "x"} == {"A", "buy", "x", "c1", "© z"}
    assert pages.blocks("") == [] and pages.blocks("<p>a<p>b") == [("o", "a"), ("o", "b")]
    assert pages.blocks("<p>x <span class='share'>s</span> y") == [("o", "x"), ("x", "s"), ("o", "y")]


def test_end_tags_that_html_lets_out():
    cases = {
        "<article><h1>T</h1><p class='notice'>Note<p>Main one<p>Main two</article>": "mT xNote mMain one mMain two",
        "<ul><li class=ad>x<li>y<ul><li class=promo>z</ul>w</ul>v": "xx oy xz ow ov",
        "<table><tr><td class=ad>a<td>b<tr class='ad'><td>c<tr><td>d</table>e": "xa ob xc od oe",
        "<dl><dt class=ad>k<dd>v<dt>l</dl>": "xk ov ol",
        "<div class=ad><p>a<div>b</div>c</div><p>d": "xa xb xc od",
        "<p class=ad>a<table><tr><td>b</table>": "xa ob",
        "<p>a<button class=ad><p>b</button>c": "oa xb oc",
        "<p class='ad'>a</article></nav><p>b": "xa ob",
        "a<svg/>b<svg><text>no</text></svg>c": "oabc",
        "x < y <a href='a>b'>z</a> <b title=\"it's\">w</b> <!- <a 'q": "ox < y z w <!- <a 'q",
    }
    for page, want in cases.items():
        assert " ".join(m + t for m, t in pages.blocks(page)) == want, page


def test_class_names_count_as_a_whole():
    inside = "<article><div class='{}'>a</div></article>"
    for name in ("side-by-side", "search-results", "discussion", "copyright", "shared", "formula", "menuconfig adjacent", "form"):
        assert pages.blocks(inside.format(name)) == [("m", "a")], name
    for name in ("ad", "x site-footer", "ad_slot-3", "comment-list", "Cookie-Banner", "main_nav"):
        assert pages.blocks(inside.format(name)) == [("x", "a")], name
    assert pages.blocks("<div class='search'>a</div>") == [("x", "a")]


@pytest.mark.parametrize("part", [
    "<a ", "<a \"", "<a '\"", "<script ", "<!", "<p>", "</p>", "<div>", "</div><div>", "<ul><li>", "<table><tr><td><p>",
    "<button><div>", "<span class=ad><p>", "<!--", "<svg>", "&amp", "<b"])
def test_broken_pages_take_linear_time(part):
    """A megabyte of one broken part: a quadratic scan would take hours."""
    begin = time.process_time()
    pages.blocks(part * ((1 << 20) // len(part)))
    assert time.process_time() - begin < 20


def test_longest_common_lines():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        found, rest = pages.common(a, b), iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found)


def test_pages_differ_from_their_neighbour(spark):
    def page(*lines):
        return "<body>" + "".join(f"<p>{x}</p>" for x in lines)

    rows = [
        (1, "http://a.net/1", page("Home", "One is here", "All rights")), (2, "http://a.net/2", page("Home", "Two is here", "All rights")),
        (3, "http://b.net/1", page("Home", "Alone")), (4, None, None), (5, "http://a.net/9?x", PAGE), (6, "http://a.net/9?x", PAGE),
        (7, "http://c.net/1", page("Same", "text")), (8, "http://c.net/2", page("Same", "text")), (None, "", ""),
    ]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, _range int")
    got = {(r.page_id, r.url): r for r in pages.extracted(docs).collect()}
    main = "T & t\nOne two\nthree four five\nA1 <b>"
    want = ["One is here", "Two is here", "Home\nAlone", "", main, main, "Same\ntext", "Same\ntext", ""]
    assert [got[r[0], r[1]].text for r in rows] == want
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(rows)


def test_long_runs_of_pages(spark):
    """Each page loses what the page before it has, wherever the ranges of URLs are cut."""
    rows = [(i, f"http://h.net/{i:05}", f"<p>top {i // 2}<p>own {i}<p>menu") for i in range(1000)]
    got = {r.page_id: r.text for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: (f"own {i}" if i % 2 or i == 0 else f"top {i // 2}\nown {i}") for i in range(1000)}
    assert got == want


def test_differences_decide_inside_an_article(spark):
    """Lines that two articles share go, captures of one URL are passed over, and a short page is no copy of its
    frame; wherever the ranges of URLs are cut."""
    def article(*lines):
        return "<nav>menu</nav><article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>"

    frame = "".join(f"<p>link {i}" for i in range(40))
    rows = [(i, f"http://a.net/{i:03}", article(f"Own text {i}", "Subscribe to our letter", f"More of {i}")) for i in range(50)]
    rows += [(100 + i, "http://b.net/1", article(f"Capture {i}", "Read this next")) for i in range(900)]
    rows += [(2000, "http://b.net/2", article("Another", "Read this next")), (2001, "http://b.net/3", article("Third"))]
    rows += [(3000 + i, f"http://c.net/{i}", f"{frame}<p>a few words of its own {i}") for i in range(2)]
    rows += [(4000, "http://d.net/1", article("One", "Two")), (4001, "http://d.net/2", article("One", "Two")),
             (4002, "http://d.net/3", article("Two", "Three"))]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extracted(docs).collect()}
    assert all(got[i] == f"Own text {i}\nMore of {i}" for i in range(50))
    assert all(got[100 + i] == f"Capture {i}" for i in range(900))
    assert (got[2000], got[2001]) == ("Another", "Third")
    assert [got[3000], got[3001]] == ["a few words of its own 0", "a few words of its own 1"]
    assert [got[4000], got[4001], got[4002]] == ["One\nTwo", "One", "Three"]


def test_empty_tables(spark, odd):
    docs = spark.createDataFrame([], "doc_id long, text string")
    web = spark.createDataFrame([], "page_id long, url string, html string")
    for found in (suffixes.repeats(docs), suffixes.without_repeats(docs), ngram_join.linked(docs), simhash.compared(docs),
                  simhash.fingerprints(docs), pieces.encoded(docs, MODEL), ctw.scored(docs), pages.extracted(web)):
        assert found.collect() == []
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert [r.n_bytes for r in suffixes.repeats(nulls).collect()] == [0, 0]
    assert [r.n_shingles for r in ngram_join.linked(nulls).collect()] == [0, 0]
    assert [r.near_next for r in simhash.compared(nulls).collect()] == [1, 1]
    assert [r.n_tokens for r in ctw.scored(nulls).collect()] == [1, 1]
    assert ctw.scored(odd).count() == odd.count() == pieces.encoded(odd, MODEL).count()
