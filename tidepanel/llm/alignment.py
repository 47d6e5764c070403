"""Alignment of two tokenizers' tokens on the bytes of each text."""

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import settle

SPACE = "▁"  # fixed value: stands for a space in pieces
# fixed value: how byte-level vocabularies of this kind cut texts before they merge
CUTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROWS = 256  # rows of a batch that are handled together, or fewer:
TEXT_BYTES, LINK_BYTES = 1 << 18, 1 << 20  # those that first reach so many bytes of text, or of stored links


def byte_of_char() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others
    for 256 and on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE from its JSON file: entries by id, and ids of a text. Special tokens are plain text here.

    Such a vocabulary numbers its merges in the order in which they apply, so the ids are the ranks.
    """

    def __init__(self, data: bytes):
        byte = byte_of_char()
        own = json.loads(data)
        special = {t["content"] for t in own.get("added_tokens", [])}
        words = {w: i for w, i in own["model"]["vocab"].items() if w not in special}
        ranks = {bytes(byte[c] for c in w): i for w, i in words.items()}
        self.surface = [b""] * (max(own["model"]["vocab"].values()) + 1)
        for word, i in ranks.items():
            self.surface[i] = word
        # the library wants the single bytes first: their order among each other decides nothing
        self.encoding = tiktoken.Encoding("bytes", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(t) for t in texts]


class Pieces:
    """A SentencePiece model from its file: pieces by id, as bytes, and ids of a text without begin and end."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.surface = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(self.model.get_piece_size())))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.model.encode(t) for t in texts]


def feasible(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All pairs of ids (a << 32 | b, in order) of which one's bytes end the other's.

    Tokens that end together are such a pair. There is at most one per byte of the vocabularies and equal entry, so
    tables over these pairs are bounded by the vocabularies, however large the corpus is.
    """
    at: tuple[dict, dict] = (defaultdict(list), defaultdict(list))
    for side, surfaces in zip(at, (a, b)):
        for i, s in enumerate(surfaces):
            if s:
                side[s].append(i)
    pairs = set()
    for s, own in at[0].items():
        for k in range(len(s)):
            pairs.update(i << 32 | j for j in at[1].get(s[k:], ()) for i in own)
    for s, own in at[1].items():
        for k in range(1, len(s)):
            pairs.update(i << 32 | j for i in at[0].get(s[k:], ()) for j in own)
    return np.array(sorted(pairs), np.int64)


def coalesced(starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The group of each interval: groups break where a start reaches the largest end before it."""
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.r_[True, starts[order][1:] >= reach[:-1]] if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all overlapping intervals; each side covers the same bytes without a gap."""
    first = np.searchsorted(b[1], a[0], side="right")
    count = np.searchsorted(b[0], a[1]) - first
    i = np.repeat(np.arange(len(count)), count)
    return i, np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(i))


class Aligner:
    """Both vocabularies, and what follows from them."""

    def __init__(self, a: bytes, b: bytes, pairs: np.ndarray):
        self.sides = (ByteLevel(a), Pieces(b))
        self.pairs = pairs
        self.surface = [np.array(s.surface, object) for s in self.sides]
        self.width = [np.array([len(x) for x in s.surface], np.int64) for s in self.sides]
        # an id in digits and what follows it: the next of its side, the other side, the next group
        self.digits = [
            [np.array([str(i).encode() + end for i in range(len(s.surface))], object) for end in (b",", b"|" if n == 0 else b";")]
            for n, s in enumerate(self.sides)
        ]

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where the joined bytes of a side are not a space and the text."""
        some = [t or "" for t in texts]
        a, b = self.sides[0].encode([" " + t for t in some]), self.sides[1].encode(some)
        out, none = [], np.zeros(0, np.int64)
        for text, *both in zip(some, a, b):
            ids = [np.array(x, np.int64) for x in both]
            whole = b" " + text.encode()
            same = text and all(b"".join(s[i]) == whole for s, i in zip(self.surface, ids))
            out.append((ids[0], ids[1]) if same else (none, none))
        return out

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """All texts at once, one after the other on one line of bytes, so that no group crosses a text's end."""
        own = self.tokens(texts)
        ids = [np.concatenate([t[n] for t in own]) for n in (0, 1)]
        counts = [np.array([len(t[n]) for t in own], np.int64) for n in (0, 1)]
        ends = [np.cumsum(self.width[n][ids[n]]) for n in (0, 1)]
        starts = [e - self.width[n][ids[n]] for n, e in enumerate(ends)]
        kind = np.repeat([0, 1], [len(x) for x in ids])
        both = coalesced(np.concatenate(starts), np.concatenate(ends), kind)
        group = [both[: len(ids[0])], both[len(ids[0]) :]]
        size = int(both.max(initial=-1)) + 1
        doc = [np.repeat(np.arange(len(own)), c) for c in counts]
        i, j = overlaps((starts[0], ends[0]), (starts[1], ends[1]))
        linked = ends[0][i] == ends[1][j]
        link = np.searchsorted(self.pairs, ids[0][i[linked]] << 32 | ids[1][j[linked]])
        of = lambda rows: np.bincount(rows, minlength=len(own))
        last = np.array([np.searchsorted(g, np.arange(size), side="right") - 1 for g in group]).reshape(2, size)
        return {
            "ids": ids, "counts": counts, "group": group, "last": last, "n_groups": of(doc[0][last[0]]),
            "links": link, "n_links": of(doc[0][i[linked]]), "n_overlaps": of(doc[0][i]), "overlap": (i, j),
        }

    def written(self, found: dict) -> list[bytes]:
        """The groups of each text in digits: `a1,a2|b1;a3|b2,b3`."""
        (a, b), (ga, gb) = found["ids"], found["group"]
        total = [np.bincount(g, minlength=len(found["last"][0])) for g in (ga, gb)]
        before = [np.cumsum(t) - t for t in total]
        words = np.empty(len(a) + len(b), object)
        for n, (ids, group) in enumerate(((a, ga), (b, gb))):
            at = np.arange(len(ids)) + (before[1][group] if n == 0 else before[0][group] + total[0][group])
            words[at] = self.digits[n][0][ids]
            end = found["last"][n]
            words[at[end]] = self.digits[n][1][ids[end]]
        stops = np.cumsum(found["counts"][0] + found["counts"][1]).tolist()
        return [b"".join(words[i:j])[:-1] for i, j in zip([0, *stops], stops)]


_aligners: dict[int, Aligner] = {}  # one per Python worker and pair of files


def _aligner(a: bytes, b: bytes, pairs: np.ndarray) -> Aligner:
    key = hash((a, b))
    if key not in _aligners:
        _aligners[key] = Aligner(a, b, pairs)
    return _aligners[key]


def _runs(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A few rows of a batch at a time, so that a task's arrays follow ``most`` and its largest row, not the batch."""
    begin = size = 0
    for end, own in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), 1):
        size += own
        if size >= most or end - begin == ROWS or end == batch.num_rows:
            yield batch.slice(begin, end - begin)
            begin, size = end, 0


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of a few rows at a time."""
    for part in _runs(batch, "text", TEXT_BYTES):
        yield part.column("doc_id"), part.column("text").to_pylist()


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values.astype(np.int32)))


def _stored(links: np.ndarray, counts: np.ndarray, size: int) -> pa.Array:
    """Each row's links as bytes: words of 32 bits, a pair's place below ``size`` and above it how often the row has
    the pair, less one. A pair that a row has more often than fits has several words."""
    bits = size.bit_length()
    most = 1 << 32 - bits
    keys, times = np.unique(np.repeat(np.arange(len(counts)), counts) * size + links, return_counts=True)
    words = -(-times // most)
    own = np.full(words.sum(), most)
    own[np.cumsum(words) - 1] = times - most * (words - 1)
    keys = np.repeat(keys, words)
    data = ((own - 1) << bits | keys % max(size, 1)).astype("<u4")
    ends = 4 * np.searchsorted(keys, np.arange(len(counts) + 1) * size)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _links(stored: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all rows' words, and where each row's begin and end, from 0."""
    stored = stored.cast(pa.binary())
    ends = np.frombuffer(stored.buffers()[1], np.int32, len(stored) + 1, 4 * stored.offset)
    data = stored.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    words, bits = data.view("<u4").astype(np.int64), size.bit_length()
    return words & (1 << bits) - 1, (words >> bits) + 1, (ends - ends[0]) // 4


def _sums(batches: Iterator[pa.RecordBatch], size: int) -> pa.RecordBatch:
    """How often each pair is among the links of all rows."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        for part in _runs(batch, "links", LINK_BYTES):
            pair, times, _ = _links(part.column("links"), size)
            np.add.at(total, pair, times)
    some = np.flatnonzero(total)
    return pa.RecordBatch.from_pydict({"pair": pa.array(some, pa.int32()), "n": pa.array(total[some])})


def _looked(batches: Iterator[pa.RecordBatch], totals: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows with n_best and count_sum in place of their links."""
    for batch in batches:
        for part in _runs(batch, "links", LINK_BYTES):
            pair, times, ends = _links(part.column("links"), len(totals))
            out = {name: part.column(name) for name in part.schema.names if name != "links"}
            for name, value in (("n_best", best), ("count_sum", totals)):
                sums = np.r_[0, np.cumsum(value[pair] * times, dtype=np.int64)]
                out[name] = pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())
            yield pa.RecordBatch.from_pydict(out)


def _files(a: str, b: str) -> tuple[bytes, bytes, np.ndarray]:
    """The driver reads them; tasks get their bytes and the feasible pairs."""
    data = []
    for path in (a, b):
        with open(path, "rb") as file:
            data.append(file.read())
    return data[0], data[1], feasible(ByteLevel(data[0]).surface, Pieces(data[1]).surface)


def aligned(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Groups of the tokens of two vocabularies on each row of ``docs`` (doc_id, text).

    ``a`` is the file of a byte-level BPE, which encodes a space and the text; ``b`` is the file of a SentencePiece
    model, which encodes the text and adds the space itself. All tokens of both sides are intervals of bytes, sorted
    by start; a group ends where the next start reaches the largest end so far, and within it overlaps expand.

    Columns: doc_id, a_ids, b_ids, a_group, b_group (the group of each token, from 0), overlap_a, overlap_b (places of
    the tokens that share a byte).

    Null or empty texts, and those whose joined bytes of a side differ from a space and the text (a literal U+2581),
    have empty lists. Repeated rows: each gives its own row. Ties of start: side A first, which decides nothing.
    Empty table: no rows. Other columns are ignored.
    """
    files = _files(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*files)
        for batch in batches:
            for own, texts in _parts(batch):
                found = aligner.align(texts)
                out, counts = {"doc_id": own}, found["counts"]
                first = np.cumsum(found["n_groups"]) - found["n_groups"]
                for n, side in enumerate("ab"):
                    out[f"{side}_ids"] = _lists(found["ids"][n], counts[n])
                    out[f"{side}_group"] = _lists(found["group"][n] - np.repeat(first, counts[n]), counts[n])
                for n, side in enumerate("ab"):
                    begin = np.repeat(np.cumsum(counts[n]) - counts[n], found["n_overlaps"])
                    out[f"overlap_{side}"] = _lists(found["overlap"][n] - begin, found["n_overlaps"])
                yield pa.RecordBatch.from_pydict(out)

    lists = ("a_ids", "a_group", "b_ids", "b_group", "overlap_a", "overlap_b")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{name} array<int>" for name in lists))


def counted(docs: DataFrame, a: str, b: str) -> DataFrame:
    """How the tokens of ``aligned`` are linked, and how often each row's pairs of ids are in the whole table.

    A link is a token of A and one of B that end at the same byte. Columns: doc_id, n_a, n_b, n_groups, n_links;
    n_best: links whose pair of ids is the most frequent one of its B id, ties included; count_sum: over the links,
    how many links of the table have the same pair; n_overlaps: pairs of tokens that share a byte; groups_sha256.

    Texts are encoded once. A linked pair of ids is one of ``feasible``, so a row's links are stored as the places
    there of its different pairs, each with how often the row has it; the counts of all pairs are a table bounded by
    the vocabularies, and they go to the tasks that look them up. So a stored row follows its different pairs, which
    the vocabularies bound, and a task holds a few rows' links at a time beside the batch that Spark hands it.

    Rows without tokens (see ``aligned``) have zeros and an empty groups_sha256. Repeated rows count each.
    """
    files = _files(a, b)
    pairs, size = files[2], len(files[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*files)
        for batch in batches:
            for own, texts in _parts(batch):
                found = aligner.align(texts)
                names = {"n_a": found["counts"][0], "n_b": found["counts"][1]}
                names |= {c: found[c] for c in ("n_groups", "n_links", "n_overlaps")}
                shas = [hashlib.sha256(w).hexdigest() if w else "" for w in aligner.written(found)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": own} | {c: pa.array(v, pa.int64()) for c, v in names.items()}
                    | {"groups_sha256": pa.array(shas, pa.string()), "links": _stored(found["links"], found["n_links"], size)}
                )

    plain = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = settle(rows.mapInArrow(run, f"{plain}, links binary"), "links")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _sums(batches, size)

    sums = rows.select("links").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    totals = np.zeros(size, np.int64)
    for part in sums.toArrow().to_batches():  # one row per pair at most
        totals[part.column("pair").to_numpy()] = part.column("n").to_numpy()
    piece = pairs & 0xFFFFFFFF
    most = np.zeros(int(piece.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, piece, totals)
    best = totals == most[piece]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _looked(batches, totals, best)

    return rows.mapInArrow(look, f"{plain}, n_best long, count_sum long")
