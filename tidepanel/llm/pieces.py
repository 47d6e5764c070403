"""SentencePiece BPE: offset-preserving normalisation, encoding and decoding."""

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in a model file
LONG = 64  # segments above this many characters are merged with a heap
CACHE = 300_000  # segments that a Python worker remembers


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind in (1, 5) else varint()
        yield tag >> 3, data[at : at + size]
        at += size


class Charsmap:
    """The compiled character map: a double-array trie of strings, each with its replacement."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest prefix of data[at:] in the map, and that prefix's length."""
        if not self.units:
            return None
        units, found = self.units, None

        def offset(unit: int) -> int:
            return (unit >> 10) << ((unit & 0x200) >> 6)

        node = offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= offset(unit)
            if unit >> 8 & 1:
                begin = units[node] & 0x7FFFFFFF
                found = self.texts[begin : self.texts.index(b"\0", begin)], i - at + 1
        return found


class Model:
    """The pieces and the settings of a model file, and the tables for merging."""

    def __init__(self, data: bytes):
        texts, scores, kinds, trainer, normalizer = [], [], [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a BPE model with white space as prefix and without user-defined or unused pieces is needed")
        self.charsmap = Charsmap(normalizer.get(2, b""))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.one_space = bool(normalizer.get(4, 1))
        self.escape = bool(normalizer.get(5, 1))
        self.begin, self.end = texts.index("<s>"), texts.index("</s>")
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(texts, kinds)) if k == BYTE}
        if trainer.get(35, 0) and len(self.bytes) != 256:
            raise ValueError("the model falls back to bytes but lacks some of them")
        vocabulary = {t: i for i, (t, k) in enumerate(zip(texts, kinds)) if k == NORMAL}
        #: what each id gives when decoded
        self.surface = [
            bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(SPACE, " ").encode() if k == NORMAL
            else " ⁇ ".encode() if k == UNKNOWN else b""
            for t, k in zip(texts, kinds)
        ]
        self.widths = np.array([1 if k == BYTE else len(t.encode()) for t, k in zip(texts, kinds)], "<u4")
        # symbols: the pieces, and behind them the single characters that are part of a piece without being one
        symbol = dict(vocabulary)
        for t in vocabulary:
            for c in t:
                symbol.setdefault(c, len(texts) + len(symbol))
        self.symbol = symbol
        self.pieces = len(texts)
        self.size = max([len(texts), *symbol.values()]) + 2
        levels = {s: n for n, s in enumerate(sorted({scores[i] for i in vocabulary.values()}, reverse=True))}
        pairs = {}
        for t, i in vocabulary.items():
            for cut in range(1, len(t)):
                left, right = symbol.get(t[:cut]), symbol.get(t[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (levels[scores[i]], i)
        keys = sorted(pairs)
        self.pairs = pairs
        self.keys = np.array(keys, np.int64)
        self.ranks = np.array([pairs[k][0] for k in keys], np.int64)
        self.merged = np.array([pairs[k][1] for k in keys], np.int64)
        # a text can be cut where no piece reaches across: before a run of spaces, and around a lone line feed
        if any(re.search(f"[^{SPACE}]{SPACE}", t) for t in vocabulary):
            self.cuts = re.compile(r"(?s).+")
        elif any("\n" in t and len(t) > 1 for t in vocabulary):
            self.cuts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        else:
            self.cuts = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.known: dict[str, bytes] = {}  # the ids of segments

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the place in the original's UTF-8."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        if not self.charsmap.units and not self.one_space and self.escape:
            source = np.frombuffer(data, np.uint8)
            align = np.repeat(np.arange(len(data)), np.where(source == 32, 3, 1))
            lead = np.zeros(3 if self.dummy_prefix else 0, np.int64)
            return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE), np.concatenate(
                [lead, align, [len(data)]]
            )
        out, align, at = bytearray(), [], 0
        mark = SPACE.encode() if self.escape else b" "

        def prefix(at: int) -> tuple[bytes, int]:
            found = self.charsmap.longest(data, at)
            if found:
                return found
            size = 1
            while at + size < len(data) and data[at + size] & 0xC0 == 0x80:
                size += 1
            return data[at : at + size], size

        if self.one_space:
            while at < len(data) and prefix(at)[0] == b" ":
                at += prefix(at)[1]
            if at == len(data):
                return "", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out += mark
            align += [at] * len(mark)
        after_space = self.one_space
        while at < len(data):
            got, size = prefix(at)
            while after_space and got.startswith(b" "):
                got = got[1:]
            for byte in got:
                put = mark if byte == 32 else bytes([byte])
                out += put
                align += [at] * len(put)
            if got:
                after_space = got.endswith(b" ")
            at += size
            after_space = after_space and self.one_space
        if self.one_space:
            while out.endswith(mark):
                del out[-len(mark) :]
                at = align[len(out)]
                del align[len(out) :]
        return out.decode(), np.array([*align, at], np.int64)

    def _by_heap(self, text: str) -> list[int]:
        """Merges of one long segment: best score first, then the leftmost."""
        symbols = [self.symbol.get(c, -1 - ord(c)) for c in text]
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and min(symbols[left], symbols[right]) >= 0:
                found = self.pairs.get(symbols[left] * self.size + symbols[right])
                if found:
                    heapq.heappush(heap, (found[0], left, symbols[left], symbols[right], found[1]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        gone = object()
        while heap:
            _, left, a, b, new = heapq.heappop(heap)
            right = after[left] if symbols[left] is not gone else -1
            if right < 0 or symbols[left] != a or symbols[right] != b:
                continue
            symbols[left], symbols[right] = new, gone
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s is not gone]

    def _by_rounds(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Merges of many short segments at once; each round does the best merge of every segment.

        Gives all symbols in order, and how many each segment has.
        """
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        each, place = np.unique(codes, return_inverse=True)
        table = np.array([self.symbol.get(chr(c), -1 - int(c)) for c in each], np.int64)
        symbols = table[place]
        segment = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.int64(1) << 40

        def rank(left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = np.where(same & (left >= 0) & (right >= 0), left * self.size + right, -1)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            return np.where(hit, self.ranks[at], none), np.where(hit, self.merged[at], -1)

        ranks, news = np.full(len(symbols), none), np.full(len(symbols), -1)
        if len(symbols) > 1:
            ranks[:-1], news[:-1] = rank(symbols[:-1], symbols[1:], segment[:-1] == segment[1:])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            best = np.minimum.reduceat(ranks * (1 << 22) + np.arange(len(ranks)), starts)
            ended = best >= none << 22
            sizes = np.diff(np.r_[starts, len(symbols)])
            if ended.any():
                stay = np.repeat(~ended, sizes)
                done.append((symbols[~stay], segment[~stay]))
                moved = np.cumsum(stay) - 1
                where = moved[best[~ended] & ((1 << 22) - 1)]
                symbols, segment, ranks, news = symbols[stay], segment[stay], ranks[stay], news[stay]
            else:
                where = best & ((1 << 22) - 1)
            if not len(symbols):
                break
            symbols[where] = news[where]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            where = (np.cumsum(keep) - 1)[where]
            symbols, segment, ranks, news = symbols[keep], segment[keep], ranks[keep], news[keep]
            touched = np.r_[where, where - 1]
            touched = touched[touched >= 0]
            right = np.minimum(touched + 1, len(symbols) - 1)
            ranks[touched], news[touched] = rank(
                symbols[touched], symbols[right], (segment[touched] == segment[right]) & (right > touched)
            )
        all_symbols = np.concatenate([d[0] for d in done])
        owner = np.concatenate([d[1] for d in done])
        order = np.argsort(owner, kind="stable")
        return all_symbols[order], np.bincount(owner, minlength=len(texts))

    def _ids(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids: characters without a piece become their bytes, or the unknown id."""
        odd = (symbols < 0) | (symbols >= self.pieces)
        if not odd.any():
            return symbols, sizes
        replaced = {}
        for s in np.unique(symbols[odd]).tolist():
            char = chr(-1 - s) if s < 0 else next(c for c, i in self.symbol.items() if i == s)
            replaced[s] = [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]
        counts = np.ones(len(symbols), np.int64)
        for s, ids in replaced.items():
            counts[symbols == s] = len(ids)
        starts = np.cumsum(counts) - counts
        out = np.repeat(symbols, counts)
        for s, ids in replaced.items():
            at = starts[symbols == s]
            for j, i in enumerate(ids):
                out[at + j] = i
        return out, np.add.reduceat(counts, np.cumsum(sizes) - sizes)

    def learn(self, segments: list[str]) -> None:
        """Encodes the segments that the cache lacks."""
        new = [s for s in dict.fromkeys(segments) if s not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(dict.fromkeys(segments))
        short = [s for s in new if len(s) <= LONG]
        step = 30_000  # keeps a round's arrays below 2**22 symbols
        groups = [(short[i : i + step], *self._by_rounds(short[i : i + step])) for i in range(0, len(short), step)]
        for s in new:
            if len(s) > LONG:
                symbols = np.array(self._by_heap(s), np.int64)
                groups.append(([s], symbols, np.array([len(symbols)])))
        for texts, symbols, sizes in groups:
            ids, sizes = self._ids(symbols, sizes)
            data, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
            for s, i, j in zip(texts, (ends - 4 * sizes).tolist(), ends.tolist()):
                self.known[s] = data[i:j]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
        """Of each text: ids with begin and end, the first and last source byte of each, and the decoded bytes.

        Texts come in groups, as the rounds of merges are cheap for many segments at once.
        """
        normal = [self.normalised(t) for t in texts]
        segments = [self.cuts.findall(n) for n, _ in normal]
        different = {s: None for own in segments for s in own}
        self.learn(list(different))
        return [self._joined(t, align, own) for t, (_, align), own in zip(texts, normal, segments)]

    def _joined(self, text: str, align: np.ndarray, segments: list[str]) -> tuple:
        ids = b"".join(map(self.known.__getitem__, segments))
        numbers = np.frombuffer(ids, "<u4")
        widths = self.widths[numbers]
        decoded = b"".join(map(self.surface.__getitem__, numbers.tolist()))
        if self.dummy_prefix and decoded.startswith(b" "):
            decoded = decoded[1:]
        count = len(widths)
        size = int(align[-1]) if count else 0
        # where pieces begin in the source: at 0 for the begin id, then one after the other
        begins = np.zeros(count + 2, np.int64)
        ends = np.zeros(count + 2, np.int64)
        if count:
            places = np.cumsum(widths, dtype=np.int64)
            ends[1:-1] = align[places]
            begins[1] = align[0]
            begins[2:-1] = ends[1:-2]
        begins[-1] = ends[-1] = size
        whole = self.begin.to_bytes(4, "little") + ids + self.end.to_bytes(4, "little")
        return np.frombuffer(whole, "<u4"), begins, ends, decoded


_models: dict[int, Model] = {}  # one per Python worker and model file


def _model(data: bytes) -> Model:
    key = hash(data)
    if key not in _models:
        _models[key] = Model(data)
    return _models[key]


def _groups(batch: pa.RecordBatch, rows: int = 128, limit: int = 1_000_000) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of a few rows at a time: so many rows, or characters, or one text."""
    for begin in range(0, batch.num_rows, rows):
        part = batch.slice(begin, rows)
        group: list[str] = []
        size = first = 0
        for n, text in enumerate(part.column("text").to_pylist()):
            group.append(text)
            size += len(text)
            if size >= limit or n + 1 == part.num_rows:
                yield part.column("doc_id").slice(first, len(group)), group
                group, size, first = [], 0, n + 1


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values).astype(np.int32)))


def encoded(docs: DataFrame, model_file: str, digests: bool = False) -> DataFrame:
    """Ids and byte spans of each row of ``docs`` (doc_id, text), in the model's encoding with begin and end ids.

    The text is normalised by the longest prefixes in the model's compiled character map; each normalised byte
    keeps its place in the source, so every piece projects to a span [begin, end) of the source's UTF-8 bytes.
    Pieces merge by score, then from the left; characters without a piece fall back to their bytes.

    Columns: doc_id, ids, begins, ends, decoded; with ``digests`` instead n_tokens, ids_sha256 (ids as
    little-endian unsigned 32-bit integers), decoded_sha256, spans_sha256 (begins, then ends, as 32-bit integers).

    Null or empty text: only the begin and end ids, decoded to an empty text. Repeated rows: each gives its own
    row. Ties of score: the leftmost pair first. Empty table: no rows. Other columns are ignored.
    """
    with open(model_file, "rb") as file:  # the driver reads it; tasks get its bytes
        data = file.read()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sha(values: list[bytes]) -> pa.Array:
        return pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data)
        for batch in batches:
            for own, group in _groups(batch):
                rows = model.encode(group)
                if digests:
                    columns = {
                        "n_tokens": pa.array([len(r[0]) for r in rows], pa.int64()),
                        "ids_sha256": sha([r[0].tobytes() for r in rows]),
                        "decoded_sha256": sha([r[3] for r in rows]),
                        "spans_sha256": sha([np.concatenate(r[1:3]).astype("<u4").tobytes() for r in rows]),
                    }
                else:
                    columns = {name: _lists([r[i] for r in rows]) for i, name in enumerate(("ids", "begins", "ends"))}
                    columns["decoded"] = pa.array([r[3].decode("utf-8", "replace") for r in rows], pa.string())
                yield pa.RecordBatch.from_pydict({"doc_id": own} | columns)
            pa.default_memory_pool().release_unused()

    schema = (
        "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string" if digests
        else "ids array<int>, begins array<int>, ends array<int>, decoded string"
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, {schema}")
