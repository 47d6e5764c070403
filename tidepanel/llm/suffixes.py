"""Repeated byte strings across documents, found with suffix arrays."""

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.exchange import LOW, batched, bucket_bits, cut, find, ids, squeezed, texts, unsqueezed
from tidepanel.llm.vector import ODD, byte_values, mixed, powers

LENGTH = 50  # bytes of a repeated string
GRAM = 20  # bytes of an anchor
HOT = 20_000  # an anchor in more batches is dealt out by its windows
CHUNK = 1 << 22  # bytes of a document that are looked at together
_U = np.uint64


# ---- suffix arrays

def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (small integers, the last one smaller than all others) in the order of their suffixes,
    exact in the first ``depth`` symbols.

    Two stages. Suffixes smaller than their successor are sorted directly, eight symbols at a time among those
    still equal. The others follow from a scan of the buckets, one per first symbol: whoever is in its final place
    puts its predecessor, if that is larger than it, to the front of the predecessor's bucket.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    # smaller than the successor: the first differing symbol after the run is larger
    last = np.r_[np.flatnonzero(text[1:] != text[:-1]), n - 1]
    runs = np.diff(np.r_[-1, last])
    rises = np.r_[text[last[:-1]] < text[last[:-1] + 1], True]
    small = np.repeat(rises, runs)

    direct = np.flatnonzero(small)
    words = _chunks(text)
    key = words[direct]
    order = np.argsort(key, kind="stable")
    direct, key = direct[order], key[order]
    tied = _groups(np.r_[True, key[1:] != key[:-1]], np.arange(len(direct)))
    for at in range(8, depth + 8, 8):
        again = np.r_[tied[1:] == tied[:-1], False]
        again[1:] |= again[:-1].copy()
        where = np.flatnonzero(again)
        if not len(where):
            break
        place = direct[where] + at
        key = np.where(place < n, words[np.minimum(place, n - 1)], _U(0))
        order = np.lexsort((key, tied[where]))
        direct[where], key, group = direct[where][order], key[order], tied[where]
        tied[where] = _groups(np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])], where)

    symbols = int(text.max()) + 1
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(symbols + 1))
    waiting: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    done = []

    def hand_on(placed: np.ndarray, symbol: int) -> np.ndarray:
        """Predecessors of what has its place go to their buckets; those of the same bucket are returned."""
        before = placed[placed > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return before
        head = text[before]
        order = np.argsort(head, kind="stable")
        before, head = before[order], head[order]
        edges = np.flatnonzero(np.r_[True, head[1:] != head[:-1], True])
        same = before[:0]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if head[a] == symbol:
                same = before[a:b]
            else:
                waiting[int(head[a])].append(before[a:b])
        return same

    for symbol in range(symbols):
        turn = np.concatenate(waiting[symbol]) if waiting[symbol] else np.zeros(0, np.int64)
        while len(turn):
            done.append(turn)
            turn = hand_on(turn, symbol)
        own = direct[bounds[symbol] : bounds[symbol + 1]]
        if len(own):
            done.append(own)
            hand_on(own, symbol)
    return np.concatenate(done)


def _groups(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each element the place of its group's first one."""
    starts = np.flatnonzero(new)
    return np.repeat(places[starts], np.diff(np.r_[starts, len(new)]))


def _chunks(text: np.ndarray) -> np.ndarray:
    """Eight symbols from each position as one number that sorts like them; symbols are below 2**8 or clipped."""
    padded = np.zeros(len(text) + 8, _U)
    padded[: len(text)] = text
    out = np.zeros(len(text), _U)
    for k in range(8):
        out = (out << _U(8)) | padded[k : k + len(text)]
    return out


def common_prefix_at_least(text: np.ndarray, order: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """For each neighbour pair of the suffix array, whether their common prefix has ``length`` symbols or more.

    ``room`` is how many symbols each position has before its string ends.
    """
    a, b = order[:-1], order[1:]
    equal = (room[a] >= length) & (room[b] >= length)
    words = _chunks(text)
    for at in [*range(0, length - 7, 8), length - 8]:
        where = np.flatnonzero(equal)
        equal[where] = words[a[where] + at] == words[b[where] + at]
    return equal


# ---- anchors

def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each window of ``length`` bytes has an anchor: its ``gram`` bytes of least hash, the leftmost if tied.

    Equal windows have the same anchor at the same place. Gives, for each run of windows with one anchor: hash of
    the anchor, first window, end of the windows, hash of all bytes the windows cover, and the anchor's place.
    """
    found = []
    for begin in range(0, max(len(data) - length + 1, 0), CHUNK):
        part = data[begin : begin + CHUNK + length - 1]
        n = len(part)
        power, inverse = powers(n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum(byte_values()[part] * power[:n], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
        places = np.arange(len(grams), dtype=_U)
        low = _U((1 << 23) - 1)
        least, width, size = (grams & ~low) | places, length - gram + 1, 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if width > size:
            least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        end = np.r_[first[1:], len(place)]
        stop = end - 1 + length
        cover = mixed((sums[stop] - sums[first]) * inverse[first] + (stop - first).astype(_U) * ODD)
        # least hashes are small, so they are scrambled again to spread over the buckets
        found.append((mixed(grams[place[first]] ^ ODD), first + begin, end + begin, cover, place[first] + begin))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, none.astype(_U), none
    return tuple(np.concatenate(x) for x in zip(*found))


def _window_hashes(data: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(first), _U)
    values = byte_values()
    for k in range(length):
        out = out * _U(0xD1342543DE82EF95) + values[data[first + k]]
    return mixed(out ^ ODD)


def _keys(anchor: np.ndarray, cover: np.ndarray) -> np.ndarray:
    """The name of a snippet: its anchor and all bytes of its windows."""
    return mixed(anchor * _U(0xA0761D6478BD642F) + cover)


def _hot_key(anchor: np.ndarray) -> np.ndarray:
    return mixed(anchor ^ _U(0x5851F42D4C957F2D))


class Repeats:
    """The steps; ``length`` bytes make a repeat."""

    def __init__(self, total: int, length: int = LENGTH, gram: int = GRAM, hot: int = HOT):
        if not 8 <= gram < length or length - gram + 1 > 32:
            raise ValueError("an anchor has 8 bytes or more, and a window at most 32 places for it")
        self.bits, self.length, self.gram, self.hot = bucket_bits(total), length, gram, hot

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> _U(64 - self.bits)).astype(np.int32)

    def name(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket and LOW more bits: two anchors of one name only send more snippets."""
        return hashes >> _U(64 - LOW - self.bits)

    def _unique(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
        """The names of the batch's anchors, which of them two documents share, and each document's anchors."""
        docs = [anchors(t, self.length, self.gram) for t in texts(table)]
        names = [np.unique(self.name(d[0])) for d in docs]
        each, count = np.unique(np.concatenate([*names, np.zeros(0, _U)]), return_counts=True)
        return each, count > 1, docs

    def ask(self, table: pa.Table) -> pa.Table:
        """Which of the batch's anchors stand in several documents?"""
        each, twice, _ = self._unique(table)
        rows = [
            (b, squeezed((each[i:j] & _U((1 << LOW) - 1)).astype(np.uint32)), np.packbits(twice[i:j]).tobytes())
            for b, i, j in cut((each >> _U(LOW)).astype(np.int32))
        ]
        batch = table.column("_batch")[0].as_py()
        return pa.table({
            "_bucket": pa.array([r[0] for r in rows], pa.int32()),
            "_batch": pa.array([batch] * len(rows), pa.int32()),
            "keys": pa.array([r[1] for r in rows], pa.binary()),
            "twice": pa.array([r[2] for r in rows], pa.binary()),
        })

    def answer(self, table: pa.Table) -> pa.Table:
        """For each anchor: 0 one document, 1 several, 2 so many that its windows are dealt out one by one."""
        keys = [unsqueezed(k) for k in table.column("keys").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(k)).astype(bool)
                 for t, k in zip(table.column("twice").to_pylist(), keys)]
        flat = np.concatenate(keys)
        each, place, count = np.unique(flat, return_inverse=True, return_counts=True)
        several = count > 1
        several[place[np.concatenate(twice)]] = True
        state = (several.astype(np.uint8) + (count > self.hot))[place]
        parts = np.split(state, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({
            "_batch": table.column("_batch"),
            "_bucket": table.column("_bucket"),
            "state": pa.array([p.tobytes() for p in parts], pa.binary()),
        })

    def snippets(self, table: pa.Table, answers: pa.Table) -> pa.Table:
        """The different snippets of the batch's shared anchors: the bytes that the anchor's windows cover."""
        schema = {"_bucket": pa.int32(), "_batch": pa.int32(), "names": pa.binary(), "anchors": pa.binary(),
                  "docs": pa.binary(), "sizes": pa.binary(), "data": pa.binary()}
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in schema.items()})
        each, _, docs = self._unique(table)
        order = np.argsort(answers.column("_bucket").to_numpy())
        states = answers.column("state").to_pylist()
        state = np.concatenate([*(np.frombuffer(states[i], np.uint8) for i in order), np.zeros(0, np.uint8)])
        body = texts(table)
        number = ids(table)
        found = []
        for n, (anchor, first, end, cover, _) in enumerate(docs):
            at = np.searchsorted(each, self.name(anchor))
            now = state[at] if len(at) else at
            pick = np.flatnonzero(now == 1)
            found.append((anchor[pick], _keys(anchor[pick], cover[pick]), first[pick], end[pick] - 1 + self.length, n))
            hot = np.flatnonzero(now == 2)
            if len(hot):
                start = np.concatenate([np.arange(first[h], end[h]) for h in hot])
                name = _window_hashes(body[n], start, self.length)
                found.append((name, _keys(name, name), start, start + self.length, n))
                # says that the anchor is hot: an empty snippet
                found.append((anchor[hot], _hot_key(anchor[hot]), first[hot], first[hot], n))
        if not found:
            return pa.table({n: pa.array([], t) for n, t in schema.items()})
        owner = np.concatenate([np.full(len(f[0]), f[4]) for f in found])
        anchor, name, first, stop = (np.concatenate([f[i] for f in found]) for i in range(4))
        order = np.lexsort((number[owner], name))
        order = order[np.r_[True, name[order][1:] != name[order][:-1]]] if len(order) else order
        order = order[np.argsort(self.bucket(anchor[order]), kind="stable")]
        rows = []
        for b, i, j in cut(self.bucket(anchor[order])):
            pick = order[i:j]
            rows.append((
                b, name[pick].tobytes(), anchor[pick].tobytes(), number[owner[pick]].tobytes(),
                (stop[pick] - first[pick]).astype("<u2").tobytes(),
                b"".join([body[o][x:y].tobytes() for o, x, y in
                          zip(owner[pick].tolist(), first[pick].tolist(), stop[pick].tolist())]),
            ))
        batch = table.column("_batch")[0].as_py()
        columns = [[r[0] for r in rows], [batch] * len(rows), *([r[i] for r in rows] for i in range(1, 6))]
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(schema.items(), columns)})

    def first_seen(self, table: pa.Table) -> pa.Table:
        """For each batch's snippet, a bit per window: does it start in a document before the batch's first one?

        Where all snippets of an anchor are alike, their smallest document tells. The others go into a suffix array
        of all of them; windows whose neighbours share ``length`` bytes are equal, and each run of equal windows
        has its smallest document.
        """
        def column(name: str, kind: str) -> list[np.ndarray]:
            return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]

        names, sizes = column("names", "<u8"), column("sizes", "<u2")
        name, anchor = np.concatenate(names), np.concatenate(column("anchors", "<u8"))
        doc, size = np.concatenate(column("docs", "<i8")), np.concatenate(sizes).astype(np.int64)
        data = np.frombuffer(b"".join(table.column("data").to_pylist()), np.uint8)
        begin = np.cumsum(size) - size
        order = np.lexsort((doc, name))
        lead = np.flatnonzero(np.r_[True, name[order][1:] != name[order][:-1]])
        one = order[lead]  # of each different snippet, the row of its smallest document
        place = np.empty(len(name), np.int64)
        place[order] = np.repeat(np.arange(len(one)), np.diff(np.r_[lead, len(order)]))
        least = doc[one]
        per_anchor = np.unique(anchor[one], return_inverse=True, return_counts=True)
        several = (per_anchor[2][per_anchor[1]] > 1) & (size[one] > 0)
        # windows of each different snippet, side by side
        windows = np.maximum(size[one] - self.length + 1, 0)
        window_at = np.cumsum(windows) - windows
        first = np.repeat(least, windows)
        if several.any():
            pick = np.flatnonzero(several)
            n, start = size[one[pick]], begin[one[pick]]
            at = np.cumsum(n + 1) - (n + 1)  # a terminator follows each snippet
            text = np.zeros(int((n + 1).sum()), np.uint8)
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            spot = np.repeat(at, n) + inside
            source = data[np.repeat(start, n) + inside]
            if (source >= 254).any():
                raise ValueError("texts are UTF-8, which has no bytes 254 and 255")
            text[spot] = source + 1
            room = np.zeros(len(text), np.int64)
            room[spot] = np.repeat(n, n) - inside
            owner = np.zeros(len(text), np.int64)
            owner[spot] = np.repeat(pick, n)
            offset = np.zeros(len(text), np.int64)
            offset[spot] = inside
            order = suffix_array(text, self.length)
            same = common_prefix_at_least(text, order, room, self.length)
            starts = np.flatnonzero(np.r_[True, ~same])
            smallest = np.minimum.reduceat(least[owner[order]], starts)
            smallest = np.repeat(smallest, np.diff(np.r_[starts, len(order)]))
            whole = room[order] >= self.length
            first[window_at[owner[order[whole]]] + offset[order[whole]]] = smallest[whole]
        # per row: bits of the windows that an earlier document has
        count = windows[place]
        row = np.repeat(np.arange(len(name)), count)
        inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        earlier = first[window_at[place[row]] + inside] < doc[row]
        bits = np.where(earlier, np.uint64(1) << inside.astype(np.uint64), np.uint64(0))
        mask = np.zeros(len(name), np.uint64)
        filled = np.flatnonzero(count)
        if len(filled):
            mask[filled] = np.add.reduceat(bits, (np.cumsum(count) - count)[filled])
        parts = np.split(mask, np.cumsum([len(x) for x in names])[:-1])
        return pa.table({
            "_batch": table.column("_batch"),
            "names": table.column("names"),
            "masks": pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()),
        })

    def spans(self, table: pa.Table, answers: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        """Starts and ends of the maximal runs of repeated bytes, per document of the batch."""
        name = np.concatenate([*(np.frombuffer(x, "<u8") for x in answers.column("names").to_pylist()), np.zeros(0, _U)])
        mask = np.concatenate([*(np.frombuffer(x, "<u4") for x in answers.column("masks").to_pylist()),
                               np.zeros(0, np.uint32)])
        order = np.argsort(name)
        name, mask = name[order], mask[order]
        number, body = ids(table), texts(table)
        hits = []
        smallest = np.full(len(name), np.iinfo(np.int64).max)
        for n, t in enumerate(body):
            anchor, first, end, cover, _ = anchors(t, self.length, self.gram)
            at, ok = find(name, _keys(anchor, cover))
            hits.append((at[ok], first[ok], end[ok], n))
            hot = find(name, _hot_key(anchor))[1]
            if hot.any():
                start = np.concatenate([np.arange(a, b) for a, b in zip(first[hot], end[hot])])
                own = _window_hashes(t, start, self.length)
                at, ok = find(name, _keys(own, own))
                hits.append((at[ok], start[ok], start[ok] + 1, n))
        for at, _, _, n in hits:
            smallest[at] = np.minimum(smallest[at], number[n])
        marked = [np.zeros(len(t) + 1, np.int32) for t in body]
        for at, first, end, n in hits:
            count = end - first
            row = np.repeat(np.arange(len(at)), count)
            inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            # the bits speak for the batch's smallest document; larger ones have that one before them
            gone = (number[n] > smallest[at])[row] | ((mask[at][row] >> inside.astype(np.uint32)) & 1).astype(bool)
            start = first[row[gone]] + inside[gone]
            marked[n][start] += 1
            marked[n][start + self.length] -= 1
        out = []
        for m in marked:
            inside = np.r_[0, (np.cumsum(m[:-1]) > 0).astype(np.int8), 0]
            step = np.diff(inside)
            out.append((np.flatnonzero(step == 1), np.flatnonzero(step == -1)))
        return out


def _kept(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    keep = np.ones(len(body), bool)
    for a, b in zip(starts, ends):
        keep[a:b] = False
    return body[keep].tobytes()


def _applied(docs: DataFrame, finish: Callable, schema: str, length: int, gram: int, hot: int) -> DataFrame:
    rows, total, _ = batched(docs)
    steps = Repeats(total, length, gram, hot)
    asked = rows.groupBy("_batch").applyInArrow(
        lambda t: steps.ask(t), "_bucket int, _batch int, keys binary, twice binary"
    )
    answers = asked.groupBy("_bucket").applyInArrow(
        lambda t: steps.answer(t), "_batch int, _bucket int, state binary"
    )
    sent = rows.groupBy("_batch").cogroup(answers.groupBy("_batch")).applyInArrow(
        lambda t, a: steps.snippets(t, a),
        "_bucket int, _batch int, names binary, anchors binary, docs binary, sizes binary, data binary",
    )
    seen = sent.groupBy("_bucket").applyInArrow(
        lambda t: steps.first_seen(t), "_batch int, names binary, masks binary"
    )

    def last(table: pa.Table, found: pa.Table) -> pa.Table:
        return finish(table, steps.spans(table, found))

    return rows.groupBy("_batch").cogroup(seen.groupBy("_batch")).applyInArrow(last, schema)


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """What each row of ``docs`` (doc_id, text) loses: every byte covered by a string of ``length`` bytes that also
    starts in a document with a smaller doc_id. Overlaps count, and strings are judged on the input.

    Only strings whose anchor stands in several documents are sent on, and of those each batch sends every
    different one once; the suffix arrays hold strings that share an anchor but differ around it. An anchor in more
    than ``hot`` batches is dealt out by its windows, so that no task gets all that stands around it.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal runs), kept_sha256, span_starts, span_ends (bytes).

    Null or empty text, or fewer bytes than ``length``: nothing goes. Null doc_id: smaller than all others. Rows
    with the same doc_id do not touch each other. Empty table: no rows. Other columns are ignored.
    """
    def finish(table: pa.Table, spans: list) -> pa.Table:
        body = texts(table)
        return pa.table({
            "doc_id": table.column("doc_id"),
            "n_bytes": pa.array([len(t) for t in body], pa.int64()),
            "n_removed": pa.array([int((b - a).sum()) for a, b in spans], pa.int64()),
            "n_spans": pa.array([len(a) for a, _ in spans], pa.int64()),
            "kept_sha256": pa.array(
                [hashlib.sha256(_kept(t, *s)).hexdigest() for t, s in zip(body, spans)], pa.string()
            ),
            "span_starts": pa.array([a.tolist() for a, _ in spans], pa.list_(pa.int64())),
            "span_ends": pa.array([b.tolist() for _, b in spans], pa.list_(pa.int64())),
        })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _applied(
        docs.select("doc_id", "text"), finish,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "span_starts array<long>, span_ends array<long>",
        length, gram, hot,
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text, all columns and rows kept.

    A character of which only some bytes remain goes too. A null text stays null. n_chars, if there, is counted anew.
    """
    names, schema = docs.columns, docs.schema
    others = [n for n in names if n not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*[F.col(n) for n in others]).alias("others")) if others else docs

    def finish(table: pa.Table, spans: list) -> pa.Table:
        known = table.column("text").is_valid().to_pylist()
        new = [
            _kept(t, *s).decode("utf-8", "ignore") if ok else None for t, s, ok in zip(texts(table), spans, known)
        ]
        columns = {"doc_id": table.column("doc_id"), "text": pa.array(new, table.schema.field("text").type)}
        if others:
            columns |= dict(zip(others, table.column("others").combine_chunks().flatten()))
        if "n_chars" in others:
            sizes = pa.array([None if t is None else len(t) for t in new], pa.int64())
            columns["n_chars"] = sizes.cast(columns["n_chars"].type)
        return pa.table({n: columns[n] for n in names})

    return _applied(packed, finish, schema, length, gram, hot)
