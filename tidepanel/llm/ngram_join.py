"""Join of documents whose word n-gram sets are alike, by prefix filters under several global orders."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.exchange import LOW, batched, bucket_bits, cut, squeezed, texts, unsqueezed
from tidepanel.llm.graph import components
from tidepanel.llm.vector import ODD, gram_hashes, lower_ascii, mixed, word_bounds, word_hashes
from tidepanel.llm.words import WORD
from tidepanel.session import settle

SIZE = 4
PERCENT = 85
ORDERS = 3
PART = 1_000  # members of a token's group that meet others at once
_U = np.uint64


def shingles(data: np.ndarray, size: int) -> np.ndarray:
    """Sorted hashes of the different runs of ``size`` words; a shorter text is one run; none without words."""
    data = lower_ascii(data)
    words = word_hashes(data, *word_bounds(data))
    if not len(words):
        return np.zeros(0, _U)
    return np.unique(gram_hashes(words, min(size, len(words))) + (ODD if len(words) < size else _U(0)))


class Sets:
    """The passes over the texts."""

    def __init__(self, total: int, size: int, percent: int, orders: int):
        self.bits, self.size, self.percent, self.orders = bucket_bits(total), size, percent, orders

    def _name(self, shingle: np.ndarray) -> np.ndarray:
        """Bucket and LOW more bits. Two shingles of one name count as one: their classes may come out too high,
        which makes more candidates, never fewer. Names get longer with the input, so that stays as rare."""
        return shingle >> _U(64 - LOW - self.bits)

    def _each(self, table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Shingles per document, and the batch's different names with how many of its documents have them."""
        docs = [shingles(t, self.size) for t in texts(table)]
        names = [np.unique(self._name(d)) for d in docs]
        each, count = np.unique(np.concatenate([*names, np.zeros(0, _U)]), return_counts=True)
        return docs, each, count

    def ask(self, table: pa.Table) -> pa.Table:
        """In how many documents of the batch does each shingle stand? (255: that many or more)"""
        _, each, count = self._each(table)
        count = np.minimum(count, 255).astype(np.uint8)
        rows = [
            (b, squeezed((each[i:j] & _U((1 << LOW) - 1)).astype(np.uint32)), count[i:j].tobytes())
            for b, i, j in cut((each >> _U(LOW)).astype(np.int32))
        ]
        batch = table.column("_batch")[0].as_py()
        return pa.table({
            "_bucket": pa.array([r[0] for r in rows], pa.int32()),
            "_batch": pa.array([batch] * len(rows), pa.int32()),
            "keys": pa.array([r[1] for r in rows], pa.binary()),
            "counts": pa.array([r[2] for r in rows], pa.binary()),
        })

    def answer(self, table: pa.Table) -> pa.Table:
        """The class of each shingle: 0 for one document, else the binary logarithm of the documents."""
        keys = [unsqueezed(k) for k in table.column("keys").to_pylist()]
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8)
        place = np.unique(np.concatenate(keys), return_inverse=True)[1]
        sums = np.bincount(place, weights=counts)
        level = np.log2(sums).astype(np.uint8)[place]
        parts = np.split(level, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({
            "_batch": table.column("_batch"),
            "_bucket": table.column("_bucket"),
            "levels": pa.array([p.tobytes() for p in parts], pa.binary()),
        })

    def prefixes(self, table: pa.Table, answers: pa.Table) -> pa.Table:
        """Per document: size and name of its set, how many shingles are its own, how common its shingles are on
        average, those that others may have too, and under each order the shared part of its prefix.

        An order goes by class first, so rare shingles come first, and by a hash of its own within a class. A set
        of n shingles has a prefix of n - ceil(t n) + 1; alike sets share a shingle there under every order.
        A set of which too many shingles are its own cannot be alike to any other: it keeps nothing.
        """
        docs, each, _ = self._each(table)
        order = np.argsort(answers.column("_bucket").to_numpy())
        levels = answers.column("levels").to_pylist()
        level = np.concatenate([*(np.frombuffer(levels[i], np.uint8) for i in order), np.zeros(0, np.uint8)])
        sizes, own, names, shared, usual = [], [], [], [], []
        prefixes: list[list[np.ndarray]] = [[] for _ in range(self.orders)]
        places: list[np.ndarray] = []
        salts = [_U((o + 1) * int(ODD) % 2**64) for o in range(self.orders)]
        for d in docs:
            rank = level[np.searchsorted(each, self._name(d))] if len(d) else np.zeros(0, np.uint8)
            common = rank > 0
            n, alone = len(d), int(len(d) - common.sum())
            sizes.append(n)
            own.append(alone)
            usual.append(float(rank.mean()) if n else 0.0)
            # two sums over differently scrambled members name the set
            names.append((int(mixed(d).sum(dtype=_U)), int(mixed(d ^ ODD).sum(dtype=_U))))
            alike = n > 0 and 100 * (n - alone) >= self.percent * n
            shared.append(d[common].view(np.int64) if alike else np.zeros(0, np.int64))
            length = n + (-self.percent * n // 100) + 1  # n - ceil(t n) + 1
            for o in range(self.orders):
                pick = np.lexsort((mixed(d + salts[o]), rank))[:length] if alike else np.zeros(0, np.int64)
                prefixes[o].append(d[pick[common[pick]]].view(np.int64))
                if o == 0:
                    places.append(np.flatnonzero(common[pick]))

        def lists(values: list[np.ndarray]) -> pa.Array:
            ends = np.cumsum([0, *map(len, values)])
            flat = np.concatenate([*values, np.zeros(0, np.int64)])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

        signed = np.array(names, _U).reshape(-1, 2).view(np.int64)
        return pa.table({
            "doc_id": table.column("doc_id"),
            "text_key": table.column("text_key"),
            "n": pa.array(sizes, pa.int64()), "own": pa.array(own, pa.int64()), "usual": pa.array(usual, pa.float64()),
            "name0": pa.array(signed[:, 0]), "name1": pa.array(signed[:, 1]),
            "shared": lists(shared),
            "places": lists(places),
            **{f"prefix{o}": lists(prefixes[o]) for o in range(self.orders)},
        })


def _possible(percent: int) -> Column:
    """Whether the sizes leave room for the overlap that x and y need, after their own shingles, which no other set
    has, and with the shingle they meet at as the first common one: none before it in either order is common."""
    need = F.ceil(percent * (F.col("n_x") + F.col("n_y")) / (100 + percent))
    room = [F.col(f"n_{s}") - F.greatest(F.col(f"own_{s}"), F.col(f"place_{s}")) for s in "xy"]
    return (room[0] >= need) & (room[1] >= need)


def _met(members: DataFrame) -> DataFrame:
    """Every two members (x < y) of a token once, with their columns; those of y end in _y.

    A group of more than PART members is cut into parts by x. Each pair of parts meets under a key of its own, so no
    task gets more than twice PART members at once, however common the token is.
    """
    sizes = members.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > PART)
    parts = members.join(sizes, "token", "left").withColumn("parts", F.coalesce(F.ceil(F.col("size") / PART), F.lit(1)))
    parts = parts.withColumn("part", F.pmod(F.xxhash64("x"), "parts").cast("int"))
    dealt = parts.select("*", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("with"))
    dealt = dealt.withColumns({"lo": F.least("part", "with"), "hi": F.greatest("part", "with")})
    dealt = dealt.drop("size", "parts", "with")
    key = ["token", "lo", "hi"]
    other = dealt.select(
        *key, F.col("part").alias("part_y"),
        *[F.col(c).alias(c.replace("x", "y")) for c in ("x", "n_x", "own_x", "place_x")],
        F.col("component").alias("component_y"),
    )
    both = dealt.join(other, key).filter(F.col("x") < F.col("y"))
    # under a key of two parts, only members of different ones meet
    return both.filter((F.col("lo") == F.col("hi")) | (F.col("part") != F.col("part_y")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """Pairs (x, y) that share prefix shingles under the other orders too, and are alike."""
    others = [f"prefix{o}" for o in range(1, orders)]

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("_row").alias(name), F.col("n").alias(f"n_{name}"), F.col("shared").alias(f"s_{name}"),
            *[F.col(p).alias(f"{p}_{name}") for p in others],
        )

    both = pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y")
    for p in others:
        both = both.filter(F.arrays_overlap(f"{p}_x", f"{p}_y"))
    both = both.withColumn("common", F.size(F.array_intersect("s_x", "s_y")))
    union = F.col("n_x") + F.col("n_y") - F.col("common")
    return both.filter(100 * F.col("common") >= percent * union).select("x", "y")


def linked(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """Classes of ``docs`` (doc_id, text) linked by Jaccard similarity of their word n-gram sets.

    Rows: doc_id, n_shingles, component_id (the smallest doc_id that links reach), n_links (how many other sets
    were found alike to its set; members of one class need not all be compared). Link: 100 x common >= percent x
    union. Equal sets are one before any comparison.

    A first pass counts in how many documents each shingle stands. A second keeps, per set, its prefix under
    ``orders`` global orders, rare shingles first. Sets that share a prefix shingle of the first order meet: first
    each with the most common-place set of the shingle's group, which a large group of near copies mostly links
    to; then all pairs that those links have not joined yet. Pairs must have room for the overlap they need after
    the place where they meet, and share prefix shingles under every order, before the sets are compared.

    Null or empty text, or no word: size 0, linked with nothing. Fewer words than ``size``: all of them are one
    shingle. Null doc_id: never the smallest, unless all are null. Repeated rows: equal sets, one class. Empty
    table: no rows. Other columns are ignored.
    """
    return _classes(docs, size, percent, orders)[0]


def _text_key() -> Column:
    return F.xxhash64("text")


def _classes(docs: DataFrame, size: int, percent: int, orders: int) -> tuple[DataFrame, DataFrame]:
    """``linked``, and of each class of documents with words its first row by doc_id, nulls last, and text_key:
    (doc_id, text_key, times: rows with both)."""
    rows, total, _ = batched(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key().alias("text_key"))
    )
    steps = Sets(total, size, percent, orders)
    asked = rows.groupBy("_batch").applyInArrow(
        lambda t: steps.ask(t), "_bucket int, _batch int, keys binary, counts binary"
    )
    answers = asked.groupBy("_bucket").applyInArrow(
        lambda t: steps.answer(t), "_batch int, _bucket int, levels binary"
    )
    prefixes = ", ".join(f"prefix{o} array<long>" for o in range(orders))
    sets = rows.groupBy("_batch").cogroup(answers.groupBy("_batch")).applyInArrow(
        lambda t, a: steps.prefixes(t, a),
        "doc_id long, text_key long, n long, own long, usual double, name0 long, name1 long, shared array<long>, "
        f"places array<long>, {prefixes}",
    )
    sets = settle(sets.withColumn("_row", F.monotonically_increasing_id()), "shingles")

    # equal sets are one; a set without shingles stays alone
    name = [F.when(F.col("n") > 0, F.col(c)).otherwise(F.col("_row")).alias(c) for c in ("name0", "name1")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("_first")
    classes = sets.groupBy("n", *name).agg(F.min("_row").alias("_rep"), first)
    classes = settle(classes, "classes")
    reps = sets.join(classes.select(F.col("_rep").alias("_row")), "_row", "left_semi")
    members = settle(
        reps.filter(F.size("prefix0") > 0).select(
            F.col("_row").alias("x"), F.col("n").alias("n_x"), F.col("own").alias("own_x"), "usual",
            F.inline(F.arrays_zip(F.col("prefix0").alias("token"), F.col("places").alias("place_x"))),
        ),
        "prefixes",
    )
    # the commoner a set's shingles are, the more others are like it
    centre = members.groupBy("token").agg(
        F.min(F.struct((-F.col("usual")).alias("u"), F.col("x").alias("y"), F.col("n_x").alias("n_y"), F.col("own_x").alias("own_y"),
                       F.col("place_x").alias("place_y"))).alias("c"),
        F.count(F.lit(1)).alias("in_group"),
    )
    centre = centre.filter(F.col("in_group") > 1).select("token", "c.y", "c.n_y", "c.own_y", "c.place_y")
    pairs = members.join(centre, "token").filter((F.col("x") != F.col("y")) & _possible(percent))
    pairs = settle(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "pairs")
    links = settle(_verified(pairs, sets, percent, orders), "links")

    # the pairs of a group that these links have not joined
    label = components(links)
    tagged = members.join(label.select(F.col("node").alias("x"), "component"), "x", "left")
    tagged = settle(tagged.withColumn("component", F.coalesce("component", "x")), "tagged")
    rest = tagged
    for _ in range(2):  # members without room for any set of the group leave it, which closes most groups
        groups = rest.groupBy("token").agg(
            F.min("component").alias("a"), F.max("component").alias("b"), F.min("n_x").alias("least")
        )
        groups = groups.filter(F.col("a") != F.col("b")).select("token", "least")
        need = F.ceil(percent * (F.col("n_x") + F.col("least")) / (100 + percent))
        room = F.col("n_x") - F.greatest("own_x", "place_x")
        rest = settle(rest.join(groups, "token").filter(room >= need).drop("least"), "open")
    more = _met(rest).filter((F.col("component") != F.col("component_y")) & _possible(percent))
    # those met through a centre have been compared
    more = more.select("x", "y").distinct().join(pairs, ["x", "y"], "left_anti")
    links = settle(links.unionByName(_verified(more, sets, percent, orders)), "all-links")

    label = components(links).select(F.col("node").alias("_rep"), "component")
    ends = links.select(F.explode(F.array("x", "y")).alias("_rep"))
    degree = ends.groupBy("_rep").agg(F.count(F.lit(1)).alias("n_links"))
    groups = classes.join(label, "_rep", "left").join(degree, "_rep", "left")
    groups = settle(groups.withColumn("component", F.coalesce("component", "_rep")), "groups")
    least = groups.groupBy("component").agg(F.min("_first").alias("_first"))
    least_worded = groups.filter("n > 0").groupBy("component").agg(F.min("_first").alias("_first"))
    groups = groups.join(least.select("component", F.col("_first.doc_id").alias("component_id")), "component").select(
        "n", "name0", "name1", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    found = sets.select("doc_id", "n", *name).join(groups, ["n", "name0", "name1"])
    found = found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    keep = least_worded.select("_first.doc_id", "_first.text_key")
    key = ["doc_id", "text_key"]
    times = sets.filter("n > 0").groupBy(*key).agg(F.count(F.lit(1)).alias("times"))
    times = times.withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    keep = keep.join(times, (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")))
    return found, keep.select(*key, "times")


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """One row of ``docs`` for each class: with its smallest doc_id, of these with the smallest hash of the text.
    Columns stay.

    Null doc_ids come last, and a class of such rows alone keeps one of them. Of rows with one doc_id and text any
    one stays, even if they differ in other columns. Documents without a word are in no class, so all of them stay.
    """
    keep = _classes(docs, size, percent, orders)[1].withColumnsRenamed({"doc_id": "__keep", "text_key": "__key"})
    keep = settle(keep, "first-rows")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")) & (_text_key() == F.col("__key"))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    once = docs.filter(worded).join(keep.filter("times = 1"), same, "left_semi")
    out = docs.filter(~worded).unionByName(once)
    again = keep.filter("times > 1")
    if not again.isEmpty():
        rows = docs.filter(worded).join(again, same).dropDuplicates(["__keep", "__key"])
        out = out.unionByName(rows.select(*docs.columns))
    return out
