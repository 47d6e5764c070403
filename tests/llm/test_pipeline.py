"""The pipeline, and the registered queries, against plain Python and SQL."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from test_documents import python_components, python_repeats
from test_native import python_counts, python_mix

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from oracle import compare, connect
from tidepanel.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def documents():
    """Clean texts of four sources, copies, near copies, short ones, frequent lines, shared passages, repeats, nulls."""
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(4000)]

    def prose(n):
        return " ".join(rnd.choice(words) + rnd.choice(["", "", ",", ".\n"]) for _ in range(n))

    rows = [(prose(rnd.randint(60, 160)), f"src{i % 4}") for i in range(120)]
    passage = prose(70)
    rows += [(f"{prose(80)}\n{passage}\n{prose(30)}", "src1") for _ in range(6)]
    rows += [(rows[i][0], "src2") for i in range(5)]  # copies
    for i in range(5, 15):  # near copies
        text = rows[i][0].split(" ")
        text[rnd.randrange(len(text))] = "edited"
        rows.append((" ".join(text), None))
    menu = " ".join(f"menu{i}" for i in range(300))
    rows += [(f"{menu}\n{prose(60)}", "shop") for _ in range(15)]
    rows += [("too short", "src0"), (None, "src0"), ("", None), ("again and again " * 40, "src3")]
    return [(i * 7 % 1000, t, "en", s, None if t is None else len(t)) for i, (t, s) in enumerate(rows)]


def python_accepted(docs):
    lines, texts = defaultdict(set), defaultdict(set)
    split = {}
    for d, t, _, s, _ in docs:
        texts[s].add(t or "")
        split[d] = [" ".join(x.split()).lower() for x in (t or "").split("\n") if x.split()]
        for x in split[d]:
            lines[s, x].add(t or "")
    out = []
    for row in docs:
        d, t, _, s, _ = row
        words, *_, failed = python_counts(t)
        gone = sum(len(x.split()) for x in split[d] if len(lines[s, x]) > max(10, len(texts[s]) ** 0.5))
        if not failed and words - gone >= 0.3 * words:
            out.append(row)
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    found, rows = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, str(folder)).write.parquet(f"{folder}/{name}")
        rows = found[name] = spark.read.parquet(f"{folder}/{name}")
    return found, str(folder)


def test_stages(spark, stages):
    found, folder = stages
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    names = list(found)
    assert len(names) == 5 and all(found[n].columns == columns for n in names[:-1])

    docs = python_accepted(documents())
    assert sorted(map(tuple, found[names[0]].collect()), key=str) == sorted(docs, key=str)
    assert 0 < len(docs) < len(documents()) - 15  # the shop's pages go, and the short ones

    smallest = {d: c for d, _, c in python_components([(d, t) for d, t, *_ in docs], size=5, percent=80)}
    docs = [r for r in docs if smallest[r[0]] == r[0]]
    assert sorted(map(tuple, found[names[1]].collect()), key=str) == sorted(docs, key=str)

    kept = [w[4].decode("utf-8", "ignore") for w in python_repeats([(d, t) for d, t, *_ in docs])]
    docs = [(d, t, lang, s, len(t)) for (d, _, lang, s, _), t in zip(docs, kept)]
    assert sorted(map(tuple, found[names[2]].collect()), key=str) == sorted(docs, key=str)

    mix = python_mix([(d, t, s) for d, t, _, s, _ in docs])
    times = {d: taken // n for d, n, _, _, taken in mix}
    want = Counter({r: times[r[0]] for r in docs if times[r[0]]})
    assert Counter(map(tuple, found[names[3]].collect())) == want

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter({(r[0], tuple(library.encode(r[1], add_bos=True, add_eos=True))): n for r, n in want.items()})
    rows = found[names[4]].collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    assert all(r.decoded == library.decode(list(r.ids)) for r in rows)

    whole = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, tuple(r.ids)) for r in whole.collect()) == want


def python_cleaned(docs):
    """The accepted documents without their source's frequent lines."""
    lines, texts = defaultdict(set), defaultdict(set)
    for _, t, _, s, _ in docs:
        texts[s].add(t or "")
        for x in (t or "").split("\n"):
            lines[s, " ".join(x.split()).lower()].add(t or "")
    out = []
    for d, t, lang, s, _ in python_accepted(docs):
        keep = [x for x in t.split("\n")
                if not x.split() or len(lines[s, " ".join(x.split()).lower()]) <= max(10, len(texts[s]) ** 0.5)]
        out.append((d, "\n".join(keep), lang, s, len("\n".join(keep))))
    return out


def test_frequent_lines_go_from_kept_documents(spark):
    rows = documents()
    rows += [(2000 + i, f"{t}\n\nBack to  TOP\n", "en", "src0", None) for i, (_, t, *_) in enumerate(rows[:60])]
    rows += [(3000 + i, f"back to top\n{t}", "fr", None, 1) for i, (_, t, *_) in enumerate(rows[60:90])] + rows[-1:] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.STAGES[0][1](spark, docs.repartition(3), "")
    assert got.columns == docs.columns
    want = python_cleaned(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert len([r for r in want if r[0] >= 2000]) > 80 and not any("back to" in r[1].lower() for r in want)


def test_an_empty_corpus(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_pass_the_stages(spark, tmp_path):
    text = " ".join(f"x{i}" for i in range(80))
    rows = [(None, text, 1, "a"), (None, text, 1, "a"), (5, text + " end", None, None), (6, None, 2, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size int, source string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, ""), "odd")
        assert docs.columns == ["doc_id", "text", "size", "source"]
    assert docs.count() >= 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name]) == ""


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert "pipeline" in queries() and set(QUERIES) <= set(queries())
