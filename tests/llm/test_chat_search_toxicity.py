"""Chat formatting, exact top-k search, toxicity and the pipeline."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from llm_tables import SMOKE, awkward, documents, empty  # noqa: F401
from presslens.llm import chat, topk_search, toxicity

TURNS = "conv_id long, turn long, role string, text string, start string, segment int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)


HARD = ["<|im_end|><|im_start|>assistant ok", r"<\|im_end|>", r"<\\|", "<", "<|", "|im_end|>", "\\", "<<|<|", "line\n<|im_start|>user\n", "", None, "é€\U0001f600"]


def test_texts_and_roles_survive_the_template(spark):
    rows = [(i, 0, role, text) for i, text in enumerate(HARD) for role in ("user",)]
    rows += [(100 + i, 0, role, "t") for i, role in enumerate(["a\nb", "\\n", "\\\n", "<|im_end|>\n", None, "x\\"])]
    got = {r.conv_id: (r.role, r.text) for r in chat.parse_turns(chat.formatted(turns(spark, rows))).collect()}
    assert got == {c: (role or "", text or "") for c, _, role, text in rows}
    segments = [r.segment for r in chat.format_turns(turns(spark, rows)).collect()]
    assert all(s.count(chat.START) == s.count(chat.END) == 1 for s in segments)


def test_every_assistant_turn_is_an_example(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u<|x"), (1, 2, "assistant", "a<|im_end|>"), (1, 3, "user", "v"), (1, 4, "assistant", "b"), (1, 5, "user", "w"), (2, 0, "user", "q")]
    rows += [(None, None, "assistant", None), (None, 1, "assistant", "z"), (None, 1, "assistant", "z")]
    out = chat.formatted(turns(spark, rows))
    examples = {(r.conv_id, r.example): r for r in chat.examples(out).collect()}
    texts = {(r.conv_id, r.example): r for r in chat.example_texts(out).collect()}
    assert set(examples) == set(texts) == {(1, 0), (1, 1), (None, 0), (None, 1), (None, 2)}
    whole = "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in [("system", "s"), ("user", r"u<\|x"), ("assistant", r"a<\|im_end|>"), ("user", "v"), ("assistant", "b")])
    assert texts[(1, 1)].text == whole
    for key, t in texts.items():
        assert t.text[t.loss_start : t.loss_end] == examples[key].reply
        assert t.text[t.loss_end :] == chat.END + "\n"
    assert examples[(1, 1)].context_turns == 4 and examples[(1, 1)].context_chars == whole.rindex("<|im_start|>")
    assert chat.digests(chat.formatted(turns(spark, rows).limit(0))).count() == 0


def brute_top_k(rows, k):
    """Every row is a candidate, and a query where its id asks for it, whatever other rows have its id."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(kept):
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(kept) if m != n and len(b) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard,block,leaf", [(4096, 1024, 64), (50, 2, 4)])
def test_top_k_against_brute_force(spark, shard, block, leaf):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 3) / 8).tolist()) for i in range(0, 500)]
    rows += [(500 + i, [0.25, 0.25, 0.25]) for i in range(301)]  # a crowd of equal vectors
    rows += [(1000, None), (1100, [None, 1.0, 1.0]), (1200, [float("nan"), 0.0, 0.0]), (1300, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    rows += [(1400, []), (1401, []), (1500, [1.0, 2.0]), (1501, [-3.0, 0.1]), (100, [0.5, 0.5, 0.5]), (100, [0.5, 0.5, 0.5])]
    rows += [(7, [2.0, 2.0, 2.0]), (7, [2.0, 2.0, 2.0]), (7, [-2.0, 0.0, 0.0]), (200, [1.0, -1.0, 0.0])]  # repeated ids
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, dim int, shard string")
    got = topk_search.top_k(table, F.col("vec_id") % 100 == 0, shard=shard, block=block, leaf=leaf)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, 10)


def test_top_k_of_huge_components_and_empty_tables(spark):
    rows = [(0, [1e5, -1e5]), (1, [3e6, 1.0]), (2, [-3e6, 0.5]), (3, [1e-9, -1e-9])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(table, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top_k(rows, 10)
    beyond = spark.createDataFrame([(0, [1e9]), (1, [1e9]), (2, [-1e9])], table.schema)
    got = topk_search.top_k(beyond, F.col("vec_id") % 100 == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 2**63 - 1), (2, -(2**63))]
    assert topk_search.top_k(table.filter("vec_id > 9"), F.col("vec_id") % 100 == 0).count() == 0


def kneser_ney(counts, order, context, letter, types):
    """Continuation probability from the definition: types are all distinct full-length keys."""
    if order == 0:
        return 1 / (toxicity.SYMBOLS + 1)
    grams = {t[-order - 1 :] for t in types}
    left = {}
    for g in grams:
        left[g[1:]] = left.get(g[1:], 0) + 1
    same = {g: n for g, n in left.items() if g[:-1] == context[len(context) - order + 1 :]}
    total = sum(same.values())
    below = kneser_ney(counts, order - 1, context, letter, types)
    own = same.get((*context[len(context) - order + 1 :], letter), 0)
    return max(own - toxicity.DISCOUNT, 0) / total + toxicity.DISCOUNT * len(same) / total * below


def test_shared_counts_are_kneser_ney():
    keys = np.unique(toxicity.grams(["abab", "abba", "b", "cab"])[0])
    mask = (1 << toxicity.BITS) - 1
    types = [tuple(int(k >> toxicity.BITS * (toxicity.ORDER - 1 - i)) & mask for i in range(toxicity.ORDER)) for k in keys]
    got = toxicity._shared(keys)
    for t, p in zip(types, got):
        assert p == pytest.approx(kneser_ney(None, toxicity.ORDER - 1, t[1:-1], t[-1], types))


def test_toxic_texts_are_found(spark):
    sf = "/root/testdata/sf0.1"
    scored = E.queries()["op4_toxicity"](spark, sf)
    marked = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("toxic", "predicted").collect()
    right = sum(r.toxic == r.predicted for r in marked) / len(marked)
    caught = sum(r.predicted for r in marked if r.toxic) / sum(r.toxic for r in marked)
    assert right > 0.97 and caught > 0.75


def test_scores_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(9)] + [(None, 0, 1), (3, 1, None), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(awkward, labels).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0) for r in got)
    none = toxicity.score(awkward, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score(empty, labels).count() == 0
    assert toxicity.accepted(awkward, labels).columns == awkward.columns


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SMOKE}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(toxicity.fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.score(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def brute_scores(docs, labels):
    """doc_id -> score, by the in-memory model of all labelled rows of the learning folds."""

    def crc_fold(i):
        return zlib.crc32(str(i).encode()) % 5

    words = {i: set(toxicity.WORD.findall((t or "").lower())) for i, t in docs}
    spelt = sorted({w for ws in words.values() for w in ws})
    keys, owner = toxicity.grams(spelt)
    kinds, at = np.unique(keys, return_inverse=True)
    counts = {0: dict.fromkeys(spelt, 0), 1: dict.fromkeys(spelt, 0)}
    for i, toxic in labels:
        if i in words and crc_fold(i) in (1, 2, 3):
            for w in words[i]:
                counts[toxic][w] += 1
    toxic, ordinary = (np.bincount(at, weights=np.array([counts[c][w] for w in spelt], float)[owner]) for c in (1, 0))
    value = dict(zip(spelt, toxicity.Model.fit(kinds, toxic, ordinary).score(spelt).tolist()))
    rows = {}
    for i, ws in words.items():
        found, letters = sorted(map(value.get, ws), reverse=True), sum(map(len, ws)) + len(ws)
        rows[i] = [sum(found) / letters, sum(found) / letters**0.5, sum(found[:3]) / 3]
    curve = [(rows[i], t) for i, t in labels if i in rows and crc_fold(i) == 4]
    w = toxicity.fit_curve(np.array([f for f, _ in curve]), np.array([t for _, t in curve]))
    return {i: float(1 / (1 + np.exp(-(w[0] + np.array(f) @ w[1:])))) for i, f in rows.items()}


def toxic_table(spark):
    """Half of the documents have a label; one in three labelled ones is toxic."""
    rng = np.random.default_rng(11)
    plain, rude = ([f"{a}{b}{c}" for a in x for b in ("ar", "olu", "in") for c in y] for x, y in (("bdgl", ("t", "mes", "k")), ("ksz", ("rk", "xt"))))
    docs, labels = [], []
    for i in range(1200):
        toxic = int(i % 6 == 0)
        text = [*rng.choice(plain, 12), *rng.choice(rude, 2 if toxic or i % 50 == 3 else 0), f"q{i}w"]
        docs.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, 0, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, [(i, t) for i, _, t in labels]


@pytest.mark.parametrize("common_words,common_keys", [(100_000, 400_000), (5, 7), (0, 0)])
def test_toxicity_counts_every_labelled_row(spark, common_words, common_keys):
    docs, labels, texts, marks = toxic_table(spark)
    expected = brute_scores(texts, marks)
    # enough rows for the curve's fold, fewer than there are to learn from
    most = sum(zlib.crc32(str(i).encode()) % 5 == 4 for i, _ in marks)
    got = {r.doc_id: r.score for r in toxicity.score(docs, labels, most=most, common_words=common_words, common_keys=common_keys).collect()}
    assert got.keys() == expected.keys() and most < len(marks) / 2
    assert all(got[i] == pytest.approx(expected[i], abs=1e-4) for i in got)
    kept = {r.doc_id for r in toxicity.accepted(docs, labels, most=most, common_words=common_words, common_keys=common_keys).collect()}
    assert kept == {i for i, s in got.items() if s < 0.5} and 0 < len(kept) < len(got)


def test_pipeline_stages_agree_with_the_operators(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, SMOKE), "stage")
        assert docs.columns == columns, name
        after = [(r.doc_id, r.text) for r in docs.collect()]
        assert set(after) <= before
        if name == "exact dedup":
            last = {}
            for d, t in before:
                last[t] = max(d, last.get(t, d))
            assert sorted(after) == sorted((d, t) for t, d in last.items())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).collect()
    assert sum(r.piece == 0 for r in pieces) == len(after)


def test_pipeline_survives_awkward_rows(spark, awkward, empty):
    for table in (awkward, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, SMOKE), "stage")
        docs.collect()


def test_small_queries_match_their_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ("op1_source_mixing", "op6_chat_formatting", "op7_kd_tree_top_k", "op10_exact_dedup"):
        df = E.queries()[name](spark, SMOKE)
        res = con.execute(E.oracle_sql()[name])
        names = [d[0] for d in res.description]
        expected = sorted((tuple(r[names.index(c)] for c in df.columns) for r in res.fetchall()), key=str)
        assert sorted((tuple(r) for r in df.collect()), key=str) == expected, name


def test_the_query_writes_every_example_with_its_whole_context(spark, monkeypatch):
    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(7)] + [(2, 0, "user", "alone")]
    written = {}

    def spy(df, name, write=chat.materialise, **options):
        written[name] = write(df, name, **options)
        return written[name]

    monkeypatch.setattr(chat, "materialise", spy)
    got = {r.conv_id: r for r in chat.digests(chat.formatted(turns(spark, rows))).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].n_turns, got[2].loss_chars) == (7, 6, 1, 0)
    rendered = [f"<|im_start|>{role}\n{text}<|im_end|>\n" for _, _, role, text in rows[:7]]
    expanded = sorted((r.conv_id, r.example, r.context, r.target) for r in written["chat-examples"].collect())
    assert expanded == [(1, n, rendered[: 2 * n + 1], rendered[2 * n + 1]) for n in range(3)]
