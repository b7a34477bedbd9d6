"""Every stage of the pipeline against brute force on the small table."""

import zlib
from collections import Counter

import duckdb
import numpy as np

import corpus_pipeline
from llm_tables import SMOKE
from presslens.llm import mixing, packing, simhash
from test_chat_search_toxicity import brute_scores
from test_dedup import brute_fingerprint, clusters
from test_tokens_packing import ids


def toxic(rows, labels, got):
    fitted = {t for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 4 and i in {d for d, _, _ in rows}}
    assert fitted == {0, 1}  # else every score is the share of toxic rows
    scores = brute_scores([(d, t) for d, t, _ in rows], labels)
    # the model rounds ratios, which can settle a score of 0.5 either way: one document of the small table
    close = {d for d, s in scores.items() if abs(s - 0.5) < 1e-4}
    assert len(close) <= 1
    return Counter(r for r in rows if (r in got if r[0] in close else scores[r[0]] < 0.5))


def exact(rows, got):
    last = {}
    for r in rows:
        last[r[1]] = max(r, last.get(r[1], r))
    return Counter(last.values())


def near(rows, got):
    rows = sorted(rows)
    groups = clusters(np.array([brute_fingerprint(t) for _, t, _ in rows], dtype=np.uint64), simhash.RADIUS)
    return Counter({g: r for g, r in zip(reversed(groups), reversed(rows))}.values())


def mixed(rows, got):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    res = con.execute(mixing.ORACLE)
    names = [d[0] for d in res.description]
    taken = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in (dict(zip(names, x)) for x in res.fetchall())}
    return Counter({r: taken[r[0]] for r in rows if taken[r[0]]})


def test_stages_against_brute_force(spark):
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()]
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], (lambda rows, got: toxic(rows, labels, got), exact, near, mixed)):
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = corpus_pipeline.materialise(stage(spark, docs, SMOKE), "stage")
        after = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
        assert after == brute(before, after), name
    lengths, filled = Counter(), {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).collect():
        lengths[r.doc_id] += r.length
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    expected = Counter()
    for r in docs.collect():
        expected[r.doc_id] += len(ids(r.text, packing.END_ID))
    assert lengths == expected
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])[:-1]].tolist()
        assert sum(n for _, n in parts) <= packing.CAPACITY
