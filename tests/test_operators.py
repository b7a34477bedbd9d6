"""Operators against the reference's documented behaviours and brute force."""

import datetime as dt
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from presslens.operators import analysis as AN
from presslens.operators import clean as C
from presslens.operators.dedup import first_by_key, latest_by_key
from presslens.operators.neighbours import neighbours_topk
from presslens.plans.charts import exact_quantiles
from presslens.plans.live import arrival_rate
from presslens.schemas import ARTICLE
from presslens.sources import catalogue as CG
from presslens.sources import feeds as FD
from presslens.sources import pages as PG

T0 = dt.datetime(2024, 1, 1)


def _raw(spark, rows):
    return spark.createDataFrame(
        [(0, i, *r) for i, r in enumerate(rows)],
        "arm int, seq long, source string, country_target string, title string, summary string, url string, "
        "published_at timestamp_ntz, extracted_at timestamp_ntz")


def test_clean_precedence_and_counters(spark):
    u = "https://news.example.com/a"
    rows = [
        ("s", "DE", "ok title", None, "not a url", None, T0),
        ("s", "DE", "  Here’s the latest. ", None, u, None, T0),
        ("s", "DE", "Real headline", "<p>Hi <b>x</b></p>", u, None, T0),
        ("s", "DE", "Later copy", None, u + "?utm_source=z", None, T0),
        ("s", "DE", None, None, "https://news.example.com/b/", None, T0),
    ]
    raw = _raw(spark, rows)
    counts = C.clean_counts(raw).first().asDict()
    assert counts == {"raw_in": 5, "clean_out": 2, "dropped_no_url": 1, "dropped_stub": 1, "dropped_dupe": 1}
    out = {r.url: r for r in C.clean(raw).collect()}
    assert set(out) == {u, "https://news.example.com/b"}
    assert out[u].title == "Real headline" and out[u].summary == "Hi x"
    assert out["https://news.example.com/b"].title is None


def test_clean_all_stub_url_is_dropped(spark):
    u = "https://h.example/x"
    raw = _raw(spark, [("s", "US", "Here's the latest.", None, u, None, T0)] * 3)
    assert C.clean(raw).count() == 0
    assert C.clean_counts(raw).first().dropped_stub == 3


def test_dedup_hot_key_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"  # one key holds a third of the rows
        rows.append((key, rnd.randint(0, 50), i, f"v{i}"))
    df = spark.createDataFrame(rows, "k string, t int, seq int, v string")
    first = {r.k: r.v for r in first_by_key(df, "k", ["t", "seq"]).collect()}
    last = {r.k: r.v for r in latest_by_key(df, "k", ["t", "seq"]).collect()}
    want_first, want_last = {}, {}
    for k, t, seq, v in rows:
        if k not in want_first or (t, seq) < want_first[k][0]:
            want_first[k] = ((t, seq), v)
        if k not in want_last or (t, seq) > want_last[k][0]:
            want_last[k] = ((t, seq), v)
    assert first == {k: v for k, (_, v) in want_first.items()}
    assert last == {k: v for k, (_, v) in want_last.items()}


def test_link_harvest_text_title_wins(spark):
    html = ('<a href="https://news.example/article/1"><img src="x.jpg"></a>'
            '<a href="https://news.example/article/1">First title</a>'
            '<a href="https://news.example/article/2"> Second </a>'
            '<a href="https://other.example/x">Other</a>')
    pages = spark.createDataFrame([(1, "https://news.example/", html)], "page_id long, url string, html string")
    out = PG.harvest_links(pages, r"^https://news\.example/article/\d+$").orderBy("rank").collect()
    assert [(r.url, r.title, r.rank) for r in out] == [
        ("https://news.example/article/1", "First title", 1), ("https://news.example/article/2", "Second", 2)]


def test_link_harvest_stops_at_cap(spark):
    anchors = "".join(f'<a href="/a/{i}"></a>' for i in range(5))
    anchors += '<a href="/a/0">late title</a><a href="/a/9">late url</a>'
    pages = spark.createDataFrame([(1, "https://x/", anchors)], "page_id long, url string, html string")
    out = PG.harvest_links(pages, r"^/a/\d+$", max_links=3).orderBy("rank").collect()
    assert [r.url for r in out] == ["/a/0", "/a/1", "/a/2"]
    assert all(r.title is None for r in out)  # the late title comes after the cap was reached


def test_null_fill_homepage_value_wins_when_not_null(spark):
    home = spark.createDataFrame([
        ("https://s/a", "Home A", None), ("https://s/b", None, None), ("https://s/c", "", None),
        ("https://s/d", "Home D", None), (None, "no url", None)],
        "url string, title string, summary string")
    art = spark.createDataFrame([
        ("https://s/a", "Article A title", "Sum A"), ("https://s/b", "Article B title", "Sum B"),
        ("https://s/c", "Article C title", "Sum C")], "url string, title string, summary string")
    out = {r.url: (r.title, r.summary) for r in PG.fill_from_articles(home, art).collect()}
    assert out == {"https://s/a": ("Home A", "Sum A"), "https://s/b": ("Article B title", "Sum B"),
                   "https://s/c": ("", "Sum C"), "https://s/d": ("Home D", None)}


def test_list_items_first_k_before_filter(spark):
    items = "<ul>" + "<li></li>" * 3 + "".join(f'<li><a href="/n/{i}">N{i}</a></li>' for i in range(20)) + "</ul>"
    pages = spark.createDataFrame([(1, "https://site.example/home", items)], "page_id long, url string, html string")
    out = PG.list_items(pages, r"(?is)<li\b[^>]*>.*?</li>").orderBy("pos").collect()
    assert len(out) == 12  # 15 items taken before the 3 empty ones are filtered
    assert out[0].url == "https://site.example/n/0" and out[0].title == "N0" and out[0].summary == ""


def test_time_chunks(spark):
    r = spark.createDataFrame([("q", T0, T0 + dt.timedelta(hours=5, minutes=30))],
                              "query string, s timestamp_ntz, e timestamp_ntz")
    out = FD.time_chunks(r, "s", "e", 45).orderBy("window_start").collect()
    assert [(x.window_start, x.window_end) for x in out] == [
        (T0 + dt.timedelta(hours=h), T0 + dt.timedelta(hours=h + 1)) for h in range(5)]


@pytest.mark.parametrize("n,ok,aborted", [(60, 2, 60), (60, 3, None), (80, 3, 61), (59, 0, None)])
def test_circuit_breaker(spark, n, ok, aborted):
    # 2/60 = 0.033 < 0.05 aborts at 60; 3/60 = 0.05 is not below; 3/61 is
    rows = [(T0.date(), i + 1, "ok" if i < ok else "bad") for i in range(n)]
    log = spark.createDataFrame(rows, "sweep date, seq long, status string")
    r = FD.circuit_breaker(log).first()
    assert r.aborted_at == aborted
    assert r.skipped == (n - aborted if aborted else 0)


def test_arrival_rate_divides_by_nonempty_seconds(spark):
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [(base - dt.timedelta(minutes=5), 100), (base - dt.timedelta(seconds=30), 5),
            (base - dt.timedelta(seconds=10), 4), (base, 3)]
    df = spark.createDataFrame(rows, "sec timestamp_ntz, arrivals long")
    r = arrival_rate(df).first()
    assert r.last_minute_arrivals == 12 and r.nonempty_seconds == 3 and r.rate_nonempty == 4.0


def test_feed_items_summary_and_link(spark):
    items = spark.createDataFrame([
        (1, "<item><title>A</title><link>https://x/1</link><summary></summary>"
            "<description>&lt;p&gt;D&lt;/p&gt;</description><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item>"),
        (2, "<item><title>B</title><link></link><summary>S</summary></item>"),
        (3, "<item><title>C</title><link>https://x/3</link><summary>S3</summary>"
            "<updated>2024-01-02T00:00:00Z</updated></item>")], "id int, item_xml string")
    out = {r.id: r for r in FD.item_rows(items, F.lit(None).cast("timestamp_ntz")).collect()}
    assert set(out) == {1, 3}
    assert out[1].summary == "<p>D</p>" and out[1].published_at == dt.datetime(2024, 1, 1, 10)
    assert out[3].summary == "S3" and out[3].published_at == dt.datetime(2024, 1, 2)


def test_fan_out_rules(spark):
    cat = spark.createDataFrame([
        Row(country="DE", country_pos=1, lang="de", gl="DE", ceid="DE:de", langs=None, topics=["WORLD"],
            queries=["Wahl Berlin"]),
        Row(country="KZ", country_pos=2, lang="ru", gl="KZ", ceid="KZ:ru", langs=["ru", "kk"], topics=[],
            queries=["Astana"]),
    ], "country string, country_pos int, lang string, gl string, ceid string, langs array<string>, "
       "topics array<string>, queries array<string>")
    feeds = CG.fan_out(cat).collect()
    assert len(feeds) == (1 + 7) + 2 * 7
    topic = [f for f in feeds if "/topic/" in f.rss][0]
    assert topic.rss.endswith("hl=de&gl=DE&ceid=DE:de") and topic.source == "Google News DE/de / WORLD"
    q_all = [f for f in feeds if f.source == "Google News DE/de / q:Wahl Berlin (all)"][0]
    assert "q=Wahl+Berlin&" in q_all.rss
    q_1h = [f for f in feeds if f.source == "Google News DE/de / q:Wahl Berlin (1h)"][0]
    assert "q=Wahl+Berlin+when%3A1h&" in q_1h.rss
    kk = [f for f in feeds if f.language == "kk"]
    assert kk and all(f.rss.endswith("ceid=KZ:kk") for f in kk)
    inter = CG.interleave(CG.fan_out(cat)).orderBy("round", "country_order").collect()
    assert [f.country_target for f in inter[:4]] == ["DE", "KZ", "DE", "KZ"]


@pytest.mark.parametrize("spec", ["3/2", "a/b", "-1/4", "1/0"])
def test_parse_shard_rejects(spec):
    with pytest.raises(ValueError):
        CG.parse_shard(spec)


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(5)
    n = 90
    vecs = rng.normal(size=(n, 8)).astype(np.float32)
    labels = np.where(np.arange(n) < 60, 0, 1)  # block 0 is hot (2/3 of the rows)
    df = spark.createDataFrame([(int(i), vecs[i].tolist(), int(labels[i])) for i in range(n)],
                               "vec_id long, embedding array<float>, label int")
    got = {(r.vec_id, r.rank): r.neighbour_id for r in neighbours_topk(df, k=4, tile=8).collect()}
    unit = vecs.astype(np.float64) / np.linalg.norm(vecs.astype(np.float64), axis=1, keepdims=True)
    want = {}
    for i in range(n):
        cand = [j for j in range(n) if j != i and labels[j] == labels[i]]
        sims = sorted(((-(unit[i] @ unit[j]), j) for j in cand))[:4]
        for r, (_, j) in enumerate(sims, 1):
            want[(i, r)] = j
    assert got == want


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice("ab"), rnd.randint(0, 40)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = {r.k: (r._q0, r._q1, r._q2) for r in exact_quantiles(df, "k", "v").collect()}
    for k in "ab":
        xs = np.array([v for kk, v in rows if kk == k], dtype=float)
        want = tuple(np.percentile(xs, [25, 50, 75]))
        assert np.allclose(got[k], want)


def test_js_to_pool_matches_brute_force(spark):
    rows = [("a", "x")] * 3 + [("a", "y")] + [("b", "y")] * 2 + [("b", "z")] * 2
    df = spark.createDataFrame(rows, "g string, token string")
    got = {r.g: r.jsd for r in AN.js_to_pool(AN.distribution(df, ["g"]), "g").collect()}
    pool = {"x": 3 / 8, "y": 3 / 8, "z": 2 / 8}
    for g, p in {"a": {"x": .75, "y": .25}, "b": {"y": .5, "z": .5}}.items():
        jsd = 0.0
        for t, q in pool.items():
            pp = p.get(t, 0.0)
            m = (pp + q) / 2
            jsd += 0.5 * (pp * math.log(pp / m) if pp else 0) + 0.5 * q * math.log(q / m)
        assert got[g] == pytest.approx(jsd)


def test_detect_language(spark):
    docs = spark.createDataFrame([(1, "The cat and the dog with a hat"), (2, "Le chat et les chiens dans la rue"),
                                  (3, "Der Hund und die Katze"), (4, "12345 !!")], "doc_id int, text string")
    got = {r.doc_id: r.predicted for r in AN.detect_language(docs).collect()}
    assert got == {1: "en", 2: "fr", 3: "de", 4: None}


TFIDF_ROWS = [(1, "The sea, the SAND; the sea"), (2, "sea law"), (2, "Law of  laws"), (None, "sea élan"), (None, None),
              (3, "an ox"), (4, ""), (5, None)] + [(i, f"common word{'x' * (i % 7)} sea") for i in range(10, 40)]


def _tfidf_expected(rows):
    tf = Counter((i, w) for i, t in rows for w in re.split(r"[\W\d_]+", (t or "").lower()) if len(w) >= 3)
    df = Counter(w for _, w in tf)
    idf = {w: math.log((len(rows) + 1) / (n + 1)) for w, n in df.items()}
    norm = Counter()
    for (i, w), n in tf.items():
        norm[i] += (n * idf[w]) ** 2
    return {(i, w): (n, df[w], n * idf[w] / math.sqrt(norm[i]) if norm[i] else 0.0) for (i, w), n in tf.items()}


@pytest.mark.parametrize("batch", ["1", "10000"])  # rows of one id in several batches, or in one
@pytest.mark.parametrize("block", [3, 1000])
def test_tfidf_in_blocks_against_brute_force(spark, block, batch):
    docs = spark.createDataFrame(TFIDF_ROWS, "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = AN.tfidf(docs, block=block).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    found = {(r.doc_id, r.term): (r.tf, r.df, pytest.approx(r.weight)) for r in got}
    assert len(found) == len(got) and found == _tfidf_expected(TFIDF_ROWS)


def test_tfidf_ids_of_text_weights_of_zero_and_no_rows(spark):
    docs = spark.createDataFrame([("a", "sea sand"), ("b", "sea sand")], "key string, body string")
    got = AN.tfidf(docs, "key", "body").orderBy("key", "term").collect()
    assert [tuple(r) for r in got] == [(k, w, 1, 2, 0.0) for k in "ab" for w in ("sand", "sea")]
    none = AN.tfidf(docs.filter("key = 'c'"), "key", "body")
    assert none.count() == 0 and none.columns == ["key", "term", "tf", "df", "weight"]


def test_tfidf_shuffles_no_row_per_document_and_term(spark):
    docs = spark.createDataFrame(TFIDF_ROWS, "doc_id long, text string")
    plan = AN.tfidf(docs)._jdf.queryExecution().executedPlan().toString()
    dealt = set(re.findall(r"hashpartitioning\((\w+?)#", plan))
    assert dealt == {"_block", "term"}  # rows with lists, and vocabularies of blocks


def test_article_schema_has_seven_columns():
    assert [f.name for f in ARTICLE.fields] == ["source", "country_target", "title", "summary", "url",
                                               "published_at", "extracted_at"]


def test_tiles_need_heading_and_anchor(spark):
    html = ('<div class="tile"><h3>Flood relief</h3><a href="/2026/05/01/flood">more</a></div>'
            '<div class="tile"><a href="/2026/05/02/no-heading">x</a></div>'
            '<div class="tile"><h3>No link</h3></div>'
            '<div class="tile"><h3>Undated</h3><a href="https://other.example/story">y</a></div>')
    pages = spark.createDataFrame([(1, "https://mm.example/", html)], "page_id long, url string, html string")
    out = PG.list_items(pages, r'(?is)<div class="tile">.*?</div>', heading_re=r"(?is)<h3[^>]*>(.*?)</h3>",
                        before_filter=None).orderBy("pos").collect()
    assert [(r.title, r.url, r.published_at) for r in out] == [
        ("Flood relief", "https://mm.example/2026/05/01/flood", dt.datetime(2026, 5, 1)),
        ("Undated", "https://other.example/story", None)]


def test_running_sums_blocks_match_plain_window(spark):
    from presslens.operators.running import running_sums
    rnd = random.Random(9)
    rows = [(g, s, rnd.randint(0, 1)) for g in ("a", "b") for s in rnd.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "g string, seq long, x int")
    out = running_sums(df, "g", "seq", {"n": F.lit(1).cast("bigint"), "xs": F.col("x").cast("bigint")},
                       block_size=97)
    got = {(r.g, r.seq): (r.n, r.xs) for r in out.collect()}
    for g in ("a", "b"):
        n = xs = 0
        for _, s, x in sorted(r for r in rows if r[0] == g):
            n += 1
            xs += x
            assert got[(g, s)] == (n, xs)


def test_circuit_breaker_across_blocks(spark):
    rows = [(T0.date(), i + 1, "ok" if i < 2 else "bad") for i in range(200)]
    log = spark.createDataFrame(rows, "sweep date, seq long, status string")
    r = FD.circuit_breaker(log, block_size=7).first()
    assert r.aborted_at == 60 and r.skipped == 140


def test_fan_out_country_restriction(spark):
    cat = spark.createDataFrame([
        Row(country="DE", country_pos=1, lang="de", gl="DE", ceid=None, langs=None, topics=["WORLD"], queries=[]),
        Row(country="IT", country_pos=2, lang="it", gl="IT", ceid=None, langs=None, topics=["WORLD"], queries=[]),
    ], "country string, country_pos int, lang string, gl string, ceid string, langs array<string>, "
       "topics array<string>, queries array<string>")
    feeds = CG.fan_out(cat, countries=["IT"]).collect()
    assert [f.country_target for f in feeds] == ["IT"] and feeds[0].rss.endswith("ceid=IT:it")


def test_missing_body_filters_and_validation(spark):
    from presslens.operators.backfill import missing_body
    arts = spark.createDataFrame([
        ("https://news.google.com/x", "Agg", "DE", None), ("https://a.example/1", "Spiegel", "DE", ""),
        ("https://a.example/2", "Spiegel", "DE", "has body"), ("https://b.example/1", "Corriere", "IT", None)],
        "url string, source string, country_target string, body string")
    assert sorted(r.url for r in missing_body(arts).collect()) == ["https://a.example/1", "https://b.example/1"]
    assert [r.url for r in missing_body(arts, country="de").collect()] == ["https://a.example/1"]
    assert [r.url for r in missing_body(arts, source_like="Corr%").collect()] == ["https://b.example/1"]
    assert missing_body(arts, limit=1).count() == 1
    for bad in ({"country": "DEU"}, {"country": "D'"}, {"source_like": "x' OR '1'='1"}):
        with pytest.raises(ValueError):
            missing_body(arts, **bad)


def test_fused_backfill_equals_step_by_step(spark):
    from presslens.operators import backfill as B
    arts = spark.createDataFrame([
        ("https://a/1", "DE", None), ("https://a/2", "DE", "kept"), ("https://a/3", "IT", ""),
        ("https://news.google.com/x", "US", None), ("https://a/4", None, None)],
        "url string, country_target string, body string")
    bodies = spark.createDataFrame([("https://a/1", "B1"), ("https://a/2", "B2"), ("https://a/3", None),
                                    ("https://news.google.com/x", "G")], "url string, body string")
    fused = sorted(map(tuple, B.fill_bodies(arts, bodies).collect()), key=str)
    steps = sorted(map(tuple, B.merge_bodies(arts, B.enrich(B.missing_body(arts), bodies)).collect()), key=str)
    assert fused == steps
    assert dict((u, b) for u, _, b in fused) == {"https://a/1": "B1", "https://a/2": "kept", "https://a/3": "",
                                                 "https://news.google.com/x": None, "https://a/4": None}


def test_extract_by_rules_per_outlet(spark):
    tiles = ('<div class="tile"><h3>Flood relief</h3><a href="/2026/05/01/flood">more</a></div>'
             '<div class="tile"><a href="/x">no heading</a></div>')
    lists = "<ul>" + "".join(f'<li><a href="/n/{i}">N{i}</a></li>' for i in range(5)) + "</ul>"
    pages = spark.createDataFrame([
        (1, "https://mm.example/", tiles), (2, "https://kz.example/home", lists), (3, "https://other.example/", lists)],
        "page_id long, url string, html string")
    rules = spark.createDataFrame([
        ("mm.example", "Outlet MM", "MM", r'(?is)<div class="tile">.*?</div>', None, r"(?is)<h3[^>]*>(.*?)</h3>",
         None, None),
        ("kz.example", "Outlet KZ", "KZ", r'(?is)<div class="card">.*?</div>', r"(?is)<li\b[^>]*>.*?</li>", None,
         15, 3),
    ], PG.RULES_SCHEMA)
    out = PG.extract_by_rules(pages, rules).orderBy("page_id", "pos").collect()
    assert [(r.source, r.title, r.url) for r in out] == [
        ("Outlet MM", "Flood relief", "https://mm.example/2026/05/01/flood"),
        ("Outlet KZ", "N0", "https://kz.example/n/0"), ("Outlet KZ", "N1", "https://kz.example/n/1"),
        ("Outlet KZ", "N2", "https://kz.example/n/2")]
    assert out[0].published_at == dt.datetime(2026, 5, 1)


def test_vectors_without_direction_have_no_neighbours(spark):
    rows = [(1, "x", [1.0, 0.0]), (2, "x", [1.0, 1.0]), (3, "x", [0.0, 0.0]), (4, "x", None),
            (5, "x", [float("nan"), 1.0]), (6, "x", [float("inf"), 1.0]), (7, "x", [None, 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {(r.vec_id, r.neighbour_id) for r in neighbours_topk(v, k=3).collect()}
    assert got == {(1, 2), (2, 1)}
