"""Declared analysis targets (D01-D09, D14) as DataFrame jobs.

Everything here is an aggregation or an equi-join on a key; per-document work
(language scores, lexicon hits) is array arithmetic inside the row, so it
needs no shuffle at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.session import written

# --- fixed values -------------------------------------------------------------
# Function-word profiles for language detection.
LANG_PROFILES = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "mit", "sich", "für", "auf",
           "den", "dem", "von", "sch", "auch", "es", "im"),
    "en": ("the", "and", "of", "to", "is", "a", "with", "from", "for", "was", "this", "that", "it", "in",
           "on", "as", "be", "by", "or", "are"),
    "es": ("el", "la", "de", "que", "y", "en", "los", "se", "del", "las", "un", "por", "con", "para",
           "una", "es", "al", "lo", "como", "más"),
    "fr": ("le", "la", "les", "des", "et", "en", "un", "une", "du", "qui", "que", "est", "pour", "dans",
           "sur", "au", "elle", "ne", "pas", "il"),
}
# Negative-language lexicon for the sentiment label.
NEGATIVE_LEXICON = ("idiot", "moron", "clown", "worthless", "stupid", "pathetic", "loser", "dumb",
                    "trash", "hate")
# ------------------------------------------------------------------------------

WORD_SPLIT = r"[^\p{L}]+"
LN2 = math.log(2.0)
#: (document, term) entries that one task weighs at once
BLOCK = 500_000


def words(text: Column) -> Column:
    return F.split(F.lower(text), WORD_SPLIT)


def normalise_whitespace(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"^ | $", "")


def count_in(tokens: Column, vocab) -> Column:
    lst = F.array(*[F.lit(w) for w in vocab])
    return F.size(F.filter(tokens, lambda t: F.array_contains(lst, t)))


def detect_language(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document: hits of each language profile over the whole text; the
    best-scoring language (ties -> alphabetical), NULL when nothing matched."""
    toks = words(F.col(text_col))
    out = docs.withColumn("_toks", toks)
    langs = sorted(LANG_PROFILES)
    for lang in langs:
        out = out.withColumn(f"score_{lang}", count_in(F.col("_toks"), LANG_PROFILES[lang]))
    ranked = F.sort_array(F.array(*[F.struct((-F.col(f"score_{l}")).alias("s"), F.lit(l).alias("l"))
                                    for l in langs]))
    best = ranked[0]
    return out.drop("_toks").withColumn("predicted", F.when(best["s"] < 0, best["l"]))


def _added_up(ids: pa.Array, texts: pa.Array, counts: np.ndarray | None = None):
    """Rows of an id and its words, a space between them (and how often each occurs, or
    once), as one entry per id and word: (ids, words, then over the entries the
    place of the id, the place of the word and the count)."""
    who = ids.dictionary_encode(null_encoding="encode")
    lists = pc.split_pattern(texts, " ")
    what = lists.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(who.indices.to_numpy().astype(np.int64), lengths)
    word = what.indices.to_numpy().astype(np.int64)
    if counts is not None and len(who.dictionary) == len(ids):  # no id comes twice, so no entry does
        return who.dictionary, what.dictionary, owner, word, counts
    size = max(len(what.dictionary), 1)
    if counts is None:
        entry, n = np.unique(owner * size + word, return_counts=True)
    else:
        entry, at = np.unique(owner * size + word, return_inverse=True)
        n = np.zeros(len(entry), np.int64)
        np.add.at(n, at, counts)
    return who.dictionary, what.dictionary, entry // size, entry % size, n


def _term_counts(min_len: int):
    """Per batch: one row per id with its terms and how often they occur."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms, owner, term, tf = _added_up(*batch.columns)
            long = pc.greater_equal(pc.utf8_length(terms), min_len).to_numpy(zero_copy_only=False)[term]
            owner, term, tf = owner[long], term[long], tf[long].astype("<i4")
            size = np.bincount(owner, minlength=len(ids))
            ends = np.cumsum(size)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), terms.take(pa.array(term)))
            counts = pa.array([tf[a:b].tobytes() for a, b in zip(ends - size, ends)], pa.binary())
            rows = pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pc.binary_join(lists, " "), counts],
                                              ["_id", "_n", "_terms", "_tfs"])
            yield rows.filter(pa.array(size > 0))
    return fn


def _whole(column: pa.ChunkedArray) -> pa.Array:
    """The column as one array."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _entries(block: pa.Table):
    """The entries of a block's documents."""
    return _added_up(_whole(block["_id"]), _whole(block["_terms"]), np.frombuffer(b"".join(block["_tfs"].to_pylist()), "<i4"))


def _block_frequencies(block: pa.Table) -> pa.Table:
    """How many ids of the block hold each term."""
    _, terms, _, term, _ = _entries(block)
    n = np.bincount(term, minlength=len(terms))
    return pa.table([pa.repeat(block["_block"][0], len(terms)), terms, pa.array(n, pa.int64())], ["_block", "term", "n"])


def _weigh(names: list[str]):
    """One block and the frequencies of its terms: the weighted entries."""
    def fn(block: pa.Table, frequencies: pa.Table) -> pa.Table:
        ids, terms, owner, term, tf = _entries(block)
        known = pc.index_in(terms, value_set=_whole(frequencies["term"]))
        df, idf = (_whole(frequencies[c]).take(known).to_numpy() for c in ("df", "idf"))
        w = tf * idf[term]
        norm = np.sqrt(np.bincount(owner, w * w, len(ids)))[owner]
        weight = np.divide(w, norm, out=np.zeros(len(w)), where=norm > 0)
        return pa.table([ids.take(pa.array(owner)), terms.take(pa.array(term)), pa.array(tf, pa.int64()),
                         pa.array(df[term], pa.int64()), pa.array(weight)], names)
    return fn


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 3,
          block: int = BLOCK) -> DataFrame:
    """L2-normalised TF-IDF weights (doc, term, weight), idf = ln((N+1)/(df+1)).
    Terms are whole-text words of at least ``min_len`` letters.

    No row per document and term is shuffled. Words are counted where their text
    lies, one row per document (its terms joined by spaces, their counts beside
    them), written once. Documents are dealt into blocks of about ``block``
    (document, term) entries; of each block only its vocabulary goes to the
    terms' document frequencies, these come back to the blocks that hold the
    term, and a block weighs its documents with them. A frequent term is one row
    per block. Rows of one id meet in one block with their counts added up, so a
    repeated id brings its vocabulary once per batch of texts at most."""
    spaced = F.regexp_replace(F.lower(F.col(text_col)), WORD_SPLIT, " ")
    texts = docs.select(F.col(id_col).alias("_id"), spaced.alias("_text"))
    of_id = texts.schema["_id"].dataType.simpleString()
    counted = written(texts.mapInArrow(_term_counts(min_len), f"_id {of_id}, _n long, _terms string, _tfs binary"), "tf")
    blocks = F.floor(F.coalesce(counted.agg(F.sum("_n")).scalar(), F.lit(0)) / block) + 1
    dealt = counted.drop("_n").withColumn("_block", F.pmod(F.xxhash64("_id"), blocks))
    found = dealt.groupBy("_block").applyInArrow(_block_frequencies, "_block long, term string, n long")
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    df = found.select("_block", "term", F.sum("n").over(Window.partitionBy("term")).alias("df")).withColumn(
        "idf", F.log((n_docs + 1) / (F.col("df") + 1)))
    names = [id_col, "term", "tf", "df", "weight"]
    return dealt.groupBy("_block").cogroup(df.groupBy("_block")).applyInArrow(
        _weigh(names), f"`{id_col}` {of_id}, term string, tf long, df long, weight double")


def distribution(df: DataFrame, keys: list[str], token: str = "token") -> DataFrame:
    """p(token | keys) from a table of token occurrences."""
    c = df.groupBy(*keys, token).agg(F.count(F.lit(1)).alias("n"))
    # per-key totals joined back (one row per key) instead of a whole-partition
    # window, which would hold a hot key's entire vocabulary in one task
    tot = c.groupBy(*keys).agg(F.sum("n").alias("_tot"))
    return c.join(tot, list(keys)).withColumn("p", F.col("n") / F.col("_tot")).drop("_tot")


def js_to_pool(dist: DataFrame, key: str, token: str = "token") -> DataFrame:
    """Jensen-Shannon divergence (nats) of each group's distribution against the
    pooled distribution of all groups. Tokens outside a group's support add
    ln2 * p_pool each, so only the group's own tokens are joined (no
    group x vocabulary product)."""
    total = dist.agg(F.sum("n")).scalar()
    pool = dist.groupBy(token).agg(F.sum("n").alias("_n")).select(token, (F.col("_n") / total).alias("q"))
    j = dist.join(pool, token)
    m = (F.col("p") + F.col("q")) / 2
    return j.groupBy(key).agg(
        (0.5 * F.sum(F.col("p") * F.log(F.col("p") / m)) +
         0.5 * (F.sum(F.col("q") * F.log(F.col("q") / m)) + F.lit(LN2) * (1 - F.sum("q")))).alias("jsd"))


def js_between(a: DataFrame, b: DataFrame, key: str, token: str = "token") -> DataFrame:
    """Jensen-Shannon divergence between two distributions per key over the
    union of their supports (full outer equi-join on (key, token))."""
    j = a.select(key, token, F.col("p").alias("pa")).join(b.select(key, token, F.col("p").alias("pb")),
                                                          [key, token], "full_outer")
    pa, pb = F.coalesce("pa", F.lit(0.0)), F.coalesce("pb", F.lit(0.0))
    m = (pa + pb) / 2

    def term(p):
        return F.when(p > 0, p * F.log(p / m)).otherwise(F.lit(0.0))
    return j.groupBy(key).agg((0.5 * F.sum(term(pa)) + 0.5 * F.sum(term(pb))).alias("jsd"))


def centroids(vectors: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Per-key centroid as (key, dim, value) plus the global centroid under key NULL."""
    ex = vectors.select(key, F.posexplode(vec).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    per = ex.groupBy(key, "dim").agg(F.sum("x").alias("_s"), F.count(F.lit(1)).alias("_c"))
    glob = per.groupBy("dim").agg((F.sum("_s") / F.sum("_c")).alias("g"))
    return per.withColumn("c", F.col("_s") / F.col("_c")).join(glob, "dim").select(key, "dim", "c", "g")


def centroid_cosine_distance(vectors: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    c = centroids(vectors, key, vec)
    return c.groupBy(key).agg(
        (1 - F.sum(F.col("c") * F.col("g")) /
         (F.sqrt(F.sum(F.col("c") * F.col("c"))) * F.sqrt(F.sum(F.col("g") * F.col("g"))))).alias("distance"))


def attention_asymmetry(counts: DataFrame, country: str, topic: str) -> DataFrame:
    """Per topic: each country's share of its own attention on the topic;
    asymmetry = max share - min share over all countries (a country that never
    covers the topic has share 0; counted, not materialised)."""
    per_country = counts.groupBy(country).agg(F.sum("n").alias("_tot"))
    n_countries = F.count(F.lit(1)).over(Window.partitionBy())
    per_country = per_country.withColumn("_nc", n_countries)
    s = counts.join(per_country, country).withColumn("share", F.col("n") / F.col("_tot"))
    agg = s.groupBy(topic).agg(F.count(F.lit(1)).alias("countries"), F.max("share").alias("max_share"),
                               F.min("share").alias("_min_present"), F.first("_nc").alias("_nc"))
    return agg.select(topic, "countries", "max_share",
                      F.when(F.col("countries") < F.col("_nc"), F.lit(0.0)).otherwise(F.col("_min_present"))
                      .alias("min_share")).withColumn("asymmetry", F.col("max_share") - F.col("min_share"))


def lexicon_hits(text: Column, lexicon=NEGATIVE_LEXICON) -> Column:
    return count_in(words(text), lexicon)
