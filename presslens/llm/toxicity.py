"""Toxicity by class-conditional Kneser-Ney models of words' spelling.

Two models, toxic and ordinary, give the probability of each letter after the
ORDER - 1 letters before it in its word. Each discounts its own counts and backs
off to counts that both classes share (and those to shared continuation counts),
so an expression too rare to say anything about a class scores the same in both.
A text's two log-likelihoods are compared over its distinct words, so that a word
said a thousand times is one piece of evidence, and normalised by length in
three ways: per letter, per root of letters, and per expression over the PEAK
most toxic ones, which a long text does not dilute. A logistic curve maps the
three to 0..1.

Class counts come from every labelled row whose crc32(id as text) mod 5 is 1, 2
or 3; the shared counts know the words of all documents, whatever their label.
The curve is fitted on 4, on about MAX_LABELLED rows at most (chosen by a hash of
the id), and 0 is held out. Words, counts and probabilities are tables that grow
with the input; tasks are given only the COMMON_WORDS and COMMON_KEYS most used
entries, which saves most of the joins, and what they lack is joined. Every text
is scored whole. Sums are of integers, so no order of rows changes a score.

Defined results: null texts count as empty; a text without words scores the share
of toxic rows among those the curve is fitted on; a null id has crc32 of the empty
text; without labels of both classes every score is that share (0 if there are
none); a document with several label rows is learned once per row; repeated rows
are scored alike; a score of exactly one half counts as toxic; very long texts
are scored whole, by their distinct words; an empty table gives an empty result;
``accepted`` carries other columns along, names that clash with helpers included.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, unused

ORDER = 6
DISCOUNT = 0.75
#: weight of the shared counts, in occurrences of a context
SHARED = 30
PEAK = 3
MAX_LABELLED = 200_000
FOLDS, HELD_OUT, CURVE_FOLD = 5, 0, 4
#: letters are told apart by code point modulo SYMBOLS; 0 pads, SYMBOLS ends a word
SYMBOLS, BITS = 1022, 10
WORD = re.compile(r"\w+")
#: distinct words remembered by a task
REMEMBERED = 300_000
#: most used words and letters in context that every task is given; longer words are always joined
COMMON_WORDS, COMMON_KEYS, LONG = 100_000, 400_000, 64
#: log-likelihood ratios are kept in units of 1 / UNIT
UNIT = 1 << 24


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, word) of every letter of the words, end included: the letter and those before it, 10 bits each, the letter lowest."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    text = "\0".join(words) + "\0"
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    ends = letters == 0
    symbols = np.where(ends, SYMBOLS, letters % (SYMBOLS - 1) + 1)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keys = symbols.copy()
    for back in range(1, ORDER):
        before = np.r_[np.zeros(back, np.int64), symbols[:-back]][: len(symbols)]
        keys |= np.where(place >= back, before, 0) << (BITS * back)
    return keys, owner


def _sum_by(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    found, at = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(at, weights=w, minlength=len(found)) for w in weights)


def _ratios(numerator: np.ndarray, denominator: np.ndarray) -> np.ndarray:
    return np.divide(numerator, denominator, out=np.zeros(len(numerator)), where=denominator > 0)


@dataclass
class Model:
    """The models of counts that fit in memory: what ``ratios`` is tested against.

    Log-likelihood ratio of every letter that training has seen in its context, and of unseen ones by context.
    """

    keys: np.ndarray
    ratio: np.ndarray
    contexts: np.ndarray
    unseen: np.ndarray

    @staticmethod
    def fit(keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Model:
        """From the counts of each class by key (sorted, no repeats)."""
        contexts, at = np.unique(keys >> BITS, return_inverse=True)

        def layer(counts: np.ndarray, below: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
            """Discounted probabilities over ``below``, and what each context leaves to it."""
            total = np.bincount(at, weights=counts, minlength=len(contexts))
            kinds = np.bincount(at, weights=counts > 0, minlength=len(contexts))
            # a context the class has not seen leaves everything to the shared counts
            spare = np.where(total > 0, _ratios(DISCOUNT * kinds + weight, total + weight), 1.0)
            return _ratios(np.maximum(counts - DISCOUNT, 0), (total + weight)[at]) + spare[at] * below, spare

        pooled, _ = layer(toxic + ordinary, _shared(keys), 0)
        (p_toxic, left_toxic), (p_ordinary, left_ordinary) = (layer(c, pooled, SHARED) for c in (toxic, ordinary))
        ratio, unseen = np.log(p_toxic) - np.log(p_ordinary), np.log(left_toxic) - np.log(left_ordinary)
        return Model(keys, ratio.astype(np.float32), contexts, unseen.astype(np.float32))

    def score(self, words: list[str]) -> np.ndarray:
        """Summed log-likelihood ratio of each word."""
        if not words:
            return np.zeros(0)
        keys, owner = grams(words)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        context = keys >> BITS
        c = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        # an unseen letter is as likely in either class by the shared counts; what differs is how much is left to them
        value = np.where(known, self.ratio[at], np.where(self.contexts[c] == context, self.unseen[c], 0.0))
        return np.bincount(owner, weights=value, minlength=len(words))


def _shared(keys: np.ndarray) -> np.ndarray:
    """Kneser-Ney continuation probability of each key's letter after the context one letter shorter, both classes together."""
    lower = 1.0 / (SYMBOLS + 1)
    for order in range(1, ORDER):
        mask = (1 << (BITS * order)) - 1
        # one row per distinct key of the next order: counting rows counts its different left neighbours
        longer = np.unique(keys & ((1 << (BITS * (order + 1))) - 1))
        found, left = _sum_by(longer & mask, np.ones(len(longer)))
        contexts, at = np.unique(found >> BITS, return_inverse=True)
        total = np.bincount(at, weights=left)
        kinds = np.bincount(at)
        below = lower if order == 1 else probability[np.searchsorted(previous, found & (mask >> BITS))]
        probability = np.maximum(left - DISCOUNT, 0) / total[at] + DISCOUNT * kinds[at] / total[at] * below
        previous = found
    return probability[np.searchsorted(previous, keys & mask)]


def fit_curve(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge: intercept and slopes of the scaled features."""
    scale = np.maximum(features.std(axis=0), 1e-9)
    x = np.c_[np.ones(len(features)), features / scale]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - p) - 1e-2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w / np.r_[1.0, scale]


def fold(id_col: str) -> Column:
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def _mask(order: int) -> Column:
    """The part of a key that holds its last ``order`` letters."""
    return F.col("key").bitwiseAND(F.lit((1 << (BITS * order)) - 1).cast("long"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From text, toxic, ordinary (label rows of each class): words with the texts of each class, and all texts, that hold them."""
    held = {(0, 0): Counter(), (1, 0): Counter(), (0, 1): Counter()}

    def emit() -> pa.RecordBatch:
        words = [w for c in held.values() for w in c]
        uses = np.array([n for c in held.values() for n in c.values()], dtype=np.int64)
        kind = np.repeat(np.array(list(held), dtype=np.int64), [len(c) for c in held.values()], axis=0)
        for c in held.values():
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array(x) for x in (uses * kind[:, 0], uses * kind[:, 1], uses))], ["word", "toxic", "ordinary", "uses"])

    for rows in batches:
        for text, toxic, ordinary in zip(*(c.to_pylist() for c in rows.columns)):
            words = set(WORD.findall((text or "").lower()))
            if toxic + ordinary <= 1:
                held[toxic, ordinary].update(words)
            else:  # learned once per label row
                held[1, 0].update(dict.fromkeys(words, toxic) if toxic else ())
                held[0, 1].update(dict.fromkeys(words, ordinary) if ordinary else ())
            if sum(map(len, held.values())) > REMEMBERED:
                yield emit()
    yield emit()


def vocabulary(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """word, toxic, ordinary, uses of every word of ``docs`` (doc_id, text), and ``wid``, its number."""
    learned = marked.filter(~fold("_id").isin(HELD_OUT, CURVE_FOLD)).groupBy("_id")
    learned = learned.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary"))
    unlearned = fold("doc_id").isin(HELD_OUT, CURVE_FOLD)
    # only texts that can have a label to learn from meet the labels
    met = docs.filter(~unlearned).join(learned, F.col("doc_id") == F.col("_id"), "left")
    none = F.lit(0).cast("long")
    rows = met.select("text", *(F.coalesce(c, none).alias(c) for c in ("toxic", "ordinary")))
    rows = rows.unionByName(docs.filter(unlearned).select("text", none.alias("toxic"), none.alias("ordinary")))
    counts = rows.mapInArrow(_count, "word string, toxic bigint, ordinary bigint, uses bigint").groupBy("word")
    return materialise(counts.agg(*(F.sum(c).alias(c) for c in ("toxic", "ordinary", "uses"))).withColumn("wid", F.monotonically_increasing_id()), "words")


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        keys, owner = grams(rows.column(0).to_pylist()) if len(rows) else (np.empty(0, np.int64),) * 2
        weights = (rows.column(1).to_numpy(), rows.column(2).to_numpy(), np.ones(len(rows)))
        keys, *sums = _sum_by(keys, *(w[owner] for w in weights))
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(x.astype(np.int64)) for x in sums)], ["key", "toxic", "ordinary", "uses"])


def shared(keys: DataFrame) -> DataFrame:
    """below, shared: what ``_shared`` computes, by the last ORDER - 1 letters of a key; each group is one context, of SYMBOLS letters at most."""
    levels = {ORDER: keys.select("key")}
    for order in range(ORDER - 1, 0, -1):
        # one row per distinct key of the next order: counting rows counts its different left neighbours
        levels[order] = levels[order + 1].groupBy(_mask(order).alias("key")).agg(F.count(F.lit(1)).alias("left"))
    found = None
    for order in range(1, ORDER):
        level = levels[order]
        if found is None:
            level = level.withColumn("shared", F.lit(1.0 / (SYMBOLS + 1)))
        else:
            level = level.withColumn("below", _mask(order - 1)).join(found, "below")
        same = Window.partitionBy(F.shiftright("key", BITS))
        total, kinds = F.sum("left").over(same), F.count(F.lit(1)).over(same)
        own = F.greatest(F.col("left") - DISCOUNT, F.lit(0.0)) / total
        found = level.select(F.col("key").alias("below"), (own + DISCOUNT * kinds / total * F.col("shared")).alias("shared"))
    return found


def ratios(words: DataFrame) -> DataFrame:
    """key, ratio (in units of 1 / UNIT), uses (places in words) of every letter in its context, as ``Model`` has them."""
    spelt = words.select("word", "toxic", "ordinary").mapInArrow(_spell, "key bigint, toxic bigint, ordinary bigint, uses bigint")
    keys = materialise(spelt.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("toxic", "ordinary", "uses"))), "keys")
    same = Window.partitionBy(F.shiftright("key", BITS))

    def layer(counts: Column, below: Column, weight: int) -> Column:
        total, kinds = F.sum(counts).over(same), F.sum((counts > 0).cast("int")).over(same)
        # totals are whole numbers, so that the least divisor of 1 only stands in for 0
        share = F.greatest(total + weight, F.lit(1))
        spare = F.when(total > 0, (DISCOUNT * kinds + weight) / share).otherwise(1.0)
        return F.greatest(counts - DISCOUNT, F.lit(0.0)) / share + spare * below

    toxic, ordinary = F.col("toxic"), F.col("ordinary")
    rows = keys.withColumn("below", _mask(ORDER - 1)).join(shared(keys), "below")
    rows = rows.withColumn("pooled", layer(toxic + ordinary, F.col("shared"), 0))
    ratio = F.log(layer(toxic, F.col("pooled"), SHARED)) - F.log(layer(ordinary, F.col("pooled"), SHARED))
    return materialise(rows.select("key", F.round(ratio * UNIT).cast("long").alias("ratio"), "uses"), "ratios")


def _common(rows: DataFrame, most: int) -> DataFrame:
    """The most used rows, at most ``most`` of them: all from some number of uses on."""
    step = F.floor(F.log2("uses") * 16)
    least, total = None, 0
    for r in sorted(rows.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("uses").alias("least")).collect(), reverse=True):
        total += r.n
        if total > most:
            break
        least = r.least
    return rows.filter(F.col("uses") >= least) if least is not None else rows.limit(0)


def _word_values(words: DataFrame, most: int) -> DataFrame:
    """word, uses, value: the summed ratio of the letters of every word."""
    known = ratios(words)
    table = _common(known, most).select("key", "ratio").toArrow().sort_by("key")
    given = words.sparkSession.sparkContext.broadcast(tuple(table.column(i).to_numpy() for i in range(2)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, ratio = given.value
        for rows in batches:
            if not len(rows):
                continue
            keys, owner = grams(rows.column(0).to_pylist())
            here = np.zeros(len(keys), bool)
            if len(common):
                at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
                here = common[at] == keys
            sums = np.zeros(len(rows), np.int64)
            if here.any():
                np.add.at(sums, owner[here], ratio[at[here]])
            ends = np.cumsum(np.bincount(owner[~here], minlength=len(rows)))
            rest = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(keys[~here]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sums), rest], ["word", "uses", "wid", "sum", "rest"])

    # written before the join, so that a key of many words can be split
    added = materialise(words.select("word", "uses", "wid").mapInArrow(add, "word string, uses bigint, wid bigint, sum bigint, rest array<bigint>"), "spelt")
    others = added.select("wid", F.explode("rest").alias("key")).join(known.select("key", "ratio"), "key")
    others = others.groupBy("wid").agg(F.sum("ratio").alias("others"))
    value = F.col("sum") + F.coalesce("others", F.lit(0))
    return materialise(added.drop("rest").join(others, "wid", "left").select("word", "uses", value.alias("value")), "values")


def features(docs: DataFrame, values: DataFrame, most: int) -> DataFrame:
    """rid, doc_id of ``docs`` (and text); letters of its distinct words (ends included); log-likelihood ratio per letter, per root of letters, at its peak."""
    table = _common(values.filter(F.length("word") <= LONG), most).select("word", "value").toArrow()
    given = docs.sparkSession.sparkContext.broadcast(dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist())))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = given.value
        for batch in batches:
            # a slice at a time: the words of a whole Arrow batch would take hundreds of MB
            for rows in (batch.slice(at, 256) for at in range(0, len(batch), 256)):
                letters, sums, top, rest = [], [], [], []
                for text in rows.column(2).to_pylist():
                    words = set(WORD.findall((text or "").lower()))
                    known = sorted((common[w] for w in words if w in common), reverse=True)
                    letters.append(sum(map(len, words)) + len(words))
                    sums.append(sum(known))
                    top.append(known[:PEAK])
                    rest.append([w for w in words if w not in common])
                made = [pa.array(x, t) for x, t in zip((letters, sums, top, rest), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *made], ["rid", "doc_id", "letters", "sum", "top", "rest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("rid", "doc_id", "text")
    added = materialise(docs.mapInArrow(add, f"rid bigint, doc_id {kind}, letters bigint, sum bigint, top array<bigint>, rest array<string>"), "texts")
    others = added.select("rid", F.explode("rest").alias("word")).join(values.select("word", "value"), "word")
    most_toxic = F.slice(F.sort_array(F.collect_list("value"), asc=False), 1, PEAK)
    others = others.groupBy("rid").agg(F.sum("value").alias("others"), most_toxic.alias("more"))
    both = F.concat("top", F.coalesce("more", F.array().cast("array<bigint>")))
    peak = F.aggregate(F.slice(F.sort_array(both, asc=False), 1, PEAK), F.lit(0).cast("long"), lambda a, x: a + x)
    total = (F.col("sum") + F.coalesce("others", F.lit(0))) / UNIT
    per = F.greatest("letters", F.lit(1))
    out = added.drop("rest").join(others, "rid", "left")
    return materialise(out.select("rid", "doc_id", "letters", (total / per).alias("mean"), (total / F.sqrt(per)).alias("root"), (peak / (UNIT * PEAK)).alias("peak")), "features")


def _rate(docs: DataFrame, labels: DataFrame, most: int, common_words: int, common_keys: int) -> DataFrame:
    """rid, doc_id, score of ``docs`` (rid, doc_id, text)."""
    marked = labels.filter("toxic IN (0, 1)").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    curve_rows = marked.filter(fold("_id") == CURVE_FOLD)
    chance = most / max(most, curve_rows.count())
    curve_rows = F.broadcast(curve_rows.filter(F.pmod(F.xxhash64(F.lit("labelled"), "_id"), F.lit(1 << 30)) < int(chance * (1 << 30))))
    on = F.col("doc_id") == F.col("_id")
    words = vocabulary(docs, marked)
    if not all(words.agg(F.sum("toxic"), F.sum("ordinary")).first()):
        share = docs.select("doc_id").join(curve_rows, on).agg(F.avg("toxic")).first()[0] or 0.0
        return docs.select("rid", "doc_id", F.lit(share).alias("score"))
    rows = features(docs, _word_values(words, common_keys), common_words)
    names = ["mean", "root", "peak"]
    # in one order, as adding up depends on it
    seen = rows.join(curve_rows, on).select("letters", *names, "toxic").toArrow()
    seen = seen.sort_by([(c, "ascending") for c in seen.column_names])
    letters, mean, root, peak, toxic = (seen.column(i).to_numpy() for i in range(5))
    share = float(toxic.mean()) if len(toxic) else 0.0
    with_words = letters > 0
    if len(set(toxic[with_words].tolist())) < 2:
        return rows.select("rid", "doc_id", F.lit(share).alias("score"))
    curve = fit_curve(np.stack([mean, root, peak], axis=1)[with_words], toxic[with_words]).tolist()
    height = sum((F.col(c) * w for c, w in zip(names, curve[1:])), F.lit(curve[0]))
    fitted = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), height))))
    return rows.select("rid", "doc_id", F.when(F.col("letters") > 0, fitted).otherwise(share).alias("score"))


def score(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = MAX_LABELLED,
    common_words: int = COMMON_WORDS,
    common_keys: int = COMMON_KEYS,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; ``most`` bounds the rows that the curve is fitted on."""
    docs = df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _rate(docs, labels, most, common_words, common_keys).select(
        "doc_id",
        (fold("doc_id") == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = MAX_LABELLED,
    common_words: int = COMMON_WORDS,
    common_keys: int = COMMON_KEYS,
) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    rid = unused(df, "_rid")
    # numbered once and written: a second reading could number the rows otherwise
    rows = materialise(df.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    docs = rows.select(F.col(rid).alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rated = _rate(docs, labels, most, common_words, common_keys)
    out = unused(rows, "_out")
    rejected = rated.filter("score >= 0.5").select(F.col("rid").alias(out))
    return rows.join(rejected, F.col(rid) == F.col(out), "left_anti").select(*df.columns)
