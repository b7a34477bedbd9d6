"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Within a source every document expects target / source size copies. Prefix
sums of the expected copies run over the source's documents, one random offset
per source is added, and a document is emitted once for each integer that its
stretch of the sum crosses. Documents are taken in order of size, which
stratifies the sample: the words taken from a source differ from its target by
little more than one document.

Defined results: a null text has size 0; null is a source of its own, ranked
last; a source without words has target 0; repeated rows are documents of their
own; documents of one size are taken in a fixed order, so reruns agree; texts of
any length count whole; an empty table gives an empty result; other columns are
carried along by ``mix``, names that clash with helpers included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.shared import materialise, running_totals, unused

#: weights by the source's rank, repeating
WEIGHTS = (5, 2, 1)
#: a document is repeated at most this often
MOST_COPIES = 3
SEED = "mix"
#: expected copies are kept in units of 1/UNIT, so that prefix sums are exact
UNIT = 1 << 32


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Target size of each source: (source, source_size) -> plus target, rate (expected copies in units).

    Sources share the whole by weight, none above ``most`` times its own size;
    the excess is reshared by weight. Ordered by size over weight, the capped
    sources come first, and the level that the others share is the largest of
    (whole - caps before) / (weights from here on).
    """
    last = F.col("source").isNull()
    ranked = running_totals(sizes.withColumn("last", last), [], [F.col("last"), F.col("source")], rank="at", name="sources")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights)).cast("int")).cast("long")
    weighed = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = [F.col("cap") / F.col("weight"), F.col("at")]
    filling = materialise(
        running_totals(weighed, [], order, {"caps_before": "cap", "weights_before": "weight"}, "nth", "filling"), "filled"
    )
    whole = filling.agg(F.sum("source_size").alias("w_size"), F.sum("weight").alias("w_weight"))
    size, weights_all = whole.select("w_size").scalar(), whole.select("w_weight").scalar()
    level = filling.agg(
        F.max((size - F.col("caps_before")).cast("double") / (weights_all - F.col("weights_before"))).alias("level")
    ).scalar()
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    # nullif: a source without words has no rate to expect
    rate = F.floor(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)) * UNIT)
    return (
        filling.withColumn("target", target)
        .select("source", "source_size", "target", F.coalesce(rate, F.lit(0)).cast("decimal(20,0)").alias("rate"))
    )


def copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, digest, source_size, target, copies, taken."""
    docs = materialise(
        df.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            words(text_col).alias("size"),
            F.xxhash64(F.col(text_col)).alias("digest"),
        ),
        "sizes",
    )
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = materialise(targets(sizes, weights, most), "targets").withColumnRenamed("source", "p_source")
    expected = docs.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    order = [F.col("size"), F.col("doc_id"), F.col("digest")]
    placed = running_totals(expected, ["source"], order, {"before": "rate"}, "nth", "expected")
    draw = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))), 1, 8)
    offset = F.conv(draw, 16, 10).cast("decimal(20,0)")

    return (
        placed.withColumn("begun", F.col("before") + offset)
        .withColumn("copies", F.expr(f"(begun + rate) div {UNIT} - begun div {UNIT}"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", "size", "digest", "source_size", "target", "copies", "taken")
    )


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """The mixed table: every row of ``df`` as often as the mix takes it.

    Rows that agree in id, source and text are interchangeable; their copies
    are dealt to them evenly. The texts are shuffled once.
    """
    i, s, g, n, c = (unused(df, x) for x in ("_id", "_source", "_digest", "_rows", "_copies"))

    def name(column: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))

    taken = copies(df, id_col, text_col, source_col, **plan).select(
        name("doc_id").alias(i), name("source").alias(s), F.col("digest").alias(g), F.col("copies").alias(c)
    )
    totals = taken.groupBy(i, s, g).agg(F.sum(c).alias(c), F.count(F.lit(1)).alias(n)).filter(F.col(c) > 0)
    rows = df.withColumn(i, name(id_col)).withColumn(s, name(source_col)).withColumn(g, F.xxhash64(F.col(text_col)))
    chosen = rows.join(totals, [i, s, g])
    alone = chosen.filter(F.col(n) == 1)
    nth = F.row_number().over(Window.partitionBy(i, s, g).orderBy(F.xxhash64(*df.columns)))
    share = F.expr(f"{c} div {n}") + F.when(nth <= F.col(c) % F.col(n), 1).otherwise(0)
    twins = chosen.filter(F.col(n) > 1).withColumn(c, share).filter(F.col(c) > 0)
    out = alone.unionByName(twins)
    return out.withColumn(c, F.explode(F.sequence(F.lit(1).cast("long"), F.col(c)))).select(*df.columns)


ORACLE = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{', '.join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT (sum(source_size) OVER () - coalesce(sum({MOST_COPIES} * source_size) OVER earlier, 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM ranked
  WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), plan AS (
  SELECT source, source_size, target,
         CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size::DOUBLE * {UNIT})::HUGEINT END AS rate,
         ('0x' || substr(md5('{SEED}:' || coalesce('=' || source, '')), 1, 8))::BIGINT AS start
  FROM (SELECT *, least({MOST_COPIES} * source_size::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target FROM ranked)
), stretches AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.rate,
         p.start + p.rate * (row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1) AS begun
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (size * ((begun + rate) // {UNIT} - begun // {UNIT}))::BIGINT AS taken
FROM stretches
"""
