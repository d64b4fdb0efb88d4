"""Mixing sources to target weights by hash-threshold histograms, with DataFrame functions only.

The mix holds `share` of all words. Each source gets a part by its weight; a target stops at `most` times its source's
size, and the excess is shared again by weight until none is above. A target of b whole sizes and a rest takes every
document b times, and once more the documents whose 60-bit hash lies below the source's threshold. The thresholds come
from nested histograms: words are summed by source and hash bucket (1024), the bucket in which the running sum passes
the rest is found, and only that bucket is refined, six times. Rows are never sorted; what is sorted are at most 1024
bucket sums of a source. The hash covers id and text, so reruns agree.

Rows equal in id, text and source share a hash. Where the threshold falls among them, they are told apart by a hash of
the number that each row got when it was staged, and the histograms go on in that; equal rows being equal, which of
them are taken doesn't show. So a source's words come as near its target as whole documents allow.

Only the table of source sizes (a row for each source) goes through unpartitioned windows.

Defined results: a null text counts no words; a null source is a source of its own, last in order; null and repeated
ids are allowed; a source without words has target 0; extra columns are ignored by `mix_table` and kept by `mix_rows`,
whatever their names (where rows equal in id, text and source differ in them, which are repeated may change between
runs); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.llm.common import WORD_PATTERN, WORD_SQL, free_names, materialize, read_table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
LEVELS, BITS = 6, 10
TWIN_LEVELS = 4


def _hash(id_col: str, text_col: str) -> Column:
    mark = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary"))
    return F.conv(F.substring(mark, 1, LEVELS * BITS // 4), 16, 10).cast("long")


def _row_hash(row: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(row), 64 - TWIN_LEVELS * BITS)


def _size(text_col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        _size(text_col).alias("size"),
        _hash(id_col, text_col).alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: water filling on the table of source sizes."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everyone = Window.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    ranked = ranked.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    ranked = ranked.withColumn("ratio", F.col("cap").cast("double") / F.col("w"))
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    ranked = (
        ranked.withColumn("budget", F.sum("source_size").over(everyone) * share)
        .withColumn("all_w", F.sum("w").over(everyone))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), zero))
    )
    level = (F.col("budget") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before"))
    full = ranked.withColumn("full", level > F.col("ratio"))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everyone), zero)
    open_w = F.sum(F.when(F.col("full"), zero).otherwise(F.col("w"))).over(everyone)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.try_divide(rest * F.col("w"), open_w.cast("double")))
    return full.withColumn("target", target).select("source", "source_size", "target")


def _refined(rows: DataFrame, state: DataFrame, levels: int) -> DataFrame:
    """state with prefix, under and words as the histograms of rows (source, size, h) leave them: the hash at which the
    running sum of words passes the rest, the words before it and the words at it (null: the rest is never passed)."""
    for level in range(1, levels + 1):
        shift = (levels - level) * BITS
        bound = state.select(F.col("source").alias("s"), "prefix", "under", "rest")
        inside = rows.select("source", "size", "h").where("size > 0")
        inside = inside.join(bound.select("s", "prefix"), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + BITS) == F.col("prefix")))
        sums = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        run = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("upto", run).join(bound.drop("prefix"), F.col("source").eqNullSafe(F.col("s")))
        sums = sums.withColumn("upto", F.col("upto") + F.col("under"))
        edge = sums.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
        edge = edge.select(F.col("source").alias("s"), "bucket", F.col("words").alias("found"), (F.col("upto") - F.col("words")).alias("lower"))
        state = state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "words")
        state = state.withColumns({"prefix": F.coalesce("bucket", F.lit(-1)), "under": F.coalesce("lower", "under")}).withColumnRenamed("found", "words").drop("bucket", "lower")
        state = materialize(state, "targets")
    return state


def _nearer() -> Column:
    """Whether the rest is met more nearly with the words at the edge than without."""
    return F.col("words") - (F.col("rest") - F.col("under")) < F.col("rest") - F.col("under")


def thresholds(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target, whole (copies of every document), edge (hashes below it get one more); and of the rows
    at the edge: rest, under (the words before them), words (theirs)."""
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    state = source_targets(sized, weights, share, most).withColumn("whole", whole)
    state = state.withColumn("rest", F.col("target") - F.col("whole") * size)
    state = materialize(state.withColumns({"prefix": F.lit(0).cast("long"), "under": F.lit(0).cast("long")}), "targets")
    return _refined(sized, state, LEVELS).withColumnRenamed("prefix", "edge")


def twin_cuts(at_edge: DataFrame, state: DataFrame) -> DataFrame:
    """s (source), cut: of the rows at the edge (source, size, h: of the row's number) those with h below the cut get one more.

    Mostly there is one row for a source, and the histograms are only made for the others.
    """
    groups = at_edge.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "s")
    state = state.where("words is not null").join(groups, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    state = materialize(state.withColumn("prefix", F.lit(0).cast("long")), "targets")
    all_ones = F.lit(1 << (TWIN_LEVELS * BITS)).cast("long")
    one = state.where("n = 1").select(F.col("source").alias("s"), F.when(_nearer(), all_ones).otherwise(F.lit(0).cast("long")).alias("cut"))
    many = state.where("n > 1").drop("n")
    if many.isEmpty():
        return one
    cut = F.when(F.col("words").isNull(), all_ones).otherwise(F.col("prefix") + _nearer().cast("long"))
    return one.union(_refined(at_edge, many, TWIN_LEVELS).select(F.col("source").alias("s"), cut.alias("cut")))


def mix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """Adaptive execution broadcasts the thresholds only if they are small; otherwise it splits the hot source's rows."""
    sized = materialize(_sized(docs, id_col, text_col, source_col), "sized")
    state = thresholds(sized, **how)
    edge = state.select(F.col("source").alias("s"), "edge")
    at = sized.where("size > 0").join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("edge")))
    cuts = twin_cuts(materialize(at.select("source", "size", _row_hash(F.col("row")).alias("h")), "edge"), state)
    found = materialize(state.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s"), "targets")
    joined = sized.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
    extra = (F.col("h") < F.col("edge")) | ((F.col("h") == F.col("edge")) & (_row_hash(F.col("row")) < F.col("cut")))
    copies = F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken.

    Rows at an edge (one for a source, or one group of equal rows) are staged with numbers, so that equal ones can be told
    apart.
    """
    s, whole, edge, h, row, copies = free_names(docs, "s", "whole", "edge", "h", "row", "copies")
    state = thresholds(materialize(_sized(docs, id_col, text_col, source_col).drop("doc_id", "row"), "sized"), **how)
    source = F.col(source_col).cast("string")
    bound = state.select(F.col("source").alias(s), F.col("whole").alias(whole), F.col("edge").alias(edge))
    joined = docs.withColumn(h, _hash(id_col, text_col)).join(bound, source.eqNullSafe(F.col(s))).drop(s)
    away = joined.where(F.col(h) != F.col(edge)).withColumn(copies, F.col(whole) + (F.col(h) < F.col(edge)).cast("long"))
    at = materialize(joined.where(F.col(h) == F.col(edge)).withColumn(row, F.monotonically_increasing_id()), "edge")
    at_edge = at.select(source.alias("source"), _size(text_col).alias("size"), _row_hash(F.col(row)).alias("h")).where("size > 0")
    cuts = materialize(twin_cuts(at_edge, state), "targets").select(F.col("s").alias(s), F.col("cut").alias(h))
    at = at.drop(h).join(cuts, source.eqNullSafe(F.col(s)), "left")
    at = at.withColumn(copies, F.col(whole) + F.coalesce(_row_hash(F.col(row)) < F.col(h), F.lit(False)).cast("long"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    out = away.select(*kept, copies).union(at.select(*kept, copies))
    return out.withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int")))).select(*kept)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(read_table(spark, sf_dir, "documents"))


OP6_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {WORD_SQL})) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w,
         row_number() OVER (ORDER BY source IS NULL, source) AS rank, 2 * source_size AS cap FROM sources),
levels AS (
  SELECT *, CAST(cap AS DOUBLE) / w AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS budget, sum(w) OVER () AS all_w FROM ranked),
filled AS (
  SELECT *, coalesce(sum(cap) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before FROM levels
  WINDOW b AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, (budget - CAST(cap_before AS DOUBLE)) / CAST(all_w - w_before AS DOUBLE) > ratio AS is_full FROM filled),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
    (budget - CAST(coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS DOUBLE)) * w
    / CAST(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS DOUBLE) END AS target FROM capped),
whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
rests AS (SELECT *, target - whole * source_size AS rest FROM whole),
runs AS (
  SELECT *, row_number() OVER (ORDER BY source, h) AS rid FROM sized),
upto AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, rid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM runs WHERE size > 0),
edges AS (
  SELECT r.source, r.h, r.rid + CASE WHEN r.upto - t.rest < t.rest - (r.upto - r.size) THEN 1 ELSE 0 END AS below
  FROM upto r JOIN rests t ON r.source IS NOT DISTINCT FROM t.source
  WHERE r.upto > t.rest AND r.upto - r.size <= t.rest)
SELECT s.doc_id, s.size, t.source_size, t.target,
       CAST(s.size * (t.whole + CASE WHEN s.h < e.h OR (s.h = e.h AND s.rid < e.below) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM runs s JOIN rests t ON s.source IS NOT DISTINCT FROM t.source
LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""
