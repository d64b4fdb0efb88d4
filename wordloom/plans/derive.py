"""Speech relations derived from the generic tables, in Spark and, for the oracle, as SQL text of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions import text as T
from wordloom.sources.readers import table

NUMBERS = ("two", "seventh", "hundred", "12", "dozen", "first", "lakh")
GAP, MIN_SEGMENT, MICRO0 = 28_800.0, 3_600.0, 1_704_067_200_000_000


UTTERANCE = 16


def eval_rows(spark: SparkSession, sf_dir: str, drop: int = 11, plural: int = 13, insert: int = 17, numbers: bool = False, empties: bool = True) -> DataFrame:
    """Every document as a recording cut into utterances of 16 words; the hypothesis has deletions, plurals and insertions.

    seg_index is unique in the corpus. Some references and hypotheses are empty.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", T.score_words(F.coalesce("text", F.lit(""))).alias("w"))
    cuts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("w") / UTTERANCE).cast("int") - 1, F.lit(0)))
    d = d.select("doc_id", F.posexplode(F.transform(cuts, lambda s: F.slice(F.col("w"), s * UTTERANCE + 1, UTTERANCE))).alias("seg", "ref"))
    at = F.col("seg") * UTTERANCE + 1
    if numbers:
        names = F.array(*map(F.lit, NUMBERS))
        d = d.withColumn("ref", F.transform("ref", lambda x, i: F.when((at + i) % 19 == 4, F.element_at(names, (at + i) % 7 + 1)).otherwise(x)))
    none = F.array().cast("array<string>")
    put = lambda x, i: (
        F.when((at + i) % drop == 3, none).when((at + i) % plural == 5, F.array(F.concat(x, F.lit("s")))).when((at + i) % insert == 7, F.array(x, F.lit("uh"))).otherwise(F.array(x))
    )
    d = d.withColumn("hyp", F.flatten(F.transform("ref", put)))
    key = F.col("doc_id") + F.col("seg")
    if empties:
        d = d.withColumn("ref", F.when(key % 41 == 0, none).otherwise(F.col("ref"))).withColumn("hyp", F.when(key % 43 == 0, none).otherwise(F.col("hyp")))
    file_no, speaker = F.col("doc_id") % 20, F.concat(F.lit("spk_"), (key % 37).cast("string"))
    uid = F.col("doc_id") * 100_000 + F.col("seg")
    start = (F.col("doc_id") * 7 + F.col("seg") * 11) % 900
    end = start + F.col("seg") % 45 + 1
    avg = F.when(key % 29 != 0, (F.col("doc_id") * 7919 + F.col("seg") * 31) % 1000 / F.lit(1000.0))
    return d.select(
        F.concat(F.lit("wav/"), T.segment_name(file_no, speaker, uid % 1_000_000, start, end)).alias("audio_filepath"),
        (F.size("ref") * F.lit(0.4) + key % 10).alias("duration"), T.stem(file_no).alias("file"), speaker.alias("speaker"), uid.alias("seg_index"),
        avg.alias("avg_score"), (avg / 2).alias("min_score"), "ref", "hyp",
    )


def words4(col: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({col}), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda x: x <> '')"


def eval_sql(name: str = "eval_rows", drop: int = 11, plural: int = 13, insert: int = 17, numbers: bool = False, empties: bool = True) -> str:
    """Common table expressions that end with `name`."""
    u = UTTERANCE
    ref = "w[seg * {u} + 1 : seg * {u} + {u}]".format(u=u)
    if numbers:
        names = "[" + ", ".join(f"'{n}'" for n in NUMBERS) + "]"
        ref = f"list_transform({ref}, lambda x, i: CASE WHEN (seg * {u} + i) % 19 = 4 THEN {names}[(seg * {u} + i) % 7 + 1] ELSE x END)"
    e1, e2 = ("CASE WHEN (doc_id + seg) % 41 = 0 THEN [] ELSE ref END", "CASE WHEN (doc_id + seg) % 43 = 0 THEN [] ELSE hyp END") if empties else ("ref", "hyp")
    return f"""{name}_w AS (SELECT doc_id, {words4("coalesce(text, '')")} AS w FROM documents),
{name}_u AS (SELECT doc_id, w, unnest(range(0, greatest(CAST(ceil(len(w) / {u}::DOUBLE) AS BIGINT), 1))) AS seg FROM {name}_w),
{name}_0 AS (SELECT doc_id, seg, {ref} AS ref FROM {name}_u),
{name}_1 AS (SELECT *, flatten(list_transform(ref, lambda x, i: CASE WHEN (seg * {u} + i) % {drop} = 3 THEN [] WHEN (seg * {u} + i) % {plural} = 5 THEN [x || 's'] WHEN (seg * {u} + i) % {insert} = 7 THEN [x, 'uh'] ELSE [x] END)) AS hyp FROM {name}_0),
{name}_2 AS (SELECT doc_id, seg, {e1} AS ref, {e2} AS hyp FROM {name}_1),
{name} AS (SELECT 'wav/' || format('audio_file_{{:03d}}_spk_{{}}_seg_{{:06d}}_start{{:06d}}_end{{:06d}}.wav', doc_id % 20, (doc_id + seg) % 37, (doc_id * 100000 + seg) % 1000000, (doc_id * 7 + seg * 11) % 900, (doc_id * 7 + seg * 11) % 900 + seg % 45 + 1) AS audio_filepath,
  len(ref) * 0.4::DOUBLE + (doc_id + seg) % 10 AS duration, format('audio_file_{{:03d}}', doc_id % 20) AS file, 'spk_' || ((doc_id + seg) % 37) AS speaker, doc_id * 100000 + seg AS seg_index,
  CASE WHEN (doc_id + seg) % 29 <> 0 THEN ((doc_id * 7919 + seg * 31) % 1000) / 1000.0::DOUBLE END AS avg_score, CASE WHEN (doc_id + seg) % 29 <> 0 THEN ((doc_id * 7919 + seg * 31) % 1000) / 1000.0::DOUBLE / 2 END AS min_score,
  ref, hyp FROM {name}_2)"""


def edits_sql(r: str, h: str) -> str:
    """Word edits of two lists: a row of the table for each reference word, folded with list_reduce."""
    return f"""list_reduce(list_prepend({{'w': '', 'row': range(0, len({h}) + 1)}}, list_transform({r}, lambda x: {{'w': x, 'row': []::BIGINT[]}})),
    lambda a, e: {{'w': '', 'row': list_reduce(list_prepend([a.row[1] + 1], list_transform(range(1, len({h}) + 1), lambda j: [j])),
      lambda b, j: list_append(b, least(b[-1] + 1, a.row[j[1] + 1] + 1, a.row[j[1]] + CASE WHEN e.w = {h}[j[1]] THEN 0 ELSE 1 END)))}}).row[-1]"""


def path_sql(r: str, h: str) -> str:
    """One letter (C S D I) for each aligned operation; of equal costs the diagonal wins, then a deletion."""
    return f"""list_reduce(list_prepend({{'w': '', 'row': list_transform(range(0, len({h}) + 1), lambda j: {{'c': j, 'p': repeat('I', j)}})}},
      list_transform({r}, lambda x: {{'w': x, 'row': []::STRUCT(c BIGINT, p VARCHAR)[]}})),
    lambda a, e: {{'w': '', 'row': list_reduce(list_prepend([{{'c': a.row[1].c + 1, 'p': a.row[1].p || 'D'}}], list_transform(range(1, len({h}) + 1), lambda j: [{{'c': j, 'p': ''}}])),
      lambda b, j: list_append(b, CASE
        WHEN a.row[j[1].c].c + (CASE WHEN e.w = {h}[j[1].c] THEN 0 ELSE 1 END) <= least(a.row[j[1].c + 1].c, b[-1].c) + 1
          THEN {{'c': a.row[j[1].c].c + (CASE WHEN e.w = {h}[j[1].c] THEN 0 ELSE 1 END), 'p': a.row[j[1].c].p || (CASE WHEN e.w = {h}[j[1].c] THEN 'C' ELSE 'S' END)}}
        WHEN a.row[j[1].c + 1].c <= b[-1].c THEN {{'c': a.row[j[1].c + 1].c + 1, 'p': a.row[j[1].c + 1].p || 'D'}}
        ELSE {{'c': b[-1].c + 1, 'p': b[-1].p || 'I'}} END))}}).row[-1].p"""


def ops_sql(source: str = "eval_rows") -> str:
    """After `source`: paths (with the row's columns), ops (one row for each operation)."""
    return f"""paths AS (SELECT *, {path_sql("ref", "hyp")} AS path FROM {source}),
letters AS (SELECT seg_index, ref, hyp, unnest(range(1, length(path) + 1)) AS k, path FROM paths),
placed AS (SELECT seg_index, ref, hyp, k, path[k] AS op, CAST(sum(CASE WHEN path[k] <> 'I' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS rp, CAST(sum(CASE WHEN path[k] <> 'D' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hp
  FROM letters WINDOW w AS (PARTITION BY seg_index ORDER BY k)),
ops AS (SELECT seg_index, k, op, CASE WHEN op <> 'I' THEN ref[rp] END AS r, CASE WHEN op <> 'D' THEN hyp[hp] END AS h FROM placed)"""


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn against the one before it."""
    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("before", F.lag("text").over(w)).where("before is not null")
    return c.select("conv_id", "turn", "role", T.score_words(F.col("before")).alias("ref"), T.score_words(F.col("text")).alias("hyp"))


PAIRS_SQL = f"""lagged AS (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations),
pairs AS (SELECT conv_id, turn, role, {words4("before")} AS ref, {words4("text")} AS hyp FROM lagged WHERE before IS NOT NULL)"""


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed words: file_no, speaker, word, start_abs, end_abs, score, event_id."""
    e = table(spark, sf_dir, "events")
    start = (F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(MICRO0)) / F.lit(1e6)
    return e.select(
        F.col("user_id").alias("file_no"), F.when(F.col("event_type").isin("error", "signup"), "spk_2").otherwise("spk_1").alias("speaker"),
        F.concat(F.col("event_type"), (F.col("event_id") % 7).cast("string")).alias("word"), start.alias("start_abs"), (start + F.col("value") * 20).alias("end_abs"),
        (F.col("value") / (F.col("value") + 50)).alias("score"), "event_id",
    )


TIMELINE_SQL = f"""timeline AS (SELECT user_id AS file_no, CASE WHEN event_type IN ('error', 'signup') THEN 'spk_2' ELSE 'spk_1' END AS speaker,
  event_type || (event_id % 7) AS word, (epoch_us(ts) - {MICRO0}) / 1e6::DOUBLE AS start_abs, (epoch_us(ts) - {MICRO0}) / 1e6::DOUBLE + value * 20 AS end_abs,
  value / (value + 50) AS score, event_id FROM events)"""

TILE, HOLE = 86_400, 3_600


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-long tiles of each file with an hour's hole at the end of each."""
    files = table(spark, sf_dir, "events").select(F.col("user_id").alias("file_no")).distinct()
    c = files.select("file_no", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("day"))
    start, end = F.col("day") * TILE, (F.col("day") + 1) * TILE - HOLE
    return c.select(
        "file_no", (F.col("day") + 1).cast("long").alias("chunk_index"), T.chunk_name(F.col("file_no"), F.col("day") + 1, start, end).alias("chunk_file"),
        start.cast("double").alias("start_s"), end.cast("double").alias("end_s"), (end - start).cast("double").alias("duration_s"),
    )


CHUNKS_SQL = f"""days AS (SELECT DISTINCT user_id AS file_no, unnest(range(0, 30)) AS day FROM events),
chunks AS (SELECT file_no, day + 1 AS chunk_index,
  format('audio_file_{{:03d}}_chunk_{{:06d}}_start{{:06d}}_end{{:06d}}.wav', file_no, day + 1, day * {TILE}, (day + 1) * {TILE} - {HOLE}) AS chunk_file,
  CAST(day * {TILE} AS DOUBLE) AS start_s, CAST((day + 1) * {TILE} - {HOLE} AS DOUBLE) AS end_s, CAST({TILE - HOLE} AS DOUBLE) AS duration_s FROM days)"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label line and a text line for each turn, joined to one transcript for each conversation."""
    c = table(spark, sf_dir, "conversations")
    line = F.concat(F.lit("spk_"), F.col("role"), F.lit(":\n"), F.col("text"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"])
    return c.groupBy(F.col("conv_id").alias("file_no")).agg(F.array_join(lines, "\n").alias("value"))


TRANSCRIPTS_SQL = """transcripts AS (SELECT conv_id AS file_no, string_agg('spk_' || role || ':' || chr(10) || text, chr(10) ORDER BY turn) AS value FROM conversations GROUP BY conv_id)"""
