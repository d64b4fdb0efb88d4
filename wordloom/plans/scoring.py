"""Queries on text functions, edit distances and scoring reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.config import DEFAULTS
from wordloom.functions import edit as E
from wordloom.functions import text as T
from wordloom.operators import evaluate as V
from wordloom.plans import derive as D
from wordloom.plans.derive import PAIRS_SQL, edits_sql, eval_sql, ops_sql, path_sql, table, words4

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


_SPOKEN = "CASE WHEN conv_id % 3 = 0 THEN 'spk_' || role || ': ' ELSE '' END || 'It''s ''quoted'' don''t <noise> 42 - ' || text"


def _spoken():
    label = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("spk_"), F.col("role"), F.lit(": "))).otherwise("")
    return F.concat(label, F.lit("It's 'quoted' don't <noise> 42 - "), F.col("text"))


def _sql_t1(x: str) -> str:
    return rf"lower(trim(regexp_replace(regexp_replace(replace(regexp_replace({x}, 'spk_[\w]+:\s*', '', 'g'), '''', ''), '[^a-zA-Z]', ' ', 'g'), ' +', ' ', 'g')))"


def _sql_edge(x: str) -> str:
    """Apostrophes that aren't inside a word become spaces, without lookaround."""
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '''''+', ' ', 'g'), '(^| )''', ' ', 'g'), '''( |$)', ' ', 'g')"


def _sql_t2(x: str) -> str:
    inner = rf"regexp_replace(regexp_replace({x}, 'spk_[\w]+:\s*', '', 'g'), '[^a-zA-Z'']', ' ', 'g')"
    return rf"lower(trim(regexp_replace({_sql_edge(inner)}, ' +', ' ', 'g')))"


def _sql_t5(x: str) -> str:
    inner = rf"regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '[^a-zA-Z'']', ' ', 'g')"
    return rf"lower(trim(regexp_replace({_sql_edge(inner)}, ' +', ' ', 'g')))"


@query("T1_clean_text", f"SELECT conv_id, turn, {_sql_t1(_SPOKEN)} AS clean FROM conversations")
def t1(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.clean_text(_spoken()).alias("clean"))


@query("T2_align_text", f"SELECT conv_id, turn, {_sql_t2(_SPOKEN)} AS clean FROM conversations")
def t2(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.align_text(_spoken()).alias("clean"))


@query("T3_words", f"SELECT conv_id, turn, CAST(len(list_filter(string_split({_sql_t1('text')}, ' '), lambda x: x <> '')) AS BIGINT) AS n_words, array_to_string(list_filter(string_split({_sql_t1('text')}, ' '), lambda x: x <> '')[1:3], '|') AS head FROM conversations")
def t3(spark, sf):
    w = T.words(T.clean_text(F.col("text")))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.size(w).cast("long").alias("n_words"), F.array_join(F.slice(w, 1, 3), "|").alias("head"))


@query("T4_score_text", f"SELECT doc_id, array_to_string({words4('text')}, ' ') AS norm FROM documents")
def t4(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.score_text(F.col("text")).alias("norm"))


@query("T5_speaker_text", f"SELECT conv_id, turn, {_sql_t5(_SPOKEN)} AS clean FROM conversations")
def t5(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.speaker_text(_spoken()).alias("clean"))


@query("T5b_strip_tags", rf"SELECT page_id, CAST(length({_sql_t5('html')}) AS BIGINT) AS n, md5({_sql_t5('html')}) AS digest FROM pages")
def t5b(spark, sf):
    c = T.speaker_text(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.length(c).cast("long").alias("n"), F.md5(c.cast("binary")).alias("digest"))


@query("T6_join_words", "SELECT conv_id, string_agg(w, ' ' ORDER BY turn) AS joined FROM (SELECT conv_id, turn, trim(split_part(text, ' ', 1)) AS w FROM conversations) WHERE w <> '' AND turn % 4 <> 1 GROUP BY conv_id")
def t6(spark, sf):
    w = F.when(F.col("turn") % 4 == 1, "  ").otherwise(F.concat(F.lit(" "), F.split_part("text", F.lit(" "), F.lit(1))))
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", w.alias("w")))).alias("ws"))
    return c.select("conv_id", T.join_words(F.transform("ws", lambda x: x["w"])).alias("joined")).where("joined <> ''")


@query("T7_names", "WITH " + eval_sql() + " SELECT seg_index, audio_filepath FROM eval_rows")
def t7(spark, sf):
    return D.eval_rows(spark, sf).select("seg_index", "audio_filepath")


@query("T8_name_times", "WITH " + eval_sql() + r" SELECT seg_index, CAST(regexp_extract(audio_filepath, 'start(\d+)_end(\d+)', 1) AS BIGINT) AS seg_start, CAST(regexp_extract(audio_filepath, 'start(\d+)_end(\d+)', 2) AS BIGINT) AS seg_end, CAST(regexp_extract(file, '_(\d+)$', 1) AS BIGINT) AS file_no FROM eval_rows")
def t8(spark, sf):
    a, b = T.name_times(F.col("audio_filepath"))
    return D.eval_rows(spark, sf).select("seg_index", a.alias("seg_start"), b.alias("seg_end"), T.file_number(F.col("file")).alias("file_no"))


_NUMS = ", ".join(f"'{w}'" for w in T.NUMBER_WORDS)


@query("T9_number_words", "WITH " + eval_sql(numbers=True) + f", w AS (SELECT seg_index, unnest(ref) AS word FROM eval_rows) SELECT word, count(*) AS n, bool_or(word IN ({_NUMS}) OR regexp_matches(word, '[0-9]')) AS is_number FROM w GROUP BY word")
def t9(spark, sf):
    w = D.eval_rows(spark, sf, numbers=True).select(F.explode("ref").alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n"), F.bool_or(T.is_number_word(F.col("word"))).alias("is_number"))


@query("T10_plural_pairs", "WITH " + eval_sql() + ", z AS (SELECT seg_index, unnest(list_zip(ref, hyp)) AS p FROM eval_rows), q AS (SELECT seg_index, p[1] AS r, p[2] AS h FROM z WHERE p[1] IS NOT NULL AND p[2] IS NOT NULL) SELECT seg_index, count(*) FILTER (r <> h AND (r || 's' = h OR h || 's' = r)) AS plural_pairs, count(*) AS pairs FROM q GROUP BY seg_index")
def t10(spark, sf):
    z = D.eval_rows(spark, sf).select("seg_index", F.explode(F.arrays_zip("ref", "hyp")).alias("p")).where("p.ref is not null and p.hyp is not null")
    return z.groupBy("seg_index").agg(F.count_if(T.is_plural_pair(F.col("p.ref"), F.col("p.hyp"))).alias("plural_pairs"), F.count("*").alias("pairs"))


@query("T11_hms", "WITH " + eval_sql() + ", r AS (SELECT seg_index, CAST(round_even(duration * 17, 0) AS BIGINT) AS s FROM eval_rows) SELECT seg_index, format('{}:{:02d}:{:02d}', s // 3600, s % 3600 // 60, s % 60) AS hms FROM r")
def t11(spark, sf):
    return D.eval_rows(spark, sf).select("seg_index", T.hms(F.col("duration") * 17).alias("hms"))


@query("T12_content_md5", "SELECT page_id, md5(html) AS digest FROM pages")
def t12(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(F.col("html").cast("binary")).alias("digest"))


@query("T13_base_names", "WITH " + eval_sql() + r" SELECT seg_index, string_split(audio_filepath, '/')[-1] AS base, regexp_replace(string_split(audio_filepath, '/')[-1], '\.[^.]*$', '') AS stem FROM eval_rows")
def t13(spark, sf):
    return D.eval_rows(spark, sf).select("seg_index", T.base_name(F.col("audio_filepath")).alias("base"), T.file_stem(F.col("audio_filepath")).alias("stem"))


@query("T14_options", "WITH o AS (SELECT conv_id, list(CASE WHEN turn % 5 = 2 THEN '' ELSE role END ORDER BY turn) AS a FROM conversations GROUP BY conv_id), p AS (SELECT conv_id, list_filter(a, lambda x: x <> '') AS b FROM o) SELECT conv_id, CASE WHEN len(b) = 0 THEN '' ELSE array_to_string(list_filter(b, lambda x, i: list_position(b, x) = i), '|') END AS options, CAST(greatest(1, len(list_distinct(b))) AS BIGINT) AS n FROM p")
def t14(spark, sf):
    o = table(spark, sf, "conversations").withColumn("x", F.when(F.col("turn") % 5 == 2, "").otherwise(F.col("role")))
    o = o.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "x"))), lambda s: s["x"]).alias("a"))
    return o.select("conv_id", F.array_join(T.options(F.col("a")), "|").alias("options"), F.size(T.options(F.col("a"))).cast("long").alias("n"))


_E = "WITH " + eval_sql() + ", s AS (SELECT seg_index, array_to_string(ref, ' ') AS r, array_to_string(hyp, ' ') AS h FROM eval_rows) "


def _strings(spark, sf):
    return D.eval_rows(spark, sf).select("seg_index", F.array_join("ref", " ").alias("r"), F.array_join("hyp", " ").alias("h"))


@query("E1_char_distance", _E + "SELECT seg_index, levenshtein(r, h) AS d FROM s")
def e1(spark, sf):
    return _strings(spark, sf).select("seg_index", E.char_distance(F.col("r"), F.col("h")).cast("long").alias("d"))


@query("E2_char_distance_cutoff", _E + "SELECT seg_index, CASE WHEN levenshtein(r, h) > 8 THEN -1 ELSE levenshtein(r, h) END AS d FROM s")
def e2(spark, sf):
    return _strings(spark, sf).select("seg_index", E.char_distance(F.col("r"), F.col("h"), 8).cast("long").alias("d"))


@query("E3_norm_distance", _E + "SELECT seg_index, round(levenshtein(r, h) / greatest(length(r), length(h), 1)::DOUBLE, 4) AS nd FROM s")
def e3(spark, sf):
    return _strings(spark, sf).select("seg_index", E.norm_distance(F.col("r"), F.col("h")).alias("nd"))


@query("E4_word_distance", f"WITH {PAIRS_SQL} SELECT conv_id, turn, {edits_sql('ref', 'hyp')} AS edits FROM pairs")
def e4(spark, sf):
    return D.conversation_pairs(spark, sf).select("conv_id", "turn", E.word_distance(F.col("ref"), F.col("hyp")).cast("long").alias("edits"))


@query("E5_utterance_wer", "WITH " + eval_sql() + f" SELECT seg_index, CASE WHEN len(ref) > 0 THEN {edits_sql('ref', 'hyp')} / len(ref)::DOUBLE END AS wer FROM eval_rows")
def e5(spark, sf):
    return V.scored(D.eval_rows(spark, sf)).select("seg_index", "wer")


@query("E6_word_alignment", "WITH " + eval_sql(numbers=True) + ", scorable AS (SELECT * FROM eval_rows WHERE len(ref) > 0), " + ops_sql("scorable") + " SELECT seg_index, k - 1 AS op_index, CASE op WHEN 'C' THEN 'equal' WHEN 'S' THEN 'substitute' WHEN 'D' THEN 'delete' ELSE 'insert' END AS op, r AS ref_word, h AS hyp_word FROM ops")
def e6(spark, sf):
    return V.operations(D.eval_rows(spark, sf, numbers=True)).select("seg_index", F.col("op_index").cast("long").alias("op_index"), "op", "ref_word", "hyp_word")


_REPORT = (
    "WITH " + eval_sql(numbers=True) + f""", p AS (SELECT *, CASE WHEN len(ref) = 0 THEN '' ELSE {path_sql("ref", "hyp")} END AS path FROM eval_rows),
letters AS (SELECT seg_index, ref, hyp, unnest(range(1, length(path) + 1)) AS k, path FROM p),
placed AS (SELECT seg_index, path[k] AS op, ref, hyp, CAST(sum(CASE WHEN path[k] <> 'I' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS rp, CAST(sum(CASE WHEN path[k] <> 'D' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS hp FROM letters WINDOW w AS (PARTITION BY seg_index ORDER BY k)),
o AS (SELECT seg_index, op, CASE WHEN op <> 'I' THEN ref[rp] END AS r, CASE WHEN op <> 'D' THEN hyp[hp] END AS h FROM placed),
tallies AS (SELECT seg_index, count(*) FILTER (op = 'S' AND (r || 's' = h OR h || 's' = r)) AS plural_subs,
  count(*) FILTER (op IN ('S', 'D') AND (r IN ({_NUMS}) OR regexp_matches(r, '[0-9]'))) AS wrong_number_words,
  count(*) FILTER (op = 'I' AND (h IN ({_NUMS}) OR regexp_matches(h, '[0-9]'))) AS number_insertions FROM o GROUP BY seg_index),
report AS (SELECT p.seg_index, length(path) - length(replace(path, 'C', '')) AS C, length(path) - length(replace(path, 'S', '')) AS S, length(path) - length(replace(path, 'D', '')) AS D,
  length(path) - length(replace(path, 'I', '')) AS I, len(ref) AS T, coalesce(plural_subs, 0) AS plural_subs,
  len(list_filter(ref, lambda x: x IN ({_NUMS}) OR regexp_matches(x, '[0-9]'))) AS ref_number_words, coalesce(wrong_number_words, 0) AS wrong_number_words, coalesce(number_insertions, 0) AS number_insertions
  FROM p LEFT JOIN tallies t ON p.seg_index = t.seg_index) """
)


def _report(spark, sf):
    return V.segment_report(D.eval_rows(spark, sf, numbers=True))


@query("E7_segment_counts", _REPORT + "SELECT * FROM report")
def e7(spark, sf):
    return _report(spark, sf).select("seg_index", "C", "S", "D", "I", "T", "plural_subs", "ref_number_words", "wrong_number_words", "number_insertions")


@query("E8_empty_rows", _REPORT + ", e AS (SELECT r.*, len(hyp) AS n_hyp FROM report r JOIN eval_rows USING (seg_index)) SELECT seg_index, T, D, n_hyp, T = 0 AS unscored FROM e WHERE T = 0 OR n_hyp = 0")
def e8(spark, sf):
    r = _report(spark, sf).withColumn("n_hyp", F.size("hyp").cast("long"))
    return r.where("T = 0 or n_hyp = 0").select("seg_index", "T", "D", "n_hyp", (F.col("T") == 0).alias("unscored"))


@query("E9_segment_ratios", _REPORT + "SELECT seg_index, CASE WHEN T > 0 THEN round((S + D + I) / T::DOUBLE, 4) END AS segment_wer, CASE WHEN T > 0 THEN round(S / T::DOUBLE, 4) END AS subst_ratio, CASE WHEN T > 0 THEN round(D / T::DOUBLE, 4) END AS deletion_ratio, CASE WHEN T > 0 THEN round(I / T::DOUBLE, 4) END AS insert_ratio FROM report")
def e9(spark, sf):
    return _report(spark, sf).select("seg_index", "segment_wer", "subst_ratio", "deletion_ratio", "insert_ratio")


_SCORED = f", scored AS (SELECT *, CAST(len(ref) AS BIGINT) AS ref_words, CASE WHEN len(ref) > 0 THEN {edits_sql('ref', 'hyp')} END AS edits FROM eval_rows) "
_SCORE = "WITH " + eval_sql() + _SCORED
_AGG = "CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(ref_words) AS BIGINT) AS ref_words, sum(edits) / nullif(sum(ref_words), 0)::DOUBLE AS corpus_wer, round(avg(edits / nullif(ref_words, 0)::DOUBLE), 9) AS mean_utt_wer, count(*) FILTER (ref_words > 0) AS n_scored, count(*) FILTER (ref_words = 0) AS n_empty_ref"


@query("A1_corpus_wer", f"WITH {PAIRS_SQL}, scored AS (SELECT *, CAST(len(ref) AS BIGINT) AS ref_words, CASE WHEN len(ref) > 0 THEN {edits_sql('ref', 'hyp')} END AS edits FROM pairs) SELECT role, {_AGG} FROM scored GROUP BY role")
def a1(spark, sf):
    return V.corpus_wer(D.conversation_pairs(spark, sf), "role")


@query("A1b_corpus_wer_total", _SCORE + f"SELECT {_AGG} FROM scored")
def a1b(spark, sf):
    return V.corpus_wer(D.eval_rows(spark, sf))


@query("A2_eval_summary", _SCORE + "SELECT count(*) AS utterances, count(*) FILTER (ref_words > 0) AS scored, count(*) FILTER (ref_words = 0) AS empty_ref, count(*) FILTER (len(hyp) = 0) AS empty_hyp, round(sum(duration) / 60, 6) AS audio_min, round(sum(duration) / 84.4::DOUBLE, 6) AS rtfx, sum(edits) / sum(ref_words)::DOUBLE AS corpus_wer, round(avg(edits / nullif(ref_words, 0)::DOUBLE), 9) AS mean_utt_wer, min(avg_score) AS min_score, max(avg_score) AS max_score FROM scored")
def a2(spark, sf):
    return V.summary(D.eval_rows(spark, sf), decode_s=84.4)


@query("A3_file_speaker_wer", _SCORE + f"SELECT file, speaker, {_AGG} FROM scored GROUP BY file, speaker")
def a3(spark, sf):
    return V.corpus_wer(D.eval_rows(spark, sf), "file", "speaker")


_AT = "count(*) AS segs_0_0, sum(edits) / sum(ref_words)::DOUBLE AS wer_0_0, count(*) FILTER (avg_score >= 0.4) AS segs_0_4, sum(edits) FILTER (avg_score >= 0.4) / nullif(sum(ref_words) FILTER (avg_score >= 0.4), 0)::DOUBLE AS wer_0_4 FROM scored WHERE ref_words > 0"


@query("A4_speaker_wer_at_thresholds", _SCORE + f"SELECT file, speaker, {_AT} GROUP BY file, speaker UNION ALL SELECT 'OVERALL', NULL, {_AT}")
def a4(spark, sf):
    return V.speaker_wer_at(D.eval_rows(spark, sf), DEFAULTS.thresholds)


_WRONG = "WITH " + eval_sql(numbers=True) + ", scorable AS (SELECT * FROM eval_rows WHERE len(ref) > 0), " + ops_sql("scorable") + ", wrong AS (SELECT CASE op WHEN 'S' THEN 'substitute' WHEN 'D' THEN 'delete' ELSE 'insert' END AS op, r, h FROM ops WHERE op <> 'C') "


@query("A13_top_errors", _WRONG + ", n AS (SELECT op, r, h, count(*) AS n FROM wrong GROUP BY ALL), k AS (SELECT *, sum(n) OVER (PARTITION BY op) AS of_type, sum(n) OVER () AS of_all, row_number() OVER (PARTITION BY op ORDER BY n DESC, coalesce(r, ''), coalesce(h, '')) AS rank FROM n) SELECT op, rank, r AS ref_word, h AS hyp_word, n, round(n * 100.0::DOUBLE / of_type, 6) AS pct_of_type, round(n * 100.0::DOUBLE / of_all, 6) AS pct_of_edits FROM k WHERE rank <= 30")
def a13(spark, sf):
    return V.top_errors(V.operations(D.eval_rows(spark, sf, numbers=True)), DEFAULTS.top_errors)


@query("A14_error_totals", _WRONG + "SELECT op, count(*) AS edits, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct_of_edits, CASE op WHEN 'substitute' THEN 1 WHEN 'delete' THEN 2 ELSE 3 END AS op_order FROM wrong GROUP BY op")
def a14(spark, sf):
    return V.error_totals(V.operations(D.eval_rows(spark, sf, numbers=True)))


def _variant(name: str, cond: str, e: str) -> str:
    return f"SELECT '{name}' AS variant, CAST(coalesce(sum({e}) FILTER ({cond}), 0) AS BIGINT) AS edits, CAST(coalesce(sum(T) FILTER ({cond}), 0) AS BIGINT) AS ref_words, count(*) FILTER ({cond}) AS segments FROM report"


@query(
    "A15_wer_variants",
    _REPORT + ", v AS (" + " UNION ALL ".join([
        _variant("usual", "T > 0", "S + D + I"), _variant("no_plural", "T > 0", "S + D + I - plural_subs"), _variant("two_words", "T >= 2", "S + D + I"),
        _variant("two_words_no_plural", "T >= 2", "S + D + I - plural_subs"), _variant("numeric_no_plural", "T >= 2 AND ref_number_words > 0", "S + D + I - plural_subs"),
    ]) + "), w AS (SELECT *, coalesce(edits * 100.0::DOUBLE / nullif(ref_words, 0), 0) AS x FROM v) SELECT variant, edits, ref_words, segments, round(x, 6) AS wer_pct, round(x - (SELECT x FROM w WHERE variant = 'usual'), 6) AS delta_wer FROM w",
)
def a15(spark, sf):
    return V.wer_variants(_report(spark, sf))


@query("A16_number_recognition", _REPORT + "SELECT count(*) AS total_segments, count(*) FILTER (ref_number_words > 0) AS segs_with_num, CAST(sum(ref_number_words) AS BIGINT) AS ref_num_total, CAST(sum(wrong_number_words) AS BIGINT) AS wrong_num, CAST(sum(number_insertions) AS BIGINT) AS num_ins FROM report")
def a16(spark, sf):
    return V.number_recognition(_report(spark, sf))
