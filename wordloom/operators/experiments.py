"""Comparison of experiments: one row each, with nested metadata and per-speaker results."""

from __future__ import annotations

import os
import platform
import shlex
import subprocess
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHECKS = ("manifest_md5", "normalizer", "conf_filter_threshold", "padded", "gpu")


def comparability(experiments: DataFrame, checks=CHECKS) -> DataFrame:
    """Is each property the same everywhere (null is a value), and what that allows to compare."""
    same = {c: (F.count_distinct(F.to_json(F.struct(F.col(c).alias("v")))) == 1).alias(f"same_{c}") for c in checks}
    out = experiments.agg(*same.values())
    return out.withColumn("wer_comparable", F.col("same_manifest_md5") & F.col("same_normalizer")).withColumn("time_comparable", F.col("same_gpu"))


def ranked(experiments: DataFrame, baseline: str) -> DataFrame:
    """Rank by corpus WER (ties by input order) and difference to the baseline; a handful of rows."""
    w = Window.orderBy(F.col("corpus_wer").asc_nulls_last(), "position")
    base = F.max(F.when(F.col("experiment") == baseline, F.col("corpus_wer"))).over(Window.partitionBy())
    rank = F.when(F.col("corpus_wer").isNotNull(), F.row_number().over(w))
    return experiments.withColumn("rank", rank.cast("long")).withColumn("delta", F.round(F.col("corpus_wer") - base, 6))


def per_speaker(results: DataFrame, experiments: list[str], baseline: str) -> DataFrame:
    """A row for each (file, speaker) in any experiment, its WER in each and the differences to the baseline; results are
    read once."""
    wer = [F.max(F.when(F.col("experiment") == e, F.col("corpus_wer"))).alias(e) for e in experiments]
    p = results.groupBy("file", "speaker").agg(F.max("ref_words").alias("ref_words"), *wer)
    deltas = [F.round(F.col(e) - F.col(baseline), 6).alias(f"delta_{e}") for e in experiments if e != baseline]
    return p.select("file", "speaker", "ref_words", *[F.round(e, 6).alias(f"wer_{e}") for e in experiments], *deltas)


def record(summary: DataFrame, name: str, model: dict, data: dict, compute: dict, timing: dict | None = None, code: dict | None = None, evaluation: dict | None = None) -> DataFrame:
    """The nested record of a run; blocks that aren't given are left out."""
    blocks = {"model": model, "data": data, "compute": compute, "timing": timing, "code": code, "eval": evaluation}
    part = lambda d: F.struct(*[F.lit(v).alias(k) for k, v in d.items()])
    given = [part(d).alias(k) for k, d in blocks.items() if d]
    return summary.select(F.lit(name).alias("experiment_name"), *given, F.struct(*summary.columns).alias("summary"))


def fingerprint() -> dict:
    """The driver's Python, Spark, processors, memory and platform; what can't be found is left out."""
    import pyspark

    found = {"python": platform.python_version(), "spark": pyspark.__version__, "cpu_count": os.cpu_count(), "platform": platform.platform()}
    try:
        found["ram_gb"] = round(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30, 1)
    except (ValueError, OSError):
        pass
    return found


def code_state(folder: str) -> dict:
    """Commit and whether files were changed since; both null, with the reason, outside a git folder."""
    ask = lambda *words: subprocess.run(["git", "-C", folder, *words], capture_output=True, text=True, check=True).stdout.strip()
    try:
        return {"commit": ask("rev-parse", "HEAD"), "dirty": bool(ask("status", "--porcelain"))}
    except (OSError, subprocess.CalledProcessError) as e:
        return {"commit": None, "dirty": None, "error": str(e)}


def reproduce_command(program: list[str], options: dict) -> str:
    """One quoted command line. True stands for a bare flag, a list for several words; None and False are left out."""
    words = list(program)
    for name, value in options.items():
        if value is None or value is False:
            continue
        words.append(f"--{name.replace('_', '-')}")
        if value is not True:
            words += [str(v) for v in value] if isinstance(value, (list, tuple)) else [str(value)]
    return " ".join(map(shlex.quote, words))


def number_consistency(reports: DataFrame, of: tuple[str, ...] = ("total_segments", "ref_num_total")) -> DataFrame:
    """Rows of A16 with experiment and position -> share of wrong number words, and whether the test set differs from that
    of the first experiment; a handful of rows."""
    first = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    differs = None
    for c in of:
        other = ~F.col(c).eqNullSafe(F.first(c).over(first))
        differs = other if differs is None else differs | other
    share = F.coalesce(F.try_divide(F.col("wrong_num") * F.lit(100.0), F.col("ref_num_total").cast("double")), F.lit(0.0))
    return reports.withColumn("wrong_pct", F.round(share, 6)).withColumn("differs", differs)


class Comparison(NamedTuple):
    """What can be compared (a row), the experiments in order of rank, and differences by speaker (None unless all ran on
    the same test data)."""

    checks: DataFrame
    rows: DataFrame
    speakers: DataFrame | None
    baseline: str
    names: list[str]


def compare(experiments: DataFrame, results: DataFrame, names: list[str], baseline: str | None = None, checks=CHECKS) -> Comparison:
    """Gate, rank and difference to the baseline (the first name without one; put in front if it isn't named), speakers.

    experiments: experiment, position, the checked properties, corpus_wer. results: experiment, file, speaker, corpus_wer,
    ref_words. Missing experiments are an error. The experiments (a row each) are computed here, once: the gate decides whether
    speakers are compared.
    """
    names = list(names)
    if baseline is not None and baseline not in names:
        names = [baseline, *names]
    baseline = baseline or names[0]
    spark, rows = experiments.sparkSession, experiments.where(F.col("experiment").isin(*names)).collect()
    chosen = require(spark.createDataFrame(rows, experiments.schema), names)
    gate = comparability(chosen, checks)
    speakers = per_speaker(results.where(F.col("experiment").isin(*names)), names, baseline) if gate.first()["wer_comparable"] else None
    return Comparison(gate, ranked(chosen, baseline), speakers, baseline, names)


def comparison_record(found: Comparison, name: str, finished_at: str, folder: str = ".", command: str | None = None) -> dict:
    """X3's provenance: a few rows, as they are written to the metadata document and the track list."""
    rows = [r.asDict(recursive=True) for r in found.rows.orderBy(F.col("rank").asc_nulls_last()).collect()]  # one row an experiment
    return {
        "comparison_name": name, "finished_at": finished_at, "baseline": found.baseline, "comparability": found.checks.first().asDict(),
        "experiments": [{"name": r["experiment"], "metadata_md5": r.get("metadata_md5")} for r in rows], "git": code_state(folder),
        "reproduce_command": command, "rows": rows,
    }


def comparison_summary(record: dict) -> str:
    """X3, SK11: the text report of a comparison."""
    percent = lambda x, form: "n/a" if x is None else format(x * 100, form)
    lines = [f"comparison : {record['comparison_name']}", f"baseline   : {record['baseline']}", f"experiments: {', '.join(e['name'] for e in record['experiments'])}"]
    lines += [f"{k}: {v}" for k, v in record["comparability"].items()]
    lines.append(f"{'rank':>4}  {'corpus_wer':>10}  {'delta':>8}  experiment")
    for r in record["rows"]:
        lines.append(f"{'?' if r['rank'] is None else r['rank']:>4}  {percent(r['corpus_wer'], '.2f'):>10}  {percent(r['delta'], '+.2f'):>8}  {r['experiment']}")
    return "\n".join([*lines, f"reproduce  : {record['reproduce_command']}", ""])


def stored_experiments(spark: SparkSession, folder: str, names: list[str], schema: str) -> DataFrame:
    """SC10: the metadata documents `<name>.metadata.json` of the named experiments with path and md5; missing ones are an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [f"{folder.rstrip('/')}/{n}.metadata.json" for n in names]
    missing = [n for n, p in zip(names, paths, strict=True) if not (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
    if missing:
        raise LookupError(f"experiments not found or not finished: {missing}")
    text = spark.read.text(paths, wholetext=True).withColumn("metadata_path", F.input_file_name())
    return text.select(F.from_json("value", schema).alias("m"), "metadata_path", F.md5(F.col("value").cast("binary")).alias("metadata_md5")).select("m.*", "metadata_path", "metadata_md5")


def require(experiments: DataFrame, names: list[str]) -> DataFrame:
    """SC10: the named experiments; an error names those that are missing."""
    found = {r[0] for r in experiments.where(F.col("experiment").isin(*names)).select("experiment").distinct().collect()}  # at most the names asked for
    missing = [n for n in names if n not in found]
    if missing:
        raise LookupError(f"experiments not found: {missing}")
    return experiments.where(F.col("experiment").isin(*names))
