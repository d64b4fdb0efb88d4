"""Writers of the corpus files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.segments import label_line, word_label


def json_lines(rows: DataFrame, path: str, by: str | None = None) -> None:
    """SK2: per-file folders; the whole corpus is the unpartitioned read of the same path."""
    w = rows.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


def json_documents(rows: DataFrame, key: str) -> DataFrame:
    """SK1: key and its document as JSON text."""
    return rows.select(key, F.to_json(F.struct(*[c for c in rows.columns if c != key])).alias("document"))


def text_documents(rows: DataFrame, folder: str, name: str = "name", value: str = "value") -> DataFrame:
    """SK1: a file for each row of (name, value) below a folder that all executors share; the paths. Files are written aside and
    moved, so a repeated attempt leaves whole ones."""

    def write(batches):
        import uuid

        import pandas as pd
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for b in batches:
            for n, text in zip(b[name], b[value], strict=True):
                own = f"{root}/_{uuid.uuid4().hex}"
                with store.open_output_stream(own) as out:
                    out.write((text or "").encode())
                store.move(own, f"{root}/{n}")
            yield pd.DataFrame({"path": [f"{folder.rstrip('/')}/{n}" for n in b[name]]})

    return rows.select(name, value).mapInPandas(write, "path string")


def csv_rows(rows: DataFrame, path: str, columns=None, sep: str = ",") -> None:
    """SK3, SK4: the named columns with a header, others are left out."""
    (rows.select(*columns) if columns else rows).write.mode("overwrite").option("header", "true").option("sep", sep).option("escape", '"').csv(path)


def label_lines(words: DataFrame) -> DataFrame:
    """SK5: the lines of a label file; words without times are left out."""
    timed = words.where("start is not null and end is not null")
    return timed.select(*[c for c in words.columns if c not in ("start", "end", "word", "score")], label_line(F.col("start"), F.col("end"), word_label(F.col("word"), F.col("score"))).alias("value"))


def registry(rows: DataFrame, path: str) -> None:
    """SK7: an append-only table."""
    rows.write.mode("append").option("header", "true").option("sep", "\t").csv(path)


def latest(versions: DataFrame, keys, version: str) -> DataFrame:
    """SK8: documents are never changed in place; each key's latest version is the view."""
    rest = [c for c in versions.columns if c not in keys]
    return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("v")).select(*keys, "v.*")


def dataset(rows: DataFrame, path: str) -> None:
    """SK9: parquet by split, where dev is called validation."""
    rows.withColumn("split", F.when(F.col("split") == "dev", "validation").otherwise(F.col("split"))).write.mode("overwrite").partitionBy("split").parquet(path)


def wer_sidecar(rows: DataFrame, wers: DataFrame, key: str = "audio_filepath") -> DataFrame:
    """SK9, J12: audio name, split and WER to 2 places; rows without a WER stay."""
    joined = rows.join(wers.select(key, "wer"), key, "left")
    return joined.select(F.element_at(F.split(key, "/"), -1).alias("audio"), "split", F.round("wer", 2).alias("segment_wer"))


def dataset_card(rows: DataFrame, name: str) -> str:
    """SK10: a markdown card from one row for each split."""
    s = rows.groupBy("split").agg(F.count("*").alias("n"), F.round(F.sum("duration") / 3600, 2).alias("hours"), F.count_distinct("speaker").alias("speakers"))
    lines = [f"| {r['split']} | {r['n']} | {r['hours']:.2f} | {r['speakers']} |" for r in s.orderBy("split").collect()]  # one row a split
    return "\n".join([f"# {name}", "", "| split | utterances | hours | speakers |", "| --- | --- | --- | --- |", *lines, ""])


def fixed_width(rows: list[dict], widths: dict[str, int]) -> str:
    """SK11: a small report as text columns."""
    out = ["".join(f"{c:>{w}}" for c, w in widths.items())]
    out += ["".join(f"{'' if r[c] is None else r[c]!s:>{w}}" for c, w in widths.items()) for r in rows]
    return "\n".join(out) + "\n"
