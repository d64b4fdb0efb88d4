"""Audio samples as float32 arrays in memory and as WAV bytes; the plans of what to do with them are relational."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.intervals import overlaps
from wordloom.sources.readers import wav_layout

RATE = 16_000


def read_wav(raw: bytes, rate: int = RATE, start: int = 0, stop: int | None = None) -> np.ndarray:
    """SC7, SC9: samples of [start, stop) as mono float32; another rate is an error."""
    found, channels, bits, size, at = wav_layout(raw)
    if found != rate or bits != 16:
        raise ValueError(f"{found} Hz, {bits} bits; expected {rate} Hz, 16 bits")
    pcm = np.frombuffer(raw[at : at + size - size % (2 * channels)], "<i2").reshape(-1, channels)[start:stop]
    return (pcm.astype(np.float32) / 32768).mean(axis=1, dtype=np.float32)


def write_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """SK6: 16-bit PCM."""
    pcm = np.clip(np.rint(samples * 32768), -32768, 32767).astype("<i2").tobytes()
    fmt = struct.pack("<HHIIHH", 1, 1, rate, rate * 2, 2, 16)
    return b"RIFF" + struct.pack("<I", 36 + len(pcm)) + b"WAVEfmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", len(pcm)) + pcm


def silence(samples: np.ndarray, plan: list[tuple[float, float]], rate: int = RATE) -> np.ndarray:
    """AU1: a copy with the planned spans zeroed."""
    out = samples.copy()
    for a, b in plan:
        out[int(a * rate) : int(b * rate)] = 0
    return out


def pad(samples: np.ndarray, seconds: float, rate: int = RATE) -> np.ndarray:
    """AU2"""
    quiet = np.zeros(round(seconds * rate), np.float32)
    return np.concatenate([quiet, samples.astype(np.float32), quiet])


def splice(parts: list[tuple[np.ndarray, float]], start: float, end: float, rate: int = RATE) -> np.ndarray:
    """AU3, AU4: the samples of [start, end) from chunks given with their start seconds, in order."""
    found = [x[max(0, round((start - at) * rate)) : max(0, round((end - at) * rate))] for x, at in sorted(parts, key=lambda p: p[1])]
    return np.concatenate(found) if found else np.zeros(0, np.float32)


def _decoded(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i2")


def samples(files: DataFrame, rate: int = RATE) -> DataFrame:
    """SC7 on a DataFrame: path and content -> path and `pcm`, mono 16-bit samples; another rate is an error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "pcm": [write_wav(read_wav(bytes(c), rate), rate)[44:] for c in b["content"]]})

    return files.select("path", "content").mapInPandas(read, "path string, pcm binary")


def cut(audio: DataFrame, spans: DataFrame, file: str, start: str = "start_s", end: str = "end_s", rate: int = RATE) -> DataFrame:
    """AU4: the samples of [start, end) seconds of each span of a file. audio: file, pcm; spans keep their columns.

    Samples are cut by the engine, two bytes each; the file's samples are beside its spans only inside the join's task, where
    they pass by the hashed spans: samples aren't sorted, as they compress so well that a partition would hold too many.
    """
    at = lambda c: F.round(F.col(c) * rate).cast("int")
    piece = F.expr(f"substring(pcm, 2 * cast(round({start} * {rate}) as int) + 1, 2 * greatest(0, cast(round({end} * {rate}) as int) - cast(round({start} * {rate}) as int)))")
    joined = audio.select(file, "pcm").join(spans.hint("shuffle_hash"), file).select(*spans.columns, "pcm")
    return joined.withColumn("pcm", piece).withColumn("n_samples", F.greatest(F.lit(0), at(end) - at(start)))


def spliced(segments: DataFrame, chunks: DataFrame, file: str = "file_no", key: str = "seg_index", span=("start_abs", "end_abs"), bucket_s: float = 600.0, rate: int = RATE) -> DataFrame:
    """AU3: each segment's samples, put together from the chunks that it overlaps (J6), in their order.

    chunks: file, chunk_index, start_s, end_s, pcm. Each chunk gives its own part as bytes; the parts of a segment meet once.
    A segment without audio is left out.
    """
    found = overlaps(segments.select(file, key, *span), chunks, file, span, bucket_s=bucket_s)
    begin = f"cast(round((greatest({span[0]}, start_s) - start_s) * {rate}) as int)"
    stop = f"cast(round((least({span[1]}, end_s) - start_s) * {rate}) as int)"
    part = F.expr(f"substring(pcm, 2 * {begin} + 1, 2 * greatest(0, {stop} - {begin}))")
    parts = found.select(file, key, "chunk_index", part.alias("part")).groupBy(file, key).agg(F.array_sort(F.collect_list(F.struct("chunk_index", "part"))).alias("parts"))
    whole = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["part"])), ""))
    return parts.select(file, key, whole.alias("pcm"), F.size("parts").cast("long").alias("n_chunks"))


def write_wavs(rows: DataFrame, folder: str, name: str = "name", rate: int = RATE) -> DataFrame:
    """SK6: writes a 16-bit WAV for each row of (name, pcm) below a folder that all executors share; path and samples of each.

    A file is written aside and moved, so a repeated attempt leaves whole files.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for b in batches:
            paths = []
            for n, pcm in zip(b[name], b["pcm"], strict=True):
                own = f"{root}/_{uuid.uuid4().hex}"
                with store.open_output_stream(own) as out:
                    out.write(write_wav(_decoded(bytes(pcm)).astype(np.float32) / 32768, rate))
                store.move(own, f"{root}/{n}")
                paths.append(f"{folder.rstrip('/')}/{n}")
            yield pd.DataFrame({"path": paths, "n_samples": [len(p) // 2 for p in b["pcm"]]})

    return rows.select(name, "pcm").mapInPandas(write, "path string, n_samples long")


def masked(rows: DataFrame, plan: str = "plan", rate: int = RATE) -> DataFrame:
    """AU1 on a DataFrame: `pcm` with the spans of the plan column (see `intervals.silence_plan`) zeroed."""
    columns = list(rows.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for pcm, spans in zip(b["pcm"], b[plan], strict=True):
                x = _decoded(bytes(pcm)).copy()
                for s in spans:
                    x[int(s["start"] * rate) : int(s["end"] * rate)] = 0
                out.append(x.tobytes())
            yield b.assign(pcm=out)[columns]

    return rows.mapInPandas(run, rows.schema)
