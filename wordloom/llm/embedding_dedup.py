"""Embedding near-duplicates by an epsilon grid order join.

Two unit vectors at cosine t or more lie within eps = sqrt(2 - 2t) of each other, also after projection on any
orthonormal axes. Distinct vectors are projected on the leading principal axes and sorted by label and grid cell (of
side eps, compared axis by axis: the epsilon grid order). The sequence is cut into blocks of at most BLOCK vectors, those
into runs of RUN blocks and those into spans of SPAN runs, each with its box on the axes. Intervals are joined from the
top: spans against spans, then the runs of the spans that stay, then in a task the halves of the two runs down to LEAF
vectors, skipping every pair of intervals whose boxes are over eps apart (in Euclidean distance). What is left is compared
with exact cosines in double precision. Spans meet by label alone, but one holds BLOCK * RUN * SPAN (a million) vectors;
runs meet by span, so no task holds the runs of a hot label.

A task gets each of its two runs once, whatever the number of block pairs in them. Only distinct vectors are compared;
copies count by multiplicity, so a hot vector costs one row. From each pair of runs come only sums of links for each
vector and one edge to the smallest vector that it reaches there, never the pairs themselves.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component, and vectors with a null
label, link with nothing; vectors of different lengths don't link; rows that share an id are vectors of their own;
a null id counts as a link of others and its row is kept if its component has no id; cosines that round to the threshold
within 1e-12 are taken again with exact sums; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import connected_components, materialize, read_table

THRESHOLD = 0.98
BLOCK = 1024
RUN = 16
SPAN = 64
AXES = 8
LEAF = 128
SLACK = 1e-9
TIE = 1e-12


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component goes first, so that squares don't overflow."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _kind(vectors: DataFrame, vec_col: str) -> str:
    """How components are stored: single precision holds those of array<float> exactly."""
    return "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"


def _vectors(bodies: list[bytes], dim: int, kind: str) -> np.ndarray:
    return unit(np.frombuffer(b"".join(bodies), kind).reshape(-1, dim))


def _marked(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, key of the distinct vector (null if it can't link), label as text, the vector's bytes."""
    kind = _kind(vectors, vec_col)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, bodies, dims = [], [], []
            for v, label in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                key = body = dim = None
                if label is not None and v.is_valid and len(v) and v.values.null_count == 0:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # no negative zero
                    if np.isfinite(x).all() and x.any():
                        body, dim = x.tobytes(), len(x)
                        key = hashlib.sha256(f"{label}\x00{dim}\x00".encode() + body).digest()
                keys.append(key)
                bodies.append(body)
                dims.append(dim)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), b.column(2), pa.array(dims, pa.int32()), pa.array(bodies, pa.binary())],
                ["vec_id", "key", "label", "dim", "body"],
            )

    picked = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col), F.col(label_col).cast("string").alias("label"))
    return picked.mapInArrow(emit, "vec_id long, key binary, label string, dim int, body binary")


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for x in b.column(0):
            one = np.frombuffer(x.as_py(), "<f8")
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["part"])


def principal_axes(classes: DataFrame, dim: int, axes: int, kind: str) -> np.ndarray:
    """(dim, axes): leading eigenvectors of the covariance of the unit vectors, from sums added up in three steps."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            if b.num_rows:
                u = _vectors(b.column(0).to_pylist(), dim, kind)
                u = np.hstack([u, np.ones((len(u), 1))])
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["part"])

    parts = classes.where(F.col("dim") == dim).select("body").mapInArrow(part, "part binary")
    got = parts.repartition(32).mapInArrow(_sum_parts, "part binary").repartition(1).mapInArrow(_sum_parts, "part binary").first()
    m = np.frombuffer(bytes(got["part"]), "<f8").reshape(dim + 1, dim + 1)
    n = max(m[dim, dim], 1)
    mean = m[:dim, dim] / n
    _, vectors = np.linalg.eigh(m[:dim, :dim] / n - np.outer(mean, mean))
    return np.ascontiguousarray(vectors[:, ::-1][:, :axes])


def _project(u: np.ndarray, basis: np.ndarray | None, axes: int) -> np.ndarray:
    """Coordinates on orthonormal axes: the principal ones, or the first coordinates for vectors of another length."""
    y = u @ basis if basis is not None and basis.shape[0] == u.shape[1] else u[:, :axes]
    return y if y.shape[1] == axes else np.hstack([y, np.zeros((len(y), axes - y.shape[1]))])


def _box(axes: int) -> list[str]:
    return [f"lo{k}" for k in range(axes)] + [f"hi{k}" for k in range(axes)]


def _blocks(classes: DataFrame, basis: np.ndarray, axes: int, eps: float, size: int, run: int, span: int, kind: str) -> DataFrame:
    """The sequence cut into blocks, with the run and the span of each and its box."""
    cells = [f"c{k}" for k in range(axes)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(3).to_numpy()
            cell = np.zeros((len(dims), axes), np.int32)
            bodies = b.column(4).to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                cell[at] = np.floor(_project(_vectors([bodies[i] for i in at], d, kind), basis, axes) / eps)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(cell[:, k]) for k in range(axes)]], [*b.schema.names, *cells])

    names = ["block", "run", "span", "label", "dim", *_box(axes), "nodes", "copies", "bodies"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, seq, runs, spans = TaskContext.get().partitionId() << 32, 0, 0, 0
        rows: list[tuple] = []
        group, in_run, in_span = None, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal seq, rows, in_run, in_span, runs, spans
            if in_run == run:
                runs, in_run, in_span = runs + 1, 0, in_span + 1
            if in_span == span:
                spans, in_span = spans + 1, 0
            y = _project(_vectors([r[2] for r in rows], group[1], kind), basis, axes)
            values = [base + seq, base + runs, base + spans, group[0], group[1], *y.min(axis=0), *y.max(axis=0)]
            values += [np.array([r[0] for r in rows], "<i8").tobytes(), np.array([r[1] for r in rows], "<i8").tobytes(), b"".join(r[2] for r in rows)]
            seq, in_run, rows = seq + 1, in_run + 1, []
            kinds = [*[pa.int64()] * 3, pa.string(), pa.int32(), *[pa.float64()] * (2 * axes), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for b in batches:
            for node, label, copies, dim, body in zip(*[c.to_pylist() for c in b.columns[:5]], strict=True):
                if rows and (group != (label, dim) or len(rows) == size):
                    yield close()
                if group != (label, dim):
                    group, in_run, in_span, runs, spans = (label, dim), 0, 0, runs + 1, spans + 1
                rows.append((node, copies, body))
        if rows:
            yield close()

    placed = classes.select("node", "label", "copies", "dim", "body").mapInArrow(
        place, "node long, label string, copies long, dim int, body binary, " + ", ".join(f"{c} int" for c in cells)
    )
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dim", *cells, "node"]
    ordered = placed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    box = ", ".join(f"{c} double" for c in _box(axes))
    schema = f"block long, run long, span long, label string, dim int, {box}, nodes binary, copies binary, bodies binary"
    return materialize(ordered.mapInArrow(cut, schema), "blocks")


def _near(axes: int, eps: float):
    """Whether the boxes of a and b are within eps of each other."""
    total = F.lit(0.0)
    for k in range(axes):
        gap = F.greatest(F.col(f"a.lo{k}") - F.col(f"b.hi{k}"), F.col(f"b.lo{k}") - F.col(f"a.hi{k}"), F.lit(0.0))
        total = total + gap * gap
    return total <= eps * eps


def interval_pairs(blocks: DataFrame, axes: int, eps: float) -> DataFrame:
    """ra <= rb: pairs of runs that may hold links. Spans are joined first, then the runs of spans that aren't too far apart."""
    box = [*[F.min(f"lo{k}").alias(f"lo{k}") for k in range(axes)], *[F.max(f"hi{k}").alias(f"hi{k}") for k in range(axes)]]
    runs = materialize(blocks.groupBy("run", "span", "label", "dim").agg(*box), "runs")
    spans = materialize(runs.groupBy("span", "label", "dim").agg(*box), "spans")
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim"))
    near = spans.alias("a").join(spans.alias("b"), same & (F.col("a.span") <= F.col("b.span")) & _near(axes, eps))
    left = near.select(F.col("a.span").alias("sa"), F.col("b.span").alias("sb")).join(runs.alias("a"), F.col("sa") == F.col("a.span"))
    # runs are numbered along the sequence, so those of an earlier span come first
    pairs = left.join(runs.alias("b"), (F.col("sb") == F.col("b.span")) & (F.col("a.run") <= F.col("b.run")) & _near(axes, eps))
    return pairs.select(F.col("a.run").alias("ra"), F.col("b.run").alias("rb"))


def apart(ya: np.ndarray, yb: np.ndarray, eps: float) -> bool:
    """Whether the boxes of two intervals are over eps apart."""
    gap = np.maximum(np.maximum(ya.min(0) - yb.max(0), yb.min(0) - ya.max(0)), 0.0)
    return float(gap @ gap) > eps * eps


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def interval_links(ua, ya, ub, yb, same: bool, threshold: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked vectors of two intervals; same: both are one interval, and each link is found once."""
    left, right = [], []
    todo = [(0, len(ua), 0, len(ub))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d or (same and d <= a) or apart(ya[a:b], yb[c:d], eps):
            continue
        if b - a <= LEAF and d - c <= LEAF:
            cosine = ua[a:b] @ ub[c:d].T
            linked = cosine >= threshold
            for i, j in zip(*np.nonzero(np.abs(cosine - threshold) <= TIE), strict=True):
                linked[i, j] = exact_cosine(ua[a + i], ub[c + j]) >= threshold
            i, j = np.nonzero(linked)
            i, j = i + a, j + c
            if same:
                once = i < j
                i, j = i[once], j[once]
            left.append(i)
            right.append(j)
            continue
        m, n = (a + b) // 2 if b - a > LEAF else b, (c + d) // 2 if d - c > LEAF else d
        todo += [(a, m, c, n), (a, m, n, d), (m, b, c, n), (m, b, n, d)]
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n reaches by the links."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if np.array_equal(low, root):
            return root
        root = low


def _run_links(pairs: DataFrame, blocks: DataFrame, basis: np.ndarray, axes: int, threshold: float, eps: float, kind: str) -> DataFrame:
    """u, v: edges that span what each pair of runs links; u, w (v null): how many rows it links u with."""
    body = blocks.select("run", "block", "dim", "nodes", "copies", "bodies")
    sides = pairs.select("ra", "rb", F.explode(F.array_distinct(F.array("ra", "rb"))).alias("run"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        ra, rb = key[0].as_py(), key[1].as_py()
        rows = sorted(table.select(["run", "block", "dim", "nodes", "copies", "bodies"]).to_pylist(), key=lambda r: (r["run"], r["block"]))
        held = {}
        for r in {ra, rb}:
            mine = [x for x in rows if x["run"] == r]
            u = _vectors([x["bodies"] for x in mine], mine[0]["dim"], kind)
            nodes, copies = (np.frombuffer(b"".join(x[c] for x in mine), "<i8") for c in ("nodes", "copies"))
            held[r] = nodes, copies, u, _project(u, basis, axes)
        n1, m1, u1, y1 = held[ra]
        n2, m2, u2, y2 = held[rb]
        i, j = interval_links(u1, y1, u2, y2, ra == rb, threshold, eps)
        nodes, copies, j = (n1, m1, j) if ra == rb else (np.concatenate([n1, n2]), np.concatenate([m1, m2]), j + len(n1))
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = _lowest(len(nodes), i, j)
        has, moved = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(root)))
        v = pa.array([*[None] * len(has), *nodes[root[moved]].tolist()], pa.int64())
        w = pa.array([*links[has].tolist(), *[None] * len(moved)], pa.int64())
        return pa.table({"u": pa.array(np.concatenate([nodes[has], nodes[moved]])), "v": v, "w": w})

    return sides.join(body, "run").groupBy("ra", "rb").applyInArrow(compare, "u long, v long, w long")


def embedding_components(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, block: int = BLOCK, run: int = RUN, span: int = SPAN, axes: int = AXES,
) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    marked = _marked(vectors, id_col, vec_col, label_col)
    marks = materialize(marked.select("vec_id", "key"), "marks")
    classes = marked.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("body").alias("body")
    )
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    usual = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if usual is None:
        found = materialize(classes.select("key", "copies", F.lit(0).cast("long").alias("links"), F.col("least").alias("component_id")), "found")
    else:
        axes = min(axes, usual["dim"])
        kind = _kind(vectors, vec_col)
        basis = principal_axes(classes, usual["dim"], axes, kind)
        blocks = _blocks(classes, basis, axes, eps, block, run, span, kind)
        pairs = materialize(interval_pairs(blocks, axes, eps), "pairs")
        links = materialize(_run_links(pairs, blocks, basis, axes, threshold, eps, kind), "links")
        degree = materialize(links.where("v is null").groupBy("u").agg(F.sum("w").alias("links")), "degree")
        parts = materialize(connected_components(links.where("v is not null").select("u", "v")), "parts")
        small = classes.select("key", "node", "least", "copies")
        rooted = small.join(parts, "node", "left").join(degree, F.col("node") == F.col("u"), "left")
        rooted = materialize(rooted.select("key", "least", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "rooted")
        ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        found = materialize(rooted.join(ids, "root").select("key", "copies", "links", "component_id"), "found")
    out = marks.join(found, "key", "left")
    n_links = F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long")
    component = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(read_table(spark, sf_dir, "embeddings"))
