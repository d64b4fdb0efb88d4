"""What the training-data operators share: table access, staging in the shared folder, words, components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources import readers

#: A word is a run of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: The same in DuckDB's dialect.
WORD_SQL = r"'[^\x20\x09-\x0D]+'"

_scratch: list[tuple[SparkSession, str]] = []


read_table = readers.table


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for own use that clash with none of df's, in any case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def give_back() -> None:
    """Returns a finished task's memory to the system; reused workers would keep it beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Remembered(dict):
    """key -> make(key), remembered for the keys in use.

    Hits are plain dictionary lookups. When `limit` keys are in, they become the older generation and the one before is
    dropped; a key that is asked for again moves back. So memory stays within two generations, and frequent keys stay.
    Keys over `longest` are made anew each time.
    """

    def __init__(self, make, limit: int, longest: int | None = None):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if self.longest is not None and len(key) > self.longest:
            return found
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.old = {}


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words; bytes.split() splits on exactly the six ASCII white-space bytes, unlike str.split()."""
    return text.encode().split() if text else []


def doc_hash_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def id_hash(doc_id: int | None) -> int:
    """The driver-side twin of `doc_hash_mod` before the modulus."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a full address. Only a local master, where all is one machine, may
    lack the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wordloom-"))
        found = spark.sparkContext.getCheckpointDir()
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return str(store.makeQualified(where).toString()).rstrip("/")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder; `drop_scratch` and the interpreter's end remove it."""
    path = f"{shared_dir(spark)}/wordloom-{what}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def drop_scratch() -> None:
    """Remove every staged table of this process. Frames that still read one fail afterwards."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            if spark.sparkContext._jsc is not None:
                remove_path(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return


def materialize(df: DataFrame, what: str = "stage", compression: str = "snappy") -> DataFrame:
    """Cut the lineage with a table in the shared folder, so a lost executor costs a reread and not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(u long, v long) links -> (node long, root long): each linked node with the smallest node it reaches.

    Alternates large-star and small-star steps; each step is two shuffles over the remaining links, and every
    round is a table in the shared folder. Minima are pre-aggregated before their shuffle and both sides of the
    join are plain tables, so a hub with very many links is split by adaptive execution. Nothing is collected but
    one row of counters for each round. The rounds are known to grow with the square of the logarithm of the nodes at
    most (in practice with the logarithm of the longest chain: 40 nodes take 5); 200 is beyond any real graph, and is
    there so that a fault ends the job.

    Defined results: null ends, links of a node to itself and repeated links are left out; no links give no rows.
    """
    pairs = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    cur = materialize(pairs, "links")
    seen = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "low")
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        large = materialize(large, "large")
        # small star: every neighbour below u, and u itself, goes to u's smallest neighbour
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        cur = materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        state = cur.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"), F.countDistinct("u").alias("d")
        ).first()
        if (state["n"], state["h"]) == seen:
            break
        seen = (state["n"], state["h"])
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
