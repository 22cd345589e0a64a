"""Small helpers that the operators of this package share."""

import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import run_folder

#: Texts that an Arrow function takes at a time. Spark bounds its batches by bytes, but what
#: is made of a text may be larger than the text.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What lets go of the words that a worker remembers for an operator, by module.
_FORGET = {}


def remembers(module: str, forget) -> None:
    """Have ``forget`` called when a worker turns to another module's functions."""
    _FORGET[module] = forget


def let_go(module: str) -> None:
    """Give back what this worker holds for modules other than ``module``."""
    for other, forget in _FORGET.items():
        if other != module:
            forget()
    pa.default_memory_pool().release_unused()


def in_slices(run):
    """A function over Arrow batches, given pieces of ``BATCH_ROWS`` rows at most.

    So no session setting is needed, and none is left behind. Workers serve one operator
    after another; what they remember for the one before goes first.
    """
    module = run.__module__

    def sliced(batches):
        let_go(module)
        return run(
            batch.slice(start, BATCH_ROWS)
            for batch in batches
            for start in range(0, batch.num_rows, BATCH_ROWS)
        )

    return sliced


def small_batches(spark: SparkSession) -> None:
    """Let workers find this package.

    Workers on machines that have this folder find the package there, wherever the driver was
    started; elsewhere it comes with ``--py-files``.
    """
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def pick(df: DataFrame, **columns) -> DataFrame:
    """The named columns alone, under fixed names: ``pick(df, doc_id="id", text="body")``.

    Extra columns of ``df``, whatever they are called, go no further.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def held_out(id_column) -> F.Column:
    """True for the quarter of ids that no model may learn labels from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def spread(id_column, seed: int) -> F.Column:
    """A fixed pseudo-random order of ids, for bounded samples that repeat exactly."""
    return F.xxhash64(F.lit(seed), F.col(id_column))


class Scratch:
    """Tables of one run, written below the folder all executors share.

    ``keep`` writes a table and reads it back, which cuts its lineage and survives lost
    executors. At the end of the ``with`` block all are deleted, but for those kept with
    ``last=True``: results that are read after the block.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = run_folder(spark, purpose)
        self.count = 0

    def __enter__(self):
        return self

    def __exit__(self, *_):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/steps")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def keep(self, df: DataFrame, last=False) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{'result' if last else 'steps'}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def kept(spark: SparkSession, purpose: str) -> Scratch:
    """A scratch outside a block: its tables stay as long as the session."""
    return Scratch(spark, purpose)


#: Bits of a filter of ids, whatever the number of ids.
FILTER_BITS = 1 << 24


def id_marks(ids: DataFrame, column: str, scratch) -> DataFrame:
    """A filter of the ids in ``column``: (word, bits), at most ``FILTER_BITS`` / 62 rows."""
    place = F.expr(f"xxhash64({column}) & {FILTER_BITS - 1}L")
    bit = F.expr("shiftleft(1L, cast(p % 62 as int))")
    words = ids.select(place.alias("p")).groupBy(F.expr("p div 62").alias("word"))
    return scratch.keep(words.agg(F.bit_or(bit).alias("bits")))


def maybe_in(df: DataFrame, marks: DataFrame, column: str) -> tuple[DataFrame, F.Column]:
    """(joined, condition): ``df`` beside its words of the filter, and whether an id is marked.

    Every id that was marked is found; of others about as many pass as bits are set. Rows
    are not shuffled: the filter is broadcast, its size is fixed. Null ids pass if marked.
    """
    place = f"(xxhash64({column}) & {FILTER_BITS - 1}L)"
    at = df.withColumn("_word", F.expr(f"{place} div 62"))
    joined = at.join(F.broadcast(marks.toDF("_word", "_bits")), "_word", "left")
    found = F.expr(f"coalesce((shiftright(_bits, cast({place} % 62 as int)) & 1) = 1, false)")
    return joined, found


def rows_of(df: DataFrame, ids: DataFrame, column: str, scratch) -> DataFrame:
    """Rows whose id is in ``ids``: only those that pass a filter of fixed size are shuffled."""
    joined, found = maybe_in(df, id_marks(ids, column, scratch), column)
    some = joined.where(found).select(df.columns)
    return some.join(ids.select(column).distinct().hint("merge"), column, "left_semi")


def rows_without(df: DataFrame, ids: DataFrame, column: str, scratch) -> DataFrame:
    """Rows whose id is not in ``ids``, null ones too; rows that the filter clears stay put."""
    joined, found = maybe_in(df, id_marks(ids, column, scratch), column)
    unsure = joined.where(found).select(df.columns)
    gone = ids.select(column).distinct().hint("merge")
    return joined.where(~found).select(df.columns).union(unsure.join(gone, column, "left_anti"))
