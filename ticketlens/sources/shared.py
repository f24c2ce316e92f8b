"""Tables written once to the cluster's shared folder and read back.

A written table cuts lineage, survives the loss of executors and gives every later query a pruned
columnar scan. The folder is the one the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: dict[str, tuple[SparkSession, str]] = {}


def _application(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def shared_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Where a session names none, a local one gets a temporary folder, which is then set as its
    ``spark.checkpoint.dir`` and logged; any other is refused. The folder is removed at exit.
    """
    app = _application(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = "file://" + tempfile.mkdtemp(prefix="ticketlens-")
        spark.conf.set("spark.checkpoint.dir", named)
        logging.getLogger(__name__).warning("spark.checkpoint.dir is unset; using %s", named)
    root = f"{named.rstrip('/')}/ticketlens-{app}"
    _ROOTS[root] = (spark, root)
    return root


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


@atexit.register
def _remove_roots() -> None:
    for spark, root in _ROOTS.values():
        try:
            delete_folder(spark, root)
        except Exception:  # the session is gone, and with it the way to its files
            logging.getLogger(__name__).info("left behind: %s", root)


def source_tag(spark: SparkSession, path: str) -> str:
    """Changes with the names, sizes and times of all files below a folder; empty where there is none."""
    where, files = _file_system(spark, path)
    if not files.exists(where):
        return ""
    found, listed = [], files.listFiles(where, True)
    while listed.hasNext():
        file = listed.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return hashlib.md5(repr(sorted(found)).encode()).hexdigest()[:12]


def bytes_below(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files below a folder."""
    where, files = _file_system(spark, path)
    return files.getContentSummary(where).getLength()


#: Bytes of stored input of one slice: a table made from more is made slice by slice.
SLICE_BYTES = 1 << 30


def slices_of(spark: SparkSession, *paths: str) -> int:
    """In how many slices a table is made from the files at the paths."""
    return max(1, -(-sum(bytes_below(spark, path) for path in paths) // SLICE_BYTES))


def slice_of(df: DataFrame, key: Column, k: int, slices: int) -> DataFrame:
    """The rows of slice ``k`` of ``slices``. Rows of equal keys are in one slice, whatever table they are of."""
    if slices == 1:
        return df
    # upper bits: the lower ones mark repeated keys, and partitions of a shuffle go by another hash
    return df.where(F.pmod(F.shiftright(F.xxhash64(key), 40), F.lit(slices)) == k)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a query in here has shuffled is removed from disk when it ends, not when the driver's garbage is collected."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def fingerprint(df: DataFrame) -> str:
    """Changes with what a DataFrame is made from: its plan, and the files that the plan reads."""
    folders = sorted({file.rpartition("/")[0] for file in df.inputFiles()})
    tags = [source_tag(df.sparkSession, unquote(folder)) for folder in folders]
    made = repr((df.semanticHash(), df.schema.json(), folders, tags))
    return hashlib.md5(made.encode()).hexdigest()[:12]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Codec of stored tables, which are read often but fill the shared folder.
CODEC = "zstd"
#: Bytes of a row group of a clustered table: the least that a selective read takes.
ROW_GROUP_BYTES = 16 << 20
# Bits of each column's place on the curve that clusters rows.
_BITS = 8


def _curve(columns: Sequence[str]) -> Column:
    """Place on a Z-shaped curve through the hashes of the columns: near places agree in all of them."""
    hashes = [F.xxhash64(c) for c in columns]
    place = F.lit(0).cast("bigint")
    for bit in range(_BITS):
        for k, of_column in enumerate(hashes):
            one = F.shiftright(of_column, bit).bitwiseAND(F.lit(1).cast("bigint"))
            place = place + F.shiftleft(one, bit * len(hashes) + k)
    return place


def write_table(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    cluster: Sequence[str] = (),
    lookup: Sequence[str] = (),
    row_group_bytes: int = ROW_GROUP_BYTES,
    mode: str = "overwrite",
    codec: str | None = None,
) -> None:
    """Replace the Parquet table at ``path``, or add to it with the mode ``append``.

    With a partition column the rows are first brought together by it; the rebalance splits a value
    that holds too many rows over several files and joins small ones. Within a file the rows are ordered so that
    equal values of each ``cluster`` column lie in few row groups, and the ``lookup`` columns get dictionaries or
    Bloom filters by which a reader that asks for one value leaves out the others.
    """
    rows = df if partition is None else df.hint("rebalance", partition)
    order = [*([partition] if partition else []), *([_curve(cluster)] if cluster else [])]
    if cluster:
        rows = rows.sortWithinPartitions(*order)
    writer = rows.write.mode(mode)
    if codec is not None:
        writer = writer.option("compression", codec)
    if cluster or lookup:
        writer = writer.option("parquet.block.size", row_group_bytes)
    for column in lookup:
        # of a column whose dictionary is complete the dictionary is used, and no filter is written
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", "20000")
    if partition is not None:
        writer = writer.partitionBy(partition)
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a table with the schema it was written with, so nothing has to be inferred."""
    return spark.read.schema(like.schema).parquet(path)


def pinned(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a freshly written table."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path, codec=CODEC)
    return read_table(df.sparkSession, path, df)


class SharedTables:
    """Named tables of one data set, each built at first use within an application.

    A name must say all that a table was built from besides the data set itself.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = scratch_path(spark, name)
        self._tables: dict[str, DataFrame] = {}
        self._folders: set[str] = set()

    def table(
        self,
        name: str,
        build: Callable[[], DataFrame | Sequence[DataFrame]],
        check: Callable[[DataFrame], None] | None = None,
        **layout,
    ) -> DataFrame:
        """The named table; ``check`` may refuse it, once it is written, by raising.

        Slices of a table are written one after the other, so that only one is shuffled at a time.
        """
        if name not in self._tables:
            built = build()
            slices = [built] if isinstance(built, DataFrame) else built
            for k, df in enumerate(slices):
                mode = "append" if k else "overwrite"
                write_table(df, f"{self.path}/{name}", mode=mode, codec=CODEC, **layout)
            written = read_table(self.spark, f"{self.path}/{name}", slices[0])
            if check is not None:
                with freed_shuffles(self.spark):
                    check(written)
            self._tables[name] = written
        return self._tables[name]

    def slices(self, name: str) -> int:
        """In how many slices a table is made from the named one, which must be there."""
        return slices_of(self.spark, f"{self.path}/{name}")

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """Path of files that are not a table, written at first use."""
        path = f"{self.path}/{name}"
        if name not in self._folders:
            write(path)
            self._folders.add(name)
        return path


    def drop(self) -> None:
        """Remove all tables. What still reads them can no longer be evaluated."""
        delete_folder(self.spark, self.path)
        self._tables.clear()
        self._folders.clear()

    def refresh(self) -> None:
        """Forget all tables, so that each is built again from its source at its next use."""
        self.drop()
        self.path = scratch_path(self.spark, self.path.rpartition("/")[2].rpartition("-")[0])


_SHARED: dict[tuple[str, str], tuple[str, SharedTables]] = {}


def shared_tables(spark: SparkSession, name: str) -> SharedTables:
    """The tables of the data set in a folder, the same object while its files stay the same."""
    key, tag = (_application(spark), name), source_tag(spark, name)
    if key not in _SHARED or _SHARED[key][0] != tag:
        last = "_".join(name.replace(":", "").strip("/").split("/"))
        _SHARED[key] = (tag, SharedTables(spark, last))
    return _SHARED[key][1]
