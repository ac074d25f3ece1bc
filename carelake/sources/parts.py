"""Tables kept in hash parts of a key, of which a change rewrites those it touches.

A change is first staged beside the table, then declared in the lake's journal, and then
the staged parts take the place of the old ones by renaming, so rows are written once. A run
that dies before the declaration changed nothing; one that dies after it is finished by
`settle`, as often as it takes. Several tables change under one declaration. One writer at a time.

Rows lie in the order of part and key, in slices that the shuffle makes: a slice holds few
parts, a large part has several slices, and equal keys lie side by side and pack well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from carelake.functions.deid import packed, unpacked

T = TypeVar("T")

PART = "part"
#: The column of tokens that are worth packing in a merge; other texts are short.
PERSON = "person_id"
#: Parts of a table: its bytes divided by about a gigabyte, and the same as long as the table lives.
PARTS = 64
#: What the last merge did to a row of a table: whether it came in then, and what it took the place of.
TAKEN, OLD = "_taken", "_old"
MARKS = (TAKEN, OLD)
#: The slice that a row is shuffled into.
SLICE = "_slice"
#: Rows of a slice: fewer are not worth a task of their own, and more are too many for one, about.
LEAST_ROWS, MOST_ROWS = 20_000, 1_000_000


def part_of(key: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def _opened(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or no file in it
            return None
        raise


def read_parts(spark: SparkSession, path: str, key: str, touched: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of a table, or of its `touched` parts only; None before its first change."""
    table = _opened(spark, path)
    if table is None:
        return None
    rows = table if touched is None else table.filter(F.col(PART).isin(list(touched)))
    # a touched part that lost all its rows holds one without a key
    return rows.filter(F.col(key).isNotNull()).drop(PART, *MARKS)


def touched_parts(rows: DataFrame, key: str, parts: int = PARTS) -> list[int]:
    """The parts that the keys of `rows` fall into: at most `parts` numbers reach the driver."""
    return sorted(part_counts(rows, key, parts))


def part_counts(rows: DataFrame, key: str, parts: int = PARTS) -> dict[int, int]:
    """How many of `rows` fall into each part: at most `parts` rows reach the driver."""
    found = rows.filter(F.col(key).isNotNull()).groupBy(part_of(key, parts).alias(PART)).count()
    return {r[PART]: r["count"] for r in found.collect()}


@dataclass(frozen=True)
class Slices:
    """Which slice a row of the touched parts goes to, by a hash of its key, so that no sample of the rows is needed.

    Every touched part has `fine` buckets. A slice holds buckets that follow each other, or a
    bucket with very many rows has several slices, of which a hash of other columns names one.
    """

    touched: tuple[int, ...]
    parts: int
    fine: int
    first: tuple[int, ...]
    several: tuple[int, ...]

    @classmethod
    def even(cls, spark: SparkSession, touched: Sequence[int], parts: int, rows: int) -> Slices:
        """Of about `rows` rows whose keys repeat little."""
        fine = _fine(spark, touched)
        return cls._cut(spark, touched, parts, fine, [rows / max(1, len(touched) * fine)] * (len(touched) * fine), False)

    @classmethod
    def counted(cls, rows: DataFrame, key: str, touched: Sequence[int], parts: int) -> Slices:
        """Of `rows`, whose keys may repeat very often: their buckets are counted, which reads the keys only."""
        spark = rows.sparkSession
        fine = _fine(spark, touched)
        empty = cls(tuple(touched), parts, fine, (), ())
        counts = [0] * (len(touched) * fine)
        for r in rows.groupBy(empty._bucket(key).alias("bucket")).count().collect():
            if r["bucket"] is not None:
                counts[r["bucket"]] = r["count"]
        return cls._cut(spark, touched, parts, fine, counts, True)

    @classmethod
    def _cut(cls, spark: SparkSession, touched: Sequence[int], parts: int, fine: int, counts: Sequence[float], parted: bool) -> Slices:
        total = sum(counts)
        n = max(min(_partitions(spark), total // LEAST_ROWS + 1), total // MOST_ROWS + 1)
        size, at, held = max(1.0, total / n), 0, 0.0
        first, several = [], []
        for count in counts:
            pieces = int(-(-count // size)) if parted and count >= 2 * size else 1
            if held and (held + count / 2 > size or pieces > 1):
                at, held = at + 1, 0.0
            first.append(at)
            several.append(pieces)
            held += count
            if pieces > 1:
                at, held = at + pieces, 0.0
        return cls(tuple(touched), parts, fine, tuple(first), tuple(several))

    def _bucket(self, key: str) -> Column:
        """The bucket of a row; null for one of an untouched part or without a key."""
        place = {p: i * self.fine for i, p in enumerate(self.touched)}
        start = F.element_at(F.array(*[F.lit(place.get(p)).cast("int") for p in range(self.parts)]), part_of(key, self.parts) + 1)
        return start + F.pmod(F.shiftright(F.xxhash64(F.col(key).cast("string")), 32), F.lit(self.fine)).cast("int")

    def dealt(self, rows: DataFrame, key: str, within: Sequence[str]) -> tuple[int, DataFrame]:
        """The number of slices, and `rows` with theirs as SLICE; a row without a key goes to the first of its part."""
        if not self.first:
            return 1, rows.withColumn(SLICE, F.lit(0))
        starts = {p: i * self.fine for i, p in enumerate(self.touched)}
        unkeyed = F.element_at(F.array(*[F.lit(starts.get(p, 0)) for p in range(self.parts)]), F.col(PART) + 1)
        bucket = F.coalesce(self._bucket(key), unkeyed) + 1
        place = F.element_at(F.array(*[F.lit(x) for x in self.first]), bucket)
        if max(self.several) > 1:
            pieces = F.element_at(F.array(*[F.lit(x) for x in self.several]), bucket)
            place += F.pmod(F.xxhash64(*(within or rows.columns)), pieces).cast("int")
        return max(a + b for a, b in zip(self.first, self.several)), rows.withColumn(SLICE, place)


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _fine(spark: SparkSession, touched: Sequence[int]) -> int:
    """Buckets of a part: a few for each partition of the session."""
    return -(-4 * _partitions(spark) // max(1, len(touched)))


def _staged(path: str) -> str:
    return f"{path}.staged"


def spread(
    rows: DataFrame, path: str, key: str, touched: Sequence[int], parts: int = PARTS, within: Sequence[str] = (),
    pack: Sequence[str] = (), slices: Slices | None = None,
) -> DataFrame:
    """`rows` with their part, shuffled once into slices of part and key, and a row without a key for each touched part.

    Rows of one part, key and `within` share a slice, which is the column SLICE. Without `slices` these are ranges, found
    by a sample, for which `rows` are computed once more. The columns `pack` come as `deid.packed` has them.
    A row of any other part is an error, since its part would lose its other rows.
    """
    part = part_of(key, parts)
    message = F.concat(F.lit(f"stage {path}: a row of an untouched part: "), F.col(key).cast("string"))
    checked = F.when(part.isin(list(touched)) if touched else F.lit(False), part).otherwise(F.raise_error(message).cast("int"))
    empty = rows.sparkSession.createDataFrame([(p,) for p in touched], f"{PART} int").coalesce(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema], PART)
    whole = rows.withColumn(PART, checked).unionByName(empty)
    n, dealt = (0, whole.withColumn(SLICE, F.lit(0))) if slices is None else slices.dealt(whole, key, within)
    near = dealt.withColumns({c: packed(F.col(c)) for c in pack})
    return near.repartitionById(n, SLICE) if n else near.repartitionByRange(PART, key, *within)


def texts(rows: DataFrame) -> list[str]:
    """The columns of `rows` that may be packed."""
    return [f.name for f in rows.schema if isinstance(f.dataType, StringType)]


def stage(
    rows: DataFrame, path: str, key: str, touched: Sequence[int], parts: int = PARTS, slices: Slices | None = None
) -> DataFrame:
    """Write all rows that the `touched` parts of the table at `path` are to hold beside it; the rows read back."""
    packs = texts(rows)
    near = spread(rows, path, key, touched, parts, pack=packs, slices=slices).sortWithinPartitions(PART, key).drop(SLICE)
    return stage_spread(near.withColumns({c: unpacked(F.col(c)) for c in packs}), path, key)


def stage_spread(rows: DataFrame, path: str, key: str) -> DataFrame:
    """The same of rows that `spread` has brought together, in the order of their part."""
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(PART).parquet(_staged(path))
    staged = rows.sparkSession.read.schema(rows.schema).parquet(_staged(path))
    return staged.filter(F.col(key).isNotNull()).drop(PART)


def commit(spark: SparkSession, root: str, paths: Sequence[str]) -> None:
    """Lay what is staged for `paths` over the tables; the journal below `root` names them until it is done."""
    spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1).write.mode("overwrite").parquet(f"{root}/journal")
    settle(spark, root)


def settle(spark: SparkSession, root: str) -> None:
    """Finish the declared change of a run that died half-way, if there is one."""
    journal = _opened(spark, f"{root}/journal")
    declared = [] if journal is None else [r["path"] for r in journal.collect()]
    if not declared:
        return

    def lay(path: str) -> None:
        # a part that has moved is not found again, so a run that dies here goes on where it was
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(folder(path))
        for status in files.listStatus(folder(_staged(path))):
            name = status.getPath().getName()
            if name.startswith(f"{PART}="):
                place = folder(path, name)
                files.delete(place, True)
                if not files.rename(status.getPath(), place):
                    raise OSError(f"settle: {place} could not be put in place")

    together([partial(lay, path) for path in declared])
    spark.createDataFrame([], "path string").coalesce(1).write.mode("overwrite").parquet(f"{root}/journal")


def together(jobs: Sequence[Callable[[], T]]) -> list[T]:
    """The results of jobs that do not depend on each other, which share the cluster."""
    if not jobs:
        return []
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(job)) for job in jobs]]
