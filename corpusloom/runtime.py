"""Session-level helpers: lineage cuts, joins on hot keys, bounded broadcasts, distributed prefix sums."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot when it holds more than this part of all rows, so there are never more hot keys than this number, and more rows than any task minds.
HOT_PART = 1000
HOT_ROWS = 10_000
#: Tasks that share the rows of one hot key.
HOT_SHARES = 64


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; on a
    cluster that would be a folder other machines do not see, so there it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpusloom-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the checkpoint folder and goes on from there.

    Iterative operators call it once a round: the plan stays short and a lost
    executor costs one round at most.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Workspace:
    """Tables that one run of an iterative operator writes into the shared checkpoint folder.

    A round's table is read back from storage, so lineage stays short and a
    lost executor costs one round; :meth:`drop` removes a table as soon as the
    next one is written, so that only the last rounds take up space. Tables are
    Parquet: columnar and compressed, where a checkpoint holds plain rows.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._root = f"{checkpoint_folder(spark)}/run-{uuid.uuid4().hex}"
        self._written = 0
        self._marked = False

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self._root}/{self._written:04d}"
        self._written += 1
        self._delete_on_exit()  # what the last plan still reads goes when the application ends
        df.write.parquet(path)
        table = self._spark.read.schema(df.schema).parquet(path)
        table._written_at = path
        return table

    def path(self, name: str) -> str:
        """A path under the run's folder for a writer of its own; it goes when the application ends."""
        self._delete_on_exit()
        return f"{self._root}/{name}"

    def _delete_on_exit(self) -> None:
        if not self._marked:
            sc = self._spark.sparkContext
            root = sc._jvm.org.apache.hadoop.fs.Path(self._root)
            fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
            fs.mkdirs(root)
            fs.deleteOnExit(root)
            self._marked = True

    def drop(self, *tables: DataFrame) -> None:
        """Deletes written tables; nothing lazy may still read them."""
        sc = self._spark.sparkContext
        for table in tables:
            path = sc._jvm.org.apache.hadoop.fs.Path(table._written_at)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def bounded_side(df: DataFrame, rows: int, what: str) -> DataFrame:
    """``df`` to be broadcast: a plan or a table of names that may hold ``rows`` rows at most; more are an error, never another plan."""
    if df.limit(rows + 1).count() > rows:
        raise ValueError(f"{what} may hold {rows} rows at most")
    return F.broadcast(df)


def hot_keys(counted: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """The keys of ``counted(keys, size)`` that hold more than one row in ``HOT_PART``, so ``HOT_PART`` of them at most, ready to be broadcast."""
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    counted = counted.select(*keys, F.col(size).alias("__n"))
    whole = counted.agg(F.sum("__n").alias("__all"))
    hot = counted.crossJoin(F.broadcast(whole)).where(known & (F.col("__n") > HOT_ROWS) & (F.col("__n") * HOT_PART > F.col("__all")))  # one row
    return F.broadcast(hot.select(*keys, F.lit(True).alias("__hot")))  # HOT_PART rows at most


def dealt(rows: DataFrame, hot: DataFrame, keys: Sequence[str], by: Column | str) -> DataFrame:
    """``rows`` with ``__share``: rows of hot and of NULL keys are dealt out over ``HOT_SHARES`` by the hash of ``by``, all others have 0."""
    unknown = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    by = F.col(by) if isinstance(by, str) else by
    share = F.when(F.coalesce("__hot", F.lit(False)) | unknown, F.pmod(F.xxhash64(by), F.lit(HOT_SHARES)).cast("int")).otherwise(0)
    return rows.join(hot, list(keys), "left").withColumn("__share", share).drop("__hot")


def copied(one: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``one``, which has one row a key, with ``__share``: a hot key's row comes for each of the ``HOT_SHARES``."""
    shares = F.when(F.coalesce("__hot", F.lit(False)), F.sequence(F.lit(0), F.lit(HOT_SHARES - 1))).otherwise(F.array(F.lit(0)))
    return one.join(hot, list(keys), "left").withColumn("__share", F.explode(shares)).drop("__hot")


def spread_join(rows: DataFrame, one: DataFrame, keys: Sequence[str], by: Column | str, how: str = "inner", size: str | None = None) -> DataFrame:
    """Joins ``rows`` with ``one``, which has one row a key, so that no task gets all rows of a frequent key.

    See :func:`dealt` and :func:`copied`. ``size`` names a column of ``one`` with
    the key's number of rows; without it they are counted. ``how`` is inner or left.
    """
    keys = list(keys)
    counted = one if size else rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    hot = hot_keys(counted, keys, size or "__size")
    return dealt(rows, hot, keys, by).join(copied(one, hot, keys), [*keys, "__share"], how).drop("__share")


def hot_list(counted: DataFrame, key: str, size: str, *also: Column) -> tuple[list, list]:
    """The hot keys of a written table ``counted(key, size)``, ``HOT_PART`` at most, for operators that use them in many joins; and the aggregates ``also`` of the same pass."""
    whole, most, *more = counted.agg(F.sum(size), F.max(size), *also).first()
    if not whole or most <= HOT_ROWS or most * HOT_PART <= whole:
        return [], more
    return [r[0] for r in counted.where((F.col(size) > HOT_ROWS) & (F.col(size) * HOT_PART > whole)).select(key).collect()], more


def share_of(key: str, hot: list, by: str) -> Column:
    """As :func:`dealt`, for a list of hot keys."""
    return F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(by), F.lit(HOT_SHARES)).cast("int")).otherwise(0) if hot else F.lit(0)


def shares_of(key: str, hot: list) -> Column:
    """As :func:`copied`, for a list of hot keys: the shares a row must come for."""
    one = F.array(F.lit(0))
    return F.explode(F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(HOT_SHARES - 1))).otherwise(one) if hot else one)


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    cell: Column,
    order: Sequence[str],
    sums: dict[str, Column],
    whole_order: bool = False,
) -> DataFrame:
    """Adds, for each entry of ``sums``, the sum of its values over all earlier rows.

    Earlier means: same ``group`` (with ``whole_order`` also every smaller
    group), then smaller ``cell``, then smaller ``order``. ``cell`` cuts a group
    into pieces along ``order`` (say the first digits of a hash), so that no
    task ever sorts a whole group: cell totals are summed first, a window over
    the small table of totals gives the cells' offsets, and the rows need one
    window within their cell.

    ``group`` and ``cell`` must not be NULL (such rows are not returned);
    NULL values count as 0; an empty input gives an empty result.
    """
    group = list(group)
    rows = df.withColumn("__cell", cell)
    for name, value in sums.items():
        rows = rows.withColumn(f"__v_{name}", F.coalesce(value, F.lit(0)).cast("long"))
    totals = rows.groupBy(*group, "__cell").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums])
    over = Window.partitionBy(*([] if whole_order else group)).orderBy(*(group if whole_order else []), "__cell")
    over = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "__cell", *[F.coalesce(F.sum(f"__t_{n}").over(over), F.lit(0)).alias(f"__o_{n}") for n in sums]
    )
    inside = Window.partitionBy(*group, "__cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(offsets, [*group, "__cell"])
    return joined.select(
        *df.columns,
        *[(F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) + F.col(f"__o_{n}")).alias(n) for n in sums],
    )
