"""Connected groups of similar things, found from shared buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.session import scratch_path

# Ids that may be broadcast to pick rows of a table: 8 bytes each.
BROADCAST_IDS = 400_000
# Ids of a bucket in a block of the last comparison.
CELL = 1000


# Paths of the tables stored in each open block of :func:`freed`, the innermost last.
_blocks: list[list[str]] = []


def stored(df: DataFrame, label: str, keep: bool = False, codec: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back; cuts the lineage for good.

    Inside a block of :func:`freed` the table goes when the block ends; ``keep``
    leaves it to the block around that one. ``codec`` compresses wide texts harder.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    owner = _blocks[:-1] if keep else _blocks
    if owner:
        owner[-1].append(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Remove the tables stored in the block when it ends: what it returns must be stored with ``keep``."""
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        # Spark removes the shuffle files of a plan once the driver has forgotten the plan.
        spark._jvm.System.gc()


def pick(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``ids`` (a stored table with a column of that name).

    Few ids are broadcast, which spares a shuffle of wide rows; more go by a
    shuffled join, with the same result.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), key, "left_semi")


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not among ``ids``; null keys stay. The other half of :func:`pick`."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), key, "left_anti")


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id it reaches.

    Each round hangs all larger neighbours of an id on its smallest neighbour,
    then all smaller ones, until every id hangs on the root of a star. Links stay
    in tables, one written in each round.
    """
    with freed(links.sparkSession):
        return _settled(links, rounds)


def _settled(links: DataFrame, rounds: int) -> DataFrame:
    now = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            ends = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return stored(now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(ends), "components", keep=True)
        before = state
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        now = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
    raise RuntimeError("components did not settle")


def linked_groups(
    buckets: DataFrame,
    sketches: DataFrame,
    close: Callable[[Column, Column], Column],
    confirm: Callable[[DataFrame], DataFrame],
    known: DataFrame | None = None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    closer: Callable[[Column, Column], Column] | None = None,
    small: bool = False,
) -> DataFrame:
    """Connected groups of the true links among ids that share a bucket.

    ``buckets`` has (bucket, id), ``sketches`` (id, sketch), or gives it for a table of
    ids; ``close`` is a cheap
    test of two sketches that no true link may fail, ``confirm`` keeps the true
    links of a table of pairs (a, b). ``known`` links are taken as they are. Returns (id, component) for linked ids.

    A group of n similar ids does not cost n * n pairs: in each bucket all ids
    are first paired with one hub, the id that shares most buckets overall; then
    ids that still differ in group with a hub chosen anew, once inside the hub's
    group and once outside. Only then are pairs across groups of a bucket
    compared, all of them, so no link between groups is lost. For these ids alone
    ``refine`` may give longer sketches (id, more), tested by ``closer`` inside
    the join, so that pairs just below the threshold are not written out.
    """
    spark = buckets.sparkSession
    with freed(spark):
        return stored(_linked(buckets, sketches, close, confirm, known, refine, closer, small), "groups", keep=True)


def _linked(buckets, sketches, close, confirm, known, refine, closer, small) -> DataFrame:
    spark = buckets.sparkSession
    many = stored(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "many")
    shared = stored(buckets.join(many.hint("shuffle_hash"), "bucket"), "shared")
    score = shared.groupBy("id").agg(F.sum("n").alias("score"))
    if callable(sketches):
        score = stored(score, "score")
        sketches = sketches(score.select("id"))
    inner = stored(score.join(sketches, "id"), "scores")
    own = ["id", "sketch"] if small else ["id"]
    rows = stored(shared.select("bucket", "id").join(inner.select(*own, "score"), "id").select("bucket", *own, "score"), "rows")
    me = F.struct(*own)
    hub = rows.groupBy("bucket").agg(F.max_by(me, "score").alias("hub"))
    pairs = rows.join(hub, "bucket").where("id <> hub.id")
    left, right = inner.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), inner.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))

    def tested(pairs: DataFrame) -> DataFrame:
        """Close pairs of an id and a hub, each once, with the smaller id first."""
        pairs = pairs.where(close(F.col("sketch"), F.col("hub.sketch"))) if small else pairs
        once = pairs.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
        return once if small else once.join(left, "a").join(right, "b").where(close(F.col("sa"), F.col("sb"))).select("a", "b")

    done = stored(tested(pairs), "pairs")

    def confirmed(pairs: DataFrame) -> DataFrame:
        with freed(spark):
            return stored(confirm(pairs), "confirmed", keep=True)

    links = confirmed(done)
    links = links.union(known) if known is not None else links
    groups = connected(links)

    def labelled() -> DataFrame:
        """Rows of buckets with more than one group, with their group."""
        every = rows.join(groups, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
        mixed = every.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo < hi")
        return every.join(mixed.select("bucket", "size"), "bucket")

    cross = stored(labelled(), "mixed")
    lead = cross.groupBy("bucket").agg(F.max_by("label", "score").alias("main"))
    cross = cross.join(lead, "bucket")
    inside = F.col("label") == F.col("main")
    again = cross.groupBy("bucket").agg(
        F.max_by(F.when(inside, me), F.when(inside, F.xxhash64("id", "bucket"))).alias("p"),
        F.max_by(F.when(~inside, me), F.when(~inside, F.col("score"))).alias("q"),
    )
    rest = cross.where("label <> main").join(again, "bucket")
    pairs = rest.select(me.alias("me"), F.explode(F.array("p", "q")).alias("hub")).select("me.*", "hub").where("id <> hub.id")
    fresh = tested(pairs).join(done, ["a", "b"], "left_anti")
    fresh = stored(fresh, "pairs")
    done = done.union(fresh)
    links = links.union(confirmed(fresh))
    groups = connected(links)

    # A bucket of many ids is cut into blocks; each pair of blocks is a cell of its own.
    blocks = F.ceil(F.col("size") / CELL).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    mixed = labelled() if small else labelled().join(inner.select("id", "sketch"), "id")
    mixed = mixed.select("bucket", "id", "label", "sketch", blocks.alias("blocks"), block.alias("block"))
    mixed = stored(mixed, "mixed")
    test = close(F.col("x.sketch"), F.col("y.sketch"))
    if refine and closer:
        mixed = mixed.join(refine(stored(mixed.select("id").distinct(), "ids")), "id")
        test = test & closer(F.col("x.more"), F.col("y.more"))
    x = mixed.withColumns({"low": F.col("block"), "high": F.explode(F.sequence("block", F.col("blocks") - 1))}).alias("x")
    y = mixed.withColumns({"low": F.explode(F.sequence(F.lit(0), "block")), "high": F.col("block")}).alias("y")
    same = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    # In a cell of one block each pair would come twice.
    apart = (F.col("x.label") < F.col("y.label")) | ((F.col("x.label") > F.col("y.label")) & (F.col("x.block") < F.col("y.block")))
    across = x.join(y.hint("merge"), same & apart & test)
    fresh = across.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    fresh = stored(fresh.join(done, ["a", "b"], "left_anti"), "pairs")
    return connected(links.union(confirmed(fresh)))
