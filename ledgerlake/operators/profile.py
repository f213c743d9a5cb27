"""Exact order statistics of many columns at once, by one range sort of their unpivoted values.

Values are range-partitioned and sorted by (group, value, partition of origin), so a group, however hot, and a value,
however frequent, are runs over neighbouring partitions. Equal values are counted as they stream by. A group that lies
inside one partition and one block is finished there; any other leaves blocks of distinct values with their counts,
each written as soon as it is full, so a worker holds a block and a batch. Prefix counts over the blocks locate any
rank, and only the blocks that hold a wanted rank are read again. A group may hold two samples; the same blocks then
carry the two cumulative curves whose largest gap is the Kolmogorov-Smirnov distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import width, written

#: Distinct values of a block, and values after which finished rows are handed on.
BLOCK, FLUSH_VALUES = 32_768, 262_144
#: Least values a partition should hold, and their factor to the root of all values: so the number of partitions and
#: their size both grow, 10^13 values coming to some 50 000 partitions.
PARTITION_LEAST, PARTITION_ROOT = 500_000, 60
SCHEMA = "key bigint, pid int, seq int, whole boolean, n bigint, n_old bigint, uniques bigint, lo double, hi double, first double, last double, q array<double>, ks double, vals array<double>, new array<bigint>, old array<bigint>"
_ARROW = pa.schema(
    [("key", pa.int64()), ("pid", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("n", pa.int64()), ("n_old", pa.int64()), ("uniques", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()), ("first", pa.float64()), ("last", pa.float64()), ("q", pa.list_(pa.float64())), ("ks", pa.float64()), ("vals", pa.list_(pa.float64())), ("new", pa.list_(pa.int64())), ("old", pa.list_(pa.int64()))]
)


def ks_distance(new: np.ndarray, old: np.ndarray, n_new: int, n_old: int, before_new: int = 0, before_old: int = 0) -> float:
    """Largest gap of the two cumulative curves at distinct sorted values, given how often each stands in either sample."""
    if not n_new or not n_old:
        return float("nan")
    return float(np.max(np.abs((np.cumsum(new) + before_new) / n_new - (np.cumsum(old) + before_old) / n_old))) if len(new) else 0.0


def at_ranks(values: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Values at zero-based ranks among ``values`` repeated ``counts`` times."""
    return values[np.searchsorted(np.cumsum(counts), ranks, side="right")]


def quantiles(values: np.ndarray, counts: np.ndarray, probabilities: list[float]) -> list[float]:
    """Interpolated between the two middle ranks."""
    at = (int(counts.sum()) - 1) * np.asarray(probabilities)
    lo, hi = at_ranks(values, counts, np.floor(at)), at_ranks(values, counts, np.ceil(at))
    return list(lo + (hi - lo) * (at - np.floor(at)))


class Blocks:
    """The open group of a partition: distinct values with their counts, and what it has handed on."""

    def __init__(self, pid: int, probabilities: list[float]):
        self.pid, self.probabilities = pid, probabilities
        self.rows: list[dict] = []
        self.held = 0
        self.key: int | None = None
        self.groups = 0

    def start(self, key: int) -> None:
        self.key, self.seq, self.parts = key, 0, []
        self.groups += 1

    def add(self, v: np.ndarray, new: np.ndarray, old: np.ndarray) -> None:
        """More of the open group; a value that was last so far goes on. A full block leaves, but for its last value."""
        if self.parts and self.parts[-1][0][-1] == v[0]:
            self.parts[-1][1][-1] += new[0]
            self.parts[-1][2][-1] += old[0]
            v, new, old = v[1:], new[1:], old[1:]
        if len(v):
            self.parts.append((v, new, old))
        if sum(len(p[0]) for p in self.parts) > BLOCK:
            v, new, old = self.taken()
            self.block(v[:-1], new[:-1], old[:-1])
            self.parts = [(v[-1:], new[-1:], old[-1:])]

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.concatenate([p[i] for p in self.parts]) for i in range(3))

    def row(self, v: np.ndarray, new: np.ndarray, old: np.ndarray, more: dict) -> None:
        mine = v[new > 0]
        lo, hi = (mine[0], mine[-1]) if len(mine) else (None, None)
        self.rows.append({"key": self.key, "pid": self.pid, "seq": self.seq, "whole": False, "n": int(new.sum()), "n_old": int(old.sum()), "uniques": len(mine), "lo": lo, "hi": hi, "first": v[0], "last": v[-1]} | more)

    def block(self, v: np.ndarray, new: np.ndarray, old: np.ndarray) -> None:
        for i in range(0, len(v), BLOCK):
            x, a, b = v[i : i + BLOCK], new[i : i + BLOCK], old[i : i + BLOCK]
            self.row(x, a, b, {"vals": x, "new": a, "old": b})
            self.seq += 1
        self.held += len(v)

    def close(self, last: bool) -> None:
        if self.key is None:
            return
        v, new, old = self.taken()
        if self.seq or self.groups == 1 or last:
            self.block(v, new, old)
        else:
            some, both = int(new.sum()), int(old.sum())
            self.row(v, new, old, {"whole": True, "q": quantiles(v, new, self.probabilities) if some else None, "ks": ks_distance(new, old, some, both)})

    def flush(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in self.rows], f.type) for f in _ARROW], schema=_ARROW)
        self.rows, self.held = [], 0
        return out


def summarise(probabilities: list[float]):
    """Stream of sorted batches (key, v, old) of one partition -> group summaries and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Blocks(TaskContext.get().partitionId(), probabilities)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            old = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            fresh = np.r_[True, keys[1:] != keys[:-1]]
            runs = np.flatnonzero(fresh | np.r_[True, values[1:] != values[:-1]])
            c_old = np.add.reduceat(old, runs)
            c_new = np.diff(np.r_[runs, len(keys)]) - c_old
            v, starts = values[runs], np.flatnonzero(fresh[runs])
            for i, j in zip(starts, [*starts[1:], len(runs)]):
                key = int(keys[runs[i]])
                if key != state.key:
                    state.close(last=False)
                    state.start(key)
                state.add(v[i:j], c_new[i:j], c_old[i:j])
            if state.held > FLUSH_VALUES or len(state.rows) > 2000:
                yield state.flush()
        state.close(last=True)
        if state.rows:
            yield state.flush()

    return run


def sorted_groups(values: DataFrame, probabilities: list[float], rows: int = 0) -> DataFrame:
    """Summaries and blocks of ``values`` (key bigint, v double[, old boolean]), none null; written once, by column.

    An empty input gives no rows. With ``old`` a group holds two samples; counts, bounds and quantiles are of the one
    that is not old. ``rows``: about how many values there are, for the number of partitions.
    """
    spark = values.sparkSession
    tagged = values if "old" in values.columns else values.withColumn("old", F.lit(False))
    placed = tagged.select("key", "v", "old", F.spark_partition_id().alias("origin"))
    ordered = placed.repartitionByRange(max(width(spark), rows // max(PARTITION_LEAST, int(PARTITION_ROOT * rows**0.5))), "key", "v", "origin").sortWithinPartitions("key", "v")
    return written(ordered.select("key", "v", "old").mapInArrow(summarise(probabilities), SCHEMA))


def _edges(groups: DataFrame) -> DataFrame:
    """Blocks without their values: counts before each block within its group, and whether its first value went before."""
    by_key = Window.partitionBy("key").orderBy("pid", "seq")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    return groups.where("not whole").select(
        "key", "pid", "seq", "n", "n_old", "uniques", "lo", "hi", "first", "last",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.sum("n_old").over(earlier), F.lit(0)).alias("before_old"),
        F.coalesce((F.last("hi", ignorenulls=True).over(earlier) == F.col("lo")).cast("int"), F.lit(0)).alias("joined"),
        F.coalesce(F.lead("first").over(by_key) == F.col("last"), F.lit(False)).alias("goes_on"),
    )


def order_statistics(groups: DataFrame, probabilities: list[float]) -> DataFrame:
    """(key, n, uniques, lo, hi, q): exact count, distinct count, bounds and quantiles of each group's own sample."""
    done = groups.where("whole and n > 0").select("key", "n", "uniques", "lo", "hi", "q")
    edges = _edges(groups)
    stats = edges.groupBy("key").agg(F.sum("n").alias("n"), (F.sum("uniques") - F.sum("joined")).alias("uniques"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n > 0")
    at = F.transform(F.array(*[F.lit(float(p)) for p in probabilities]), lambda p: (F.col("n") - 1) * p)
    wanted = stats.select("key", F.posexplode(at).alias("i", "at")).select(
        "key", "i", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank")
    )
    holders = wanted.join(edges.select("key", "pid", "seq", "before", (F.col("before") + F.col("n")).alias("after")), "key").where("rank >= before and rank < after")
    read = groups.where("not whole").select("key", "pid", "seq", "vals", "new").join(holders, ["key", "pid", "seq"])

    def located(frames):
        for pdf in frames:
            found = [float(at_ranks(np.asarray(r.vals), np.asarray(r.new), np.array([r.rank - r.before]))[0]) for r in pdf.itertuples(index=False)]
            yield pdf[["key", "i", "at"]].assign(v=found)

    found = read.mapInPandas(located, "key bigint, i int, at double, v double")
    each = found.groupBy("key", "i").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.first("at").alias("at"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    q = each.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))).alias("q")).select("key", F.transform("q", lambda s: s["v"]).alias("q"))
    return done.unionByName(stats.join(q, "key", "left").select(done.columns))


def ks_distances(groups: DataFrame) -> DataFrame:
    """(key, ks) of groups with two samples; null where one sample is empty."""
    done = groups.where("whole").select("key", "ks")
    edges = _edges(groups)
    total = edges.groupBy("key").agg(F.sum("n").alias("t"), F.sum("n_old").alias("t_old"))
    blocks = groups.where("not whole").select("key", "pid", "seq", "new", "old").join(edges.select("key", "pid", "seq", "before", "before_old", "goes_on"), ["key", "pid", "seq"]).join(total, "key")

    def gaps(frames):
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                # a value that goes on in the next block is no point of the curves yet; it is read there
                stop = len(r.new) - bool(r.goes_on)
                out.append(ks_distance(np.asarray(r.new)[:stop], np.asarray(r.old)[:stop], r.t, r.t_old, r.before, r.before_old))
            yield pdf[["key"]].assign(ks=out)

    edge = blocks.mapInPandas(gaps, "key bigint, ks double").groupBy("key").agg(F.max("ks").alias("ks"))
    return done.unionByName(edge).select("key", F.nanvl("ks", F.lit(None).cast("double")).alias("ks"))
