"""Differences between two copies of a keyed table, found by invertible Bloom lookup tables.

Every row of either copy is one element (64-bit key hash, 64-bit hash of its fields). The elements fall into buckets
by key; a bucket's lookup table is an array of cells, each the count and the XORs of the elements that hash to it.
Adding one copy and subtracting the other cancels what both hold, so a table's size follows the differences it must
reveal and not the rows it summarises. Peeling the cells that hold one element names the differing keys; only their
rows are fetched and compared field by field. A bucket that holds more differences than its cells can tell apart is
compared whole, so nothing is ever lost.
"""

from __future__ import annotations

import struct

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys per bucket, and cells per key: three hash places a key, decodable up to about 0.8 differing elements a cell; a changed row is two elements.
BUCKET_KEYS, CELLS_PER_KEY, PLACES = 1024, 0.75, 3


def set_hash(code: Column, value: Column, quantum: float) -> Column:
    """Order-free summand of a field's hash; values in one ``quantum`` hash alike, nulls not at all."""
    return F.when(value.isNotNull(), F.xxhash64(code, F.round(value / F.lit(quantum)).cast("long"))).otherwise(F.lit(0).cast("long"))


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("k", F.lit(-1).cast("long")), F.lit(buckets)).cast("int")


def lookup_cells(elements: DataFrame, buckets: int, cells: int) -> DataFrame:
    """Subtracted tables of ``elements`` (k, h, sign): one row for each cell that is not empty.

    Rows of a bucket are combined before the shuffle, so a hot bucket moves at most its cells.
    """
    part = cells // PLACES
    # an element's places follow its check word, so the two versions of a changed row fall on cells of their own
    places = F.array(*[(F.pmod(F.xxhash64("c", F.lit(i).cast("long")), F.lit(part)) + F.lit(i * part)).cast("int") for i in range(PLACES)])
    checked = elements.select(bucket_of(buckets).alias("bucket"), "k", "h", "sign", F.xxhash64("k", "h").alias("c"))
    spread = checked.select("*", F.explode(places).alias("cell"))
    table = spread.groupBy("bucket", "cell").agg(F.sum("sign").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.bit_xor("c").alias("c"))
    return table.where("n <> 0 or k <> 0 or h <> 0 or c <> 0")


def peel(cells: int) -> object:
    """Peeler of one bucket: the differing key hashes, or one row without a key if the bucket can't be decoded.

    A cell holds one element if its count is 1 or -1 and its check word is the hash of its other two words.
    """
    part = cells // PLACES

    def run(bucket: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        words = {int(r[1]): [int(r[2]), int(r[3]), int(r[4]), int(r[5])] for r in pdf[["bucket", "cell", "n", "k", "h", "c"]].itertuples(index=False)}
        found: list[int] = []
        todo = [cell for cell, w in words.items() if abs(w[0]) == 1]
        while todo:
            cell = todo.pop()
            w = words.get(cell)
            if w is None or abs(w[0]) != 1 or _xx(w[1], w[2]) != w[3]:
                continue
            n, k, h, c = w
            found.append(k)
            for other in places_of(c, part):
                x = words.setdefault(other, [0, 0, 0, 0])
                x[0] -= n
                x[1] ^= k
                x[2] ^= h
                x[3] ^= c
                if x == [0, 0, 0, 0]:
                    del words[other]
                elif abs(x[0]) == 1:
                    todo.append(other)
        keys = list(dict.fromkeys(found))
        return pd.DataFrame({"bucket": bucket[0], "k": pd.array([None] if words else keys, dtype="Int64")})

    return run


def _xx(*words: int) -> int:
    """What SQL's ``xxhash64`` gives for bigints: XXH64 of each word, seeded with the hash of those before it."""
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", word), seed & 0xFFFFFFFFFFFFFFFF)
    return seed - (1 << 64) if seed >> 63 else seed


def places_of(c: int, part: int) -> list[int]:
    """The cells of check word ``c``; equals the expression in ``lookup_cells``."""
    return [_xx(c, i) % part + i * part for i in range(PLACES)]


def differing_keys(left: DataFrame, right: DataFrame, rows: int) -> DataFrame:
    """(bucket, k): key hashes whose rows differ; k null: every key of the bucket must be compared.

    ``left`` and ``right`` have (k, h), a key at most once. ``rows``: about how many keys there are; a wrong figure
    costs time, never results. Empty sides are allowed.
    """
    buckets = max(1, rows // BUCKET_KEYS)
    cells = max(3 * PLACES, int(min(rows, BUCKET_KEYS) * CELLS_PER_KEY) // PLACES * PLACES)
    signed = left.select("k", "h", F.lit(1).alias("sign")).unionByName(right.select("k", "h", F.lit(-1).alias("sign")))
    table = lookup_cells(signed, buckets, cells)
    peeled = table.groupBy("bucket").applyInPandas(peel(cells), "bucket int, k bigint")
    return peeled.withColumn("buckets", F.lit(buckets))


def rows_to_compare(side: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``side`` (with k) whose key differs or whose bucket could not be decoded."""
    named = keys.where("k is not null").select("k")
    whole = keys.where("k is null").select("bucket")
    by_key = side.join(named, "k", "left_semi")
    in_bucket = side.withColumn("bucket", bucket_of(buckets)).join(whole, "bucket", "left_semi").drop("bucket")
    return by_key.unionByName(in_bucket)
