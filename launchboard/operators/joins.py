"""Join helpers: size-checked broadcast, NULL-key bypass and hot-key spreading."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__jk"
_BUCKET = "__null_bucket"


def _row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a row: 16 per value, and the length of texts."""
    size = F.lit(16 * max(len(df.columns), 1))
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return size.cast("bigint")


def proven_small(dfs: dict[str, DataFrame], max_bytes: int) -> dict[str, bool]:
    """Whether each relation is at most ``max_bytes`` large, from one job of
    partial sums (one row per relation reaches the driver)."""
    if not dfs:
        return {}
    parts = [df.select(F.lit(k).alias("_rel"), _row_bytes(df).alias("_size")) for k, df in dfs.items()]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    sizes = {r["_rel"]: r["s"] for r in stacked.groupBy("_rel").agg(F.sum("_size").alias("s")).collect()}
    return {k: sizes.get(k, 0) <= max_bytes for k in dfs}


def broadcast_if(df: DataFrame, proven: bool) -> DataFrame:
    """Broadcast a relation proven small, or derived from one (an aggregate or
    projection of it is at most as large)."""
    return F.broadcast(df) if proven else df


#: Buckets of a spread key for each shuffle partition that its rows would fill: many
#: small ones, as buckets meet partitions by hash.
BUCKETS_A_PARTITION = 16


@dataclass(frozen=True)
class Skew:
    """How unevenly rows lie on a join key: the share of rows without one, and the share
    of each hot key (its text)."""

    nulls: float = 0.0
    hot: dict[str, float] = field(default_factory=dict)

    def buckets(self, partitions: int, bypass: bool) -> dict[int, list[str]]:
        """Hot keys by number of buckets, which follows their share of the rows that are
        shuffled; numbers are powers of two, so that they are few."""
        shuffled = max(1.0 - (self.nulls if bypass else 0.0), 1e-9)
        found: dict[int, list[str]] = {}
        for key, share in sorted(self.hot.items()):
            n = BUCKETS_A_PARTITION * partitions * min(share / shuffled, 1.0)
            found.setdefault(1 << max(math.ceil(math.log2(max(n, 2))), 1), []).append(key)
        return found


def find_skew(rows: DataFrame, keys: dict[str, str], share: float) -> dict[str, Skew]:
    """For each named key column, the share of rows without a key and the keys that more
    than ``share`` of the rows have. At most ``1 / share`` keys of a column can qualify,
    and these lead all counts, so that many rows reach the driver at most. One pass with
    map-side combine: the rows are counted while their keys are."""
    # a pair without a name for each row counts the rows; its count leads all others
    pairs = [F.struct(F.lit(n).alias("name"), k.cast("string").alias("key"))
             for n, k in [*((n, F.col(c)) for n, c in keys.items()), (None, F.lit(None))]]
    counts = (rows.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")
              .groupBy("name", "key").agg(F.count(F.lit(1)).alias("n")))
    bound = min(len(keys) * (math.ceil(1 / share) + 1) + 1, (1 << 31) - 1)
    top = counts.orderBy(F.desc("n")).limit(bound).collect()
    total = max((r["n"] for r in top if r["name"] is None), default=1)
    # keyless rows of a column are one of its counts: few enough to be missed they are no matter
    return {n: Skew(sum(r["n"] for r in top if r["name"] == n and r["key"] is None) / total,
                    {r["key"]: r["n"] / total for r in top
                     if r["name"] == n and r["key"] is not None and r["n"] > share * total}) for n in keys}


def null_share(rows: DataFrame, column: str) -> float:
    """Share of rows without a value."""
    found = rows.agg(F.avg(F.col(column).isNull().cast("int")).alias("s")).first()["s"]
    return found or 0.0


def left_join_skewed(left: DataFrame, left_key: Column, rights: list[tuple[DataFrame, str]],
                     seed_cols: list[str], skew: Skew, bypass_share: float = 1.0) -> DataFrame:
    """``left LEFT JOIN r1 ON key = r1.k1 LEFT JOIN r2 ON key = r2.k2 ...`` as shuffle
    joins whose left key is often NULL or, for a few keys, hot.

    NULL keys match nothing. If their share is at least ``bypass_share`` (and there are
    any), their rows go round the shuffle: the left side is read in two branches, one
    joined and one that only gets the right sides' columns. Else they are spread like hot
    keys. A hot key's rows get a bucket number, and the right sides' rows of the key are
    copied into each of its buckets, so that each left row still meets every partner once.
    A key has as many buckets as follow from its share and the number of shuffle
    partitions, so that none is much larger than others whatever the size. All right
    sides join on the same (key, bucket) pair, so the left side is shuffled once for all of
    them; runtime skew handling cannot split such chained joins, the buckets do.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bypass = 0 < bypass_share <= skew.nulls
    classes = skew.buckets(partitions, bypass)
    seed = F.xxhash64(*[F.col(c) for c in seed_cols])

    def bucket_count(key: Column) -> Column:
        """NULL for ordinary keys."""
        found = F.lit(None).cast("bigint")
        for n, keys in classes.items():
            found = F.when(key.cast("string").isin(keys), F.lit(n).cast("bigint")).otherwise(found)
        return found

    out = left.withColumn(_KEY, left_key)
    if bypass:
        keyless, out = out.where(F.col(_KEY).isNull()), out.where(F.col(_KEY).isNotNull())
    count = bucket_count(F.col(_KEY))
    if not bypass:
        spread = max(math.ceil(BUCKETS_A_PARTITION * partitions * max(skew.nulls, 1 / partitions)), 1)
        count = F.when(F.col(_KEY).isNull(), F.lit(spread).cast("bigint")).otherwise(count)
    bucket = F.coalesce(F.pmod(seed, count) + 1, F.lit(0).cast("bigint"))
    # (key, bucket) travel as one struct column: a literal bucket on the right
    # side must not be folded into a filter, or the shuffle would be keyed by
    # the raw key again and every NULL would land in one partition
    out = out.withColumn(_BUCKET, F.struct(F.col(_KEY).alias("k"), bucket.alias("b")))
    for i, (right, key_name) in enumerate(rights):
        rb = f"{_BUCKET}_{i}"
        r = right.where(F.col(key_name).isNotNull())
        r_bucket = F.lit(0).cast("bigint")
        if classes:
            copies = F.sequence(F.lit(1).cast("bigint"), bucket_count(F.col(key_name)))
            r = r.withColumn("_b", F.explode(F.coalesce(copies, F.array(F.lit(0).cast("bigint")))))
            r_bucket = F.col("_b")
        r = r.withColumn(rb, F.struct(F.col(key_name).alias("k"), r_bucket.alias("b")))
        if classes:
            r = r.drop("_b")
        out = out.join(r, out[_BUCKET] == r[rb], "left").drop(rb)
    out = out.drop(_KEY, _BUCKET)
    if not bypass:
        return out
    blank = {f.name: F.lit(None).cast(f.dataType) for right, _ in rights for f in right.schema.fields}
    return out.unionByName(keyless.drop(_KEY).withColumns(blank))
