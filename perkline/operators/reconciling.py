"""Which rows of two tables differ, at the cost of one pass and of what differs.

Rows are dealt into buckets by the hash of their key. A bucket's digest is the number of its rows and two
sums of row hashes; sums do not depend on order, are taken in the map tasks first, and those of small buckets
add up to those of large ones. So both sides are reduced to digests of small buckets in one pass each; the
large buckets are compared first, then the small ones inside those that differ. Keys are compared only
inside small buckets that differ: tables that agree cost two scans and nothing else, whatever their size.

Two sums of 64-bit hashes with different seeds tell rows apart, that is 128 bits for a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from perkline.operators.merging import copied

LARGE, SMALL = 256, 64  # large buckets, and small ones in each
DIGEST = ("n", "first_sum", "second_sum")


def _bucket(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), *keys), F.lit(count)).cast("int")


def _digest(columns: Sequence[str]) -> list[Column]:
    """Number of rows and the sums; NULLs and their places count."""
    flags = [F.col(c).isNull() for c in columns]
    return [
        F.count(F.lit(1)).alias("n"),
        *[
            F.sum(F.xxhash64(F.lit(seed), *columns, *flags).cast("decimal(20,0)")).alias(name)
            for seed, name in ((1, "first_sum"), (2, "second_sum"))
        ],
    ]


def bucket_digests(
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    large: int = LARGE,
    small: int = SMALL,
    by: Sequence[str] = (),
) -> DataFrame:
    """Digest of every small bucket: at most ``large * small`` rows (for each value of ``by``)."""
    bucket = _bucket(keys, large * small)
    dealt = rows.withColumns({"_large": F.floor(bucket / small).cast("int"), "_small": bucket})
    return dealt.groupBy(*by, "_large", "_small").agg(*_digest(columns or rows.columns))


def differing_buckets(source: DataFrame, target: DataFrame, level: Sequence[str]) -> DataFrame:
    """``level`` columns of digests that differ when summed up to this level, with the rows of both sides."""
    sides = []
    for side, sign in ((source, 1), (target, -1)):
        signed = [(F.sum(c) * sign).alias(c) for c in DIGEST]
        counts = [F.sum(F.col("n") * int(sign == s)).alias(name) for s, name in ((1, "source_rows"), (-1, "target_rows"))]
        sides.append(side.groupBy(*level).agg(*signed, *counts))
    both = sides[0].unionByName(sides[1]).groupBy(*level)
    summed = both.agg(*[F.sum(c).alias(c) for c in (*DIGEST, "source_rows", "target_rows")])
    return summed.filter(" OR ".join(f"{c} != 0" for c in DIGEST)).drop(*DIGEST)


def key_differences(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    large: int = LARGE,
    small: int = SMALL,
) -> DataFrame:
    """``(*keys, difference, source_rows, target_rows)`` of every key whose rows are not the same on both sides.

    ``difference`` is ``missing`` (in the target), ``extra`` (only there) or ``changed``. NULL is a key like
    others; a key on several rows is compared as a whole. ``target`` has the source's columns; its values are
    compared in the source's types.
    """
    columns = list(columns or source.columns)
    types = {f.name: f.dataType for f in source.schema.fields}
    target = target.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])
    source = source.select(*columns)
    digests = [copied(bucket_digests(side, keys, columns, large, small)) for side in (source, target)]

    first = differing_buckets(*digests, ["_large"]).select("_large")
    inside = [d.join(F.broadcast(first), "_large", "left_semi") for d in digests]  # at most ``large`` numbers
    wanted = sorted(r[0] for r in differing_buckets(*inside, ["_small"]).select("_small").collect())
    # At most ``large * small`` numbers; when most buckets differ, asking for them saves nothing.
    if 2 * len(wanted) > large * small:
        chosen = F.lit(True)
    else:
        chosen = F.array_contains(F.lit(wanted).cast("array<int>"), F.col("_small")) if wanted else F.lit(False)

    sides = []
    for side, sign in ((source, 1), (target, -1)):
        found = side.withColumn("_small", _bucket(keys, large * small)).filter(chosen)
        hashes = _digest(columns)
        per_key = found.groupBy(*keys).agg(*hashes)
        sides.append(
            per_key.select(
                *keys,
                *[(F.col(c) * sign).alias(c) for c in DIGEST],
                (F.col("n") * int(sign == 1)).alias("source_rows"),
                (F.col("n") * int(sign == -1)).alias("target_rows"),
            )
        )
    names = (*DIGEST, "source_rows", "target_rows")
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    difference = (
        F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    )
    different = both.filter(" OR ".join(f"{c} != 0" for c in DIGEST))
    return different.select(*keys, difference.alias("difference"), "source_rows", "target_rows")
