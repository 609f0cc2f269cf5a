"""Schema-reconciling union (N6, N8, N9, R4) and full-row dedupe.

The target schema is decided on the driver from the frames' schemas (metadata only): columns in
first-seen order; a column whose type differs between frames becomes text for good; a column a
frame lacks is a typed null there. Every frame is cast *before* the union, because Spark's own
union would widen long + double to double, and under ANSI would parse text into numbers and fail.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir


def target_schema(frames: Sequence[DataFrame]) -> list[tuple[str, T.DataType]]:
    """N6 rule: columns in order of first occurrence; a name with more than one type is text."""
    fields = [f for df in frames for f in df.schema.fields]
    kinds = {name: {f.dataType for f in fields if f.name == name}
             for name in dict.fromkeys(f.name for f in fields)}
    return [(name, min(types, key=str) if len(types) == 1 else T.StringType())
            for name, types in kinds.items()]


def plain_text(c: Column, dtype: T.DataType) -> Column:
    """A value as text. Numbers have no exponent and no empty fraction (``1.2345678E7`` and ``12345678``
    are both ``12345678``), so one number is one text whatever type a snapshot had given its column."""
    text = c.cast("string")
    if not isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return text
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    whole, frac, power = (F.regexp_extract(text, r"^-?([0-9]+)(?:\.([0-9]+))?(?:E(-?[0-9]+))?$", k) for k in (1, 2, 3))
    frac = F.regexp_replace(frac, "0+$", "")
    shift = F.when(power == "", F.lit(0)).otherwise(power.try_cast("int"))
    digits, point = F.concat(whole, frac), F.length(whole) + shift              # the point's place in the digits
    padded = F.rpad(F.concat(F.repeat(F.lit("0"), F.greatest(1 - point, F.lit(0))), digits),
                    F.greatest(point, F.length(digits) + F.greatest(1 - point, F.lit(0))), "0")
    at = F.greatest(point, F.lit(1))
    whole_number = F.substring(padded, F.lit(1), at)
    rest = F.regexp_replace(F.substr(padded, at + 1), "0+$", "")
    plain = F.concat(sign, F.regexp_replace(whole_number, "^0+(?=[0-9])", ""),
                     F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)))
    return F.when(whole == "", text).when(plain == "-0", F.lit("0")).otherwise(plain)           # NaN and Infinity as they are


def align(df: DataFrame, schema: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """Project one frame onto the target schema (N8 cast to text, N9 typed nulls). Columns are taken by
    position, so a name may hold any character."""
    have = {f.name: (i, f.dataType) for i, f in enumerate(df.schema.fields)}
    rows = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    cols = []
    for k, (name, dtype) in enumerate(schema):
        i, own = have.get(name, (None, None))
        c = F.lit(None).cast(dtype) if own is None else F.col(f"_{i}")
        cols.append((c if own in (None, dtype) else plain_text(c, own)).alias(f"c{k}"))
    return rows.select(*cols).toDF(*[name for name, _ in schema])


def reconcile_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with drifting schemas; row order of the inputs is kept."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    if len(frames) == 1:
        return frames[0]
    schema = target_schema(frames)
    return reduce(DataFrame.union, [align(f, schema) for f in frames])


def row_digest(df: DataFrame) -> list[Column]:
    """128 bits of a row as two longs; equal rows (null = null, NaN = NaN, -0.0 = 0.0) have equal digests."""
    cols = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        cols += [c + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c, c.isNull()]
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *reversed(cols))]


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (null equals null; no key exists, the row is the identity).

    Planned as a hash aggregate on all columns: duplicates collapse map-side before the shuffle,
    so even one row repeated across a third of the input ships once per task.
    """
    return df.distinct()


# Digests that more than one row has, at most so many are broadcast (about 32 MB).
REPEATED_DIGESTS = 1_000_000


def dedupe_by_digest(df: DataFrame, digest: Callable[[DataFrame], list[Column]] = row_digest,
                     max_repeated: int = REPEATED_DIGESTS) -> DataFrame:
    """N7 with the rows of :func:`dedupe`, for wide rows few of which repeat: only digests are shuffled to
    find out which occur twice (their number is checked before they are broadcast). A row whose digest
    occurs once is kept where it is; the others are compared in whole, so equal digests of different rows
    lose nothing. With more repeated digests than ``max_repeated`` it is :func:`dedupe`.

    ``df`` is read twice and must give the same rows each time."""
    names, two = df.columns, ["_d0", "_d1"]
    rows = df.select("*", *[d.alias(n) for d, n in zip(digest(df), two)])
    scratch_dir(df.sparkSession)
    repeated = rows.groupBy(*two).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*two).checkpoint(eager=True)
    if repeated.limit(max_repeated + 1).count() > max_repeated:
        return dedupe(df)
    known = F.broadcast(repeated)
    once = rows.join(known, two, "left_anti").drop(*two)
    return once.unionAll(rows.join(known, two, "left_semi").drop(*two).distinct()).toDF(*names)
