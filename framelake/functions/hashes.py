"""Column functions on perceptual and content hashes, and split keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def difference_hash(grid: Column, size: int) -> Column:
    """Bits of a row-major gray grid of size + 1 columns: 1 where a value is at least its right neighbour."""
    places = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda r: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda c: r * (size + 1) + c)))
    bits = F.transform(places, lambda p: F.when(F.get(grid, p) >= F.get(grid, p + 1), "1").otherwise("0"))
    return F.when(F.size(grid) >= size * (size + 1), F.array_join(bits, ""))


def bits_to_long(bits: Column) -> Column:
    """Up to 64 bits of 0/1 text as a long."""
    return F.conv(bits, 2, -10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two 0/1 texts; the shorter is padded with zeros on the left."""
    n = F.greatest(F.length(a), F.length(b))
    left, right = F.lpad(a, n, F.lit("0")), F.lpad(b, n, F.lit("0"))
    return F.size(F.filter(F.zip_with(F.split(left, ""), F.split(right, ""), lambda x, y: x != y), lambda d: d))


def hamming_long(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def content_hash(data: Column) -> Column:
    return F.sha2(data, 256)


def sample_hash(**parts: Column) -> Column:
    """sha256 of ``name: value`` parts joined by a bar, in the order given; doubles with six decimals by the caller."""
    return F.sha2(F.concat_ws("|", *[F.concat(F.lit(f"{k}:"), F.coalesce(v.cast("string"), F.lit(""))) for k, v in parts.items()]), 256)


def split_point(ident: Column, seed: str) -> Column:
    """First eight bytes of sha256("seed:id") as a share of 2^64."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident.cast("string")), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / float(2**64)


def assign_split(ident: Column, ratios: dict[str, float], seed: str) -> Column:
    """train, val or test by cumulative shares; a rounding tail goes to the first positive share."""
    total = sum(ratios.values())
    if total <= 0:
        raise ValueError("split ratios must sum to a positive number")
    point, upto, out = split_point(ident, seed), 0.0, None
    names = [n for n in ("train", "val", "test") if n in ratios]
    for name in names:
        upto += ratios[name] / total
        out = F.when(point < upto, name) if out is None else out.when(point < upto, name)
    return out.otherwise(next(n for n in names if ratios[n] > 0))
