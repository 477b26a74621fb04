"""One portable hash for splits, folds, samples, bootstrap and synthetic rows."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(key: Column | str, seed: object) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of md5('key|seed')."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws("|", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def unit_hash_sql(key: str, seed: object) -> str:
    """The same double in DuckDB."""
    return f"(cast('0x'||left(md5(concat_ws('|', cast({key} as varchar), '{seed}')),8) as bigint)/4294967296.0)"


def poisson_one(u: Column, most: int = 12) -> Column:
    """Poisson(1) count for a uniform ``u``; the tail above ``most`` is below 1e-9."""
    cdf, term = [], 0.36787944117144233
    total = 0.0
    for i in range(most):
        total += term
        cdf.append(total)
        term /= i + 1
    return reduce(lambda acc, c: acc + (u >= F.lit(c)).cast("int"), cdf, F.lit(0))


def poisson_hex(digits: Column, most: int = 12) -> Column:
    """``poisson_one`` of the :func:`unit_hash` that begins with these hex digits, by comparing digits: small counts,
    which are the frequent ones, first."""
    cdf, term, total = [], 0.36787944117144233, 0.0
    for i in range(most):
        total += term
        cdf.append(f"{math.ceil(total * 4294967296):08x}")
        term /= i + 1
    out = F.when(digits < cdf[0], F.lit(0).cast("byte"))
    for i, bound in enumerate(cdf[1:], 1):
        out = out.when(digits < bound, F.lit(i).cast("byte"))
    return out.otherwise(F.lit(most).cast("byte"))
