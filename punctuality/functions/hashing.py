"""Row hashing for samples and splits that do not depend on the partitioning."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough that no fraction in use rounds to nothing.
BUCKETS = 1 << 60


def row_bucket(keys: Sequence[str], seed: int, portable: bool = False) -> Column:
    """A number in ``[0, BUCKETS)`` that depends on the key values and the seed only.

    ``portable`` uses MD5 over the key texts, which other SQL engines can reproduce;
    the default is Spark's cheaper 64-bit hash.
    """
    if portable:
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
        number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    else:
        number = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return F.pmod(number, F.lit(BUCKETS))
