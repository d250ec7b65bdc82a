"""Running last non-null value per key, by windows over bounded chunks of a key.

Keys of ordinary size are one window each. A hot key is cut into chunks of about ``CHUNK`` rows at order values
drawn from a sample (whatever the values are, so chunks are balanced), and every chunk is a window of its own: no
task holds more than a chunk of one key. "Last non-null" is associative, so the state that enters a chunk is the last
non-null of the states that leave the earlier chunks of its key (one row a chunk). Rows of equal order are never cut
apart; they go by a hash of their columns. Null keys are one key. All of it stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Rows of one key that a window holds, about; sampled rows a chunk; most chunks of a key (its rows search their chunk).
CHUNK, SAMPLED, MOST_CHUNKS = 1 << 18, 64, 256
_TIE, _CHUNK, _CUTS, _IN = "_scan_tie", "_scan_chunk", "_scan_cuts", "_scan_in_"


def _cuts(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """For each hot key (its columns renamed), the order values at which a chunk begins. Written: a sample is drawn once."""
    share = min(1.0, SAMPLED / CHUNK)
    sample = df.select(*[F.col(k).alias(_IN + k) for k in keys], F.col(order).alias(_CUTS)).sample(share, seed=1)
    drawn = sample.groupBy(*[_IN + k for k in keys]).agg(F.array_sort(F.collect_list(_CUTS)).alias(_CUTS))
    each = F.greatest(F.lit(round(CHUNK * share)), F.ceil(F.size(_CUTS) / MOST_CHUNKS))
    cuts = F.array_distinct(F.filter(_CUTS, lambda _, i: (i + 1) % each == 0))
    return materialise(drawn.withColumn(_CUTS, cuts).filter(F.size(_CUTS) > 0), "scan-cuts")


def running_last(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """``df`` with each of ``columns`` replaced by its last non-null value of the row's key up to the row, in ``order``.

    A sample of the keys and orders is read when this is called.
    """
    names = df.columns
    cuts = _cuts(df, keys, order)
    hot = not cuts.isEmpty()
    df = df.withColumn(_TIE, F.xxhash64(*[c for c in names if c not in (*keys, order)]))
    if hot:
        of = [F.col(k).eqNullSafe(F.col(_IN + k)) for k in keys]
        begun = F.size(F.filter(_CUTS, lambda c: c <= F.col(order)))
        df = (df.join(F.broadcast(cuts), of, "left")
              .select(*names, _TIE, F.when(F.col(_CUTS).isNotNull(), begun).alias(_CHUNK)))
    own = [*keys, _CHUNK] if hot else keys
    upto = (Window.partitionBy(*own).orderBy(F.col(order).asc_nulls_first(), _TIE)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = df.select(*[F.last(c, ignorenulls=True).over(upto).alias(c) if c in columns else F.col(c) for c in names],
                        *([_CHUNK] if hot else []))
    if not hot:
        return carried
    place = F.struct(order, _TIE)
    left = df.filter(F.col(_CHUNK).isNotNull()).groupBy(*own).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns])
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    entries = left.select(*[F.col(k).alias(_IN + k) for k in own], *[F.last(c, ignorenulls=True).over(before).alias(_IN + c) for c in columns])
    of = [F.col(k).eqNullSafe(F.col(_IN + k)) for k in keys] + [F.col(_CHUNK) == F.col(_IN + _CHUNK)]
    return carried.join(F.broadcast(entries), of, "left").select(
        *[F.coalesce(F.col(c), F.col(_IN + c)).alias(c) if c in columns else F.col(c) for c in names])
