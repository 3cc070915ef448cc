"""Point-in-time key lookup: the version of a dimension row that was valid on
a fact's date.

A join on the key with the dates as a filter would compare every line with
every version of its key.  Here time is cut into buckets: a version stands in
each bucket that its validity meets, a line in its date's.  Lines meet
versions by an equality join on key and bucket, so a line is compared with
the versions of its key in one bucket, and a hot key is spread over buckets;
what is still skewed adaptive execution splits.  The buckets are as wide as
a version lasts on average (measured, within the facts' dates), so the
versions take at most three rows each on average, however long some last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_asof_bucket"


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def lookup_asof(fact: DataFrame, versions: DataFrame, fact_keys, fact_date: str, keys, out: dict,
                from_col: str = "effective_date", to_col: str = "ineffective_date", how: str = "inner") -> DataFrame:
    """``fact`` with columns ``out`` (version column -> new name) of the version
    whose validity, ``from_col`` to ``to_col`` (both included; a NULL end is
    open), holds ``fact_date``.

    A late line gets the version of its own date, closed or not.  Without one
    (no version of the key then, or a NULL key or date) ``how="inner"`` drops
    the line and ``"left"`` keeps it with NULLs.  Versions of one key must not
    overlap (see ``overlapping_versions``); a version without a start is never
    valid."""
    fact_keys, keys = _as_list(fact_keys), _as_list(keys)
    date = F.to_date(F.col(fact_date))
    span = fact.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).first()
    v = versions.select(*[F.col(k).alias(f"_v_{i}") for i, k in enumerate(keys)], F.to_date(from_col).alias("_from"),
                        F.to_date(to_col).alias("_to"), *[F.col(c).alias(f"_o_{n}") for c, n in out.items()])
    lo, hi = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    # only what overlaps the facts' dates, cut to them
    v = (v.filter("_from IS NOT NULL").withColumn("_from", F.greatest("_from", lo)).withColumn("_to", F.least(F.coalesce("_to", hi), hi))
         .filter("_from <= _to"))
    n, days = v.agg(F.count("*"), F.coalesce(F.sum(F.datediff("_to", "_from") + 1), F.lit(0))).first()
    width = max(1, -(-days // max(1, n)))

    def bucket(c):
        return F.floor(F.datediff(c, lo) / width)

    spread = v.withColumn(_BUCKET, F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_to")))))
    dated = fact.withColumn("_asof_date", date).withColumn(_BUCKET, bucket(F.col("_asof_date")))
    on = [F.col(f"f.{a}") == F.col(f"v._v_{i}") for i, a in enumerate(fact_keys)]
    on += [F.col(f"f.{_BUCKET}") == F.col(f"v.{_BUCKET}"),
           (F.col("f._asof_date") >= F.col("v._from")) & (F.col("f._asof_date") <= F.col("v._to"))]
    return dated.alias("f").join(spread.alias("v"), on, how).select(
        *[F.col(f"f.`{c}`") for c in fact.columns], *[F.col(f"v._o_{n}").alias(n) for n in out.values()])


def overlapping_versions(versions: DataFrame, keys, from_col: str = "effective_date",
                         to_col: str = "ineffective_date") -> DataFrame:
    """Audit: versions that begin before the one before them has ended."""
    keys = _as_list(keys)
    order = Window.partitionBy(*keys).orderBy(from_col, F.col(to_col).asc_nulls_last())
    far = F.lit("9999-12-31").cast("date")
    last = F.max(F.coalesce(F.to_date(to_col), far)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return versions.filter(F.col(from_col).isNotNull()).withColumn("_last", last).filter(F.to_date(from_col) <= F.col("_last")).drop("_last")
