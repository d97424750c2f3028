"""Join shapes beyond a plain equi join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST_DAY, OPEN_END = "0001-01-01", "9999-12-31"


# Days of the bins of each length class; longer and open intervals share one bin of their key.
BINS = [4**k for k in range(7)]
_WHOLE, _MARK = -1, 0


def _bin_rows(rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each rule in the one or two bins it touches: bins are at least as long as the rule and at most four times so."""
    days = F.datediff("_to", "_from") + 1
    width = F.lit(_WHOLE)
    for bin_days in reversed(BINS):
        width = F.when(days <= bin_days, F.lit(bin_days)).otherwise(width)
    sized = rules.where(F.col("_from") <= F.col("_to")).withColumn("_width", width)
    first, last = (F.floor(F.unix_date(F.to_date(c)) / F.col("_width")).cast("int") for c in ("_from", "_to"))
    bins = F.when(F.col("_width") == _WHOLE, F.array(F.lit(0))).otherwise(F.sequence(first, last))
    return sized.withColumn("_bin", F.explode(bins)).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _bin_facts(facts: DataFrame, placed: DataFrame, at: str, mark: bool) -> DataFrame:
    """Each fact once for every class of bins that some rule is in; classes are read as a scalar subquery of seven values."""
    classes = placed.agg(F.array_sort(F.collect_set("_width"))).scalar()
    found = F.coalesce(classes, F.array().cast("array<int>"))
    if mark:
        found = F.array_union(found, F.array(F.lit(_MARK)))
    day = F.unix_date(F.to_date(at))
    bin_ = F.when(F.col("_width") == _WHOLE, 0).when(F.col("_width") == _MARK, F.when(F.col(at).isNotNull(), 0))
    return facts.withColumn("_width", F.explode(found)).withColumn("_bin", bin_.otherwise(F.floor(day / F.col("_width")).cast("int")))


def _uncovered(rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The intervals between, before and after the rules of each key: a sweep over them in the order of their start."""
    inside = Window.partitionBy(*keys).orderBy("_from", "_to")
    spans = rules.where(F.col("_from") <= F.col("_to")).select(*keys, "_from", "_to").distinct()
    reach = spans.withColumn("_reach", F.max("_to").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    before = reach.select(*keys, F.coalesce(F.date_add("_reach", 1), F.lit(FIRST_DAY).cast("date")).alias("_from"), F.date_sub("_from", 1).alias("_to"))
    after = spans.groupBy(*keys).agg(F.max("_to").alias("_to")).where(F.col("_to") < F.lit(OPEN_END).cast("date"))
    return before.unionByName(after.select(*keys, F.date_add("_to", 1).alias("_from"), F.lit(OPEN_END).cast("date").alias("_to")))


def validity_join(
    facts: DataFrame, rules: DataFrame, keys: Sequence[str], at: str,
    valid_from: str, valid_to: str, how: str = "inner",
) -> DataFrame:
    """Match facts to the rules valid at ``at`` (days, both ends included); a NULL end is open.

    Rules are sorted into bins by their length and facts meet them on key and bin, so the rows that are compared stay
    proportional to the facts and their matches however many rules a key has, and a hot key spreads over its bins.
    ``left`` keeps facts without a rule, also those with NULL keys or days: the gaps between a key's rules are
    swept once and joined as rules without values, so each fact still takes part in one join only.
    """
    extra = [c for c in rules.columns if c not in keys and c not in facts.columns]
    end = F.coalesce(F.col(valid_to).cast("date"), F.lit(OPEN_END).cast("date"))
    values = F.struct(*[F.col(c) for c in extra]) if extra else F.struct(F.lit(0).alias("_none"))
    spans = rules.select(*keys, values.alias("_rule"), F.to_date(valid_from).alias("_from"), end.alias("_to"))
    kind = spans.schema["_rule"].dataType
    if how == "left":
        gaps = _uncovered(spans, keys).withColumn("_rule", F.lit(None).cast(kind))
        spans = spans.unionByName(gaps.select(*spans.columns))
    placed = _bin_rows(spans, keys)
    probes = _bin_facts(facts, placed, at, how == "left").alias("f")
    if how == "left":
        known = spans.where(F.col("_from") <= F.col("_to")).select(*keys).distinct()
        marks = known.select(
            *keys, F.lit(None).cast(kind).alias("_rule"), F.lit(FIRST_DAY).cast("date").alias("_from"),
            F.lit(OPEN_END).cast("date").alias("_to"), F.lit(_MARK).alias("_width"), F.lit(0).alias("_bin"),
        )
        placed = placed.unionByName(marks.select(*placed.columns))
    r = placed.withColumn("_hit", F.lit(True)).alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"f.{k}") == F.col(f"r.{k}") for k in [*keys, "_width", "_bin"]])
    valid = F.to_date(F.col(f"f.{at}")).between(F.col("r._from"), F.col("r._to"))
    joined = probes.join(r, same & valid, how)
    if how == "left":
        # The extra row of each fact meets a mark if its key has rules at all; then one of its other rows has matched.
        joined = joined.where((F.col("f._width") == _MARK) != F.col("r._hit").isNotNull())
    return joined.select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"r._rule.{c}").alias(c) for c in extra])


def rate_join(
    facts: DataFrame, rates: DataFrame, keys: Sequence[str], at: str, valid_from: str, valid_to: str, how: str = "inner",
) -> DataFrame:
    """``validity_join`` for short lists: tariffs and factors, of which a key has a handful of periods.

    Every fact meets all periods of its key and dates are tested row by row, without bins and gaps to prepare.
    """
    f, r = facts.alias("f"), rates.alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"f.{k}") == F.col(f"r.{k}") for k in keys])
    valid = F.col(f"f.{at}").between(F.col(f"r.{valid_from}"), F.coalesce(F.col(f"r.{valid_to}"), F.lit(OPEN_END).cast("date")))
    extra = [c for c in rates.columns if c not in keys and c not in facts.columns]
    return f.join(r, same & valid, how).select("f.*", *[F.col(f"r.{c}") for c in extra])


def expand_days(intervals: DataFrame, start: Column, end: Column, name: str = "day") -> DataFrame:
    """One row per day of each interval, turning a range join into an equi join."""
    return intervals.where(start <= end).withColumn(name, F.explode(F.sequence(start, end)))


def default_join(
    facts: DataFrame, rules: DataFrame, key: str, default_key: str, value: str, name: str
) -> DataFrame:
    """Value of the row for ``key``, else of the row keyed ``default_key`` (read as a scalar subquery)."""
    specific = rules.select(F.col(key), F.col(value).alias("_specific"))
    fallback = rules.where(F.col(key) == default_key).agg(F.max(value)).scalar()
    return facts.join(specific, key, "left").withColumn(name, F.coalesce("_specific", fallback)).drop("_specific")


def outer_chain(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer combination of frames with disjoint measures, as one union and one shuffle."""
    measures = [(c, f.schema[c].dataType) for f in frames for c in f.columns if c != key]
    aligned = [
        f.select(key, *[F.col(c) if c in f.columns else F.lit(None).cast(t).alias(c) for c, t in measures])
        for f in frames
    ]
    union = reduce(DataFrame.unionByName, aligned)
    return union.groupBy(key).agg(*[F.max(c).alias(c) for c, _ in measures])


def not_in(left: DataFrame, value: Column, right: DataFrame, column: str) -> DataFrame:
    """Rows of ``left`` whose value is NOT IN a column, with SQL's rule for NULLs.

    Two counts of the right side decide about NULLs, so that the rest is an ordinary anti join on the value.
    """
    rows, known = right.agg(F.count("*")).scalar(), right.agg(F.count(column)).scalar()
    able = left.withColumn("_value", value).where((rows == 0) | (F.col("_value").isNotNull() & (rows == known)))
    return able.join(right.select(F.col(column).alias("_value")).distinct(), "_value", "left_anti").drop("_value")
