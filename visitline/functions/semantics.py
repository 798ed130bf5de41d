"""Column-level building blocks for the visit-date rules.

The source rules were written for in-memory data frames with R missing-value
semantics. The helpers below give those semantics to Spark expressions:

* group statistics are computed with ``groupBy`` (partial aggregation on the
  map side, so one huge subject or visit never lands whole in one task) and
  attached back to the rows with an equi-join that AQE can split when a key
  is skewed;
* aggregates that R makes missing when any input is missing ("poisoned");
* ``n_distinct`` that counts a missing value as a value;
* joins that match missing keys with missing keys;
* right-closed binning with R-style labels;
* "first row of a group" under an explicit order, as an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RIGHT = "__r_"


def n_rows() -> Column:
    """``count(*)``."""
    return F.count(F.lit(1))


def poisoned(agg: Column, col: str | Column) -> Column:
    """``agg`` if no value of ``col`` in the group is missing, else NULL.

    R's ``max``/``min``/``median`` return NA as soon as one input is NA;
    Spark's skip NULLs. ``count(col) = count(*)`` restores R's rule.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.count(c) == n_rows(), agg)


def n_distinct_na(col: str | Column) -> Column:
    """Distinct values in a group, a missing value counting as one value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.count_distinct(c) + F.when(F.count(c) < n_rows(), F.lit(1)).otherwise(F.lit(0))


def nulls_last_key(*cols: str | Column) -> list[Column]:
    """Fields for a struct that sorts ascending with NULLs last, per column."""
    out: list[Column] = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.extend([col.isNull(), col])
    return out


def sort_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """``keys`` with the numbers and dates before the texts, each in the order given.

    Sorts compare the first key of two rows in place and fetch the rows only where it is equal: a subject number
    tells most rows apart, a study name hardly any. Groups and matches are the same in any order of their keys.
    """
    text = {name for name, kind in df.select(*keys).dtypes if kind == "string"}
    return [k for k in keys if k not in text] + [k for k in keys if k in text]


def key_condition(keys: Sequence[str], nullable: Iterable[str] = (), prefix: str = _RIGHT) -> Column:
    """Equality on ``keys`` between ``k`` and ``prefix + k``; ``<=>`` for nullable keys."""
    nullable = set(nullable)
    cond = None
    for k in keys:
        left, right = F.col(k), F.col(prefix + k)
        term = left.eqNullSafe(right) if k in nullable else left == right
        cond = term if cond is None else cond & term
    return cond


def join_on_keys(
    df: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    nullable: Iterable[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Join ``other`` to ``df`` on same-named ``keys`` and keep one copy of them.

    Keys listed in ``nullable`` match NULL with NULL (R's join default);
    Spark plans ``<=>`` as an ordinary hash/sort-merge key.
    """
    renamed = other.withColumnsRenamed({k: _RIGHT + k for k in keys})
    joined = df.join(renamed, key_condition(sort_keys(df, keys), nullable), how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    return joined.drop(*[_RIGHT + k for k in keys])


def own_shuffle(small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give the small side of a join its own shuffle on the join ``keys``.

    A per-subject table built by an aggregate (or a join) on the same keys is
    already partitioned by them, so Spark joins it to the rows without
    shuffling it. AQE then cannot split a skewed partition of the rows: its
    skew handling needs a shuffle on both sides. Shuffling the small side
    (one row per key) restores that, and a hot subject's rows are split over
    several tasks.
    """
    return small.repartition(*sort_keys(small, keys))


def several_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ``keys`` that more than one row has."""
    return df.groupBy(*sort_keys(df, keys)).agg(n_rows().alias("__rows")).where(F.col("__rows") > 1).drop("__rows")


def keep_group_extreme(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    which: str,
    nullable: Iterable[str] = (),
) -> DataFrame:
    """Rows whose ``col`` equals the group max (or min); ties are all kept."""
    agg = F.max(col) if which == "max" else F.min(col)
    stats = df.groupBy(*sort_keys(df, keys)).agg(agg.alias("__extreme"))
    out = join_on_keys(df, stats, keys, nullable, "inner")
    return out.where(F.col(col) == F.col("__extreme")).drop("__extreme")


def first_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    payload: Sequence[str],
) -> DataFrame:
    """One row per group: the smallest ``order`` (then ``payload``) wins.

    A column named in ``order`` sorts ascending with NULLs last and is carried once, also if it is in ``payload``.

    Implemented as ``min(struct(order..., payload...))``: an ordinary
    aggregate with map-side partial aggregation, so a hot group is reduced
    before it is shuffled instead of being sorted in one task.
    """
    fields: list[Column] = []
    for i, o in enumerate(order):
        fields += [F.col(o).isNull().alias(f"__o{i}"), F.col(o).alias(o)] if isinstance(o, str) else [o.alias(f"__o{i}")]
    fields += [F.col(p).alias(p) for p in payload if p not in [o for o in order if isinstance(o, str)]]
    best = df.groupBy(*sort_keys(df, keys)).agg(F.min(F.struct(*fields)).alias("__best"))
    return best.select(*keys, *[F.col("__best")[p].alias(p) for p in payload])


def r_cut_labels(breaks: Sequence[float]) -> list[str]:
    """Interval labels as R's ``cut(x, breaks)`` prints them (``dig.lab = 3``).

    R formats each break with three significant digits (``formatC(.., digits=3)``,
    i.e. C's ``%.3g``): 1000 prints as ``1e+03``.
    """
    fmt = ["%.3g" % b for b in breaks]
    return [f"({lo},{hi}]" for lo, hi in zip(fmt[:-1], fmt[1:])]


def cut_right(col: str | Column, breaks: Sequence[float]) -> Column:
    """Right-closed bins ``(b[i], b[i+1]]``; values outside give NULL (R's NA bin)."""
    c = F.col(col) if isinstance(col, str) else col
    labels = r_cut_labels(breaks)
    expr = None
    for lo, hi, label in zip(breaks[:-1], breaks[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def cut_rank(col: str | Column, breaks: Sequence[float]) -> Column:
    """1-based bin number for ``cut_right`` (NULL outside), for sorting labels."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, (lo, hi) in enumerate(zip(breaks[:-1], breaks[1:]), start=1):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def r_number_text(col: str | Column) -> Column:
    """``as.character`` of an R double: whole numbers print without ``.0``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def r_text_na(col: str | Column) -> Column:
    """``paste(x)``: a missing value becomes the text ``NA``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("NA"))


def day_number(col: str | Column) -> Column:
    """Days since 1970-01-01 as DOUBLE (R's numeric value of a Date)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_date(c).cast("double")


def day_to_date(col: str | Column) -> Column:
    """DATE shown for a possibly fractional day number (R prints the floor)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_from_unix_date(F.floor(c).cast("int"))


def joined_list(entries: Column, value: str, sep: str = ", ") -> Column:
    """Text of the ``value`` field of ``entries`` (array of structs), in struct order.

    Build the structs with the sort fields first: ``array_sort`` compares
    structs field by field.
    """
    return F.array_join(F.transform(F.array_sort(entries), lambda x: x[value]), sep)
