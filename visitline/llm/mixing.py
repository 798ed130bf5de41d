"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size (words). Together the targets share the
total size by weight, but none is above ``max_epochs`` times its source's size:
such sources are clamped there and the excess is shared again by weight among the
rest, until no source is above its cap.

A source's target is met by whole repetitions of all its documents and one
fractional repetition: the documents whose place, a seeded hash of id and text, is
before a cut, chosen so that their words come nearest to what is left of the target.
Equal rows share a place; at the cut as many of them are taken as come nearest. The cut
is found on histograms of the place's first digits, each level inside the bucket where
the one before crossed, so a source with a third of all rows is only ever aggregated,
never sorted in one task, whether its rows have ids of their own, one id or none.

Edge cases: a null or empty text has size 0 and is repeated like the others of its
source; a null source is a source of its own, after all others; rows of one repeated or
null doc_id are taken one by one (of equal rows at the cut, any: their id, source and size
are the same); an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitline.llm.common import as_rows, global_rank, is_empty, stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
SEED = 17
#: How many first hexadecimal digits of the place a level looks at; the last one sees it whole.
DIGITS = (3, 6, 32)


def n_words(text: Column) -> Column:
    """Words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def place(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A document's seeded place, 32 hexadecimal digits, the same in every run and engine."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(F.md5(text), F.lit("-")))
    return F.md5(key)


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, cycle: int = 3) -> DataFrame:
    """``(source, source_size, weight, target)`` from rows ``(source, size)``.

    Sources in code-point order (null last) weigh 1, 2, ..., ``cycle``, repeating.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = global_rank(sums, [F.col("source").asc_nulls_last()])
    weighed = stored(ranked.withColumn("weight", F.pmod("rank", F.lit(cycle)).cast("long") + 1).drop("rank"))
    cap = F.lit(max_epochs).cast("long") * F.col("source_size")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, free, clamped = total, None, F.lit(False)
    # Each round only looks at sums over sources; clamped sources stay clamped, as the level only rises.
    while True:
        row = weighed.agg(
            F.sum(F.when(~clamped, F.col("weight"))).alias("free"),
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0)).alias("fixed"),
            F.sum(clamped.cast("long")).alias("n"),
        ).first()
        if not row["free"] or (free is not None and row["n"] == count):
            break
        free, left, count = row["free"], total - row["fixed"], row["n"]
        big = "decimal(38,0)"
        clamped = cap.cast(big) * F.lit(free).cast(big) <= F.lit(left).cast(big) * F.col("weight").cast(big)
    level = (F.lit(left).cast("long") * F.col("weight")).cast("double") / F.lit(float(free or 1))
    return weighed.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(level))


def _crossing(sized: DataFrame, found: DataFrame, known: int, digits: int) -> DataFrame:
    """``found`` one level deeper: for each source the first ``digits`` of a place (``_at``) at which its words pass ``part``.

    Only rows in the bucket of ``known`` digits that the level before found are looked at; ``_before`` are the words
    before the new bucket, ``_words`` and ``_n`` its words and rows.
    """
    of_source = F.col("source").eqNullSafe(F.col("_s"))
    if known:
        bucket = found.select("_s", "_at")
        sized = sized.join(bucket, of_source & (F.substring("place", 1, known) == F.col("_at"))).drop("_s", "_at")
    sums = sized.groupBy("source", F.substring("place", 1, digits).alias("_begins")).agg(
        F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_n")
    )
    sums = sums.join(found.select("_s", "_before", "part"), of_source)
    upto = F.col("_before") + F.sum("_words").over(Window.partitionBy("_s").orderBy("_begins"))
    sums = sums.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_words"))
    sums = sums.where((F.col("_before") < F.col("part")) & (F.col("part") <= F.col("_upto")))
    return stored(sums.select("_s", F.col("_begins").alias("_at"), "_before", "part", "_words", "_n"))


def repetition_plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, source_size, target, whole, cut, at_cut, equal)`` from rows ``(source, size, place)`` and their targets.

    Each document of the source is taken ``whole`` times, and once more if its place is before ``cut``, or is the cut
    and it is among the first ``at_cut`` of the ``equal`` rows there.
    """
    plan = targets.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("part", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double"))
    found = plan.where("part > 0").select(F.col("source").alias("_s"), F.lit(0).cast("long").alias("_before"), "part")
    for known, digits in zip((0, *DIGITS), DIGITS, strict=False):
        found = _crossing(sized, found, known, digits)
    at_cut = F.ceil((F.col("part") - F.col("_before")) / (F.col("_words") / F.col("_n")) - 0.5).cast("long")
    cuts = found.select("_s", F.col("_at").alias("cut"), at_cut.alias("at_cut"), F.col("_n").alias("equal"))
    out = plan.join(cuts, plan["source"].eqNullSafe(cuts["_s"]), "left")
    return stored(out.select("source", "source_size", "target", F.col("whole").cast("long").alias("whole"), "cut", "at_cut", "equal"))


def mix_plan(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``(sized, plan)``: one light row per document, written once, and the plan of each source."""
    at = place(docs["doc_id"], docs["text"], seed)
    sized = stored(docs.select("doc_id", "source", n_words(docs["text"]).alias("size"), at.alias("place")))
    return sized, repetition_plan(sized, source_targets(sized, max_epochs))


def with_copies(df: DataFrame, plan: DataFrame, source: Column, place: Column) -> DataFrame:
    """``df`` with its source's plan and ``copies``, how often the mix takes the row."""
    p = plan.withColumnRenamed("source", "of_source")
    joined = df.withColumn("_place", place).join(p, source.eqNullSafe(F.col("of_source")), "left")
    at, cut = F.col("_place"), F.col("cut")
    more = F.coalesce((at < cut) | ((at == cut) & (F.col("at_cut") >= F.col("equal"))), F.lit(False))
    whole = joined.withColumn("copies", F.col("whole") + more.cast("long"))
    if is_empty(plan.where("at_cut > 0 and at_cut < equal")):
        return whole
    # Some of the equal rows at a cut are taken: these rows alone are numbered.
    among = F.coalesce((at == cut) & (F.col("at_cut") > 0) & (F.col("at_cut") < F.col("equal")), F.lit(False))
    equal = stored(whole.where(among).withColumn("_row", F.monotonically_increasing_id()))
    ranked = global_rank(equal, [F.col("of_source").asc_nulls_last(), F.col("_row")], "_nth")
    first = ranked.groupBy(F.col("of_source").alias("_s")).agg(F.min("_nth").alias("_first"))
    chosen = (F.col("_nth") - F.col("_first") < F.col("at_cut")).cast("long")
    numbered = ranked.join(first, F.col("of_source").eqNullSafe(F.col("_s"))).withColumn("copies", F.col("whole") + chosen)
    return whole.where(~among).unionByName(numbered.select(whole.columns))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, with the columns of ``docs``."""
    _, plan = mix_plan(docs, max_epochs, seed)
    rows = as_rows(docs)
    taken = with_copies(rows, plan, F.col("row.source"), place(F.col("row.doc_id"), F.col("row.text"), seed)).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def mix_report(docs: DataFrame) -> DataFrame:
    """The registered result: one row per document with its size, its source's figures and the words taken."""
    sized, plan = mix_plan(docs)
    taken = with_copies(sized, plan, sized["source"], sized["place"]).withColumn("taken", F.col("copies") * F.col("size"))
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken")


MIX_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('17:' || coalesce(doc_id::varchar, 'null') || ':' || coalesce(md5(text), '-')) as place
  from {documents}
), numbered as (
  select *, row_number() over (partition by source, place) as nth from sized
), sums as (
  select source, sum(size)::bigint as source_size, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight
  from sized group by source
), ratio as (
  select *, sum(source_size) over () as total,
         sum(weight) over (order by 3.0 * source_size / weight, source nulls last rows between current row and unbounded following) as free,
         coalesce(sum(3 * source_size) over (order by 3.0 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as fixed
  from sums
), capped as (
  select *, 3 * source_size * free <= (total - fixed) * weight as clamped from ratio
), level as (
  select coalesce(any_value(total), 0) - coalesce(sum(3 * source_size) filter (clamped), 0) as rest, sum(weight) filter (not clamped) as open_weight from capped
), targets as (
  select source, source_size,
         case when clamped then (3 * source_size)::double else (rest * weight)::bigint::double / open_weight::double end as target
  from capped, level
), plan as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from targets
), parts as (
  select *, target - (whole * source_size)::double as part from plan
), steps as (
  select source, place, sum(size) as words, count(*) as n, sum(sum(size)) over (partition by source order by place) as upto
  from sized group by source, place
), cuts as (
  select p.source, t.place as cut, ceil((p.part - (t.upto - t.words)) / (t.words / t.n) - 0.5) as at_cut
  from parts p join steps t on p.source is not distinct from t.source and t.upto - t.words < p.part and p.part <= t.upto
  where p.part > 0
)
select s.doc_id, s.source, s.size, p.source_size, p.target,
       ((p.whole + case when s.place < c.cut or (s.place = c.cut and s.nth <= c.at_cut) then 1 else 0 end) * s.size)::bigint as taken
from numbered s join parts p on s.source is not distinct from p.source left join cuts c on s.source is not distinct from c.source
"""
