"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated up to
three times. A document's virtual finish time is the number of its source's
words up to its end, divided by the source's weight. All queue entries are
range-partitioned by finish time, and the mix is what finishes before the
total budget is used up. Only DataFrame functions are used.

A source whose target would be above ``MOST_REPEATS`` times its size ends its
queue early; the others go on, and the cut falls later: the same shares as
resharing the excess by weight until no target is above.

Defined cases: a null text has no words; a null source is a source of its own,
after all others; null ids and repeated rows are documents like any other
(equal rows are told apart by their place in the table that the operator
writes, and get equal or interchangeable results); without any word all
targets and takings are 0; an empty table gives an empty table; extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import read, saved
from strata.llm.ranking import numbered, range_partitioned, running_totals

#: weights of the sources in their order, repeating
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
_WORDS = r"[^\x20\x09-\x0D]+"
_EXACT = "decimal(38,0)"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> tuple[DataFrame, int]:
    """Targets of ``sizes(source, source_size)`` and the total budget.

    Adds ``pos`` (place of the source by code point, null last), ``weight``
    and ``target``. Each round of resharing is one aggregation over the table
    of sources, of which the driver reads two numbers."""
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = numbered(sizes, [F.col("source").asc_nulls_last()], "mix-sources")
    placed = saved(placed.withColumn("weight", F.get(cycle, (F.col("pos") % len(weights)).cast("int"))), "mix-weights")
    size, weight = F.col("source_size").cast(_EXACT), F.col("weight").cast(_EXACT)
    total = int(placed.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0])
    words, shares = total, int(placed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0])
    while True:
        above = weight * F.lit(words).cast(_EXACT) > size * F.lit(most_repeats * shares).cast(_EXACT)
        capped, left = placed.agg(F.sum(F.when(above, size * most_repeats)), F.sum(F.when(~above, weight))).first()
        if left is None:  # no source, or every one at its cap
            break
        again = (total - int(capped or 0), int(left))
        if again == (words, shares):
            break
        words, shares = again
    fair = (weight * F.lit(words).cast(_EXACT)).cast("double") / F.lit(float(max(shares, 1)))
    return placed.withColumn("target", F.when(above, (size * most_repeats).cast("double")).otherwise(fair)), total


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document, and
    ``repeats``, the number of times that the mix takes it."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit(""))))
    base = saved(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(_WORDS)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"), F.monotonically_increasing_id().alias("row")), "mix-docs")
    targets, total = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_repeats)
    of_source = targets.withColumnRenamed("source", "_source")
    known = base.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    queue = saved(running_totals(known, "pos", ["key", "row"], "size", "mix-queues", "ahead"), "mix-queue")

    def finish(n):
        return (F.col("ahead") + n * F.col("source_size")).cast("double") / F.col("weight")

    entries = queue.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(most_repeats - 1)))).select(
        finish(F.col("n")).alias("finish"), "pos", "key", "row", "n", "size")
    cut = _cut(range_partitioned(entries, [F.col(c) for c in _ORDER], "mix-entries"), total)
    if cut is None:
        repeats = F.lit(most_repeats)
    else:
        last = F.struct(*[F.lit(cut[c]).alias(c) for c in _ORDER])
        repeats = sum((F.struct(finish(F.lit(n)).alias("finish"), "pos", "key", "row", F.lit(n).alias("n")) <= last).cast("int")
                      for n in range(most_repeats))
    return queue.withColumn("repeats", repeats).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"), "repeats")


_ORDER = ["finish", "pos", "key", "row", "n"]


def _cut(entries: DataFrame, budget: int):
    """The last entry within the budget; None if all are. Only the range in
    which the budget ends is put in order, and the driver reads its number,
    the words before it, and the one entry."""
    from pyspark.sql import Window

    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    ranges = (entries.groupBy("part").agg(F.sum("size").alias("size"))
              .withColumn("upto", F.sum("size").over(upto)))  # one row for each range
    edge = ranges.where(F.col("upto") > budget).orderBy("part").first()
    if edge is None:
        return None
    inside = Window.partitionBy("part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    here = (entries.where(F.col("part") == edge["part"]).withColumn("upto", F.sum("size").over(inside) + F.lit(edge["upto"] - edge["size"]))
            .where(F.col("upto") <= budget))
    before = entries.where(F.col("part") < edge["part"])
    last = here.select(*_ORDER).agg(F.max(F.struct(*_ORDER)).alias("e")).first()["e"]
    if last is None:
        last = before.agg(F.max(F.struct(*_ORDER)).alias("e")).first()["e"]
    return last if last is not None else {"finish": -1.0, "pos": -1, "key": "", "row": -1, "n": -1}


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
with base as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '-') || ':' || coalesce(text, '')) as key
  from documents),
sources as (
  select source, sum(size)::hugeint as source_size,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::hugeint as weight,
         row_number() over (order by source nulls last) as pos
  from base group by source),
-- in the order of size to weight, a source is at its cap if its fair share of what is left is above the cap
filled as (
  select *, sum(source_size) over () as total, sum(weight) over () as shares,
         coalesce(sum(3 * source_size) over w, 0) as caps_before, coalesce(sum(weight) over w, 0) as shares_before
  from sources
  window w as (order by source_size / weight::double, pos rows between unbounded preceding and 1 preceding)),
capped as (
  select *, weight * (total - caps_before) > 3 * source_size * (shares - shares_before) as above from filled),
fair as (
  select coalesce(sum(3 * source_size) filter (where above), 0) as caps, sum(weight) filter (where not above) as shares from capped),
targets as (
  select c.source, c.source_size::bigint as source_size, c.weight, c.pos, c.total,
         case when above then (3 * c.source_size)::double else (c.weight * (c.total - f.caps))::double / f.shares::double end as target
  from capped c, fair f),
queue as (
  select b.doc_id, b.size, t.source_size, t.weight, t.pos, t.target, t.total, b.key,
         row_number() over (order by b.key) as row
  from base b join targets t on b.source is not distinct from t.source),
ahead as (select *, sum(size) over (partition by pos order by key, row rows unbounded preceding) as ahead from queue),
entries as (
  select a.row, a.size, a.total, (a.ahead + n * a.source_size)::double / a.weight::double as finish, a.pos, a.key, n
  from ahead a, (values (0), (1), (2)) as r(n)),
taken as (
  select row, sum(size) filter (where upto <= total) as taken, count(*) filter (where upto <= total) as repeats
  from (select *, sum(size) over (order by finish, pos, key, row, n rows unbounded preceding) as upto from entries)
  group by row)
select a.doc_id, a.size, a.source_size, a.target, coalesce(t.taken, 0)::bigint as taken, t.repeats::int as repeats
from ahead a join taken t using (row)
"""
