"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue; its documents wait in an order shuffled by a keyed hash, once and again for each pass over the source. A
document's virtual finish time is the cumulative words of its queue up to and with it, divided by the queue's target. All documents
of all queues are range-sorted by it, and the mix is what comes first, cut off where the total budget is used up.
The budget is the sum of the targets, each in whole words, so it ends at time 1; the document that a queue is serving then is
preempted: its words up to the target finish at time 1, the others are a piece of their own that finishes later.

No queue is ever sorted in one task, nor all of them. Words are first summed for each (source, hash bin), the running sums over
the bins are taken on that small table, and only the rows of one bin are ordered together; a source with a third of all rows is spread over a
third of all bins. The range sort is by bins of virtual time, even ones up to time 1 and even ones of its logarithm after it: all queues are served
at an even rate, so no bin has more than its share of the words, and running totals over the bins come from a small table in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, WORD, pieces, shared_folder, written

#: Input to one task of the range sort, of which only ids and sizes travel, and bins of virtual time to one such task.
TASK_MB, BINS_A_TASK = 2_000.0, 4


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): size is the number of words; a null text has none."""
    size = F.coalesce(F.regexp_count(docs["text"].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), size.alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, passes: int = 2) -> DataFrame:
    """(source, source_size, weight, target): one row a source, also for the null source, which comes last.

    The budget is ``share`` times all words. Each source gets a part by its weight, at most ``passes`` times its own
    words; what is above is shared again among the others. The level reached is found in closed form: with sources
    in order of cap / weight, those before the first whose cap / weight is at least the level are full. From
    there on the level only falls, so it is the greatest of such.
    The windows here run over one row a source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * passes)
    per = per.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumn("left_over", F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    per = per.withColumn("level", F.col("left_over") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return per.select("source", "source_size", "weight", target.alias("target"))


def queued(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, passes: int = 2, seed: str = "mix") -> DataFrame:
    """The queues: (doc_id, source, size, source_size, target, bin, nth, pass, words, finish, late), one row for each pass of each document, two where it is
    preempted at time 1, of which the later is ``late``. (source, bin, nth) tells a document from all others, repeated rows included."""
    sized = written(sizes(docs), f"{shared_folder(docs.sparkSession)}/sized")  # the texts are read once
    bins = max(1, pieces(docs, 1.0))
    goal = targets(sized, weights, share, passes)
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("string"), F.lit(seed)))
    rows = sized.withColumn("key", key).withColumn("bin", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * bins / F.lit(2**32)).cast("int"))
    summed = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    queue = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ahead = summed.select(F.col("source").alias("s"), F.col("bin").alias("b"), F.coalesce(F.sum("words").over(queue), F.lit(0)).alias("ahead"))
    ahead = ahead.join(goal.withColumnRenamed("source", "s2"), F.col("s").eqNullSafe(F.col("s2"))).drop("s2")
    inner = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size")
    rows = rows.withColumn("upto", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("nth", F.row_number().over(inner))
    rows = rows.join(ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    rows = rows.withColumn("pass", F.explode(F.array(*map(F.lit, range(passes))))).withColumn("end", F.col("ahead") + F.col("upto") + F.col("source_size") * F.col("pass"))
    whole = F.floor("target").cast("long")
    in_time = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), whole - F.col("end") + F.col("size")))
    piece = lambda words, end, late: F.struct(words.alias("words"), F.when(F.col("target") > 0, end / F.col("target")).alias("finish"), late.alias("late"))
    first = F.when((in_time > 0) | (F.col("size") == 0), piece(in_time, F.least(F.col("end"), whole), F.lit(False)))
    rest = F.when(in_time < F.col("size"), piece(F.col("size") - in_time, F.col("end"), F.lit(True)))
    rows = rows.withColumn("piece", F.explode(F.filter(F.array(first, rest), lambda x: x.isNotNull())))
    return rows.select("doc_id", "source", "size", "source_size", "target", "bin", "nth", "pass", "piece.*")


def served(docs: DataFrame, **how) -> DataFrame:
    """The rows of queued() range-sorted by virtual finish time, with ``taken``: their words within the total budget."""
    n = pieces(docs, TASK_MB)
    bins = n * BINS_A_TASK
    waiting = written(queued(docs, **how), f"{shared_folder(docs.sparkSession)}/queued")
    late = bins + 1 + F.floor(F.log2("finish") * bins)
    anywhere = F.pmod(F.hash("bin", "nth"), F.lit(bins))  # documents without words move nothing
    waiting = waiting.withColumn("time", F.when(F.col("size") == 0, anywhere).when(F.col("late"), late).otherwise(F.floor(F.col("finish") * bins)).cast("int"))
    budget = waiting.select("source", F.floor("target").cast("long").alias("whole")).distinct().agg(F.sum("whole")).first()[0] or 0
    before = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    totals = waiting.groupBy("time").agg(F.sum("words").alias("words")).select(F.col("time").alias("t"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    line = Window.partitionBy("time").orderBy("finish", "late", "source", "pass", "bin", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = waiting.repartitionByRange(n, "time").withColumn("upto", F.sum("words").over(line))
    rows = rows.join(F.broadcast(totals), F.col("time") == F.col("t"))
    left = F.lit(budget) - F.col("before") - F.col("upto") + F.col("words")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), left)).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", "bin", "nth", "pass", "words", "finish", "late", taken.alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, passes: int = 2, seed: str = "mix") -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, finish, taken.

    ``taken`` has the words that the mix takes of the document over all passes, ``finish`` its virtual finish time on the first.
    Nulls: a null source is a source of its own; a null doc_id is a document, shuffled as the smallest id. Repeated rows
    are documents of their own. Sources without words have target 0 and no finish. An empty table gives no rows.
    """
    rows = served(docs, weights=weights, share=share, passes=passes, seed=seed)
    own = rows.groupBy("source", "bin", "nth").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.max(F.when(F.col("pass") == 0, F.col("finish"))).alias("finish"), F.sum("taken").alias("taken"),
    )
    return own.select("doc_id", "source", "size", "source_size", "target", "finish", "taken")


#: DuckDB SQL for the op9 query.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, source_size * 2 AS cap, source_size * 2 / weight AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5e0 - coalesce(sum(source_size * 2) OVER w, 0) AS left_over,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM per WINDOW w AS (ORDER BY source_size * 2 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), weight * coalesce(max(CASE WHEN ratio >= left_over / weight_left THEN left_over / weight_left END) OVER (), 'infinity'::DOUBLE)) AS target
  FROM lev),
served AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY p.pass, md5(d.doc_id || ':mix'), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d CROSS JOIN (VALUES (1), (2)) p(pass) JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(sum(greatest(0, least(size, floor(target) - upto + size))) AS BIGINT) AS taken
FROM served GROUP BY doc_id, size, source_size, target
"""
