"""Operator 1: mixing sources to target weights by weighted fair queueing.

Each source is a queue of shuffled documents, ``passes`` times over.  A document's virtual finish
time is the source's cumulative words up to its end divided by the source's target, so at virtual
time 1 every source has sent exactly its target; a document that goes across that time is sent in
two parts.  All queues run to their ends; what they send is range-sorted globally by virtual finish
time and cut where the running total reaches the budget, which is what ends each source's share.

Defined cases: a null text has no words; a null source is a source of its own, ranked last;
rows equal in (doc_id, source, text) form one queue item of that many copies and share what is
taken evenly; an empty table gives an empty mix; columns besides doc_id, source and text are
ignored here.  Documents without words are never taken (size 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.base import packed, running_total, text_key, written

#: One step of the shuffle order: rows per (source, step) stay near this many.
ROWS_PER_STEP = 4_000
WORD = r"[^\x20\x09-\x0D]+"


def words_of(column: str = "text") -> Column:
    """Number of whitespace-separated words; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(column: str = "source") -> Column:
    """Never-null key of a source that keeps the null source apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def targets(sources: DataFrame, share: float, weights: tuple[float, ...], passes: int) -> DataFrame:
    """Add ``target`` to written ``sources`` (source, source_key, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times
    all words.  A target stops at ``passes`` times its source's size; the excess is shared again
    by weight until no target is above.  Each round is one aggregate with a one-row result.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = running_total(sources.withColumn("one", F.lit(1)), order, "one", "rank", "mix-ranks")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (ranked.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(float(passes)))
              .select("source_key", "source_size", "weight", "cap"))
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, settled = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("cap") < F.col("weight") * level
        row = ranked.agg(F.sum(F.when(capped, F.col("cap"))).alias("cap"),
                         F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
                         F.count_if(capped).alias("n")).first()
        if row["n"] == settled or row["weight"] is None:
            break
        settled = row["n"]
        level = (budget - (row["cap"] or 0.0)) / row["weight"]
    if level is None:
        return ranked.withColumn("target", F.lit(0.0))
    return ranked.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.lit(level)))


def mix(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3.0, 1.0, 2.0),
        passes: int = 2, seed: int = 17) -> DataFrame:
    """Per distinct (doc_id, source, text): how many words of it the mix takes, and where.

    Returns doc_id, source, source_key, text_key, copies (equal rows), size (words of one copy),
    source_size, target, served (words taken over all copies and passes) and position (words of
    the mix before its first pass; null if nothing is taken).  The document that its source's
    target ends in is served in part.
    """
    items = written(
        docs.select("doc_id", "source", source_key().alias("source_key"), text_key().alias("text_key"),
                    words_of().alias("size"))
        .groupBy("doc_id", "source", "source_key", "text_key", "size")
        .agg(F.count(F.lit(1)).alias("copies")), "mix-items")
    sources = written(items.groupBy("source", "source_key")
                      .agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), "mix-sources")
    goals = written(targets(sources, share, weights, passes), "mix-targets")
    steps = max(1, -(-items.count() // ROWS_PER_STEP))

    # shuffled queue: (pass, step, hash) orders a source's rows; a step is a slice of the hash,
    # so the queue of a source that holds most rows is still cut into small groups
    queue = (items.filter(F.col("size") > 0)
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
             .withColumn("hash", F.xxhash64(F.lit(seed), "pass", "doc_id", "text_key"))
             .withColumn("step", F.col("pass") * steps
                         + F.shiftright(F.shiftrightunsigned("hash", 33) * F.lit(steps), 31))
             .withColumn("words", F.col("size") * F.col("copies")))
    sums = queue.groupBy("source_key", "step").agg(F.sum("words").alias("_words"))
    earlier = Window.partitionBy("source_key").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.withColumn("_offset", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
               .drop("_words").join(goals.select("source_key", F.floor("target").alias("goal")), "source_key"))
    inside = (Window.partitionBy("source_key", "step").orderBy("hash", "doc_id", "text_key")
              .rowsBetween(Window.unboundedPreceding, -1))
    timely = F.greatest(F.lit(0), F.least(F.col("words"), F.col("goal") - F.col("start")))
    parts = F.array(F.struct(timely.alias("words"), (F.col("start") + timely).alias("end")),
                    F.struct((F.col("words") - timely).alias("words"), (F.col("start") + F.col("words")).alias("end")))
    sent = (queue.join(offsets, ["source_key", "step"])
            .withColumn("start", F.col("_offset") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
            .withColumn("part", F.explode(parts)).filter("part.words > 0")
            .withColumn("finish", F.when(F.col("goal") > 0, F.col("part.end") / F.col("goal"))
                        .otherwise(F.lit(float("inf"))))
            .select("doc_id", "source_key", "text_key", "pass", F.col("part.words").alias("words"), "finish"))
    budget = goals.agg(F.sum(F.floor("target"))).first()[0] or 0
    sent = truncated(sent, budget)
    taken = (sent.groupBy(F.col("doc_id").alias("_id"), F.col("source_key").alias("_source"),
                          F.col("text_key").alias("_text"))
             .agg(F.sum("words").alias("served"), F.min("before").alias("position")))
    same = (F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("source_key") == F.col("_source"))
            & (F.col("text_key") == F.col("_text")))
    return (items.join(taken, same, "left").drop("_id", "_source", "_text")
            .join(goals.select("source_key", "source_size", "target"), "source_key")
            .withColumn("served", F.coalesce("served", F.lit(0)).cast("long")))


def truncated(sent: DataFrame, budget: int) -> DataFrame:
    """What the queues ``sent`` (words, finish and the row's keys), in order of virtual finish time, up
    to ``budget`` words; the last one in part.  ``before`` is the running total."""
    order = [F.col("finish"), F.col("source_key"), F.col("pass"), F.col("doc_id"), F.col("text_key")]
    return (running_total(written(sent, "mix-sent"), order, "words", "before", "mix-order")
            .filter(F.col("before") < budget)
            .withColumn("words", F.least(F.col("words"), F.lit(budget) - F.col("before"))))


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: rows of ``docs``, each as many times as its passes are taken.

    A pass that the mix serves in part is kept whole if at least half of it is served, so
    documents stay whole.  All columns of ``docs`` are kept; the order is that of the input.
    """
    times = F.round(F.col("served") / (F.col("size") * F.col("copies"))).cast("int")
    plan = mix(docs, **parameters).filter("served > 0").select("doc_id", "source_key", "text_key", times.alias("times"))
    rows = packed(docs).select("row", text_key("row.text").alias("text"), source_key("row.source").alias("source"))
    same = (F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("source") == F.col("source_key"))
            & (F.col("text") == F.col("text_key")))
    taken = rows.join(plan.filter("times > 0").hint("shuffle_hash"), same)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def op1(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (and source, position)."""
    rows = mix(docs, **parameters).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    share = F.floor(F.col("served") / F.col("copies")) + F.when(
        F.col("copy") <= F.col("served") % F.col("copies"), 1).otherwise(0)
    return rows.select("doc_id", "size", "source_size", "target", share.cast("long").alias("taken"),
                       "source", F.col("position").alias("position"))
