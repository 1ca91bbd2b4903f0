r"""Mixing sources to target weights by Pareto order sampling.

A document's size is its number of words, runs of characters other than white space (0x20, 0x09-0x0D). The
sources, by code point and null last, weigh 5, 2, 1, 5, 2, 1 ... and share ``share`` times all words; no
source gets more than ``most`` times its own, and what that leaves over is shared by weight among the others.

A source whose target is t of its S words takes every document ``floor(t / S)`` times. Of the words that are
still wanted, R, a further copy of some documents is drawn without replacement:

* a document of s words is included with probability ``l = min(1, s * R' / sum(s * s))``, so that the
  drawn words are R on average; those of probability 1 are taken for certain, and R' is what they leave of R;
* the others are ranked by the odds of a uniform number over the odds of their inclusion,
  ``(u / (1 - u)) / (l / (1 - l))``, and the first of them are taken until R' words are reached.

The sample's size is fixed: a source's words are its target, rounded. The last document drawn may give only its
first words; one document a source at most does. Long documents, whose presence would move a total most, are thus
likelier than short ones, and the largest are certain.

u comes from a digest of id and text, so runs agree however the rows are divided. No source's rows are ranked in one
task: the ranks are cut to 48 bits, words are summed for ranges of 36, 24, 12 and 0 bits, and each time only the range in
which R' is reached is looked into. All is column expressions.

Rows: a null or empty text has no words and is not taken, a source of no words has target 0. Rows that are equal in id,
source and text are drawn one after another, like others. Null ids are ids like others. An empty table gives no rows.
Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.common import checked
from ratewright.operators.joins import small_side

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a rank, and of it those that one pass tells apart.
RANK_BITS, PASS_BITS = 48, 12
#: Copies that one row is expanded to at once.
_CHUNK = 4096


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, draw`` of every row: its words, and a random number of 48 bits."""
    text = F.coalesce("text", F.lit(""))
    seed = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("size"),
        F.conv(F.substring(F.md5(seed), 1, RANK_BITS // 4), 16, 10).cast("long").alias("draw"),
    )


def targets(by_size: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, rank, source_size, target`` from the number of rows of each source and size (source, size, rows).

    A source is at its bound if the level of words a weight, with all sources of a smaller bound a weight at theirs,
    is not below its own; these are the first in the order of bound a weight. One row a source passes through one task.
    """
    # Equal in every row, so that all sources are one group.
    whole = Window.partitionBy(F.lit(0))
    sources = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(whole.orderBy(F.asc_nulls_last("source"))))
    ranked = ranked.withColumn("weight", weight.cast("double")).withColumn("bound", F.col("source_size") * F.lit(float(most)))
    order = whole.orderBy(F.col("bound") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Whole numbers, so differences are exact; a frame to the end of all rows would be summed up again for each of them.
    after = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    levelled = ranked.withColumn("level", left / after)
    # The level at the first source that stays below its bound holds for all that follow.
    free = F.when(F.col("level") * F.col("weight") < F.col("bound"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return levelled.withColumn("level", level).select(
        "source", "rank", "source_size", F.coalesce(F.col("level") * F.col("weight"), F.col("bound")).alias("target")
    )


def _plan(by_size: DataFrame, goals: DataFrame) -> DataFrame:
    """By source: whole copies, the size from which a further copy is certain, and what is drawn of the smaller ones.

    ``wanted`` words are to be drawn from documents of fewer than ``certain`` words, whose squares sum up to ``squares``.
    """
    source = goals["source"].eqNullSafe(by_size["source"])
    rows = by_size.where("size > 0").join(goals, source).select(goals["source"], "rank", "source_size", "target", "size", "rows")
    copies = F.floor(F.col("target") / F.col("source_size"))
    rows = rows.withColumn("copies", copies).withColumn(
        "rest", F.floor(F.col("target") + 0.5).cast("long") - copies * F.col("source_size")
    )
    # Sizes from the largest on; as many rows as there are sizes.
    order = Window.partitionBy("rank").orderBy(F.desc("size"))
    words = (F.col("size") * F.col("rows")).cast("decimal(38,0)")
    larger = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.coalesce(F.sum(words).over(larger), F.lit(0))
    squared = words * F.col("size")
    squares = F.sum(squared).over(Window.partitionBy("rank")) - F.coalesce(F.sum(squared).over(larger), F.lit(0))
    rows = rows.withColumn("left", left.cast("long")).withColumn("squares", squares.cast("decimal(38,0)"))
    # A size of which a copy is not certain, once all larger ones are; the largest such size begins the draw.
    drawn = F.col("size").cast("decimal(38,0)") * F.col("left") < F.col("squares")
    begins = F.struct("size", "left", "squares")
    grouped = rows.groupBy("rank", "source", "source_size", "target", "copies").agg(F.max(F.when(drawn, begins)).alias("first"))
    return grouped.select(
        "rank", "source", "source_size", "target", "copies",
        (F.coalesce(F.col("first.size"), F.lit(0)) + 1).alias("certain"),
        F.coalesce(F.greatest(F.col("first.left"), F.lit(0)), F.lit(0)).cast("long").alias("wanted"),
        F.col("first.squares").cast("double").alias("squares"),
    )


def rank_of(draw, size, wanted, squares):
    """48 bits of ``q / (1 + q)``, which rises with the odds ratio q."""
    u = (draw.cast("double") + 0.5) / F.lit(float(1 << RANK_BITS))
    included = size.cast("double") * (wanted.cast("double") / squares)
    over, under = u * (1 - included), (1 - u) * included
    return F.floor(over / (over + under) * F.lit(float(1 << RANK_BITS))).cast("long")


def _reached(ranked: DataFrame) -> DataFrame:
    """By source: the rank at which the wanted words are reached (``at``), and the words of lower ranks (``before``)."""
    found = None
    for shift in range(RANK_BITS - PASS_BITS, -1, -PASS_BITS):
        rows = ranked
        if found is not None:
            above = found.select(F.col("source_rank").alias("_source"), "at", "before")
            rows = rows.join(small_side(above), (F.col("source_rank") == F.col("_source")) & (F.shiftright("place", shift + PASS_BITS) == F.col("at")))
        else:
            rows = rows.withColumn("before", F.lit(0).cast("long"))
        ranges = rows.groupBy("source_rank", F.shiftright("place", shift).alias("range")).agg(
            F.sum("size").alias("words"), F.first("wanted").alias("wanted"), F.first("before").alias("before")
        )
        # At most 4,096 ranges a source.
        order = Window.partitionBy("source_rank").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = ranges.withColumn("until", F.col("before") + F.sum("words").over(order))
        hit = F.when(F.col("until") >= F.col("wanted"), F.struct("range", (F.col("until") - F.col("words")).alias("before")))
        found = checked(
            running.groupBy("source_rank").agg(F.min(hit).alias("hit")).select("source_rank", F.col("hit.range").alias("at"), F.col("hit.before").alias("before")),
            "mixing-ranges",
        )
    return found


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, source, text).

    ``doc_id, source, size, source_size, target``, ``copies`` (whole ones), ``part`` (words of a further copy, less than
    ``size``), ``taken`` (words of both) and ``draw``, which with the id tells rows apart. ``most`` is 1 or more.
    """
    rows = checked(sized(docs), "mixing-sizes")
    by_size = checked(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("rows")), "mixing-counts")
    goals = checked(targets(by_size, weights, share, most), "mixing-targets")
    plan = checked(_plan(by_size, goals), "mixing-plan")

    named = goals.select(F.col("source").alias("_source"), F.col("rank").alias("source_rank"), "source_size", "target")
    inner = plan.select(F.col("rank").alias("source_rank"), F.col("copies").alias("all"), "certain", "wanted", "squares")
    each = checked(named.join(inner, "source_rank", "left"), "mixing-sources")
    placed = rows.join(small_side(each), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    drawn = (F.col("size") > 0) & (F.col("size") < F.col("certain")) & (F.col("wanted") > 0)
    place = F.when(drawn, rank_of(F.col("draw"), F.col("size"), F.col("wanted"), F.col("squares")))
    placed = placed.withColumn("place", place).drop("squares")
    reached = _reached(placed.where("place is not null").select("source_rank", "size", "wanted", "place"))
    ends = reached.select(F.col("source_rank").alias("_rank"), "at", "before")
    decided = placed.join(small_side(ends), F.col("source_rank") == F.col("_rank"), "left").drop("_rank")

    certain = (F.col("size") > 0) & (F.col("size") >= F.col("certain"))
    more = (certain | F.coalesce(F.col("place") < F.col("at"), F.lit(False))).cast("long")
    copies = F.when(F.col("size") > 0, F.col("all") + more).otherwise(0).cast("long").alias("copies")
    columns = ("doc_id", "source", "size", "draw", "source_size", "target")
    at_end = F.coalesce(F.col("place") == F.col("at"), F.lit(False))
    clear = decided.where(~at_end).select(*columns, copies, F.lit(0).cast("long").alias("part"))
    result = clear.unionByName(_last(decided.where(at_end), columns))
    return result.withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))


def _last(rows: DataFrame, columns: tuple) -> DataFrame:
    """Rows at the rank where the wanted words are reached: equal rows, but for chance.

    They are counted, not ranked; of each group of equal rows some are taken, one in part, and the others not.
    """
    groups = rows.groupBy("source_rank", "all", "wanted", "before", *columns).agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("source_rank").orderBy("draw", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    words = F.greatest(F.col("wanted") - F.col("before") - F.coalesce(F.sum(F.col("size") * F.col("rows")).over(order), F.lit(0)), F.lit(0))
    groups = groups.withColumn("words", F.least(words, F.col("size") * F.col("rows")))
    whole = F.floor(F.col("words") / F.col("size"))
    kinds = F.array(
        F.struct(whole.alias("times"), (F.col("all") + 1).alias("copies"), F.lit(0).cast("long").alias("part")),
        F.struct((F.col("words") % F.col("size") > 0).cast("long").alias("times"), F.col("all").alias("copies"), (F.col("words") % F.col("size")).alias("part")),
        F.struct((F.col("rows") - F.ceil(F.col("words") / F.col("size"))).alias("times"), F.col("all").alias("copies"), F.lit(0).cast("long").alias("part")),
    )
    some = groups.select(*columns, F.explode(kinds).alias("kind")).where("kind.times > 0")
    # A count becomes rows in two steps, so that no array has a member for each row.
    chunks = some.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("kind.times") - 1) / _CHUNK))).alias("chunk"))
    size = F.least(F.lit(_CHUNK), F.col("kind.times") - F.col("chunk") * _CHUNK)
    each = chunks.select("*", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return each.select(*columns, F.col("kind.copies").alias("copies"), F.col("kind.part").alias("part"))


def texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: ``doc_id, source, copy, text``, a row for each copy that is taken; a part is the text's beginning.

    Whole copies number from 0, the part comes after them.
    """
    text = F.coalesce("text", F.lit(""))
    seed = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    held = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text", F.conv(F.substring(F.md5(seed), 1, RANK_BITS // 4), 16, 10).cast("long").alias("draw"))
    wanted = mixed.where("taken > 0").groupBy("doc_id", "source", "draw").agg(F.sum("copies").alias("_copies"), F.max("part").alias("_part"))
    held = held.dropDuplicates(["doc_id", "source", "draw"])
    same = [held[c].eqNullSafe(wanted[c]) for c in ("doc_id", "source")] + [held["draw"] == wanted["draw"]]
    found = held.join(wanted, same[0] & same[1] & same[2]).select(held["doc_id"], held["source"], "text", "_copies", "_part")
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_part").cast("int"))
    whole = found.where("_copies > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("copy"), "text")
    part = found.where("_part > 0").select("doc_id", "source", F.col("_copies").alias("copy"), F.array_join(words, " ").alias("text"))
    return whole.unionByName(part)


def digests(mixed: DataFrame) -> DataFrame:
    """The columns by which a mix is compared."""
    return mixed.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken")
