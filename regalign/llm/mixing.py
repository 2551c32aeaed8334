"""Mixing sources to target token weights by bounded entropy balancing (DataFrame operations only).

Every document gets a rate w in (0, 2).  Among all rates that give each source its target number of
words, the bounded entropy  sum w ln w + (2 - w) ln(2 - w)  is least for the exponential tilt
w / (2 - w) = exp(lambda_s * x), x the document's size in units of its source's mean.  The dual is
convex and separates by source; Newton steps on lambda run for all sources at once, each step one
aggregate over the (source, size) histogram.  Rates are rounded to copies with a per-source
threshold on a hash, found by two histogram searches, and the last few words are filled with single
documents that fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regalign.llm.common import attach, keyed, materialize, scan, word_count
from regalign.operators.ranking import row_number_global

WEIGHTS = (5, 2, 1)
SHARE = 1.5          # of all words
MAX_COPIES = 2       # times a source's, and a document's, words
BINS = 1024          # of one search pass; two passes tell 2**20 hash levels apart
LAMBDA_LIMIT = 700.0
#: Sums of doubles depend on the order of addition; sums of these decimals don't, so reruns agree.
_EXACT = "decimal(30,6)"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, n_docs, weight, target) for every source, null included.

    Sources in code-point order (null last) take the weights in turn and share ``share`` of all
    words by weight; a target above ``most`` times the source's words stops there and the rest is
    shared again among the others, until none is above.  The loop runs at most once per distinct
    cap and passes only two sums to the driver per turn.
    """
    per = materialize(sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "sources")
    ranked = row_number_global(per, [F.col("source").isNull(), F.col("source").asc_nulls_last()], "rank")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                        (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = materialize(ranked.withColumn("weight", turn).withColumn(
        "cap", F.lit(most) * F.col("source_size")), "weights")
    amount = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:  # words per unit of weight; it only rises, so a capped source stays capped
        capped = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= F.col("cap")
        got = table.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0)).alias("cap"),
                        F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weight")).first()
        if not got["weight"]:
            break
        now = (amount - got["cap"]) / got["weight"]
        if level is not None and now <= level:
            break
        level = now
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level or 0.0)))
    return table.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def _rate(size: Column, tilt: Column, mean: Column) -> Column:
    """2 * logistic(lambda * size / mean); the limit on the exponent keeps exp() finite."""
    z = F.least(F.greatest(tilt * size / mean, F.lit(-LAMBDA_LIMIT)), F.lit(LAMBDA_LIMIT))
    return F.lit(float(MAX_COPIES)) / (F.lit(1.0) + F.exp(-z))


def tilts(sizes: DataFrame, targets: DataFrame, n_sources: int, rounds: int = 60, tolerance: float = 1e-7) -> DataFrame:
    """(source, source_size, target, mean, tilt) for every source: the dual solution, by safeguarded Newton steps.

    A step that leaves the bracket of the root is replaced by its midpoint.  Sources at their cap,
    without words or without target need no tilt (null).  One row per source is carried from round
    to round in a written table, through the aggregate itself; the driver sees only whether a
    source is still open.
    """
    grid = materialize(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    open_ = (F.col("target") > 0) & (F.col("target") < F.lit(MAX_COPIES) * F.col("source_size"))
    start = F.log(F.col("target") / (F.lit(MAX_COPIES) * F.col("source_size") - F.col("target")))
    fixed = ["source_size", "target", "mean"]
    state = materialize(targets.select(
        "source", "source_size", "target", F.when(open_, F.col("source_size") / F.col("n_docs")).alias("mean"),
        F.when(open_, F.round(start, 9)).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
        (~open_).alias("done")), "tilts")
    for _ in range(rounds):
        if state.where(~F.col("done")).isEmpty():
            break
        rows = attach(grid, state.where(~F.col("done")), ["source"], how="inner", rows=n_sources)
        w = _rate(F.col("size"), F.col("tilt"), F.col("mean"))
        slope = w * (F.lit(1.0) - w / F.lit(float(MAX_COPIES))) * F.col("size") * F.col("size") / F.col("mean")
        step = rows.groupBy("source").agg(
            *[F.first(c).alias(c) for c in (*fixed, "tilt", "low", "high")],
            F.sum((w * F.col("size") * F.col("n")).cast(_EXACT)).cast("double").alias("got"),
            F.sum((slope * F.col("n")).cast(_EXACT)).cast("double").alias("slope"))
        miss = F.col("got") - F.col("target")
        low = F.when(miss < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        step = step.withColumn("low", low).withColumn("high", high)
        newton = F.col("tilt") - F.try_divide(miss, F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        # doubling outwards while a side of the bracket is still open
        middle = F.when(F.col("high") >= 1e6, F.col("low") + F.abs("low") + 1.0).when(
            F.col("low") <= -1e6, F.col("high") - F.abs("high") - 1.0).otherwise((F.col("low") + F.col("high")) / 2)
        near = F.abs(miss) <= F.lit(tolerance) * F.col("target")
        tight = F.col("high") - F.col("low") <= 1e-9
        done = near | tight
        step = step.select(
            "source", *fixed,
            F.when(done, F.col("tilt")).otherwise(F.round(F.when(inside, newton).otherwise(middle), 9)).alias("tilt"),
            "low", "high", done.alias("done"))
        state = materialize(step.unionByName(state.where("done")), "tilts")
    return state.select("source", *fixed, "tilt")


class Mix:
    """The decisions of a mix as one small table (a row per source), applied to any frame of ``sizes_of``.

    Every decision adds columns to that table, through the aggregate that makes it, so a pass over
    the documents meets one small table however many decisions came before.  ``has`` counts the
    words a source has so far; it is kept by adding, not by another pass.
    """

    def __init__(self, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE):
        targets = source_targets(sizes, weights, share)
        self.n = targets.count()  # rows of the table, at most
        self.state = tilts(sizes, targets, self.n)
        self.cuts = self.fills = 0
        # rows equal in id, source, size and text draw by their row key, all others by that hash alone
        self.repeats = materialize(sizes.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
            "_h", F.lit(True).alias("_again")), "repeats")
        self.n_repeats = self.repeats.count()
        rows = materialize(self._rated(sizes).select(
            "_f", "_r", "source", "size", "target", "source_size", "mean", "tilt", "rate", "whole", "level", "bin"), "rates")
        whole = rows.groupBy("source").agg(*self._carried(), F.sum(F.col("whole") * F.col("size")).alias("has"))
        self.state = materialize(whole, "whole")
        rows = rows.drop("target", "source_size", "mean", "tilt")
        for _ in range(2):  # then once more among the documents that still fit
            self._round_up(rows)
        for _ in range(2):
            self._fill(rows)

    def _carried(self) -> list[Column]:
        """The table's columns, equal in all rows of a source, through an aggregate by source."""
        return [F.first(c).alias(c) for c in self.state.columns if c != "source"]

    def _attach(self, rows: DataFrame) -> DataFrame:
        return attach(rows, self.state, ["source"], rows=self.n)

    def _rated(self, rows: DataFrame) -> DataFrame:
        """``rows`` and the table, with the rate, its whole part, and the place in the order of rounding up."""
        rows = self._attach(rows)
        # a source at its cap has no tilt: all its documents go twice
        rate = F.when(F.col("target") <= 0, F.lit(0.0)).when(F.col("tilt").isNull(), F.lit(float(MAX_COPIES))).otherwise(
            _rate(F.col("size"), F.col("tilt"), F.col("mean")))
        levels = BINS * BINS
        rows = attach(rows, self.repeats, ["_h"], rows=self.n_repeats)
        own = [F.when(F.col("_again"), F.col(c)) for c in ("_f", "_r")]
        draw = F.pmod(F.xxhash64("_h", *own, F.lit(71)), F.lit(levels)) / F.lit(float(levels))
        rows = rows.withColumn("rate", rate).withColumn("whole", F.floor("rate"))
        # draw - fraction lies in (-1, 1)
        level = F.floor((draw - (F.col("rate") - F.col("whole")) + 1.0) / 2.0 * F.lit(levels)).cast("int")
        return rows.withColumn("level", level).withColumn("bin", F.shiftright("level", 10))

    def _copied(self, rows: DataFrame) -> DataFrame:
        """Rated rows and the table, with ``up`` and ``copies``."""
        up = F.lit(False)
        for k in range(self.cuts):
            cut_bin, cut_level = F.col(f"bin{k}"), F.col(f"level{k}")
            # no cut: the source never passes its target, so all that fits rounds up
            below = cut_bin.isNull() | (F.col("bin") < cut_bin) | (
                (F.col("bin") == cut_bin) & F.coalesce(F.col("level") < cut_level, F.lit(True)))
            up = up | (_fits(F.col(f"limit{k}")) & below)
        rows = rows.withColumn("up", up).withColumn(
            "copies", (F.col("whole") + F.when(F.col("up"), 1).otherwise(0)).cast("int"))
        for k in range(self.fills):
            more = (F.col("_f") == F.col(f"f{k}")) & (F.col("_r") == F.col(f"r{k}")) & (F.col("copies") < MAX_COPIES)
            rows = rows.withColumn("copies", F.col("copies") + F.when(more, 1).otherwise(0))
        return rows

    def _lacking(self) -> Column:
        """The words a source still lacks (null: less than one)."""
        lack = F.col("target") - F.col("has")
        return F.when(lack >= 1, lack)

    def _round_up(self, rows: DataFrame) -> None:
        """Round documents up in the order of their levels until the next one that fits would pass the target.

        Two passes find the place: the bin in which the words pass the target, then the level inside.
        """
        k = self.cuts
        self.state = self.state.withColumn(f"limit{k}", self._lacking())
        limit = F.col(f"limit{k}")
        left = ~F.col("up") & _fits(limit)
        bins = self._cut(self._copied(self._attach(rows)), "bin", left, limit, f"bin{k}", "at")
        self.state = materialize(bins, "bins")
        inside = left & (F.col("bin") == F.col(f"bin{k}"))
        levels = self._cut(self._copied(self._attach(rows)), "level", inside, limit - F.col("at"), f"level{k}", "more")
        self.state = materialize(levels.withColumn("has", F.col("has") + F.col("at") + F.col("more")).drop("at", "more"), "levels")
        self.cuts += 1

    def _cut(self, rows: DataFrame, by: str, among: Column, need: Column, place: str, before: str) -> DataFrame:
        """The table with the first value of ``by`` whose words, added in order, would pass the need (null: none
        does), and the words before it.  Only the rows of ``among`` count."""
        sums = rows.groupBy("source", F.when(among, F.col(by)).alias("_by")).agg(
            *self._carried(), F.sum(F.when(among, F.col("size"))).alias("_words"))
        order = Window.partitionBy("source").orderBy("_by").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows a source
        sums = sums.withColumn("_before", F.coalesce(F.sum("_words").over(order), F.lit(0)))
        over = F.col("_before") + F.col("_words") > need  # and so have all places after it
        return sums.groupBy("source").agg(
            *self._carried(), F.min(F.when(over, F.col("_by"))).alias(place),
            F.coalesce(F.min(F.when(over, F.col("_before"))), F.sum("_words"), F.lit(0)).alias(before))

    def _fill(self, rows: DataFrame) -> None:
        """One more copy of the source's largest document that still fits and has a copy left (lowest level first)."""
        k, need = self.fills, self._lacking()
        fits = self._copied(self._attach(rows)).where(
            (F.col("copies") < MAX_COPIES) & (F.col("size") > 0) & (F.col("size") <= need))
        best = fits.groupBy("source").agg(F.max(F.struct("size", (-F.col("level")).alias("order"), "_f", "_r")).alias("x"))
        best = attach(self.state, best, ["source"], rows=self.n)
        self.state = materialize(best.withColumn("has", F.col("has") + F.coalesce("x.size", F.lit(0))).withColumns(
            {f"f{k}": F.col("x._f"), f"r{k}": F.col("x._r")}).drop("x"), "fill")
        self.fills += 1

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, source, size, ...) with source_size, target, rate, copies and taken."""
        out = self._copied(self._rated(rows)).withColumn("taken", F.col("copies") * F.col("size"))
        own = [c for c in rows.columns if c not in ("_f", "_r", "_h")]
        return out.select(*own, "source_size", "target", "rate", "copies", "taken")


def _fits(limit: Column) -> Column:
    """Whether a document that isn't a whole number of copies may be rounded up within ``limit`` words."""
    return (F.col("rate") > F.col("whole")) & (F.col("whole") < MAX_COPIES) & (F.col("size") > 0) & (F.col("size") <= limit)


def sizes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *more) -> DataFrame:
    """(doc_id, source, size, _h, more..., _f, _r) of every row of a ``scan``; ``size`` counts words (null text: 0)."""
    names = [F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
             word_count(F.col(text_col)).alias("size")]
    same = F.xxhash64(F.col(id_col).cast("long"), F.col(source_col).cast("string"), word_count(F.col(text_col)), F.col(text_col))
    return keyed(docs, [*names, same.alias("_h"), *more])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) for every row of ``docs`` (doc_id, text, source).

    ``copies`` is 0, 1 or 2 and ``taken`` = copies * size.  Null sources are a source of their own.
    A source without words has target 0.  Which documents round up depends on a hash of id, source,
    size and text, among rows equal in all four also on the row key, so each row is drawn on its
    own; reruns over the same files agree.  Null and empty texts
    have size 0.  An empty table gives no rows; other columns of ``docs`` are not read.
    """
    sizes = materialize(sizes_of(scan(docs)), "sizes")
    return Mix(sizes, weights, share).apply(sizes)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all their columns and then ``copy`` (1, 2)."""
    docs = scan(docs)
    plan = Mix(materialize(sizes_of(docs), "sizes"), weights, share)
    rows = sizes_of(docs, "doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = plan.apply(rows).where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    name = "copy" if "copy" not in docs.columns else "_copy"
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns], F.col("_copy").alias(name))
