"""Benchmark decontamination by template canonicalisation (DataFrame operations only).

Numbers, units and names become typed placeholders, so a question that was asked again with other
values keeps its template.  Windows of template words are hashed and joined with those of the
benchmark; the windows of a document and an item that lie on one diagonal are aligned, and their
slots must agree: in a stretch of windows one benchmark value stands for one document value.  Where
a slot contradicts an earlier one the stretch is cut, and what lies on either side still counts.

A window of hardly anything but placeholders proves nothing by its template, and a name is told by
its capital, which a copy may have lost.  So every window is also joined on its plain lower-cased
words, values kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regalign.llm.common import attach, keyed, materialize, scan, unpack, with_row_key

WINDOW = 5            # template words
COVERAGE = 0.8        # share of an item's windows that must be found in a document, or
RUN_WORDS = 13        # template words found in one unbroken stretch
LITERAL = 3           # words of a window that must not be placeholders for its template to count

# Unit words after a number.
UNITS = ["%", "$", "€", "£", "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "mile", "miles", "mg", "g", "kg",
         "lb", "lbs", "ounces", "oz", "ml", "l", "liter", "liters", "litre", "litres", "s", "sec", "seconds", "min",
         "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollars",
         "cents", "euros", "pounds", "percent", "degrees", "c", "f", "k", "w", "kw", "v", "hz", "khz", "mhz", "kb", "mb",
         "gb", "tb", "n", "j", "kj", "pa", "mol"]


def marked_words(text: Column) -> Column:
    """The words of a text, lower-cased and without punctuation, its slots as ``<num3p5>``, ``<unitkg>``, ``<namebob>``.

    A number is a run of digits with single ``. , : /`` between digits (written ``p``); a unit is a
    word of ``UNITS`` after a number; a name is a capitalised word with a small letter that does
    not start a text, line or sentence.  Null: no words.
    """
    units = "|".join(sorted((u if u.isalpha() else f"\\{u}" for u in UNITS), key=len, reverse=True))
    t = F.translate(F.coalesce(text, F.lit("")), "<>", "  ")
    t = F.regexp_replace(t, r"(?<=\p{Nd})[.,:/](?=\p{Nd})", "p")
    t = F.regexp_replace(t, r"(?<=[^.!?:\s]\s)\p{Lu}\p{L}*\p{Ll}\p{L}*", " <name$0> ")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}])\p{Nd}(?:p?\p{Nd})*+", " <num$0> ")
    t = F.lower(t)
    t = F.regexp_replace(t, rf"(<num[^>]*>)\s*({units})(?![\p{{L}}\p{{N}}])", "$1 <unit$2> ")
    # a symbol used as a unit is kept as its name, so that it stays one word
    for i, u in enumerate(u for u in UNITS if not u.isalpha()):
        t = F.replace(t, F.lit(f"<unit{u}>"), F.lit(f"<unitsign{i}>"))
    return F.filter(F.split(t, r"[^\p{L}\p{N}\p{M}<>]+"), lambda w: w != "")


def template(words: Column) -> Column:
    """``marked_words`` without the slots' values."""
    return F.transform(words, lambda w: F.when(w.startswith("<name"), "<name>").when(
        w.startswith("<num"), "<num>").when(w.startswith("<unit"), "<unit>").otherwise(w))


def plain(words: Column) -> Column:
    """``marked_words`` without the marks: the lower-cased words themselves."""
    return F.transform(words, lambda w: F.when(w.startswith("<num"), F.substr(w, F.lit(5), F.length(w) - 5)).when(
        w.startswith("<"), F.substr(w, F.lit(6), F.length(w) - 6)).otherwise(w))


def _whole(words: Column) -> Column:
    """The hash of a text of fewer words than a window has."""
    return F.xxhash64(F.lit("whole"), words)


def windows(df: DataFrame, n: int) -> DataFrame:
    """``df`` (with ``words``) exploded into its windows: ``pos`` and ``h``; ``words`` is dropped.

    Every window has the hash of its template, and one that holds a slot also that of its plain
    words (without a slot they are the same); a text of fewer than ``n`` words has one hash, of all
    its plain words.  The outer form of explode keeps the optimizer from testing the hashes' number
    in a filter below, which would work the words out again for every window.
    """
    size = F.size("tokens")
    last = size - F.lit(n - 1)
    made = F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(
        (i - 1).alias("pos"), F.xxhash64(F.slice("tokens", i, n)).alias("h")))
    slots = F.filter(F.transform("tokens", lambda w, i: F.when(w.startswith("<"), i + 1)), lambda p: p.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(slots, lambda p: F.sequence(F.greatest(F.lit(1), p - (n - 1)), F.least(p, last)))))
    also = F.transform(starts, lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(F.slice("plain", i, n)).alias("h")))
    whole = F.array(F.struct(F.lit(0).alias("pos"), _whole(F.col("plain")).alias("h")))
    rest = [c for c in df.columns if c != "words"]
    out = df.withColumn("tokens", template(F.col("words"))).withColumn("plain", plain(F.col("words"))).select(
        *rest, F.when(size >= n, F.concat(made, also)).when(size > 0, whole).alias("hashes"))
    return out.select(*rest, F.explode_outer("hashes").alias("x")).where(F.col("x").isNotNull()).select(*rest, "x.pos", "x.h")


def _grams(items: DataFrame, n: int) -> DataFrame:
    """(h, item, ipos, rich) of the benchmark's windows: plain words, and the template of ``rich`` windows,
    which have enough literal words for it to count."""
    texts = items.select("item", template(F.col("words")).alias("tokens"), plain(F.col("words")).alias("plain"))
    size = F.size("tokens")
    each = F.transform(F.sequence(F.lit(1), size - F.lit(n - 1)), lambda i: F.struct(
        (i - 1).alias("ipos"), F.xxhash64(F.slice("tokens", i, n)).alias("t"), F.xxhash64(F.slice("plain", i, n)).alias("p"),
        (F.size(F.filter(F.slice("tokens", i, n), lambda w: ~w.startswith("<"))) >= min(LITERAL, n)).alias("rich")))
    long = texts.where(size >= n).select("item", F.explode(each).alias("x")).select("item", "x.*")
    short = texts.where((size > 0) & (size < n)).select(
        _whole(F.col("plain")).alias("h"), "item", F.lit(0).alias("ipos"), F.lit(False).alias("rich"))
    return long.select(F.col("p").alias("h"), "item", "ipos", "rich").unionByName(
        long.where("rich").select(F.col("t").alias("h"), "item", "ipos", "rich")).distinct().unionByName(short)


def _identity(words: Column) -> Column:
    """What a word of an item stands for: itself, a number together with the unit after it."""
    return F.transform(words, lambda w, i: F.when(
        w.startswith("<num") & F.coalesce(F.get(words, i + 1).startswith("<unit"), F.lit(False)),
        F.concat(w, F.get(words, i + 1))).otherwise(w))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, coverage: float = COVERAGE,
                 run_words: int = RUN_WORDS) -> DataFrame:
    """(_f, _r, doc_id, item_id, item_windows, found, share, run, slots, changed) per document row and item it contains.

    ``found`` counts the item's windows that lie on a diagonal and agree in themselves, ``share`` is
    their part of the item's (of all, or of those rich in literal words, whichever is more), ``run``
    the template words of the longest unbroken stretch whose slots agree, ``slots`` the distinct slot
    values compared and ``changed`` those that differ (0: verbatim).  A row appears if share >=
    ``coverage`` or run >= ``run_words``.  Slots agree if no benchmark value stands for two document
    values; two benchmark values may become one.  A number is told apart by the unit after it.

    An item of fewer than ``n`` words is found where it is a document's whole text, whatever the
    case: inside longer texts a few words are no evidence.  Null and empty texts on either side have
    no window; repeated items each give their rows; repeated documents are told apart by their row
    key; null ids are carried along; an empty table on either side gives no rows; other columns are
    not read.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).select(
        "item_id", marked_words(F.col("text")).alias("words"))
    items = materialize(items.withColumn("item", F.monotonically_increasing_id()), "items")
    grams = materialize(_grams(items, n), "grams")
    total = grams.select("item", "ipos", "rich").distinct().groupBy("item").agg(
        F.count(F.lit(1)).alias("item_windows"), F.count_if("rich").alias("rich_windows"))

    texts = keyed(scan(docs), ["doc_id", "text"])
    hashed = windows(texts.select("_f", "_r", marked_words(F.col("text")).alias("words")), n)
    hits = attach(hashed, grams, ["h"], how="inner").select("_f", "_r", "pos", "item", "ipos", "rich")
    hits = materialize(hits.distinct(), "hits")
    # items that could still pass, before the texts are looked at again
    pair = ["_f", "_r", "item"]
    likely = hits.groupBy(*pair).agg(F.count_distinct("ipos").alias("found"),
                                     F.count_distinct(F.when(F.col("rich"), F.col("ipos"))).alias("found_rich"))
    likely = attach(likely, total, ["item"], how="inner")
    enough = (F.col("found") >= coverage * F.col("item_windows")) | (
        (F.col("rich_windows") > 0) & (F.col("found_rich") >= coverage * F.col("rich_windows"))) | (F.col("found") >= run_words - n + 1)
    likely = materialize(likely.where(enough).drop("found", "found_rich"), "likely")
    again = attach(texts, likely.select("_f", "_r").distinct(), ["_f", "_r"], how="inner", salts=1)
    again = materialize(again.select("_f", "_r", F.col("doc_id").cast("long").alias("doc_id"),
                                     plain(marked_words(F.col("text"))).alias("words")), "suspects")
    line = [*pair, "diagonal"]
    rows = hits.join(likely, pair).withColumn("diagonal", F.col("pos") - F.col("ipos"))
    # the words of an item, a row per window: the item's texts go to the hits however often it is found
    marks = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.startswith("<").alias("slot")))
    near = F.filter(F.slice(marks, F.col("ipos") + 1, n), lambda m: m["slot"])
    asked = grams.select("item", "ipos").distinct().join(items.select("item", "words"), "item").withColumn(
        "names", _identity(F.col("words"))).withColumn("bare", plain(F.col("words"))).select("item", "ipos", F.transform(near, lambda m: F.struct(
            m["at"].alias("at"), F.get("names", m["at"]).alias("value"), F.get("bare", m["at"]).alias("was"))).alias("asked"))
    rows = attach(rows, materialize(asked, "asked"), ["item", "ipos"], how="inner").join(again, ["_f", "_r"])
    compared = F.transform("asked", lambda s: F.struct(
        s["at"].alias("at"), s["value"].alias("value"), s["was"].alias("was"), F.get("words", s["at"] + F.col("diagonal")).alias("doc")))
    rows = materialize(rows.select(*line, "doc_id", "item_windows", "rich_windows", "rich", "ipos", compared.alias("slots")), "aligned")
    # for every slot the last place before it where the same benchmark value stands for another document value
    slots = rows.select(*line, F.explode("slots").alias("s")).select(*line, "s.at", "s.value", "s.was", "s.doc").distinct()
    same = Window.partitionBy(*line, "value").orderBy("at")
    turned = F.when(F.lag("doc").over(same) != F.col("doc"), F.lag("at").over(same))
    slots = slots.withColumn("turned", turned).withColumn("clash", F.max("turned").over(same))
    # one pass over a diagonal, slots and windows in order: a window ends a stretch that starts after the last clash
    steps = rows.drop("slots").withColumn("clash", F.lit(None).cast("int")).withColumn("window", F.lit(True)).unionByName(
        slots.select(*line, F.col("at").alias("ipos"), "clash", F.lit(False).alias("window")), allowMissingColumns=True)
    along = Window.partitionBy(*line).orderBy("ipos")
    steps = steps.withColumn("last", F.coalesce(F.max("clash").over(along.rangeBetween(Window.unboundedPreceding, n - 1)), F.lit(-1))).withColumn(
        "within", F.coalesce(F.max("clash").over(along.rangeBetween(0, n - 1)), F.lit(-1)))
    order = Window.partitionBy(*line).orderBy("ipos")  # at most one row per window of the item
    steps = steps.where("window").withColumn("island", F.col("ipos") - F.row_number().over(order)).withColumn(
        "start", F.min("ipos").over(Window.partitionBy(*line, "island")))
    good = steps.where(F.col("within") < F.col("ipos")).withColumn(
        "length", F.col("ipos") - F.greatest("start", F.col("last") + 1) + 1)
    seen = slots.select(*line, "value", "was", "doc").distinct().groupBy(*line).agg(
        F.count(F.lit(1)).alias("slots"), F.count_if(F.col("was") != F.col("doc")).alias("changed"))
    lines = good.groupBy(*line).agg(F.max("length").alias("length")).join(seen, line, "left")
    runs = lines.groupBy(*pair).agg((F.max("length") + n - 1).alias("run"), F.coalesce(F.max("slots"), F.lit(0)).alias("slots"),
                                    F.coalesce(F.max("changed"), F.lit(0)).alias("changed"))
    found = good.groupBy(*pair, "doc_id", "item_windows", "rich_windows").agg(
        F.count_distinct("ipos").alias("found"), F.count_distinct(F.when(F.col("rich"), F.col("ipos"))).alias("found_rich"))
    share = F.greatest(F.col("found") / F.col("item_windows"), F.try_divide("found_rich", "rich_windows"))
    out = found.join(runs, pair).withColumn("share", share)
    out = out.where((F.col("share") >= coverage) | (F.col("run") >= run_words))
    return attach(out, items.select("item", "item_id", F.size("words").alias("_words")), ["item"], how="inner").select(
        "_f", "_r", "doc_id", "item_id", "item_windows", "found", "share", F.least("run", "_words").alias("run"), "slots", "changed")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no benchmark item."""
    docs = scan(docs)
    rows = with_row_key(docs)
    bad = materialize(contaminated(docs, benchmark, **params).select("_f", "_r").distinct(), "contaminated")
    kept = attach(rows, bad.withColumn("_hit", F.lit(True)), ["_f", "_r"], salts=1).where(F.col("_hit").isNull())
    return unpack(kept, docs.columns)
