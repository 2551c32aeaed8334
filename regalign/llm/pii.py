"""Personal data: pattern spans, and terms that give a protected value away (DataFrame operations only).

Information-theoretic sanitisation: e-mail addresses, IP addresses, card and phone numbers are the
protected entities.  Words close to an entity are counted over its distinct contexts (the edited
copies of a passage are one), and their document frequency over the whole corpus; a term's disclosure of an entity is its pointwise mutual
information as a share of the entity's own information content,

    ln(N * n(c, t) / (n(c) * n(t))) / ln(N / n(c)),

1 for a term that occurs with the entity only, about 0 for one that is everywhere.  Terms at or
above ``generalise`` are replaced by a tag, those at or above ``remove`` are taken out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regalign.llm.common import WORD, attach, keyed, materialize, scan, with_row_key
from regalign.llm.components import components

KINDS = ["email", "ip", "card", "phone", "generalise", "remove"]
#: The base patterns, written so that a search never walks a run of characters twice: a match can
#: only begin where its run begins (or the last match ended), and nothing is given back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CONTEXT = 8           # words on either side of an entity
MIN_CONTEXTS = 3      # distinct contexts of an entity that a term must occur in
GENERALISE, REMOVE = 0.5, 0.8
ALIKE = 0.55          # contexts that share more than this part of their words are edited copies of one passage
BANDS, ROWS = 16, 2   # min-hash bands that bring such contexts together
TAGS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "generalise": "<TERM>", "remove": ""}


def valid(kind: Column, value: Column) -> Column:
    """Whether a match passes its kind's check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(kind == "card", F.when(n.between(12, 19), F.call_function("luhn_check", digits)).otherwise(False))
            .otherwise(n.between(9, 15)))


def _near(part: Column, last: bool) -> Column:
    """The last or first CONTEXT words of a piece of text."""
    words = F.filter(F.split(part, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.slice(words, F.greatest(F.size(words) - CONTEXT + 1, F.lit(1)) if last else 1, CONTEXT)


def _placed(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` (``gap``: characters since the last match, ``value``, ``i``) with ``start`` and ``stop``."""
    before = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("value")
    return rows.withColumn("start", F.coalesce(F.sum(F.col("gap") + length).over(before), F.lit(0)) + F.col("gap")).withColumn(
        "stop", F.col("start") + length)


def base_spans(texts: DataFrame) -> DataFrame:
    """(_f, _r, kind, start, stop, value, left, right): the valid matches of the four base kinds in whole texts.

    ``start`` and ``stop`` count code points; ``left`` and ``right`` are the words next to the match.
    """
    some = texts.where(F.col("text").rlike("[0-9@]"))  # every kind needs a digit or an @
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.split("text", p, -1).alias("gaps"),
                              F.regexp_extract_all("text", F.lit(p), 0).alias("values")) for k, p in PATTERNS.items()])
    rows = some.select("_f", "_r", F.explode_outer(each).alias("x")).select("_f", "_r", "x.kind", "x.gaps", "x.values")
    rows = rows.where(F.size("values") > 0).select(
        "_f", "_r", "kind", "gaps", F.posexplode_outer("values").alias("i", "value")).where(F.col("value").isNotNull())
    left, right = F.element_at("gaps", F.col("i") + 1), F.element_at("gaps", F.col("i") + 2)
    rows = rows.select("_f", "_r", "kind", "i", "value", F.length(left).cast("long").alias("gap"),
                       _near(left, True).alias("left"), _near(right, False).alias("right"))
    rows = _placed(rows, ["_f", "_r", "kind"])
    return rows.where(valid(F.col("kind"), F.col("value"))).select(
        "_f", "_r", "kind", "start", "stop", "value", "left", "right")


def term(word: Column) -> Column:
    """A word as a term: lower-cased, without what isn't a letter at either end."""
    return F.lower(F.regexp_replace(word, r"^[^\p{L}]+|[^\p{L}]+$", ""))


def passages(contexts: DataFrame) -> DataFrame:
    """``contexts`` (entity, ctx, bag, ...) with ``passage``: equal for an entity's contexts that are edited copies.

    Contexts that agree in a min-hash band are compared with the least of them, and those alike in
    more than ``ALIKE`` of their words are linked: at most ``BANDS`` links a context, however many
    copies there are.  Linked contexts are one passage.
    """
    def least(j: int) -> Column:
        return F.array_min(F.transform("bag", lambda w: F.xxhash64(w, F.lit(j))))

    def band(i: int) -> Column:
        return F.xxhash64("entity", F.lit(i), *[least(j) for j in range(i * ROWS, (i + 1) * ROWS)])

    rows = contexts.where(F.size("bag") > 0).select(
        "ctx", "bag", F.explode_outer(F.array(*[band(i) for i in range(BANDS)])).alias("band"))
    rows = materialize(rows, "bands")
    hubs = rows.groupBy("band").agg(F.min(F.struct("ctx", "bag")).alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = materialize(hubs.where("n > 1").drop("n"), "hubs")
    near = F.size(F.array_intersect("bag", "hub.bag")) > F.lit(ALIKE) * F.size(F.array_union("bag", "hub.bag"))
    links = attach(rows, hubs, ["band"], how="inner").where((F.col("ctx") != F.col("hub.ctx")) & near)
    same = materialize(components(links.select(F.col("ctx").alias("a"), F.col("hub.ctx").alias("b"))), "passages")
    return attach(contexts, same.withColumnRenamed("node", "ctx"), ["ctx"], salts=1).withColumn(
        "passage", F.coalesce("root", "ctx")).drop("root")


def disclosures(texts: DataFrame, base: DataFrame, min_contexts: int = MIN_CONTEXTS,
                generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of the terms that reveal an entity at least as strongly as ``generalise``.

    Contexts that are word for word the same (copies of a text or passage), or edited copies of one
    passage, count once; such a context has the terms of all its copies.  Every term in
    ``min_contexts`` contexts of an entity is judged, its document frequency counted over all texts.
    """
    around = base.select(entity(F.col("kind"), F.col("value")).alias("entity"), F.concat("left", "right").alias("words"))
    around = around.distinct().select("entity", F.xxhash64("entity", "words").alias("ctx"),
                                      F.array_distinct(F.transform("words", term)).alias("bag"))
    around = materialize(around, "contexts")
    enough = around.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_contexts).select("entity")
    around = materialize(passages(attach(around, materialize(enough, "entities"), ["entity"], how="inner")), "contexts")
    sizes = around.groupBy("entity").agg(F.count_distinct("passage").alias("nc")).where(F.col("nc") >= min_contexts)
    pairs = around.select("entity", "passage", F.explode_outer(F.filter("bag", lambda t: F.length(t) >= 3)).alias("term"))
    pairs = pairs.where(F.col("term").isNotNull()).distinct()
    pairs = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("nct")).where(F.col("nct") >= min_contexts)
    pairs = materialize(pairs.join(sizes, "entity"), "pairs")
    # letters only inside a word: what term() leaves; one row per document and term
    words = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    corpus = texts.select(words.alias("words")).select(F.explode_outer(
        F.array_distinct(F.transform(F.array_distinct("words"), term))).alias("term"))
    seen = corpus.where(F.col("term").isNotNull())
    # counted before the join, so that a common term brings one row
    nt = seen.groupBy("term").agg(F.count(F.lit(1)).alias("nt"))
    n = texts.count()
    total = F.lit(float(max(n, 1)))
    pmi = F.log(total * F.col("nct") / (F.col("nc") * F.greatest("nt", "nct")))
    share = F.try_divide(pmi, F.log(total / F.col("nc")))
    return pairs.join(nt, "term").select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= generalise)


def entity(kind: Column, value: Column) -> Column:
    """One name for all spellings of a protected value."""
    return F.concat(kind, F.lit(":"), F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(
        F.regexp_replace(value, "[^0-9]", "")))


def term_spans(texts: DataFrame, base: DataFrame, found: DataFrame, remove: float = REMOVE) -> DataFrame:
    """(_f, _r, kind, start, stop): every occurrence of a revealing term in the texts that hold its entity."""
    holds = base.select("_f", "_r", entity(F.col("kind"), F.col("value")).alias("entity")).distinct()
    marks = attach(holds, found, ["entity"], how="inner").groupBy("_f", "_r", "term").agg(F.max("disclosure").alias("d"))
    marks = materialize(marks, "marks")
    rows = attach(texts, marks.select("_f", "_r").distinct(), ["_f", "_r"], how="inner")
    rows = rows.select("_f", "_r", F.split("text", WORD, -1).alias("gaps"),
                       F.posexplode_outer(F.regexp_extract_all("text", F.lit(WORD), 0)).alias("i", "value"))
    rows = rows.where(F.col("value").isNotNull()).select(
        "_f", "_r", "i", "value", F.length(F.element_at("gaps", F.col("i") + 1)).cast("long").alias("gap"))
    rows = _placed(rows, ["_f", "_r"]).withColumn("term", term(F.col("value")))
    rows = rows.join(marks, ["_f", "_r", "term"])
    start = F.col("start") + F.length(F.regexp_extract("value", r"^[^\p{L}]*", 0))
    return rows.select("_f", "_r", F.when(F.col("d") >= remove, "remove").otherwise("generalise").alias("kind"),
                       start.alias("start"), (start + F.length("term")).alias("stop"))


def all_spans(docs: DataFrame, min_contexts: int = MIN_CONTEXTS,
              generalise: float = GENERALISE,
              remove: float = REMOVE) -> tuple[DataFrame, DataFrame]:
    """(texts with a row key, spans): (_f, _r, spans), the sorted spans of each row that has one.

    A span is (start, place of its kind, stop).  Terms that overlap a base span are left out.
    """
    texts = keyed(scan(docs), [F.col("doc_id").cast("long").alias("doc_id"), "text"])
    base = materialize(base_spans(texts), "base")
    found = materialize(disclosures(texts, base, min_contexts, generalise), "disclosures")
    more = term_spans(texts, base, found, remove)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(F.col("start").cast("long").alias("start"), order.alias("kind"), F.col("stop").cast("long").alias("stop"))
    both = base.select("_f", "_r", span.alias("s")).unionByName(more.select("_f", "_r", span.alias("s")))
    per = both.groupBy("_f", "_r").agg(F.array_sort(F.collect_list("s")).alias("spans"))
    sure = F.filter("spans", lambda s: s["kind"] <= 4)
    clear = F.filter("spans", lambda s: (s["kind"] <= 4) | ~F.exists(
        "sure", lambda b: (s["start"] < b["stop"]) & (b["start"] < s["stop"])))
    return texts, materialize(per.withColumn("sure", sure).withColumn("spans", clear).drop("sure"), "spans")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame, **params) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms) for every row of ``docs``.

    Spans are ``kind:start:stop`` in code points, by start and kind; ``base_sha256`` covers the
    four base kinds alone.  Null texts count as empty and have no span; repeated rows and null ids
    keep their rows; an empty table gives no rows; other columns are not read.
    """
    texts, spans = all_spans(docs, **params)
    none = F.array().cast("array<struct<start:long,kind:int,stop:long>>")
    rows = texts.select("_f", "_r", "doc_id").join(spans, ["_f", "_r"], "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans"))
    kinds = F.transform("spans", lambda s: s["kind"])
    count = {k: F.size(F.array_remove(F.transform(kinds, lambda x: x != i + 1), True)).cast("long")
             for i, k in enumerate(KINDS)}
    base = _listed(F.filter("spans", lambda s: s["kind"] <= 4))
    return rows.select("doc_id", *[count[k].alias(f"n_{k}") for k in KINDS[:4]], F.sha2(base, 256).alias("base_sha256"),
                       _listed(F.col("spans")).alias("spans"),
                       (count["generalise"] + count["remove"]).alias("n_terms"))


def sanitise(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, with all their columns, and every span of their text replaced by its kind's tag.

    Overlapping spans are taken in order, each from where the one before ended.  Texts without a
    span, null and empty ones stay as they are; ``n_chars``, if there, counts the new text.
    """
    docs, names = scan(docs), docs.columns
    _, spans = all_spans(docs, **params)
    total = spans.agg(F.sum(F.size("spans"))).first()[0] or 0  # bounds the table's rows and its arrays
    rows = attach(with_row_key(docs), spans, ["_f", "_r"], salts=1, rows=total)
    text = F.col("_row.text")
    tags = F.array(*[F.lit(TAGS[k]) for k in KINDS])
    # (end of the cover so far, pieces): a span adds the text between the cover and its start, and its tag
    step = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out")), lambda a, s: F.when(
        s["stop"] <= a["end"], a).otherwise(F.struct(s["stop"].alias("end"), F.concat(
            a["out"], F.substring(text, (a["end"] + 1).cast("int"), F.greatest(s["start"] - a["end"], F.lit(0)).cast("int")),
            F.element_at(tags, s["kind"])).alias("out"))))
    done = rows.withColumn("_done", step)
    new = F.when(F.col("spans").isNull(), text).otherwise(F.concat(
        F.col("_done.out"), F.substring(text, (F.col("_done.end") + 1).cast("int"), F.length(text))))
    out = done.select("_row", new.alias("_new"))
    return out.select(*[F.col("_new").alias("text") if c == "text" else
                        F.length("_new").cast("long").alias(c) if c == "n_chars" else F.col(f"_row.`{c}`").alias(c) for c in names])
