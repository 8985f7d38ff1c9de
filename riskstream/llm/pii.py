"""Personal data: patterns of fixed form, and what the words before them lead to. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskstream.llm.common import as_row, from_row, written

# The kinds in order, and their forms. The forms find, leftmost and longest first, what the
# plain ones in the brackets find, but never go back over what they have read: a run of characters
# is entered at its start only, as no later start can succeed where that one failed.
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[ -]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # Not a kind: words with five digits or more, which a pattern can make known.
    "candidate": r"(?<!\S)(?=(?:[^\s0-9]*+[0-9]){5})\S++",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+", "candidate": None}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

TAIL = 80               # characters before a find in which its pattern, two words, must lie
SEEDS = 3               # different known instances that a pattern needs
CONFIDENCE = 0.8        # of its different instances
PRECISION = 0.5         # of the places where its words stand
ROUNDS = 3
BROADCAST_ROWS = 100_000


def _luhn(digits: Column) -> Column:
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    twice = F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(twice, F.lit(0), lambda n, d: n + d) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    """Whether a find of this kind counts."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _cut(kind: str, text: Column) -> Column:
    """An array of (gap, found): the text in order; the last has no find."""
    there = text.contains(HINTS[kind]) if HINTS[kind] else F.lit(True)
    if kind not in ("email", "phone"):
        there &= text.rlike("[0-9]")
    zipped = F.arrays_zip(F.split(text, FORMS[kind], -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(FORMS[kind]), F.lit(0)).alias("found"))
    none = F.array(F.struct(text.alias("gap"), F.lit(None).cast("string").alias("found")))
    return F.when(there, zipped).otherwise(none)


def _steps(k: int, kind: str, text: Column) -> Column:
    return F.transform(_cut(kind, text), lambda x: F.struct(
        F.lit(k).alias("k"), F.length(x["gap"]).alias("gap"), x["found"].alias("found"),
        F.when(x["found"].isNotNull(), F.right(x["gap"], F.lit(TAIL))).alias("tail")))


def _masked(kind: str, text: Column) -> Column:
    mask = lambda found: F.when(found.isNull(), "").when(valid(kind, found), f"<{kind}>").otherwise(found)
    return F.array_join(F.transform(_cut(kind, text), lambda x: F.concat(x["gap"], mask(x["found"]))), "")


def _normal(words: Column) -> Column:
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def mentions(docs: DataFrame) -> DataFrame:
    """(row, doc_id, _text, kind, start, end, instance, pattern): valid finds of every kind, and candidates that
    touch none; code points, end exclusive. A row without any has one with null kind. `row` tells the
    rows of `docs` apart, `_text` is the hash of the text, `pattern` the two words before a find, lower-cased, with 0 for
    every digit, or null. Null text is empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("_text"),
                       text.alias("text"))
    steps = F.concat(*[_steps(k, kind, F.col("text")) for k, kind in enumerate(FORMS)])
    # Every kind's steps add up to the whole text.
    order = Window.partitionBy("row").orderBy("k", "pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.select("row", "doc_id", "_text", F.length("text").alias("size"), F.posexplode(steps).alias("pos", "step")).select(
        "row", "doc_id", "_text", "size", "pos", "step.*").withColumn("length", F.coalesce(F.length("found"), F.lit(0)))
    placed = placed.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(order) - F.col("k") * F.col("size"))
    counts = reduce(lambda rest, k: F.when(F.col("k") == k, valid(list(FORMS)[k], F.col("found"))).otherwise(rest),
                    range(len(FORMS)), F.lit(False))
    # The last step of the last kind stands for the row itself.
    itself = F.col("found").isNull() & (F.col("k") == len(FORMS) - 1)
    base = F.col("k") < len(KINDS)
    tail = F.regexp_extract(_normal(F.col("tail")), r"(?:^|\s)(\S+\s+\S+)\s*$", 1)
    placed = placed.where(itself | (F.col("found").isNotNull() & counts)).select(
        "row", "doc_id", "_text", F.when(~itself, F.element_at(F.array(*map(F.lit, FORMS)), F.col("k") + 1)).alias("kind"),
        (F.col("end") - F.col("length")).alias("start"), F.col("end"), F.col("found").alias("instance"),
        F.when(tail != "", F.regexp_replace(tail, r"\s+", " ")).alias("pattern"),
        F.when(base, F.col("end") - F.col("length")).alias("base_start"), F.when(base, F.col("end")).alias("base_end"))
    here = Window.partitionBy("row").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("before", F.max("base_end").over(here.orderBy("start", F.col("base_start").isNull())))
    placed = placed.withColumn("after", F.min("base_start").over(here.orderBy(F.desc("start"), F.col("base_start").isNull())))
    clear = ~(F.coalesce(F.col("before") > F.col("start"), F.lit(False)) | F.coalesce(F.col("after") < F.col("end"), F.lit(False)))
    return placed.where((F.coalesce("kind", F.lit("")) != "candidate") | clear).drop("base_start", "base_end", "before", "after")


def confident_patterns(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(pattern, kind) of the patterns that lead to one kind nearly always.

    `found` is the table of `mentions`. Known instances seed a graph of patterns and instances: they
    score 1 for their kind. In each of `ROUNDS` rounds a pattern's score for a kind is the mean of that of its
    different instances, and a candidate's that of independent hints by its patterns. A pattern is
    kept with `SEEDS` known instances and a score of `CONFIDENCE`, if it has candidates and if, of all places of its two words in
    `docs`, at least `PRECISION` lead to a find.
    """
    edges = written(found.where("pattern IS NOT NULL").groupBy("pattern", "kind", "instance").agg(
        F.count("*").alias("places")), "pii-edges")
    size = edges.groupBy("pattern").agg(
        F.count("*").alias("instances"), F.sum("places").alias("led"), F.max(F.col("kind") == "candidate").alias("open"))
    seeds = edges.where("kind <> 'candidate'").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    kept = written(seeds.join(size, "pattern").where(F.col("open") & (F.col("seeds") >= SEEDS)), "pii-patterns")
    open_edges = written(edges.where("kind = 'candidate'").select("pattern", "instance").join(
        kept.select("pattern", "kind"), "pattern"), "pii-open")
    scores = kept.select("pattern", "kind", "seeds", "instances", "led", (F.col("seeds") / F.col("instances")).alias("score"))
    for _ in range(ROUNDS):
        hints = open_edges.join(scores.select("pattern", "kind", "score"), ["pattern", "kind"])
        guessed = hints.groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("guess"))
        means = open_edges.join(guessed, ["instance", "kind"]).groupBy("pattern", "kind").agg(F.sum("guess").alias("guessed"))
        scores = written(scores.drop("score").join(means, ["pattern", "kind"]).select(
            "pattern", "kind", "seeds", "instances", "led",
            ((F.col("seeds") + F.col("guessed")) / F.col("instances")).alias("score")), "pii-scores")
    sure = written(scores.where(F.col("score") >= CONFIDENCE), "pii-sure")
    few = F.broadcast(sure) if sure.count() <= BROADCAST_ROWS else sure
    texts = docs.where("text IS NOT NULL").select(
        F.split(F.trim(F.regexp_replace(_normal(F.col("text")), r"\s+", " ")), " ").alias("words"))
    starts = F.when(F.size("words") > 1, F.sequence(F.lit(1), F.size("words") - 1)).otherwise(F.array().cast("array<int>"))
    places = texts.select(F.explode(F.transform(
        starts, lambda at: F.array_join(F.slice("words", at, 2), " "))).alias("pattern"))
    counted = places.join(few, "pattern").groupBy("pattern", "kind", "led").count()
    return written(counted.where(F.col("led") >= PRECISION * F.col("count")).select("pattern", "kind"), "pii-confident")


def personal_data(docs: DataFrame) -> DataFrame:
    """(row, doc_id, _text, kind, start, end, known): every span of personal data of every row of `docs`;
    `known` by its form, the rest by a confident pattern. A row without spans has one with null kind.

    Null text is empty. Spans of different kinds may overlap; those found by a pattern overlap none.
    Repeated rows each have their spans. Extra columns are ignored. No rows: no rows.
    """
    found = written(mentions(docs), "pii-mentions")
    sure = confident_patterns(found, docs).withColumnRenamed("kind", "led_to")
    known = found.where("kind IS NULL OR kind <> 'candidate'").select(
        "row", "doc_id", "_text", "kind", "start", "end", F.lit(True).alias("known"))
    more = found.where("kind = 'candidate'").join(sure, "pattern").select(
        "row", "doc_id", "_text", F.col("led_to").alias("kind"), "start", "end", F.lit(False).alias("known"))
    return known.union(more.distinct())


def span_report(spans: DataFrame) -> DataFrame:
    """One row per row of the documents: (doc_id, n_email, n_ip, n_card, n_phone, base, spans); the counts and
    `base` are of the known spans, `spans` of all, as kind:start:end in the order of kinds, then starts."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = spans.withColumn("span", F.when(F.col("kind").isNotNull(), F.struct(
        rank.alias("rank"), "start", "end", "kind", "known")))
    text = lambda all_: F.array_join(F.transform(all_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return spans.groupBy("row", "doc_id").agg(
        *[F.count(F.when((F.col("kind") == kind) & F.col("known"), 1)).alias(f"n_{kind}") for kind in KINDS],
        F.sort_array(F.collect_list("span")).alias("all")).select(
        "doc_id", *[f"n_{kind}" for kind in KINDS], text(F.filter("all", lambda s: s["known"])).alias("base"),
        text(F.col("all")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """`docs`, all columns and rows, with <kind> in `text` in place of personal data; null text stays null. Columns of any name pass."""
    more = personal_data(docs).where("NOT known").groupBy("doc_id", "_text").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "kind")), False).alias("more"))
    keyed = docs.select(as_row(docs, "text"), "doc_id", "text", F.xxhash64("text").alias("_text"))
    same = F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t._text") == F.col("m._text"))
    df = keyed.alias("t").join(written(more, "pii-more").alias("m"), same, "left").select("row", "text", "more")
    df = df.withColumn("text", F.when(F.col("more").isNull(), F.col("text")).otherwise(F.aggregate(
        "more", F.col("text"), lambda t, s: F.concat(
            F.substring(t, F.lit(1), s["start"].cast("int")), F.lit("<"), s["kind"], F.lit(">"),
            F.substring(t, s["end"].cast("int") + 1, F.length(t))))))
    for kind in KINDS:
        df = df.withColumn("text", F.when(F.col("text").isNotNull(), _masked(kind, F.col("text"))))
    return from_row(df, docs, text="text")


