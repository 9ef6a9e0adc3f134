"""Personal data: base spans by rule, and candidates that boosted trees select; DataFrame code alone.

Places of matches come from the text split at them: gap and match lengths are summed along the text.
Matches are rows of their own from there on, so a text full of numbers is a long group of narrow rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.llm import boosting
from ledgerwell.llm.shared import stage

KINDS = ("email", "ip", "card", "phone")
# Possessive forms that match what the stated patterns match, without backtracking or deep recursion.
# A match that starts inside a run of its own characters can only follow the match before (\G).
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# High recall: runs of digits with separators, and addresses with a written-out "at".
RUN = r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,}+"
MASKED = r"[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?[Aa][Tt]\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[({]\x20?[Dd][Oo][Tt]\x20?[\])}])\x20?[A-Za-z0-9-]{1,63}){1,8}"
AT = r"\x20?[\[({]\x20?[Aa][Tt]\x20?[\])}]\x20?"
DOT = r"\x20?(?:\.|[\[({]\x20?[Dd][Oo][Tt]\x20?[\])}])\x20?"
CUES = r"(?i)(mail|phone|tel|call|fax|mobile|card|visa|credit|host|server|address|contact)"
# A span has at most so many digits. A run has at most three signs, so blanks, between two of them.
MOST_DIGITS = 19
PIECES = 1 + 3 * (MOST_DIGITS - 1)
FEATURES = ("f_kind", "f_digits", "f_groups", "f_plus", "f_check", "f_before", "f_after", "f_cue")
PRECISION = 0.95
LEAST_SEEN = 50
BROADCAST_ROWS = 500_000


def _matches(kind: str, pattern: str, quick: Column) -> Column:
    """The text's matches: kind, nth, gap before, matched text, and a little of what is around."""
    parts, found = F.split("_text", pattern, -1), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    around = F.zip_with(parts, F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda p, q: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(20)).alias("pre"), F.left(q, F.lit(1)).alias("post")))
    both = F.zip_with(found, around, lambda m, a: F.struct(F.lit(kind).alias("kind"), m.alias("m"), a["gap"].alias("gap"), a["pre"].alias("pre"), a["post"].alias("post")))
    rows = F.transform(F.filter(both, lambda x: x["m"].isNotNull()), lambda x, i: F.struct(*(x[c].alias(c) for c in ("kind", "m", "gap", "pre", "post")), i.alias("nth")))
    return F.when(quick, rows)


def key_columns(docs: DataFrame) -> DataFrame:
    """doc_id, ``_text`` and ``_key``, a hash of both. Rows alike in both are one document."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    return own.withColumn("_key", F.xxhash64("doc_id", "_text"))


def match_rows(docs: DataFrame) -> DataFrame:
    """doc_id, _key, kind, start, end, m, pre, post of all rule matches and generator runs."""
    rows = key_columns(docs).withColumn("_digits", F.col("_text").rlike("[0-9]"))
    at, digits = F.contains(F.col("_text"), F.lit("@")), F.col("_digits")
    masked = F.col("_text").rlike(r"[\[({]\x20?[Aa][Tt]\x20?[\])}]")
    every = [
        _matches("email", PATTERNS["email"], at),
        _matches("ip", PATTERNS["ip"], digits),
        _matches("card", PATTERNS["card"], digits),
        _matches("phone", PATTERNS["phone"], digits & F.contains(F.col("_text"), F.lit("+"))),
        _matches("run", RUN, digits),
        _matches("masked", MASKED, masked),
    ]
    empty = F.array().cast("array<struct<kind:string,m:string,gap:int,pre:string,post:string,nth:int>>")
    found = rows.where(at | digits | masked).select("doc_id", "_key", F.explode(F.concat(*[F.coalesce(e, empty) for e in every])).alias("x")).select("doc_id", "_key", "x.*")
    # Equal rows of one key are the same match of a repeated document.
    found = found.repartition("doc_id", "_key", "kind").dropDuplicates(["doc_id", "_key", "kind", "nth"])
    along = Window.partitionBy("doc_id", "_key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("m")).over(along)
    return found.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("m"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, F.lit("[^0-9]+"), F.lit(""))


def luhn(digits: Column) -> Column:
    """Whether a string of digits has the Luhn check sum; the last digit counts once."""
    back = F.reverse(digits)
    places = F.transform(F.sequence(F.lit(1), F.greatest(F.length(back), F.lit(1))), lambda i: F.struct(i.alias("i"), (F.ascii(back.substr(i, F.lit(1))) - 48).alias("d")))
    doubled = lambda x: x["d"] * 2 - F.when(x["d"] > 4, F.lit(9)).otherwise(F.lit(0))
    total = F.aggregate(places, F.lit(0), lambda acc, x: acc + F.when(x["i"] % 2 == 1, x["d"]).otherwise(doubled(x)))
    return total % 10 == 0


def _octets(m: Column) -> Column:
    """Whether all dotted parts are at most 255."""
    short = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(short, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(p.try_cast("int") <= 255))


def base_valid() -> Column:
    """Whether a rule match is personal data by its kind's check."""
    m, n = F.col("m"), F.length(_digits(F.col("m")))
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", _octets(m))
        .when(F.col("kind") == "card", n.between(14, 19) & luhn(F.when(n <= 19, _digits(m))))
        .when(F.col("kind") == "phone", n.between(10, 15))
        .otherwise(F.lit(False))
    )


def _sort_of(c: Column) -> Column:
    """0 blank or border, 1 letter, 2 digit, 3 other."""
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)


def candidates(matches: DataFrame) -> DataFrame:
    """All spans that the generators propose, with a kind and features; they overlap.

    A run proposes each series of its blank-separated pieces that begins and ends in a piece with digits
    and has at most ``MOST_DIGITS``, as every kind that these allow; a written-out address proposes itself. ``label`` is 1 if the e-mail rule accepts just
    a written-out address once its signs are undone; whether the rules accept a run's span, they tell
    themselves. The features do not look at the rules' own extent.
    """
    runs = matches.where("kind in ('run', 'masked')").withColumn("_pieces", F.when(F.col("kind") == "run", F.split("m", " ")).otherwise(F.array("m")))
    # The place of each piece: pieces and one blank each before it.
    piece = runs.select("doc_id", "_key", F.col("start").alias("run"), "kind", "pre", "post", F.posexplode("_pieces").alias("i", "piece"), F.size("_pieces").alias("n"))
    along = Window.partitionBy("doc_id", "_key", "kind", "run").orderBy("i")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    piece = piece.withColumn("start", F.col("run") + F.coalesce(F.sum(F.length("piece") + 1).over(before), F.lit(0)))
    piece = piece.withColumn("_own", F.length(_digits(F.col("piece")))).withColumn("_sum", F.sum("_own").over(along))
    ahead = F.collect_list(F.struct("piece", "_own", "_sum")).over(along.rowsBetween(0, PIECES))
    piece = piece.withColumn("left", F.lag("piece").over(along)).withColumn("next", ahead)
    is_run = F.col("kind") == "run"
    piece = piece.where(~is_run | F.col("_own").between(1, MOST_DIGITS))
    held = F.size(F.filter("next", lambda x: x["_sum"] - F.col("_sum") + F.col("_own") <= MOST_DIGITS))
    series = F.transform(F.sequence(F.lit(1), F.when(is_run, held).otherwise(F.lit(1))), lambda k: F.struct(F.array_join(F.slice(F.col("next")["piece"], F.lit(1), k), " ").alias("m"), k.alias("k"), F.get(F.col("next"), k)["piece"].alias("right"), F.get(F.col("next"), k - 1)["_own"].alias("last")))
    spans = piece.withColumn("s", F.explode(series)).where(~is_run | (F.col("s.last") > 0)).select("doc_id", "_key", "run", "kind", "i", "n", "start", "left", "pre", "post", "s.*")
    # Borders that belong to no number: outer signs. In an address they are part of its names.
    lead = F.when(is_run, F.regexp_extract("m", r"^[).\-]+", 0)).otherwise(F.lit(""))
    bare = F.regexp_replace(F.expr("substring(m, length(regexp_extract(m, '^[).-]+', 0)) + 1)"), r"[(.\-]+$", "")
    spans = spans.withColumn("start", F.col("start") + F.length(lead)).withColumn("m", F.when(is_run, bare).otherwise(F.col("m")))
    digits = _digits(F.col("m"))
    spans = spans.withColumn("_d", digits).withColumn("_n", F.length("_d"))
    kinds = F.array(
        F.when(F.col("kind") == "masked", F.lit(0)),
        F.when((F.col("kind") == "run") & F.col("m").rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"), F.lit(1)),
        F.when((F.col("kind") == "run") & F.col("_n").between(12, 19) & ~F.col("m").rlike(r"[().+]"), F.lit(2)),
        F.when((F.col("kind") == "run") & F.col("_n").between(7, 15), F.lit(3)),
    )
    spans = spans.select("*", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("f_kind"))
    check = F.when(F.col("f_kind") == 1, _octets(F.col("m"))).when(F.col("f_kind") == 2, F.col("_n").between(14, 19) & luhn(F.when(F.col("_n") <= 19, F.col("_d")))).when(F.col("f_kind") == 3, F.col("_n").between(10, 15)).otherwise(F.lit(True))
    plain = F.regexp_replace(F.regexp_replace("m", AT, "@"), DOT, ".")
    around = F.concat(F.right("pre", F.lit(1)), plain, F.coalesce("post", F.lit("")))
    label = F.when(F.col("f_kind") == 0, F.regexp_extract(around, PATTERNS["email"], 0) == plain).otherwise(F.lit(False))
    before = F.when(F.col("left").isNotNull(), F.lit(2)).otherwise(_sort_of(F.right("pre", F.lit(1))))
    after = F.when(F.col("right").isNotNull(), F.lit(2)).otherwise(_sort_of(F.coalesce("post", F.lit(""))))
    return spans.select(
        "doc_id", "_key", "run", "i", "k", "start", (F.col("start") + F.length("m")).alias("end"), "f_kind",
        F.least("_n", F.lit(20)).alias("f_digits"),
        F.least(F.size(F.split("m", r"[^0-9]+")), F.lit(9)).alias("f_groups"),
        F.when(F.col("kind") == "masked", 0).otherwise(F.col("m").startswith("+").cast("int")).alias("f_plus"),
        F.coalesce(check, F.lit(False)).cast("int").alias("f_check"), before.alias("f_before"), after.alias("f_after"),
        F.col("pre").rlike(CUES).cast("int").alias("f_cue"), label.cast("int").alias("label"),
    )


def learn(labelled: DataFrame, precision: float = PRECISION) -> tuple[list[tuple], list[float | None]]:
    """Each cell's features with its score, and per kind the calibrated threshold, from labelled candidates.

    All candidates count; half of the documents grow the trees, the other half set the thresholds. A
    kind whose candidates never reach the precision has none. The cells are bounded by the features.
    """
    fold = F.pmod(F.xxhash64("_key"), F.lit(2)).alias("fold")
    cells = labelled.groupBy(*FEATURES, fold).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).collect()
    cells = sorted(cells, key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in cells], np.int64).reshape(-1, len(FEATURES))
    pos, neg, folds = (np.array([r[c] for r in cells], float) for c in ("pos", "neg", "fold"))
    grow = folds == 0
    model = boosting.fit(x[grow], pos[grow], neg[grow])
    p, limits = boosting.scores(model, x), []
    for kind in range(len(KINDS)):
        own = ~grow & (x[:, 0] == kind)
        limits.append(boosting.threshold(p[own], pos[own], neg[own], precision, LEAST_SEEN))
    return [(*map(int, row), float(score)) for row, score in zip(x, p, strict=True)], limits


def best_apart(spans: DataFrame) -> DataFrame:
    """doc_id, _key, kind, start, end of the spans that stay of those that overlap, taken best first.

    A span goes if one that stays is better and overlaps it. Spans linked by overlaps are decided together.
    """
    along = Window.partitionBy("doc_id", "_key").orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("_new", (F.col("start") >= F.coalesce(reach, F.lit(-1))).cast("int"))
    islands = islands.withColumn("_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rank = F.struct(F.col("p").cast("double").alias("p"), (F.col("end") - F.col("start")).cast("long").alias("n"), (-F.col("start")).cast("long").alias("s"), F.col("kind").alias("kind"), F.col("end").cast("long").alias("end"))
    ranked = islands.groupBy("doc_id", "_key", "_island").agg(F.sort_array(F.collect_set(rank), asc=False).alias("_ranked"))
    none = F.array().cast("array<struct<p:double,n:bigint,s:bigint,kind:string,end:bigint>>")
    meets = lambda c, o: (-o["s"] < c["end"]) & (o["end"] > -c["s"])
    chosen = F.aggregate("_ranked", none, lambda acc, c: F.when(F.exists(acc, lambda o: meets(c, o)), acc).otherwise(F.concat(acc, F.array(c))))
    rows = ranked.select("doc_id", "_key", F.explode(chosen).alias("c"))
    return rows.select("doc_id", "_key", F.col("c.kind").alias("kind"), (-F.col("c.s")).alias("start"), F.col("c.end").alias("end"))


def find_spans(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """(doc_id, _key, kind, start, end, base): personal data of every whole text, one row per span.

    Base spans are those of the stated rules and always stay. A candidate is added if its score reaches
    its kind's threshold, it meets no base span, and no better one that is added overlaps it (higher score,
    then longer, then earlier). Places are code points, the end exclusive. Null and empty texts have none.
    """
    matches = stage(match_rows(docs), "matches")
    base = matches.where(F.col("kind").isin(*KINDS) & base_valid()).select("doc_id", "_key", "kind", "start", "end")
    names = F.array(*[F.lit(k) for k in KINDS])
    proposed = candidates(matches).withColumn("kind", F.element_at(names, F.col("f_kind") + 1))
    accepted = base.select("_key", "kind", "start", "end").distinct().withColumn("_base", F.lit(1))
    on = ["_key", "kind", "start", "end"]
    met = proposed.join(accepted, on, "left").withColumn("label", F.greatest("label", F.coalesce("_base", F.lit(0))))
    labelled = stage(met.drop("_base"), "proposed")
    cells, limits = learn(labelled, precision)
    # One row per combination of feature values; every candidate's is among them.
    table = docs.sparkSession.createDataFrame(cells, ", ".join(f"{f} int" for f in FEATURES) + ", p double")
    limit = F.element_at(F.array(*[F.lit(x if x is not None else 2.0) for x in limits]), F.col("f_kind") + 1)
    good = labelled.join(F.broadcast(table), list(FEATURES)).where(F.col("p") >= limit)
    # A base span meets a candidate if it reaches beyond its start, or begins before its end.
    all_rows = base.select("doc_id", "_key", "start", "end", "kind", F.lit(0).alias("added")).unionByName(good.select("doc_id", "_key", "start", "end", "kind", "p", "run", "i", "k", F.lit(1).alias("added")), allowMissingColumns=True)
    doc = Window.partitionBy("doc_id", "_key")
    up_to = doc.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = doc.orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    own = F.col("added") == 0
    placed = all_rows.withColumn("_reach", F.max(F.when(own, F.col("end"))).over(up_to)).withColumn("_next", F.min(F.when(own, F.col("start"))).over(onward))
    free = placed.where(own | ~(F.coalesce(F.col("_reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_next") < F.col("end"), F.lit(False))))
    columns = ["doc_id", "_key", "kind", "start", "end"]
    added = best_apart(free.where(~own)).select(*columns, F.lit(False).alias("base"))
    return base.select(*columns, F.lit(True).alias("base")).union(added)


def _listed(rows: Column) -> Column:
    """Spans as kind:start:end by start, then in the order of kinds."""
    ordered = F.array_sort(rows)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per row: doc_id, base counts per kind, a hash of the base spans, all spans, how many were added."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    span = F.struct("start", F.array_position(kinds, F.col("kind")).alias("nth"), "end", "kind")
    spans = find_spans(docs, precision).groupBy("doc_id", "_key")
    per_doc = spans.agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.count_if(~F.col("base")).alias("n_added"),
        _listed(F.collect_list(F.when(F.col("base"), span))).alias("_base"),
        _listed(F.collect_list(span)).alias("spans"),
    ).drop("doc_id")
    rows = key_columns(docs).select("doc_id", "_key")
    met = rows.join(per_doc, "_key", "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in (*KINDS, "added")]
    digest = F.sha2(F.coalesce("_base", F.lit("")).cast("binary"), 256).alias("base_sha256")
    return met.select("doc_id", *counts[:-1], digest, F.coalesce("spans", F.lit("")).alias("spans"), counts[-1])


def redact(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The rows of ``docs`` with each span of ``text`` replaced by its kind in brackets.

    Spans that overlap are one, named by the kind of the first. Other columns and rows without personal
    data stay as they are; a null text stays null.
    """
    spark = docs.sparkSession
    kinds = F.array(*[F.lit(k) for k in KINDS])
    own = ["doc_id", "_key"]
    along = Window.partitionBy(*own).orderBy("start", "nth", "end")
    spans = find_spans(docs, precision).withColumn("nth", F.array_position(kinds, F.col("kind"))).distinct()
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("_new", (F.col("start") >= F.coalesce(reach, F.lit(-1))).cast("int")).withColumn("_island", F.sum("_new").over(along))
    one = islands.groupBy(*own, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "nth", "end")).alias("kind"))
    # Each kept stretch of text before a span, and what stands for the span.
    before = F.lag("end", 1, 0).over(Window.partitionBy(*own).orderBy("start"))
    steps = one.withColumn("from", before).groupBy(*own).agg(
        F.array_sort(F.collect_list(F.struct(F.col("start"), F.col("from"), F.concat(F.lit("["), F.upper("kind"), F.lit("]")).alias("mark"), F.col("end")))).alias("_steps")
    )
    steps = stage(steps, "redactions")
    few = steps.count() <= BROADCAST_ROWS
    # The row as one struct, so that its columns may be called like the helpers.
    row, text = F.col("_row"), F.col("_row")["text"]
    keyed = docs.select(F.struct(*docs.columns).alias("_row")).withColumn("_row_key", F.xxhash64(row["doc_id"].cast("long"), F.coalesce(text.cast("string"), F.lit(""))))
    same = (F.col("_row_key") == F.col("_key")) & row["doc_id"].cast("long").eqNullSafe(F.col("doc_id"))
    met = keyed.join(F.broadcast(steps) if few else steps, same, "left")
    kept = F.transform("_steps", lambda s: F.concat(F.substring(text, (s["from"] + 1).cast("int"), (s["start"] - s["from"]).cast("int")), s["mark"]))
    rest = F.substring(text, (F.element_at("_steps", -1)["end"] + 1).cast("int"), F.length(text))
    redacted = F.when(F.col("_steps").isNull(), text).otherwise(F.concat(F.array_join(kept, ""), rest))
    return met.select(*[redacted.alias(c) if c == "text" else row[c].alias(c) for c in docs.columns])
