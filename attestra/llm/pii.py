"""Personal data: identifiers by pattern, and the terms that reveal them by co-occurrence in the corpus.

Identifiers (e-mail, IP, card and phone numbers) are found in whole texts.  Terms are all runs of letters and
digits.  For an identifier ``c`` and a term ``t``, the windows of 32 runs on both sides of each mention of ``c``, and
contexts of 64 runs over all documents, give how much of what is to know about ``c`` the term gives away:

    PMI(c; t) / IC(c) = log2(N n_ct / (n_c n_t)) / log2(N / n_c)

which is 1 for a term that occurs with ``c`` only, and near 0 for a common word (``N``: contexts, ``n_t``: those with
``t``, ``n_c``: mentions, ``n_ct``: those with ``t`` in the window).  Terms beyond the upper
threshold are removed, those beyond the lower one are generalised.  DataFrame and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions.binding import evaluated_once
from attestra.llm.common import own_columns, prepared, small_side, written

# The patterns match what their plain forms match; possessive runs and "not inside a run" only spare the
# search from trying every place of a long run, and deep recursion.  ``\G`` is the end of the match before.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "general", "removed")
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

RUN = r"[\p{L}\p{N}]++"
CONTEXT = 64  # runs
SHORTEST = 2  # characters of a term


@dataclass(frozen=True)
class Disclosure:
    """Thresholds of PMI / IC, and the least contexts (two of them different) that show an association."""

    generalise: float = 0.75
    remove: float = 0.90
    least_contexts: int = 3


DEFAULT = Disclosure()


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a short string of digits is right."""
    places = F.sequence(F.lit(1), F.length(digits))
    doubled = F.transform(
        places,
        lambda k: F.when(
            (F.length(digits) - k) % 2 == 1,
            F.substring(digits, k, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, k, F.lit(1)).cast("int") > 4, 9).otherwise(0),
        ).otherwise(F.substring(digits, k, F.lit(1)).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    """The checks of each kind; lengths are checked before anything is computed from the digits."""
    digits = _digits(match)
    size = F.length(digits)
    card = F.when(size.between(16, 19), _luhn(F.when(size.between(16, 19), digits).otherwise("0"))).otherwise(False)
    return (
        F.when(kind == "ip", match.rlike(rf"^{PART}(?:\.{PART}){{3}}$"))
        .when(kind == "card", card)
        .when(kind == "phone", size.between(8, 15))
        .otherwise(True)
    )


def _matches(text: Column, kind: str) -> Column:
    """Every match of a kind with the code points between it and the match before."""
    # What a text must hold for a match: most texts are spared the search.
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9]"))
    pattern = F.lit(PATTERNS[kind])
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda s: F.length(s))
    found = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    none = F.array().cast("array<struct<gap:int,match:string>>")
    return F.when(needs, F.filter(found, lambda x: x["match"].isNotNull())).otherwise(none)


def _before(column: str, *keys: str, order: str) -> Column:
    """Sum of a column over the earlier rows of a text."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    """Rows with a number of their own, a key of their text and all matches; the texts stay behind."""
    rows = own_columns(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = [_matches(F.col("text"), k).alias(k) for k in PATTERNS]
    made = rows.select("doc_id", F.xxhash64("text").alias("key"), F.crc32(F.col("text").cast("binary")).alias("key2"), *found)
    return written(made.withColumn("row", F.monotonically_increasing_id()), "matches")


def _identifiers(rows: DataFrame) -> DataFrame:
    """``key, key2, kind, start, end, entity`` of the valid matches of each distinct text."""
    # All rows of equal texts have equal matches: one of them speaks for the text.
    texts = rows.where(F.greatest(*[F.size(k) for k in PATTERNS]) > 0)
    kinds = [texts.select("key", "key2", F.lit(k).alias("kind"), F.posexplode(k).alias("at", "x")) for k in PATTERNS]
    each = reduce(DataFrame.union, kinds).select("key", "key2", "kind", "at", "x.gap", "x.match").distinct()
    each = each.withColumn("length", F.length("match")).withColumn("step", F.col("gap") + F.col("length"))
    placed = each.withColumn("start", _before("step", "key", "key2", "kind", order="at") + F.col("gap"))
    good = placed.where(_valid(F.col("kind"), F.col("match")))
    entity = F.when(F.col("kind") == "email", F.lower("match")).when(F.col("kind") == "ip", F.col("match")).otherwise(_digits(F.col("match")))
    return good.select(
        "key", "key2", "kind", "start", (F.col("start") + F.col("length")).alias("end"), F.xxhash64("kind", entity).alias("entity")
    )


def _runs(text: Column) -> Column:
    """The terms of a text as they stand: all runs of letters and digits."""
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0))


def _contexts(docs: DataFrame) -> DataFrame:
    """The distinct terms of every context of every document, one array a context; an empty text is one context."""
    rows = own_columns(docs, "doc_id", "text").where("text is not null")
    rows = evaluated_once(rows.select(_runs(F.col("text")).alias("runs")))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("runs")), F.lit(CONTEXT))
    each = rows.select(F.explode(F.transform(starts, lambda k: F.slice("runs", k, CONTEXT))).alias("runs"))
    return each.select(F.array_distinct(F.split(F.lower(F.array_join("runs", " ")), " ")).alias("terms"))


def _located(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``key, key2, at, run, start, end`` of the runs of texts that hold an identifier, each text once."""
    wanted = small_side(written(found.select("key", "key2").distinct(), "keys"), row_bytes=16)
    rows = own_columns(docs, "doc_id", "text").where("text is not null")
    rows = rows.select(F.xxhash64("text").alias("key"), F.crc32(F.col("text").cast("binary")).alias("key2"), "text")
    rows = rows.join(wanted, ["key", "key2"], "left_semi").groupBy("key", "key2").agg(F.first("text").alias("text"))
    gaps = F.transform(F.split("text", RUN, -1), lambda g: F.length(g))
    rows = rows.select("key", "key2", F.posexplode(F.arrays_zip(gaps.alias("gap"), _runs(F.col("text")).alias("run"))).alias("at", "x"))
    rows = rows.where("x.run is not null").select("key", "key2", "at", "x.gap", "x.run", (F.col("x.gap") + F.length("x.run")).alias("step"))
    rows = rows.withColumn("start", _before("step", "key", "key2", order="at") + F.col("gap"))
    return rows.select("key", "key2", "at", "run", "start", (F.col("start") + F.length("run")).alias("end"))


def disclosures(docs: DataFrame, found: DataFrame, how: Disclosure = DEFAULT) -> DataFrame:
    """``key, key2, kind, start, end`` of the terms that reveal an identifier of their text.

    ``found`` has the identifiers of the texts.  Co-occurrence is counted in a window around each mention, whose
    terms count once; a term beyond a threshold is marked wherever a text with that identifier has it outside
    identifiers.  Every document counts, copies too; but terms whose windows with the identifier are
    all the same show no association.
    """
    runs = _located(docs, found)
    lines = runs.select("key", "key2", F.col("start").alias("place"), F.lit(0).alias("mark"), "at", "end", "run", F.lit(None).cast("long").alias("entity"))
    marks = found.select("key", "key2", F.col("start").alias("place"), F.lit(1).alias("mark"), F.lit(None).cast("int").alias("at"), "end", F.lit(None).cast("string").alias("run"), "entity")
    upto = Window.partitionBy("key", "key2").orderBy("place", F.desc("mark"), "end").rowsBetween(Window.unboundedPreceding, 0)
    seen = {
        "index": F.coalesce(F.last("at", ignorenulls=True).over(upto) + 1, F.lit(0)),  # of the run that follows a mention
        "covered": F.coalesce(F.max(F.when(F.col("mark") == 1, F.col("end"))).over(upto), F.lit(0)),
    }
    placed = written(lines.union(marks).withColumns(seen), "placed")
    here = placed.where("mark = 1").select("key", "key2", "index", "entity").distinct()
    copies = own_columns(docs, "doc_id", "text").where("text is not null")
    copies = copies.select(F.xxhash64("text").alias("key"), F.crc32(F.col("text").cast("binary")).alias("key2"))
    copies = copies.groupBy("key", "key2").agg(F.count("*").alias("copies"))
    here = written(here.join(copies, ["key", "key2"]), "mentions")

    terms = placed.where((F.col("mark") == 0) & (F.length("run") >= SHORTEST) & (F.col("covered") <= F.col("place")))
    terms = terms.select("key", "key2", "at", F.lower("run").alias("term"), F.col("place").alias("start"), "end")
    # A mention meets the terms of its own block of the text and of the two beside it.
    around = F.explode(F.array(*[F.expr(f"`index` div {CONTEXT}") + k for k in (-1, 0, 1)])).alias("block")
    some_here = small_side(here, row_bytes=48).select("key", "key2", "index", "entity", "copies", around)
    near = terms.withColumn("block", F.expr(f"at div {CONTEXT}")).join(some_here, ["key", "key2", "block"])
    near = near.where(F.abs(F.col("at") - F.col("index")) <= CONTEXT // 2)
    near = near.select("key", "key2", "index", "term", "entity", "copies").distinct()
    alike = F.xxhash64("key", "index")
    pairs = near.groupBy("entity", "term").agg(F.sum("copies").alias("n_ct"), F.min(alike).alias("a"), F.max(alike).alias("b"))
    pairs = written(pairs.where((F.col("n_ct") >= how.least_contexts) & (F.col("a") != F.col("b"))).drop("a", "b"), "pairs")

    # The empty term stands for every context: its count is their number.
    every = F.lit("").alias("term")
    asked = written(pairs.select("term").distinct().union(docs.sparkSession.range(1).select(every)), "asked")
    some = small_side(asked, row_bytes=32 + F.octet_length("term"))
    held = _contexts(docs).select(F.explode(F.array_union(F.array(F.lit("")), "terms")).alias("term"))
    counted = written(held.join(some, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t")), "counted")
    total = (counted.where("term = ''").first() or [None, 0])[1]
    n_t = counted.where("term <> ''")
    n_c = here.groupBy("entity").agg(F.sum("copies").alias("n_c"))

    scored = pairs.join(n_t, "term").join(n_c, "entity")
    content = F.log2(F.lit(float(total)) / F.col("n_c"))
    pmi = F.log2(F.lit(float(total)) * F.col("n_ct") / (F.col("n_c").cast("double") * F.col("n_t")))
    share = F.when(content > 0, pmi / content).otherwise(0.0)
    scored = written(scored.withColumn("share", share).where(F.col("share") >= how.generalise).select("entity", "term", "share"), "scored")
    wide = 48 + F.octet_length("term")
    told = here.select("key", "key2", "entity").distinct().join(small_side(scored, wide), "entity")
    told = written(told.groupBy("key", "key2", "term").agg(F.max("share").alias("share")), "told")
    spans = terms.join(small_side(told, wide), ["key", "key2", "term"])
    kind = F.when(F.col("share") >= how.remove, "removed").otherwise("general")
    return spans.select("key", "key2", kind.alias("kind"), "start", "end")


def find(docs: DataFrame, how: Disclosure = DEFAULT) -> DataFrame:
    """``doc_id, row, key, key2, base, added`` for every row of ``docs`` (``doc_id, text``).

    ``base`` and ``added`` are arrays of ``(kind_no, kind, start, end)`` in order of kind and start, in
    code points, ``end`` exclusive.  Matches that fail their check are dropped and not tried again.
    Null and empty texts have no spans; repeated rows have equal ones; an empty table gives no rows.
    """
    prepared(docs.sparkSession)
    rows = _texts(docs)
    found = written(_identifiers(rows), "identifiers")

    def gathered(spans: DataFrame, name: str) -> DataFrame:
        number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
        one = F.struct(number.alias("kind_no"), "kind", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
        return spans.groupBy("key", "key2").agg(F.array_sort(F.collect_list(one)).alias(name))

    base = gathered(found.select("key", "key2", "kind", "start", "end"), "base")
    added = gathered(disclosures(docs, found, how), "added")
    spans = written(base.join(added, ["key", "key2"], "left"), "spans")
    # Only rows of texts with an identifier look for their spans.
    held = F.greatest(*[F.size(k) for k in PATTERNS]) > 0
    some = rows.where(held).select("doc_id", "row", "key", "key2").join(spans, ["key", "key2"], "left")
    none = F.array().cast(spans.schema["base"].dataType)
    some = some.select("doc_id", "row", "key", "key2", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))
    return some.union(rows.where(~held).select("doc_id", "row", "key", "key2", none, none))


def told(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, how: Disclosure = DEFAULT) -> DataFrame:
    """``doc_id, text`` of every row: identifiers replaced by their kind, terms generalised or removed.

    Where spans overlap, the one that starts first (then the longer one) counts.
    """
    spans = written(find(docs, how), "found").where(F.size("base") > 0)
    spans = spans.select("key", "key2", F.concat("base", "added").alias("spans")).dropDuplicates(["key", "key2"])
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<from:bigint,to:bigint,kind:string>>").alias("kept"))
    chosen = F.aggregate(
        order,
        empty,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                (-s["back"]).alias("at"),
                F.concat(a["kept"], F.array(F.struct(s["start"].alias("from"), (-s["back"]).alias("to"), s["kind"].alias("kind")))).alias("kept"),
            ),
        ).otherwise(a),
    )["kept"]
    spans = spans.select("key", "key2", chosen.alias("kept"))
    rows = own_columns(docs, "doc_id", "text")
    keyed = rows.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    keyed = keyed.withColumn("key2", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    joined = keyed.join(spans, ["key", "key2"], "left")
    mark = {"general": "[TERM]", "removed": ""}
    places = F.sequence(F.lit(1), F.size("kept"))

    def piece(k: Column) -> Column:
        span = F.element_at("kept", k)
        start = F.when(k == 1, F.lit(0)).otherwise(F.element_at("kept", F.greatest(k - 1, F.lit(1)))["to"]).cast("int")
        word = F.coalesce(*[F.when(span["kind"] == n, w) for n, w in mark.items()], F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        return F.concat(F.substring("text", start + 1, (span["from"] - start).cast("int")), word)

    last = F.element_at("kept", -1)["to"].cast("int")
    tail = F.substring("text", last + 1, F.length("text"))
    text = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform(places, piece), ""), tail))
    return joined.select("doc_id", text.alias("text"))
