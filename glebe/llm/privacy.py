"""Personal data and the terms that give it away; DataFrame operations only.

Base kinds are found by patterns, leftmost and without overlap per kind, with code point positions.
The patterns say what the documented ones say, but start only where a run starts (or the last match
ended) and repeat single characters rather than groups, so that long runs cost linear time and no stack.

Around them runs an information-theoretic sanitiser. A found value is a protected entity; all terms of
the texts that hold it are its context: every word outside the spans, but for those with digits.
Over the whole corpus, with counts of different texts N (all), n(e), n(t) and n(e,t), the normalised pointwise
mutual information ``log(N n(e,t) / (n(e) n(t))) / -log(n(e,t) / N)`` says how strongly term t reveals
entity e: 1 if neither occurs without the other. In the numerator stands the lower confidence bound
``n(e,t) - DOUBT sqrt(n(e,t))`` of a count: one or two joint texts prove nothing, as every rare word of a text is alone
with its entities, so words that merely are rare stay. Copies of a text count once. A term at or above ``disclosure`` is
a span of kind ``term`` in every document that holds the entity, and is generalised with it. Documents without an entity
are left alone. Entities in too few texts for any term, and terms too frequent for any entity, are left out before
entities meet terms; both bounds are exact.

Null and empty texts have no spans. Repeated rows get equal results. An empty table gives an empty
result. Other columns are kept; helper columns avoid their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.llm.tables import apart, stored

DISCLOSURE = 0.75
DOUBT = 1.5  # standard deviations between a count and its lower bound

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_VALID = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"
# single separators between digits stay, other ones are blanked before runs are read
CARD_BLANK = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
CARD = r"[0-9][0-9\x20-]+"
CARD_LIKE = r"[0-9](?:[\x20-]?[0-9]){13}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, kind: int, holds) -> Column:
    """Spans of the matches for which ``holds`` is true, in order."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")
    )

    def step(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.length(z["gap"])
        end = start + F.coalesce(F.length(z["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), z["hit"].alias("value"))
        kept = z["hit"].isNotNull() & holds(z["hit"])
        return F.struct(end.alias("at"), F.when(kept, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(pieces, begin, step, lambda acc: acc["out"])


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind. Each pattern runs only on texts that hold its marker."""
    none = F.array().cast(_SPANS)
    card = _matches(
        F.regexp_replace(text, CARD_BLANK, "\u0001"), CARD, 2, lambda v: F.length(_digits(v)).between(14, 19) & _luhn(_digits(v))
    )
    found = [
        F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL, 0, lambda v: F.lit(True))),
        F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), _matches(text, IP, 1, lambda v: F.rlike(v, F.lit(IP_VALID)))),
        F.when(F.rlike(text, F.lit(CARD_LIKE)), card),
        F.when(F.contains(text, F.lit("+")), _matches(text, PHONE, 3, lambda v: F.length(_digits(v)).between(10, 15))),
    ]
    return F.array_sort(F.concat(*[F.coalesce(x, none) for x in found]))


def _lower(c: Column) -> Column:
    return F.lower(c)


def _entities(spans: Column) -> Column:
    return F.array_distinct(F.transform(spans, lambda s: F.concat(s["kind"].cast("string"), F.lit(":"), s["value"])))


def _replaced(body: Column, spans: Column, kind: Column) -> Column:
    """``body`` with each of the sorted spans replaced by the entry of its kind; overlapping spans become one."""

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(body, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, F.get(kind, s["kind"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_lower(text), F.lit(WORD), F.lit(0)))


def _terms(text: Column, spans: Column) -> Column:
    """The words of a text without its spans and without what is glued to digits."""
    plain = _replaced(text, spans, F.array(*[F.lit(" ") for _ in KINDS]))
    return _words(F.regexp_replace(plain, r"[^\s0-9]*+[0-9][^\s]*+", " "))


def strength(n_both: Column, n_entity: Column, n_term: Column, total: Column, doubt: float = DOUBT) -> Column:
    """Normalised pointwise mutual information with the lower bound of the joint count; null where that is not positive."""
    least = n_both - doubt * F.sqrt(n_both)
    whole = F.when(n_both >= total, F.lit(1.0)).otherwise(-F.log(n_both / total))
    return F.when(least > 0, F.log(least * total / (n_entity * n_term)) / whole)


def disclosing(scanned: DataFrame, text: str, spans: str, disclosure: float = DISCLOSURE, doubt: float = DOUBT) -> DataFrame:
    """(entity, term): the terms that reveal an entity, from counts over all different texts."""
    different = scanned.select(F.xxhash64(text).alias("one"), F.xxhash64(text, F.lit(1)).alias("two"), F.col(text).alias("text"), F.col(spans).alias("spans"))
    held = different.filter(F.size("spans") > 0).select("one", "two", F.explode(_entities(F.col("spans"))).alias("entity")).distinct()
    entities = stored(held.groupBy("entity").agg(F.count("*").alias("n_entity")).filter(F.col("n_entity") > doubt * doubt), "entities")
    held = stored(held.join(entities.select("entity"), "entity", "left_semi"), "held")
    total = float(different.agg(F.count_distinct("one", "two")).first()[0])
    largest = entities.agg(F.max("n_entity")).first()[0] or 1
    # a term in more texts than the largest entity shares at most all of that entity's texts
    most = max(largest, total * (largest / total) ** disclosure * (1 + 1e-9)) if total else 0
    terms = (
        different.groupBy("one", "two").agg(F.first("text").alias("text"))
        .select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    )
    terms = terms.filter((F.col("n_term") > doubt * doubt) & (F.col("n_term") <= most))
    context = different.join(held.select("one", "two").distinct(), ["one", "two"], "left_semi").groupBy("one", "two").agg(
        F.first("text").alias("text"), F.first("spans").alias("spans")
    )
    said = context.select("one", "two", F.explode(_terms(F.col("text"), F.col("spans"))).alias("term"))
    together = held.join(said, ["one", "two"]).groupBy("entity", "term").agg(F.count("*").alias("n_both")).filter(F.col("n_both") > doubt * doubt)
    joined = together.join(entities, "entity").join(terms, "term")
    found = strength(F.col("n_both"), F.col("n_entity"), F.col("n_term"), F.lit(total), doubt)
    return joined.filter(found >= disclosure).select("entity", "term")


def _among(value: Column, listed: Column) -> Column:
    """Whether a sorted array holds a value, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(27, -1, -1)])
    at = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= F.size(listed)) & (F.get(listed, at + step - 1) <= value), at + step).otherwise(at)
    )
    return F.coalesce(F.get(listed, at - 1) == value, F.lit(False))


def scan(
    docs: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, doubt: float = DOUBT
) -> tuple[DataFrame, tuple[str, str]]:
    """``docs`` with base spans and term spans; returns the names of the two columns."""
    base, terms, key, listed = apart(docs, "base_spans", "term_spans", "scan_key", "scan_terms")
    scanned = stored(docs.withColumn(base, base_spans(F.coalesce(F.col(text), F.lit("")))), "scanned")
    pairs = stored(disclosing(scanned, text, base, disclosure, doubt), "disclosing")
    holding = scanned.filter(F.size(base) > 0).withColumn(key, F.xxhash64(text))
    by_text = (
        holding.select(key, F.explode(_entities(F.col(base))).alias("entity")).distinct().join(pairs, "entity")
        .groupBy(key).agg(F.sort_array(F.collect_set("term")).alias(listed))
    )
    mine = _matches(F.col(text), WORD, 4, lambda v: _among(_lower(v), F.col(listed)))
    free = F.filter(mine, lambda t: ~F.exists(F.col(base), lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    none = F.array().cast(_SPANS)
    with_terms = holding.join(by_text, key, "left").withColumn(terms, F.when(F.col(listed).isNotNull(), free).otherwise(none))
    clean = scanned.filter(F.size(base) == 0).withColumn(terms, none)
    return with_terms.select(*docs.columns, base, terms).unionByName(clean.select(*docs.columns, base, terms)), (base, terms)


def number(spans: Column | str, kind: int) -> Column:
    """How many of the spans are of a kind. The condition takes one argument: a second one would be the position."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def digest(spans: Column) -> Column:
    """kind:start:end of the spans by start, then kind, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def sanitize(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind, like ``<EMAIL>``; overlapping spans become one."""
    found, (base, terms) = scan(docs, text, **options)
    body, kind = F.col(text), F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    spans = F.array_sort(F.concat(base, terms))
    rebuilt = _replaced(body, spans, kind)
    return found.withColumn(text, F.when(F.size(spans) > 0, rebuilt).otherwise(body)).select(*docs.columns)
