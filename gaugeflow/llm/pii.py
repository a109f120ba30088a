"""Personal data by patterns, and terms that give it away by what the corpus tells.

Base spans are e-mail and IP addresses, card and phone numbers. Each distinct value is a
protected entity. A term (a word of three letters or more outside all base spans) of a
document that holds an entity reveals as much about it as their point-wise mutual information
over all documents, measured against the information of the entity itself:
disclosure(e, t) = PMI(e, t) / IC(e), with PMI = log2(N n(e,t) / (n(e) n(t))) and
IC = log2(N / n(e)), all n counting whole documents. Each occurrence of a term that reaches
the threshold, and was seen with the entity in two different texts at least, is a span of the
kind ``term`` in the documents of the entity: to be removed, or generalised to its kind's label.

Everything is DataFrame functions. Equal texts are one with a count before terms are paired
with entities; only texts that hold an entity are shuffled.

Defined results: null text is empty. Equal rows get equal results; documents without an
entity have no terms. Positions are code points, ends exclusive. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns. An address or number starts where its run of characters does
# (or where the last match ended), and a card number is a whole run of digits; saying so keeps
# the search linear in the text and changes no match.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Entities of one text that a task pairs with the text's terms; more go to several tasks.
ENTITIES_TOGETHER = 256
#: Share of an entity's information that a term may not reveal, and texts it must be seen in.
THRESHOLD, SUPPORT = 0.8, 2


def _matches(text: Column, pattern: str) -> Column:
    """Matches as an array of (start, end, value), from the texts between and of them."""
    between = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    steps = F.zip_with(
        F.slice(between, 1, F.size(values)), values,
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + F.length(step["gap"])
        end = start + F.length(step["value"])
        match = F.struct(start.alias("start"), end.alias("end"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(match)).alias("found"))

    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.aggregate(steps, start, add, lambda state: state["found"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        bare = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(bare, lambda p: (F.length(p) <= 3) & (
            F.coalesce(p.try_cast("int"), F.lit(0)) <= 255
        ))
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """An array of (kind, start, end, value) by kind, then start."""
    possible = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9]"),
        "phone": text.rlike(r"\+[0-9]"),
    }

    def of(kind: str) -> Column:
        good = F.filter(_matches(text, PATTERNS[kind]), lambda m: _passes(kind, m["value"]))
        named = F.transform(good, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            m["value"].alias("value"),
        ))
        none = F.expr(
            "cast(array() as array<struct<kind:string,start:int,end:int,value:string>>)"
        )
        return F.when(possible[kind], named).otherwise(none)

    return F.concat(*map(of, PATTERNS))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(
        F.lower(span["value"])
    )
    return F.xxhash64(span["kind"], value)


_TERM = r"(?<![\p{L}\p{N}])\p{L}{3,}+(?![\p{L}\p{N}])"


def _outside(text: Column, base: Column) -> Column:
    """The text with spaces in place of its base spans, so that positions stay."""
    by_place = F.array_sort(F.transform(base, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end")
    )))

    def put(state: Column, span: Column) -> Column:
        start = F.greatest(span["start"], state["at"])
        gap = F.substring(text, state["at"] + 1, start - state["at"])
        blank = F.repeat(F.lit(" "), F.greatest(span["end"], start) - start)
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], gap, blank).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    blanked = F.aggregate(by_place, start, put, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))
    ))
    return F.when(F.size(base) > 0, blanked).otherwise(text)


def _term_of(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _terms(outside: Column) -> Column:
    """The distinct terms of a text whose base spans are blank."""
    words = F.regexp_extract_all(outside, F.lit(_TERM), F.lit(0))
    return F.array_distinct(F.transform(words, _term_of))


def _places(outside: Column, terms: Column) -> Column:
    """Every occurrence (start, end) of one of ``terms``, in order."""
    between = F.split(outside, _TERM, -1)
    words = F.regexp_extract_all(outside, F.lit(_TERM), F.lit(0))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    steps = F.zip_with(
        F.slice(between, 1, F.size(words)), words,
        lambda gap, word: F.struct(
            F.length(gap).alias("gap"), F.length(word).alias("length"),
            F.array_contains(terms, _term_of(word)).alias("found"),
        ),
    )

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["length"]
        place = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            step["found"], F.concat(state["found"], F.array(place))
        ).otherwise(state["found"]).alias("found"))

    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.aggregate(steps, start, add, lambda state: state["found"])


def term_documents(found: DataFrame) -> DataFrame:
    """term, n: in how many documents each term of the corpus stands outside base spans."""
    outside = found.select(_outside(F.col("text"), F.col("base")).alias("outside"))
    return outside.select(F.explode(_terms(F.col("outside"))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n")
    )


def _holders(base: DataFrame) -> DataFrame:
    """digest, n_rows, text, base, entities of each distinct text with an entity."""
    return base.filter(F.size("base") > 0).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n_rows"), F.first("text").alias("text"),
        F.first("base").alias("base"), F.first("entities").alias("entities"),
    )


def _slots(n_entities: Column) -> Column:
    return F.ceil(n_entities / ENTITIES_TOGETHER).cast("int")


def _pairs(found: DataFrame, holders: DataFrame, n_docs: int) -> DataFrame:
    """digest, entity, term, n_rows, n_entity, n: what stands together in a text.

    Left out is what cannot reach the threshold: entities of one text or of all documents,
    and terms of more documents than would do if the entity were in each of them.
    """
    each = holders.select(
        "digest", "n_rows", F.size("entities").alias("n_entities"),
        F.explode("entities").alias("entity"),
    )
    entities = each.groupBy("entity").agg(
        F.sum("n_rows").alias("n_entity"), F.count(F.lit(1)).alias("n_texts")
    ).filter((F.col("n_texts") >= SUPPORT) & (F.col("n_entity") < n_docs)).drop("n_texts")
    slot = F.pmod(F.xxhash64("entity"), _slots(F.col("n_entities"))).cast("int")
    held = common.written(each.join(entities, "entity").select(
        "digest", slot.alias("slot"), "entity", "n_rows", "n_entity"
    ), "pii-held")

    # n(e,t) <= n(e), so PMI <= log2(N / n(t)); a little more, for rounding.
    def most(n_entity):
        return 1.000001 * F.pow(F.lit(float(n_docs)), 1 - THRESHOLD) * F.pow(n_entity, THRESHOLD)

    widest = held.agg(F.max("n_entity")).first()[0] or 0
    counts = term_documents(found).filter(
        (F.col("n") >= SUPPORT) & (F.col("n") <= most(F.lit(float(widest))))
    )
    used = held.select("digest").distinct()
    outside = holders.join(used, "digest", "left_semi").select(
        "digest", _slots(F.size("entities")).alias("slots"),
        _outside(F.col("text"), F.col("base")).alias("outside"),
    )
    words = outside.select("digest", "slots", F.explode(_terms(F.col("outside"))).alias("term"))
    known = words.join(counts, "term").select(
        "digest", "term", "n", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")
    )
    return known.join(held, ["digest", "slot"]).filter(
        F.col("n") <= most(F.col("n_entity").cast("double"))
    ).drop("slot")


def disclosing(pairs: DataFrame, n_docs: int) -> DataFrame:
    """(entity, term, disclosure) of the terms that reveal too much of an entity."""
    counted = pairs.groupBy("entity", "term").agg(
        F.sum("n_rows").alias("n_pair"), F.count(F.lit(1)).alias("n_texts"),
        F.max("n_entity").alias("n_entity"), F.max("n").alias("n"),
    ).filter(F.col("n_texts") >= SUPPORT)
    total = F.lit(float(n_docs))
    pmi = F.log2(total * F.col("n_pair") / (F.col("n_entity") * F.col("n")))
    information = F.log2(total / F.col("n_entity"))
    return (
        counted.withColumn("disclosure", F.when(information > 0, pmi / information))
        .filter(F.col("disclosure") >= THRESHOLD).select("entity", "term", "disclosure")
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, spans: base spans and disclosing terms by kind, then start."""
    texts = common.texts(docs).withColumn("text_key", F.xxhash64("text"))
    found = texts.withColumn("base", base_spans(F.col("text")))
    spans = F.transform("base", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")
    ))
    holds = F.size("base") > 0
    base = common.written(found.select(
        "doc_id", "text_key", spans.alias("base"),
        F.array_distinct(F.transform("base", _entity)).alias("entities"),
        F.when(holds, F.unhex(F.md5("text"))).alias("digest"),
        F.when(holds, F.col("text")).alias("text"),
    ), "pii-base")
    holders = common.written(_holders(base), "pii-holders")
    n_docs = base.count()
    pairs = common.written(_pairs(found, holders, n_docs), "pii-pairs")
    revealed = pairs.join(disclosing(pairs, n_docs), ["entity", "term"]).groupBy("digest").agg(
        F.collect_set("term").alias("terms")
    )
    outside = holders.select(
        "digest", _outside(F.col("text"), F.col("base")).alias("outside")
    ).join(revealed, "digest")
    placed = outside.select(
        F.col("digest").alias("key"), _places(F.col("outside"), F.col("terms")).alias("places")
    )
    named = F.transform(F.coalesce("places", F.array()), lambda t: F.struct(
        F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")
    ))
    # Rows without an entity have no digest; a key of their own spreads them over the tasks.
    spread = F.unhex(F.md5(F.monotonically_increasing_id().cast("string")))
    row_key = F.coalesce("digest", spread)
    return base.drop("text").withColumn("row_key", row_key).join(
        placed, F.col("row_key") == F.col("key"), "left"
    ).select("doc_id", "text_key", F.concat("base", named).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span generalised to its kind's label; of overlapping ones the first."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
    )))

    def put(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        replaced = F.concat(state["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        free = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(free, replaced).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(by_place, start, put, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))
    ))
