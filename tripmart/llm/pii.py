"""Information-theoretic sanitisation of personal data, in DataFrame and SQL functions only.

Patterns find the protected entities (base spans). How much a term reveals an entity is
estimated from the corpus: over all documents, ``df(e)`` hold the entity, ``df(t)`` the term
and ``df(e, t)`` both, wherever in the document they stand. The term discloses

    PMI(e; t) / IC(e),  PMI = log2(n * df(e, t) / (df(e) * df(t))),  IC = log2(n / df(e))

of the entity's information: 1 if it stands in no document without it. In documents that hold
the entity, every occurrence of a term that discloses ``remove_at`` of it is removed, and from
``generalise_at`` on it is replaced by a general word; base spans are always replaced by their kind. A pair needs
``min_documents`` documents, copies included: every word of a single document would tell of
an entity in it. Documents without an entity are left alone.

Texts are read once for the mentions (checkpointed: only documents with mentions carry their
text and the hashes of their terms) and once for the document frequencies of all terms, which
are summed per task before they are shuffled, by 64-bit hash. Entities and terms meet as narrow
rows: entities held by the same documents as one class, and only terms rare enough to reach the
lower threshold, which changes no result. An entity of any frequency is handled by partial sums
and by equi-joins that adaptive execution can split.

Positions come from splitting the text at the pattern and adding up the lengths of pieces
and matches, so they are code points. The patterns are those of the contract with
possessive quantifiers and anchors that change no match but keep long runs linear.

Defined cases: null and empty texts have no spans; rows that repeat id and text get the same
spans each; a term that tells of several entities is one span, and none where it overlaps a base span; an empty table gives
no rows; columns other than id and text are only carried where whole rows are returned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free, same, splittable

#: fixed values: the kinds in order
KINDS = ("email", "ip", "card", "phone")
#: each kind's cheap test and its pattern. Email: a run of local characters is tried from its start (or
#: from the last match) only; card: a chain of digits of 16 to 19 that no further digit continues.
TESTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
SPANS = "array<struct<start:int,stop:int,value:string>>"


@dataclass(frozen=True)
class Sanitising:
    min_documents: int = 2
    generalise_at: float = 0.75
    remove_at: float = 0.95
    general_word: str = "[TERM]"


def located(text: Column, pattern: str, taken: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """Matches (those ``taken``) with their code-point positions (the end exclusive)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["0"])
        end = begin + F.length(F.coalesce(x["1"], F.lit("")))
        span = F.array(F.struct(begin.alias("start"), end.alias("stop"), x["1"].alias("value")))
        return F.struct(end.alias("at"), F.when(x["1"].isNotNull() & taken(x["1"]), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def shifted(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["stop"] + acc["at"]).alias("stop"), s["value"].alias("value")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    def placed(both: Column) -> Column:
        """Positions within blocks of as many matches as there are blocks, then the blocks': no long array grows by one."""
        size = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(both))).cast("int"))
        first = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(both) - 1) / size).cast("int")), lambda b: F.aggregate(F.slice(both, b * size + 1, size), first, add))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out")), shifted, lambda acc: F.flatten(acc["out"]))

    return F.transform(F.array(F.arrays_zip(pieces, found)), placed)[0]


def boxes(spans: Column) -> Column:
    """The spans in order, as many to a box as there are boxes, with each box's first start and last stop."""
    size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(spans))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(spans) / size).cast("int")), lambda b: F.slice(spans, b * size + 1, size))
    return F.transform(blocks, lambda x: F.struct(F.array_min(F.transform(x, lambda s: s["start"])).alias("start"), F.array_max(F.transform(x, lambda s: s["stop"])).alias("stop"), x.alias("spans")))


def overlaps(held: Column, word: Column) -> Column:
    """Whether a span of the boxes overlaps the word; only boxes that do are looked into."""

    def meets(s: Column) -> Column:
        return (s["start"] < word["stop"]) & (word["start"] < s["stop"])

    return F.exists(held, lambda box: F.coalesce(meets(box), F.lit(False)) & F.exists(box["spans"], meets))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, -place, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match is of its kind."""
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return passes_luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def row_key(text: Column) -> Column:
    return F.xxhash64(text)


def term_key(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def terms_in(text: Column) -> Column:
    """The distinct terms of a text, as hashes."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), term_key))


def entities_in(found: DataFrame) -> DataFrame:
    """(row, entity): one row for each entity that a row holds."""
    return found.where(F.size("spans") > 0).select("row", F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity"))


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, row_key, spans, terms, text): base spans by kind, then start; terms and text of rows with a span.

    ``row`` numbers the rows; cut the result before it is read twice.
    """
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    out = out.withColumn("row_key", row_key(F.col("text")))
    for kind in KINDS:
        test = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(TESTS[kind])
        out = out.withColumn(kind, F.when(test, located(F.col("text"), PATTERNS[kind])))

    def named(kind: str) -> Column:
        kept = F.filter(F.coalesce(F.col(kind), F.array().cast(SPANS)), lambda s: holds(kind, s["value"]))
        plain = F.lower if kind == "email" else (lambda v: v) if kind == "ip" else digits
        return F.transform(kept, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), F.xxhash64(F.lit(kind), plain(s["value"])).alias("entity")))

    out = out.select("doc_id", "row_key", "text", F.concat(*(named(k) for k in KINDS)).alias("spans"))

    some = F.size("spans") > 0
    return out.select(F.monotonically_increasing_id().alias("row"), "doc_id", "row_key", "spans", F.when(some, terms_in(F.col("text"))).alias("terms"), F.when(some, F.col("text")).alias("text"))


def entity_classes(found: DataFrame, how: Sanitising = Sanitising()) -> DataFrame:
    """(entity, stands, with_entity) of the entities that enough rows hold, but not all: those held by the same rows (as many, of
    equal hash sums) disclose alike, so the smallest stands for its class."""
    held = entities_in(found).groupBy("entity").agg(
        F.count(F.lit(1)).alias("with_entity"), F.bit_xor(F.xxhash64("row")).alias("mix"), F.sum(F.xxhash64(F.lit(1), "row").cast("decimal(20,0)")).alias("total"))
    held = cut(held.where((F.col("with_entity") >= how.min_documents) & (F.col("with_entity") < found.count())))
    alike = ["with_entity", "mix", "total"]
    return held.join(splittable(held.groupBy(*alike).agg(F.min("entity").alias("stands"))), alike).select("entity", "stands", "with_entity")


def shared_terms(docs: DataFrame, found: DataFrame, classes: DataFrame, how: Sanitising, least: float, text: str) -> DataFrame:
    """(row, entity, with_entity, term, with_term) of all terms beside standing entities that can disclose ``least`` of them.

    As df(e, t) <= df(e), only terms with df(t) <= n (df(e) / n)^least can; all others are dropped before entities and
    terms of a row meet, first by the most frequent entity's bound, then by each entity's own.
    """
    n = found.count()

    def bound(with_entity: Column) -> Column:
        return F.pow(with_entity / float(n), F.lit(least)) * n * (1 + 1e-9)

    stands = classes.where("entity = stands").select("entity", "with_entity")
    most = stands.agg(F.max(bound(F.col("with_entity")))).first()[0] or 0.0
    of_term = docs.select(F.explode(terms_in(F.col(text).cast("string"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    of_term = of_term.where((F.col("with_term") >= how.min_documents) & (F.col("with_term") <= F.lit(most)))
    terms = found.where(F.size("spans") > 0).select("row", F.explode("terms").alias("term")).join(splittable(of_term), "term")
    beside = entities_in(found).join(splittable(stands), "entity")
    return beside.join(terms, "row").where(F.col("with_term") <= bound(F.col("with_entity"))).select("row", "entity", "with_entity", "term", "with_term")


def disclosed(shared: DataFrame, n: int, how: Sanitising) -> DataFrame:
    """(entity, term, disclosure) of the pairs that enough rows share."""
    pairs = shared.groupBy("entity", "with_entity", "term", "with_term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= how.min_documents)
    pmi = F.log2(F.lit(float(n)) * F.col("both") / (F.col("with_entity").cast("double") * F.col("with_term")))
    information = F.log2(F.lit(float(n)) / F.col("with_entity"))
    return pairs.select("entity", "term", (pmi / information).alias("disclosure"))


def disclosures(docs: DataFrame, found: DataFrame, how: Sanitising = Sanitising(), text: str = "text", least: float = 0.0) -> DataFrame:
    """(entity, term, disclosure) of every pair with enough support, over all documents; of those below ``least``, some are left out."""
    classes = cut(entity_classes(found, how))
    per_class = disclosed(shared_terms(docs, found, classes, how, least, text), found.count(), how)
    return per_class.withColumnRenamed("entity", "stands").join(classes, "stands").select("entity", "term", "disclosure")


def sanitising_spans(docs: DataFrame, how: Sanitising = Sanitising(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, spans, term_spans) of every row; term_spans have start, stop and ``remove``."""
    found = cut(mentions(docs, doc_id, text))
    shared = cut(shared_terms(docs, found, cut(entity_classes(found, how)), how, how.generalise_at, text))
    telling = disclosed(shared, found.count(), how).where(F.col("disclosure") >= how.generalise_at).select("entity", "term", (F.col("disclosure") >= how.remove_at).alias("remove"))
    once = shared.join(splittable(telling), ["entity", "term"]).groupBy("row", "term").agg(F.max("remove").alias("remove"))
    of_row = once.groupBy("row").agg(F.collect_list("term").alias("telling"), F.collect_list(F.when(F.col("remove"), F.col("term"))).alias("removed"))
    rows = found.join(splittable(of_row), "row", "left")
    placed = F.transform(
        located(F.col("text"), TERM, lambda w: F.array_contains("telling", term_key(w))),
        lambda w: F.struct(w["start"].alias("start"), w["stop"].alias("stop"), F.array_contains("removed", term_key(w["value"])).alias("remove")),
    )
    apart = F.transform(F.array(boxes(F.col("spans"))), lambda held: F.filter(placed, lambda w: ~overlaps(held, w)))[0]
    none = F.array().cast("array<struct<start:int,stop:int,remove:boolean>>")
    return rows.select("doc_id", "row_key", "spans", F.when(F.col("telling").isNull(), none).otherwise(apart).alias("term_spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text."""
    base = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    terms = F.transform("term_spans", lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["stop"]))
    return found.select(
        "doc_id", *(_count(k) for k in KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, terms), ",").alias("spans"),
        F.size("term_spans").cast("long").alias("n_terms"), F.size(F.filter("term_spans", lambda s: s["remove"])).cast("long").alias("n_removed"),
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def sanitise(docs: DataFrame, how: Sanitising = Sanitising(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with sanitised texts: base spans as ``[KIND]``, telling terms generalised or removed; a null text stays null."""
    found = sanitising_spans(docs, how, doc_id, text).where((F.size("spans") > 0) | (F.size("term_spans") > 0))
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by")))
    terms = F.transform("term_spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.when(s["remove"], "").otherwise(how.general_word).alias("by")))
    own_id, own_key, made = free(docs, "found_id", "found_key", "changes")
    changes = found.select(F.col("doc_id").alias(own_id), F.col("row_key").alias(own_key), F.array_sort(F.concat(base, terms)).alias(made)).dropDuplicates([own_id, own_key])
    whole = F.col(text).cast("string")

    def change(acc: Column, c: Column) -> Column:
        before = F.substring(whole, acc["at"] + 1, c["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], c["stop"]).alias("at"), F.when(c["start"] >= acc["at"], F.concat(acc["out"], before, c["by"])).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(made, zero, change, lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.length(whole))))
    joined = docs.join(splittable(changes), same(F.col(doc_id).cast("long"), F.col(own_id)) & (row_key(F.coalesce(whole, F.lit(""))) == F.col(own_key)), "left")
    return joined.withColumn(text, F.when(F.col(made).isNull(), whole).otherwise(clean)).select(*docs.columns)
