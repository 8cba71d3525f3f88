"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Patterns find the protected entities: e-mail and network addresses, card and
phone numbers. The corpus then tells which ordinary terms give an entity away.
Everything is counted in one unit, documents, of which exact and near copies are one:
the pointwise mutual information of a term and an entity that a document holds,
log(p(t, e) / (p(t) p(e))), is compared with the entity's information, -log p(e),
which it reaches when the term never occurs without the entity. Terms that
disclose more than ``REMOVE`` of it are removed from the documents that hold the
entity, those above ``GENERALISE`` are replaced by a general word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import components

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("removed", "term")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": "[REMOVED]", "term": "[NAME]"}
#: A document's sketch: the least hashes of its shingles of three words. Near copies agree in two of the ``PROBES`` least and
#: in so much of the sketch.
SKETCH, PROBES, ALIKE = 64, 5, 0.8
#: A pair of term and entity counts from so many documents on.
SUPPORT = 3
GENERALISE, REMOVE = 0.85, 0.95
TERM = "\\p{L}{2,}"

# Patterns. Quantifiers are possessive and a run is entered at its start (or where the former match ended), which finds
# the same matches as plain greedy ones but never backtracks or recurses over very long runs.
_LOCAL = "A-Za-z0-9._%+-"
_PATTERNS = {
    "email": f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_MARK = "\x01"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the check: from the right every second one doubled, less 9 above 9, sum divisible by 10."""
    digits = F.reverse(_digits(value))

    def weighed(at: Column) -> Column:
        digit = F.substring(digits, at, F.lit(1)).cast("int")
        return F.when(at % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda total, x: total + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$")
    count = F.length(_digits(value))
    if kind == "card":
        return F.when(count.between(12, 19), _luhn(value)).otherwise(False)
    return count.between(9, 15)


def _normal(kind: str, value: Column) -> Column:
    return F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)


def _marked_spans(text: Column, pattern: str | Column, kind: str | Column, order: Column, valid, value) -> Column:
    """Spans of a pattern's matches: they are set between marks, the text is split there, and lengths are summed up."""
    safe = F.translate(text, _MARK, "?")  # neither character belongs to any pattern
    pieces = F.split(F.regexp_replace(safe, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK)
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece)
        span = F.struct(state["at"].alias("start"), order.alias("order"), end.alias("end"), kind.alias("kind"), value(piece).alias("value"))
        found = F.when((state["n"] % 2 == 1) & valid(piece), F.concat(state["found"], F.array(span.cast(SPAN)))).otherwise(state["found"])
        return F.struct((state["n"] + 1).alias("n"), end.alias("at"), found.alias("found"))

    return F.aggregate(pieces, start, step, lambda state: state["found"])


SPAN = "struct<start:bigint,order:int,end:bigint,kind:string,value:string>"


def base_spans(text: Column) -> Column:
    """All valid matches of the patterns, by start and then kind, as an array of ``SPAN``; offsets in code points, end exclusive."""
    none = F.array().cast(f"array<{SPAN}>")
    worth = {"email": F.contains(text, F.lit("@")), "ip": F.contains(text, F.lit(".")), "card": F.lit(True), "phone": F.contains(text, F.lit("+"))}
    found = [
        F.when(worth[kind], _marked_spans(text, _PATTERNS[kind], kind, F.lit(order), lambda p, k=kind: _valid(k, p), lambda p, k=kind: _normal(k, p)))
        .otherwise(none) for order, kind in enumerate(KINDS)]
    return F.sort_array(F.concat(*found))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _key(text: str = "text") -> list[Column]:
    return [F.xxhash64(text).alias("_h1"), F.hash(text).alias("_h2"), F.length(text).alias("_h3")]


_KEY = ["_h1", "_h2", "_h3"]


def _sketch(text: Column) -> Column:
    """The least hashes of the text's distinct shingles; fewer than three words are one shingle."""
    words = F.transform(F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}@]+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    shingle = lambda all_, w, at: F.when((at == 0) | (at + 2 < F.size(all_)), F.xxhash64(w, F.get(all_, at + 1), F.get(all_, at + 2)))
    # inside the outer transform the words are a variable; the expression itself would be evaluated again for each of them
    hashes = F.transform(F.array(words), lambda all_: F.transform(all_, lambda w, at: shingle(all_, w, at)))
    return F.slice(F.sort_array(F.array_distinct(F.array_compact(F.flatten(hashes)))), 1, SKETCH)


def _with_spans(docs: DataFrame) -> DataFrame:
    """``_row, doc_id``, the text's key, its base spans, the entities and terms it holds, and its sketch."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", base_spans(F.col("text")).alias("spans"))
    held = F.array_distinct(F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"))))
    terms = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    return written(rows.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", *_key(), "spans", held.alias("held"), terms.alias("terms"),
        _sketch(F.col("text")).alias("sketch")), "pii-spans")


def _units(spans: DataFrame) -> DataFrame:
    """``_row, unit`` per distinct text, of which the first row stands for all; near copies share a ``unit``.

    Texts that agree in two of their least shingle hashes are compared with the first that does, by how much of
    the least hashes of both together they share.
    """
    texts = written(spans.groupBy(*_KEY).agg(F.min("_row").alias("_row"), F.first("sketch").alias("sketch")).select("_row", "sketch"), "pii-sketches")
    least = F.col("sketch")
    two = [F.when(F.size(least) > j, F.xxhash64(F.get(least, F.lit(i)), F.get(least, F.lit(j)))) for j in range(PROBES) for i in range(j)]
    whole = F.when(F.size(least) > 0, F.xxhash64(least))
    probes = texts.select("_row", F.explode(F.array_compact(F.array(whole, *two))).alias("probe"))
    first = probes.groupBy("probe").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("probe", "first")
    likely = probes.join(first, "probe").where("_row != first").select(F.col("_row").alias("a"), F.col("first").alias("b")).distinct()
    own = texts.select(F.col("_row").alias("a"), F.col("sketch").alias("sa"))
    other = texts.select(F.col("_row").alias("b"), F.col("sketch").alias("sb"))
    both = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    shared = F.size(F.array_intersect(both, F.array_intersect("sa", "sb")))
    near = likely.join(own, "a").join(other, "b").where(shared >= ALIKE * F.size(both)).select("a", "b")
    classes = components(near).select(F.col("node").alias("_row"), "root")
    return written(texts.select("_row").join(classes, "_row", "left").select("_row", F.coalesce("root", "_row").alias("unit")), "pii-units")


def disclosing_terms(spans: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame | None:
    """``kind, value, term, level``: the terms that give an entity away, or None when no entity has the support.

    Copies of a document, exact or near, count once for entities, terms, pairs and
    the total alike. A term and an entity meet wherever in a document they stand.
    Pairs are made in the documents that hold an entity only. There, too frequent
    terms are seen already: in all documents they are no rarer. Only the terms left
    are counted everywhere, so the terms of the corpus are never shuffled.
    """
    units = _units(spans)
    holding = written(spans.where(F.size("held") > 0).select("_row", "held", "terms").join(units, "_row"), "pii-holding")
    held = holding.select("unit", F.explode("held").alias("h")).select("unit", "h.kind", "h.value").distinct()
    entities = held.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= support)
    held = written(held.join(entities, ["kind", "value"]), "pii-held")
    if held.isEmpty():
        return None
    total = float(units.select("unit").distinct().count())
    lowest = min(generalise, remove)

    def share(n_term: str) -> Column:
        """How much of the entity's information the term gives, if it is in ``n_term`` documents."""
        own = F.log(F.lit(total) / F.col("n_entity"))
        return F.when(own > 0, F.log(F.col("n_both") * F.lit(total) / (F.col(n_term) * F.col("n_entity"))) / own).otherwise(0.0)

    within = holding.select("unit", F.explode("terms").alias("term")).distinct()
    met = within.join(held, "unit").groupBy("kind", "value", "term", "n_entity").agg(F.count(F.lit(1)).alias("n_both")).where(F.col("n_both") >= support)
    beside = within.groupBy("term").agg(F.count(F.lit(1)).alias("n_beside"))
    pairs = written(met.join(beside, "term").where(share("n_beside") >= lowest - 1e-9), "pii-pairs")
    terms = written(pairs.select("term").distinct(), "pii-candidates")
    everywhere = spans.select("_row", F.explode("terms").alias("term")).join(terms, "term").join(units, "_row").select("unit", "term").distinct()
    counted = everywhere.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    level = F.when(share("n_term") >= remove, TERM_KINDS[0]).when(share("n_term") >= generalise, TERM_KINDS[1])
    return written(pairs.join(counted, "term").select("kind", "value", "term", level.alias("level")).where("level is not null"), "pii-terms")


def _terms_of_texts(spans: DataFrame, terms: DataFrame) -> DataFrame:
    """The text's key and the terms to hide in it; removal wins over generalising."""
    held = spans.select(*_KEY, F.explode("held").alias("h")).select(*_KEY, "h.kind", "h.value").distinct()
    levels = held.join(terms, ["kind", "value"]).groupBy(*_KEY, "term").agg(F.min("level").alias("level"))
    of = lambda level: F.sort_array(F.collect_list(F.when(F.col("level") == level, F.col("term"))))
    return written(levels.groupBy(*_KEY).agg(of(TERM_KINDS[0]).alias("_removed"), of(TERM_KINDS[1]).alias("_generalised")), "pii-texts")


def _term_spans(text: Column, base: Column) -> Column:
    """Spans of the terms in ``_removed`` and ``_generalised`` (letters only) as whole words outside the base spans."""
    found = []
    for order, (kind, column) in enumerate(zip(TERM_KINDS, ("_removed", "_generalised")), len(KINDS)):
        pattern = F.concat(F.lit("(?iu)(?<![\\p{L}\\p{N}])(?:"), F.array_join(column, "|"), F.lit(")(?![\\p{L}\\p{N}])"))
        spans = _marked_spans(text, pattern, kind, F.lit(order), lambda p: F.lit(True), F.lower)
        found.append(F.when(F.size(column) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>")))
    free = F.filter(F.concat(*found), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.sort_array(F.concat(base, free))


def find(docs: DataFrame, **thresholds) -> DataFrame:
    """``doc_id, base, spans`` per row of ``docs``: the base spans, and with them those of disclosing terms.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text
    is empty and has no spans. Rows are told apart by their texts, so repeated or
    null ids do no harm and equal texts have equal spans. An empty table gives no
    rows.
    """
    spans = _with_spans(docs)
    terms = disclosing_terms(spans, **thresholds)
    plain = F.col("spans").alias("base"), F.col("spans")
    if terms is None:
        return spans.select("doc_id", *plain)
    texts = _terms_of_texts(spans, terms)
    rows = spans.select("doc_id", *_KEY, "spans")
    source = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("text", *_key())
    source = source.join(texts, _KEY).dropDuplicates(_KEY)  # only texts that hold a disclosing term
    added = source.select(*_KEY, "text", "_removed", "_generalised").join(rows.dropDuplicates(_KEY).select(*_KEY, "spans"), _KEY).select(
        *_KEY, _term_spans(F.col("text"), F.col("spans")).alias("_all"))
    return rows.join(added, _KEY, "left").select("doc_id", F.col("spans").alias("base"), F.coalesce("_all", "spans").alias("spans"))


def hide(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the label of its first."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    label = lambda s: reduce(lambda c, k: c.when(s["kind"] == k, LABELS[k]), KINDS[1:] + TERM_KINDS, F.when(s["kind"] == KINDS[0], LABELS[KINDS[0]]))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        fresh = F.concat(state["parts"], F.array(between, label(span)))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.when(span["start"] >= state["at"], fresh).otherwise(state["parts"]).alias("parts"))

    rest = lambda state: F.concat(F.array_join(state["parts"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """The rows of ``docs`` with personal data and disclosing terms hidden in ``text``; other columns stay as they are.

    Null texts stay null, empty ones empty; equal texts are hidden alike, so repeated
    rows and null or repeated ids do no harm. An empty table gives no rows.
    """
    columns = {name: f"_c{at}" for at, name in enumerate(docs.columns)}
    own = docs.toDF(*columns.values())
    text = F.col(columns["text"]).cast("string")
    keyed = own.select(F.col(columns["doc_id"]).alias("doc_id"), text.alias("text"))
    spans = _with_spans(keyed)
    terms = disclosing_terms(spans, **thresholds)
    if terms is None:
        hidden = own.withColumn("_text", hide(text, base_spans(text)))
    else:
        full = own.withColumn("_plain", F.coalesce(text, F.lit(""))).select("*", *_key("_plain"))
        joined = full.join(_terms_of_texts(spans, terms), _KEY, "left").withColumn("_spans", base_spans(F.col("_plain")))
        every = F.when(F.col("_removed").isNotNull(), _term_spans(F.col("_plain"), F.col("_spans"))).otherwise(F.col("_spans"))
        hidden = joined.withColumn("_text", F.when(text.isNotNull(), hide(F.col("_plain"), every)))
    return hidden.select(*[F.col("_text" if name == "text" else own_name).alias(name) for name, own_name in columns.items()])
