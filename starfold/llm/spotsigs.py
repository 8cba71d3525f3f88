"""SpotSigs fingerprints in DataFrame functions only.

Every common word (an anchor) starts a spot signature: the anchor and the chain of
content words that follow it, up to ``CHAIN`` of them or the next anchor. The set
of a text's signatures, hashed and sorted, is its fingerprint. Two fingerprints
are compared by their Jaccard likeness; the shorter set over the longer bounds it,
so sets are partitioned by length and only neighbouring partitions meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .components import components

#: Common words of the languages at hand, by language.
ANCHORS = {
    "de": ("auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "in", "ist", "mit", "nicht", "sich", "und", "von", "zu"),
    "en": ("a", "an", "and", "are", "as", "at", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with"),
    "es": ("con", "de", "del", "el", "en", "la", "las", "los", "para", "por", "que", "se", "un", "una", "y"),
    "fr": ("au", "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pour", "que", "qui", "sur", "un", "une"),
}
CHAIN = 3
SIMILARITY = 0.8


def signatures(text: Column, anchors=None, chain: int = CHAIN) -> Column:
    """The sorted distinct 32-bit hashes of a text's spot signatures.

    A text without any has one, the hash of all its words in order; a null text or
    one without words has none. Words are runs of letters and digits in lower case.
    """
    words = sorted({w for own in (anchors or ANCHORS).values() for w in own})
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", "  "), F.lit(" "))
    marked = F.regexp_replace(padded, " (" + "|".join(words) + ") ", "\x01$1 ")
    whole = F.trim(F.regexp_replace(padded, " +", " "))
    spots = F.transform(F.split(marked, "\x01"), lambda s: F.trim(F.regexp_replace(s, " +", " ")))
    chains = F.filter(F.transform(spots, lambda s: F.substring_index(s, " ", chain + 1)), lambda s, at: (at > 0) & F.contains(s, F.lit(" ")))
    found = F.when(F.size(chains) > 0, chains).when(whole != "", F.array(whole)).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: F.substring(F.md5(s), 1, 8))))


def fingerprint(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def likeness(left: Column, right: Column) -> Column:
    """Jaccard likeness of two sets of signatures; two empty ones are alike."""
    both = F.size(F.array_intersect(left, right)).cast("double")
    return F.when((F.size(left) == 0) & (F.size(right) == 0), 1.0).otherwise(both / (F.size(left) + F.size(right) - both))


#: Rows of a bucket of neighbours, about, and the most buckets.
BUCKET_ROWS, BUCKETS = 4096, 4096


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its fingerprint, that of an edited text, and its likeness to that and to the next document's.

    The next document is the one of the next smaller ``doc_id`` (null ids come
    last, equal ids by their text's hash), after the last the first. In the edited text the
    last third of the characters is replaced by the first as many of the next
    document. ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A
    null text is empty. A single row is its own next document. An empty table gives
    no rows.

    Texts are shuffled once, into buckets of neighbouring ids that a window sorts
    and that spill. The first document of a bucket also joins the bucket before it
    as a guest, to be the next one of its last.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = rows.count()
    buckets = max(1, min(BUCKETS, count // BUCKET_ROWS))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 20 * buckets).alias("b")).first()["b"] if shares else []
    bounds = sorted(set(bounds or []), reverse=True)

    def bucket(doc_id: Column) -> Column:
        """How many bounds lie above the id: 0 for the largest ids; null ids go to a bucket of their own at the end."""
        above = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b > doc_id)) if bounds else F.lit(0)
        return F.when(doc_id.isNull(), len(bounds) + 1).otherwise(above)

    order = [F.col("doc_id").desc_nulls_last(), F.col("_hash"), F.col("text")]
    placed = rows.select("*", bucket(F.col("doc_id")).alias("_bucket"), F.xxhash64("text").alias("_hash"))
    # the first of each bucket: one narrow row per bucket
    first = placed.groupBy("_bucket").agg(F.min(F.struct((-F.col("doc_id")).alias("d"), F.col("_hash").alias("h"))).alias("f")).orderBy("_bucket").collect()
    keys = [(r["_bucket"], None if r["f"]["d"] is None else -r["f"]["d"], r["f"]["h"]) for r in first]
    if not keys:
        keys = [(0, None, 0)]
    before = docs.sparkSession.createDataFrame(
        [(keys[at - 1][0], doc_id, hashed) for at, (_, doc_id, hashed) in enumerate(keys)], "_to int, _id bigint, _h bigint")
    guests = rows.withColumn("_hash", F.xxhash64("text")).join(
        F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))  # one row per bucket
    guests = guests.dropDuplicates(["_to"]).select("doc_id", "text", F.col("_to").alias("_bucket"), "_hash", F.lit(True).alias("_guest"))
    here = placed.select("doc_id", "text", "_bucket", "_hash", F.lit(False).alias("_guest")).union(guests)
    window = Window.partitionBy("_bucket").orderBy("_guest", *order)
    text, n = F.col("text"), F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), n - third), F.substring(F.lead("text").over(window), F.lit(1), third))
    signed = here.select("doc_id", "text", "_bucket", "_hash", "_guest", edited.alias("_edited"), n.cast("bigint").alias("n_chars"), signatures(text).alias("_own"))
    followed = signed.withColumn("_next", F.lead("_own").over(window)).where(~F.col("_guest"))
    printed = followed.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "_own", "_next", signatures(F.col("_edited")).alias("_changed"))
    return printed.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("_own")).alias("fingerprint"),
        fingerprint(F.col("_changed")).alias("edited_fingerprint"), likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, fingerprint_id, class_id``: documents whose signature sets reach the similarity, joined into classes.

    Equal fingerprints meet first, so copies cost no comparisons. A set can only
    reach the similarity with one whose length lies in the same or the next
    partition of lengths (their bounds grow by 1 / similarity) and with which it shares
    one of its rarest signatures; candidates are then compared exactly. Null texts and texts
    without words have no signatures and are alike. ``class_id`` is the least
    ``doc_id`` reachable. An empty table gives no rows.
    """
    rows = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), signatures(F.col("text").cast("string")).alias("sigs")).select(
        "doc_id", F.xxhash64("sigs").alias("fingerprint_id"), "sigs"), "spots")
    sets = written(rows.groupBy("fingerprint_id").agg(F.min("doc_id").alias("_first"), F.first("sigs").alias("sigs"), F.first(F.size("sigs")).alias("n")), "spot-sets")
    each = sets.select("fingerprint_id", "n", F.explode("sigs").alias("sig"))
    common = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    rare = each.join(common, "sig").groupBy("fingerprint_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("_o"))
    prefix = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / similarity))
    probes = rare.select("fingerprint_id", "n", part.alias("part"), F.explode(F.slice("_o", F.lit(1), prefix.cast("int"))["sig"]).alias("sig"))
    left = probes.select(F.col("fingerprint_id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = probes.select(F.col("fingerprint_id").alias("b"), F.col("n").alias("nb"), "sig", "part")
    longer = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = left.join(right, ["sig", "part"]).where(longer & (F.col("na") >= F.col("nb") * similarity - 1e-9)).select("a", "b").distinct()
    own = sets.select(F.col("fingerprint_id").alias("a"), F.col("sigs").alias("sa"))
    other = sets.select(F.col("fingerprint_id").alias("b"), F.col("sigs").alias("sb"))
    near = pairs.join(own, "a").join(other, "b").where(likeness(F.col("sa"), F.col("sb")) >= similarity).select("a", "b")
    roots = components(near)
    named = sets.join(roots, sets.fingerprint_id == roots.node, "left").select(
        "fingerprint_id", "_first", F.coalesce("root", "fingerprint_id").alias("root"))
    least = named.groupBy("root").agg(F.min("_first").alias("class_id"))
    return rows.select("doc_id", "fingerprint_id").join(named.join(least, "root").select("fingerprint_id", "class_id"), "fingerprint_id", "left").select(
        "doc_id", "fingerprint_id", "class_id")
