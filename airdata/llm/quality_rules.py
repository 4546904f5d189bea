"""Quality rules: base rules and a hashed n-gram likelihood ratio, in native expressions.

The n-grams of a text are the character runs at the edges of its words (the
first three and the last three characters, or the whole of a shorter word) and
its pairs of neighbouring words, these by their lengths alone or as "the same
word again". All these have vocabularies that stop
growing with the corpus, unlike words and word pairs, so a fixed number of
buckets holds them at every size, and what is learned from the trusted documents
also fits good documents that are not among them. Two multinomials over the
buckets, of the trusted documents and of the raw corpus, give each bucket a
log-likelihood ratio; a document's score is the mean over its n-grams, so it
doesn't depend on its length. Every document whose score lies under a fixed
threshold is rejected. Counting aggregates before the shuffle to one row a
bucket and task; the ratios, one whole number for each of the ``BUCKETS``
buckets, reach the second pass as one constant array, which shuffles nothing.

Texts without words have no n-grams and fail the base rules; very long texts
are taken whole; repeated rows are judged one by one (and counted each time);
empty tables give empty results; columns of any names go along in ``keep``.

Arrays are handed to higher-order functions as arguments only, never used inside
their lambdas: there they would be computed anew for each element.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airdata.llm.common import computed

#: Buckets of the hashed n-grams; added to every count.
BUCKETS, SMOOTHING = 1 << 16, 1.0
#: Characters of a run at the edge of a word.
RUN = 3
#: Ratios are summed as whole multiples of 1 / PLACES, so that no order of the sum matters.
PLACES = 100_000
#: Least mean log-likelihood ratio of a document that is kept.
THRESHOLD = -0.35
#: Base rules: least words, per cent of words in repeated windows, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: The white space that parts words, and the signs that count as symbols.
SPACE, SYMBOLS = "\t\n\x0b\x0c\r", "#*$%&|<>"


def spaced(text: Column) -> Column:
    """The text with every white-space character as a plain space."""
    for c in SPACE:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words_of(text_spaced: Column) -> Column:
    return F.array_remove(F.split(text_spaced, " "), "")


def without(text: Column, signs: str) -> Column:
    for c in signs:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def neighbours(a: Column, step: int, f) -> Column:
    """f(x[i], x[i + step]) for every i that has both; a: an array column."""
    n = F.greatest(F.size(a) - step, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + step), n), f)


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add _spaced, the text with plain spaces, and _words."""
    d = computed(docs, _spaced=spaced(F.coalesce(F.col(text), F.lit(""))))
    return computed(d, _words=words_of(F.col("_spaced")))


def pair_of(x: Column, y: Column) -> Column:
    """A number for a pair of words: by their lengths, -1 for the same word again."""
    length = lambda w: F.char_length(w).cast("long")
    return F.when(x == y, F.lit(-1).cast("long")).otherwise(length(x) * (1 << 31) + length(y))


def pairs() -> Column:
    """The numbers of the pairs of neighbouring words of a row of with_words."""
    return neighbours(F.col("_words"), 1, pair_of)


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def grams(buckets: int) -> Column:
    """The buckets of all n-grams, with repeats, of a row of with_words."""
    runs = [F.transform("_words", lambda w: bucket_of(F.substring(w, 1, RUN), buckets)), F.transform("_words", lambda w: bucket_of(F.right(w, F.lit(RUN)), buckets))]
    return F.concat(*runs, F.transform(pairs(), lambda x: bucket_of(x, buckets)))


def gram_rows(d: DataFrame, buckets: int, *columns: str) -> DataFrame:
    """The buckets of ``grams``, a row each, with some columns of d; no lambda, so that all of it is compiled."""
    words = d.select(*columns, F.inline(F.arrays_zip("_words", F.slice("_words", F.lit(2), F.size("_words")))).alias("_x", "_y"))
    x, y = F.col("_x"), F.col("_y")
    edges = [bucket_of(F.substring(x, 1, RUN), buckets), bucket_of(F.right(x, F.lit(RUN)), buckets)]
    found = words.select(*columns, F.explode(F.array(*edges, F.when(y.isNotNull(), bucket_of(pair_of(x, y), buckets)))).alias("bucket"))
    return found.filter("bucket is not null")  # the last word has no pair


def with_base(d: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to the result of with_words."""
    d = computed(d, _h2=neighbours(F.col("_words"), 1, lambda x, y: F.xxhash64(x, y)))
    t = F.coalesce(F.col(text), F.lit(""))
    d = computed(
        d, n_words=F.size("_words").cast("long"),
        word_chars=F.char_length(F.replace(F.col("_spaced"), F.lit(" "), F.lit(""))).cast("long"),
        n_symbols=(F.octet_length(t) - F.octet_length(without(t, SYMBOLS))).cast("long"),
        _lines=F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        # hashes of windows of 8 words, out of those of 2 and 4
        _h4=neighbours(F.col("_h2"), 2, lambda x, y: F.xxhash64(x, y)))
    d = computed(d, n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                 _h8=neighbours(F.col("_h4"), 4, lambda x, y: F.xxhash64(x, y)))
    # only documents that have a window twice go into the ordering of windows
    again = F.size(F.array_distinct("_h8")) < F.size("_h8")
    d = computed(d, _order=F.when(again, F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = computed(d, _at=F.sort_array(F.array_distinct(F.flatten(neighbours(
        F.col("_order"), 1, lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))))))
    steps = neighbours(F.col("_at"), 1, lambda x, y: F.least(y - x, F.lit(WINDOW)))
    repeat = F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda a, x: a + x)
    d = computed(d, n_repeat_words=F.coalesce(repeat, F.lit(0)).cast("long"))
    return computed(d, base_failed=(F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[int]:
    """By bucket, the log-likelihood ratio of trusted against all documents in units of 1 / PLACES.

    ``trusted``: the keys of the trusted documents (repeats and nulls count once
    and not at all). At most ``buckets`` rows reach the driver.
    """
    flag = trusted.select(F.col(key).alias("_key")).filter("_key is not null").distinct().withColumn("_trusted", F.lit(1))
    # the labels grow with the documents: one plan for all sizes
    d = docs.select(key, text).join(flag.hint("merge"), F.col(key) == F.col("_key"), "left")
    found = gram_rows(with_words(d.withColumn("_trusted", F.coalesce("_trusted", F.lit(0))), text), buckets, "_trusted")
    counts = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_trusted").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    shift = math.log((sum(raw) + smoothing * buckets) / (sum(target) + smoothing * buckets))
    return [round((math.log((t + smoothing) / (n + smoothing)) + shift) * PLACES) for n, t in zip(raw, target)]


def with_llr(d: DataFrame, found: list[int]) -> DataFrame:
    """Add llr, the mean ratio of the n-grams (null without any), to the result of with_words."""
    # ``found`` is of fixed size; folded into one constant array
    rated = F.split(F.lit(",".join(map(str, found))), ",").cast("array<int>")
    ratio = lambda x: F.get(rated, bucket_of(x, len(found)))
    of_words = F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + ratio(F.substring(w, 1, RUN)) + ratio(F.right(w, F.lit(RUN))))
    of_pairs = F.aggregate(pairs(), F.lit(0).cast("long"), lambda a, x: a + ratio(x))
    n = F.size("_words")  # each has two edges, all but the last a pair
    return computed(d, llr=F.when(n > 0, (of_words + of_pairs) / F.lit(PLACES) / (3 * n - 1)))


def _judge(d: DataFrame, docs: DataFrame, trusted: DataFrame, key: str, text: str, threshold: float, buckets: int, smoothing: float) -> DataFrame:
    """Add the columns of quality_rules to d, whose text is in the column ``text``; docs is the raw corpus."""
    d = with_llr(with_words(d, text), ratios(docs, trusted, key, text, buckets, smoothing))
    none = trusted.filter(F.col(key).isNotNull()).isEmpty()
    return with_base(d, text).withColumn("kept", ~F.col("base_failed") & (F.lit(none) | F.coalesce(F.col("llr") >= threshold, F.lit(False))))


def quality_rules(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                  buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """Judge every row of docs.

    Returns key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, llr (mean ratio of its n-grams; null without any) and kept:
    not base_failed and llr at or above the threshold. A null text has no words
    and fails the base rules, so it is never kept. Rows with equal keys are
    judged one by one. Without trusted documents the base rules alone decide.
    ``buckets``: how many the n-grams are hashed into.
    """
    d = _judge(docs.select(key, text), docs, trusted, key, text, threshold, buckets, smoothing)
    return d.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def keep(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns, whatever their names."""
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("text"))
    return _judge(d, docs.select(F.col(key).alias("_id"), F.col(text).alias("text")), trusted.select(F.col(key).alias("_id")), "_id", "text", threshold, buckets, smoothing).filter("kept").select("_row.*")
