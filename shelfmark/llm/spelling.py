"""Spelling variants of a corpus's words, grouped under their frequent form.

Words at one edit from each other are found by asymmetric q-chunks: the longer of the two
(of equal lengths the smaller) gives two disjoint chunks that make up the whole word, the
other one positional grams of the chunks' lengths. One edit leaves a chunk whole, and that
chunk is a gram of the other word at most one place further on. DataFrame functions only.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..checkpoints import materialise

#: Words of fewer code points, or of fewer occurrences, are left out.
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form has so many times the occurrences of the word.
RATIO = 10
#: A group of equal chunks is joined if it makes at most so many pairs; a larger one is split further.
PAIRS = 4096
# What a word is made of, and the letters that are lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", typo_every: int | None = 31,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, with their occurrences.

    With ``typo_every`` a run loses one letter wherever that number divides the CRC-32 of
    ``doc_id:run``; the rest of the CRC says which. Occurrences are added up in each task
    before they meet. NULL and empty texts have no words; a NULL id counts as the empty
    text.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0))
    run = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run"))
    # Lower-casing changes the same letters where there are no others, and is faster.
    small = F.when(F.octet_length("_run") == F.length("_run"), F.lower("_run")).otherwise(
        F.translate("_run", CAPITALS, SMALL))
    run = run.filter(F.length("_run") >= min_length).select("_id", small.alias("word"))
    if typo_every:
        hashed = run.withColumn("_hash", F.crc32(F.concat("_id", F.lit(":"), "word")))
        place = F.pmod(F.col("_hash"), F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word")))
        run = hashed.select(F.when(F.col("_hash") % typo_every == 0, shorter).otherwise(F.col("word")).alias("word"))
    counted = run.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # One condition that needs the count: by itself the length would be asked of every occurrence, made a second time.
    return counted.filter(F.when(F.col("n") >= min_count, F.length("word") >= min_length).otherwise(False))


def _whole(words: DataFrame) -> DataFrame:
    """Each word once as the one that is cut into chunks, and twice as the one that gives grams.

    ``shorter`` is by how much it is shorter than the word cut into chunks: 0 or 1.
    """
    sides = F.expr("array(struct(true AS cut, 0 AS shorter), struct(false AS cut, 0 AS shorter), "
                   "struct(false AS cut, 1 AS shorter))")
    return words.select("word", "n", F.col("word").alias("rest"), F.lit(0).cast("long").alias("key"), F.inline(sides))


def _split(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first and with the second chunk in its key, and the rest of the word left to compare.

    A word shorter by one has the first chunk at its place and the second one place
    before it; other grams are beyond the shift that the lengths allow. What is left of
    both words is again one edit apart, by the same difference in length.
    """
    middle = rows.withColumn("length", F.length("rest") + F.col("shorter")).withColumn(
        "at", F.expr("length div 2").cast("int"))
    first = F.struct(F.lit(0).alias("chunk"), F.substring("rest", F.lit(1), F.col("at")).alias("gram"),
                     F.substring("rest", F.col("at") + 1, F.length("rest")).alias("rest"))
    at = F.col("at") - F.col("shorter")
    second = F.struct(F.lit(1).alias("chunk"), F.substring("rest", at + 1, F.length("rest")).alias("gram"),
                      F.substring("rest", F.lit(1), at).alias("rest"))
    both = middle.select("word", "n", "cut", "shorter", "key", "length", F.explode(F.array(first, second)).alias("one"))
    return both.select("word", "n", "cut", "shorter", F.col("one.rest").alias("rest"),
                       F.xxhash64("key", "length", "one.chunk", "one.gram").alias("key"))


def _verified(rows: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): words of equal keys that are one edit apart, ``a`` the longer or smaller."""
    cut = rows.filter("cut").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    grams = rows.filter("NOT cut").select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "shorter")
    met = cut.join(grams, "key").filter((F.col("shorter") == 1) | (F.col("a") < F.col("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, n_a, b, n_b): every two words (word, n) that one inserted, deleted or replaced code point parts, once.

    Words that share a chunk meet and are verified. A chunk that would make over
    ``pairs`` pairs is not joined: what is left of its words is cut into chunks in turn,
    which then have to agree as well, until the groups are small or a single code point is
    left, which no more words can fill than there are letters. So no group is ever paired
    off whole, and no pair is lost.
    """
    found, rows = [], _whole(words)
    while True:
        rows = materialise(_split(rows))
        groups = rows.groupBy("key").agg(F.count_if("cut").alias("cuts"), F.count_if(~F.col("cut")).alias("grams"),
                                         F.max(F.length("rest") + F.col("shorter")).alias("left"))
        large = materialise(groups.filter((F.col("cuts") * F.col("grams") > pairs) & (F.col("left") > 1)).select("key"))
        if large.isEmpty():
            found.append(_verified(rows))
            break
        found.append(_verified(rows.join(large, "key", "left_anti")))
        rows = rows.join(large, "key", "left_semi")
    return reduce(DataFrame.union, found).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): forms followed to the last.

    Each step multiplies the occurrences, so there are no circles and a chain has fewer
    steps than a count has digits. Words at their root leave the loop.
    """
    forms = materialise(forms)
    following = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    ends, open_words = [], forms.select("word", F.col("form").alias("root"))
    while True:
        moved = materialise(open_words.join(following, "root", "left"))
        ends.append(moved.filter("next IS NULL").select("word", "root"))
        open_words = moved.filter("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if open_words.isEmpty():
            return reduce(DataFrame.union, ends)


def group_words(words: DataFrame, ratio: int = RATIO, pairs: int = PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word (word, n); words must be distinct.

    ``n_near`` counts the words at one edit. The form is the most frequent of them, of
    equal ones the first in code-point order, if it has ``ratio`` times the occurrences;
    else NULL, as ``form_n`` is. The root is the last form that following forms leads to,
    the word itself if it has none. No words, no rows.
    """
    words = materialise(words.select("word", "n"))
    met = near_pairs(words, pairs)
    both = met.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        met.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    frequent = -F.col("best.less") >= F.col("n") * ratio
    formed = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")))
    roots = _roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", typo_every: int | None = 31,
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """The words of whole texts with their near words' number, form and root; see ``word_counts`` and ``group_words``.

    NULL and empty texts, a NULL id, repeated rows, runs of any length and an empty table
    have the results said there; columns other than the two named are not read.
    """
    return group_words(word_counts(docs, text, doc_id, typo_every, min_length, min_count), ratio)
