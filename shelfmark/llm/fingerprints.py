"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

DataFrame functions only.
"""

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A line longer than the first is cut past it, before the second: at the end of a sentence, else of a word.
PARAGRAPH_CHARS, LONGEST_PARAGRAPH = 160, 320
#: The same for a text's first paragraph, which is kept short: a short text shares its beginning with its versions.
FIRST_CHARS, LONGEST_FIRST = 16, 48
#: A sketch has TABLES * SLOTS cells; a digest goes to one cell of each table.
TABLES, SLOT_BITS = 3, 3
SLOTS = 1 << SLOT_BITS
CELLS = TABLES * SLOTS
#: Each retry has GROWTH times the cells of the one before; the last tells some 200,000 differing digests apart.
GROWTH, RETRIES = 4, 7
#: Sampled ids for each range of ids that a task works on.
SAMPLED = 100


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of the text's paragraphs: its lines, long ones cut.

    No paragraph is longer than ``LONGEST_PARAGRAPH`` characters, the first no longer than
    ``LONGEST_FIRST`` beside line breaks before it. So texts that begin with the same 49
    characters share a paragraph.
    """
    first, later = f"{FIRST_CHARS},{LONGEST_FIRST}", f"{PARAGRAPH_CHARS},{LONGEST_PARAGRAPH}"
    before_stop = f"{PARAGRAPH_CHARS - 1},{LONGEST_PARAGRAPH - 1}"
    pattern = "|".join([rf"\A\n*+[^\n]{{{first}}}?(?=\s)", rf"\A\n*+[^\n]{{1,{LONGEST_FIRST}}}",
                        rf"[^\n]{{{before_stop}}}?[.!?](?=\s)", rf"[^\n]{{{later}}}?(?=\s)",
                        rf"[^\n]{{1,{LONGEST_PARAGRAPH}}}"])
    paragraphs = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.array_distinct(F.transform(paragraphs, lambda p: F.xxhash64(p)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _hashed(keys: Column, level: Column) -> Column:
    """Each digest with its check, its cells at a level, and the hash bits that choose its part of the sketch."""
    def cell(at: Column, table: int) -> Column:
        slot = F.shiftright(at, SLOT_BITS * table).bitwiseAND(F.lit(SLOTS - 1)) + SLOTS * table
        return slot.cast("int").alias(f"cell{table}")

    return F.transform(
        F.transform(keys, lambda k: F.struct(k.alias("key"), F.xxhash64(k, level).alias("at"))),
        lambda h: F.struct(h["key"].alias("key"), F.xxhash64(h["key"]).alias("check"),
                           *[cell(h["at"], table) for table in range(TABLES)],
                           F.shiftright(h["at"], SLOT_BITS * TABLES).alias("part")))


def _xor(of: Column, field: str) -> Column:
    return F.aggregate(of, F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v[field]))


def _cells(hashed: Column) -> Column:
    """The sketch: per cell the number of digests, and their exclusive or, as are their checks."""
    tables = [_table(hashed, table) for table in range(TABLES)]
    none = F.struct(F.lit(0).alias("n"), *[F.lit(0).cast("long").alias(name) for name in ("key", "check")])
    return F.transform(F.concat(*tables), lambda inside: F.when(F.size(inside) == 0, none).otherwise(F.struct(
        F.size(inside).alias("n"), _xor(inside, "key").alias("key"), _xor(inside, "check").alias("check"))))


def _table(hashed: Column, table: int) -> Column:
    """The digests in each cell of one table."""
    numbers = F.sequence(F.lit(SLOTS * table), F.lit(SLOTS * (table + 1) - 1))
    return F.transform(numbers, lambda c: F.filter(hashed, lambda h: h[f"cell{table}"] == c))


def sketch(keys: Column) -> Column:
    """The smallest sketch of an array of digests."""
    return _let(_hashed(keys, F.lit(0)), _cells)


def _subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"),
                                                  x["key"].bitwiseXOR(y["key"]).alias("key"),
                                                  x["check"].bitwiseXOR(y["check"]).alias("check")))


def _peeled(cells: Column, level: Column) -> Column:
    """How many digests differ, found by peeling a subtracted sketch; NULL if cells are left that no digest fits.

    A cell that holds one digest gives it away: its check agrees. Taken out of its other
    cells, it may leave more such cells. Every round takes at least one digest out.
    """
    def singles(state: Column) -> Column:
        """Digests that are alone in a cell, with their cells and whose they are."""
        alone = F.filter(state, lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["key"]) == c["check"]))
        ours, theirs = (F.array_distinct(F.transform(F.filter(alone, lambda c: c["n"] == n), lambda c: c["key"]))
                        for n in (1, -1))
        return F.concat(*[F.transform(_hashed(keys, level), lambda h: h.withField("n", F.lit(n)))
                          for n, keys in ((1, ours), (-1, theirs))])

    def without(state: Column, found: Column) -> Column:
        return F.transform(state, lambda c, i: _let(
            F.filter(found, lambda f: (f["cell0"] == i) | (f["cell1"] == i) | (f["cell2"] == i)),
            lambda here: F.when(F.size(here) == 0, c).otherwise(F.struct(
                (c["n"] - F.aggregate(here, F.lit(0), lambda a, f: a + f["n"])).alias("n"),
                c["key"].bitwiseXOR(_xor(here, "key")).alias("key"),
                c["check"].bitwiseXOR(_xor(here, "check")).alias("check")))))

    def state(cells: Column, count: Column) -> Column:
        return _let(cells, lambda c: F.struct(c.alias("cells"), count.cast("int").alias("count"),
                                              singles(c).alias("found")))

    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(CELLS)), state(cells, F.lit(0)),
        lambda s, _: F.when(F.size(s["found"]) == 0, s).otherwise(
            state(without(s["cells"], s["found"]), s["count"] + F.size(s["found"]))),
        lambda s: F.when(F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)),
                         s["count"]))
    return end


def differing(a: Column, b: Column, a_cells: Column, b_cells: Column) -> Column:
    """How many digests are in one of two arrays alone, by their sketches.

    The sketches as they are come first. If they cannot be peeled, both are made again,
    ``GROWTH`` times larger each time: further bits of a digest's hash say which part of
    the sketch it belongs to, and every part is subtracted and peeled for itself. Digests
    that even the last size cannot tell apart are counted by comparing the arrays.
    """
    def at_level(level: Column) -> Column:
        parts = F.pow(F.lit(GROWTH), level).cast("int")

        def of_part(hashed: Column, p: Column) -> Column:
            return F.filter(hashed, lambda h: F.pmod(h["part"], parts) == p)

        def one(both: Column, p: Column) -> Column:
            some = F.struct(of_part(both["a"], p).alias("a"), of_part(both["b"], p).alias("b"))
            cells = F.when(level == 0, _subtracted(a_cells, b_cells)).otherwise(
                _let(some, lambda x: _subtracted(_cells(x["a"]), _cells(x["b"]))))
            return _peeled(cells, level)

        return _let(F.struct(_hashed(a, level).alias("a"), _hashed(b, level).alias("b")), lambda both: F.aggregate(
            F.sequence(F.lit(0), parts - 1), F.lit(0),
            lambda total, p: F.when(total.isNotNull(), total + one(both, p))))

    peeled = F.aggregate(F.sequence(F.lit(0), F.lit(RETRIES)), F.lit(None).cast("int"),
                         lambda found, level: F.when(found.isNotNull(), found).otherwise(at_level(level)))
    return F.coalesce(peeled, F.size(F.array_except(a, b)) + F.size(F.array_except(b, a)))


def likeness(a: Column, b: Column, differ: Column) -> Column:
    """Shared digests over all digests of two arrays of which ``differ`` are not shared; 1 if both are empty."""
    together = F.size(a) + F.size(b)
    return _let(differ, lambda d: F.when(together == 0, 1.0).otherwise((together - d) / (together + d)))


def as_text(cells: Column) -> Column:
    """A sketch as hexadecimal digits: per cell two of the number, sixteen of the digests, eight of the checks."""
    return F.lower(F.array_join(F.transform(cells, lambda c: F.concat(
        F.lpad(F.hex(F.pmod(c["n"], F.lit(256))), 2, "0"), F.lpad(F.hex(c["key"]), 16, "0"),
        F.substring(F.lpad(F.hex(c["check"]), 16, "0"), 9, 8))), ""))


# ------------------------------------------------------------------- documents and the next

def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the falling ``bounds`` are above the id: its range, found over two short lists."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds)) + 1
    lists = [bounds[k:k + step] for k in range(0, len(bounds), step)]
    coarse = F.size(F.filter(F.lit([b[0] for b in lists]), lambda b: b > doc_id))
    fine = F.size(F.filter(F.element_at(F.array(*[F.lit(b) for b in lists]), coarse), lambda b: b > doc_id))
    return (F.when(doc_id.isNull(), len(bounds)).when(coarse == 0, 0)
            .otherwise((coarse - 1) * step + fine)).cast("int")


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, next_text): each text with that of the next document, by falling id; the first follows the last.

    Texts move once. Ranges of ids of about equal size are read off a bounded sample of
    the ids; every range is sorted by one task, together with a copy of the first document
    of the range that follows. Equal ids are ordered by the hash of their text, NULL ids
    come last, NULL texts are empty, a single document follows itself.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # More ranges than tasks, so that a task can take a few and none has two by bad luck.
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fraction = min(1.0, SAMPLED * ranges / max(rows.count(), 1))
    cuts = [k / ranges for k in range(1, ranges)]
    met = rows.sample(fraction=fraction, seed=11).agg(
        F.percentile_approx("doc_id", cuts, 10_000)).first()[0] or []
    place = _range_of(F.col("doc_id"), sorted(set(met), reverse=True))
    rows = rows.withColumn("range", place).withColumn(
        "order", F.struct(F.col("doc_id").isNull().alias("last"), F.bitwise_not("doc_id").alias("falling"),
                          F.xxhash64("text").alias("hash")))
    # One row per range that is not empty.
    firsts = rows.groupBy("range").agg(F.min("order").alias("first"))
    round_trip = Window.orderBy("range")
    firsts = firsts.select("range", "first", F.coalesce(
        F.lag("range").over(round_trip), F.max("range").over(Window.partitionBy())).alias("before"))
    placed = rows.join(F.broadcast(firsts), "range").withColumn("copies", F.concat(
        F.array(F.struct(F.col("range").alias("to"), F.lit(False).alias("copy"))),
        F.when(F.col("order").eqNullSafe(F.col("first")), F.array(F.struct(
            F.col("before").alias("to"), F.lit(True).alias("copy")))).otherwise(F.array())))
    spread = placed.select("doc_id", "text", "order", F.inline("copies"))
    following = Window.partitionBy("to").orderBy("copy", "order")
    return (spread.withColumn("next_text", F.lead("text").over(following)).filter("NOT copy")
            .select("doc_id", "text", "next_text"))


def fingerprint_versions(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The edit puts as many characters of the next text's beginning in place of the last
    half. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next: the share of paragraphs that the two have in common.

    A NULL text counts as empty: its sketch is all zeros, as like to another empty one as
    can be. Equal texts have equal fingerprints, and an empty table gives no rows.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    versions = with_next(docs, text, doc_id).withColumn("edited", F.concat(
        F.left("text", F.length("text") - half), F.left("next_text", half)))
    names = ("text", "edited", "next_text")
    versions = versions.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.transform(F.array(*names), digests).alias("digests"))
    versions = versions.withColumn("sketches", F.transform("digests", sketch))
    own, own_cells = F.col("digests")[0], F.col("sketches")[0]
    near = F.transform(F.slice(F.arrays_zip("digests", "sketches"), 2, 2), lambda v: likeness(
        own, v["digests"], differing(own, v["digests"], own_cells, v["sketches"])))
    return (versions.withColumn("near", near).withColumn("printed", F.transform("sketches", as_text))
            .select("doc_id", "n_chars", "edited_sha256", F.col("printed")[0].alias("fingerprint"),
                    F.col("printed")[1].alias("edited_fingerprint"), F.col("near")[0].alias("near_edited"),
                    F.col("near")[1].alias("near_next")))
