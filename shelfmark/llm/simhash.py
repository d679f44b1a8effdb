"""SimHash near-duplicates, found through an inverted index of the fingerprints' bytes."""

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..checkpoints import materialise
from .graph import components

#: Which of several marks are like a given one.
Like = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: For the rows of a list, what stands for each of them, and which of those are like each other.
Compared = Callable[[pd.DataFrame], tuple[np.ndarray, Like]]

BYTES = 8
#: Fingerprints of one posting list that one task compares; longer lists are compared block by block.
BLOCK = 4096
SEED = 42


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """XXH64 of the UTF-8 of a text's word shingles, in their order, repeats included.

    Words are runs without ASCII white space, A to Z in small letters; shingles are
    ``size`` words joined by spaces, or all words when there are fewer.
    """
    from xxhash import xxh64_intdigest

    # bytes.lower and bytes.split know ASCII alone, which is what is asked for.
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()][:max(len(words) - size, 0) + 1]
    ends = ends[min(size, len(words)) - 1:] - 1
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends.tolist())], dtype="<u8")


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit SimHash: bit by bit, what over half of the hashes have; zero for none."""
    if not len(hashes):
        return 0
    # Bits are counted some thousand shingles at a time, so a long text takes no more memory.
    ones = sum(np.unpackbits(hashes[k:k + 8192].view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
               .sum(axis=0, dtype=np.int64) for k in range(0, len(hashes), 8192))
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, size: int = 3) -> Column:
    """The SimHash of a column's texts, as a signed long."""
    @F.pandas_udf(T.LongType())
    def hashed(texts: pd.Series) -> pd.Series:
        prints = [majority_bits(shingle_hashes(t, size)) for t in texts]
        return pd.Series(np.array(prints, dtype=np.uint64).view(np.int64))
    return hashed(text)


def byte_sets(shared: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``shared`` positions contain one of them.

    For five shared bytes: the 14 fours whose positions cancel under exclusive or. Five
    of the eight positions always contain such a four. For other numbers, every set of
    that many positions.
    """
    if shared == 5:
        return [s for s in combinations(range(BYTES), 4) if reduce(int.__xor__, s) == 0]
    return list(combinations(range(BYTES), shared))


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b): links that join all fingerprints (``print``, distinct) at ``bits`` or fewer differing bits.

    ``bits`` differing bits touch as many bytes at most, so such a pair shares at least
    8 - ``bits`` bytes in their places. Lists of a single byte would each hold one in 256
    of all fingerprints, and tallying them by pair would emit their squares; so lists are
    kept of byte sets of which every pair with enough shared bytes has one (``byte_sets``).
    Within a list, a pair's shared bytes are tallied, pairs below 8 - ``bits`` dropped, and
    the others verified by their bits.
    """
    shared = BYTES - bits
    sets = byte_sets(shared)
    postings = materialise(prints.select(F.col("print").alias("node"), F.posexplode(F.array(*[
        F.col("print").bitwiseAND(F.lit(_mask(s))) for s in sets])).alias("set", "value")))

    def like(one: np.ndarray, others: np.ndarray) -> np.ndarray:
        differing = others ^ one
        close = (differing.view(np.uint8).reshape(len(others), BYTES) == 0).sum(axis=1) >= shared
        close[close] = np.bitwise_count(differing[close]) <= bits
        return close

    return _spanning_links(postings, lambda rows: (rows["node"].to_numpy().view(np.uint64), like))


def _spanning_links(postings: DataFrame, compared: Compared, marks: DataFrame | None = None) -> DataFrame:
    """(a, b): links between nodes of a list (``set``, ``value``) that are like each other, spanning what they join.

    A list gives no more links than it has nodes. One of a ``weight`` (of each node; 1
    unless ``postings`` have it) above ``BLOCK`` is split by a hash into blocks, and every
    two blocks are compared by a task of their own. Nodes are compared by themselves, or by
    their ``marks`` (node, ...).
    """
    weight = F.col("weight") if "weight" in postings.columns else F.lit(1.0)
    counts = postings.groupBy("set", "value").agg(F.count("*").alias("count"), F.sum(weight).alias("weight"))
    # Left out: nodes that are alone in their list.
    shared = counts.filter("count > 1").select("set", "value", F.when(F.col("weight") > BLOCK, F.ceil(
        F.col("weight") * 1.25 / BLOCK)).cast("int").alias("blocks"))
    dealt = postings.join(shared, ["set", "value"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # Block i meets every block j: as the first of the two where i <= j, else as the second.
    meets = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"))))
    spread = dealt.select("node", "set", "value", F.explode(meets).alias("pair"))
    keys = ["set", "value", "i", "j"]
    lists = spread.select("node", "set", "value", "pair.i", "pair.j")
    if marks is not None:
        lists = lists.join(marks, "node")
    lists = lists.repartition(*keys).sortWithinPartitions(*keys)

    def forests(rows: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
        nodes = rows["node"].to_numpy()
        found = []
        for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            pairs = forest(*compared(rows.iloc[begin:end]))
            found += [(nodes[begin + a], nodes[begin + b]) for a, b in pairs]
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            of = batch[keys].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1])
            yield forests(batch, cuts)
            held = batch.iloc[cuts[-1]:]        # the list may go on in the next batch
        if held is not None:
            yield forests(held, np.array([0, len(held)]))

    return lists.mapInPandas(compare, "a long, b long").distinct()


def _mask(positions: tuple[int, ...]) -> int:
    return int(np.array([sum(0xFF << 8 * p for p in positions)], dtype=np.uint64).view(np.int64)[0])


def forest(marks: np.ndarray, like: Like, pivots: int = 16) -> list[tuple[int, int]]:
    """Pairs (earlier, later) that join all the marks of a list that are ``like`` each other.

    A mark is compared with a few that were like many before it, then with all that are
    not yet joined to it: within a group of copies that is few, and no pair that could
    join two groups is passed over.
    """
    root, found = np.arange(len(marks)), []
    hits: dict[int, int] = {}
    for k in range(1, len(marks)):
        some = np.fromiter(hits, np.int64, len(hits))
        near = some[like(marks[k], np.ascontiguousarray(marks[some]))] if len(some) else some
        for p in near.tolist():
            hits[p] += 1
        rest = np.flatnonzero(~np.isin(root[:k], root[near])) if len(near) else np.arange(k)
        others = rest[like(marks[k], np.ascontiguousarray(marks[rest]))]
        if len(others):
            hits[int(others[0])] = hits.get(int(others[0]), 0) + 1
            if len(hits) > pivots:
                del hits[min(hits, key=hits.get)]
        _, first = np.unique(root[np.concatenate([near, others])], return_index=True)
        joined = np.concatenate([near, others])[first]
        if len(joined):
            found += [(int(j), k) for j in joined]
            groups = root[joined]
            root[:k][np.isin(root[:k], groups)] = groups[0]
            root[k] = groups[0]
    return found


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id) of each document.

    ``fingerprint`` is hexadecimal; ``component_id`` is the smallest id among the documents
    that can be reached over links of ``bits`` or fewer differing bits. Copies meet in
    their fingerprint and are one node of the graph, however many there are.

    A NULL, empty or blank text has fingerprint zero and is linked like any other. NULL
    ids keep their row but name no component: one of NULL ids alone is NULL. Equal ids
    are rows of their own; an empty table gives no rows.
    """
    kept = materialise(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("print")))
    roots = fingerprint_components(kept, bits)
    return _labelled(kept, roots).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
                                         "component_id")


def fingerprint_components(kept: DataFrame, bits: int = 3) -> DataFrame:
    """(node, root) of the fingerprints in ``kept`` (print) that are linked to others."""
    prints = materialise(kept.select("print").distinct())
    return materialise(components(links(prints, bits)))


def _labelled(kept: DataFrame, roots: DataFrame) -> DataFrame:
    """``kept`` (doc_id, print, ...) with the smallest doc_id of each row's component."""
    # First the smallest id of each fingerprint, combined in each task, then of each component.
    by_print = kept.groupBy("print").agg(F.min("doc_id").alias("least"))
    placed = by_print.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least")
    by_root = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(placed.join(by_root, "root").select(F.col("print").alias("_print"), "component_id"))
    return kept.join(named, F.col("print") == F.col("_print")).drop("_print")


# ------------------------------------------------------- copies beyond a few differing bits

#: Bytes of a signature, of which BANDS times ROWS make the keys that candidates share.
POSITIONS, BANDS, ROWS = 256, 24, 5
#: Signatures nominate pairs down to so many standard deviations below the similarity asked for.
DEVIATIONS = 5
#: Below so many no pair is compared: of 10^17 pairs of 0.8 one is there, fewer than texts that share a 64-bit hash.
CERTAIN = 10
#: Texts from which the commonest shingles are read, and how many of these are put last.
SAMPLED, COMMON = 8192, 1 << 16
#: A node that is compared by its shingles weighs 1, and 1 more for each so many of them.
SHINGLES = 1024
_STIRS = np.random.default_rng(2).integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEYS = np.random.default_rng(3).integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_signature(hashes: np.ndarray) -> tuple[bytes, list[int]]:
    """(signature, keys) of a set of shingles: by each of many stirrings, a byte of the smallest hash.

    Two sets agree in a position as often as they share shingles: the share of equal bytes
    estimates their similarity (Jaccard). Each key is a digest of ``ROWS`` positions.
    """
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[k:k + 1024, None] * _STIRS).min(axis=0))
    high = least >> np.uint64(32)
    mixed = (high[:BANDS * ROWS].reshape(BANDS, ROWS) * _KEYS).sum(axis=1, dtype=np.uint64)
    return (high & np.uint64(0xFF)).astype(np.uint8).tobytes(), mixed.view(np.int64).tolist()


def shingle_set(text: Column, size: int) -> Column:
    """The set of a text's shingles: their hashes, sorted, eight bytes each."""
    @F.pandas_udf(T.BinaryType())
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, size)).astype("<u8").tobytes() for t in texts], dtype=object)
    return sets(text)


def _least_equal(similarity: float, deviations: int = DEVIATIONS) -> int:
    """Equal bytes that signatures of sets of ``similarity`` have but for once in some millions."""
    return int(POSITIONS * (similarity - deviations * (similarity * (1 - similarity) / POSITIONS) ** 0.5))


def _signatures(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["mark"]), np.uint8).reshape(len(rows), -1)


def candidate_groups(marked: DataFrame, similarity: float, bits: int) -> DataFrame:
    """(node, root) of texts that may be near-duplicates, from ``marked`` (node, print, mark, keys), a row for each.

    Fingerprints that differ in at most ``bits`` bits bring texts together; so does a
    second inverted index, of the keys, if their signatures have ``_least_equal`` bytes in
    common. A pair of similarity 0.8 shares no key but once in 10,000. Every two texts that
    are linked so, by others too, are in one group.
    """
    least = _least_equal(similarity)

    def compared(rows: pd.DataFrame) -> tuple[np.ndarray, Like]:
        return _signatures(rows), lambda one, others: (others == one).sum(axis=1) >= least

    postings = materialise(marked.select("node", F.posexplode("keys").alias("set", "value")))
    alike = _spanning_links(postings, compared, marked.select("node", "mark"))
    return materialise(components(alike.union(fingerprint_links(marked, bits))))


def fingerprint_links(marked: DataFrame, bits: int) -> DataFrame:
    """(a, b): links of texts (node, print) whose fingerprints differ in at most ``bits`` bits."""
    reps = materialise(marked.groupBy("print").agg(F.min("node").alias("rep")))
    same = marked.join(reps, "print").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    near = links(reps.select("print"), bits)
    for side in ("a", "b"):
        near = near.join(reps.select(F.col("print").alias(side), F.col("rep").alias(f"{side}_rep")), side)
    return same.union(near.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")))


def similar_sets(similarity: float) -> Compared:
    """Compares rows by the Jaccard similarity of their ``shingles``, counted only where their ``mark`` allows it."""
    least = _least_equal(similarity, CERTAIN)

    def compared(rows: pd.DataFrame) -> tuple[np.ndarray, Like]:
        marks = _signatures(rows)
        sets = [np.frombuffer(s, "<u8") for s in rows["shingles"]]
        sizes = np.array(list(map(len, sets)), dtype=np.int64)

        def like(one: int, others: np.ndarray) -> np.ndarray:
            own = sets[one]
            if not len(own):
                return sizes[others] == 0
            found = (sizes[others] > 0) & ((marks[others] == marks[one]).sum(axis=1) >= least)
            near = others[found]
            if len(near):
                every = np.concatenate([sets[o] for o in near.tolist()])
                at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                shared = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(sizes[near]) - sizes[near])
                found[found] = shared / (len(own) + sizes[near] - shared) >= similarity
            return found

        return np.arange(len(rows)), like

    return compared


def verified_links(sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that join all texts of a group whose sets of shingles are of ``similarity`` or more.

    ``sets`` has (node, root, mark, shingles): the group and the set of each text.
    """
    weight = 1 + F.octet_length("shingles") / (8 * SHINGLES)
    postings = materialise(sets.select("node", F.lit(0).alias("set"), F.col("root").alias("value"),
                                       weight.alias("weight")))
    return _spanning_links(postings, similar_sets(similarity), sets.select("node", "mark", "shingles"))


def common_shingles(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of shingles that several texts of a sample share: which are first says nothing of a result."""
    @F.pandas_udf("array<long>")
    def sets(bodies: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in bodies], dtype=object)

    sampled = texts.toDF("text").sample(min(1.0, SAMPLED / max(texts.count(), 1)), seed=SEED)
    found = sampled.select(F.explode(sets("text")).alias("shingle")).groupBy("shingle").count().filter(
        "count > 2").orderBy(F.desc("count"), "shingle").limit(COMMON).toPandas()
    hashes = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["count"].to_numpy(np.int64)[order]


def rarest(hashes: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Those shingles of a set of which every set of ``similarity`` or more has one among its own.

    Sets of that similarity share so large a part of each that the first shingle they share,
    in any order, is not among the last of either: the rarest come first here.
    """
    own, (known, counts) = np.unique(hashes), common
    last = np.zeros(len(own), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        last = np.where(known[at] == own, counts[at], 0)
    least = int(np.ceil(similarity * len(own) - 1e-9))
    return own[np.lexsort((own, last))][:len(own) - least + 1]


def missed_links(kept: DataFrame, marked: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that join all texts of different ``roots`` (node, root) that may be of ``similarity``.

    ``kept`` has the ``rarest`` shingles of each text. Lists of them whose texts are all of one
    root, nearly all, are done with before anything is sent for a comparison.
    """
    own = F.coalesce("root", "node").alias("root")
    # Dealt by shingle once, for the roots of each list as for its texts.
    postings = kept.select("node", "rarest").join(roots, "node", "left").select(
        "node", own, F.explode("rarest").alias("value")).repartition("value")
    several = postings.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                            F.count("node").alias("count")).filter("low <> high AND count > 1")
    lists = materialise(postings.join(several.select("value"), "value").groupBy("value", "node").agg(
        F.min("root").alias("root")).select("node", "root", F.lit(0).alias("set"), "value"))
    least = _least_equal(similarity, CERTAIN)

    def compared(rows: pd.DataFrame) -> tuple[np.ndarray, Like]:
        marks, groups = _signatures(rows), rows["root"].to_numpy()

        def like(one: int, others: np.ndarray) -> np.ndarray:
            found = groups[others] != groups[one]
            found[found] = (marks[others[found]] == marks[one]).sum(axis=1) >= least
            return found

        return np.arange(len(rows)), like

    return _spanning_links(lists, compared, marked.join(roots, "node", "left").select("node", "mark", own))


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, bits: int = 3, text: str = "text",
             doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest id stays.

    Documents are near-duplicates if their sets of word shingles have a Jaccard similarity
    of ``similarity`` or more. Fingerprints and signatures only nominate such pairs
    (``candidate_groups``), the sets decide (``verified_links``): fingerprints of texts
    that share 0.8 of their shingles differ in some ten bits, far beyond what an index of
    eight bytes can find, and texts that are mostly one shingle have equal ones whatever
    else they hold. Pairs that share no key are found by their rarest shingles
    (``missed_links``), so that none is left out. Only texts of a group are read again.
    Texts without words are copies of each other. NULL ids come
    last; rows with equal ids are told apart by a hash of the whole row, and of rows that
    agree in everything one stays.
    """
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") if t.startswith("map") else F.col(f"`{c}`")
                       for c, t in docs.dtypes])

    common = common_shingles(docs.select(text), shingle)

    @F.pandas_udf("node long, print long, mark binary, keys array<long>, rarest array<long>")
    def marks(texts: pd.Series) -> pd.DataFrame:
        from xxhash import xxh64_intdigest

        made = []
        for body in texts:
            hashes = shingle_hashes(body, shingle)
            node = xxh64_intdigest(b" ".join((body or "").encode("utf-8", "replace").lower().split()), SEED)
            made.append((node, majority_bits(hashes), *byte_signature(hashes),
                         rarest(hashes, similarity, common).view(np.int64)))
        frame = pd.DataFrame(made, columns=["node", "print", "mark", "keys", "rarest"])
        for column in ("node", "print"):
            frame[column] = frame[column].to_numpy(dtype=np.uint64).view(np.int64)
        return frame

    kept = materialise(docs.select(F.col(doc_id).alias("doc_id"), row.alias("row"), marks(F.col(text)).alias("of"))
                       .select("doc_id", "row", "of.*"))
    marked = materialise(kept.select("node", "print", "mark", "keys").dropDuplicates(["node"]))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    by_text = materialise(kept.groupBy("node").agg(F.min(first).alias("first")))

    def sets_of(groups: DataFrame) -> DataFrame:
        read = by_text.join(groups, "node").select("node", "root", F.col("first.doc_id").alias("_id"),
                                                   F.col("first.row").alias("_row"))
        bodies = docs.select(F.col(doc_id).alias("doc_id"), row.alias("row"), F.col(text).alias("text")).join(
            read, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")))
        # Rows that agree in everything are one text.
        return materialise(bodies.select("node", "root", "text").dropDuplicates(["node"]).select(
            "node", "root", shingle_set(F.col("text"), shingle).alias("shingles")).join(
            marked.select("node", "mark"), "node"))

    near = materialise(verified_links(sets_of(candidate_groups(marked, similarity, bits)), similarity))
    roots = materialise(components(near))
    missed = materialise(missed_links(kept, marked, roots, similarity))
    if not missed.isEmpty():
        further = verified_links(sets_of(materialise(components(missed))), similarity)
        roots = materialise(components(near.union(further)))
    by_root = by_text.join(roots, "node", "left").groupBy(
        F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    stay = materialise(by_root.select(F.col("first.doc_id").alias("_stay_id"), F.col("first.row").alias("_stay_row")))
    survivors = docs.withColumn("_row_hash", row).join(
        stay, F.col(doc_id).eqNullSafe(F.col("_stay_id")) & (F.col("_row_hash") == F.col("_stay_row")), "left_semi")
    again = kept.join(stay, F.col("doc_id").eqNullSafe(F.col("_stay_id")) & (F.col("row") == F.col("_stay_row")),
                      "left_semi").groupBy("doc_id", "row").count().filter("count > 1")
    if not again.isEmpty():
        survivors = survivors.dropDuplicates([doc_id, "_row_hash"])
    return survivors.drop("_row_hash")
