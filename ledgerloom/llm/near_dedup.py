"""MinHash near-dedup (operator 7): multi-index Hamming join.

A text is its set of distinct shingles of WORDS words.  SLOTS minimum hashes
of b = 16 bits make its signature.  Two sets of Jaccard similarity s differ in
a slot with probability 1 - s, so links at the threshold stay well within
MAX_ERRORS differing slots.  All pairs within that distance are found by
pigeonhole: a signature is cut into CHUNKS chunks, so some chunk has at most
MAX_ERRORS // CHUNKS errors, and every chunk is indexed once for each allowed
set of erroneous slots, which are left out of its key.  Signatures that share
no key are farther apart than MAX_ERRORS.

Texts with equal shingle sets form a class; copies are never paired.  A
bucket (an index key) may hold a large group of near copies, so its members
are not all paired up; links are confirmed on full shingle sets in steps:

1. every member is compared with the bucket's first member, and the components
   of the confirmed links are found;
2. where a bucket still holds several components, its members are compared with
   one of them chosen by hash, in one bucket out of KEYS_PER_ROUND;
3. what is still apart is compared exactly: classes that buckets join form a
   cluster, clusters are cut into blocks (large components into blocks of their
   own, which need not be compared with one another), and each pair of blocks
   is a task that compares signatures and then sets of pairs from different
   components and returns no more than a spanning forest of its links.

Members of one component need no comparison, so no component is lost, and no
step emits the pairs of a group.

Defined results: null texts are empty; a text without words has no shingles
and links with nothing; with fewer than WORDS words the whole sequence is its
one shingle.  A row without doc_id links with nothing and is kept, with a null
component.  Equal rows are reported alike, and stay or go alike (exact dedup
is another operator); rows that share a doc_id but not a text are judged each
on its own.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, text_or_empty, text_runs, unused, worker_object
from ledgerloom.llm.components import connected_components, star_forest

WORDS = 5
SLOTS, CHUNKS, MAX_ERRORS = 32, 8, 15
SEED = 77
#: Of the buckets, one in so many gives its members a second comparison.
KEYS_PER_ROUND = 8
#: Classes, and shingles of classes, in a block of the exact last step.
BLOCK, BLOCK_SHINGLES = 512, 500_000
#: Bytes of texts whose words one worker holds at once.
TEXT_RUN = 1_000_000
#: Words whose hashes one worker remembers.
CACHED_WORDS = 400_000
def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str, lower: bool = True) -> list[bytes]:
    """The words of a text in UTF-8: maximal runs of characters other than
    space and the five controls from tab to carriage return.  Methods of bytes
    know ASCII only, so just A-Z are lowered and just those six split."""
    data = text.encode()
    return (data.lower() if lower else data).split()


class WordHashes:
    """word -> 64-bit hash, remembered per worker."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, texts: list[list[bytes]]) -> np.ndarray:
        """Hashes of all words of all texts, one after the other."""
        known = self.known
        missing = list(set(itertools.chain.from_iterable(texts)).difference(known))
        blake = hashlib.blake2b
        known.update((w, int.from_bytes(blake(w, digest_size=8).digest(), "little")) for w in missing)
        out = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(texts)), np.uint64)
        if len(known) > CACHED_WORDS:
            for w in missing:
                del known[w]
        return out


def word_hashes() -> WordHashes:
    return worker_object(("word hashes",), WordHashes, large=True)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [words_of(t) for t in texts]
    h, ends = word_hashes().of(split), np.cumsum([len(w) for w in split])
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for j in range(words):
        rolled = _mix(rolled * np.uint64(31) + h[j : j + len(rolled)])
    out = []
    for end, own in zip(ends.tolist(), split):
        start = end - len(own)
        if not own:
            out.append(np.zeros(0, np.uint64))
        elif len(own) < words:  # the whole sequence; its length keeps it apart from longer shingles
            short = np.array([len(own)], np.uint64)
            for x in h[start:end]:
                short = _mix(short * np.uint64(31) + x)
            out.append(short)
        else:
            out.append(np.unique(rolled[start : end - words + 1]))
    return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """(sets, slots) minimum hashes of 16 bits; the sets must not be empty."""
    rng = np.random.default_rng(SEED)
    twist, factor = rng.integers(0, 2**63, slots, np.uint64), rng.integers(0, 2**63, slots, np.uint64) * np.uint64(2) + np.uint64(1)
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), slots), np.uint16)
    for k in range(slots):
        least = np.minimum.reduceat((flat ^ twist[k]) * factor[k], starts)
        out[:, k] = _mix(least) >> np.uint64(48)
    return out


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest()


def _features(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "row", "tie", "n_shingles", "digest", "signature"]
    for run in text_runs(batches, TEXT_RUN):
        sets = shingle_sets(run.column("text").to_pylist(), words)
        full = [s for s in sets if len(s)]
        found = iter(signatures(full).view(np.int16).tolist()) if full else iter(())
        columns = [
            *(run.column(c) for c in ("doc_id", "row", "tie")),
            pa.array(list(map(len, sets)), pa.int64()),
            pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
            pa.array([next(found) if len(s) else None for s in sets], pa.list_(pa.int16())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def index_keys(sig: np.ndarray) -> np.ndarray:
    """(signatures, keys): one key per chunk and set of slots left out."""
    per = SLOTS // CHUNKS
    out = []
    for chunk in range(CHUNKS):
        own = sig[:, chunk * per : (chunk + 1) * per].astype(np.uint64)
        for k, gone in enumerate(itertools.combinations(range(per), MAX_ERRORS // CHUNKS)):
            key = np.full(len(sig), chunk * 1000 + k, np.uint64)
            for slot in range(per):
                if slot not in gone:
                    key = _mix(key * np.uint64(1 << 16) ^ own[:, slot])
            out.append(key)
    return np.stack(out, axis=1).astype(np.int64)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = index_keys(np.array(batch.column("signature").to_pylist(), np.int16).view(np.uint16))
        each = keys.shape[1]
        cls, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "n_shingles"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), pa.array(np.repeat(cls, each)), pa.array(np.repeat(n, each))], names=["key", "cls", "n_shingles"]
        )


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The shingle set of each class, from the text of a row that has it."""
    for run in text_runs(batches, TEXT_RUN):
        sets = shingle_sets(run.column("text").to_pylist(), words)
        rows = zip(run.column("cls").to_pylist(), run.column("digest").to_pylist(), sets)
        found = [(cls, s.astype("<u8").tobytes()) for cls, digest, s in rows if len(s) and _digest(s) == digest]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], names=["cls", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        linked = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(lambda it: _confirm(it, percent), "a long, b long, linked boolean")


def _similar_size(percent: int, a: str, b: str) -> Column:
    """Sets can only reach the similarity if the smaller has that share of the larger."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _shared_counts(x: list[np.ndarray], y: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common elements of the pairs (x[i], y[j]) of sorted sets."""
    rows, cols = np.unique(i), np.unique(j)
    values = np.concatenate([*(x[k] for k in rows), *(y[k] for k in cols)])
    vocabulary, code = np.unique(values, return_inverse=True)
    if len(i) * 3e-5 < 1e-10 * len(rows) * len(cols) * len(vocabulary):  # few pairs: one by one
        return np.array([len(np.intersect1d(x[a], y[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())])
    owner = np.repeat(np.arange(len(rows) + len(cols)), [*(len(x[k]) for k in rows), *(len(y[k]) for k in cols)])
    order = np.argsort(code, kind="stable")
    code, owner, common = code[order], owner[order], np.zeros((len(rows), len(cols)), np.float32)
    for low in range(0, len(vocabulary), 4096):  # products of 0/1 matrices, a few thousand columns at a time
        a, b = np.searchsorted(code, [low, low + 4096])
        table = np.zeros((len(rows) + len(cols), 4096), np.float32)
        table[owner[a:b], code[a:b] - low] = 1
        common += table[: len(rows)] @ table[len(rows) :].T
    return common[np.searchsorted(rows, i), np.searchsorted(cols, j)].astype(np.int64)


def _compare_blocks(table: pa.Table, percent: int) -> pa.RecordBatch:
    """A spanning forest of the links between components, within a block or between two."""
    side, cls, root = (table.column(c).to_numpy() for c in ("side", "cls", "root"))
    sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
    sizes, sig = np.array(list(map(len, sets))), np.array(table.column("signature").to_pylist(), np.int16)
    inner = table.column("two")[0] == table.column("one")[0]
    x = np.flatnonzero(side == 0)
    y = x if inner else np.flatnonzero(side == 1)
    errors = np.zeros((len(x), len(y)), np.uint8)
    for k in range(SLOTS):
        errors += sig[x, k, None] != sig[None, y, k]
    a, b = sizes[x][:, None], sizes[y][None, :]
    open_ = (errors <= MAX_ERRORS) & (root[x][:, None] != root[y][None, :]) & (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent)
    i, j = np.nonzero(np.triu(open_, 1) if inner else open_)
    if len(i):
        both = _shared_counts([sets[k] for k in x], [sets[k] for k in y], i, j)
        linked = 100 * both >= percent * (sizes[x[i]] + sizes[y[j]] - both)
        i, j = i[linked], j[linked]
    node, low = star_forest(cls[x[i]], cls[y[j]])
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(low, pa.int64())], names=["a", "b"])


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Walks a partition sorted by pair of blocks; holds one pair at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "one", "two"))))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)] if keys else []
        for low, high in zip(cuts, cuts[1:]):
            if keys[low] != key:
                if held:
                    yield _compare_blocks(pa.Table.from_batches(held), percent)
                held, key = [], keys[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield _compare_blocks(pa.Table.from_batches(held), percent)


def _cluster_links(apart: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) links between components.  ``apart``: key, cls, root of the members of mixed buckets."""
    first = apart.groupBy("key").agg(F.min("cls").alias("a"))
    joined = apart.join(first, "key").select("a", F.col("cls").alias("b")).where("a <> b").distinct()
    named = connected_components(joined).select(F.col("node").alias("cls"), F.col("root").alias("cluster"))
    docs = apart.select("cls", "root").distinct().join(named, "cls", "left").withColumn("cluster", F.coalesce("cluster", "cls"))
    docs = staged(docs.join(classes.select("cls", "n_shingles", "signature"), "cls"), "apart-classes")

    own = docs.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    large = (F.col("n") * 2 >= BLOCK) | (F.col("shingles") * 2 >= BLOCK_SHINGLES)
    own = own.withColumn("group", F.when(large, F.col("root")).otherwise(-1))
    groups = own.groupBy("cluster", "group").agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    groups = staged(groups.select("cluster", "group", blocks.alias("blocks")), "groups")
    placed = docs.join(own.select("cluster", "root", "group"), ["cluster", "root"]).join(groups, ["cluster", "group"])
    placed = placed.withColumn("block", F.struct("group", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("i")))
    placed = placed.select("cluster", "block", "cls", "root", "signature").join(sets, "cls")

    numbered = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.col("group").alias("group"), i.alias("i")))
    each = groups.select("cluster", F.explode(numbered).alias("block"))
    left, right = each.withColumnRenamed("block", "one"), each.withColumnRenamed("block", "two")
    pairs = left.join(right, "cluster").where("one <= two AND (one.group <> two.group OR one.group = -1)")
    sides = pairs.select("cluster", F.col("one").alias("block"), "one", "two", F.lit(0).alias("side")).unionByName(
        pairs.where("one <> two").select("cluster", F.col("two").alias("block"), "one", "two", F.lit(1).alias("side"))
    )
    rows = placed.join(sides, ["cluster", "block"]).select("cluster", F.to_json("one").alias("one"), F.to_json("two").alias("two"), "side", "cls", "root", "signature", "shingles")
    dealt = rows.repartition("cluster", "one", "two").sortWithinPartitions("cluster", "one", "two")
    return dealt.mapInArrow(lambda it: _block_pairs(it, percent), "a long, b long")


def _links(classes: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(node, root) over classes.  ``classes``: cls, least (a doc_id that has it), digest, n_shingles, signature."""
    index = staged(classes.select("cls", "n_shingles", "signature").mapInArrow(_index, "key long, cls long, n_shingles long"), "index")
    # the first member of each bucket, by a pre-aggregated minimum; buckets of one member end here
    first = index.groupBy("key").agg(F.min(F.struct("cls", "n_shingles")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(
        index.join(first, "key").select("key", "cls", "n_shingles", F.col("first.cls").alias("first"), F.col("first.n_shingles").alias("first_n")), "members"
    )
    wanted = classes.select("cls", "least", "digest").join(members.select("cls").distinct(), "cls")
    rows = texts.join(wanted, texts["doc_id"] == wanted["least"]).select("cls", "digest", "text")
    sets = staged(rows.mapInArrow(lambda it: _sets(it, words), "cls long, shingles binary").dropDuplicates(["cls"]), "shingle-sets")

    stars = members.where((F.col("cls") != F.col("first")) & _similar_size(percent, "n_shingles", "first_n"))
    stars = staged(stars.select(F.col("first").alias("a"), F.col("cls").alias("b")).distinct(), "stars")
    links = staged(_compare(stars, sets, percent).where("linked").select("a", "b"), "star-links")

    def apart(links: DataFrame) -> DataFrame:
        """key, cls, n_shingles, root of the members of buckets that hold several components."""
        roots = connected_components(links)
        own = members.join(roots, members["cls"] == roots["node"], "left").select("key", "cls", "n_shingles", F.coalesce("root", "cls").alias("root"))
        mixed = own.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
        return staged(own.join(mixed, "key"), "apart")

    left = apart(links).where(F.pmod("key", F.lit(KEYS_PER_ROUND)) == 0)
    pick = F.min_by(F.struct("cls", "n_shingles", "root"), F.xxhash64("cls", "key")).alias("lead")
    again = left.join(left.groupBy("key").agg(pick), "key").where((F.col("root") != F.col("lead.root")) & _similar_size(percent, "n_shingles", "lead.n_shingles"))
    again = again.select(F.least("cls", "lead.cls").alias("a"), F.greatest("cls", "lead.cls").alias("b")).distinct()
    again = staged(again.join(stars, ["a", "b"], "left_anti"), "more-stars")
    links = links.unionByName(staged(_compare(again, sets, percent).where("linked").select("a", "b"), "more-links"))
    rest = staged(_cluster_links(apart(links).select("key", "cls", "root"), classes, sets, percent), "cluster-links")
    return connected_components(links.unionByName(rest))


def _judged(docs: DataFrame, percent: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tie (hash of the text), n_shingles, component_id, kept of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    numbered = texts.withColumn("row", F.monotonically_increasing_id()).withColumn("tie", F.xxhash64("text"))
    features = "doc_id long, row long, tie long, n_shingles long, digest binary, signature array<short>"
    rows = staged(numbered.mapInArrow(lambda it: _features(it, words), features), "features")
    linkable = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = linkable.groupBy("digest").agg(
        F.min("row").alias("cls"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    classes = staged(classes, "classes")
    roots = _links(classes, texts.where("doc_id IS NOT NULL"), percent, words)
    named = staged(classes.join(roots, classes["cls"] == roots["node"], "left").select("digest", "least", F.coalesce("root", "cls").alias("root")), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    got = linkable.join(named.join(least, "root").select("digest", "component_id"), "digest")
    alone = rows.where("digest IS NULL OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "tie", "n_shingles", "component_id"]
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return got.select(*columns).unionByName(alone.select(*columns)).withColumn("kept", kept)


def near_groups(docs: DataFrame, percent: int = 80, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.
    Links: 100 * intersection >= percent * union of the shingle sets."""
    return _judged(docs, percent, words, id_col, text_col).drop("tie")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group (the smallest doc_id), all columns kept."""
    own_id, own_tie = unused(docs, "gone_id"), unused(docs, "gone_tie")
    gone = _judged(docs, percent, words, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(own_id), F.col("tie").alias(own_tie)).distinct()
    return docs.join(gone, (F.col(id_col) == F.col(own_id)) & (F.xxhash64(text_or_empty(text_col)) == F.col(own_tie)), "left_anti")
