"""Substring dedup (operator 9): De Bruijn compaction of repeated word windows.

Edges are k-mers of WINDOW words.  An edge is repeated if its words start at
two places, within one text or in two.  Counting every edge would shuffle each
word of the corpus many times over, so edges are compacted first, the way
large De Bruijn graphs are built:

* Among the ANCHOR-word k-mers of an edge the one of smallest hash is its
  anchor (the whole edge where a window is shorter than ANCHOR).  Consecutive
  edges of a text with the same anchor form a *path*, about 13 edges long and
  cut after PATH_EDGES.  Equal edges have equal anchors.
* Only paths whose anchor occurs twice can hold repeated edges.  Anchors are
  counted over the whole corpus; the repeated ones go into a Bloom filter, and
  only paths that pass it leave their task, with the source coordinates (text
  digest, first word) and the hashes of their edges.
* Equal paths (same anchor, same edges) merge by aggregation: one row, however
  often they occur.  A path that occurs twice is repeated throughout.  The
  edges of the remaining paths are counted on merged paths, weighted with their
  occurrences, which settles the places where the graph branches.
* Repeated paths are compacted further through Spark joins: where every
  occurrence of a path is followed by the same path, and that one is always
  preceded by it, the two do not branch and become one.  Joins that double the
  distance (each path's predecessor's predecessor) turn such links into chains
  in a number of rounds that grows with the logarithm of their length.
* Equality so far is one of 64-bit hashes.  The words at the source coordinates
  decide: a chain is a long span of its texts, and the spans of all its
  occurrences are cut from the texts and compared by SHA-256; so are the
  single windows at branches, with one occurrence of every chain that holds the
  same edge.  Where spans or windows of one hash differ in their words, every
  window of every occurrence of these chains is compared by itself, so a
  collision of hashes removes no word and saves none.

The Bloom filter has at most MAX_FILTER_BITS (32 MB).  With more repeated
anchors than fit it, more unique paths pass and shuffle, and no result
changes.  Paths are keyed by text digest, so equal texts share one answer and
rows need no stable order.  Hot edges, paths and texts are pre-aggregated
before every shuffle, and joins on them can be split by AQE.

Defined results: a null text has no words; texts shorter than a window keep
all words; every occurrence of a repeated window goes, the first one too;
repeated rows and doc_ids are separate occurrences.  An empty table gives an
empty result.  In ``remove_repeats`` a text without removed words is returned
as it was (null stays null); in others the removed words go together with the
white space that follows them.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, text_or_empty, text_runs, unused, worker_object
from ledgerloom.llm.near_dedup import _mix, words_of

WINDOW, ANCHOR = 35, 11
SLOTS_PER_ANCHOR, HASHES = 16, 3
MIN_FILTER_BITS, MAX_FILTER_BITS, SLICE_BITS = 1 << 16, 1 << 28, 1 << 16
#: A path and the place of an edge in it share one long.
PATH_EDGES = 62
#: Bytes of texts whose words one worker holds at once.
TEXT_RUN = 1_000_000
#: Bytes of words hashed at once.
HASH_RUN = 1 << 20
BASE = 0x9E3779B97F4A7C15
_TOKENS = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHashes:
    """64-bit hashes of words: a random number per byte value, times a power by its place, summed and mixed."""

    def __init__(self):
        self.numbers = np.random.default_rng(9).integers(1, 2**63, 256, np.uint64)
        self.power, self.back = _powers(BASE, HASH_RUN), _powers(pow(BASE, -1, 1 << 64), HASH_RUN)

    def of(self, texts: list[list[bytes]]) -> np.ndarray:
        """Hashes of all words of all texts, one after the other."""
        words = list(itertools.chain.from_iterable(texts))
        if not words:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(b" ".join([*words, b""]), np.uint8)
        bounds = np.concatenate([[0], np.flatnonzero(data == 32) + 1])  # no word holds a space; a word's own counts too
        out, at = [], 0
        while at < len(words):
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + HASH_RUN, "right")) - 1)
            part, own = data[bounds[at] : bounds[upto]], bounds[at:upto] - bounds[at]
            power = self.power[: len(part)] if len(part) <= HASH_RUN else _powers(BASE, len(part))
            out.append(_mix(np.add.reduceat(self.numbers[part] * power, own) * self.back[own]))
            at = upto
        return np.concatenate(out)


def word_hashes() -> WordHashes:
    return worker_object(("word numbers",), WordHashes)


class Paths:
    """The paths of some texts (lists of words), as arrays over paths; without ``edges`` only texts and anchors."""

    def __init__(self, texts: list[list[bytes]], window: int, anchor: int, edges: bool = True):
        h, sizes = word_hashes().of(texts), np.array([len(t) for t in texts], np.int64)
        self.text = self.first = self.count = np.zeros(0, np.int64)
        self.anchor = self.extent = self.edges = np.zeros(0, np.uint64)
        self.edge_at = np.zeros(0, np.int64)
        n = len(h) - window + 1
        if n < 1:
            return
        power, back = _powers(BASE, len(h)), _powers(pow(BASE, -1, 1 << 64), len(h))
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)])

        def grams(k: int) -> np.ndarray:
            return _mix((prefix[k:] - prefix[:-k]) * back[: len(h) - k + 1])

        small, span = grams(anchor), window - anchor + 1
        least, reach = np.arange(len(small)), 1  # place of the smallest of ``reach`` k-mers from here on; the first of equals
        while reach < span:
            step = min(reach, span - reach)
            a, b = least[: len(least) - step], least[step:]
            least, reach = np.where(small[b] < small[a], b, a), reach + step
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(texts)), sizes)[:n]
        inside = np.flatnonzero(np.arange(n) + window <= ends[owner])
        if not len(inside):
            return
        at = least[inside]
        new = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        pieces = -(-np.diff(np.append(new, len(inside))) // PATH_EDGES)
        new = np.repeat(new, pieces) + PATH_EDGES * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        first = inside[new]
        self.count = np.diff(np.append(new, len(inside)))
        self.text = owner[first]
        self.first = first - (ends - sizes)[self.text]
        self.anchor = small[at[new]]
        if not edges:
            return
        self.extent = _mix((prefix[first + self.count + window - 1] - prefix[first]) * back[first] + self.count.astype(np.uint64))
        self.edges, self.edge_at = grams(window)[inside], new


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, list[list[bytes]]]]:
    """(digests, occurrences, words) of the distinct texts of each run."""
    for run in text_runs(batches, TEXT_RUN):
        times: dict[bytes, int] = {}
        texts: dict[bytes, str] = {}
        for digest, text in zip(run.column("digest").to_pylist(), run.column("text").to_pylist()):
            times[digest] = times.get(digest, 0) + 1
            texts[digest] = text
        yield list(texts), np.array(list(times.values()), np.int64), [words_of(t, lower=False) for t in texts.values()]


def _anchors(batches: Iterator[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of a run with their occurrences (2 stands for any larger number)."""
    for _, times, words in _runs(batches):
        p = Paths(words, window, anchor, edges=False)
        values, place = np.unique(p.anchor, return_inverse=True)
        n = np.minimum(2, np.bincount(place, weights=times[p.text], minlength=len(values))).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["anchor", "n"])


def _slots(values: np.ndarray, bits: int) -> np.ndarray:
    x = values.view(np.uint64)
    return np.stack([_mix(x + np.uint64(j * 0x632BE59BD9B4E019 % (1 << 64))) % np.uint64(bits) for j in range(HASHES)])


def _slices(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = np.unique(_slots(batch.column("anchor").to_numpy(zero_copy_only=False), bits))
        owner, local = (slot // SLICE_BITS).astype(np.int32), (slot % SLICE_BITS).astype("<u2")
        ids, starts = np.unique(owner, return_index=True)
        parts = [local[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(owner)))]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(parts, pa.binary())], names=["slice", "slots"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, slots in zip(batch.column("slice").to_pylist(), batch.column("slots").to_pylist()):
            held.setdefault(i, np.zeros(SLICE_BITS, bool))[np.frombuffer(slots, "<u2")] = True
    maps = [np.packbits(held[i]).tobytes() for i in sorted(held)]
    yield pa.RecordBatch.from_arrays([pa.array(sorted(held), pa.int32()), pa.array(maps, pa.binary())], names=["slice", "bitmap"])


def _filter_of(anchors: DataFrame) -> bytes:
    """Bloom filter of a staged table's ``anchor`` values; at most MAX_FILTER_BITS / 8 bytes come to the driver."""
    n, bits = anchors.count(), MIN_FILTER_BITS
    while bits < SLOTS_PER_ANCHOR * n and bits < MAX_FILTER_BITS:
        bits *= 2
    slices = anchors.select("anchor").mapInArrow(lambda it: _slices(it, bits), "slice int, slots binary")
    out = bytearray(bits // 8)
    for row in slices.repartition("slice").mapInArrow(_merged, "slice int, bitmap binary").toLocalIterator():
        out[row["slice"] * SLICE_BITS // 8 : (row["slice"] + 1) * SLICE_BITS // 8] = row["bitmap"]
    return bytes(out)


def _holds(bitmap: bytes, values: np.ndarray) -> np.ndarray:
    table, s = np.frombuffer(bitmap, np.uint8), _slots(values, len(bitmap) * 8)
    return ((table[s >> np.uint64(3)] >> (7 - (s & np.uint64(7))).astype(np.uint8)) & 1).all(axis=0)


def _path_rows(batches: Iterator[pa.RecordBatch], bitmap: bytes, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for digests, times, words in _runs(batches):
        p = Paths(words, window, anchor)
        keep = np.flatnonzero(_holds(bitmap, p.anchor)) if len(p.anchor) else np.zeros(0, np.int64)
        spans = zip(p.edge_at[keep].tolist(), (p.edge_at + p.count)[keep].tolist())
        edges = p.edges.view(np.int64)
        owner = p.text[keep]
        columns = [
            pa.array(p.anchor[keep].view(np.int64)), pa.array(p.extent[keep].view(np.int64)), pa.array([digests[i] for i in owner.tolist()], pa.binary()),
            pa.array(p.first[keep], pa.int64()), pa.array(times[owner], pa.int64()), pa.array([edges[a:b] for a, b in spans], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "extent", "digest", "first", "times", "edges"])


def repeated_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``texts``: digest, text.  Returns per digest the repeated edges as
    ``spans``: (first word, edges that start there and on; or a bit set of them)."""
    if window < 1:
        raise ValueError(f"a window has at least one word, not {window}")
    spark, anchor = texts.sparkSession, min(ANCHOR, window)
    anchors = texts.mapInArrow(lambda it: _anchors(it, window, anchor), "anchor long, n long")
    again = staged(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "repeated-anchors")
    shared = spark.sparkContext.broadcast(_filter_of(again))
    path = "anchor long, extent long, digest binary, first long, times long, edges array<bigint>"
    paths = staged(texts.mapInArrow(lambda it: _path_rows(it, shared.value, window, anchor), path), "paths")

    # equal hashes of all edges: a collision of ``extent`` alone merges nothing
    same = ["anchor", "extent", "sign"]
    paths = paths.withColumn("sign", F.xxhash64("edges"))
    merged = paths.groupBy(*same, "edges").agg(F.sum("times").alias("times"))
    merged = staged(merged.withColumn("path", F.monotonically_increasing_id()).withColumn("n", F.size("edges").cast("long")), "merged-paths")
    edges = merged.select("path", "times", F.posexplode("edges").alias("i", "edge"))
    # edges of paths that occur once, if they occur elsewhere too; ``whole``: a place in a repeated path
    place = F.col("path") * (PATH_EDGES + 2) + F.col("i")
    code = F.when(F.col("times") > 1, place).otherwise(-1 - place)
    branching = edges.select("edge", code.alias("code")).groupBy("edge").agg(F.min("code").alias("low"), F.max("code").alias("whole"))
    branching = staged(branching.where("low < 0 AND low < whole").select("edge", F.expr("CASE WHEN whole >= 0 THEN whole END").alias("whole")), "branching-edges")
    once = edges.where("times = 1").select("path", "i", "edge").join(branching.select("edge"), "edge")
    some = once.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("i", "edge"))).alias("m"))  # at most PATH_EDGES
    some = some.select("path", F.col("m.i").cast("array<tinyint>").alias("at"), F.col("m.edge").alias("own"))
    places = paths.select(*same, "digest", "first", "times")
    whole = places.join(merged.where("times > 1").select(*same, "path", "n", F.col("times").alias("t")), same)
    # equal texts of several runs come together before anything is dealt by text
    whole = staged(whole.groupBy("digest", "first", "path", "n", "t").agg(F.sum("times").alias("times")), "occurrences")
    single = places.join(merged.where("times = 1").join(some, "path").select(*same, "at", "own"), same)
    single = staged(single.select("digest", "first", "at", "own"), "single-occurrences")

    chains = _chains(whole)
    spans = _chain_spans(whole, chains)
    # one occurrence of a repeated path that holds the edge of a single window
    step = F.lit(PATH_EDGES + 2).cast("long")
    held = branching.where("whole IS NOT NULL").select("edge", F.expr(f"whole div {PATH_EDGES + 2}").alias("path"), (F.col("whole") % step).alias("i"))
    one = spans.groupBy("chain").agg(F.min(F.struct("digest", "first")).alias("at"))
    members = _members(whole, chains)
    stand = held.join(members, "path").join(one, "chain").select("at.digest", (F.col("at.first") + F.col("off") + F.col("i")).alias("first"), "edge")
    return _verified(texts, spans, single, stand, members, edges, window)


def _chains(whole: DataFrame) -> DataFrame:
    """``path, chain, off`` of the paths that follow another one in a chain: its first path, and the edges before.

    ``whole``: occurrences of the repeated paths; ``t``: how often a path occurs."""
    order = Window.partitionBy("digest").orderBy("first")
    follows = F.lead("first").over(order) == F.col("first") + F.col("n")
    steps = whole.select("path", "n", "t", "times", F.when(follows, F.struct(F.lead("path").over(order).alias("path"), F.lead("t").over(order).alias("t"))).alias("next"))
    links = steps.where("next IS NOT NULL").groupBy("path", "n", "t", F.col("next.path").alias("next"), F.col("next.t").alias("next_t"))
    # every occurrence of the one is followed by the other, and there are no others of that one
    links = links.agg(F.sum("times").alias("w")).where("w = t AND w = next_t")
    chains = staged(links.select(F.col("next").alias("path"), F.col("path").alias("chain"), F.col("n").alias("off")), "links")
    while True:
        before = chains.select(F.col("path").alias("chain"), F.col("chain").alias("earlier"), F.col("off").alias("more"))
        joined = chains.join(before, "chain", "left")
        chains = joined.select("path", F.coalesce("earlier", "chain").alias("chain"), (F.col("off") + F.coalesce("more", F.lit(0))).alias("off"), F.col("earlier").isNotNull().alias("moved"))
        chains = staged(chains, "chains")
        if not chains.where("moved").head(1):
            return chains.select("path", "chain", "off")
        chains = chains.select("path", "chain", "off")


def _members(whole: DataFrame, chains: DataFrame) -> DataFrame:
    """``path, n, chain, off`` of all repeated paths; one outside any chain is its own."""
    paths = whole.select("path", "n").distinct()
    return paths.join(chains, "path", "left").select("path", "n", F.coalesce("chain", "path").alias("chain"), F.coalesce("off", F.lit(0)).alias("off"))


def _chain_spans(whole: DataFrame, chains: DataFrame) -> DataFrame:
    """``digest, first, n, chain, times``: occurrences of the chains, ``n`` edges long."""
    sizes = _members(whole, chains).groupBy("chain").agg(F.max(F.col("off") + F.col("n")).alias("n"))
    starts = whole.select("digest", "first", F.col("path").alias("chain"), "times")
    return staged(starts.join(sizes, "chain").select("digest", "first", "n", "chain", "times"), "chain-spans")


_CUT = "digest binary, first long, chain long, edge long, times long, s1 long, s2 long"


def _cuts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """128 bits of SHA-256 of the words of each span, once per text of a batch."""
    for batch in batches:
        lists, digests, texts = batch.column("spans"), batch.column("digest").to_pylist(), batch.column("text")
        starts, rows = lists.offsets.to_numpy(), lists.values
        first_all, n_all = rows.field("first").to_numpy(), rows.field("n").to_numpy()
        for digest, row in dict(zip(digests, range(batch.num_rows))).items():
            words = words_of(texts[row].as_py(), lower=False)
            data, ends = b" ".join(words), np.cumsum(np.array([0, *[len(w) + 1 for w in words]], np.int64))
            a, b = int(starts[row]), int(starts[row + 1])
            first = first_all[a:b]
            spans = zip(ends[first].tolist(), (ends[first + n_all[a:b] + window - 1] - 1).tolist())
            hashes = np.frombuffer(b"".join([hashlib.sha256(data[x:y]).digest()[:16] for x, y in spans]), np.int64)
            own = rows.slice(a, b - a)
            columns = [pa.array([digest] * (b - a), pa.binary()), *(own.field(c) for c in ("first", "chain", "edge", "times")), pa.array(hashes[0::2]), pa.array(hashes[1::2])]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _CUT.split(", ")])


def _hashed(texts: DataFrame, spans: DataFrame, window: int, name: str) -> DataFrame:
    """``spans`` (digest, first, n, chain, edge, times) with the hash of the words at their coordinates, for every
    batch that holds a copy of the text."""
    lists = spans.groupBy("digest").agg(F.collect_list(F.struct("first", "n", "chain", "edge", "times")).alias("spans"))
    cut = texts.join(lists, "digest").select("digest", "text", "spans")
    return staged(cut.mapInArrow(lambda it: _cuts(it, window), _CUT), name)


def _verified(texts: DataFrame, spans: DataFrame, single: DataFrame, stand: DataFrame, members: DataFrame, edges: DataFrame, window: int) -> DataFrame:
    """Per digest the ``spans`` (first word, edges or a bit set of edges) whose words occur twice."""
    empty, one = F.lit(None).cast("long"), F.lit(1).cast("long")
    mark = F.explode(F.arrays_zip("at", "own"))
    windows = single.select("digest", "first", mark.alias("m")).select("digest", (F.col("first") + F.col("m.at")).alias("first"), F.col("m.own").alias("edge"))
    asked = spans.select("digest", "first", "n", "chain", empty.alias("edge"), "times")
    asked = asked.unionByName(windows.unionByName(stand).select("digest", "first", one.alias("n"), empty.alias("chain"), "edge", one.alias("times")))
    cut = _hashed(texts, asked, window, "cuts")
    by_chain, by_window = cut.where("chain IS NOT NULL").drop("edge"), cut.where("edge IS NOT NULL")
    differ = (F.min("s1") != F.max("s1")) | (F.min("s2") != F.max("s2"))
    odd_edges = staged(by_window.groupBy("edge").agg(differ.alias("odd")).where("odd").select("edge"), "differing-edges")
    odd_chains = by_chain.groupBy("chain").agg(differ.alias("odd")).where("odd").select("chain")
    holders = edges.where("times > 1").join(odd_edges, "edge", "left_semi").select("path").distinct() if odd_edges.head(1) else None
    if holders is not None:
        odd_chains = odd_chains.union(members.join(holders, "path", "left_semi").select("chain"))
    odd_chains = staged(odd_chains.distinct(), "differing-chains")

    # equal words wherever the hashes are equal: all of it occurs twice
    bits = F.aggregate("at", F.lit(0).cast("long"), lambda x, i: x.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))))
    if holders is None and not odd_chains.head(1):
        good = spans.select("digest", "first", "n", empty.alias("bits")).unionByName(single.select("digest", "first", empty.alias("n"), bits.alias("bits")))
        return good.groupBy("digest").agg(F.collect_list(F.struct("first", "n", "bits")).alias("spans"))

    good = spans.join(odd_chains, "chain", "left_anti").select("digest", "first", "n")
    good = good.unionByName(windows.join(odd_edges, "edge", "left_anti").select("digest", "first", one.alias("n")))
    each = spans.join(odd_chains, "chain", "left_semi").select("digest", F.explode(F.expr("sequence(first, first + n - 1)")).alias("first"), "times")
    each = each.select("digest", "first", one.alias("n"), empty.alias("chain"), empty.alias("edge"), "times")
    # windows of one place agree in their words; the greater count knows the copies of the text
    doubtful = by_window.select("digest", "first", "s1", "s2", "times")
    doubtful = doubtful.unionByName(_hashed(texts, each, window, "single-cuts").select("digest", "first", "s1", "s2", "times"))
    doubtful = doubtful.groupBy("digest", "first", "s1", "s2").agg(F.max("times").alias("times"))
    twice = doubtful.groupBy("s1", "s2").agg(F.sum("times").alias("m")).where("m > 1").select("s1", "s2")
    good = good.unionByName(doubtful.join(twice, ["s1", "s2"], "left_semi").select("digest", "first", one.alias("n")))
    return good.select("*", empty.alias("bits")).groupBy("digest").agg(F.collect_list(F.struct("first", "n", "bits")).alias("spans"))


def _covered(n: int, spans: list[dict], window: int) -> np.ndarray:
    """Words of a text of ``n`` words that lie in a repeated window."""
    change = np.zeros(n + 1, np.int64)
    for s in spans:
        first, bits = s["first"], s["bits"]
        if bits is None:
            change[first] += 1
            change[first + s["n"] + window - 1] -= 1
        while bits:
            if bits & 1:
                change[first] += 1
                change[first + window] -= 1
            bits, first = bits >> 1, first + 1
    return np.cumsum(change[:n]) > 0


def _digest(text_col: str) -> Column:
    """16 bytes of SHA-256."""
    return F.unhex(F.substring(F.sha2(text_or_empty(text_col).cast("binary"), 256), 1, 32))


def _with_spans(docs: DataFrame, text_col: str, window: int, name: str) -> DataFrame:
    """``docs`` with its spans (null without any) in column ``name``."""
    spans = repeated_spans(docs.select(_digest(text_col).alias("digest"), text_or_empty(text_col).alias("text")), window)
    key = unused(docs, "digest")
    spans = spans.select(F.col("digest").alias(key), F.col("spans").alias(name))
    return docs.withColumn(key, _digest(text_col)).join(spans, key, "left").drop(key)


def _summary(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    for batch in text_runs(batches, TEXT_RUN):
        rows = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            words, gone = words_of(text, lower=False), 0
            kept = words
            if spans:
                covered = _covered(len(words), spans, window)
                gone, kept = int(covered.sum()), [w for w, c in zip(words, covered.tolist()) if not c]
            rows.append((doc_id, len(words), gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def repeat_report(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return _with_spans(rows, "text", window, "spans").select("doc_id", "text", "spans").mapInArrow(
        lambda it: _summary(it, window), "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def _cutter(window: int) -> Callable[[Column, Column], Column]:
    # Arrow: pandas would turn the longs of a struct to doubles where one of a batch is null
    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        def one(text: str | None, own) -> str | None:
            if text is None:
                return None
            data = text.encode()
            pieces = _TOKENS.findall(data)
            covered = _covered(len(pieces), own, window)
            head = data[: len(data) - sum(map(len, pieces))]  # white space before the first word
            return (head + b"".join([p for p, c in zip(pieces, covered.tolist()) if not c])).decode()

        runs = text_runs(iter([pa.RecordBatch.from_arrays([texts, spans], names=["text", "spans"])]), TEXT_RUN)
        done = [pa.array([one(t, s) for t, s in zip(r.column("text").to_pylist(), r.column("spans").to_pylist())], pa.string()) for r in runs]
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` without the words that repeated windows cover; all rows and columns stay."""
    name = unused(docs, "spans")
    found = _with_spans(docs, text_col, window, name)
    touched, text = F.col(name).isNotNull(), F.col(text_col)
    # the texts that stay do not go through Python
    new = _cutter(window)(F.when(touched, text), F.col(name))
    return found.withColumn(text_col, F.when(touched, new).otherwise(text)).select(*docs.columns)
