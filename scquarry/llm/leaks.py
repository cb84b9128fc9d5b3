"""Evaluation passages inside corpus documents: CGK embedding, bit-sampling LSH over windows, exact edit verification."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Consecutive words of a passage that make a leak: the size of what is sought, and of the windows of texts and passages alike.
RUN = 12
#: Edits of a word (one replaced, put in or left out) within which a window still matches.
EDITS = 2
#: Steps of a random walk; walks; signatures drawn from each walk; steps that a signature samples, one from each equal stretch of
#: the walk. Chosen for a recall of 0.9 of the pairs of windows that are EDITS edits apart. Measured on random windows: one edit
#: 1.00, two replaced 0.97, one replaced and one put in or left out 0.96, two put in 0.93, two left out 0.92.
STEPS, WALKS, SIGNATURES, SAMPLED = 20, 16, 3, 6
#: Two windows within EDITS edits share at least RUN - q + 1 - q * EDITS runs of q words; those of these lengths are looked up.
GRAMS = (2, 3, 4)
#: Bits of a filter for each of its entries, and at most: beyond 128 MB a filter lets more through, but never too little.
FILTER_SHARE, FILTER_BITS = 32, 1 << 30
#: Windows of passages up to which their signatures (no more than 70 MB) go to every task; beyond it windows are joined by signature.
BROADCAST_WINDOWS = 100_000
#: Words that a task looks at together, pairs of windows that it compares together.
BATCH_WORDS, BATCH_PAIRS = 40_000, 50_000

_REACH = RUN + EDITS
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_PAD = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """The words of a text: longest runs of letters and digits, without case, accents and markup tags."""
    s = _TAG.sub(" ", text).casefold() if "<" in text else text.casefold()
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
    return _WORD.findall(s)


def codes(text: str, memo: dict[str, int]) -> list[int]:
    out = []
    for w in words(text):
        if (c := memo.get(w)) is None:
            c = xxhash.xxh64_intdigest(w)
            if len(memo) < 300_000:
                memo[w] = c
        out.append(c)
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def signatures(code: np.ndarray, starts: np.ndarray, seed: int = 7) -> Iterator[np.ndarray]:
    """The signatures of each window of RUN words, one array per table: sampled places of its CGK embeddings.

    A walk stands at one word of the window, writes it down at every step and goes on to the next word if the step's random
    function of the word says so; both windows of a pair walk by the same functions, so that a few edits change few of the
    places written. Each walk gives several samples of its places. Equal windows always have equal signatures.
    """
    padded = np.r_[code, np.full(1, _PAD)]
    end = starts + RUN
    for walk in range(WALKS):
        rng = np.random.default_rng([seed, walk])
        go = _mix(padded ^ np.uint64(rng.integers(1, 2**63)))
        factors = np.zeros((SIGNATURES, STEPS), np.uint64)
        for s in range(SIGNATURES):
            edges = [STEPS * i // SAMPLED for i in range(SAMPLED + 1)]
            factors[s, [int(rng.integers(*e)) for e in zip(edges, edges[1:])]] = rng.integers(1, 2**63, SAMPLED, dtype=np.uint64) | np.uint64(1)
        at, out = starts.copy(), np.zeros((SIGNATURES, len(starts)), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(STEPS):
                here = np.where(at < end, at, len(code))
                for s in np.flatnonzero(factors[:, j]):
                    out[s] += padded[here] * factors[s, j]
                at += ((go[here] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
        for s in range(SIGNATURES):
            # the table's number goes into the signature: those of different tables are told apart by it
            yield _mix(out[s] ^ np.uint64((int(_PAD) * (walk * SIGNATURES + s + 1)) & 0xFFFFFFFFFFFFFFFF))


def grams(code: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q words from each place on."""
    h = np.full(max(0, len(code) - q + 1), q, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(q):
            h = h * np.uint64(0x9E3779B185EBCA87) + code[j : j + len(h)]
    return _mix(h)


def edit_distance(passage: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The fewest edits of a word that turn each row of passage into the beginning, of any length, of the same row of text."""
    n, m = passage.shape[1], text.shape[1]
    row = [np.full(len(text), j) for j in range(m + 1)]
    for i in range(1, n + 1):
        new = [np.full(len(text), i)]
        for j in range(1, m + 1):
            new.append(np.minimum(np.minimum(row[j], new[j - 1]) + 1, row[j - 1] + (passage[:, i - 1] != text[:, j - 1])))
        row = new
    return np.min(row, axis=0)


def near_pairs(passage: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of passage and text are within EDITS edits, and their edits."""
    # a word that isn't edited stands in both, moved by EDITS places at most
    shared = np.zeros(len(text), np.int64)
    for move in range(-EDITS, EDITS + 1):
        low = max(0, -move)
        shared += (passage[:, low:] == text[:, low + move : RUN + move]).sum(axis=1)
    at = np.flatnonzero(shared >= RUN - EDITS)
    e = edit_distance(passage[at], text[at])
    return at[e <= EDITS], e[e <= EDITS]


class Index:
    """The signatures of all windows of passages, in order, for the tasks."""

    def __init__(self, part: np.ndarray, table: np.ndarray) -> None:
        self.part, self.words = part, table
        self.tables = []
        for s in signatures(table.ravel(), np.arange(len(table)) * RUN):
            order = np.argsort(s, kind="stable")
            self.tables.append((s[order], order.astype(np.int32)))

    def candidates(self, code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a window of code and a window of a passage (their numbers) with equal signatures in any table."""
        pairs = [np.zeros(0, np.int64)]
        for (known, order), s in zip(self.tables, signatures(code, starts)):
            low, high = np.searchsorted(known, s, "left"), np.searchsorted(known, s, "right")
            hit = np.flatnonzero(high > low)
            count = (high - low)[hit]
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pairs.append(hit.repeat(count) * len(self.part) + order[low[hit].repeat(count) + inner])
        both = np.unique(np.concatenate(pairs))
        return both // max(1, len(self.part)), both % max(1, len(self.part))


class Filter:
    """Hashes that may be there: two bits of each are set."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.shift = bits, np.uint64(64 - int(math.log2(len(bits) * 8)))

    @staticmethod
    def places(h: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            return h >> shift, (h * np.uint64(0xC2B2AE3D27D4EB4F)) >> shift

    def has(self, h: np.ndarray) -> np.ndarray:
        a, b = self.places(h, self.shift)
        test = lambda p: (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
        out = test(a).astype(bool)
        out[out] = test(b[out]).astype(bool)
        return out


def filter_of(hashes: DataFrame, entries: int) -> Filter:
    """A filter of the hashes (one bigint column), set by the tasks in parts of 64 KB that are joined by part."""
    size = min(FILTER_BITS, 1 << max(19, math.ceil(math.log2(FILTER_SHARE * max(entries, 1))))) // 8
    shift, part = np.uint64(64 - int(math.log2(size * 8))), 1 << 16

    def give(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([v.tobytes() for v in parts.values()], pa.binary())], ["part", "bits"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for p in Filter.places(b.column(0).to_numpy().view(np.uint64), shift):
                p = np.unique(p)
                byte, bit = (p >> np.uint64(3)).astype(np.int64), np.left_shift(1, (p & np.uint64(7)).astype(np.int64)).astype(np.uint8)
                for k in np.unique(byte // part).tolist():
                    own = byte // part == k
                    np.bitwise_or.at(parts.setdefault(k, np.zeros(part, np.uint8)), byte[own] % part, bit[own])
        yield give(parts)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(v, np.uint8)
                parts[k] = parts[k] | x if k in parts else x
        yield give(parts)

    out = np.zeros(size, np.uint8)
    schema = "part int, bits binary"
    for r in hashes.mapInArrow(fill, schema).repartition("part").mapInArrow(join, schema).toLocalIterator():
        out[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["bits"], np.uint8)
    return Filter(out)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of width words each as a table of words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width)


def _row_hash(table: np.ndarray) -> np.ndarray:
    h = np.zeros(len(table), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(table.shape[1]):
            h = _mix(h * np.uint64(0x9E3779B185EBCA87) + table[:, j])
    return h


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(np.asarray(c).view(np.int64) if np.asarray(c).dtype == np.uint64 else c) for c in columns], names)


def _binary(table: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in table], pa.binary())


def _read_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict[str, int] = {}
    for b in batches:
        rows = [(i, np.array(codes(p, memo), np.uint64)) for i, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        rows = [(i, c) for i, c in rows if len(c) >= RUN]
        packed = [c.tobytes() for _, c in rows]
        keys = np.array([xxhash.xxh64_intdigest(p) for p in packed], np.uint64)
        yield _batch(["item_id", "passage", "words"], pa.array([i for i, _ in rows], pa.string()), keys, pa.array(packed, pa.binary()))


def _passage_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for passage, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            table = np.lib.stride_tricks.sliding_window_view(np.frombuffer(packed, np.uint64), RUN)
            yield _batch(["passage", "place", "part", "part_words"], np.full(len(table), passage, np.int64), np.arange(len(table), dtype=np.int64), _row_hash(table), _binary(table))


def _passage_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for packed in b.column(0).to_pylist():
            yield _batch(["h"], np.concatenate([grams(np.frombuffer(packed, np.uint64), q) for q in GRAMS]))


def _sign(width: int, shared=None):
    """For mapInArrow: the signatures (key) of windows (id, words); only those that a filter lets through, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 4096):
                b = big.slice(at, 4096)
                code, ids = _rows(b.column(1), width).ravel(), b.column(0).to_numpy()
                for s in signatures(code, np.arange(b.num_rows) * width):
                    use = np.ones(len(s), bool) if shared is None else shared.value.has(s)
                    yield _batch(["key", "id"], s[use], ids[use])

    return run


def _windows(held: list[tuple[int, list[int]]], known: Filter) -> tuple[np.ndarray, ...]:
    """Of some texts: their words end to end, the starts of the windows that may match, and of these the text's id and the place in it,
    and the words from there on as far as EDITS edits can reach."""
    code = np.array([x for _, c in held for x in c], np.uint64)
    size = np.array([len(c) for _, c in held], np.int64)
    begin = np.cumsum(size) - size
    count = np.maximum(size - RUN + 1, 0)
    of = np.repeat(np.arange(len(held)), count)
    pos = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    starts = begin[of] + pos
    may = np.ones(len(starts), bool)
    for q in GRAMS:
        have = np.r_[0, np.cumsum(known.has(grams(code, q)))]
        may &= have[np.minimum(starts + _REACH - q + 1, len(have) - 1)] - have[starts] >= RUN - q + 1 - q * EDITS
    starts, of, pos = starts[may], of[may], pos[may]
    place = starts[:, None] + np.arange(_REACH)
    table = np.where(place < (begin + size)[of][:, None], code[np.minimum(place, len(code) - 1)], np.uint64(0))
    return code, starts, np.array([i for i, _ in held], np.int64)[of], pos, table


def _scan(each: Callable[[list], pa.RecordBatch]) -> Callable:
    """For mapInArrow: each() on the words of some texts of RUN words or more at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        held, size = [], 0
        for b in batches:
            for i, s in zip(b.column(0).to_pylist(), b.column(1)):
                c = codes(s.as_py(), memo)
                if len(c) >= RUN:
                    held.append((i, c))
                    size += len(c)
                if size >= BATCH_WORDS:
                    yield each(held)
                    held, size = [], 0
        if held:
            yield each(held)

    return run


def _matches(shared_grams, shared_index) -> Callable:
    """Windows within EDITS edits of a passage's, by the index: doc_id, pos, part, edits."""

    def each(held: list) -> pa.RecordBatch:
        index = shared_index.value
        code, starts, ids, pos, table = _windows(held, shared_grams.value)
        i, j = index.candidates(code, starts)
        near, edits = [], []
        for at in range(0, len(i), BATCH_PAIRS):
            n, e = near_pairs(index.words[j[at : at + BATCH_PAIRS]], table[i[at : at + BATCH_PAIRS]])
            near.append(n + at)
            edits.append(e)
        n = np.concatenate(near) if near else np.zeros(0, np.int64)
        return _batch(["doc_id", "pos", "part", "edits"], ids[i[n]], pos[i[n]], index.part[j[n]], pa.array(np.concatenate(edits) if edits else [], pa.int32()))

    return _scan(each)


def _candidates(shared_grams, shared_keys) -> Callable:
    """Windows with a signature that some passage has: doc_id, pos, stretch, and their words where a task first sees them."""
    seen: set[int] = set()

    def each(held: list) -> pa.RecordBatch:
        code, starts, ids, pos, table = _windows(held, shared_grams.value)
        hit = np.zeros(len(starts), bool)
        for s in signatures(code, starts):
            hit |= shared_keys.value.has(s)
        ids, pos, table = ids[hit], pos[hit], table[hit]
        key = _row_hash(table)
        if len(seen) > 500_000:
            seen.clear()
        packed = []
        for k, r in zip(key.tolist(), table):
            packed.append(None if k in seen else r.tobytes())
            seen.add(k)
        return _batch(["doc_id", "pos", "stretch", "words"], ids, pos, key, pa.array(packed, pa.binary()))

    return _scan(each)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in batches:
        for at in range(0, big.num_rows, BATCH_PAIRS):
            b = big.slice(at, BATCH_PAIRS)
            n, e = near_pairs(_rows(b.column(3), RUN), _rows(b.column(2), _REACH))
            yield _batch(["stretch", "part", "edits"], b.column(0).take(pa.array(n)), b.column(1).take(pa.array(n)), pa.array(e, pa.int32()))


def passages_of(items: DataFrame, item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """Items by equal passage: passage (a hash of its words), item_id, words; those with fewer than RUN words are left out."""
    given = items.select(F.col(item_id).cast("string"), F.col(passage)).toDF("i", "p").filter("i IS NOT NULL AND p IS NOT NULL")
    return given.mapInArrow(_read_passages, "item_id string, passage bigint, words binary")


def members_of(items: DataFrame, item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """item_id, member: for the least item of every passage all items that have it."""
    read = passages_of(items, item_id, passage).select("passage", "item_id").distinct()
    return read.groupBy("passage").agg(F.min("item_id").alias("least"), F.collect_set("item_id").alias("all")).select(F.col("least").alias("item_id"), F.explode("all").alias("member"))


def find_leaks(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage", broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """Documents that share stretches of RUN words with passages: doc_id, item_id, n_items, run_words, windows, edits.

    There is one row per document and passage. item_id is the least id of the n_items items that have the passage (members_of()
    gives them all); run_words the length of the longest run of consecutive words that both have (0 if shorter than RUN: every run
    of RUN words or more is found, whatever the random functions); windows the number of the document's windows of RUN words that
    match within EDITS edits of a word, each found with a probability of 0.9 or more; edits the least of these.

    Passages and texts are cut into windows of RUN words, one from every word on. Windows are embedded by random walks (CGK) so
    that edits change few places, and sampled places make signatures. Windows that share too few runs of words with all passages
    together can't be within EDITS edits of any and aren't embedded; a filter of bounded size tells. One pass over the corpus finds
    the windows that share a signature with a passage's. Up to broadcast_windows windows of passages the tasks hold their signatures
    and compare word by word at once. Beyond that, the tasks send the windows that have a signature of some passage (by a second
    filter), and these are joined with the passages' by signature: equal windows, of texts as of passages, are joined and compared
    once, so that boilerplate and copies make no hot signature. Both ways give the same rows.

    Null, blank or too short texts and passages match nothing; rows without an id are left out; repeated rows of a document or an
    item count once; extra columns are ignored.
    """
    spark = documents.sparkSession
    broadcast = spark.sparkContext.broadcast
    read = passages_of(items, item_id, passage)
    classes = materialize(read.groupBy("passage").agg(F.min("item_id").alias("item_id"), F.countDistinct("item_id").alias("n_items"), F.first("words").alias("words")), "passages")
    total = classes.agg(F.coalesce(F.sum(F.length("words")), F.lit(0)).alias("n")).first()["n"] // 8
    shared_grams = broadcast(filter_of(classes.select("words").mapInArrow(_passage_grams, "h bigint"), total * len(GRAMS)))
    places = materialize(classes.select("passage", "words").mapInArrow(_passage_windows, "passage bigint, place bigint, part bigint, part_words binary"), "places")
    parts = places.groupBy("part").agg(F.first("part_words").alias("part_words"))
    corpus = documents.select(F.col(doc_id).cast("bigint"), F.col(text)).toDF("i", "t").filter("i IS NOT NULL AND t IS NOT NULL")
    if total <= broadcast_windows:
        got = parts.toArrow().combine_chunks()  # at most broadcast_windows rows of 104 bytes
        index = Index(got.column(0).to_numpy(), _rows(got.column(1), RUN))
        near = corpus.mapInArrow(_matches(shared_grams, broadcast(index)), "doc_id bigint, pos bigint, part bigint, edits int")
    else:
        signed = materialize(parts.mapInArrow(_sign(RUN), "key bigint, id bigint"), "signed")
        shared_keys = broadcast(filter_of(signed.select("key"), total * WALKS * SIGNATURES))
        found = materialize(corpus.mapInArrow(_candidates(shared_grams, shared_keys), "doc_id bigint, pos bigint, stretch bigint, words binary"), "windows")
        stretches = materialize(found.filter("words IS NOT NULL").groupBy("stretch").agg(F.first("words").alias("words")), "stretches")
        keys = stretches.mapInArrow(_sign(_REACH, shared_keys), "key bigint, id bigint").withColumnRenamed("id", "stretch")
        pairs = keys.join(signed.withColumnRenamed("id", "part"), "key").select("stretch", "part").distinct()
        pairs = pairs.join(stretches, "stretch").join(parts, "part").select("stretch", "part", "words", "part_words")
        near = materialize(pairs.mapInArrow(_verify, "stretch bigint, part bigint, edits int"), "near")
        near = found.select("doc_id", "pos", "stretch").join(near, "stretch").select("doc_id", "pos", "part", "edits")
    each = near.join(places.select("part", "passage", "place"), "part").groupBy("doc_id", "passage", "pos", "place").agg(F.min("edits").alias("edits"))
    # windows that match exactly one after the other on a diagonal make a run
    line = W.partitionBy("doc_id", "passage", "line").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    each = each.withColumn("line", F.col("pos") - F.col("place"))
    each = each.withColumn("gap", F.when(F.col("edits") == 0, F.col("pos") - F.sum(F.expr("int(edits = 0)")).over(line)))
    runs = each.groupBy("doc_id", "passage", "line", "gap").agg(F.count(F.lit(1)).alias("n"), F.collect_set("pos").alias("at"), F.min("edits").alias("edits"))
    length = F.max(F.when(F.col("gap").isNotNull(), F.col("n") + (RUN - 1)))
    matched = F.size(F.array_distinct(F.flatten(F.collect_list("at"))))
    whole = runs.groupBy("doc_id", "passage").agg(F.coalesce(length, F.lit(0)).cast("int").alias("run_words"), matched.alias("windows"), F.min("edits").alias("edits"))
    return whole.join(classes.select("passage", "item_id", "n_items"), "passage").select("doc_id", "item_id", "n_items", "run_words", "windows", "edits")
