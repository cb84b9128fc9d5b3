"""Subjects of documents: weighted terms, truncated singular value decomposition, cosine similarity to refined seed centroids."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scquarry.session import materialize

#: Labelled documents that seed the subjects, about so many at most, the same number of each subject where there are more, taken by a
#: hash of their id (all other statistics cover all documents).
MAX_LABELLED = 20_000
#: Terms are hashed to so many places, whatever their number: none is left out for being rare among many, and a task's or the
#: driver's tables never have more rows. Terms that share a place count as one. A place counts if so many documents have it.
PLACES, MIN_DOCUMENTS = 1 << 17, 3
#: Terms that tell less than this about subjects (0: nothing, 1: all) get no weight.
LEAST_TOPICALITY = 0.1
#: Dimensions kept and extra ones computed, subspace iterations, rounds of weighting and embedding, refinements in each.
DIMS, EXTRA, POWER, ROUNDS, REFINEMENTS = 64, 16, 2, 2, 2
#: Cosine above which a document moves a centroid.
CONFIDENT = 0.6
#: A sentence is on the subject of the nearest centroid if that is at least so near and if its embedding is at least this
#: part of a typical topical term's weight long.
LEAST_COSINE, LEAST_LENGTH = 0.12, 0.06
#: A document deals with a subject of at least so many sentences and such a share of its sentences on any, with three at most.
SENTENCES, SENTENCE_SHARE, MOST = 2, 0.15, 3
#: Seeds are kept apart by a document's language where a subject has this many labelled documents in it and this share of its own; a
#: subject without such a language has one centroid of all its seeds.
LEAST_SEEDS, SEED_SHARE = 2, 0.02

_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
#: A run of letters, hyphens within it kept, that no digit touches.
_TERM = re.compile(r"(?<![\w-])[^\W\d_]{3,}(?:-[^\W\d_]+)*(?![\w-])")


def sentences(text: str) -> list[list[str]]:
    """The terms of each sentence: words of three letters or more, hyphens kept, without codes and numbers."""
    return [_TERM.findall(s) for s in _SENTENCE.split((_TAG.sub(" ", text) if "<" in text else text).lower())]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of the terms of each sentence (-1 ends it), and the distinct ones of the text with their frequencies."""
    memo: dict[str, int] = {}

    def place(w: str) -> int:
        if (x := memo.get(w)) is None:
            x = xxhash.xxh64_intdigest(w) % PLACES
            if len(memo) < 300_000:
                memo[w] = x
        return x

    for b in batches:
        packed, distinct, times = [], [], []
        for s in b.column("text"):
            codes = np.array([x for st in sentences(s.as_py()) for x in [*map(place, st), -1]], np.int32)
            packed.append(codes.tobytes())
            t, n = np.unique(codes[codes >= 0], return_counts=True)
            distinct.append(t.astype(np.int32).tobytes())
            times.append(n.astype(np.float32).tobytes())
        binary = [pa.array(x, pa.binary()) for x in (packed, distinct, times)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), *binary], ["doc_id", "lang", "codes", "terms", "times"])


def _sum_vectors(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums of vectors by key, added up in parallel; keys and lengths are bounded by the callers' parameters."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(v.as_buffer(), np.float64)
                sums[k] = sums[k] + x if k in sums else x
        yield _vectors(sums.keys(), sums.values())

    return {r["key"]: np.frombuffer(r["vector"], np.float64) for r in parts.repartition("key").mapInArrow(add, "key int, vector binary").toLocalIterator()}


def _vectors(keys, vectors) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(keys), pa.int32()), pa.array([v.tobytes() for v in vectors], pa.binary())], ["key", "vector"])


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column end to end, and how many each row has."""
    packed = column.to_pylist()
    return np.frombuffer(b"".join(packed), kind), np.array([len(p) for p in packed], np.int64) // np.dtype(kind).itemsize


def entries(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and frequency of the distinct terms of encoded documents, sorted by row and term."""
    code, lengths = _flat(b.column("terms"), np.int32)
    return np.repeat(np.arange(b.num_rows), lengths), code, _flat(b.column("times"), np.float32)[0]


class Weights:
    """The weight of every place, and the number (in order) of those with any."""

    def __init__(self, weight: np.ndarray) -> None:
        self.weight, self.used = weight, np.flatnonzero(weight > 0)
        self.number = np.full(len(weight), -1)
        self.number[self.used] = np.arange(len(self.used))


class Sparse:
    """Weighted term vectors of unit length of some documents, as triplets sorted by row; columns are the places with a weight."""

    def __init__(self, b: pa.RecordBatch, weights: Weights) -> None:
        row, code, n = entries(b)
        use = weights.number[code] >= 0
        self.rows, self.row, self.col = b.num_rows, row[use], weights.number[code[use]]
        value = (1 + np.log(n[use])) * weights.weight[code[use]]
        norm = np.sqrt(np.bincount(self.row, value**2, self.rows))
        self.value = value / norm[self.row]

    def times(self, m: np.ndarray) -> np.ndarray:
        out = np.zeros((self.rows, m.shape[1]))
        if len(self.row):
            first = np.flatnonzero(np.r_[True, self.row[1:] != self.row[:-1]])
            out[self.row[first]] = np.add.reduceat(m[self.col] * self.value[:, None], first, axis=0)
        return out

    def transposed_times(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The columns that occur and their rows of the product."""
        order = np.argsort(self.col, kind="stable")
        col = self.col[order]
        first = np.flatnonzero(np.r_[True, col[1:] != col[:-1]])
        return col[first], np.add.reduceat(m[self.row[order]] * self.value[order][:, None], first, axis=0)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


class _Pass:
    """Sums over all documents, made where they lie: each(batch) gives (keys, vectors) to be added up."""

    def __init__(self, docs: DataFrame, rows: int = 500) -> None:
        # a task sends one vector per term that it saw: few large tasks send less than many small ones
        self.docs, self.rows = docs.coalesce(max(1, 2 * docs.sparkSession.sparkContext.defaultParallelism)), rows

    def sums(self, each: Callable) -> dict[int, np.ndarray]:
        rows = self.rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for big in batches:
                for at in range(0, big.num_rows, rows):
                    keys, vectors = each(big.slice(at, rows))
                    for k, v in zip(keys, vectors):
                        total[k] = total[k] + v if (k := int(k)) in total else v
            yield _vectors(total.keys(), total.values())

        return _sum_vectors(self.docs.mapInArrow(run, "key int, vector binary"))


def document_frequency(docs: _Pass) -> tuple[int, np.ndarray]:
    """The number of documents and, by place, of those that have it."""
    step = PLACES // 32

    def each(b):
        n = np.bincount(entries(b)[1], minlength=PLACES).astype(float)
        return [*range(32), 32], [*n.reshape(32, step), np.array([float(b.num_rows)])]

    s = docs.sums(each)
    return int(s[32][0]) if 32 in s else 0, np.concatenate([s[i] for i in range(32)]) if 32 in s else np.zeros(PLACES)


def topicality(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """How much each term tells about the subject: one less the entropy of its subject, scaled down for rare terms.

    counts: by term and subject, the documents of the subject that have the term; documents: those of the subject.
    """
    k = counts.shape[1]
    rate = (counts + 1.0 / k) / (documents + 1.0)
    p = rate / rate.sum(axis=1, keepdims=True)
    told = 1 + (p * np.log(p)).sum(axis=1) / np.log(k)
    total = counts.sum(axis=1)
    out = told * total / (total + 2.0)
    return np.where(out < LEAST_TOPICALITY, 0.0, out)


def truncated_svd(docs: _Pass, shared_weights, start: np.ndarray | None, spark) -> np.ndarray:
    """The leading right singular vectors (weighted places x DIMS) of the documents' weighted term vectors, by subspace iteration."""
    size = len(shared_weights.value.used)
    width = min(DIMS + EXTRA, size)
    q = np.random.default_rng(5).standard_normal((size, width))
    q = np.linalg.qr(q if start is None else np.hstack([start, q])[:, :width])[0]
    for _ in range(POWER + (start is None)):
        shared = spark.sparkContext.broadcast(q)

        def each(b, shared=shared):
            x = Sparse(b, shared_weights.value)
            return x.transposed_times(x.times(shared.value)) if len(x.row) else ((), ())

        z = np.zeros((size, width))
        for k, v in docs.sums(each).items():
            z[k] = v
        q, r = np.linalg.qr(z)
    # q spans the subspace; turned so that its first columns are the leading directions
    u, _, _ = np.linalg.svd(r)
    return (q @ u)[:, : min(DIMS, width)]


def assign_subjects(documents: DataFrame, labels: DataFrame, subjects: list[str], doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The subjects that each document deals with: (doc_id, subject), none to three per document.

    labels has doc_id and subject, some of them wrong; documents with one label seed the subjects (MAX_LABELLED of them at
    most). Terms are weighted by rarity among all documents and by what they tell about subjects; the weighted documents are
    embedded by truncated singular value decomposition; seed centroids, one per subject and language, are refined with all
    documents near them. The assigned documents then take the place of the labels for another round of weighting and
    embedding. At last the sentences of each document are embedded and go to the nearest centroid if any is near; general
    sentences have next to no weight. A document deals with subjects of SENTENCES sentences or more that make up SENTENCE_SHARE
    of its sentences on any subject.

    Terms are hashed to PLACES places, so that each text is read once and no term is dropped. Null, blank and general texts have no subject; copies have equal subjects; repeated rows give repeated results; null labels
    and labels of unknown subjects or documents are ignored; without labels there are no subjects.
    """
    spark = documents.sparkSession
    schema = "doc_id bigint, subject string"
    used = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.lower(F.trim(F.col(lang))), F.lit("")).alias("lang"), F.col(text).alias("text")).filter("text IS NOT NULL AND doc_id IS NOT NULL")
    encoded = materialize(used.mapInArrow(_encode, "doc_id bigint, lang string, codes binary, terms binary, times binary"), "encoded")
    all_docs = _Pass(encoded.select("terms", "times"))
    total, frequency = document_frequency(all_docs)
    if not (frequency >= MIN_DOCUMENTS).any():
        return spark.createDataFrame([], schema)
    rarity = np.where(frequency >= MIN_DOCUMENTS, np.log(1 + total / np.maximum(frequency, 1)), 0.0)
    number = F.create_map(*[x for i, s in enumerate(subjects) for x in (F.lit(s), F.lit(i))])
    single = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), number[F.col("subject")].alias("s")).filter("s IS NOT NULL").groupBy("doc_id").agg(F.min("s").alias("s"), F.max("s").alias("_m")).filter("s = _m").drop("_m")
    had = single.groupBy("s").agg(F.least(F.lit(1.0), F.lit(MAX_LABELLED / len(subjects)) / F.count(F.lit(1))).alias("_take"))  # one row per subject
    single = single.join(F.broadcast(had), "s").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("_take") * 1_000_000).drop("_take")
    seeds = materialize(encoded.drop("codes").join(single, "doc_id").select("s", "lang", "terms", "times"), "seeds")
    by_lang = {(r["s"], r["lang"]): r["count"] for r in seeds.groupBy("s", "lang").count().collect()}  # about MAX_LABELLED rows at most
    if not by_lang:
        return spark.createDataFrame([], schema)
    own = Counter()
    for (x, _), n in by_lang.items():
        own[x] += n
    apart = sorted(x for x, n in by_lang.items() if n >= max(LEAST_SEEDS, SEED_SHARE * own[x[0]]))
    alone = sorted(set(own) - {x for x, _ in apart})
    group = {x: i for i, x in enumerate(apart)} | {x: len(apart) + alone.index(x[0]) for x in by_lang if x[0] in alone}
    subject_of = np.array([x for x, _ in apart] + alone)
    groups, size, k = len(subject_of), PLACES, len(subjects)

    def counts_of(rows: _Pass, subject: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Documents by term and subject and by subject, of the documents to which subject(batch) gives one (else -1)."""

        def each(b):
            s = subject(b)
            row, code, _ = entries(b)
            of = s[row]
            pair, n = np.unique(code[of >= 0].astype(np.int64) * k + of[of >= 0], return_counts=True)
            first = np.flatnonzero(np.r_[True, pair[1:] // k != pair[:-1] // k]) if len(pair) else []
            out = np.zeros((len(first), k))
            out[np.cumsum(np.isin(np.arange(len(pair)), first)) - 1, pair % k] = n
            return [*(pair[first] // k), size], [*out, np.bincount(s[s >= 0], minlength=k).astype(float)]

        c, d = np.zeros((size, k)), np.zeros(k)
        for key, v in rows.sums(each).items():
            if key == size:
                d = v
            else:
                c[key] = v
        return c, d

    seed_docs = _Pass(seeds)
    counts, have = counts_of(seed_docs, lambda b: np.array(b.column("s").to_pylist(), int))
    start = None
    for _ in range(ROUNDS):
        weights = Weights(rarity * topicality(counts, have))
        if not len(weights.used):
            return spark.createDataFrame([], schema)
        shared = spark.sparkContext.broadcast(weights)
        if start is not None:  # the places that had a weight before and have one now
            old, basis = start
            start = np.zeros((len(weights.used), basis.shape[1]))
            both = old.number[weights.used] >= 0
            start[both] = basis[old.number[weights.used[both]]]
        basis = truncated_svd(all_docs, shared, start, spark)
        start = weights, basis
        base = spark.sparkContext.broadcast(basis)

        def seed_sums(b, near=None, shared=shared, base=base):
            e = _unit(Sparse(b, shared.value).times(base.value))
            g = np.array([group.get(x, -1) for x in zip(b.column("s").to_pylist(), b.column("lang").to_pylist())])
            ok = (g >= 0) & e.any(axis=1)
            if near is not None:
                ok &= (e * near[g]).sum(axis=1) >= 0.3
            return [*np.unique(g[ok])], [e[ok & (g == x)].sum(axis=0) for x in np.unique(g[ok])]

        def placed(sums: dict[int, np.ndarray], old: np.ndarray) -> np.ndarray:
            new = old.copy()
            for j, v in sums.items():
                new[j] = v
            return _unit(new)

        centroids = placed(seed_docs.sums(seed_sums), np.zeros((groups, basis.shape[1])))
        centroids = placed(seed_docs.sums(lambda b, c=centroids, f=seed_sums: f(b, c)), centroids)  # without the labels that look wrong

        def nearest(b, c, shared=shared, base=base):
            e = _unit(Sparse(b, shared.value).times(base.value))
            near = e @ c.T
            return e, np.where(near.max(axis=1) >= CONFIDENT, near.argmax(axis=1), -1)

        for _ in range(REFINEMENTS):

            def moved(b, c=centroids, nearest=nearest):
                e, g = nearest(b, c)
                return [*np.unique(g[g >= 0])], [e[g == x].sum(axis=0) for x in np.unique(g[g >= 0])]

            centroids = placed(all_docs.sums(moved), centroids)
        counts, have = counts_of(all_docs, lambda b, c=centroids, f=nearest: np.r_[subject_of, -1][f(b, c)[1]])
    f, w = frequency[weights.used], weights.weight[weights.used]
    typical = (f * w**2).sum() / (f * w).sum()
    vectors = spark.sparkContext.broadcast((weights.number, (basis * w[:, None]).astype(np.float32)))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                n = sentence_counts(b, *vectors.value, centroids, subject_of, k, LEAST_LENGTH * typical)
                order = np.argsort(-n, axis=1, kind="stable")[:, :MOST]
                top = np.take_along_axis(n, order, 1)
                row, place = np.nonzero((top >= SENTENCES) & (top >= SENTENCE_SHARE * n.sum(axis=1, keepdims=True)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), pa.array(subjects, pa.string()).take(pa.array(order[row, place]))], ["doc_id", "subject"])

    return encoded.select("doc_id", "codes").mapInArrow(classify, schema)


def sentence_counts(b: pa.RecordBatch, number: np.ndarray, vectors: np.ndarray, centroids: np.ndarray, subject_of: np.ndarray, k: int, least: float) -> np.ndarray:
    """Sentences by document and subject of encoded documents (-1 ends a sentence): each goes to the nearest centroid, if any is near."""
    code, lengths = _flat(b.column("codes"), np.int32)
    out = np.zeros((b.num_rows, k), np.int64)
    sentence = np.cumsum(code < 0)
    term = np.where(code >= 0, number[code], -1)
    use = term >= 0
    if not use.any():
        return out
    sentence = sentence[use]
    pair = np.unique(sentence * len(vectors) + term[use])
    row = pair // len(vectors)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    e = np.add.reduceat(vectors[pair % len(vectors)], first, axis=0)
    length = np.linalg.norm(e, axis=1)
    near = (e / np.maximum(length, 1e-12)[:, None]) @ centroids.T
    on = (length >= least) & (near.max(axis=1) >= LEAST_COSINE)
    # the document of a sentence is that of its first term
    document = np.repeat(np.arange(b.num_rows), lengths)[use][np.searchsorted(sentence, row[first])]
    np.add.at(out, (document[on], subject_of[near.argmax(axis=1)][on]), 1)
    return out
