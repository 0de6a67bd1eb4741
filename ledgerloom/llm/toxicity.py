"""Toxicity by a linear-chain conditional random field over a document's words.

Tokens of labelled documents get labels of their own: in toxic documents, the words that labelled toxic documents hold far
more often than clean ones; elsewhere none. The field is trained on them by gradient ascent. Scoring runs forward-backward
over each whole document (by products of 2 x 2 matrices, so that long documents are as quick as short ones); the words'
marginals make the document's score, and the words over one half are its offending spans.

The model is fitted on a bounded sample: the first labelled documents of each label in seeded order, long ones too, as far
as SAMPLE_ROWS documents or SAMPLE_BYTES bytes; of documents that share an id, the
least text; texts over a LARGE_PART-th of the bytes and ids with two labels are left out. Everything else covers all rows and whole texts. Inputs of a score: the text alone.

Edge cases: null and blank texts get the score of a document without marginals; without labelled rows of both labels the
score is 0 for all; a document whose id is null is scored too; equal rows get equal scores. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ledgerloom.llm import common

common.shipped(__name__)
SAMPLE_ROWS = 1500
LARGE_PART = 16
SAMPLE_BYTES = 8_000_000
VOCABULARY = 40_000
ROUNDS = 60
BLOCK = 64
STEMS = range(3, 9)
#: A word and its stems.
WIDTH = len(STEMS) + 1
STEP_WORDS = 300_000
#: Words of the sample that the fit goes over at once.
SLICE_WORDS = 100_000
FOLDS = 5
EDGES = b".,;:!?\"'()[]{}*_-~<>|/\\"


@dataclass
class Field:
    """The features' weights for the toxic state, a word's own, transitions, and the score's weights."""

    weight: dict
    bias: float
    trans: object
    start: object
    link: tuple[float, float, float]


def features(word: bytes) -> list[bytes]:
    """A word without marks at its ends in lower case, and the stems of STEMS characters that it goes on after."""
    low = word.lower().strip(EDGES)
    text = low.decode()
    return [low, *[b"^" + text[:k].encode() for k in STEMS if len(text) > k]]


class Weights(dict):
    """The weight of a raw word for the toxic state. Bounded."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: bytes) -> float:
        if len(self) >= 300_000:
            self.clear()
        get = self.field.weight.get
        out = self[word] = self.field.bias + sum(get(f, 0.0) for f in features(word))
        return out


def marginals(x, sizes, trans, start):
    """P(toxic state) of every word of chains laid end to end, and the summed pair marginals. x: exp of the words' weights.

    Chains are cut into blocks of BLOCK words. The blocks' matrices are multiplied up word by word for all blocks at once,
    then chained block by block for all documents at once; last, words get their marginals inside the blocks.
    """
    import numpy as np

    nb = -(-sizes // BLOCK)
    first = np.cumsum(nb) - nb
    total = int(nb.sum())
    chain = np.repeat(np.arange(len(sizes)), nb)
    ends = np.cumsum(sizes)
    base = (ends - sizes)[chain] + (np.arange(total) - first[chain]) * BLOCK
    at = base[:, None] + np.arange(BLOCK)
    real = at < ends[chain][:, None]
    e = x[np.minimum(at, len(x) - 1)]
    # a word's matrix is trans with its column of the toxic state times e; words beyond the end are the identity
    (t00, t01), (t10, t11) = trans
    p = np.zeros((4, total))
    p[0] = p[3] = 1
    for k in range(BLOCK):
        r, y = real[:, k], e[:, k]
        a, b = p[0] * t00 + p[1] * t10, (p[0] * t01 + p[1] * t11) * y
        c, d = p[2] * t00 + p[3] * t10, (p[2] * t01 + p[3] * t11) * y
        z = a + b + c + d
        p = np.where(r, np.stack([a, b, c, d]) / z, p)
    f, g = np.empty((2, total)), np.empty((2, total))
    now = np.repeat(np.asarray(start, float)[:, None], len(sizes), axis=1)
    for k in range(int(nb.max()) if len(nb) else 0):
        live = np.flatnonzero(nb > k)
        i = first[live] + k
        f[:, i] = now[:, live]
        u = np.stack([f[0, i] * p[0, i] + f[1, i] * p[2, i], f[0, i] * p[1, i] + f[1, i] * p[3, i]])
        now[:, live] = u / u.sum(axis=0)
    now = np.ones((2, len(sizes)))
    for k in range(1, int(nb.max()) + 1 if len(nb) else 1):
        live = np.flatnonzero(nb >= k)
        i = first[live] + nb[live] - k
        g[:, i] = now[:, live]
        u = np.stack([p[0, i] * g[0, i] + p[1, i] * g[1, i], p[2, i] * g[0, i] + p[3, i] * g[1, i]])
        now[:, live] = u / u.sum(axis=0)
    fwd = np.empty((BLOCK + 1, 2, total))
    fwd[0] = f
    for k in range(BLOCK):
        a, b = fwd[k, 0] * t00 + fwd[k, 1] * t10, (fwd[k, 0] * t01 + fwd[k, 1] * t11) * e[:, k]
        z = a + b
        fwd[k + 1] = np.where(real[:, k], np.stack([a, b]) / z, fwd[k])
    out = np.empty((total, BLOCK))
    pairs = np.zeros((2, 2))
    back = g
    for k in range(BLOCK - 1, -1, -1):
        r, y = real[:, k], e[:, k]
        q = fwd[k + 1] * back
        out[:, k] = q[1] / (q[0] + q[1])
        w = np.stack([fwd[k, 0] * t00 * back[0], fwd[k, 0] * t01 * y * back[1], fwd[k, 1] * t10 * back[0], fwd[k, 1] * t11 * y * back[1]])
        pairs += ((w / w.sum(axis=0)) * r).sum(axis=1).reshape(2, 2)
        u = np.stack([t00 * back[0] + t01 * y * back[1], t10 * back[0] + t11 * y * back[1]])
        back = np.where(r, u / u.sum(axis=0), back)
    return out[real], pairs


class Sample:
    """Whole labelled texts as word numbers: each distinct word and feature once, four bytes for each word of a text."""

    def __init__(self, texts: list[bytes], labels: list[int]):
        import numpy as np

        self.y = np.array(labels)
        number: dict = {}
        each = [np.fromiter((number.setdefault(w, len(number)) for w in t.split()), np.int32) for t in texts]
        self.sizes = np.array([len(x) for x in each], np.int64)
        self.ids = np.concatenate(each) if each else np.zeros(0, np.int32)
        self.doc = np.repeat(np.arange(len(each), dtype=np.int32), self.sizes)
        index: dict = {}
        self.has = np.full((len(number), WIDTH), -1, np.int32)  # each word's features
        for k, w in enumerate(number):
            made = [index.setdefault(f, len(index)) for f in features(w) if f]
            self.has[k, : len(made)] = made
        self.features = list(index)

    def contexts(self, label: int):
        """The words of the distinct (before, word, after) of texts with a label: however often a text was copied, it counts once."""
        import numpy as np

        same = np.r_[False, self.doc[1:] == self.doc[:-1]]
        before = np.where(same, np.r_[-1, self.ids[:-1]], -1).astype(np.int64)
        after = np.where(np.r_[same[1:], False], np.r_[self.ids[1:], -1], -1).astype(np.int64)
        mine = self.y[self.doc] == label
        pair = np.unique((before[mine] + 1) << 32 | self.ids[mine], return_inverse=True)  # pairs by number, then triples
        return pair[0][np.unique(pair[1].astype(np.int64) << 32 | (after[mine] + 1)) >> 32] & 0xFFFFFFFF

    def slices(self):
        """Ranges of texts with about STEP_WORDS words, and of their words."""
        import numpy as np

        ends = np.cumsum(self.sizes)
        lo = 0
        while lo < len(ends):
            at = int(ends[lo] - self.sizes[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, at + SLICE_WORDS, "right")))
            yield lo, hi, at, int(ends[hi - 1])
            lo = hi


def fit(texts: list[bytes], labels: list[int]) -> Field | None:
    """Trains the field, then the score's link, on whole labelled texts, some of them at a time."""
    import numpy as np

    if len(set(labels)) < 2:
        return None
    rows = Sample(texts, labels)
    y, sizes, ids, doc = rows.y, rows.sizes, rows.ids, rows.doc
    seen = []
    for label in (0, 1):
        own = rows.has[rows.contexts(label)]
        seen.append((len(own), np.bincount(own[own >= 0], minlength=len(rows.features))))
    (neg, clean), (pos, toxic) = seen
    often = np.flatnonzero(clean + toxic > 1).tolist()
    top = sorted(often, key=lambda f: (-(clean[f] + toxic[f]), rows.features[f]))[:VOCABULARY]
    kept = np.zeros(len(rows.features) + 1, np.int32)  # feature 0 is none; so is the last, which -1 picks
    kept[top] = np.arange(1, len(top) + 1)
    has, names = kept[rows.has], [rows.features[f] for f in top]
    clean, toxic = (np.r_[0, side[top]].astype(float) for side in (clean, toxic))
    # far more often in toxic documents, and often enough not to be chance among so many features
    odds = np.log((toxic + 0.5) / (pos + 1)) - np.log((clean + 0.5) / (neg + 1))
    chance = np.sqrt((toxic + clean + 1) / (pos + neg) * (1 / pos + 1 / neg))
    marked = (toxic >= max(4, 0.02 * y.sum())) & (odds > np.log(8)) & ((toxic / pos - clean / neg) > 5 * chance)
    gold = marked[has].any(axis=1)[ids] & (y[doc] == 1)
    weight, bias = np.where(marked, 3.0, 0.0), -4.0
    log_t, grad_w, grad_b, grad_t = np.log(np.array([[0.95, 0.05], [0.8, 0.2]])), np.full(len(weight), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    before = np.r_[False, gold[:-1]] & np.r_[False, doc[1:] == doc[:-1]]
    want = np.bincount(ids, gold, len(has))
    want_t = np.array([[(~before & ~gold).sum(), (~before & gold).sum()], [(before & ~gold).sum(), (before & gold).sum()]], float)
    start = np.array([1.0, 1e-3])

    def inferred(weight, bias, trans):
        """Range of texts and of words, and the words' marginals and summed pair marginals, slice by slice."""
        strength = np.exp(bias + weight[has].sum(axis=1))
        for lo, hi, at, end in rows.slices():
            n = sizes[lo:hi]
            if end > at:
                yield lo, hi, at, end, *marginals(strength[ids[at:end]], n[n > 0], trans, start)

    for _ in range(ROUNDS):
        d, dt = want.copy(), want_t.copy()
        for _, _, at, end, got, pairs in inferred(weight, bias, np.exp(log_t)):
            d -= np.bincount(ids[at:end], got, len(has))
            dt -= pairs
        dw = np.bincount(has.ravel(), np.repeat(d, WIDTH), len(weight)) - 0.05 * weight
        dw[0] = 0
        dt -= 0.05 * log_t
        db = d.sum() - 0.05 * bias
        grad_w += dw * dw
        grad_b += db * db
        grad_t += dt * dt
        weight = np.clip(weight + 0.5 * dw / np.sqrt(grad_w), -12, 12)
        bias = float(np.clip(bias + 0.5 * db / np.sqrt(grad_b), -12, 12))
        log_t = np.clip(log_t + 0.2 * dt / np.sqrt(grad_t), -8, 4)
    field = Field({f: float(w) for f, w in zip(names, weight[1:], strict=True) if w}, bias, np.exp(log_t), start, (0.0, 0.0, 0.0))
    most, mass = np.zeros(len(sizes)), np.zeros(len(sizes))
    for lo, hi, at, end, got, _ in inferred(weight, bias, field.trans):
        np.maximum.at(most, doc[at:end], got)
        mass[lo:hi] = np.bincount(doc[at:end] - lo, got, hi - lo)
    feats = np.stack([np.ones(len(sizes)), most, np.log1p(mass)], axis=1)
    link, cost = np.zeros(3), np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0) ** 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-feats @ link))
        h = (feats * (cost * p * (1 - p))[:, None]).T @ feats + 0.05 * np.eye(3)
        link = link + np.linalg.solve(h, feats.T @ (cost * (y - p)) - 0.05 * link)
    field.link = tuple(link.tolist())
    return field


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Field | None:
    """Fits on the bounded sample of labelled rows outside the held-out fold. Ids with two labels, and texts beyond a
    LARGE_PART-th of the bytes, have no part in it."""
    known = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).where("toxic = _most").drop("_most").withColumn("place", F.xxhash64("doc_id"))
    pick = None
    for label in (0, 1):  # some more than needed, as some documents are missing
        some = known.where(F.col("toxic") == label).orderBy("place", "doc_id").limit(2 * rows)
        pick = some if pick is None else pick.unionByName(some)
    # at most 4 * rows ids are broadcast, and as many texts meet in the two groups of the window
    some = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(pick), "doc_id")
    some = some.groupBy("toxic", "place", "doc_id").agg(F.min("text").alias("text")).where(F.octet_length("text") <= size // LARGE_PART)
    order = Window.partitionBy("toxic").orderBy("place", "doc_id")
    some = some.withColumns({"k": F.row_number().over(order), "sofar": F.sum(F.octet_length("text")).over(order)})
    sample = some.where((F.col("k") <= rows) & (F.col("sofar") <= size)).orderBy("toxic", "k").select("text", "toxic").collect()
    return fit([r[0].encode() for r in sample], [int(r[1]) for r in sample])


def tagged(documents: DataFrame, field: Field | None, carry: list[str] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, *carry, score, spans): spans are (start, end, p) of offending words in code points of the text."""
    spark = documents.sparkSession
    plain = field and (field.weight, field.bias, field.trans, field.start, field.link)  # at most VOCABULARY words
    shared = spark.sparkContext.broadcast(plain)
    names = list(dict.fromkeys([id_col, *carry]))
    rows = documents.select(*names, F.col(text_col).cast("string").alias("_text"))
    fields = [rows.schema[n] for n in names]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = shared.value and Field(*shared.value)
        weights = own and Weights(own)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
        for batch in batches:
            texts = batch.column(len(names)).cast(pa.binary()).to_pylist()
            score, spans = np.zeros(len(texts)), [[] for _ in texts]
            lo = 0
            while own and lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi] or b"") // 5 <= STEP_WORDS):
                    size += len(texts[hi] or b"") // 5
                    hi += 1
                words = [(t or b"").split() for t in texts[lo:hi]]
                sizes = np.array([len(w) for w in words], np.int64)
                x = np.exp(np.fromiter((weights[w] for own_words in words for w in own_words), float, int(sizes.sum())))
                full = np.flatnonzero(sizes)
                p = marginals(x, sizes[full], own.trans, own.start)[0] if len(full) else np.zeros(0)
                doc = np.repeat(np.arange(len(words)), sizes)
                most = np.zeros(len(words))
                np.maximum.at(most, doc, p)
                odds = own.link[0] + own.link[1] * most + own.link[2] * np.log1p(np.bincount(doc, p, len(words)))
                score[lo:hi] = 1 / (1 + np.exp(-odds))
                starts = np.cumsum(sizes) - sizes
                for i in np.unique(doc[p >= 0.5]).tolist():
                    spans[lo + i] = _spans(texts[lo + i], words[i], p[starts[i] : starts[i] + sizes[i]])
                lo = hi
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(names))], pa.array(score), pa.array(spans, kind)], [*names, "score", "spans"])

    span = StructType().add("start", "long").add("end", "long").add("p", "double")
    schema = StructType(fields).add("score", "double").add("spans", ArrayType(span))
    return rows.mapInArrow(run, schema)


def _spans(text: bytes, words: list[bytes], p) -> list:
    out, at, chars, done = [], 0, 0, 0
    for w, x in zip(words, p.tolist(), strict=True):
        at = text.index(w, at)
        if x >= 0.5:
            chars += len(text[done:at].decode())
            size = len(w.decode())
            out.append({"start": chars, "end": chars + size, "p": x})
            done = at
        at += len(w)
    return out


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = tagged(docs, learn(docs, common.table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))
