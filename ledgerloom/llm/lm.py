"""Language-model scores: a causal self-attention model over subword ids, trained in numpy, with corpus counts.

A text is a chain of words, each spelled by subword ids and an event that ends it, then an end token. From the 8 to 31 ids
before, a causal attention layer predicts the class of the next id, one of CLASSES; inside its class, an id's probability
comes from counts of ids after the one before; whether a word ends after an id, from counts too. Together they give the
probability of any spelling. The word's other probability is that of the class of its first id times the word's share of all
words of that class. A mixture of the two is the word's probability: for a given spelling of words these sum to 1 or less.

Gathered from all training documents, before any shuffle summed up by task: counts of words (keyed by 64-bit hash), of ids, of
ids that begin and end words, of neighbouring ids. On the driver the ids' neighbours (a matrix of fixed size) give the classes.
The windows of all training documents stream through tasks by one schedule, whatever their number: each document is dealt to
one network of one round, all of equal shares, and a round's networks start alike and are averaged by Spark after it. The first
round has one network, so that those of the next ones stay near enough to each other. Rows are dealt by their number, so that
copies of one text spread too.

Scoring lays windows of CONTEXT + STRIDE ids over each whole text, so that every id is scored once with CONTEXT ids or more
before it (fewer only at the start).

The most frequent words, SHARED_WORDS at most and all that have the same count or none, reach the tasks as a broadcast; rarer
words are joined by their hash.

Edge cases: a null or blank text is its end token; without training documents all counts are 0; a null id counts as the text
'' for the split; equal rows score equally; a word that the tokenizer gives no id has NO_IDS as its spelling's log10
probability. Words that differ only in what the tokenizer drops (the case of other letters than A-Z) share a spelling.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common, packing
from ledgerloom.llm.packing import WordIds, text_ids, vocabulary

common.shipped(__name__)
FOLDS, HELD = 7, 2
END = 1
#: Ids of the vocabulary are under this.
IDS = 1 << 16
KEPT_IDS = 1024
CLASSES = 32
WIDTH = 8
CONTEXT, STRIDE = 8, 24
#: How many networks are trained side by side in each round, and how fast they learn.
ROUNDS = ((1, 0.03), (4, 0.02), (32, 0.01))
#: Windows of a training step.
BATCH = 64
SHARED_WORDS = 400_000
NO_IDS = -12.0
STEP_WORDS = 200_000
#: Hashes of words that a task counts before it gives them out.
HASHES = 1_000_000
#: Ids handled at once in a task that counts or trains.
STEP_IDS = 200_000


def fold(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def windows(ids, ends, end: int = END):
    """Input and target ids of the windows of chains laid end to end, and which targets are scored; `end` fills the rest.

    The chains are laid out anew, each with CONTEXT + 1 places before it and whole strides for itself, and windows are cut from that.
    """
    import numpy as np

    sizes = np.diff(np.r_[0, ends])
    count = -(-sizes // STRIDE)
    room = CONTEXT + 1 + count * STRIDE
    first = np.cumsum(room) - room
    at = np.arange(len(ids)) + np.repeat(first + CONTEXT + 1 - (ends - sizes), sizes)
    laid, real = np.full(int(room.sum()), end, ids.dtype), np.zeros(int(room.sum()), bool)
    laid[at], real[at] = ids, True
    start = np.repeat(first, count) + (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    cut = lambda m, many: np.lib.stride_tricks.sliding_window_view(m, many)
    if not len(start):
        return np.zeros((0, CONTEXT + STRIDE + 1), ids.dtype), np.zeros((0, STRIDE), bool)
    return cut(laid, CONTEXT + STRIDE + 1)[start], cut(real, STRIDE)[start + CONTEXT + 1]


def initial(seed: int = 11) -> list:
    import numpy as np

    rng = np.random.default_rng(seed)
    r = lambda *s: (rng.normal(size=s) * 0.15).astype(np.float32)
    return [r(KEPT_IDS, WIDTH), r(CONTEXT + STRIDE, WIDTH), r(WIDTH, WIDTH), r(WIDTH, WIDTH), r(WIDTH, WIDTH), r(WIDTH, WIDTH), r(WIDTH, CLASSES), np.zeros(CLASSES, np.float32)]


def _mask():
    """1 where a scored position sees a position of its window, itself included, else 0."""
    import numpy as np

    return (np.arange(CONTEXT + STRIDE)[None] <= np.arange(CONTEXT, CONTEXT + STRIDE)[:, None]).astype(np.float32)


def forward(net: list, x, mask):
    """Class logits of the last STRIDE positions of each window, and what the gradient needs.

    A column of ones beside the values makes the product with the weights give the weights' sums too, so that they stay unscaled.
    From there on arrays lie by feature, with all positions in a row: what scales positions or features then runs along whole rows.
    """
    import numpy as np

    e, pos, wq, wk, wv, wo, out, bias = net
    many = len(x)
    h = e.take(x, axis=0)
    h += pos
    last = np.ascontiguousarray(h[:, CONTEXT:]).reshape(-1, WIDTH)
    flat = h.reshape(-1, WIDTH)
    q = (last @ (wq * WIDTH**-0.5)).reshape(many, STRIDE, WIDTH)
    kv = (flat @ np.concatenate([wk, wv, np.zeros((WIDTH, 1), wv.dtype)], axis=1)).reshape(many, -1, 2 * WIDTH + 1)
    kv[:, :, 2 * WIDTH] = 1
    k, v = kv[:, :, :WIDTH], kv[:, :, WIDTH:]
    a = np.matmul(q, k.transpose(0, 2, 1))
    if a.max(initial=0) > 30:
        np.minimum(a, 30, out=a)
    np.exp(a, out=a)
    a *= mask
    o = np.matmul(a, v).reshape(-1, WIDTH + 1)
    share = 1 / np.maximum(o[:, WIDTH], 1e-30)
    seen = wo.T @ o[:, :WIDTH].T
    seen *= share
    z = seen + last.T
    logits = out.T @ z
    logits += bias[:, None]
    return logits.T, (flat, last, q, k, v, a, share, o, seen, z)


def gradient(net: list, x, y, real, mask):
    import numpy as np

    e, pos, wq, wk, wv, wo, out, bias = net
    many = len(x)
    p, (flat, last, q, k, v, a, share, o, seen, z) = forward(net, x, mask)
    p = p.T  # by class
    if p.max() > 80 or p.min() < -80:
        np.clip(p, -80, 80, out=p)
    np.exp(p, out=p)
    weight = real.ravel().astype(np.float32)
    weight *= np.float32(1 / max(1, np.count_nonzero(real)))
    n = len(weight)
    p *= weight / (np.ones(CLASSES, np.float32) @ p)
    p.ravel()[y.ravel() * n + np.arange(n)] -= weight
    deep = lambda m: m.reshape(many, -1, m.shape[1])
    dout, dbias, dz = z @ p.T, p @ np.ones(n, np.float32), out @ p
    dseen = dz * share
    dwo = o[:, :WIDTH].T @ dseen.T
    # a weight's gradient is its share of do times its value less the mean value: the ones column takes the mean off
    less = np.empty((n, WIDTH + 1), dz.dtype)
    do = less[:, :WIDTH]
    np.matmul(dseen.T, wo.T, out=do)
    np.negative(np.ones(WIDTH, np.float32) @ (dseen * seen), out=less[:, WIDTH])
    ds = np.matmul(deep(less), v.transpose(0, 2, 1))
    ds *= a
    dkv = np.empty((many, CONTEXT + STRIDE, 2 * WIDTH), dz.dtype)
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
    np.matmul(a.transpose(0, 2, 1), deep(less)[:, :, :WIDTH], out=dkv[:, :, WIDTH:])
    dkv = dkv.reshape(-1, 2 * WIDTH)
    dq = np.matmul(ds, k).reshape(-1, WIDTH)
    dq *= WIDTH**-0.5
    dwq, dwkv = last.T @ dq, flat.T @ dkv
    dh = deep(dkv @ np.concatenate([wk.T, wv.T]))
    dlast = dq @ wq.T
    dlast += dz.T
    dh[:, CONTEXT:] += deep(dlast)
    ids, by_column = x.ravel(), dh.reshape(-1, WIDTH).T.astype(np.float64, order="C")
    de = np.empty(e.shape, np.float32)
    for c in range(WIDTH):
        de[:, c] = np.bincount(ids, by_column[c], len(e))
    dwk, dwv = dwkv[:, :WIDTH], dwkv[:, WIDTH:]
    return [de, dh.sum(axis=0), dwq, dwk, dwv, dwo, dout, dbias]


#: Added to gradients, so that what Adam gathers of weights that no window of many steps has never gets subnormal, which is slow.
TINY = 1e-18


class Trainer:
    """Adam over windows as they come; memory doesn't grow with their number."""

    def __init__(self, net: list, rate: float = 0.01):
        import numpy as np

        self.flat, self.rate, self.steps = np.concatenate([w.ravel() for w in net]).astype(np.float32), rate, 0
        cuts = np.cumsum([w.size for w in net])[:-1]
        self.net = [part.reshape(w.shape) for part, w in zip(np.split(self.flat, cuts), net, strict=True)]  # views
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.mask = _mask()

    def learn(self, rows, marks, kept, classes) -> None:
        import numpy as np

        for lo in range(0, len(rows), BATCH):
            own, real = kept.take(rows[lo : lo + BATCH]), marks[lo : lo + BATCH]
            x, y = own[:, :-1], classes.take(own[:, CONTEXT + 1 :])
            self.steps += 1
            g = np.concatenate([w.ravel() for w in gradient(self.net, x, y, real, self.mask)])
            g += np.float32(TINY)
            self.m += np.float32(0.1) * (g - self.m)
            g *= g
            self.v += np.float32(0.01) * (g - self.v)
            size = np.sqrt(self.v)
            size *= np.float32((1 - 0.99**self.steps) ** -0.5)
            size += np.float32(1e-8)
            np.divide(self.m, size, out=size)
            size *= np.float32(self.rate / (1 - 0.9**self.steps))
            self.flat -= size


def neighbours_to_model(pairs, kept_count, ids_count, end: int, used):
    """From counts of (previous, next) kept ids: classes, log10 p(id | class, previous) and p(id | kept bucket). The kept id `end` has a class of its own.

    used: which kept ids stand for any id; where a corpus has few, the others get no probability.
    """
    import numpy as np

    n = pairs.sum(axis=0) + 0.1 * used
    expected = np.outer(pairs.sum(axis=1) + 0.1, n) / n.sum() + 1e-9
    pmi = np.log1p(np.maximum(pairs / expected, 0)).astype(np.float32)
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(pmi.T @ rng.normal(size=(len(n), 24)).astype(np.float32))[0]
    for _ in range(3):
        basis = np.linalg.qr(pmi.T @ (pmi @ basis))[0]
    points = pmi.T @ np.linalg.qr(pmi @ basis)[0]
    points /= np.linalg.norm(points, axis=1, keepdims=True) + 1e-6
    order = np.argsort(-n, kind="stable")
    order = np.r_[end, order[order != end]]
    own = CLASSES // 4
    classes = np.empty(len(n), np.int64)
    classes[order[:own]] = np.arange(own)  # the end and the most frequent ids are classes of their own
    rest = order[own:]
    centers = points[rest[: CLASSES - own]]
    for _ in range(12):
        near = (points[rest] @ centers.T).argmax(axis=1)
        for c in range(len(centers)):
            if (near == c).any():
                centers[c] = points[rest[near == c]].mean(axis=0)
                centers[c] /= np.linalg.norm(centers[c]) + 1e-6
    classes[rest] = near + own
    inside = n / np.maximum(np.bincount(classes, n, CLASSES), 1e-9)[classes]
    given = np.zeros((len(n), CLASSES))
    for c in range(CLASSES):
        given[:, c] = pairs[:, classes == c].sum(axis=1)
    back = 4.0
    cond = np.log10((pairs + back * inside[None] + 1e-30) / (given[:, classes] + back))
    spread = np.log10((ids_count + 0.01) / kept_count)
    return classes, cond.astype(np.float32), spread.astype(np.float32)


def hashed(words):
    """64-bit hashes of an Arrow array of words."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    words = words.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.tolist()), np.uint64, len(words)).view(np.int64)


def summed(keys, n):
    """Distinct keys and the sums of their counts."""
    import numpy as np

    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


SPELLED = "kind int, doc_id long, text string, ids binary, sizes binary, word long, n long"


def spelled(documents: DataFrame, path: str) -> DataFrame:
    """One pass over the texts. Kind 0: documents with their ids and how many each word has, 16 bits each; of the training
    documents, kind 1: words by hash, 2: ids, 3: ids that begin a word, 4: ids that end one; `n` is how often, by task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names, kinds = SPELLED.replace(",", "").split()[::2], [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        words, by_id = WordIds(path, END), np.zeros((3, IDS), np.int64)
        waiting: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]  # hashes and counts, summed up only when many

        def rows(**own):
            many = len(next(iter(own.values())))
            return pa.RecordBatch.from_arrays([own[k] if k in own else pa.nulls(many, t) for k, t in zip(names, kinds, strict=True)], names)

        def seen():
            hashes, times = waiting[0]
            return rows(kind=pa.array(np.ones(len(hashes), np.int32)), word=pa.array(hashes), n=pa.array(times))

        def merged():
            waiting[:] = [summed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))]

        def binary(values, ends):
            return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.r_[0, 2 * ends].astype(np.int32)), pa.py_buffer(values.astype(np.uint16))])

        for batch in batches:
            held = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, many in common.part_ranges(batch.column(1), packing.STEP_WORDS):
                texts = batch.column(1).slice(lo, many).cast(pa.string())
                ids, per_word, n, numbers = text_ids(words, pc.ascii_lower(texts.fill_null("")))
                doc, word_ends = np.repeat(np.arange(len(n)), n), np.cumsum(per_word, dtype=np.int64)
                found = np.bincount(numbers[~held[lo : lo + many][doc]], minlength=len(words.spans.sizes))
                at = np.flatnonzero(found[1:])  # the end is no word
                waiting.append((hashed(words.words.take(pa.array(at))), found[1:][at]))
                if sum(len(x) for x, _ in waiting) > 2 * HASHES:
                    merged()
                    if len(waiting[0][0]) > HASHES:
                        yield seen()
                        waiting[:] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                count_ids(by_id, words.spans, found)
                last = np.cumsum(n)
                kind = pa.array(np.zeros(many, np.int32))
                yield rows(kind=kind, doc_id=batch.column(0).slice(lo, many), text=texts, ids=binary(ids, word_ends[last - 1]), sizes=binary(*packed_sizes(per_word, last)))
        merged()
        yield seen()
        for k in range(3):
            at = np.flatnonzero(by_id[k])
            yield rows(kind=pa.array(np.full(len(at), 2 + k, np.int32)), word=pa.array(at), n=pa.array(by_id[k][at]))

    held = F.coalesce(fold(F.col("doc_id")) == HELD, F.lit(False))
    return documents.select("doc_id", "text", held.alias("held")).mapInArrow(run, SPELLED)


def count_ids(by_id, spans, found) -> None:
    """Adds the ids of words to the counts of ids, of first ones and of last ones; found: how often each word is there."""
    import numpy as np

    some = np.flatnonzero(found.astype(bool) & (spans.sizes > 0))
    n, first = found[some], spans.starts[some]
    ids, sizes = spans.get(some)
    for k, (own, times) in enumerate(((ids, np.repeat(n, sizes)), (spans.flat[first], n), (spans.flat[first + spans.sizes[some] - 1], n))):
        by_id[k] += np.bincount(own, times, IDS).astype(np.int64)  # sums of whole numbers, exact below 2^53


def packed_sizes(sizes, ends):
    """Sizes as 16-bit numbers and the ends of their documents there: 65535 says that the number after it adds to it."""
    import numpy as np

    more = sizes // 65535
    if not more.any():
        return sizes, ends
    out = np.full(int(len(sizes) + more.sum()), 65535, np.int64)
    at = np.cumsum(more + 1)
    out[at - 1] = sizes % 65535
    return out, at[ends - 1]


def unpacked_sizes(packed):
    import numpy as np

    closed = packed < 65535
    if closed.all():
        return packed
    return np.diff(np.cumsum(packed)[closed], prepend=0)


def _chains(column) -> Iterator:
    """Ids laid end to end and the ends of the chains, about STEP_IDS at once."""
    import numpy as np

    rows, size = [], 0
    for row in column:
        rows.append(row.as_py())
        size += len(rows[-1]) // 2
        if size >= STEP_IDS:
            yield np.frombuffer(b"".join(rows), np.uint16).astype(np.int64), np.cumsum([len(r) // 2 for r in rows])
            rows, size = [], 0
    if rows:
        yield np.frombuffer(b"".join(rows), np.uint16).astype(np.int64), np.cumsum([len(r) // 2 for r in rows])


def neighbours(rows: DataFrame, kept) -> DataFrame:
    """(pair, n): how often a kept id follows another, previous * KEPT_IDS + next; summed up in a matrix by each task."""
    shared = rows.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kept, counts = shared.value, np.zeros(KEPT_IDS * KEPT_IDS, np.int64)
        for batch in batches:
            for ids, ends in _chains(batch.column(0)):
                now = kept[ids]
                before = np.r_[kept[END], now[:-1]]
                before[ends[:-1]] = kept[END]
                counts += np.bincount(before.astype(np.int64) * KEPT_IDS + now, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["pair", "n"])

    return rows.select("ids").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def fitted(rows: DataFrame) -> dict:
    """The model from spelled(): all of fixed size, whatever the corpus."""
    import numpy as np

    spark = rows.sparkSession
    counts = np.zeros((3, IDS))
    for kind, i, n in rows.where("kind >= 2").groupBy("kind", "word").agg(F.sum("n").alias("n")).collect():  # at most three times the vocabulary
        counts[kind - 2, i] = n
    ids_count, begins, ends = counts
    train = rows.where("kind = 0").where(F.coalesce(fold(F.col("doc_id")) != HELD, F.lit(True))).select("ids")
    top = [int(i) for i in np.argsort(-ids_count, kind="stable")[: KEPT_IDS - 2] if ids_count[i] and i != END]
    kept = np.full(IDS, KEPT_IDS - 1, np.int64)
    kept[[END, *top]] = np.arange(len(top) + 1)
    matrix = np.zeros(KEPT_IDS * KEPT_IDS)
    for r in neighbours(train, kept).toArrow().to_batches():  # at most KEPT_IDS squared
        matrix[r.column(0).to_numpy()] = r.column(1).to_numpy()
    kept_count = np.bincount(kept, ids_count + 0.01, KEPT_IDS)
    classes, cond, spread = neighbours_to_model(matrix.reshape(KEPT_IDS, KEPT_IDS), kept_count[kept], ids_count, int(kept[END]), np.bincount(kept, minlength=KEPT_IDS) > 0)
    start = np.log10(np.maximum(np.bincount(classes[kept], begins, CLASSES), 1)).astype(np.float32)
    stop = (ends + 0.5) / (ids_count + 1)
    net = initial()
    net[-1][np.bincount(classes[np.unique(kept)], minlength=CLASSES) == 0] = -30  # classes without ids
    numbered = train.select(F.monotonically_increasing_id().alias("row"), "ids")  # of a written table: the same when a task runs again
    part, before = F.pmod(F.xxhash64("row"), F.lit(sum(many for many, _ in ROUNDS))), 0
    for many, rate in ROUNDS:
        own = numbered.where((part >= before) & (part < before + many))
        before += many
        shared = spark.sparkContext.broadcast((net, kept, classes, rate))

        def learn(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa

            net, kept, classes, rate = shared.value
            trainer, n = Trainer(net, rate), 0
            rng = np.random.default_rng(7)
            for batch in batches:
                for ids, ends in _chains(batch.column(1)):
                    own, real = windows(ids, ends)
                    order = rng.permutation(len(own))  # so that a step doesn't see one document only
                    trainer.learn(own[order], real[order], kept, classes)
                    n += len(own)
            if n:
                flat = np.concatenate([w.ravel() for w in trainer.net]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat], pa.list_(pa.float32()))], ["n", "net"])

        made = own.repartition(many, F.xxhash64("row", F.lit(1))).mapInArrow(learn, "n long, net array<float>")
        weights = made.select("n", F.posexplode("net").alias("at", "weight")).groupBy("at").agg((F.sum(F.col("n") * F.col("weight").cast("double")) / F.sum("n")).alias("mean"))
        got = weights.toArrow()  # a row for each weight of one network
        if got.num_rows:
            mean = np.empty(got.num_rows)
            mean[got.column("at").to_numpy()] = got.column("mean").to_numpy()
            cuts = np.cumsum([w.size for w in net])[:-1]
            net = [p.reshape(w.shape).astype(np.float32) for p, w in zip(np.split(mean, cuts), net, strict=True)]
    return {"net": net, "kept": kept, "classes": classes, "cond": cond, "spread": spread, "start": start, "stop": np.log10(stop).astype(np.float32), "on": np.log10(1 - stop).astype(np.float32)}


def attention_scores(model: dict, ids, ends, mask):
    """log10 p of every id of chains laid end to end, each scored once, and of its class."""
    import numpy as np

    kept = model["kept"].take(ids)
    end = model["kept"][END]
    before = np.r_[end, kept[:-1]][: len(kept)]
    before[ends[:-1]] = end
    rows, real = windows(kept, ends, end)
    lift = np.empty(real.shape, np.float32)
    for lo in range(0, len(rows), 64):  # so few that they stay in the cache
        own = rows[lo : lo + 64]
        logits = forward(model["net"], own[:, :-1], mask)[0].T  # by class
        n = logits.shape[1]
        got = logits.ravel().take(model["classes"].take(own[:, CONTEXT + 1 :].ravel()) * n + np.arange(n))
        if logits.max() > 80:
            np.minimum(logits, 80, out=logits)
            np.minimum(got, 80, out=got)
        np.exp(logits, out=logits)
        got -= np.log(np.ones(CLASSES, np.float32) @ logits)
        lift[lo : lo + 64] = got.reshape(-1, STRIDE)
    lift = lift[real]
    lift *= np.float32(0.4342945)
    return lift + model["cond"].ravel().take(before * KEPT_IDS + kept) + model["spread"].take(ids), lift


def word_scores(model: dict, ids, sizes, ends, mask):
    """Of each word of chains of ids: log10 p of its spelling, and of its first id's class less that class's share of all words' starts."""
    import numpy as np

    each, classes = attention_scores(model, ids, ends, mask)
    stop = np.cumsum(sizes)
    first = np.minimum(stop - sizes, len(ids) - 1)
    spelled = each.astype(np.float64) + model["on"][ids]
    spelled[stop - 1] += np.where(ids[stop - 1] == END, 0, model["stop"][ids[stop - 1]]) - model["on"][ids[stop - 1]]
    total = np.cumsum(np.r_[0, spelled])
    kind = model["classes"][model["kept"][ids[first]]]
    whole = sizes > 0
    return np.where(whole, total[stop] - total[stop - sizes], NO_IDS), np.where(whole, classes[first] - model["start"][kind], 0.0)


def least_shared(sizes: dict) -> int:
    """From how many words have each count: the least count such that no more than SHARED_WORDS words have it or a greater one."""
    least, room = max(sizes, default=0) + 1, SHARED_WORDS
    for n in sorted(sizes, reverse=True):
        room -= sizes[n]
        if room < 0:
            break
        least = n
    return least


def mixture(whole, spelling, unseen: float):
    """log10 of the mixture of two probabilities given as log10, the second one's part being `unseen`. What the smaller adds is at most log10(2)."""
    import numpy as np

    whole, spelling = whole + np.log10(1 - unseen), spelling + np.log10(unseen)
    less = np.abs(whole - spelling).astype(np.float32)
    less *= np.float32(-np.log(10))
    np.exp(less, out=less)
    less += 1
    np.log(less, out=less)
    return np.maximum(whole, spelling) + np.log10(np.e) * less


def score(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    import numpy as np

    spark, path = documents.sparkSession, tokenizer_path or vocabulary()
    rows = common.written(spelled(documents.select("doc_id", F.col("text").cast("string").alias("text")), path), "spelled")
    counts = common.written(rows.where("kind = 1").groupBy(F.col("word").alias("hash")).agg(F.sum("n").alias("n")), "words")
    docs = rows.where("kind = 0")
    n_docs = docs.where(F.coalesce(fold(F.col("doc_id")) != HELD, F.lit(True))).count()
    sizes = {r.n: r.words for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()}  # a row for each count that a word has
    total, distinct = sum(n * words for n, words in sizes.items()) + n_docs, sum(sizes.values()) + (n_docs > 0)
    top = counts.where(F.col("n") >= least_shared(sizes)).toArrow()  # at most SHARED_WORDS
    keys, many = top.column("hash").to_numpy(), top.column("n").to_numpy()
    order = np.argsort(keys)
    model = fitted(rows) | {"keys": keys[order], "many": many[order]}
    shared = spark.sparkContext.broadcast(model)
    scale = float(total + distinct + 1)
    unseen = min(0.5, max(0.02, sizes.get(1, 0) / max(total, 1)))  # the spelling's part: how often a word is new, by the words seen once

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["key", "doc_id", "n_tokens", "n_known", "base", "mixed", "hash", "neural", "lift"]
        model, mask = shared.value, _mask()
        if len(model["keys"]) == 0:
            model = model | {"keys": np.zeros(1, np.int64), "many": np.zeros(1, np.int64)}
        for batch in batches:
            for lo, k in common.part_ranges(batch.column(2), STEP_WORDS):
                ids, sizes = (np.frombuffer(b"".join(batch.column(c).slice(lo, k).to_pylist()), np.uint16).astype(np.int64) for c in (3, 4))
                sizes = unpacked_sizes(sizes)
                word, distinct, n = common.split_words(pc.ascii_lower(batch.column(2).slice(lo, k).cast(pa.string()).fill_null("")))
                n = n + 1
                close = np.cumsum(n) - 1
                neural, lift = word_scores(model, ids, sizes, np.cumsum(sizes)[close], mask)
                # of distinct words, the end last; then of all
                keys = hashed(distinct)
                at = np.minimum(np.searchsorted(model["keys"], keys), len(model["keys"]) - 1)
                c = np.r_[np.where(model["keys"][at] == keys, model["many"][at], 0), n_docs]
                rare = c == 0
                rare[-1] = False
                with np.errstate(divide="ignore"):
                    whole = np.log10(c)
                number = np.full(len(sizes), len(distinct))
                inside = np.ones(len(sizes), bool)
                inside[close] = False
                number[inside] = word
                pick = np.flatnonzero(rare.take(number))
                mixed = mixture(whole.take(number) + lift, neural, unseen)
                mixed[pick] = 0
                by_doc = lambda x: np.add.reduceat(x, close + 1 - n)  # noqa: B023, E731
                doc = np.searchsorted(close, pick)
                key = batch.column(0).slice(lo, k)
                nothing = lambda kind, k=k: pa.nulls(k, kind)
                yield pa.RecordBatch.from_arrays([
                    key, batch.column(1).slice(lo, k), pa.array(n), pa.array(by_doc((c > 0).astype(np.int64).take(number))),
                    pa.array(by_doc(np.where(rare, 0, np.log10((c + 1) / scale)).take(number))), pa.array(by_doc(mixed)), nothing(pa.int64()), nothing(pa.float64()), nothing(pa.float64()),
                ], names)
                if len(pick):
                    empty, flat = pa.nulls(len(pick), pa.int64()), pa.nulls(len(pick), pa.float64())
                    yield pa.RecordBatch.from_arrays([key.take(pa.array(doc)), empty, empty, empty, flat, flat, pa.array(keys[number[pick]]), pa.array(neural[pick]), pa.array(lift[pick].astype(float))], names)

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text", "ids", "sizes")
    made = common.written(keyed.mapInArrow(run, "key long, doc_id long, n_tokens long, n_known long, base double, mixed double, hash long, neural double, lift double"), "scores")
    rare = made.where("hash is not null").select("key", "hash", "neural", "lift").join(counts, "hash", "left")
    base = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(scale))
    word = F.when(F.col("n").isNotNull(), F.log10("n") + F.col("lift") + float(np.log10(1 - unseen)))
    spelling = F.col("neural") + float(np.log10(unseen))
    most = F.greatest(word, spelling)
    mixed = most + F.log10(F.coalesce(F.pow(F.lit(10.0), word - most), F.lit(0.0)) + F.pow(F.lit(10.0), spelling - most))
    rare = rare.groupBy("key").agg(F.sum(base).alias("base2"), F.sum(mixed).alias("mixed2"), F.count("n").alias("known2"))
    out = made.where("hash is null").select("key", "doc_id", "n_tokens", "n_known", "base", "mixed").join(rare, "key", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD).alias("held_out"), "n_tokens", plus("n_known", "known2").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), plus("base", "base2").alias("base_score"), plus("mixed", "mixed2").alias("score"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"))
