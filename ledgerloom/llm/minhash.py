"""MinHash near-duplicates by a multi-index Hamming join on b-bit signatures.

A signature has CHUNKS chunks of WIDTH slots, each the low 16 bits of a least hash. Two signatures that differ in at most
CHUNKS * (ERRORS + 1) - 1 slots have, by the pigeonhole principle, a chunk with at most ERRORS differing slots. Every way to
leave ERRORS slots out of a chunk gives a key, so two such signatures surely share a key; pairs at the least similarity
that differ in more slots share none with a probability of 8e-7, by the binomial. Nothing else loses a link: candidates fall
only by exact bounds, and links are confirmed on whole shingle sets.

The bound: each class carries BITS bits, set at its shingles' hashes. Every bit that only one of two classes has is a shingle
that the other lacks, so sizes and bits bound the intersection from above.

Work is kept low among the copies:
1. Equal word sequences are one class.
2. Each class is compared with the least class in its most frequent bucket: a pair per class at most, which joins up large
   groups of near copies.
3. In buckets that still hold several components, members of different components are compared in tiles: those outside a
   bucket's largest component with all members of that component, each such member once per component and not per bucket, and
   those outside with each other. A tile holds at most twice TILE classes and passes on the pairs that the bound lets pass or,
   if these are more than its classes, the likeliest as a spanning forest, and names the classes of the others.
4. Where such a forest's pair turns out to be no link, the classes whose pairs were held back meet once more, in tiles that
   hold their whole shingle sets: there every pair is decided at once, and a tile passes on a spanning forest of true links.

Edge cases: texts without words, null texts and null ids link with nothing; a text of fewer words than a shingle is one
shingle; equal rows are copies of each other; of rows with one id and different texts each has its own links. Columns other
than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common

common.shipped(__name__)
SHINGLE = 5
PERCENT = 75
CHUNKS, WIDTH = 14, 5
ERRORS = 1
SLOTS = CHUNKS * WIDTH
BITS = 4096
SEED = 29
#: Classes and, where a tile holds whole sets, shingles on a side of it; pairs for each class that it passes on without making a
#: forest of them; pairs bounded and pairs decided at once.
TILE = 1024
TILE_SHINGLES = 4_000_000
PASSED = 1
BOUNDED = 100_000
DECIDED = 64


class WordHashes(dict):
    """64-bit hashes of words, with a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def shingle_hashes(texts: list[bytes], hashes: WordHashes, size: int = SHINGLE):
    """(64-bit hashes of all shingles, how many each text has, words of each text). Texts are lower-cased bytes."""
    import numpy as np

    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((hashes[x] for w in words for x in w), np.uint64, int(n.sum()))
    ends = np.cumsum(n)
    starts = ends - n
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    first = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    last = np.repeat(ends, count)
    odd = np.random.default_rng(SEED).integers(1, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(len(first), np.uint64)
    for j in range(size):
        at = first + j
        inside = at < last
        out += np.where(inside, flat[np.minimum(at, max(len(flat) - 1, 0))], np.uint64(j + 1)) * odd[j] if len(flat) else out
        out ^= out >> np.uint64(29)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    return out, count, words


def signatures(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, rid, k1, k2, n_shingles, sig, bits): the row's and the content's address and the signature, null where a text has no words, and its bits."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        hashes, rng = WordHashes(), np.random.default_rng(SEED + 1)
        mul = rng.integers(1, 2**63, SLOTS, np.uint64) * np.uint64(2) + np.uint64(1)
        mix = rng.integers(0, 2**63, SLOTS, np.uint64)
        for batch in batches:
            for lo, texts in common.text_parts(batch.column(1)):
                hi = lo + len(texts)
                h, count, words = shingle_hashes([t.lower() for t in texts], hashes)
                full = np.flatnonzero(count)
                at = (np.cumsum(count) - count)[full]
                sig = np.empty((len(full), SLOTS), np.uint16)
                for k in range(SLOTS) if len(full) else ():
                    least = np.minimum.reduceat((h ^ mix[k]) * mul[k], at)
                    sig[:, k] = (least >> np.uint64(20)).astype(np.uint16)
                sigs, distinct, keys, bits = [None] * (hi - lo), np.zeros(hi - lo, np.int64), [None] * (hi - lo), [None] * (hi - lo)
                for j, (i, a) in enumerate(zip(full.tolist(), at.tolist(), strict=True)):
                    sigs[i] = sig[j].tobytes()
                    own = np.unique(h[a : a + count[i]])
                    distinct[i] = len(own)
                    flags = np.zeros(BITS, bool)
                    flags[(own & np.uint64(BITS - 1)).astype(np.int64)] = True
                    bits[i] = np.packbits(flags).tobytes()
                    keys[i] = xxhash.xxh3_128_digest(b" ".join(words[i]))
                k1 = [k and int.from_bytes(k[:8], "little", signed=True) for k in keys]
                k2 = [k and int.from_bytes(k[8:], "little", signed=True) for k in keys]
                own = [batch.column(c).slice(lo, hi - lo) for c in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(distinct), pa.array(sigs, pa.binary()), pa.array(bits, pa.binary())], ["doc_id", "rid", "k1", "k2", "n_shingles", "sig", "bits"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("rid", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, rid long, k1 long, k2 long, n_shingles long, sig binary, bits binary")


def keys(sig: Column) -> Column:
    """A 64-bit key for each chunk and slot left out of it."""
    chunk = 2 * WIDTH

    def key(q: Column) -> Column:
        at, out = (q / WIDTH).cast("int") * chunk, (q % WIDTH) * 2
        return F.xxhash64(q, F.concat(F.substring(sig, at + 1, out), F.substring(sig, at + out + 3, chunk - 2 - out)))

    return F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), key)


def bounded(n, bits, i, j, percent: int):
    """Which pairs (i, j) of rows the sizes and the bits let pass, and the most that they can share, in parts of their union; bits: rows of longs."""
    import numpy as np

    out = []
    for k in range(0, len(i), BOUNDED):
        a, b = i[k : k + BOUNDED], j[k : k + BOUNDED]
        for own in (slice(0, 1), slice(0, 8), slice(0, None)):  # a part of the bits bounds too
            x, y = bits[a, own], bits[b, own]
            count = lambda z: np.bitwise_count(z).sum(axis=1, dtype=np.int64)
            most = np.minimum(n[a] - count(x & ~y), n[b] - count(y & ~x))
            fits = (100 + percent) * most >= percent * (n[a] + n[b])
            a, b, most = a[fits], b[fits], most[fits]
        out.append((a, b, most / (n[a] + n[b] - most)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (i, j, np.zeros(0))


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b) of classes, those whose whole shingle sets reach the similarity. texts: (class, text, n, bits) of all that occur."""
    one, two = (texts.select(*[F.col(c).alias(x + k) for c, k in (("class", ""), ("text", "t"), ("n", "n"), ("bits", "s"))]) for x in "ab")
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "at", "bt", "an", "bn", "as", "bs")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hashes, kept = WordHashes(), (None, None)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n = np.concatenate([part.column(c).to_numpy() for c in (4, 5)])
                bits = np.frombuffer(b"".join(x for c in (6, 7) for x in part.column(c).to_pylist()), np.uint64).reshape(len(n), -1)
                i = np.arange(part.num_rows)
                part = part.take(pa.array(bounded(n, bits, i, i + part.num_rows, percent)[0]))
                a, ta, tb = part.column(0).to_pylist(), *(part.column(c).cast(pa.binary()).to_pylist() for c in (2, 3))
                yes = []
                for k in range(len(a)):
                    if kept[0] != a[k]:  # rows of one a come together
                        kept = (a[k], np.unique(shingle_hashes([ta[k].lower()], hashes)[0]))
                    other = np.unique(shingle_hashes([tb[k].lower()], hashes)[0])
                    shared = len(np.intersect1d(kept[1], other, assume_unique=True))
                    if 100 * shared >= percent * (len(kept[1]) + len(other) - shared):
                        yes.append(k)
                yield part.select(["a", "b"]).take(pa.array(yes, pa.int64()))

    return both.mapInArrow(run, "a long, b long")


def tiles(keyed: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """(g, p, q, side, class): the tiles in which classes of different components that share a key meet.

    `load` in keyed and classes: the part of a tile's side that a class takes. q is -1 where members of a component (side 0) meet those outside (side 1); else p and q are a bucket's blocks.
    """
    component = F.coalesce("component", "class").alias("component")
    of = keyed.select("key", "class", "load").join(found, "class", "left").select("key", "class", "load", component)
    by = of.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("load").alias("load"))
    mixed = by.groupBy("key").agg(F.count("*").alias("many"), F.max(F.struct("n", "component", "load")).alias("main"), F.sum("load").alias("all")).where("many > 1")
    mixed = mixed.select("key", "many", F.col("main.component").alias("main"), (F.col("all") - F.col("main.load")).alias("rest"))
    outside = common.written(of.join(mixed, "key").where("component <> main"), "outside")
    hash_ = F.xxhash64("class")
    # a component's members, each once, and those outside with all its blocks
    meets = outside.select("main", "class").distinct()
    size = lambda load: F.greatest(F.ceil(load), F.lit(1)).cast("int").alias("blocks")
    members = classes.select("class", "load").join(found, "class", "left").select("class", "load", component)
    members = members.join(meets.select(F.col("main").alias("component")).distinct(), "component")
    blocks = members.groupBy(F.col("component").alias("main")).agg(size(F.sum("load")))
    members = members.withColumnRenamed("component", "main").join(blocks, "main")
    first = members.select(F.col("main").alias("g"), F.pmod(hash_, "blocks").cast("int").alias("p"), F.lit(-1).alias("q"), F.lit(0).alias("side"), "class")
    second = meets.join(blocks, "main").select(F.col("main").alias("g"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("p"), F.lit(-1).alias("q"), F.lit(1).alias("side"), "class")
    # those outside with each other
    among = outside.where("many > 2").withColumn("blocks", size(F.col("rest"))).withColumn("own", F.pmod(hash_, "blocks").cast("int"))
    place = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "own").alias("p"), F.greatest(x, "own").alias("q"), (x < F.col("own")).cast("int").alias("side")))
    third = among.select(F.col("key").alias("g"), F.explode(place).alias("t"), "class").select("g", "t.p", "t.q", "t.side", "class")
    return first.unionByName(second).unionByName(third)


def by_tile(placed: DataFrame, described: DataFrame, columns: list[str], handle, names: list[str], schema: str) -> DataFrame:
    """What handle(tile) gives for each tile, a dict of its rows' columns by name: rows of so many columns."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.bool_() if part.endswith("boolean") else pa.int64() for part in schema.split(", ")]
        now, tile, out = None, {}, []

        def rows() -> pa.RecordBatch:
            made = list(zip(*out, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, types, strict=True)], names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                keys = list(zip(*(part.column(c).to_pylist() for c in range(3)), strict=True))
                values = [part.column(c).to_pylist() for c in range(3, 3 + len(columns))]
                for k, key in enumerate(keys):
                    if key != now:
                        if now is not None:
                            out.extend(handle(tile))
                        now, tile = key, {c: [] for c in columns} | {"one": key[1] == key[2]}
                    for c, v in zip(columns, values, strict=True):
                        tile[c].append(v[k])
                yield rows()
                out.clear()
        if now is not None:
            out.extend(handle(tile))
        yield rows()

    rows = placed.join(described, "class").select("g", "p", "q", *columns)
    return rows.repartition("g", "p", "q").sortWithinPartitions("g", "p", "q").mapInArrow(run, schema)


def _bounded_pairs(tile: dict, percent: int) -> Iterator:
    """Pairs (i, j) of a tile's classes of different components that the bound lets pass, and its value, some lines at once."""
    import numpy as np

    side, n, comp = (np.array(tile[c]) for c in ("side", "n", "component"))
    bits = np.frombuffer(b"".join(tile["bits"]), np.uint64).reshape(len(n), -1)
    left = np.arange(len(n)) if tile["one"] else np.flatnonzero(side == 0)
    right = left if tile["one"] else np.flatnonzero(side == 1)
    for k in range(0, len(left), 64):
        i, j = left[k : k + 64][:, None], right[None]
        fits = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        fits &= (i < j) | (not tile["one"])
        x, y = np.nonzero(fits)
        yield bounded(n, bits, left[k + x], right[y], percent)


def candidates(placed: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """(a, b, partly): pairs of a tile's classes of different components that the bound lets pass, and whether the tile held others back.

    A class with pairs held back has a row of its own, without b. described has (class, component, n, bits).
    """

    def pairs_of(tile: dict) -> Iterator:
        import numpy as np

        got = list(_bounded_pairs(tile, percent))
        if not got:
            return
        i, j, score = (np.concatenate(x) for x in zip(*got, strict=True))
        name = np.array(tile["class"])
        partly = len(i) > PASSED * len(name)
        if partly:
            order = np.argsort(-score, kind="stable")
            i, j = i[order], j[order]
            label = np.unique(tile["component"], return_inverse=True)[1]
            u, v = label[i], label[j]
            # of each two components the likeliest pair, then the forest
            first = np.sort(np.unique(np.minimum(u, v) * (label.max() + 1) + np.maximum(u, v), return_index=True)[1])
            now, held = np.arange(label.max() + 1), np.ones(len(i), bool)
            for k, x, y in zip(first.tolist(), u[first].tolist(), v[first].tolist(), strict=True):
                if now[x] != now[y]:
                    now[now == now[x]] = now[y]
                    held[k] = False
            yield from ((x, None, True) for x in name[np.unique(np.r_[i[held], j[held]])].tolist())
            i, j = i[~held], j[~held]
        a, b = name[i], name[j]
        yield from ((x, y, partly) for x, y in zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))

    made = by_tile(placed, described, ["side", "class", "component", "n", "bits"], pairs_of, ["a", "b", "partly"], "a long, b long, partly boolean")
    return made.groupBy("a", "b").agg(F.max("partly").alias("partly"))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(class, shingles): a class's distinct shingle hashes, in order."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for lo, own in common.text_parts(batch.column(1)):
                h, count, _ = shingle_hashes([t.lower() for t in own], hashes)
                sets = [np.unique(x).tobytes() for x in np.split(h, np.cumsum(count)[:-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(own)), pa.array(sets, pa.binary())], ["class", "shingles"])

    return texts.select("class", "text").mapInArrow(run, "class long, shingles binary")


def decided(placed: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """(a, b): in each tile a spanning forest of all links between its classes. described has (class, component, n, bits, shingles)."""

    def links_of(tile: dict) -> Iterator:
        import numpy as np

        name, n, sets = tile["class"], np.array(tile["n"]), [np.frombuffer(x, np.uint64) for x in tile["shingles"]]
        label = np.unique(tile["component"], return_inverse=True)[1]
        for i, j, score in _bounded_pairs(tile, percent):
            order = np.lexsort((-score, i))
            i, j = i[order], j[order]
            for own in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1) if len(i) else ():
                x, rest = int(i[own[0]]), j[own]
                while len(rest := rest[label[rest] != label[x]]):
                    now, rest = rest[:DECIDED], rest[DECIDED:]
                    flat = np.concatenate([sets[y] for y in now.tolist()])
                    at = np.minimum(np.searchsorted(sets[x], flat), len(sets[x]) - 1)
                    shared = np.add.reduceat((sets[x][at] == flat).astype(np.int64), np.cumsum(n[now]) - n[now])
                    for y in now[100 * shared >= percent * (n[x] + n[now] - shared)].tolist():
                        if label[x] != label[y]:
                            label[label == label[y]] = label[x]
                            yield name[x], name[y]

    return by_tile(placed, described, ["side", "class", "component", "n", "bits", "shingles"], links_of, ["a", "b"], "a long, b long")


def linked(keyed: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(class, component) of all linked classes."""

    def joined(links: DataFrame) -> DataFrame:
        return common.written(common.components(links), "components").withColumnRenamed("node", "class")

    def described(classes: DataFrame, found: DataFrame) -> DataFrame:
        return classes.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))

    best = keyed.groupBy("class").agg(F.max(F.struct("many", "key")).alias("best")).select("class", F.col("best.key").alias("key"))
    center = keyed.groupBy("key").agg(F.min("class").alias("a"))
    first = best.join(center, "key").where("a <> class").select("a", F.col("class").alias("b"))
    found = joined(common.written(confirmed(first, texts, percent), "links"))
    # a star for each component stands for the links so far
    star = lambda found: found.select(F.col("component").alias("a"), F.col("class").alias("b"))
    classes, load = classes.select("class", "n", "bits"), F.lit(1 / TILE)
    placed = tiles(keyed.withColumn("load", load), found, classes.withColumn("load", load))
    more = common.written(candidates(placed, described(classes, found), percent), "more")
    pairs = more.where("b is not null")
    new = common.written(confirmed(pairs.select("a", "b"), texts, percent), "links")
    found = joined(star(found).unionByName(new))
    if pairs.where("partly").join(new, ["a", "b"], "left_anti").isEmpty():
        return found
    held = more.where("b is null").select(F.col("a").alias("class"))
    load = F.greatest(load, F.col("n") / TILE_SHINGLES).alias("load")
    sets = common.written(shingle_sets(texts.join(held, "class", "left_semi")), "sets")
    classes = common.written(classes.join(held, "class", "left_semi").select("class", "n", "bits", load), "held")
    keyed = common.written(keyed.select("class", "key").join(classes.select("class", "load"), "class"), "keys")
    last = decided(tiles(keyed, found, classes), described(classes.drop("load").join(sets, "class"), found), percent)
    return joined(star(found).unionByName(common.written(last, "links")))


def clusters(documents: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; component_id is the least id reachable by links."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = common.written(signatures(docs), "signatures")
    full = F.col("k1").isNotNull() & F.col("doc_id").isNotNull()
    classes = rows.where(full).groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "rid")).alias("one"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bits").alias("bits"))
    # numbers are given once, when the table is written
    classes = common.written(classes.select(F.monotonically_increasing_id().alias("class"), "k1", "k2", "one.doc_id", "one.rid", "n", "sig", "bits"), "classes")
    keyed = classes.select("class", F.explode(keys(F.col("sig"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("many")).where("many > 1")
    # only rows of shared keys are kept for what follows
    keyed = common.written(keyed.join(shared, "key"), "keys")
    wanted = keyed.select("class").distinct().join(classes.select("class", "doc_id", "rid", "n", "bits"), "class")
    texts = docs.withColumn("rid", F.xxhash64("text")).join(wanted, ["doc_id", "rid"]).dropDuplicates(["class"])
    texts = common.written(texts.select("class", "text", "n", "bits"), "texts")
    found = linked(keyed, classes, texts, percent)
    member = classes.select("class", "k1", "k2", "doc_id").join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = member.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    member = member.join(least, "component").select("k1", "k2", "component_id")
    out = rows.where(full).select("doc_id", "k1", "k2", "n_shingles").join(member, ["k1", "k2"], "left")
    alone = rows.where(~full).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id").unionByName(alone)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clusters(common.table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
