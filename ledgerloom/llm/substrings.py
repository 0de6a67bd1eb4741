"""Exact removal of repeated passages by super-k-mer partitioning.

A window is WINDOW consecutive words of one document. Its minimiser is the least hash of the GRAM-word sequences in it, so
equal windows have equal minimisers, and consecutive windows that share one are a super-k-mer, a single packed string.

1. Each minimiser's least and greatest document, aggregated before the shuffle. Minimisers of one document can't hold a
   repeat; the others set two bits each in a filter of 16 to 32 bits for each of them, up to FILTER_BITS. False hits, even a
   full filter, only let strings through that turn out to be unique.
2. Super-k-mers that pass travel as packed strings to their minimiser's bucket, equal strings of a task as one row with their
   least and greatest document. There strings are sorted by minimiser, and each group's windows are counted exactly: a run of
   windows of a string gets the least document that any of them starts in.
3. The places of these strings, without text and written by the same pass over the texts, are joined with the runs; windows in
   later documents go, and every word that such a window covers is removed.

A passage in a third of all documents is thus one row per task in step 2, and a key with one row on the right in step 3. The
bucket of a minimiser with very many super-k-mers (HOT_STRINGS or more, and a HOT_SHARE-th of all or more, so at most HOT_SHARE
minimisers) is dealt to all tasks by the strings' digests, for around one common phrase there may be as many different strings
as documents. Its strings, and those of any group of more than GROUP_BYTES, are passed on as one row per window of a distinct
string under a 128-bit hash, and counted by aggregates that combine before the shuffle. Strings are told apart by 128-bit hashes.

A window goes if the same words also start in a document with a smaller id.

Edge cases: null and short texts have no windows and keep all words; rows without an id neither lose words nor make others
lose any; equal rows with one id do not remove each other. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.llm.minhash import WordHashes

common.shipped(__name__)
WINDOW = 50
GRAM = 8
#: Bits of the filter at most: 32 MB in every executor.
FILTER_BITS = 1 << 28
#: Super-k-mers of a minimiser, and its part of all shared ones, from which on its strings are dealt to all tasks.
HOT_STRINGS = 50_000
HOT_SHARE = 65_536
#: Distinct strings that a task keeps the least and greatest document of, before it passes them on.
HELD_STRINGS = 100_000
#: Bytes of distinct strings of one minimiser that a task holds.
GROUP_BYTES = 8_000_000
#: Rows that a task gathers before it passes them on.
OUT_ROWS = 10_000


def windows_of(texts: list[bytes], hashes: WordHashes, window: int = WINDOW):
    """Super-k-mers of texts: arrays of text number, first window, number of windows, minimiser; and the texts' words."""
    import numpy as np

    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(n.sum()))
    ends = np.cumsum(n)
    count = np.maximum(n - window + 1, 0)
    if not count.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), words
    gram = np.zeros(len(flat) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        gram = (gram ^ (gram >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + flat[j : j + len(gram)]
    gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    least, size, span = gram, 1, window - GRAM + 1
    while size * 2 <= span:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if span > size:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    text = np.repeat(np.arange(len(n)), count)
    at = np.repeat(ends - n - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    least = least[at]
    new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
    return text[new], at[new] - (ends - n)[text[new]], np.diff(np.r_[new, len(least)]), least[new].view(np.int64), words


def minimisers(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(mini, lo, hi, n): every minimiser with its least and greatest document and its number of super-k-mers."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, texts in common.text_parts(batch.column(2)):
                text, _, _, mini, _ = windows_of(texts, hashes, window)
                own, (u, inv, n) = ids[at + text], np.unique(mini, return_inverse=True, return_counts=True)
                lo, hi = np.full(len(u), np.iinfo(np.int64).max), np.full(len(u), np.iinfo(np.int64).min)
                np.minimum.at(lo, inv, own)
                np.maximum.at(hi, inv, own)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(lo), pa.array(hi), pa.array(n, pa.int64())], ["mini", "lo", "hi", "n"])

    rows = docs.mapInArrow(run, "mini long, lo long, hi long, n long")
    return rows.groupBy("mini").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))


def shared_minimisers(docs: DataFrame, window: int = WINDOW) -> tuple:
    """The filter of the minimisers of more than one document, as longs, and (mini) of those among them that are hot."""
    import numpy as np

    shared = common.written(minimisers(docs, window).where("lo < hi").select("mini", "n"), "minimisers")
    number, total = shared.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = min(FILTER_BITS, max(64, 1 << (16 * number).bit_length()))
    low, shift = size - 1, size.bit_length() - 1
    places = F.expr(f"explode(array(mini & {low}L, shiftrightunsigned(mini, {shift}) & {low}L))")
    bits = shared.select(places.alias("p"))
    bits = bits.groupBy(F.expr("shiftright(p, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(p & 63)))").alias("b"))
    out = np.zeros(size // 64, np.int64)
    for batch in bits.toArrow().to_batches():  # at most FILTER_BITS / 64 rows
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out, shared.where(F.col("n") >= max(HOT_STRINGS, total // HOT_SHARE)).select("mini")


def _passed(bits, mini):
    import numpy as np

    low, shift = 64 * len(bits) - 1, (64 * len(bits)).bit_length() - 1
    out = np.ones(len(mini), bool)
    for at in (mini & low, (mini.view(np.uint64) >> np.uint64(shift)).view(np.int64) & low):
        out &= (bits[at >> 6] >> (at & 63)) & 1 == 1
    return out


def _shared_kmers(batch, bits, hashes: WordHashes, window: int) -> Iterator:
    """(row, first word, minimiser, digest, packed string) of the super-k-mers of a batch that pass the filter."""
    import xxhash

    for at, texts in common.text_parts(batch.column(2)):
        text, start, n, mini, words = windows_of(texts, hashes, window)
        keep = _passed(bits, mini)
        last, flat, ends = -1, b"", []
        for k, s, m, key in zip(text[keep].tolist(), start[keep].tolist(), n[keep].tolist(), mini[keep].tolist(), strict=True):
            if k != last:
                last, flat, ends = k, b" ".join(words[k]), list(accumulate(map(len, words[k]), initial=0))  # without the spaces
            stop = s + m + window - 1
            packed = flat[ends[s] + s : ends[stop] + stop - 1]
            yield at + k, s, key, xxhash.xxh3_128_digest(packed), packed


def _batch(rows: list, kinds: str, names: list[str]):
    """A record batch of tuples; kinds: l for a long, b for bytes, d for a digest, which becomes two longs."""
    import numpy as np
    import pyarrow as pa

    columns = []
    for kind, column in zip(kinds, zip(*rows, strict=True) if rows else [()] * len(kinds), strict=True):
        if kind == "d":
            two = np.frombuffer(b"".join(column), np.int64).reshape(-1, 2)
            columns += [pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy())]
        else:
            columns.append(pa.array(column, pa.int64() if kind == "l" else pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names)


def occurrences(docs: DataFrame, shared, window: int = WINDOW) -> DataFrame:
    """One pass over the texts gives two kinds of rows. With `start`: (mini, h1, h2, doc_id, rid, start), where each string stands.

    Without: (mini, h1, h2, least, most, packed), see strings().
    """
    string_names, place_names = ["mini", "h1", "h2", "least", "most", "packed"], ["mini", "h1", "h2", "doc_id", "rid", "start"]
    schema = "mini long, h1 long, h2 long, least long, most long, packed binary, doc_id long, rid long, start long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes, seen, out, stand = WordHashes(), {}, [], []

        def known() -> list:
            rows = [(m, h, a, b, None) for (m, h), (a, b, n) in seen.items() if n]
            seen.clear()
            return rows

        def rows(own: list, kinds: str, names: list[str]) -> pa.RecordBatch:
            made = _batch(own, kinds, names)
            types = {part.split()[0]: pa.binary() if part.endswith("binary") else pa.int64() for part in schema.split(", ")}
            return pa.RecordBatch.from_arrays([made.column(c) if c in names else pa.nulls(len(own), t) for c, t in types.items()], list(types))

        for batch in batches:
            ids, rids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, start, mini, digest, packed in _shared_kmers(batch, shared.value, hashes, window):
                d = ids[row]
                stand.append((mini, digest, d, rids[row], start))
                if len(stand) >= OUT_ROWS:
                    yield rows(stand, "ldlll", place_names)
                    stand = []
                was = seen.get((mini, digest))
                if was is None:
                    seen[mini, digest] = [d, d, 0]
                    out.append((mini, digest, d, d, packed))
                    if len(seen) >= HELD_STRINGS:
                        out += known()
                    if len(out) >= OUT_ROWS:
                        yield rows(out, "ldllb", string_names)
                        out = []
                elif not was[0] <= d <= was[1]:
                    was[:] = min(d, was[0]), max(d, was[1]), 1
        yield rows(stand, "ldlll", place_names)
        yield rows(out + known(), "ldllb", string_names)

    return docs.mapInArrow(run, schema)


def strings_of(found: DataFrame) -> DataFrame:
    """Of occurrences(), the strings."""
    return found.where("start is null").select("mini", "h1", "h2", "least", "most", "packed")


def strings(docs: DataFrame, shared, window: int = WINDOW) -> DataFrame:
    """(mini, h1, h2, least, most, packed): a row for each string and task, more if a task holds too many; its text in one of them."""
    return strings_of(occurrences(docs, shared, window))


def places_of(found: DataFrame) -> DataFrame:
    """Of occurrences(), (mini, h1, h2, doc_id, rid, start): where the strings stand."""
    return found.where("start is not null").select("mini", "h1", "h2", "doc_id", "rid", "start")


def counted(packed: DataFrame, window: int = WINDOW, hot: DataFrame | None = None) -> DataFrame:
    """(mini, h1, h2, at, n, least, most, w1, w2): n windows of a string, from `at` on, whose least document is `least`.

    Where w1 and w2 are given, the window's least document over all strings is still to be found by its hash. hot: (mini), at
    most HOT_SHARE distinct ones, whose strings no single task meets.
    """

    def words_at(text: bytes) -> list[int]:
        at = [0]
        for w in text.split(b" "):
            at.append(at[-1] + len(w) + 1)
        return at

    def group(rows: list, out: list) -> None:
        if min(r[1] for r in rows) == max(r[2] for r in rows):
            return  # all of one document
        if len(rows) == 1:
            (digest, least, most, text), mini = rows[0][:4], rows[0][4]
            out.append((mini, digest, 0, text.count(b" ") + 2 - window, least, most, None, None))
            return
        first: dict = {}
        cut = []
        for _, least, _, text, _ in rows:
            at = words_at(text)
            cut.append([text[at[i] : at[i + window] - 1] for i in range(len(at) - window)])
            for key in cut[-1]:
                d = first.get(key)
                if d is None or least < d:
                    first[key] = least
        for (digest, _, most, _, mini), keys in zip(rows, cut, strict=True):
            begin, low = 0, first[keys[0]]
            for i, key in enumerate([*keys, None]):
                d = first[key] if key is not None else None
                if d != low:
                    if low < most:
                        out.append((mini, digest, begin, i - begin, low, most, None, None))
                    begin, low = i, d

    def spill(rows: list, out: list) -> None:
        import xxhash

        for digest, least, most, text, mini in rows:
            at = words_at(text)
            for i in range(len(at) - window):
                h = xxhash.xxh3_128_intdigest(text[at[i] : at[i + window] - 1])
                out.append((mini, digest, i, 1, least, most, (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["mini", "h1", "h2", "at", "n", "least", "most", "w1", "w2"]
        held, size, over, out, now = [], 0, False, [], None

        def end_string() -> None:
            nonlocal held, size, over
            if now is not None:
                held.append((now[1], now[2], now[3], now[4], now[0]))
                size += len(now[4])
                if over or now[5] is not None or size > GROUP_BYTES:
                    spill(held, out)
                    held, over = [], True

        def end_group() -> None:
            nonlocal held, size, over
            if held:
                group(held, out)
            held, size, over = [], 0, False

        for batch in batches:
            digests = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1).tobytes()
            for k, (mini, least, most, deal, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 3, 4, 6)), batch.column(5).cast(pa.binary()).to_pylist(), strict=True)):
                digest = digests[16 * k : 16 * k + 16]
                if now is not None and now[0] == mini and now[1] == digest:
                    now[2:5] = min(least, now[2]), max(most, now[3]), now[4] or text
                    continue
                end_string()
                if now is not None and now[0] != mini:
                    end_group()
                now = [mini, digest, least, most, text, deal]
                if len(out) >= OUT_ROWS:
                    yield _batch(out, "ldllllll", names)
                    out = []
        end_string()
        end_group()
        yield _batch(out, "ldllllll", names)

    if hot is None:
        rows = packed.withColumn("deal", F.lit(None).cast("long"))
    else:  # of bounded size
        rows = packed.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "mini", "left").withColumn("deal", F.when(F.col("_hot"), F.col("h1"))).drop("_hot")
    rows = rows.repartition("mini", "deal").sortWithinPartitions("mini", "h1", "h2")
    return rows.mapInArrow(run, "mini long, h1 long, h2 long, at long, n long, least long, most long, w1 long, w2 long")


def intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, rid, cuts): each document's runs of windows that go, as an array of (start, n)."""
    docs = docs.where("doc_id is not null and text is not null")
    bits, hot = shared_minimisers(docs, window)
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # FILTER_BITS at most
    met = common.written(occurrences(docs, shared, window), "strings")
    found = common.written(counted(strings_of(met), window, hot), "runs")
    single = found.where("w1 is not null")
    lows = single.groupBy("w1", "w2").agg(F.min("least").alias("low"))
    single = single.join(lows, ["w1", "w2"]).where("low < most").select("mini", "h1", "h2", "at", "n", F.col("low").alias("least"))
    runs = found.where("w1 is null and least < most").select(*single.columns).unionByName(single)
    late = places_of(met).join(runs, ["mini", "h1", "h2"]).where("doc_id > least")
    late = late.select("doc_id", "rid", (F.col("start") + F.col("at")).alias("start"), "n")
    return late.groupBy("doc_id", "rid").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("cuts"))


def without_repeats(documents: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row with the words that stay, joined by single spaces."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("rid"), F.col(text_col).cast("string").alias("text"))
    cuts = intervals(docs, window)
    joined = docs.join(cuts, ["doc_id", "rid"], "left").select("doc_id", "text", "cuts")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, gone, kept = [], [], []
            for text, cut in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or b"").split()
                n.append(len(words))
                if cut:
                    left, at = [], 0
                    for c in cut:
                        left += words[at : c["start"]] if c["start"] > at else []
                        at = max(at, c["start"] + c["n"] + window - 1)
                    words = left + words[at:]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary").withColumn("kept", F.col("kept").cast("string"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
