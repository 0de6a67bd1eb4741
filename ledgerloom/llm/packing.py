"""Packing by concatenating and cutting: two passes over partition token totals give global offsets, then fixed windows.

The first pass turns documents into token ids and writes, for each, its start inside its partition. Prefix sums over the
partitions' totals then give every document its place in one long row of ids. Cutting that row every `length` ids makes the
sequences; a document that crosses a cut is two or more boundary pieces, also where partitions meet. Only the last sequence
needs padding, and every id lies in exactly one piece.

Edge cases: null and empty texts are the end id alone; very long texts become many pieces; equal rows are packed each; no
rows give no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import common

common.shipped(__name__)
LENGTH = 2048
END = 1
#: Parts of words, and other words, that a task knows the ids of; emptied when full, so that its memory is bounded.
CACHE_PARTS = 300_000
#: New parts or words that are tokenised at once.
NEW_WORDS = 10_000
#: Words of texts that are handled at once: the more, the fewer distinct ones in all.
STEP_WORDS = 1_000_000
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Spans:
    """Sequences of ids laid end to end, by number."""

    def __init__(self, first: list[int]):
        import numpy as np

        self.sizes, self.starts, self.flat = np.array([len(first)], np.int32), np.zeros(1, np.int32), np.array(first, np.uint32)

    def add(self, ids, sizes) -> None:
        import numpy as np

        sizes = sizes.astype(np.int32)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes, dtype=np.int32) - sizes])
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, ids.astype(np.uint32)])

    def get(self, numbers):
        """The ids of these sequences, end to end, and how many each has."""
        import numpy as np

        n = self.sizes.take(numbers)
        ends = np.cumsum(n, dtype=np.int64)
        at = np.repeat(self.starts.take(numbers) - (ends - n), n)
        at += np.arange(len(at))
        return self.flat.take(at), n


class Numbers(dict):
    """Numbers of strings by first appearance; new ones wait in `new`."""

    def __init__(self):
        super().__init__({b"": 0})
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        self.new.append(key)
        out = self[key] = len(self)
        return out

    def of(self, keys):
        """Of an Arrow array of strings."""
        import numpy as np
        import pyarrow as pa

        keys = keys.cast(pa.binary()).to_numpy(zero_copy_only=False)  # much faster than a Python list made by Arrow
        return np.fromiter(map(self.__getitem__, keys.tolist()), np.int64, len(keys))


class WordIds:
    """Numbers of distinct words, and their ids. White space ends a word in this vocabulary, so that words stand alone.

    Number 0 stands for a text's end. A word of letters, ASCII signs or the one followed by the other has these as its parts, of
    which the tokenizer's model alone gives the ids, the last of a part being one that ends parts; case is dropped. Other words
    are tokenised together, as one text. Ids of parts and of other words are kept for the words that come later.
    """

    def __init__(self, tokenizer_path: str, end: int = END):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.end = Tokenizer.from_file(tokenizer_path), end
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        known = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(known.values()) + 1, bool)
        self.closing[[i for t, i in known.items() if t.endswith("</w>")]] = True
        # the model's signs for bytes: printable ones stand for themselves, the others follow 255 in order
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.shown = {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in plain)}
        # of bytes from 128 on, which have two bytes each
        self.pairs = np.array([[0, 0]] * 128 + [list(chr(self.shown.get(b, b)).encode()) for b in range(128, 256)], np.uint8)
        self._forget()

    def _forget(self) -> None:
        import numpy as np

        self.parts, self.part_spans, self.split = Numbers(), Spans([]), np.ones(1, bool)
        self.others, self.other_spans = Numbers(), Spans([])

    def numbers(self, words):
        """Numbers of an Arrow array of distinct words, good until the next call."""
        import numpy as np
        import pyarrow.compute as pc

        if len(self.parts) + len(self.others) > CACHE_PARTS:
            self._forget()
        self.words, self.spans = words, Spans([self.end])
        if not len(words):
            return np.zeros(0, np.int64)
        low = pc.ascii_lower(words)
        head = pc.ascii_rtrim(low, SIGNS.decode())
        each = np.stack([self._parts(head), self._parts(_rest(low, head))], axis=1)
        odd = np.flatnonzero(~self.split[each[:, 0]])
        each[odd] = 0
        ids, sizes = self.part_spans.get(each.ravel())
        sizes = sizes.reshape(-1, 2).sum(axis=1)
        if len(odd):
            own, n = self.other_spans.get(self._others(words.take(odd)))
            ids = np.insert(ids, np.repeat(np.cumsum(sizes)[odd], n), own)
            sizes[odd] = n
        self.spans.add(ids, sizes)
        return np.arange(1, len(words) + 1)

    def _parts(self, column):
        coded = column.dictionary_encode()
        got = self.parts.of(coded.dictionary)
        new = self.parts.new
        for k in range(0, len(new), NEW_WORDS):
            self._learn(new[k : k + NEW_WORDS])
        new.clear()
        return got.take(coded.indices.to_numpy())

    def _learn(self, parts: list[bytes]) -> None:
        """Ids of new parts; of those that the splitting parts further there are none."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        column = pa.array(parts, pa.binary()).view(pa.string())
        sizes = np.zeros(len(parts), np.int32)
        signs = pc.equal(pc.ascii_ltrim(column, SIGNS.decode()), "").to_numpy(False)
        letters = pc.utf8_is_alpha(column).to_numpy(False)
        # letters under U+0250, which have no form but their own and become one letter each, but U+0130
        offsets, data = _bytes(column)
        most = np.maximum.reduceat(data, offsets[:-1])
        near = letters & (most < 0xCA) & ~pc.match_substring(column, "\u0130").to_numpy(False)
        order, texts = np.flatnonzero(signs | near), []
        if len(order):
            chosen = pc.utf8_lower(column.take(pa.array(order)))
            texts.append(self._shown(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), chosen), " ")[0].as_buffer()))
        for k in np.flatnonzero(letters & ~near).tolist():
            text = self._letters(parts[k])
            if text is not None:
                texts.append(text)
                order = np.append(order, k)
        ids = np.zeros(0, np.int64)
        if texts:
            ids = np.array(self.plain.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.int64)
            n = np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
            sizes[order] = n
            if (np.diff(order) < 0).any():  # back to the order of the parts
                back = Spans([])
                back.add(ids, n)
                ids = back.get(1 + np.argsort(order))[0]
        self.part_spans.add(ids, sizes)
        self.split = np.concatenate([self.split, sizes > 0])

    def _shown(self, joined) -> str:
        """UTF-8 words with spaces between as the model sees them."""
        import numpy as np

        raw = np.frombuffer(joined, np.uint8)
        wide = np.flatnonzero(raw >= 128)
        if not len(wide):
            return raw.tobytes().decode()
        out = np.insert(raw, wide + 1, self.pairs[raw[wide], 1])
        out[wide + np.arange(len(wide))] = self.pairs[raw[wide], 0]
        return out.tobytes().decode()

    def _letters(self, word: bytes) -> str | None:
        """A word of letters, not all of them ASCII, as the model sees it; None for other words."""
        import unicodedata

        text = word.decode()
        if not (text.isalpha() and unicodedata.is_normalized("NFC", text)):
            return None
        text = "".join(map(str.lower, text))
        if not text.isalpha():  # a letter may become a letter and a mark, which the splitting parts
            return None
        return text.encode().decode("latin-1").translate(self.shown)

    def _others(self, words):
        """Numbers among the other words, which the whole tokenizer splits."""
        import numpy as np

        got, new = self.others.of(words), self.others.new
        for k in range(0, len(new), NEW_WORDS):
            texts = [w.decode() for w in new[k : k + NEW_WORDS]]
            made = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
            at = np.fromiter((x[0] for x in made.offsets), np.int64, len(made.offsets))
            self.other_spans.add(np.array(made.ids, np.int64), np.bincount(np.searchsorted(ends, at, "right"), minlength=len(texts)))
        new.clear()
        return got

    def ids(self, numbers):
        """The ids of words by their numbers, end to end, and how many each has."""
        return self.spans.get(numbers)

    def whole(self, text: bytes):
        """The ids of a text as the tokenizer itself sees it, the end id last."""
        import numpy as np

        return np.array([*self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.end], np.uint32)


def _bytes(column):
    """Offsets and bytes of an Arrow array of strings, as numpy arrays."""
    import numpy as np

    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _rest(words, heads):
    """What words have after their heads."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    (offsets, data), n = _bytes(words), pc.binary_length(heads).to_numpy()
    size = np.diff(offsets) - n
    ends = np.cumsum(size, dtype=np.int32)
    at = np.repeat(offsets[:-1] + n - (ends - size), size)
    at += np.arange(len(at), dtype=at.dtype)
    return pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends])), pa.py_buffer(data.take(at))])


def text_ids(words: WordIds, texts):
    """Of an Arrow array or a list of texts: ids of the texts laid end to end, each with its end id, how many ids each word has,
    the end among them, how many words each text, and their numbers: that of the end, 0, or 1 more than in the distinct words."""
    import numpy as np
    import pyarrow as pa

    if isinstance(texts, list):
        texts = pa.array(texts, pa.binary()).view(pa.string())
    own, distinct, n = common.split_words(texts)
    numbers = np.zeros(len(own) + len(n), np.int64)
    numbers[np.delete(np.arange(len(numbers)), np.cumsum(n + 1) - 1)] = words.numbers(distinct)[own]
    return *words.ids(numbers), n + 1, numbers


def tokenized(documents: DataFrame, tokenizer_path: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, local, n, ids): a document's ids, the end id last, and where they start in their partition."""
    path = tokenizer_path or vocabulary()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        words, local, part = WordIds(path, end), 0, TaskContext.get().partitionId()
        for batch in batches:
            for lo, many in common.part_ranges(batch.column(1), STEP_WORDS):
                texts = batch.column(1).slice(lo, many).cast(pa.string()).fill_null("")
                ids, per_word, n, _ = text_ids(words, texts)
                sizes = np.add.reduceat(per_word, np.cumsum(n) - n, dtype=np.int64)
                odd = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(False)).tolist()  # a special token may hold white space around it
                if odd:
                    each = np.split(ids, np.cumsum(sizes)[:-1])
                    for i in odd:
                        each[i] = words.whole(texts[i].as_buffer().to_pybytes())
                    ids, sizes = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
                ends = np.cumsum(sizes)
                flat = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(np.r_[0, 4 * ends].astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array([part] * len(texts), pa.int32()), pa.array(local + ends - sizes), pa.array(sizes), flat], ["doc_id", "part", "local", "n", "ids"])
                local += int(ends[-1])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part int, local long, n long, ids binary")


def placed(tokens: DataFrame) -> DataFrame:
    """Adds `at`, the document's place in the long row of ids. The totals are one row per partition of the first pass."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # as many rows as the first pass had partitions, 16 bytes each: small at any size of input
    return tokens.join(F.broadcast(base), "part").withColumn("at", F.col("base") + F.col("local"))


def pieces(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds `p`: what a document gives to each sequence, as an array of (sequence_id, start, length, offset)."""
    cut = F.expr(f"""transform(sequence(at div {length}, (at + n - 1) div {length}), s -> struct(
        s as sequence_id, greatest(at, s * {length}) - at as start, least(at + n, (s + 1) * {length}) - greatest(at, s * {length}) as length,
        greatest(at - s * {length}, 0L) as offset))""")
    return placed(tokens).withColumn("p", cut)


def sequences(tokens: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """(sequence_id, ids): the sequences themselves; the last is padded."""
    each = pieces(tokens, length).withColumn("p", F.expr("transform(p, x -> struct(x.sequence_id, x.offset, substring(ids, int(4 * x.start) + 1, int(4 * x.length)) as ids))"))
    each = each.select(F.explode("p").alias("p")).select("p.*")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("h")))), lambda x: x.h), "")
    padding = f"{pad.to_bytes(4, 'little').hex().upper()}"
    return each.groupBy("sequence_id").agg(F.unhex(F.rpad(joined, length * 8, padding)).alias("ids"))


def pack(documents: DataFrame, length: int = LENGTH, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tokens = common.written(tokenized(documents, tokenizer_path), "tokens")
    each = pieces(tokens, length).withColumn("p", F.expr("transform(p, x -> struct(x.sequence_id, x.start, x.length, x.offset, crc32(substring(ids, int(4 * x.start) + 1, int(4 * x.length))) as ids_crc32))"))
    each = each.select("doc_id", F.col("n").alias("doc_tokens"), F.explode("p").alias("p"))
    return each.select("doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
