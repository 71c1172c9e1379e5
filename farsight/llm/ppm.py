"""Operator 4 -- language-model scores by prediction by partial matching.

The model is a trie of byte contexts.  Its lower part holds contexts of up to
ORDER bytes, learnt from all training texts: a symbol is coded in the longest
context the trie holds; if it has not followed that context, an escape
(method C) is coded and the next shorter context tried, without the symbols
that the longer one already ruled out.  These contexts reach back to the separator before
the current word, so a word's code length there depends on the word alone, and every
distinct word is counted, and coded, once.

Above them stand the bytes of the two words before, whose step is a whole
word: adaptive contexts, met earlier in the same text, then those of the corpus, all
in which a word stands MIN_COUNT times.  Their escapes are estimated from training texts, by what kind of
context it is and how many words before were foreseen; an escape excludes the
word that was foreseen.  A text is its words, each closed by a separator, and one end symbol.

With full counts the symbols of a context are among those of its suffix, so
exclusion needs one number per context, the mass its symbols have in the
suffix.  The trie and the word counts hold everything that the training texts
do and stay distributed, and so do the contexts of two words: tasks hold
what is frequent, the rest is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.shingles import hashed_texts, hashed_words, mixed
from farsight.llm.util import bitmap, dense_sums, give_back, in_bitmap, slices, table, trimmed
from farsight.session import saved

ORDER = 6
#: Longest grams of a part of the trie, about.
PART_GRAMS = 250_000
#: Code lengths of grams that every task which adds up words holds, at most; the others are joined.
CACHED_GRAMS = 200_000
#: A word foreseen by the corpus has followed its two words so often, whatever the size of the corpus.
MIN_COUNT = 3
#: 2**CELL_BITS cells, counted in parts of 2**PART_BITS, spare the count of most rarer words.
CELL_BITS, PART_BITS = 28, 15
#: Upper contexts that every task holds, at most; the others are joined.
CACHED_PHRASES = 1_000_000
#: Bits of the bitmap of the others, which only spares asking for contexts that there aren't.
ASKED_BITS = 26
#: Bytes of the texts that meet their upper contexts together, about.
CHUNK_BYTES = 4 << 20
#: Words whose counts every task holds, at most.
FREQUENT = 200_000
#: Words that a counting task keeps, about.
CACHE = 400_000
#: A pair of a context and the word after it, with its number, as tasks send it; pairs go in 2**PAIR_BITS parts.
PAIR, PAIR_BITS = np.dtype([("context", "<u8"), ("word", "<u8"), ("n", "u1")]), 12
END = b"\n"
_SYMBOLS = 256
_END_HASH = np.array([0x0A0A0A0A], np.uint64)


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, place within the word's segment, first place of each segment).
    A segment is a separator, the word and a separator; the end has no second one."""
    parts = [b" " + w if w == END else b" " + w + b" " for w in words]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    return data, np.arange(len(data)) - np.repeat(starts, sizes), starts


class Index:
    """Places of distinct int64 keys, by open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots, self.place = np.zeros(1 << bits, np.int64), np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(keys)), self._home(keys)
        while len(todo):
            free = self.place[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.place[slot], self.slots[slot] = todo[won], keys[todo[won]]
            left = np.ones(len(todo), bool)
            left[won] = False
            todo, at = todo[left], (at[left] + 1) & self.mask
        self.zero = self._of_zero()

    @classmethod
    def again(cls, slots: np.ndarray, place: np.ndarray) -> Index:
        """The index with these ``slots`` and ``place``, as sent to a task."""
        self = cls.__new__(cls)
        self.slots, self.place = slots, place
        self.shift, self.mask = np.uint64(65 - len(slots).bit_length()), len(slots) - 1
        self.zero = self._of_zero()
        return self

    def _of_zero(self) -> int:
        """The slot that holds key 0, or -1: any other slot with a 0 is empty."""
        at = int(self._home(np.zeros(1, np.int64))[0])
        while self.place[at] >= 0 and self.slots[at] != 0:
            at = (at + 1) & self.mask
        return at if self.place[at] >= 0 else -1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mixed(keys.view(np.uint64)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        at, out = self._home(keys), np.full(len(keys), -1, np.int64)
        todo, wanted = None, keys
        while len(at):
            slot = self.slots[at]
            same = slot == wanted  # an empty slot says -1 to key 0
            out[same if todo is None else todo[same]] = self.place[at[same]]
            go = np.flatnonzero(~same & ((slot != 0) | (at == self.zero)))
            todo, wanted, at = go if todo is None else todo[go], wanted[go], (at[go] + 1) & self.mask
        return out


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def longest_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places where words begin): for each coded symbol of each word the
    run of up to ORDER + 1 bytes that ends in it, which says all that its code length depends on."""
    data, place, starts = _laid_out(words)
    size = np.minimum(place, ORDER) + 1
    run = np.zeros(len(data), np.int64)
    for i in range(min(ORDER + 1, len(data))):
        run[i:] |= np.where(size[i:] > i, data[:len(data) - i] << (8 * i), 0)
    coded = place >= 1
    return (run | size << 56)[coded], starts - np.arange(len(starts))


def suffix_grams(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of all suffixes of the longest grams ``keys``."""
    size, bits, out, sums = keys >> 56, keys & ((1 << 56) - 1), [], []
    for k in range(1, ORDER + 2):
        at = size >= k
        found, where = np.unique(bits[at] & ((1 << 8 * k) - 1) | k << 56, return_inverse=True)
        out.append(found)
        sums.append(np.bincount(where, counts[at], len(found)).astype(np.int64))
    return np.concatenate(out), np.concatenate(sums)


def grams(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of the byte runs of 1 to ORDER + 1 that end in a coded
    symbol.  A key holds the run's length above its bytes."""
    data, place, starts = _laid_out(words)
    weight = np.repeat(counts, np.diff(np.append(starts, len(data))))
    keys, sums, run = [], [], np.zeros(len(data), np.int64)
    for size in range(1, ORDER + 2):
        at = np.flatnonzero(place >= max(1, size - 1))
        run[size - 1:] |= data[:len(data) - size + 1] << (8 * (size - 1))
        found, where = np.unique(run[at] | size << 56, return_inverse=True)
        keys.append(found)
        sums.append(np.bincount(where, weight[at]).astype(np.int64))
    return np.concatenate(keys), np.concatenate(sums)


class Trie:
    """Contexts with what coding needs, as sorted arrays."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.n = keys[order], counts[order].astype(np.float64)
        size, bits = self.keys >> 56, self.keys & ((1 << 56) - 1)
        self.contexts, of = np.unique((size - 1) << 56 | bits >> 8, return_inverse=True)
        self.of, self.by_key, self.by_context = of, Index(self.keys), Index(self.contexts)
        total = np.bincount(of, self.n, len(self.contexts))
        kinds = np.bincount(of, minlength=len(self.contexts)).astype(np.float64)
        longer = size > 1
        short = _lookup(self.keys, (size - 1) << 56 | bits & ((1 << 8 * np.maximum(size - 1, 0)) - 1))
        covered = np.bincount(of[longer], self.n[short[longer]], len(self.contexts)) if longer.any() else np.zeros(len(self.contexts))
        depth, path = self.contexts >> 56, self.contexts & ((1 << 56) - 1)
        suffix = _lookup(self.contexts, (depth - 1) << 56 | path & ((1 << 8 * np.maximum(depth - 1, 0)) - 1))
        inner = depth > 0
        # as the first context: all symbols; below a longer one: without that one's symbols
        self.all, self.escape = total + kinds, kinds
        self.rest, self.rest_escape = np.zeros(len(kinds)), np.zeros(len(kinds))
        self.rest_escape[inner] = kinds[suffix[inner]] - kinds[inner]
        self.rest[inner] = total[suffix[inner]] - covered[inner] + self.rest_escape[inner]
        root = _lookup(self.contexts, np.array([0]))[0]
        self.unseen = _SYMBOLS - (int(kinds[root]) if root >= 0 else 0)

    def codes(self, most: np.ndarray, path: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after the ``most`` (ORDER at most) last bytes of ``path``."""
        out = np.zeros(len(symbol))
        last = np.full(len(symbol), -1)  # the longer context that was left
        todo = np.arange(len(symbol))
        for depth in range(ORDER, -1, -1):
            at = todo[most[todo] >= depth]
            here = path[at] & ((1 << 8 * depth) - 1)
            g = self.by_key.find((depth + 1) << 56 | here << 8 | symbol[at])
            hit = g >= 0
            c = np.full(len(at), -1)
            c[hit] = self.of[g[hit]]
            c[~hit] = self.by_context.find(here[~hit] | depth << 56)
            known = c >= 0
            at, c, g, hit = at[known], c[known], g[known], hit[known]
            first = last[at] < 0
            whole = np.where(first, self.all[c], self.rest[last[at]])
            escape = np.where(first, self.escape[c], self.rest_escape[last[at]])
            out[at[hit]] += np.log10(self.n[g[hit]] / whole[hit])
            miss = ~hit & (escape > 0)  # nothing left to escape from costs nothing
            out[at[miss]] += np.log10(escape[miss] / whole[miss])
            last[at[~hit]] = c[~hit]
            done = np.zeros(len(out), bool)
            done[at[hit]] = True
            todo = todo[~done[todo]]
        out[todo] -= np.log10(max(1, self.unseen))
        return out

    def log10(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word."""
        keys, starts = longest_grams(words)
        size, bits = keys >> 56, keys & ((1 << 56) - 1)
        out = self.codes(size - 1, bits >> 8, bits & 255)
        return np.add.reduceat(out, starts) if len(starts) else out


def _at_most(counts: DataFrame, most: int) -> int:
    """The smallest power of the fourth root of two, rounded up, such that at
    most ``most`` rows of ``counts`` have an n of that or more."""
    step = F.floor(F.log2("n") * 4).cast("int")
    have = {r[0]: r[1] for r in counts.groupBy(step.alias("step")).count().collect()}  # at most 256 rows
    left, least = most, 1
    for s in range(256, -1, -1):
        left -= have.get(s, 0)
        if left < 0:
            return int(np.ceil(2 ** ((s + 1) / 4)))
    return least


def _counted(texts: pa.Array, times: int) -> pa.Table:
    """(word, n): ``times`` what tokens() makes of ``texts``, and the ends."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts)).flatten().value_counts()
    word, n = found.field(0).cast(pa.binary()), found.field(1)
    some = pc.not_equal(pc.binary_length(word), 0)
    return pa.table({"word": pa.concat_arrays([word.filter(some), pa.array([END], pa.binary())]),
                     "n": np.append(n.filter(some).to_numpy(), len(texts)) * times})


def _summed(counts: list[pa.Table]) -> pa.Table:
    """(word, n) with the sum of n for each word of ``counts``."""
    sums = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"word": sums["word"], "n": sums["n_sum"]})


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over ``texts`` (text, taught): how often each word, or the end
    of a text, stands in taught texts; 0 for words of the others alone."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in slices(batches):
            taught = b.column(1)
            for text, times in ((b.column(0).filter(taught), 1), (b.column(0).filter(pc.invert(taught)), 0)):
                if len(text):
                    held.append(_counted(text, times))
                    size += held[-1].num_rows
            if size > 2 * CACHE:
                held = [_summed(held)]
                size = held[0].num_rows
                if size > CACHE // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _summed(held).to_batches()

    return texts.mapInArrow(trimmed(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _gram_table(counts: DataFrame) -> DataFrame:
    """gram, n (how often training texts hold it), words (how many of the words of
    ``counts`` (word, n) hold it, places counted) of each longest gram."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 50_000):
            words = b.column(0).to_pylist()
            keys, starts = longest_grams(words)
            n = np.repeat(b.column(1).to_numpy(), np.diff(np.append(starts, len(keys))))
            found, where, times = np.unique(keys, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.bincount(where, n, len(found)).astype(np.int64)), pa.array(times)],
                                             ["gram", "n", "words"])

    return (counts.select("word", "n").mapInArrow(trimmed(cut), "gram long, n long, words long")
            .groupBy("gram").agg(F.sum("n").alias("n"), F.sum("words").alias("words")))


def coded_words(counts: DataFrame) -> DataFrame:
    """(word, n, log): ``counts`` (word, n) with each word's log10 probability.

    The trie stays distributed, and every context of the training texts is in
    it.  What a symbol's code length depends on is its longest gram and the
    contexts that are its suffixes.  All that are longer than one byte share
    their last two bytes, so grams are dealt by those, a part of about
    PART_GRAMS grams builds its contexts by itself, and the contexts of one byte and of
    none, 2**16 counts, go to each.  Each distinct gram is coded once; the
    most frequent code lengths are sent to the tasks that add up words, the others are joined."""
    spark = counts.sparkSession
    numbered = saved(counts.select("word", "n").withColumn("wid", F.monotonically_increasing_id()), "numbered")
    table_ = saved(_gram_table(numbered), "grams")
    pairs = table_.where("n > 0").groupBy(F.expr("gram & 65535").alias("pair")).agg(F.sum("n").alias("n")).toArrow()  # 2**16 at most
    pair, n = pairs["pair"].to_numpy(), pairs["n"].to_numpy()
    single, where = np.unique(pair & 255, return_inverse=True)
    low = (np.append(pair | 2 << 56, single | 1 << 56), np.append(n, np.bincount(where, n, len(single)).astype(np.int64)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("words", pa.int64())]))
        if held.num_rows:
            keys, n = held["gram"].to_numpy(), held["n"].to_numpy()
            own, sums = suffix_grams(keys[n > 0], n[n > 0])
            longer = own >> 56 > 2
            trie = Trie(np.append(own[longer], low[0]), np.append(sums[longer], low[1]))
            for at in range(0, len(keys), 100_000):
                part = keys[at:at + 100_000]
                bits = part & ((1 << 56) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(part), held["words"].combine_chunks().slice(at, len(part)),
                                                  pa.array(trie.codes((part >> 56) - 1, bits >> 8, bits & 255))], ["gram", "words", "log"])

    parts = max(1, -(-table_.count() // PART_GRAMS))
    codes = saved(table_.repartition(parts, F.expr("shiftright(gram, 8) & 65535")).mapInArrow(trimmed(code), "gram long, words long, log double"), "codes")
    often = codes.where(F.col("words") >= _at_most(codes.select(F.col("words").alias("n")), CACHED_GRAMS)).toArrow()
    sent = spark.sparkContext.broadcast((often["gram"].to_numpy(), often["log"].to_numpy()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, log = sent.value
        index = Index(held)
        for b in slices(batches, 50_000):
            keys, starts = longest_grams(b.column(0).to_pylist())
            at = index.find(keys)
            sums = np.add.reduceat(np.where(at >= 0, log[at] if len(log) else 0.0, 0.0), starts) if len(starts) else np.zeros(0)
            other = np.flatnonzero(at < 0)
            cuts = np.searchsorted(other, np.append(starts, len(keys)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(sums),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(keys[other], pa.int64()))], ["word", "n", "wid", "log", "rest"])

    some = saved(numbered.mapInArrow(trimmed(add), "word binary, n long, wid long, log double, rest array<long>"), "some")
    sent.destroy()
    rest = (some.select("wid", F.explode("rest").alias("gram")).join(codes.select("gram", F.col("log").alias("more")), "gram")
            .groupBy("wid").agg(F.sum("more").alias("more")))
    return some.drop("rest").join(rest, "wid", "left").select("word", "n", (F.col("log") + F.coalesce("more", F.lit(0.0))).alias("log"))


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def _laid_end_to_end(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words and ends of the texts, where each text starts)."""
    found = [f[0] for f in hashed_texts(raws)]
    sizes = np.array([len(f) + 1 for f in found])
    starts = np.cumsum(sizes) - sizes
    return np.concatenate([x for f in found for x in (f, _END_HASH)]), starts


def _contexts(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the two words before each word of texts laid end to end."""
    one, two = np.zeros_like(h), np.zeros_like(h)
    one[1:], two[2:] = h[:-1], h[:-2]
    one[starts] = two[starts] = 0
    two[starts[starts + 1 < len(h)] + 1] = 0
    with np.errstate(over="ignore"):
        return mixed(mixed(two + np.uint64(1)) + one)


def _pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, key of both) of each word of ``texts``; a key's first CELL_BITS are its cell."""
    h, starts = _laid_end_to_end([_raw(t) for t in texts])
    context = _contexts(h, starts)
    with np.errstate(over="ignore"):
        return context, h, mixed(context + h)


def _add_cells(sums: dict[int, np.ndarray], held: dict[int, list[bytes]], within: int) -> None:
    """Adds to ``sums``, up to MIN_COUNT for each of a part's ``within`` cells, what is ``held`` for
    the part, all of it at once."""
    for i, raws in held.items():
        more = np.bincount(np.frombuffer(b"".join(raws), np.uint16), minlength=within)
        sums[i] = np.minimum(MIN_COUNT, sums.get(i, 0) + more).astype(np.uint8)
    held.clear()


def _repeated(texts: DataFrame) -> np.ndarray:
    """Bitmap of the cells that MIN_COUNT words or more of ``texts`` fall into: no
    word of another cell follows its context as often.  Its size is fixed."""
    parts, within = 1 << CELL_BITS - PART_BITS, 1 << PART_BITS

    def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
        cells = np.sort(np.concatenate(held))
        ends = np.searchsorted(cells, np.arange(parts + 1) << PART_BITS)
        low = (cells & np.uint32(within - 1)).astype(np.uint16)
        used = np.flatnonzero(np.diff(ends))
        return pa.RecordBatch.from_pydict({"part": pa.array(used, pa.int32()), "cells": [low[ends[i]:ends[i + 1]].tobytes() for i in used]})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in slices(batches, 128):
            held.append((_pairs(b.column(0).to_pylist())[2] >> np.uint64(64 - CELL_BITS)).astype(np.uint32))
            size += len(held[-1])
            if size > 4_000_000:
                yield dealt(held)
                held, size = [], 0
        if held:
            yield dealt(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        held: dict[int, list[bytes]] = {}
        size = 0
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(i, []).append(raw)
                size += len(raw)
                if size > 16 << 20:
                    _add_cells(sums, held, within)
                    size = 0
        _add_cells(sums, held, within)
        if sums:
            yield pa.RecordBatch.from_pydict({"part": pa.array(list(sums), pa.int32()), "cells": [
                np.packbits(v >= MIN_COUNT, bitorder="little").tobytes() for v in sums.values()]})

    kind = "part int, cells binary"
    out = np.zeros((parts, within // 8), np.uint8)
    got = texts.mapInArrow(trimmed(deal), kind).repartition("part").mapInArrow(trimmed(add), kind).toArrow()
    for i, raw in zip(got["part"].to_pylist(), got["cells"]):
        out[i] = np.frombuffer(raw.as_buffer(), np.uint8)
    return out.reshape(-1).view("<u8")


def _counted_pairs(context: np.ndarray, word: np.ndarray, key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, sum of ``n``, or how often it stands there) of each pair once, in the order of its ``key``."""
    if not len(key):
        return context, word, np.zeros(0, np.int64)
    order = np.argsort(key)
    for again in (False, True):
        context_, word_, key_ = context[order], word[order], key[order]
        new = np.append(True, (context_[1:] != context_[:-1]) | (word_[1:] != word_[:-1]))
        if again or not (new[1:] & (key_[1:] == key_[:-1])).any():
            break
        order = np.lexsort((word, context, key))  # pairs that share a key
    at = np.flatnonzero(new)
    return context_[at], word_[at], np.diff(np.append(at, len(key))) if n is None else np.add.reduceat(n[order], at)


def phrases(texts: DataFrame) -> DataFrame:
    """Upper contexts of the corpus, all in which a word stands MIN_COUNT times: context
    (hash of the two words before), word (hash of the one that follows most), sure (0 to 3:
    its share of such words), n (how often they follow)."""
    sent = texts.sparkSession.sparkContext.broadcast(_repeated(texts))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = []
            for part in slices(iter([b]), 256):
                context, h, key = _pairs(part.column(0).to_pylist())
                keep = in_bitmap(sent.value, key >> np.uint64(64 - CELL_BITS))
                held.append(np.stack([context[keep], h[keep], key[keep]]))
            if held:
                both = np.concatenate(held, axis=1)
                held.clear()
                context, h, n = _counted_pairs(*both)
                del both
                times = -(-n // 255)  # a larger number is sent as several
                pairs = np.zeros(times.sum(), PAIR)
                pairs["context"], pairs["word"], pairs["n"] = np.repeat(context, times), np.repeat(h, times), 255
                pairs["n"][np.cumsum(times) - 1] = n - 255 * (times - 1)
                with np.errstate(over="ignore"):
                    part = mixed(pairs["context"] + pairs["word"]) >> np.uint64(64 - PAIR_BITS)
                cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict({"part": pa.array(part[cuts].astype(np.int32)), "pairs": pa.array(
                    [pairs[x:y].tobytes() for x, y in zip(cuts, np.append(cuts[1:], len(part)))], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, size = None, [], 0
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i != of and size > 8 << 20:
                    yield counts(held)
                    held, size = [], 0
                of = i
                held.append(raw)
                size += len(raw)
        if held:
            yield counts(held)

    def counts(held: list[bytes]) -> pa.RecordBatch:
        pairs = np.frombuffer(b"".join(held), PAIR)
        context, h = pairs["context"].copy(), pairs["word"].copy()
        with np.errstate(over="ignore"):
            context, h, n = _counted_pairs(context, h, mixed(context + h), pairs["n"].astype(np.int64))
        keep = n >= MIN_COUNT
        return pa.RecordBatch.from_arrays([pa.array(context[keep].view(np.int64)), pa.array(h[keep].view(np.int64)), pa.array(n[keep])],
                                          ["context", "word", "n"])

    # whole parts are counted together, a few at a time
    counted = (texts.mapInArrow(trimmed(report), "part int, pairs binary").repartition("part").sortWithinPartitions("part")
               .mapInArrow(trimmed(count), "context long, word long, n long"))
    top = (counted.groupBy("context").agg(F.min(F.struct((-F.col("n")).alias("less"), "word")).alias("top"), F.sum("n").alias("n"))
           .select("context", "top.word", F.expr("cast(least(3, (-4 * top.less) div n) AS tinyint)").alias("sure"), "n"))
    top = saved(top, "phrases")
    sent.destroy()
    return top


def _equal_together(x: np.ndarray) -> np.ndarray:
    """Places of ``x`` such that equal numbers stand together, by place: one sort of their
    upper bits with the places below, and a slower one where unequal numbers share those bits."""
    bits = np.uint64(len(x).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort(x.view(np.uint64) & ~low | np.arange(len(x), dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    by, packed = x[order], packed >> bits
    return np.argsort(x, kind="stable") if ((packed[1:] == packed[:-1]) & (by[1:] != by[:-1])).any() else order


#: States of an escape: adaptive or of the corpus, how sure, words foreseen before.
STATES = 2 * 4 * 4


class Foresight:
    """Upper contexts: those met earlier in the same text, then the corpus's,
    of which the most frequent are held and the others come with the texts."""

    def __init__(self, index: Index, word: np.ndarray, sure: np.ndarray):
        self.index, self.word, self.sure = index, word.view(np.uint64), sure

    def of(self, h: np.ndarray, starts: np.ndarray, others: tuple[Index, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, states, hashes of the foreseen words) in texts laid end to
        end; ``others`` are their contexts, words and how sure, beside those held."""
        text = np.zeros(len(h), np.int64)
        text[starts[1:]] = 1
        text = np.cumsum(text)
        context = _contexts(h, starts).view(np.int64)
        order = _equal_together(context)  # within a context by place, and so by text
        again = (context[order][1:] == context[order][:-1]) & (text[order][1:] == text[order][:-1])
        state, guess = np.full(len(h), -1), np.zeros(len(h), np.uint64)
        state[order[1:][again]], guess[order[1:][again]] = 0, h[order[:-1][again]]
        for index, word, sure in ((self.index, self.word, self.sure), (others[0], others[1].view(np.uint64), others[2])):
            todo = np.flatnonzero(state < 0)
            place = index.find(context[todo])
            todo, place = todo[place >= 0], place[place >= 0]
            state[todo], guess[todo] = 16 + 4 * sure[place].astype(np.int64), word[place]
        at = np.flatnonzero(state >= 0)
        # words foreseen since the last miss, or since the text began
        k = np.arange(len(at))
        hit = guess[at] == h[at]
        begins = np.append(True, text[at][1:] != text[at][:-1]) if len(at) else hit
        reset = np.where(begins, k, 0)
        reset[1:] = np.maximum(reset[1:], np.where(~hit[:-1], k[1:], 0))
        run = k - np.maximum.accumulate(reset) if len(at) else k
        return at, state[at] + np.minimum(3, run), guess[at]


def other_contexts(texts: DataFrame, corpus: DataFrame) -> DataFrame:
    """(chunk, context, word, sure): the contexts of ``corpus`` that stand in the texts
    of each chunk of ``texts`` (chunk, text)."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmap(corpus.select(F.col("context").alias("key")), ASKED_BITS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, found, size = None, [], 0
        for b in slices(batches, 256):
            chunks = b.column(0).to_numpy()
            cuts = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1]))
            for x, y in zip(cuts, np.append(cuts[1:], len(chunks))):
                if found and (chunks[x] != of or size > 4_000_000):
                    yield asked(of, found)
                    found, size = [], 0
                of = chunks[x]
                need = _contexts(*_laid_end_to_end([_raw(t) for t in b.column(1).slice(x, y - x).to_pylist()]))
                found.append(need[in_bitmap(sent.value, need)])
                size += len(found[-1])
        if found:
            yield asked(of, found)

    def asked(chunk: int, found: list[np.ndarray]) -> pa.RecordBatch:
        contexts = np.unique(np.concatenate(found)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(contexts), chunk, np.int64)), pa.array(contexts)], ["chunk", "context"])

    met = saved(texts.select("chunk", "text").mapInArrow(trimmed(ask), "chunk long, context long")
                .join(corpus.select("context", "word", "sure"), "context").select("chunk", "context", "word", "sure"), "met")
    sent.destroy()
    return met


def escapes(texts: DataFrame, states: int) -> np.ndarray:
    """Share of words foreseen in each state, over ``texts`` (uses: of each state how
    often its word did not follow, and how often it did)."""
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * states, np.int64)
        for b in batches:
            total += b.column(0).flatten().to_numpy().reshape(-1, 2 * states).sum(axis=0)
        return total

    total = dense_sums(texts, count, 2 * states, 2 * states).reshape(states, 2)
    return (total[:, 1] + 0.5) / (total.sum(axis=1) + 1)


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words as texts laid end to end have them."""
    out = np.full(len(words), _END_HASH[0], np.uint64)
    if words:
        out[np.fromiter((w != END for w in words), bool, len(words))] = hashed_words(b" ".join(words))[0]
    return out.view(np.int64)


def scores(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id as text) mod 7 is not 2 (a null
    doc_id is never held out), or from ``training`` (text), as for a
    pretrained model.  A null text counts as empty, which is the end alone;
    rows that repeat are scored, and taught, each; other columns are not
    read; an empty table gives no rows; without training text all bytes are
    equally likely below the adaptive contexts.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    flagged = docs.select(F.struct("doc_id", held_out.alias("held_out")).alias("row"), F.coalesce("text", F.lit("")).alias("text"),
                          (F.lit(training is None) & ~held_out).alias("taught"))
    if training is not None:
        flagged = flagged.unionByName(training.select(F.lit(None).cast(flagged.schema["row"].dataType).alias("row"),
                                                      F.coalesce("text", F.lit("")).alias("text"), F.lit(True).alias("taught")))
    flagged = saved(flagged.withColumn("uid", F.monotonically_increasing_id()), "texts")
    texts, size = flagged.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    flagged = flagged.withColumn("chunk", F.expr(f"uid div {max(1, CHUNK_BYTES * texts // max(1, size))}L"))
    counts = saved(word_counts(flagged.select("text", "taught")), "words")
    known_words = counts.where("n > 0")
    total, kinds = known_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = _at_most(known_words, FREQUENT)
    coded = saved(coded_words(counts), "coded_words")
    frequent = coded.where((F.col("n") >= least) | (F.col("word") == F.lit(END))).toArrow()
    log = frequent["log"].to_numpy()
    held = (np.log10(frequent["n"].to_numpy() + 1.0), log, _left(log), frequent["n"].to_numpy() > 0)
    corpus = phrases(flagged.where("taught").select("text"))
    often = _at_most(corpus, CACHED_PHRASES)
    got = corpus.where(F.col("n") >= often).toArrow()
    tables = [Index(_hashes(frequent["word"].to_pylist())), Index(got["context"].to_numpy())]  # built once
    others = other_contexts(flagged, corpus.where(F.col("n") < often))
    sent = spark.sparkContext.broadcast(([(t.slots, t.place) for t in tables], held, (got["word"].to_numpy(), got["sure"].to_numpy())))

    def score(texts: pa.Table, met: pa.Table) -> pa.Table:
        others = (Index(met["context"].to_numpy()), met["word"].to_numpy(), met["sure"].to_numpy())
        out = pa.Table.from_batches([part for b in texts.to_batches() for part in parts(b, others)])
        give_back()
        return out

    def parts(b: pa.RecordBatch, others: tuple[Index, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        tables, (base_of, log_of, left_of, known_of), corpus = sent.value
        index, upper = Index.again(*tables[0]), Foresight(Index.again(*tables[1]), *corpus)
        text, at = b["text"], 0
        while at < b.num_rows:
            raws, size = [], 0
            while at + len(raws) < b.num_rows and len(raws) < 256 and size < 1 << 20:
                raws.append(_raw(text[at + len(raws)].as_py()))
                size += len(raws[-1])
            found = hashed_texts(raws)
            sizes = np.array([len(f[0]) + 1 for f in found])
            starts = np.cumsum(sizes) - sizes
            h = np.concatenate([x for f in found for x in (f[0], _END_HASH)])
            place = index.find(h.view(np.int64))
            common = place >= 0
            spot, state, guess = upper.of(h, starts, others)
            hit = guess == h[spot]
            # what is foreseen is coded above, the rest below, without the word that was foreseen
            below = np.ones(len(h), bool)
            below[spot[hit]] = False
            log = np.where(common & below, log_of[place], 0.0)
            other = index.find(guess.view(np.int64))
            log[spot] -= np.where(hit | (other < 0), 0.0, left_of[other])
            cut = np.append(starts, len(h))
            uses = np.bincount((np.searchsorted(starts, spot, "right") - 1) * 2 * STATES + 2 * state + hit, minlength=len(raws) * 2 * STATES)
            barred = np.flatnonzero(~hit & (other < 0))
            base, known = np.where(common, base_of[place], 0.0), common & known_of[place]
            rare = np.flatnonzero(~common)
            cuts = np.searchsorted(rare, cut)
            spelt = [raws[k][x:y] for k, (_, first, last) in enumerate(found)
                     for i in (rare[cuts[k]:cuts[k + 1]] - starts[k],) for x, y in zip(first[i].tolist(), last[i].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b["uid"].slice(at, len(raws)), b["taught"].slice(at, len(raws)), b["row"].slice(at, len(raws)), pa.array(sizes, pa.int64()),
                 pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)),
                 pa.array(np.add.reduceat(log, starts)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(raws) + 1) * 2 * STATES, pa.int32()), pa.array(uses, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(spelt, pa.binary())),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(below[rare])),
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(spot[barred], cut), pa.int32()), pa.array(guess[barred].view(np.int64)))],
                ["uid", "taught", "row", "n_tokens", "known", "base", "log", "uses", "rare", "below", "barred"])
            at += len(raws)

    scored = saved(flagged.groupBy("chunk").cogroup(others.groupBy("chunk")).applyInArrow(
        score, f"uid long, taught boolean, row struct<doc_id: {kind}, held_out: boolean>, n_tokens long, known long, base double, log double, "
               "uses array<int>, rare array<binary>, below array<boolean>, barred array<long>"), "scored")
    sent.destroy()
    sure = escapes(scored.where("taught").select("uses"), STATES)
    of_use = F.array(*[F.lit(float(x)) for x in np.stack([np.log10(1 - sure), np.log10(sure)], axis=1).reshape(-1)])
    scored = scored.where("row IS NOT NULL")
    seldom = coded.where(F.col("n") < least)
    # rare words meet their counts and code lengths
    rare = (scored.select("uid", F.explode(F.arrays_zip("rare", "below")).alias("r"))
            .select("uid", F.col("r.rare").alias("word"), F.col("r.below").cast("int").alias("below"))
            .join(seldom, "word")
            .groupBy("uid").agg(F.sum((F.col("n") > 0).cast("long")).alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_base"),
                                F.sum(F.col("below") * F.col("log")).alias("more_log")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(b.column(0).to_pylist())), pa.array(_left(b.column(1).to_numpy()))], ["hash", "left"])

    # and so do rare words that were foreseen and did not follow
    barred = (scored.select("uid", F.explode("barred").alias("hash"))
              .join(seldom.select("word", "log").mapInArrow(trimmed(hashed), "hash long, left double"), "hash")
              .groupBy("uid").agg(F.sum("left").alias("left")))
    unit = float(np.log10(total + kinds + 1))
    upper_log = F.aggregate(F.zip_with("uses", of_use, lambda n, x: n * x), F.lit(0.0), lambda s, x: s + x)
    return (scored.select("uid", "row", "n_tokens", "known", "base", (F.col("log") + upper_log).alias("log"))
            .join(rare, "uid", "left").join(barred, "uid", "left")
            .select("row.doc_id", "row.held_out", "n_tokens",
                    (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * unit).alias("base_score"),
                    (F.col("log") + F.coalesce("more_log", F.lit(0.0)) - F.coalesce("left", F.lit(0.0))).alias("score")))


def _left(log: np.ndarray) -> np.ndarray:
    """log10 of what a word of log10 probability ``log`` leaves to the others."""
    return np.log10(np.maximum(1e-9, 1 - 10.0 ** log))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
