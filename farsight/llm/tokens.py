"""Operator 7 -- token counts by a map-side two-tier lookup.

Tier one is a compact hash table of frequent pre-token lengths, sent to every
worker; its size has a fixed bound.  Tier two is a cache in each worker:
what misses tier one is encoded once in a batch and kept.  No pre-token is
shuffled for the counts.

The unit is a *stretch*: a text is cut before every single space that stands
between two characters that are not white space.  The byte-level pattern
always starts a new pre-token there (a space joins what follows it), so
stretches are encoded apart with the same tokens as the whole text, and a
special token's string, which has no space in it, is never cut.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.util import table, trimmed

#: Tier one: at most so many stretches, each of at most so many characters.
FREQUENT, FREQUENT_CHARS = 40_000, 64
#: Rows, about, from which tier one is filled.  They decide speed alone, never a count.
SAMPLE_ROWS = 4_000
#: Tier two is emptied when it holds so many stretches.
CACHE = 400_000


def stretches(text: str) -> list[str]:
    """Cut ``text`` before each single space between non-spaces."""
    parts = text.split(" ")
    if len(parts) == 1:
        return parts
    out = [parts[0]]
    for p in parts[1:]:
        before = out[-1]
        if p and before and not p[0].isspace() and not before[-1].isspace():
            out.append(" " + p)
        else:
            out[-1] = before + " " + p
    return out


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


class Lengths(dict):
    """stretch -> number of tokens: tier one, then what this worker met."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.tokenizer, self.frequent = _tokenizer(path), frequent

    def learn(self, missing: list[str]) -> None:
        if len(self) + len(missing) > CACHE:
            self.clear()
            self.update(self.frequent)
        for at in range(0, len(missing), 4096):
            part = missing[at:at + 4096]
            self.update(zip(part, self.of(part)))

    def of(self, part: list[str]) -> list[int]:
        got = self.tokenizer.encode_batch_fast(part, add_special_tokens=False) if part else []
        return [len(e) for e in got]

    def count(self, texts: list[str]) -> list[int]:
        out, group, size = [], [], 0
        for t in texts:
            group.append(stretches(t))
            size += len(group[-1])
            if size > 200_000:
                out += self._count(group)
                group, size = [], 0
        return out + self._count(group)

    def _count(self, group: list[list[str]]) -> list[int]:
        missing: set[str] = set()
        for g in group:
            missing.update(g)
        missing.difference_update(self)
        if missing:
            need = None
            if len(self) + len(missing) > CACHE:  # the cache is emptied: what this group needs is learnt anew
                need = set().union(*group) - self.frequent.keys()
            self.learn(list(need if need is not None else missing))
        get = self.__getitem__
        return [sum(map(get, g)) for g in group]


def frequent_lengths(texts: DataFrame, path: str) -> dict[str, int]:
    """Tier one from a bounded sample of ``texts`` (column text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(s for s in stretches(t) if len(s) <= FREQUENT_CHARS)
        top = seen.most_common(FREQUENT)
        yield pa.RecordBatch.from_pydict({"s": [s for s, _ in top], "n": [n for _, n in top]})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path, {})
        for b in batches:
            part = b.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"s": part, "k": lengths.of(part)})

    share = SAMPLE_ROWS / max(1, texts.count())
    some = texts if share >= 1 else texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    top = (some.mapInArrow(trimmed(count), "s string, n long")
           .groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(FREQUENT).select("s"))
    got = top.mapInArrow(trimmed(encode), "s string, k long").toArrow()
    return dict(zip(got["s"].to_pylist(), got["k"].to_pylist()))


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, n_bytes (UTF-8), n_tokens,
    over_limit (n_tokens > ``limit``).

    A null text counts as empty (0 bytes, 0 tokens); null and repeated keys
    stay rows of their own; other columns are not read; an empty table gives
    no rows.  ``path`` names a byte-level BPE tokenizer.json that every
    executor can read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(rows.select("text"), path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(path, sent.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n = lengths.count(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    sized = rows.select(F.struct("doc_id", F.octet_length("text").cast("long").alias("n_bytes")).alias("doc_id"), "text")
    kind = sized.schema["doc_id"].dataType.simpleString()
    return (sized.mapInArrow(trimmed(count), f"doc_id {kind}, n_tokens long")
            .select("doc_id.doc_id", "doc_id.n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
