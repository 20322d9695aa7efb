"""Operator 1: packing by cutting stock.

Documents are tokenised once (ids of a public tokenizer plus an end id) and cut
into pieces of at most ``CAPACITY`` ids; only lengths and checksums go on. The
histogram of piece lengths (at most ``CAPACITY`` rows) feeds the cutting-stock
program of ``cutting_stock``. Its whole patterns are assigned by rank: the
pieces of a length class are ranked, and pattern j takes the next ranks of each
class it holds. Ranks of hot classes are made by many tasks.

Defined cases: a null or empty text has only its end id; a document with more
than ``CAPACITY`` ids has full pieces and a rest; repeated rows are packed
each; null doc_ids are kept; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormmart.llm.common import gapless_rank, loaded, staged, tidy
from stormmart.llm.cutting_stock import cutting_plan, length_classes

CAPACITY = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Characters of words whose ids a worker remembers, in each of two generations.
REMEMBERED_CHARS = 5_000_000
#: Characters of text whose words are looked up together.
CHARS_AT_ONCE = 1_000_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long")

# Texts that the tokenizer must see whole: characters that str.split() takes for
# white space and the tokenizer does not, the letter that str.lower() lowers by
# its place, and the opening of the tokenizer's special tokens. So must texts that
# could be composed again once they are lowered (a letter and a mark that only the
# lower case has as one character).
_WHOLE = ("\x1c", "\x1d", "\x1e", "\x1f", "\u03a3", "<|")
# A single comma or stop behind a letter or digit at the end of a word. The mark
# comes first in the pattern: with the look behind first, every character is tried.
_LAST_MARK = re.compile(r"([.,])(?<=[^\W_][.,])(?!\S)")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteCharacters(dict):
    """str.translate table of a byte-level vocabulary: each UTF-8 byte of a
    character as one printable character; bytes without one follow from 256 on."""

    def __init__(self) -> None:
        super().__init__()
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.of_byte = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def __missing__(self, code: int) -> str:
        self[code] = "".join(self.of_byte[b] for b in chr(code).encode())
        return self[code]


class WordTokenizer:
    """ids of whole texts as little-endian 32-bit bytes.

    The tokenizer composes characters (NFC), lowers letters, drops white space,
    never joins text across it and parts letters from punctuation. So a composed
    text's ids are those of its lower-case words, a last comma or stop apart, one
    after the other. Words repeat, and
    their ids are remembered: in two generations, of which the older is dropped
    when the younger is full. Words of letters need no splitting and go straight
    to the tokenizer's merges. Texts for which this does not hold (see
    ``_WHOLE``) go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.byte_characters = ByteCharacters()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        out, odd, merges, pack = [], [], self.merges, struct.pack
        for w in words:
            if w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w)):
                ids = [t.id for t in merges(w if w.isascii() else w.translate(self.byte_characters))]
                out.append(pack("<%dI" % len(ids), *ids))
            else:
                odd.append(len(out))
                out.append(b"")
        for i, ids in zip(odd, self._whole([words[i] for i in odd])):
            out[i] = ids
        return out

    def _learn(self, words: set[str]) -> None:
        if self.chars > REMEMBERED_CHARS:
            self.older, self.known, self.chars = self.known, {}, 0
        known, older = self.known, self.older
        fresh = words.difference(known)
        self.chars += sum(map(len, fresh))
        known.update([(w, older[w]) for w in fresh.intersection(older)] if older else ())
        new = list(fresh.difference(older))
        known.update(zip(new, self._words(new)))

    def forget(self) -> None:
        self.known, self.older, self.chars = {}, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of a few texts; their words are looked up together."""
        split: list[list[str]] = []
        whole: dict[int, bytes] = {}
        for i, text in enumerate(texts):
            composed = text if text.isascii() else unicodedata.normalize("NFC", text)
            lower = composed.lower()
            if any(x in composed for x in _WHOLE) or not (lower.isascii() or unicodedata.is_normalized("NFC", lower)):
                whole[i] = self._whole([text])[0]
                split.append([])
            else:
                split.append(_LAST_MARK.sub(r" \1", lower).split())
        self._learn(set().union(*split))
        ids = self.known.__getitem__
        return [whole.get(i) or b"".join(map(ids, words)) for i, words in enumerate(split)]


def _tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return loaded("tokenizer", path, lambda: WordTokenizer(path))


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens
    and, if asked for, the ids themselves as little-endian 32-bit bytes."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size > CHARS_AT_ONCE:
                yield ids, texts
                ids, texts, size = [], [], 0
        yield ids, texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = _tokenizer(path), struct.pack("<I", END_ID)
        for doc_ids, texts in (g for batch in batches for g in groups(batch)):
            rows: list[tuple] = []
            for doc_id, ids in zip(doc_ids, tokenizer.encode(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total)
                                + ((part,) if with_ids else ()))
            columns = list(zip(*rows)) or [()] * (5 + with_ids)
            types = [pa.int64()] * 5 + [pa.binary()] * with_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names)
        tokenizer.forget()

    return docs.select("doc_id", "text").mapInArrow(tidy(cut, "tokenizer"), schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset. ``pieces`` should be a staged table."""
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    lengths, counts = (np.array(x, dtype=np.int64) for x in
                       (zip(*sorted((r["length"], r["n"]) for r in histogram)) if histogram else ((), ())))
    classes = length_classes(lengths, counts)
    n_classes = int(classes[-1]) + 1 if len(classes) else 0
    room = np.zeros(n_classes, dtype=np.int64)
    demand = np.zeros(n_classes, dtype=np.int64)
    np.maximum.at(room, classes, lengths)
    np.add.at(demand, classes, counts)

    # Both tables are small for any corpus: at most one row per length, and at
    # most a few hundred patterns.
    class_of = spark.createDataFrame(
        [(int(n), int(c)) for n, c in zip(lengths, classes)], "length long, class int")
    taken, sequences, shares = [0] * n_classes, 0, []
    for p in cutting_plan(room, demand, capacity):
        for c, copies in p.items:
            shares.append((c, taken[c], taken[c] + copies * p.times, sequences, copies))
            taken[c] += copies * p.times
        sequences += p.times
    share = spark.createDataFrame(
        shares, "class int, from_rank long, to_rank long, first_sequence long, copies long")

    classed = pieces.join(F.broadcast(class_of), "length")
    ranked = gapless_rank(classed, ["class"], ["doc_id", "start", "ids_crc32"], "rank")
    placed = ranked.join(
        F.broadcast(share.withColumnRenamed("class", "share_class")),
        (F.col("class") == F.col("share_class")) & (F.col("rank") >= F.col("from_rank"))
        & (F.col("rank") < F.col("to_rank")))
    in_sequence = placed.withColumn(
        "sequence_id", F.col("first_sequence")
        + F.floor((F.col("rank") - F.col("from_rank")) / F.col("copies")))
    # A sequence has at most ``capacity`` pieces.
    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank")
    before = F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return in_sequence.select(*pieces.columns, "sequence_id",
                              F.coalesce(before, F.lit(0)).alias("offset"))


def padding_share(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, padded room and the share that is padding.
    A sequence whose length is a power of two needs no padding."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    padded = F.when(F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0, F.col("tokens")).otherwise(capacity)
    sums = used.agg(F.count(F.lit(1)).alias("sequences"), F.sum("tokens").alias("tokens"),
                    F.sum(padded).alias("room"))
    return sums.withColumn("padding", 1 - F.col("tokens") / F.col("room"))


def op1_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(staged(tokenised_pieces(docs, tokenizer_path()), "pieces"))
