"""Harmonic packing of tokenised documents into sequences.

Class k holds lengths in (C/(k+1), C/k] for a capacity C; a bin of class k takes
exactly k pieces, so any k of them fit and no worker needs to know another's bins.
Documents may be cut, so they are cut where classes end: first into whole sequences
(class 1), then the rest gives up the longest length floor(C/k) that it holds, again
and again, until at most ``C / tail`` tokens are left. Those bins are full but for
fewer than k tokens; only the short tails leave the gaps of their class.

Every worker fills its own bins. What doesn't fill a bin (fewer than k pieces per
class and worker) is numbered over all workers and fills bins of k again; then fewer
than k pieces per class are left, a number that the capacity bounds, and those are
packed first-fit by falling length, a few neighbouring classes at a time.
"""

from __future__ import annotations

import codecs
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, pick, store, texts

PIECE = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "class int, worker int, nth bigint, sequence_id bigint, offset bigint"
)


#: Left-over pieces are packed by ranges of classes that begin here: (1), 4, 16, 128.
FIRST_CLASSES = (4, 16, 128)
RANGES = len(FIRST_CLASSES) + 1

#: Letters of the first 256 code points: in composed form, with lower case of their own.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
#: Byte-level vocabularies write a byte that is no visible character from code 256 on.
BYTE_LETTERS = "".join(chr(b if b in _VISIBLE else 256 + _HIDDEN.index(b)) for b in range(256))


class Words(dict):
    """Token ids of white-space separated words as little-endian uint32 bytes. Words
    repeat, so their ids are kept; the memory is bounded by starting anew."""

    def __init__(self, path: str, special_as_text: bool, most: int = 1_000_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.merges = self.tokenizer.model.tokenize
        self.most = most
        self.stops = {x: self._encoded(x) for x in ".,"}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [x.content.lower().encode() for x in added]

    def ids(self, text: str) -> bytes:
        """The ids of a text. The vocabulary drops white space and no token crosses it,
        so the ids of the words in order are those of the text. It lowers case as well;
        A-Z are lowered beforehand, so that there are fewer words to keep. Special tokens
        are looked for before case is lowered, so a word that may hold one stays as it
        is."""
        raw = text.encode()
        lowered = raw.lower()
        if not any(x in lowered for x in self.special):
            return b"".join(map(self.__getitem__, lowered.split()))
        words = zip(raw.split(), lowered.split())
        return b"".join(self._encoded(w.decode()) if any(x in low for x in self.special) else self[low] for w, low in words)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = self._new(word)
        return found

    def _new(self, word: bytes) -> bytes:
        # A full stop or comma after a letter is a piece of its own, and so is a word of
        # Latin letters alone, which needs no more than the vocabulary's merges: it is
        # composed already, and its lower case is letter by letter.
        plain = word.decode()
        if not word.isalpha():
            if len(plain) > 1 and plain[-1] in self.stops and LATIN.fullmatch(plain, 0, len(plain) - 1):
                return self[word[:-1]] + self.stops[plain[-1]]
            if not LATIN.fullmatch(plain):
                return self._encoded(plain)
            plain = codecs.charmap_decode(plain.lower().encode(), "strict", BYTE_LETTERS)[0]
        found = [t.id for t in self.merges(plain)]
        return struct.pack(f"<{len(found)}I", *found)

    def _encoded(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)


def cuts(length: int, capacity: int, tail: int) -> Iterator[tuple[int, int]]:
    """(length, class) of the pieces that a document of ``length`` tokens gives, in
    order. Each piece of class k is at most capacity // k long."""
    for _ in range(length // capacity):
        yield capacity, 1
    rest = length % capacity
    while rest * tail > capacity:
        length = capacity // -(-capacity // rest)  # the longest floor(C / k) in the rest
        yield length, capacity // length
        rest -= length
    if rest:
        yield rest, capacity // rest


def _pieces(path: str, special_as_text: bool, end_id: int, capacity: int, tail: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, worker = Words(path, special_as_text), TaskContext.get().partitionId()
        waiting: dict[int, list[list]] = {}
        bins = 0
        for batch in batches(rows, 500):
            out: list[list] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
                ids = words.ids(text) + end
                total, start = len(ids) // 4, 0
                for length, k in cuts(total, capacity, tail):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    held = waiting.setdefault(k, [])
                    held.append([doc_id, start, length, crc, total, k, worker, 0, None, None])
                    start += length
                    if len(held) == k:
                        offset = 0
                        for piece in held:
                            piece[8:] = [(worker << 40 | bins) * 4, offset]
                            offset += piece[2]
                        out.extend(held)
                        waiting[k] = []
                        bins += 1
            yield _batch(out, batch.schema.field("doc_id").type)
        left = [p[:7] + [n, None, None] for held in waiting.values() for n, p in enumerate(held)]
        if left:
            yield _batch(left, batch.schema.field("doc_id").type)

    return run


def _batch(pieces: list[list], id_type: pa.DataType) -> pa.RecordBatch:
    names = ["doc_id", *[x.split()[0] for x in PIECE.split(", ")]]
    kinds = [id_type, *[pa.int32() if x.endswith(" int") else pa.int64() for x in PIECE.split(", ")]]
    columns = list(zip(*pieces)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names)


def _first_fit(capacity: int):
    """Packs one group of left-over pieces; ``RANGES`` groups at most, so bins are told
    apart by bin and group."""

    def run(left: pa.Table) -> pa.Table:
        group = left["group"][0].as_py()
        lengths = left["length"].to_pylist()
        room: list[int] = []
        bins, offsets = [0] * len(lengths), [0] * len(lengths)
        keys = list(zip(left["class"].to_pylist(), left["number"].to_pylist()))
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], keys[i])):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if at == len(room):
                room.append(capacity)
            bins[i], offsets[i] = at, capacity - room[at]
            room[at] -= lengths[i]
        kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return left.select(kept).append_column("sequence_id", pa.array([(b * RANGES + group) * 4 + 2 for b in bins], pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    tail: int = 16,
    special_as_text: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per
    piece of a document.

    A document is its text's token ids, then ``end_id``; NULL or empty text is that one
    id. Pieces cover every id once; those of a sequence lie gapless from offset 0 and
    hold at most ``capacity`` ids. sequence_id is unique, not gapless. Rows with one
    doc_id, or none, are packed as documents of their own. No documents, no rows.
    """
    narrow = pick(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = store(narrow.mapInArrow(_pieces(tokenizer, special_as_text, end_id, capacity, tail), f"doc_id {kind}, {PIECE}"), "pieces")

    # What the workers could not fill: number it per class over all workers.
    left = pieces.where("sequence_id is null").drop("sequence_id", "offset")
    held = left.groupBy("class", "worker").agg((F.max("nth") + 1).alias("n"))
    by_class = Window.partitionBy("class")
    held = held.select(
        "class",
        "worker",
        (F.sum("n").over(by_class.orderBy("worker").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
        F.sum("n").over(by_class).alias("all"),
    )
    left = left.join(held, ["class", "worker"]).withColumn("number", F.col("before") + F.col("nth"))
    left = store(left.withColumn("bin", F.floor(F.col("number") / F.col("class"))), "left-over-pieces")
    in_bin = Window.partitionBy("class", "bin").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    fills = (F.col("bin") + 1) * F.col("class") <= F.col("all")
    filled = left.where(fills).select(
        *columns[:5],
        ((F.col("bin") * (capacity + 1) + F.col("class")) * 4 + 1).alias("sequence_id"),
        (F.sum("length").over(in_bin) - F.col("length")).alias("offset"),
    )
    # Fewer than k pieces of each class k; the capacity has few classes, since a class is
    # capacity // length: some 2 * sqrt(capacity), so a group has a bounded number of rows.
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    group = sum((F.when(F.col("class") >= first, 1).otherwise(0) for first in FIRST_CLASSES), F.lit(0))
    rest = left.where(~fills).withColumn("group", group).groupBy("group").applyInArrow(lambda t: _first_fit(capacity)(t), schema)
    return pieces.where("sequence_id is not null").select(*columns).union(filled.select(*columns)).union(rest.select(*columns))
