"""Phrase collocations from sorted count streams, in the layout of external-memory
language-model estimation.

Counting. Words are 64-bit ids (of language and word). Each task keeps its documents'
windows, the up to four words that start at a position within a piece, as sorted runs:
equal windows are one entry with a count, and a run names its words once. The runs are
cut at common range borders; one part of the key range merges its runs into one stream
in prefix order, where the windows that begin with a phrase lie side by side, so a
pass down the stream counts the phrases of every length at once. Only the first and the
last phrase of a length can go on in a neighbouring part; these are passed on whatever
their count and summed, so a range border may lie anywhere, also inside a frequent phrase.

Scoring. What is left are the counts of phrases found often enough, as one stream
of all lengths. Merge joins of it with itself in prefix order give the count of each
first part of a phrase, in suffix order that of each last part; the same orders give the
largest count of a phrase extended by one word to the right or left. (A phrase's parts
are at least as frequent as itself, so none is missing from the stream.)

Ids are checked: if two words of the corpus share one, all is done anew with other ids.
"""

from __future__ import annotations

import bisect
import collections
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import release
from .common import pick, store

UNKNOWN = "und"
LONGEST = 4
BREAK = b"."
#: Lower-cases A-Z and makes each of ``.,;:!?`` and line ends one mark between pieces.
_TRANSLATED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9)
_STRETCH = 8192  # one window in so many is in the sample that borders are drawn from
_GRAM = [f"g{i}" for i in range(1, LONGEST + 1)]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words, with ``BREAK`` between pieces."""
    return text.translate(_TRANSLATED).replace(BREAK, b" . ").split()


def word_id(lang: bytes, word: bytes, seed: int) -> int:
    """63 bits, never 0 (0 stands for the end of a piece)."""
    return (xxhash.xxh64_intdigest(lang + b"\0" + word, seed) >> 1) or 1


class _Ids:
    """Ids of words, kept for those seen lately."""

    def __init__(self, seed: int, most: int = 400_000):
        self.seed, self.most, self.size, self.known = seed, most, 0, {}

    def __call__(self, lang: bytes, words: list[bytes]) -> np.ndarray:
        if self.size > self.most:
            self.known.clear()
            self.size = 0
        known = self.known.setdefault(lang, {BREAK: 0})
        before = len(known)
        known.update((w, word_id(lang, w, self.seed)) for w in words if w not in known)
        self.size += len(known) - before + 1
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def windows(ids: np.ndarray) -> np.ndarray:
    """One row for each word that has another after it in its piece: the words from
    there on, 0 where the piece has ended."""
    padded = np.r_[ids, np.zeros(LONGEST - 1, ids.dtype)]
    out = np.stack([padded[i : i + len(ids)] for i in range(LONGEST)], axis=1)
    for i in range(1, LONGEST):
        out[out[:, i - 1] == 0, i] = 0
    return out[(out[:, 0] > 0) & (out[:, 1] > 0)]


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    langs = batch["lang"].cast(pa.binary())
    for lang, text in zip(langs, batch["text"].cast(pa.binary())):
        yield (UNKNOWN.encode() if not lang.is_valid else lang.as_py()), text.as_py() or b""


def _words(seed: int, most: int):
    """Counts of words in part of the documents, and the sample of windows."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng([seed, TaskContext.get().partitionId()])
        ids, counts = _Ids(seed), {}

        def counted() -> pa.RecordBatch:
            found = [(lang, w, n) for lang, of in counts.items() for w, n in of.items() if w != BREAK]
            return pa.RecordBatch.from_pydict(
                {
                    "id": pa.array([word_id(lang, w, seed) for lang, w, _ in found], pa.int64()),
                    "lang": pa.array([lang for lang, _, _ in found], pa.binary()).cast(pa.string()),
                    "word": pa.array([w for _, w, _ in found], pa.binary()).cast(pa.string()),
                    "n": pa.array([n for _, _, n in found], pa.int64()),
                    "window": pa.nulls(len(found), pa.binary()),
                }
            )

        held, size = [], 0
        for batch in rows:
            for lang, text in _documents(batch):
                words = words_of(text)
                counts.setdefault(lang, collections.Counter()).update(words)
                held.append(ids(lang, [*words, BREAK]))
                size += len(held[-1])
                if size > 64 * _STRETCH:
                    yield _sampled(held, random)
                    held, size = [], 0
                    if sum(map(len, counts.values())) > most:
                        yield counted()
                        counts.clear()
        yield counted()
        if held:
            yield _sampled(held, random)

    return run


def _sampled(held: list[np.ndarray], random: np.random.Generator) -> pa.RecordBatch:
    found = windows(np.concatenate(held))
    starts = np.arange(0, len(found), _STRETCH)
    at = starts + random.integers(0, np.minimum(_STRETCH, len(found) - starts)) if len(found) else starts
    none = pa.nulls(len(at))
    return pa.RecordBatch.from_pydict(
        {
            "id": pa.array(random.integers(0, 2**62, len(at)), pa.int64()),
            "lang": none.cast(pa.string()),
            "word": none.cast(pa.string()),
            "n": none.cast(pa.int64()),
            "window": pa.array([x.astype(">u8").tobytes() for x in found[at]], pa.binary()),
        }
    )


WORDS = "id bigint, lang string, word string, n bigint, window binary"


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers byte by byte: their high bytes hardly take space."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T).tobytes(), 1)


def _unplaned(x: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(x), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _ordered(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (of 32-bit numbers) in prefix order, equal ones summed."""
    wide = np.uint64(32)
    high = grams[:, 0].astype(np.uint64) << wide | grams[:, 1]
    low = grams[:, 2].astype(np.uint64) << wide | grams[:, 3]
    order = np.lexsort((low, high))
    high, low, counts = high[order], low[order], counts[order]
    starts = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
    return grams[order[starts]], np.add.reduceat(counts, starts)


def _runs(seed: int, borders: list[tuple[int, ...]], run_windows: int):
    """Documents to sorted runs of windows, cut at the borders."""

    def cut(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        names, numbers = np.unique(np.concatenate(held), return_inverse=True)  # 0, a break, is the first
        found = windows(numbers.astype(np.uint32))
        if not len(found):
            return
        grams, counts = _ordered(found, np.ones(len(found), np.int64))
        at = [bisect.bisect_left(range(len(grams)), b, key=lambda i: tuple(names[grams[i]].tolist())) for b in borders]
        for part, (a, b) in enumerate(zip([0, *at], [*at, len(grams)])):
            if b > a:
                own, local = np.unique(grams[a:b], return_inverse=True)
                local = local.reshape(-1, LONGEST).astype(np.uint32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int64()),
                        "names": pa.array([_planes(np.diff(names[own], prepend=np.uint64(0)))], pa.binary()),
                        "grams": pa.array([_planes(np.ascontiguousarray(local.T).reshape(-1))], pa.binary()),
                        "counts": pa.array([_planes(counts[a:b])], pa.binary()),
                    }
                )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = _Ids(seed), [], 0
        for batch in rows:
            for lang, text in _documents(batch):
                held.append(ids(lang, [*words_of(text), BREAK]))
                size += len(held[-1])
                if size >= run_windows:
                    yield from cut(held)
                    held, size = [], 0
        if held:
            yield from cut(held)

    return run


RUNS = "part bigint, names binary, grams binary, counts binary"


def _merged(least: int):
    """The runs of one part of the key range as one stream; the phrases in it that are
    found ``least`` times, or may go on in a neighbouring part."""

    def run(table: pa.Table) -> pa.Table:
        names = [np.cumsum(_unplaned(x.as_py(), "<u8"), dtype=np.uint64) for x in table["names"]]
        known = np.unique(np.concatenate(names))
        grams = np.concatenate(
            [
                np.searchsorted(known, own).astype(np.uint32)[_unplaned(x.as_py(), "<u4").reshape(LONGEST, -1).T]
                for own, x in zip(names, table["grams"])
            ]
        )
        grams, counts = _ordered(grams, np.concatenate([_unplaned(x.as_py(), "<i8") for x in table["counts"]]))
        out, new = [], np.r_[True, (grams[1:, 0] != grams[:-1, 0])]
        zero = len(known) and known[0] == 0
        for order in range(2, LONGEST + 1):
            new |= np.r_[True, grams[1:, order - 1] != grams[:-1, order - 1]]
            starts = np.flatnonzero(new)
            f = np.add.reduceat(counts, starts)
            keep = f >= least
            keep[[0, -1]] = True
            if zero:
                keep &= grams[starts, order - 1] > 0
            found = known[grams[starts[keep]]]
            found[:, order:] = 0
            out.append((found, f[keep]))
        found, f = np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])
        return pa.table({**{g: found[:, i].astype(np.int64) for i, g in enumerate(_GRAM)}, "f": f})

    return run


PHRASES = ", ".join(f"{g} bigint" for g in _GRAM) + ", f bigint"


def _vocabulary(docs: DataFrame, seed: int, most_words: int, most_samples: int) -> tuple[DataFrame, list[bytes]]:
    """The corpus's words with ids and counts (stored), and a sample of windows."""
    found = store(docs.mapInArrow(_words(seed, most_words), WORDS), "phrase-words")
    sample = found.filter("window IS NOT NULL").orderBy("id").limit(most_samples).select("window").collect()
    words = store(found.filter("window IS NULL").groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "phrase-vocabulary")
    release(found)
    return words, sorted(bytes(r[0]) for r in sample)


def phrase_counts(
    docs: DataFrame,
    least: int = 30,
    run_windows: int = 2_000_000,
    part_windows: int = 3_000_000,
    most_words: int = 300_000,
    most_samples: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Of documents (lang, text): the words (id, lang, word, n), all of them, and the
    count stream (g1 to g4, f) of the phrases of 1 to 4 words found ``least`` times, 0
    after a phrase's last word. Both are stored.

    A run and a part of the range are one task's memory and have about ``run_windows`` and
    ``part_windows`` entries; their number grows with the input. ``most_samples`` windows at
    most are drawn to place the borders, which decide on the parts' sizes only."""
    seed = 0
    while True:
        words, sample = _vocabulary(docs, seed, most_words, most_samples)
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            break
        release(words)
        seed += 1
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = max(1, min(-(-total // part_windows), len(sample)))
    drawn = [sample[len(sample) * i // parts] for i in range(1, parts)]
    borders = sorted({tuple(np.frombuffer(x, ">u8").tolist()) for x in drawn})
    runs = docs.mapInArrow(_runs(seed, borders, run_windows), RUNS)
    spread = runs.repartition(len(borders) + 1, "part") if borders else runs
    pieces = spread.groupBy("part").applyInArrow(_merged(least), PHRASES)
    longer = pieces.groupBy(*_GRAM).agg(F.sum("f").alias("f"))
    single = words.select(F.col("id").alias("g1"), *[F.lit(0).cast("bigint").alias(g) for g in _GRAM[1:]], F.col("n").alias("f"))
    return words, store(longer.unionByName(single).filter(F.col("f") >= least), "phrase-counts")


def _length() -> Column:
    return sum(F.when(F.col(g) != 0, 1).otherwise(0) for g in _GRAM)


def _first(k: Column) -> list[Column]:
    """The first ``k`` words of a phrase, as a phrase."""
    return [F.when(k > i, F.col(g)).otherwise(0) for i, g in enumerate(_GRAM)]


def _after(k: Column) -> list[Column]:
    """The words after the first ``k``, as a phrase."""
    return [F.coalesce(*[F.when(k == d, F.col(_GRAM[i + d])) for d in range(1, LONGEST - i)], F.lit(0)) for i in range(LONGEST)]


def _parts(phrases: DataFrame, counts: DataFrame, part, name: str) -> DataFrame:
    """Per phrase and cut ``k`` the count of one part, by a merge join of the stream of
    such parts with the stream of counts."""
    cuts = phrases.select(*_GRAM, F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    wanted = cuts.select(*_GRAM, "k", *[x.cast("bigint").alias(f"p{i}") for i, x in enumerate(part(F.col("k")), 1)])
    have = counts.select(*[F.col(g).alias(f"p{i}") for i, g in enumerate(_GRAM, 1)], F.col("f").alias(name))
    return wanted.join(have.hint("merge"), [f"p{i}" for i in range(1, LONGEST + 1)]).select(*_GRAM, "k", name)


def _extended(phrases: DataFrame) -> DataFrame:
    """Per phrase the largest count of a phrase one word longer that holds it."""
    last = F.col("length") - 1
    longer = phrases.filter("length > 2")
    ends = [longer.select(*[x.alias(g) for x, g in zip(part, _GRAM)], "f") for part in (_first(last), _after(F.lit(1)))]
    return ends[0].unionByName(ends[1]).groupBy(*_GRAM).agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, first: int | None = 2000, cover: int = 80, **sizes: int
) -> DataFrame:
    """Phrases of 2 to 4 words whose parts are found together more than alone.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces and at
    spaces and tabs into words; everything is counted per language. A phrase found ``a``
    times, at least ``least``, scores floor(2000000 a / (l + r)) at the cut where that is lowest
    (then the earliest), ``l`` and ``r`` being the counts of what is before and after
    the cut. Phrases within a longer one that is found in ``cover`` of 100 cases go. Returns
    lang, rank, phrase, a, l, r, n (words of the language), score, score descending: the
    ``first`` ones of each language, or all.

    NULL texts are empty, NULL languages are ``und``; repeated rows count as often as they
    are there; no words give no rows. ``sizes`` are those of ``phrase_counts``."""
    docs = pick(docs, lang=lang, text=text)
    words, counts = phrase_counts(docs, least, **sizes)
    phrases = counts.withColumn("length", _length()).filter("length > 1")
    cut = _parts(phrases, counts, _first, "l").join(_parts(phrases, counts, _after, "r").hint("merge"), [*_GRAM, "k"])
    cuts = cut.groupBy(*_GRAM).agg(F.sort_array(F.collect_list(F.struct("k", "l", "r"))).alias("cuts"))  # three at most
    scored = phrases.join(cuts.hint("merge"), _GRAM).join(_extended(phrases).hint("merge"), _GRAM, "left")
    wide = "decimal(38,0)"
    scored = scored.withColumn(
        "best",
        F.expr(
            f"array_min(transform(cuts, c -> struct((cast(f AS {wide}) * 2000000) div (cast(c.l AS {wide}) + c.r) AS score, "
            "c.k AS k, c.l AS l, c.r AS r)))"
        ),
    )
    left = scored.filter(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("f").cast(wide) * cover))
    # the words' texts: one row a word, then one a phrase again
    named = (
        left.select(*_GRAM, F.posexplode(F.array(*_GRAM)).alias("at", "id"))
        .filter("id != 0")
        .join(words.filter(F.col("n") >= least).select("id", "lang", "word"), "id")
        .groupBy(*_GRAM)
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"), F.min("lang").alias("lang"))
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = (
        left.join(named, _GRAM)
        .select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")
        .join(totals, "lang")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(order).cast("bigint"))
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
