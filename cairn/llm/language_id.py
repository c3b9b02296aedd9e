"""Language identification as inference of a mixture.

A document may be written in several languages. Each word has a likelihood under
each language, from byte n-grams of the lower-cased word with its borders (hashed
into a fixed number of cells); expectation-maximisation over the document's words
estimates the proportions of the languages. The set of languages is selected by
penalised likelihood (BIC): the sets tried are the most frequent language alone, the
two most frequent and so on, and one more language has to pay for its parameter. A
background that makes all n-grams alike belongs to every set: words that it explains
better than any language speak for none, so text in a language that was not learned has
a small score. Runs of letters without spaces are cut into units of a few n-grams.

Training counts n-grams over all learned documents, each partition for itself; the
counts (a fixed size per language) are then summed in a tree of small groups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import release
from .common import batches, fold, fresh, named, pick, store, texts

CELLS = 1 << 16
ORDER = 3
SMOOTHING = 0.5
LONG, UNIT = 48, 24  # words of more bytes are cut into units of so many
MOST_UNITS = 200_000  # inferred at a time; a longer text's units are joined
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def _ngrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The cell of the n-gram that begins at each byte of ``text``, and where words
    begin. ``text``: words with one space before, between and after."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint32)
    x = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    x = (x * np.uint32(2654435761)) >> np.uint32(16)
    return x, np.flatnonzero(raw[:-2] == 32)


def _spaced(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().split()) + b" "


def _counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in rows:
        for lang, text in zip(batch["lang"].to_pylist(), texts(batch["text"])):
            mine = counts.setdefault(lang, np.zeros(CELLS))
            spaced = _spaced(text)
            if len(spaced) > 2:
                mine += np.bincount(_ngrams(spaced)[0], minlength=CELLS)
    part = TaskContext.get().partitionId()
    for lang, x in counts.items():
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]), "part": pa.array([part], pa.int64()), "counts": pa.array([x.tobytes()], pa.binary())})


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(CELLS)
    for x in table["counts"]:
        total += np.frombuffer(x.as_py())
    return pa.table({"lang": table["lang"][:1], "part": table["to"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


class Model:
    """Languages, and per n-gram cell the log likelihood under each of them and under
    the background (the last column)."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        p = counts + SMOOTHING
        log_p = np.log(p / p.sum(axis=1, keepdims=True)).T
        self.log_p = np.ascontiguousarray(np.c_[log_p, np.full(CELLS, -np.log(CELLS))].astype(np.float32))

    def word_scores(self, spaced: bytes) -> np.ndarray:
        """Log likelihood of each word or unit (rows) under each language and the
        background (columns); those of very long texts are joined, evenly."""
        out = []
        for at in range(0, len(spaced), 1 << 20):  # bounds the memory of a long text
            cells, starts = _ngrams(spaced[at : at + (1 << 20) + 2])
            if not len(cells):
                continue
            if not len(starts) or starts[0]:
                starts = np.r_[0, starts]  # a word that began in the stretch before
                joined = at > 0
            else:
                joined = False
            long = np.flatnonzero(np.diff(np.r_[starts, len(cells)]) > LONG)
            if len(long):
                ends = np.r_[starts, len(cells)]
                starts = np.unique(np.concatenate([starts, *[np.arange(ends[i], ends[i + 1] - UNIT, UNIT) for i in long]]))
            scores = np.add.reduceat(self.log_p[cells], starts, axis=0).astype(np.float64)
            if joined and out:
                out[-1][-1] += scores[0]
                scores = scores[1:]
            out.append(scores)
        found = np.concatenate(out) if out else np.zeros((0, self.log_p.shape[1]))
        if len(found) > MOST_UNITS:
            found = np.add.reduceat(found, np.arange(0, len(found), -(-len(found) // MOST_UNITS)), axis=0)
        return found


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", fan_in: int = 64) -> Model:
    """A model of every language in ``lang_col`` from all texts; rows with a NULL
    language or text are skipped. The driver gets one array of ``CELLS`` counts per
    language."""
    rows = pick(docs, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    now = store(rows.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(_counted, "lang string, part bigint, counts binary"), "lang-counts")
    while (now.agg(F.max("part")).first()[0] or 0) > 0:
        groups = now.withColumn("to", F.floor(F.col("part") / fan_in)).groupBy("lang", "to")
        after = store(groups.applyInArrow(_summed, "lang string, part bigint, counts binary"), "lang-counts")
        release(now)
        now = after
    found = sorted((x["lang"], bytes(x["counts"])) for x in now.collect())
    return Model([k for k, _ in found], np.array([np.frombuffer(x) for _, x in found]).reshape(len(found), CELLS))


def _em(likelihood: np.ndarray, doc: np.ndarray, starts: np.ndarray, active: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) over the active languages and the log of
    the mixture's likelihood relative to each word's best language."""
    words = np.diff(np.r_[starts, len(doc)])[:, None]
    share = active / active.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = likelihood * share[doc]
        joint /= joint.sum(axis=1, keepdims=True) + 1e-300
        share = np.add.reduceat(joint, starts, axis=0) / words
    total = (likelihood * share[doc]).sum(axis=1)
    return share, np.add.reduceat(np.log(total + 1e-300), starts)


def infer(scores: list[np.ndarray], rounds: int = 8, penalty: float = 1.0) -> list[np.ndarray]:
    """Each document's proportions of the languages and the background (last) after the
    selection of its set of languages; ``scores`` has a matrix words x (languages and
    background) for each (words > 0)."""
    if not scores:
        return []
    lengths = np.array([len(x) for x in scores])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    doc = np.repeat(np.arange(len(scores)), lengths)
    log_p = np.concatenate(scores)
    likelihood = np.exp(np.maximum(log_p - log_p.max(axis=1, keepdims=True), -200))
    n, langs = len(scores), log_p.shape[1] - 1
    share, _ = _em(likelihood, doc, starts, np.ones((n, langs + 1)), rounds)
    rank = np.c_[np.argsort(np.argsort(-share[:, :langs], axis=1, kind="stable"), axis=1), np.full(n, -1)]
    best_bic = np.full(n, np.inf)
    best = np.zeros((n, langs + 1))
    # A language that a tenth of a word is in can't pay for itself.
    sizes = np.maximum((share[:, :langs] * lengths[:, None] > 0.1).sum(axis=1), 1)
    for size in range(1, langs + 1):
        some = np.flatnonzero(sizes >= size)
        if not len(some):
            break
        rows = np.flatnonzero(np.isin(doc, some)) if len(some) < n else np.arange(len(doc))
        at = np.searchsorted(some, doc[rows])
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        mixed, log_l = _em(likelihood[rows], at, begin, (rank[some] < size).astype(float), rounds)
        bic = -2 * log_l + penalty * (size - 1) * np.log(lengths[some] + 1)
        better = bic < best_bic[some]
        best[some[better]], best_bic[some[better]] = mixed[better], bic[better]
    return list(best)


def _inferred(scored: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """``infer`` of some documents at a time, about ``MOST_UNITS`` units."""
    held: list[np.ndarray] = []
    for x in scored:
        if held and sum(map(len, held)) + len(x) > MOST_UNITS:
            yield from infer(held)
            held = []
        held.append(x)
    yield from infer(held)


def _identified(model: Model, column: str, names: list[str]):
    """mapInArrow function that adds the prediction, its share, all shares and the part
    of the text that languages explain."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 200):
            langs: list[str] = []
            shares: list[float] = []
            mixes: list[str | None] = []
            explained: list[float] = []
            found = texts(batch[column])
            told = [bool(model.langs and LETTER.search(x)) for x in found]
            mixed = _inferred(model.word_scores(_spaced(x)) for x, ok in zip(found, told) if ok)
            for ok in told:
                if not ok:
                    langs.append(UNDETERMINED), shares.append(0.0), mixes.append(None), explained.append(0.0)
                    continue
                share = np.minimum(next(mixed)[:-1], 1.0)
                top = int(np.argmax(share))
                langs.append(model.langs[top]), shares.append(float(share[top])), explained.append(float(min(share.sum(), 1.0)))
                mixes.append(",".join(f"{model.langs[i]}:{share[i]:.4f}" for i in np.argsort(-share, kind="stable") if share[i] > 0))
            new = [pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(mixes, pa.string()), pa.array(explained, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return run


NAMES = ("lang_pred", "score", "languages", "explained")


def identify(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str, str, str] = NAMES) -> DataFrame:
    """``docs`` with four columns more: the predicted language (that of the largest
    proportion, the first by name if equal), its proportion, the whole set as
    ``lang:proportion`` by falling proportion, and the sum of the proportions, the rest
    being words that no language explains. A text that is NULL or has no letter is
    ``und`` with 0, a NULL set and 0, and so is every text if no language was learned."""
    extra = [StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), StringType(), DoubleType()))]
    return docs.mapInArrow(_identified(model, text_col, list(names)), StructType([*docs.schema.fields, *extra]))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: Column | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages, explained), one row per row of ``docs``.

    Learns from rows that are not held out (default: crc32 of the id as text modulo 4
    is 2; a NULL id is learned from) and predicts all. No documents, no rows.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.withColumn("held_out", fold(F.col("doc_id"), 4) == 2 if held_out is None else held_out)
    model = train(rows.where(~F.col("held_out")))
    return identify(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", *NAMES)


def accepted(
    docs: DataFrame,
    languages: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least: float = 0.25,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose language was determined and is one of
    ``languages`` (None: any learned one). NULL texts and texts without letters go, and so
    do texts of which the languages explain less than ``least``."""
    names = tuple(fresh(docs, x) for x in ("lang_pred", "lang_share", "lang_mix", "lang_explained"))
    learned = docs.where(fold(named(id_col), 4) != 2)
    marked = identify(docs, train(learned, text_col, lang_col), text_col, names)
    ok = (named(names[0]) != UNDETERMINED) & (named(names[3]) >= least)
    if languages is not None:
        ok = ok & named(names[0]).isin(list(languages))
    return marked.where(ok).select(*map(named, docs.columns))
