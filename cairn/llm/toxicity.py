"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic
regression.

The lexicon is a short fixed seed list and what labelled documents teach: words and
word beginnings that are in far more toxic than clean documents, each with a weight,
the logarithm of the odds. Features of a text, all over the whole of it: densities
and counts of lexicon words, how many are near a second-person word, rates of
capitals, punctuation and digits, and of words that are disguised (l0ser, st*pid).

Learning reads a bounded sample of the labelled documents (``max_labelled``, those of
the smallest hashes, so a stable choice); scoring reads every text in one pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import evidence, fold, pick, store, texts

# Words of abuse and words of address.
SEEDS = frozenset("idiot idiots moron morons loser losers stupid scum trash pathetic worthless disgusting clown dumb imbecile".split())
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner euch ihr tu te toi ton ta tes vous votre vos "
    "tú ti usted ustedes vosotros vosotras".split()
)
DISGUISE = str.maketrans("013457@$", "oieastas")
MASKED = re.compile(r"[^\W\d_][0-9@$*!.#][^\W_]")
SHOUTED = re.compile(r"[!?]{2,}")
EDGE = ".,;:!?\"'()[]{}<>|*#%&$-_~/\\+="
PREFIXES = (4, 5, 6)
FEATURES = (
    "log_words", "hits", "hit_rate", "weight_sum", "weight_max", "weight_rate", "kinds", "seed_hits",
    "seed_rate", "densest", "person_rate", "near_person", "masked_rate", "masked_hits", "capital_rate",
    "digit_rate", "punctuation_rate", "exclaim_rate", "question_rate", "shouted_rate", "word_length",
)
CHARACTERS = {
    "capital_rate": range(65, 91),
    "digit_rate": range(48, 58),
    "punctuation_rate": [c for c in range(33, 127) if not chr(c).isalnum()],
    "exclaim_rate": [33],
    "question_rate": [63],
}


def forms(word: str) -> list[str]:
    """What the lexicon may know of a lower-case word: itself and its beginnings."""
    core = word.strip(EDGE)
    return [core, *[core[:n] + "*" for n in PREFIXES if len(core) > n]] if core else []


def _lexicon_counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in rows:
        for toxic, text in zip(batch["toxic"].to_pylist(), texts(batch["text"])):
            seen[toxic].update({f for w in set(text.lower().split()) for f in forms(w)})
    keys = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_pydict(
        {
            "form": pa.array(keys, pa.string()),
            "toxic": pa.array([seen[1][k] for k in keys], pa.int64()),
            "clean": pa.array([seen[0][k] for k in keys], pa.int64()),
        }
    )


def learn_lexicon(sample: DataFrame, size: int = 4000, least: int = 3) -> dict[str, float]:
    """Weights of the ``size`` forms that tell toxic documents best, from columns text
    and toxic; a form must be in ``least`` toxic ones."""
    docs = {int(r["toxic"]): int(r["count"]) for r in sample.groupBy("toxic").count().collect()}
    if not docs.get(1) or not docs.get(0):
        return {}
    counts = sample.select("toxic", "text").mapInArrow(_lexicon_counts, "form string, toxic bigint, clean bigint")
    counts = counts.groupBy("form").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(F.col("t") >= least)
    odds = F.log(((F.col("t") + 0.5) / (docs[1] + 1.0)) / ((F.col("c") + 0.5) / (docs[0] + 1.0)))
    told = counts.select("form", odds.alias("w"), evidence(F.col("t"), F.col("c"), docs[1], docs[0]).alias("z"))
    told = told.where((F.col("w") > 1.5) & (F.col("z") > 20))
    return {r["form"]: float(r["w"]) for r in told.orderBy(F.desc("z"), "form").limit(size).collect()}


class Features:
    """Turns texts into rows of ``FEATURES``; remembers the weights of words it met."""

    def __init__(self, lexicon: dict[str, float], most: int = 500_000):
        self.lexicon, self.most = lexicon, most
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The lexicon's weight of a word, 0 if it has none; seeds count as 5."""
        plain = word.strip(EDGE)
        found = [self.lexicon.get(f, 0.0) for f in forms(word)]
        if plain in SEEDS:
            found.append(5.0)
        return max(found, default=0.0)

    def disguised(self, word: str) -> bool:
        """Whether a word that is no hit becomes a seed when its disguise is off."""
        core = word.strip(EDGE.replace("$", "").replace("*", ""))
        if core.isalpha() or not MASKED.search(core):
            return False
        if core.translate(DISGUISE) in SEEDS or re.sub(r"[^\w]|_", "", core) in SEEDS:
            return True
        return "*" in core and any(len(s) == len(core) and all(a in ("*", b) for a, b in zip(core, s)) for s in SEEDS)

    def row(self, text: str) -> list[float]:
        words = text.lower().split()
        n = max(1, len(words))
        if len(self.known) > self.most:
            self.known.clear()
        for w in words:
            if w not in self.known:
                self.known[w] = self.weight(w)
        weights = list(map(self.known.__getitem__, words))
        hits = [i for i, w in enumerate(weights) if w]
        raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
        size = max(1, int(raw.sum()))
        masked = MASKED.findall(text) if int(raw[48:58].sum() + raw[33] + raw[35] + raw[36] + raw[42] + raw[46] + raw[64]) else []
        masked_hits = sum(map(self.disguised, {w for w in words if not w.isalpha()})) if masked else 0
        people = sum(w.strip(EDGE) in SECOND_PERSON for w in words) if hits else 0
        near = sum(any(w.strip(EDGE) in SECOND_PERSON for w in words[max(0, i - 5) : i + 6]) for i in hits)
        densest, left = 0, 0
        for right, i in enumerate(hits):  # most hits among 50 words
            while hits[left] <= i - 50:
                left += 1
            densest = max(densest, right - left + 1)
        hit_words = {words[i].strip(EDGE) for i in hits}
        seeds = sum(words[i].strip(EDGE) in SEEDS for i in hits)
        total = sum(weights[i] for i in hits)
        return [
            math.log1p(len(words)), len(hits), len(hits) / n, total, max((weights[i] for i in hits), default=0.0), total / n,
            len(hit_words), seeds, seeds / n, densest, people / n, near, len(masked) / n, masked_hits,
            *[int(raw[list(CHARACTERS[k])].sum()) / size for k in CHARACTERS],
            len(SHOUTED.findall(text)) / n, len(text) / n,
        ]


def features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``rows`` without ``text`` and with a double column for each of ``FEATURES``."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Features(lexicon)
        for batch in batches:
            found = np.array([table.row(x) for x in texts(batch["text"])], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *[pa.array(np.ascontiguousarray(x)) for x in found.T]], [*kept, *FEATURES])

    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept], *[f"{x} double" for x in FEATURES]])
    return rows.mapInArrow(run, schema)


class Model:
    """A lexicon, trees over the features, and the calibration of their probability."""

    def __init__(self, lexicon: dict[str, float], trees=None, calibration=None, share: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` without ``text`` and with ``score``: the calibrated probability. A
        thousandth of the trees' own probability is mixed in, which keeps their order
        where the calibration is flat. Without trees: the share of toxic labels."""
        kept = [c for c in rows.columns if c != "text"]
        if self.trees is None:
            return rows.select(*kept, F.lit(self.share).alias("score"))
        found = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(rows, self.lexicon))
        scored = self.trees.transform(found).select(*kept, vector_to_array("probability")[1].alias("raw"))
        if self.calibration is None:
            return scored.withColumnRenamed("raw", "score")
        calibrated = self.calibration.transform(scored)
        return calibrated.select(*kept, (0.999 * F.col("calibrated") + 0.001 * F.col("raw")).alias("score"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    usable: Column | None = None,
    max_labelled: int = 30_000,
    trees: int = 30,
    depth: int = 4,
) -> Model:
    """A model from labelled documents whose key passes ``usable`` (over ``doc_id``;
    default: crc32 of the id as text modulo 5 is not 0).

    At most ``max_labelled`` labels are used, those of the smallest hash of the id; of
    several labels of one document the largest counts; NULL ids, labels and texts are
    skipped. Three disjoint folds of the sample, by a hash of the id: three eighths give
    the lexicon, three eighths grow the trees and a quarter calibrates, so neither trees
    nor calibration see features that know their labels. A fold of one class is
    replaced by the whole sample. With labels of one class only, or none, the model is
    their share of toxic ones (none: 0).
    """
    usable = fold(F.col("doc_id"), 5) != 0 if usable is None else usable
    marks = pick(labels, doc_id=label_id, toxic=label_col).where("doc_id is not null and toxic is not null").where(usable)
    marks = marks.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    # A bounded sample (max_labelled rows of two numbers), so it may be broadcast.
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = pick(docs, doc_id=id_col, text=text_col).where("text is not null").join(F.broadcast(marks), "doc_id")
    sample = store(rows, "toxic-sample")
    counts = {int(r["toxic"]): int(r["count"]) for r in sample.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Model({}, share=float(bool(counts.get(1))))
    fold_of = F.pmod(F.xxhash64("doc_id"), F.lit(8))
    of_words, of_trees = sample.where(fold_of.isin(1, 2, 3)), fold_of.isin(5, 6, 7)
    lexicon = learn_lexicon(of_words if of_words.select("toxic").distinct().count() == 2 else sample)
    found = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features(sample, lexicon))
    found = store(found.select("features", F.col("toxic").cast("double").alias("label"), of_trees.alias("grows"), fold_of.isin(0, 4).alias("calibrates")), "toxic-features")
    grown = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, minInstancesPerNode=5, maxBins=64, seed=42, checkpointInterval=-1)
    fit_rows = found.where("grows")
    if fit_rows.select("label").distinct().count() < 2:
        fit_rows = found
    model = grown.fit(fit_rows.coalesce(4))
    raw = model.transform(found.where("calibrates")).select(vector_to_array("probability")[1].alias("raw"), "label")
    steps = None
    if not raw.isEmpty():
        steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(raw)
    return Model(lexicon, model, steps)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``; NULL and empty
    texts are scored as texts without words. held_out: crc32 of the id as text modulo 5
    is 0. No documents, no rows."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    scored = model.score(rows.select("doc_id", "held_out", "text"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
