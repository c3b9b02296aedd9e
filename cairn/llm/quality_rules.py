"""Quality rules: a decision list learned by sequential covering.

Texts are counted once (words, symbols, repeated lines and words, capitals, ...). On the
labelled documents a list of rules is learned, each a conjunction of thresholds on rates
of these counts: a rule grows on two thirds of the rows by the condition that
gains most information about bad documents, is pruned on the other third by dropping
its last conditions as long as that makes it more precise, and takes the documents
it covers out of the rows that the next rule is learned from. Learning ends when no
further rule is precise enough. The list becomes one ordered Spark conditional
expression: the number of the first rule that holds, or NULL, and such documents stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, store, utf8

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_WORD_CHARACTERS = SPACE + bytes(range(0x80, 0xC0))  # white space, and UTF-8 bytes that begin no character
SYMBOLS = b"#*$%&|<>"
SETS = {
    "n_upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "n_letters": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "n_digits": b"0123456789",
    "n_exclamations": b"!",
    "n_stops": b".,;:?",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", *SETS]
#: Rates that conditions are made of: counts by counts.
RATES = {
    "word length": ("word_chars", "n_words"),
    "symbols per word": ("n_symbols", "n_words"),
    "share of repeated lines": ("n_dup_lines", "n_lines"),
    "share of repeated words": ("n_repeat_words", "n_words"),
    "words per line": ("n_words", "n_lines"),
    "share of distinct words": ("n_distinct", "n_words"),
    "share of capitals": ("n_upper", "n_letters"),
    "digits per character": ("n_digits", "word_chars"),
    "exclamation marks per word": ("n_exclamations", "n_words"),
    "stops per word": ("n_stops", "n_words"),
    "words": ("n_words", None),
}


def repeated_words(numbers: np.ndarray, distinct: int) -> int:
    """How many words lie in a window of three that is there twice or more."""
    if len(numbers) < 4:
        return 0
    pairs = numbers[:-2] * distinct + numbers[1:-1]
    if distinct >= 2**21:  # three numbers would not fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs * distinct + numbers[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = order[np.r_[same, False] | np.r_[False, same]]
    inside = np.zeros(len(numbers), bool)
    for i in range(3):
        inside[twice + i] = True
    return int(inside.sum())


def counts(text: bytes) -> list[int]:
    """The ``COUNTS`` of one text, in UTF-8."""
    words = text.split()
    numbers: dict[bytes, int] = {}
    for w in words:
        numbers.setdefault(w, len(numbers))
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return [
        len(words),
        len(text.translate(None, NOT_WORD_CHARACTERS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), len(numbers)),
        len(lines),
        len(numbers),
        *[len(text) - len(text.translate(None, of)) for of in SETS.values()],
    ]


def text_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the ``COUNTS`` of every text. A NULL text is empty; all counts are 0 then."""
    docs = pick(docs, doc_id=doc_id, text=text)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = np.array([counts(x) for x in utf8(batch["text"])], np.int64).reshape(-1, len(COUNTS))
            columns = {c: pa.array(found[:, i]) for i, c in enumerate(COUNTS)}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **columns})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} bigint" for c in COUNTS]]))


def rate(name: str) -> Column:
    above, below = RATES[name]
    return F.col(above).cast("double") / (F.greatest(F.col(below), F.lit(1)) if below else F.lit(1))


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """A rate at least (or, if not ``above``, at most) ``bound``."""

    name: str
    above: bool
    bound: float

    def holds(self, rates: dict[str, np.ndarray]) -> np.ndarray:
        return rates[self.name] >= self.bound if self.above else rates[self.name] <= self.bound

    def column(self) -> Column:
        return rate(self.name) >= self.bound if self.above else rate(self.name) <= self.bound

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<='} {self.bound:.6g}"


@dataclass(frozen=True)
class Rule:
    """Documents for which all conditions hold are bad."""

    conditions: tuple[Condition, ...]

    def holds(self, rates: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(rates.values()))), bool)
        for c in self.conditions:
            out &= c.holds(rates)
        return out

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out &= c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _gain(good_now: np.ndarray, bad_now: np.ndarray, good: int, bad: int) -> np.ndarray:
    """Information gained about the bad rows that stay covered."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = bad_now * (np.log2(bad_now / (bad_now + good_now)) - np.log2(bad / (bad + good)))
    return np.where(bad_now > 0, gain, -np.inf)


def _best_condition(rates: dict[str, np.ndarray], is_bad: np.ndarray) -> tuple[float, Condition | None]:
    bad, good = int(is_bad.sum()), int((~is_bad).sum())
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, values in rates.items():
        order = np.argsort(values, kind="stable")
        sorted_values, bad_below = values[order], np.cumsum(is_bad[order])
        borders = np.flatnonzero(np.diff(sorted_values) > 0)  # between two different values
        if not len(borders):
            continue
        bad_left, n_left = bad_below[borders], borders + 1
        for above in (False, True):
            bad_now = bad - bad_left if above else bad_left
            n_now = len(values) - n_left if above else n_left
            gain = _gain(n_now - bad_now, bad_now, good, bad)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                bound = (sorted_values[borders[i]] + sorted_values[borders[i] + 1]) / 2
                best = (float(gain[i]), Condition(name, above, float(bound)))
    return best


def _some(rates: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {name: values[rows] for name, values in rates.items()}


def grow(rates: dict[str, np.ndarray], is_bad: np.ndarray, most: int) -> Rule:
    """Conditions are added while they gain information and good rows are covered."""
    rows, conditions = np.arange(len(is_bad)), []
    while len(conditions) < most and not is_bad[rows].all():
        _, found = _best_condition(_some(rates, rows), is_bad[rows])
        if found is None:
            break
        conditions.append(found)
        rows = rows[found.holds(_some(rates, rows))]
    return Rule(tuple(conditions))


def prune(rule: Rule, rates: dict[str, np.ndarray], is_bad: np.ndarray) -> tuple[Rule, float, int]:
    """The rule without those of its last conditions that do not make it more precise on
    these rows (rates smoothed by one row of each kind), its precision there, and the bad
    rows it covers."""
    best: tuple[float, int, Rule] | None = None
    for n in range(1, len(rule.conditions) + 1):
        short = Rule(rule.conditions[:n])
        covered = short.holds(rates)
        bad, good = int((covered & is_bad).sum()), int((covered & ~is_bad).sum())
        precision = (bad + 1) / (bad + good + 2)
        if best is None or precision > best[0]:
            best = (precision, bad, short)
    return best[2], best[0], best[1]


def learn_rules(
    rates: dict[str, np.ndarray], is_bad: np.ndarray, for_pruning: np.ndarray, precision: float = 0.9, most_conditions: int = 6, most_rules: int = 32
) -> list[Rule]:
    """Sequential covering. A rule must have ``precision`` on the pruning rows and cover
    bad ones among them; the first that does not ends the list."""
    rules: list[Rule] = []
    left = np.arange(len(is_bad))
    while len(rules) < most_rules and is_bad[left].any():
        a, b = left[~for_pruning[left]], left[for_pruning[left]]
        if not is_bad[a].any() or is_bad[a].all():
            break
        rule = grow(_some(rates, a), is_bad[a], most_conditions)
        if not rule.conditions:
            break
        rule, reached, covered = prune(rule, _some(rates, b), is_bad[b])
        if reached < precision or not covered:
            break
        rules.append(rule)
        left = left[~rule.holds(_some(rates, left))]
    return rules


def learn(counted: DataFrame, labels: DataFrame, doc_id: str = "doc_id", good: str = "quality", max_labelled: int = 30_000, **options) -> list[Rule]:
    """The rules that tell documents with ``good`` = 0 from those with another value.

    ``counted`` is what ``text_counts`` returns. Learned from at most ``max_labelled``
    label rows, those of smallest id hashes, whose documents pass ``base_failed``. NULL
    ids and labels take no part; a repeated label or document counts as often as it is
    there. No rules come of no labels, or labels of one kind."""
    marked = pick(labels, doc_id=doc_id, good=good).dropna()
    spread = F.xxhash64(F.col("doc_id").cast("string"))
    sample = marked.withColumn("_h", spread).orderBy("_h", "doc_id", "good").limit(max_labelled)
    columns = [rate(name).alias(f"r{i}") for i, name in enumerate(RATES)]
    rows = (
        counted.filter(~base_failed())
        .join(F.broadcast(sample), "doc_id")  # ``max_labelled`` rows at most
        .select((F.col("good") == 0).alias("bad"), (F.pmod("_h", F.lit(3)) == 0).alias("prune"), "_h", *columns)
        .orderBy("_h", "bad", *[f"r{i}" for i in range(len(RATES))])
        .limit(2 * max_labelled)
        .toArrow()
    )
    rates = {name: np.asarray(rows[f"r{i}"], np.float64) for i, name in enumerate(RATES)}
    flags = [np.asarray(rows[c].to_pylist(), bool) for c in ("bad", "prune")]
    return learn_rules(rates, *flags, **options)


def first_rule(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, or NULL."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(rule.column(), i) if out is None else out.when(rule.column(), i)
    return F.lit(None).cast("int") if out is None else out


def judged(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds base_failed, rule (the first that holds, or NULL) and kept."""
    found = counted.withColumns({"base_failed": base_failed(), "rule": first_rule(rules)})
    return found.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, its counts, base_failed, rule and kept.

    A NULL text is empty and fails the base rule, as any text of fewer than 50 words does.
    Repeated rows, and rows with a NULL id, are judged each for itself. Texts are counted
    whole, one at a time; the counts are stored once, for learning and judging."""
    counted = store(text_counts(docs, doc_id, text), "quality-counts")
    out = judged(counted, learn(counted, labels, **options))
    return out.select(
        F.col("doc_id").alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )

