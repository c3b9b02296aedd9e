"""Mixing documents to target weights by soft membership.

A classifier learned from a labelled table gives every document a posterior over the
domains, and a document counts towards each domain with its tokens times its
posterior. Nonnegative rates per document (how many times it enters the mix) are
fitted so that the expected tokens of the domains match the targets: projected
gradient descent on the least-squares distance, weighted by the domains' Gram matrix
so that a step needs no tuning. A step sends one total per domain to the driver, and
every row updates its own rate; rates are stored every few steps.

The classifier is a decision table. Words that mark a domain are learned from the
labelled documents; a text's cell is made of how many such words it has for each
domain and of coarse measures of repetition, capitals and symbols; and the posterior
of a cell is its labelled documents' domains, smoothed towards the whole. Everything
is DataFrame and SQL functions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import release
from .common import WHITESPACE, evidence, fresh, named, pick, store

# Inside a character class of a regular expression.
SYMBOLS = "!#$%&*|@^~<>{}\\[\\]="
CAPITALS = "A-Z"


def words_of(text: Column) -> Column:
    """The lower-case words of a text; none for NULL or empty."""
    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r"))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, WHITESPACE))


def _measured(docs: DataFrame) -> DataFrame:
    """Adds the distinct words and the coarse measures of ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))

    def rate(kept: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{kept}]+", "")) / size

    words = docs.withColumns({"_words": words_of(F.col("text")), "_capitals": rate(CAPITALS), "_symbols": rate(SYMBOLS)})
    words = words.withColumn("n_tokens", F.size("_words").cast("long")).withColumn("_distinct", F.array_distinct("_words"))
    repeated = 1 - F.size("_distinct") / F.greatest(F.col("n_tokens"), F.lit(1))
    return words.withColumn("_repeated", repeated).drop("_words", "text")


def _level(x: Column, *edges: float) -> Column:
    return sum((F.when(x >= e, 1).otherwise(0) for e in edges), F.lit(0))


class Classifier:
    """Marker words by domain, and posteriors by cell (lists ordered as ``domains``)."""

    def __init__(self, domains: list[str], markers: dict[str, list[str]], cells: dict[int, list[float]], prior: list[float]):
        self.domains, self.markers, self.cells, self.prior = domains, markers, cells, prior

    def cell(self) -> Column:
        """The number of a row's cell, from the columns of ``marked``."""
        out = _level(F.col("_repeated"), 0.35, 0.6, 0.85) * 27
        out = out + _level(F.col("_capitals"), 0.08, 0.4) * 9
        out = out + _level(F.col("_symbols"), 0.005, 0.04) * 3
        out = out + _level(F.col("n_tokens"), 1, 60)
        for words in self.markers.values():
            found = F.size(F.array_intersect(F.col("_marked"), F.array(*map(F.lit, words)))) if words else F.lit(0)
            out = out * 4 + _level(found, 1, 2, 4)
        return out.cast("long")

    def marked(self, measured: DataFrame) -> DataFrame:
        """Adds the markers among a row's words: all domains' in one pass over them."""
        every = sorted({w for words in self.markers.values() for w in words})
        found = F.array_intersect(F.col("_distinct"), F.array(*map(F.lit, every))) if every else F.array().cast("array<string>")
        return measured.withColumn("_marked", found)

    def posteriors(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, n_tokens and a double column ``p0``, ``p1``... for each domain."""
        rows = self.marked(_measured(docs)).select(*keep, "n_tokens", self.cell().alias("_cell"))
        prior = F.array(*map(F.lit, self.prior))
        if self.cells:
            # At most one row per labelled cell; the number of cells is fixed.
            table = docs.sparkSession.createDataFrame(list(self.cells.items()), "_cell long, _p array<double>")
            rows = rows.join(F.broadcast(table), "_cell", "left").withColumn("_p", F.coalesce("_p", prior))
        else:
            rows = rows.withColumn("_p", prior)
        return rows.select(*keep, "n_tokens", *[F.col("_p")[i].alias(f"p{i}") for i in range(len(self.domains))])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    domains: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    markers: int = 200,
    least: int = 5,
    smoothing: float = 2.0,
    max_labelled: int = 50_000,
) -> Classifier:
    """A classifier from labelled documents. ``domain``: an expression over ``labels``
    that gives one of ``domains``; rows where it gives anything else are skipped, and of
    several labels of a document the first by name counts. Without labels every
    posterior is even. At most ``max_labelled`` labels are used, those of the smallest
    hash of the id, so the texts meet a broadcast of bounded size."""
    marks = labels.select(named(label_id).alias("_id"), domain.alias("_domain")).where("_id is not null")
    marks = marks.where(F.col("_domain").isin(domains)).groupBy("_id").agg(F.min("_domain").alias("_domain"))
    marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    rows = pick(docs, _id=id_col, text=text_col).join(F.broadcast(marks), "_id")
    sample = store(_measured(rows).drop("_id"), "labelled")
    sizes = {r["_domain"]: int(r["count"]) for r in sample.groupBy("_domain").count().collect()}
    total = sum(sizes.values())
    if not total:
        return Classifier(domains, {d: [] for d in domains}, {}, [1 / len(domains)] * len(domains))
    prior = [(sizes.get(d, 0) + 1) / (total + len(domains)) for d in domains]
    # Documents of each domain that have a word: counted before the shuffle.
    in_domain = [F.sum(F.when(F.col("_domain") == d, 1).otherwise(0)).alias(f"n{i}") for i, d in enumerate(domains)]
    counts = sample.select("_domain", F.explode("_distinct").alias("word")).groupBy("word").agg(*in_domain, F.count("*").alias("n"))
    # A marker is far more frequent in its domain than elsewhere, and not by chance.
    told = []
    for i, d in enumerate(domains):
        mine, other = sizes.get(d, 0), total - sizes.get(d, 0)
        if mine and other and 2 * mine < total:
            a, b = F.col(f"n{i}"), F.col("n") - F.col(f"n{i}")
            odds = F.log(((a + 0.5) / (mine + 1.0)) / ((b + 0.5) / (other + 1.0)))
            z = evidence(a, b, mine, other)
            told.append(F.when((a >= least) & (odds > 2) & (z > 20), F.struct(F.lit(i).alias("i"), z.alias("z"))))
    found: dict[str, list[str]] = {d: [] for d in domains}
    if told:
        marked = counts.select("word", F.explode(F.array_compact(F.array(*told))).alias("m")).select("word", "m.i", "m.z")
        marked = store(marked, "markers")
        for i, d in enumerate(domains):  # at most ``markers`` words a domain
            top = marked.where(F.col("i") == i).orderBy(F.desc("z"), "word").limit(markers)
            found[d] = [r["word"] for r in top.collect()]
    out = Classifier(domains, found, {}, prior)
    cells = out.marked(sample).groupBy(out.cell().alias("_cell")).agg(*in_domain)
    for r in cells.collect():
        n = sum(r[f"n{i}"] for i in range(len(domains)))
        out.cells[int(r["_cell"])] = [(r[f"n{i}"] + smoothing * prior[i]) / (n + smoothing) for i in range(len(domains))]
    release(sample)
    return out


def _totals(rows: DataFrame, domains: int, rate: Column) -> np.ndarray:
    sums = rows.agg(*[F.sum(F.col("n_tokens") * F.col(f"p{i}") * rate).alias(f"s{i}") for i in range(domains)]).first()
    return np.array([float(x or 0) for x in sums])


def _pushed(p: list[Column], rate: Column, push: np.ndarray) -> Column:
    """A projected step: along the posterior, and cut at the row's least rate."""
    return F.greatest(F.col("least"), rate + sum((x * float(push[i]) for i, x in enumerate(p)), F.lit(0.0)))


def _newton(cells: DataFrame, goal: np.ndarray, gram: np.ndarray, tolerance: float, every: int) -> tuple[DataFrame, np.ndarray]:
    """Steps weighted by the inverse Gram matrix, which reach targets that can be reached
    in few steps: they go on until there or until ``every`` of them do not halve the
    residual. Where it does not go to 0 they have another goal than least squares and
    are only a start."""
    p = [F.col(f"p{i}") for i in range(len(goal))]
    solve = np.linalg.pinv(gram, rcond=1e-10)
    now, rate, step = cells.withColumn("rate", F.lit(1.0)), F.col("rate"), 0
    residual = goal - _totals(now, len(goal), rate)
    start = np.abs(residual).max()
    while np.abs(residual).max() > tolerance * max(goal.sum(), 1):
        rate = _pushed(p, rate, solve @ residual)
        step += 1
        if step % every == 0:
            last, now, rate = now, store(now.withColumn("rate", rate), "rates"), F.col("rate")
            release(last)
        residual = goal - _totals(now, len(goal), rate)
        if step % every == 0:
            if np.abs(residual).max() > start / 2:
                break
            start = np.abs(residual).max()
    return now.withColumn("rate", rate), residual


def _accelerated(cells: DataFrame, goal: np.ndarray, gram: np.ndarray, tolerance: float, every: int) -> tuple[DataFrame, np.ndarray]:
    """Accelerated projected gradient on the plain distance of the totals: steps of 1 / L
    (L: the largest eigenvalue of the Gram matrix) from a point ahead of the last one;
    the lead is given up when the distance grows. Ends when no step of ``every`` brings
    the distance down by ``tolerance`` of the targets."""
    k = len(goal)
    p = [F.col(f"p{i}") for i in range(k)]
    eta = 1 / max(np.linalg.eigvalsh(gram).max(), 1e-300)
    now = stored = store(cells.withColumns({"ahead": F.col("rate")}), "rates")
    scale = max(goal.sum(), 1)
    ahead_total = best = None
    t, still = 1.0, 0
    while still < 3:
        before = best
        for _ in range(every):
            if ahead_total is None:
                ahead_total = _totals(now, k, F.col("ahead"))
            now = now.withColumn("new", _pushed(p, F.col("ahead"), eta * (goal - ahead_total)))
            total = _totals(now, k, F.col("new"))
            distance = float(((goal - total) ** 2).sum() ** 0.5)
            if best is not None and distance > best and t > 1:  # restart from the last point
                t, ahead_total, last = 1.0, None, stored
                now = stored = store(now.drop("new").withColumn("ahead", F.col("rate")), "rates")
                release(last)
                continue
            following = (1 + (1 + 4 * t * t) ** 0.5) / 2
            lead, t = (t - 1) / following, following
            now = now.withColumn("ahead", F.col("new") + lead * (F.col("new") - F.col("rate")))
            last = stored
            now = stored = store(now.drop("rate").withColumnRenamed("new", "rate"), "rates")
            release(last)
            ahead_total, best = None, distance if best is None else min(best, distance)
        still = still + 1 if before is not None and before - best <= tolerance * scale else 0
    return now.drop("ahead"), goal - _totals(now, k, F.col("rate"))


def fit_rates(
    rows: DataFrame, targets: list[float], every: int = 8, tolerance: float = 1e-9, floors: dict[int, float] | None = None
) -> tuple[DataFrame, np.ndarray]:
    """``rows`` (n_tokens, p0, p1...) with ``rate``: nonnegative, and such that the sums
    of rate * n_tokens * p come as near to ``targets`` as can be, in tokens; and what is
    left to the targets, by domain.

    Projected gradient descent from rate 1 on the squared distance of the domains'
    totals. Rows of one posterior keep one rate, so the steps run over the distinct
    posteriors with their tokens; a step sends one total per domain to the driver. The
    first steps are weighted by the domains' Gram matrix; targets that these do not reach are approached by plain accelerated steps until the distance no longer
    falls. ``floors``: by domain the least rate of rows that are likeliest of it (0: of the
    others). Documents without tokens have no say and get the rate of their posterior.
    """
    k = len(targets)
    names = [f"p{i}" for i in range(k)]
    p = [F.col(x) for x in names]
    largest = F.greatest(*p) if k > 1 else p[0]
    least = F.coalesce(*[F.when(p[i] == largest, F.lit(float(x))) for i, x in (floors or {}).items()], F.lit(0.0))
    cells = store(rows.groupBy(*names).agg(F.sum("n_tokens").alias("n_tokens")).withColumn("least", least), "posterior-cells")
    gram = np.zeros((k, k))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = cells.agg(*[F.sum(F.col("n_tokens") * p[i] * p[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    for i, j in pairs:
        gram[i, j] = gram[j, i] = float(sums[f"g{i}_{j}"] or 0)
    goal = np.array(targets, float)
    fitted, residual = _newton(cells, goal, gram, tolerance, every)
    if np.abs(residual).max() > tolerance * max(goal.sum(), 1) and gram.any():
        fitted, residual = _accelerated(store(fitted, "rates"), goal, gram, tolerance, every)
    # one row per distinct posterior; Spark broadcasts it if it is small
    rates = fitted.select(*[F.col(x).alias(f"_{x}") for x in names], "rate")
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in names]
    joined = rows.join(store(rates, "rates"), same, "left").drop(*[f"_{x}" for x in names])
    return joined.withColumn("rate", F.coalesce("rate", F.lit(1.0))), residual


def mix(
    docs: DataFrame,
    classifier: Classifier,
    weights: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    total: float | None = None,
    keep: str | None = None,
    tolerance: float = 1e-9,
) -> DataFrame:
    """(doc_id, n_tokens, one posterior column per domain, rate, copies, and per domain
    the tokens by which the fit misses its target), a row per row.

    ``weights`` are the domains' target shares of the mix (scaled to sum 1; a domain not
    named has 0), ``total`` its size in tokens (default: that of ``docs``). With ``keep``
    documents that are likeliest of that domain have a rate of at least 1, so none of them
    is thinned out, and the default size is what gives that domain's expected tokens their
    share, if that is more. ``tolerance`` is a share of the size. ``rate`` is
    fitted; ``copies`` is the whole number it is rounded to, up with the probability of
    its fraction (by a hash of the document, so the same for repeated rows): their
    expected token totals are those of the rates. Targets that no nonnegative rates reach
    are approached as near as can be; ``missed_<domain>`` says how near. Words are tokens;
    NULL and empty texts have none. No documents, no rows. Weights of sum 0 are an error.
    """
    if sum(weights.values()) <= 0 or min(weights.values()) < 0:
        raise ValueError("weights must be nonnegative and not all 0")
    if keep is not None and not weights.get(keep):
        raise ValueError("the domain to keep needs a weight")
    shares = [weights.get(d, 0.0) / sum(weights.values()) for d in classifier.domains]
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("_hash", F.xxhash64("doc_id", "text"))
    rows = store(classifier.posteriors(rows, ["doc_id", "_hash"]), "posteriors")
    at = classifier.domains.index(keep) if keep is not None else None
    if total is None:
        mine = F.sum(F.col("n_tokens") * F.col(f"p{at}")) if keep is not None else F.lit(0.0)
        size, kept = rows.agg(F.sum("n_tokens"), mine).first()
        total = max(float(size or 0), float(kept or 0) / shares[at] if keep is not None else 0.0)
    floors = {at: 1.0} if keep is not None else None
    fitted, residual = fit_rates(rows, [total * s for s in shares], tolerance=tolerance, floors=floors)
    chance = F.shiftrightunsigned(F.xxhash64("_hash"), 11) / F.lit(float(1 << 53))
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return fitted.select(
        "doc_id",
        "n_tokens",
        *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(classifier.domains)],
        "rate",
        copies.alias("copies"),
        *[F.lit(float(x)).alias(f"missed_{d}") for d, x in zip(classifier.domains, residual)],
        "_hash",
    )


def mixed(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, each as many times as ``found`` (of ``mix``)
    says; rows of 0 copies go."""
    key, times = fresh(docs, "mix_key"), fresh(docs, "mix_copies")
    # Rows of one key have one text and posterior, so one number of copies.
    copies = found.groupBy(F.col("_hash").alias(key)).agg(F.max("copies").alias(times))
    rows = docs.withColumn(key, F.xxhash64(named(id_col), named(text_col))).join(copies, key)
    turn = fresh(docs, "mix_turn")
    rows = rows.where(named(times) > 0).withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), named(times))))
    return rows.select(*map(named, docs.columns))
