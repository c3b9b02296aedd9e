"""Quality rules, hard negatives and phrases against brute force on small tables, odd rows
included."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import hard_negatives, phrases, quality_rules

WORDS = "the cat sat on a mat and ran far off to see one big red dog by our old green barn near town".split()
CLASH = "id string, word string, n string, f string, g1 string, k string, l string, block string, label string, rule string, range string"


def make(spark, rows, kind="bigint"):
    """Documents with clashing further columns."""
    return spark.createDataFrame([(i, t, lang, *"xxxxxxxxxxx") for i, t, lang in rows], f"doc_id {kind}, text string, lang string, {CLASH}")


def bag(rows):
    return collections.Counter(map(tuple, rows))


# ------------------------------------------------------------------ phrases


def brute_phrases(rows, least=30, first=2000, cover=80):
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    hidden = set()
    for (lang, *w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                part = (lang, *w[i : i + k])
                if 100 * a >= cover * f[part]:
                    hidden.add(part)
    found = collections.defaultdict(list)
    for (lang, *w), a in candidates.items():
        if (lang, *w) not in hidden:
            cuts = [(2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return bag(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, of in found.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(of)[:first], 1)
    )


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    rows = []
    for i in range(150):
        words = [r.choice(WORDS) for _ in range(r.randint(3, 40))]
        if i % 3 == 0:
            words[2:2] = ["New", "York", "city", "hall"][: r.randint(2, 4)]
        marks = [w + (r.choice(".,;:!?\n\v\f\r\t") if r.random() < 0.1 else "") for w in words]
        rows.append((i, " ".join(marks), ["en", "fr", None][i % 7 // 3]))
    odd = [(None, None, None), (900, None, "en"), (901, "", "en"), (902, " \n\t . ", "fr"), (903, "mat " * 20_000, "en"), (904, "x" * 50_000, "de"),
           (905, "été du 世界 \x00 \x1c" * 40, "fr"), (5, "the cat sat", "und"), (5, "the cat sat", "und")]
    return rows + odd


@pytest.mark.parametrize("sizes", [{}, {"run_windows": 200, "part_windows": 500, "most_words": 50}], ids=["one part", "many parts"])
def test_phrases(spark, texts, sizes, monkeypatch):
    monkeypatch.setattr(phrases, "_STRETCH", 16)  # a border every few windows
    for least in (30, 4):
        got = phrases.collocations(make(spark, texts).repartition(5), least=least, **sizes)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert bag(got.collect()) == brute_phrases([(t, lang) for _, t, lang in texts], least)


def test_phrases_are_limited_per_language(spark, texts):
    got = phrases.collocations(make(spark, texts), least=4, first=3)
    assert bag(got.collect()) == brute_phrases([(t, lang) for _, t, lang in texts], 4, 3)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(make(spark, [])).collect() == []
    assert phrases.collocations(make(spark, [(1, None, None), (2, " . ", "en")])).collect() == []


def test_words_that_share_an_id_are_told_apart(spark, texts, monkeypatch):
    """With ids that clash under the first seed the count is done anew."""
    whole = phrases.word_id

    def clashing(lang, word, seed):
        return 7 if seed == 0 and word in (b"the", b"cat") else whole(lang, word, seed)

    seeds, run = [], phrases._vocabulary
    monkeypatch.setattr(phrases, "word_id", clashing)
    monkeypatch.setattr(phrases, "_vocabulary", lambda docs, seed, *a: seeds.append(seed) or run(docs, seed, *a))
    got = phrases.collocations(make(spark, texts), least=4)
    assert bag(got.collect()) == brute_phrases([(t, lang) for _, t, lang in texts], 4)
    assert seeds == [0, 1]


def test_borders_lie_inside_a_frequent_phrase(spark):
    """One phrase that is most of the corpus is spread over several parts and still
    counted once."""
    rows = [(i, " ".join(f"of the {w}" for w in WORDS), "en") for i in range(60)]
    got = phrases.collocations(make(spark, rows), run_windows=300, part_windows=400)
    assert bag(got.collect()) == brute_phrases([(t, lang) for _, t, lang in rows])


# ------------------------------------------------------------------ hard negatives


def brute_negatives(rows, every, positives, negatives, low, high, scale=256):
    """Exact search with whole numbers of any size."""
    fine = [
        (i, lab, [int(np.floor(scale * float(x))) for x in v])
        for i, lab, v in rows
        if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, lab, v) in enumerate(fine):
        if i % every:
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(v, w)), j, other) for n, (j, other, w) in enumerate(fine) if n != at and len(w) == len(v)),
            key=lambda x: x[:2],
        )
        for ps, p in [(-s, j) for s, j, other in scored if other == lab][:positives]:
            near = [(-s, j) for s, j, other in scored if other != lab and low * ps <= -100 * s <= high * ps][:negatives]
            out += [(i, p, rank, j, ps, s) for rank, (s, j) in enumerate(near, 1)]
    return bag(out)


def vectors(n=400, width=24, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, width))
    rows = [(int(i), int(i % 4), (centres[i % 4] * r.uniform(0, 1) + r.normal(size=width) * 0.7).astype(np.float32).tolist()) for i in range(n)]
    twin = rows[20][2]
    odd = [
        (None, 1, twin), (1000, None, twin), (1010, 1, None), (1020, 1, [None] * width), (1030, 2, [float("nan")] + twin[1:]),
        (1040, 2, [float("inf")] + twin[1:]), (1050, 1, []), (1051, 2, []), (1060, 3, twin[:5]), (1061, 3, twin[:5]), (1062, 1, twin[:5]),
        (1070, 1, [0.0] * width), (20, rows[20][1], twin), (20, rows[20][1], twin), (1080, 9, twin), (1081, 0, [-x for x in twin]),
    ]
    return rows + odd + [(2000 + i, 2, twin) for i in range(30)]


SCHEMA = "vec_id bigint, label int, embedding array<float>, id string, vector string, block string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 16, "group_rows": 3, "stripe_rows": 64}], ids=["one cell", "many cells"])
@pytest.mark.parametrize("asked", [(5, 10, 30, 90), (2, 3, -50, 120)], ids=["production", "wide"])
def test_hard_negatives(spark, sizes, asked):
    rows = vectors()
    positives, negatives, low, high = asked
    got = hard_negatives.hard_negatives(
        table(spark, rows).repartition(3), every=10, positives=positives, negatives=negatives, low=low, high=high, **sizes
    )
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert bag(got.collect()) == brute_negatives(rows, 10, positives, negatives, low, high)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(table(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(table(spark, [(1, 1, [1.0]), (2, 1, [1.0])])).collect() == []  # no anchor


def test_label_may_be_an_expression(spark):
    rows = vectors()
    moved = [(i, lab if lab is None or i is None or i % 7 else (lab + 1) % 10, v) for i, lab, v in rows]
    col = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(table(spark, rows), label=col, every=10)
    assert bag(got.collect()) == brute_negatives(moved, 10, 5, 10, 30, 90)


def test_components_beyond_exact_doubles(spark):
    """Large components are multiplied as whole numbers; sums that a long may not hold
    are an error, never a wrong score."""
    rows = [(i, i % 2, [float(300_017 * (i + 1)), float(2_000_003 + i), 1.0]) for i in range(20)]
    got = hard_negatives.hard_negatives(table(spark, rows), every=10)
    assert bag(got.collect()) == brute_negatives([(i, lab, list(np.float32(v).tolist())) for i, lab, v in rows], 10, 5, 10, 30, 90)
    with pytest.raises(Exception, match="may not fit in a long"):
        hard_negatives.hard_negatives(table(spark, [(i, i % 2, [3e8, 3e8]) for i in range(4)]), every=1).collect()


def test_bounds_hold_and_spare_work():
    r = np.random.default_rng(1)
    for width in (1, 3, 5, 64, 67):
        values = np.floor(r.normal(size=(200, width)) * r.choice([1, 300, 40_000], size=(200, 1))).astype(np.int64)
        places = np.stack([np.zeros(200, np.int64), np.arange(200)], axis=1)
        rows = hard_negatives.Rows(np.arange(200), np.zeros(200, np.int64), places, values)
        exact = rows.vectors @ rows.vectors.T
        last = None
        for level in range(len(hard_negatives.LEVELS)):
            lower, upper = hard_negatives.bounds(rows, rows, level)
            assert (lower <= exact).all() and (exact <= upper).all()
            i, j = np.nonzero(np.ones((200, 200), bool))
            for whole, pair in zip((lower, upper), hard_negatives.bounds(rows, rows, level, (i, j))):
                assert np.allclose(whole.reshape(-1), pair, atol=1e-3)
            if last is not None:  # finer segments bound at least as well, but for the rounding
                assert ((upper - lower) <= last * (1 + 1e-4) + 1e-3).all()
            last = upper - lower
    smooth = np.repeat(np.floor(r.normal(size=(4000, 16)) * 200), 4, axis=1).astype(np.int64)
    places = np.stack([np.zeros(4000, np.int64), np.arange(4000)], axis=1)
    rows = hard_negatives.Rows(np.arange(4000), np.zeros(4000, np.int64), places, smooth)
    anchors = rows.part(0, 50)
    best = hard_negatives.Best(np.full((50, 1), hard_negatives.NOTHING), np.full((50, 1), 2**62), 5)
    scored = hard_negatives.search(anchors, rows, best, True)
    assert scored < 50 * 4000 / 4  # most pairs are never scored
    assert len(best.found) == 250


# ------------------------------------------------------------------ quality rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def base_fails(n_words, n_repeat):
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def quality_texts(n=300):
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(r.randint(20, 160))]
        bad = i % 4 == 0
        if bad and i % 8:
            words = [w[:-1] + r.choice("#$|") if r.random() < 0.4 else w for w in words]
        elif bad:
            words = [w.upper() for w in words]
        text = " ".join(w + (r.choice(["\n", ".", ""]) if r.random() < 0.2 else "") for w in words)
        rows.append((i, text, "en"))
        labels.append((i, 0 if bad else 1))
    return rows, labels


ODD = [
    (None, None, None), (None, "the cat", None), (900, None, None), (901, "", None), (902, " \n\t ", "en"), (903, "mat " * 30_000, "en"),
    (904, "été 世界  x\u0085 \x1c \x00 <b>\n<b>\n <b>\n\n\n" * 30, "fr"), (905, "x" * 50_000, None), (5, "a b c d a b c", "en"), (5, "a b c d a b c", "en"),
    (906, "a a a a", "en"), (907, "\n".join(["same line of words"] * 20), "en"),
]


def test_quality_counts(spark):
    rows = quality_texts()[0] + ODD
    got = quality_rules.text_counts(make(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert bag(got.collect()) == bag((i, *brute_counts(t)) for i, t, _ in rows)


def test_repeated_words_of_many_distinct_ones():
    r = np.random.default_rng(0)
    numbers = r.integers(0, 6, 300)
    text = " ".join(map(str, numbers))
    want = brute_counts(text)[4]
    assert quality_rules.repeated_words(numbers, 6) == want
    assert quality_rules.repeated_words(numbers, 2**21 + 5) == want  # ranks of pairs instead of pairs


def test_quality_rules(spark):
    rows, labels = quality_texts(900)
    learned = [x for x in labels if x[0] % 3]  # the others are held out
    marks = spark.createDataFrame([*learned, (None, 0), (903, None), (5, 1)], "doc_id bigint, quality int")
    got = quality_rules.quality_rules(make(spark, rows + ODD), marks)
    found = got.collect()
    assert bag((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in found) == bag(
        (i, *brute_counts(t)) for i, t, _ in rows + ODD
    )
    for x in found:
        assert x.base_failed == base_fails(x.n_words, x.n_repeat_words)
        assert x.kept == (not x.base_failed and x.rule is None)
    by_id = {x.doc_id: x for x in found if x.doc_id is not None and x.doc_id < 900 and x.doc_id != 5}
    held = [(by_id[i], good) for i, good in labels if i % 3 == 0 and not by_id[i].base_failed]
    assert np.mean([x.kept == bool(good) for x, good in held]) > 0.97
    assert all(x.kept for x, good in held if good)


def test_the_expression_says_what_the_rules_say(spark):
    """The ordered conditional against the rules applied one by one in Python."""
    rows, labels = quality_texts(600)
    counted = quality_rules.text_counts(make(spark, rows + ODD))
    rules = quality_rules.learn(counted, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert len(rules) >= 2
    columns = [quality_rules.rate(name).alias(f"r{i}") for i, name in enumerate(quality_rules.RATES)]
    table_ = quality_rules.judged(counted, rules).select("rule", *columns).toPandas()
    rates = {name: table_[f"r{i}"].to_numpy() for i, name in enumerate(quality_rules.RATES)}
    want = np.zeros(len(table_))
    for i, rule in reversed(list(enumerate(rules, 1))):
        want[rule.holds(rates)] = i
    assert (table_["rule"].fillna(0).to_numpy() == want).all()


def brute_grow(rates, bad, most):
    """Every condition between two neighbouring values, tried one by one."""
    covered, out = np.ones(len(bad), bool), []
    while len(out) < most and not bad[covered].all():
        best = (1e-9, None)
        p0, n0 = bad[covered].sum(), (~bad[covered]).sum()
        for name, values in rates.items():
            distinct = np.unique(values[covered])
            for above, (x, y) in itertools.product((False, True), list(zip(distinct, distinct[1:]))):
                c = quality_rules.Condition(name, above, (x + y) / 2)
                now = covered & c.holds(rates)
                p, n = bad[now].sum(), (~bad[now]).sum()
                gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else -np.inf
                if gain > best[0] + 1e-12:
                    best = (gain, c)
        if best[1] is None:
            break
        out.append(best[1])
        covered &= best[1].holds(rates)
    return quality_rules.Rule(tuple(out)), covered


def test_rules_grow_as_by_brute_force():
    r = np.random.default_rng(4)
    for _ in range(5):
        rates = {"words": r.normal(size=80), "word length": r.integers(0, 5, 80).astype(float)}
        bad = (rates["words"] > 0.3) & (rates["word length"] > 1) | (r.random(80) < 0.1)
        want, covered = brute_grow(rates, bad, 6)
        got = quality_rules.grow(rates, bad, 6)
        assert (got.holds(rates) == covered).all() and len(got.conditions) == len(want.conditions)


def test_a_rule_is_cut_where_it_is_most_precise():
    a, b = quality_rules.Condition("words", True, 0.5), quality_rules.Condition("word length", True, 0.5)
    rates = {"words": np.array([1.0] * 8 + [0.0] * 8), "word length": np.array([1.0, 0.0] * 8)}
    bad = np.array([True] * 8 + [False] * 8)
    rule, precision, covered = quality_rules.prune(quality_rules.Rule((a, b)), rates, bad)
    assert rule.conditions == (a,) and covered == 8 and precision == 9 / 10


def test_no_rules_without_two_kinds(spark):
    rows = quality_texts(60)[0]
    for marks in ([], [(i, 1) for i in range(60)], [(i, None) for i in range(60)]):
        labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
        got = quality_rules.quality_rules(make(spark, rows), labels).collect()
        assert all(x.rule is None and x.kept == (not x.base_failed) for x in got) and len(got) == 60
    assert quality_rules.quality_rules(make(spark, []), spark.createDataFrame([], "doc_id bigint, quality int")).collect() == []
