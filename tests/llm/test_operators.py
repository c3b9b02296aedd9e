"""The operators against brute force on small tables, odd rows included."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cairn.llm import ann, exact_dedup, language_id, lm_scoring, mixing, packing, pii, sharding, simhash, toxicity
from cairn.llm.graph import components
from cairn.llm.queries import MIX_WEIGHTS, label_classifier, label_domain, tokenizer_path

WORDS = "the cat sat on a mat and ran far off to see one big red dog by our old green barn near town".split()
LOST = "le chat noir dort sous une table avec ses petits jouets et mange du poisson frais chaque matin".split()
# Names that the operators use for columns of their own.
CLASH = "text_ string, fp string, score string, count string, sha string, rate string, number string, lang string, block string"


def make(spark, rows, kind="bigint"):
    """Documents with clashing further columns."""
    return spark.createDataFrame(
        [(i, t, "x", "x", "x", "x", "x", "x", "x", lang, "x") for i, t, lang in rows], f"doc_id {kind}, text string, {CLASH}"
    )


def corpus(n=120, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang, words = ("en", WORDS) if i % 3 else ("fr", LOST)
        rows.append((i, " ".join(r.choice(words) for _ in range(r.randint(3, 60))), lang))
    copies = [(n + j, rows[7][1], "en") for j in range(30)] + [(n + 40 + j, rows[9][1].replace(" ", " \t\n", 2), "fr") for j in range(4)]
    odd = [
        (None, None, None), (None, "the cat", None), (900, None, None), (901, "", None), (902, " \n\t ", "en"),
        (903, "12 34 !!", "en"), (904, "é", "fr"), (5, "the cat sat", "en"), (5, "the cat sat", "en"), (905, "mat " * 30_000, "en"),
        (906, "x" * 50_000, None),
    ]
    return rows + copies + odd


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def bag(rows):
    return collections.Counter(map(tuple, rows))


# ------------------------------------------------------------------ SimHash


def brute_fingerprint(text, n=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    fps = sorted(set(fps))
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i:]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    return {x: find(x) for x in fps}


def test_simhash_against_brute_force(docs, rows):
    got = simhash.near_duplicates(docs).collect()
    fps = {(i, t): brute_fingerprint(t) for i, t, _ in rows}
    root = brute_components(fps.values(), 3)
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = bag((i, f"{fps[i, t]:016x}", least.get(root[fps[i, t]])) for i, t, _ in rows)
    assert bag((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("distance,limit", [(3, 8192), (3, 2), (2, 1), (1, 1), (0, 1), (5, 3)])
def test_links_connect_what_distance_connects(spark, distance, limit):
    r = random.Random(distance)
    centres = [r.getrandbits(64) for _ in range(3)]
    fps = {0, 2**64 - 1}
    for c in centres:  # dense balls: hot segment values, and chains
        for _ in range(25):
            x = c
            for b in r.sample(range(64), r.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in sorted(fps)]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), distance, limit)
    pairs = edges.collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= distance for a, b in pairs)
    roots = {x.node & (2**64 - 1): x.root for x in components(edges).collect()}
    want = brute_components(fps, distance)
    classes = collections.defaultdict(set)
    for x, y in want.items():
        classes[y].add(x)
    got = collections.defaultdict(set)
    for x in fps:
        got[roots.get(x, (x, "alone"))].add(x)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, got.values()))


def test_simhash_keeps_one_of_each_group(docs, rows):
    classes = simhash.near_duplicates(docs).collect()
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.component_fp for r in classes})


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (600, 601), (601, 600)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 600: 600, 601: 600}


# ------------------------------------------------------------------ exact dedup


def brute_groups(rows):
    out = collections.defaultdict(list)
    for i, t, _ in rows:
        out[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return out


def test_exact_dedup_against_brute_force(docs, rows):
    want = bag(
        (i, min((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in brute_groups(rows).items()
        for i in ids
    )
    for block_rows in (4, 65_536):
        got = exact_dedup.exact_duplicates(docs, block_rows=block_rows).collect()
        assert bag((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        stays = collections.Counter(r.text_sha256 for r in got if r.kept)
        assert set(stays.values()) == {1} and len(stays) == len(brute_groups(rows))
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_keeps_one_row(docs, rows):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted(brute_groups(rows))


def test_filters_merge_without_loss():
    r = np.random.default_rng(1)
    parts = []
    total = collections.Counter()
    for _ in range(5):
        fps, n = np.unique(r.integers(0, 2**64, 300, dtype=np.uint64) >> np.uint64(r.integers(0, 60)), return_counts=True)
        n = n.astype(np.uint64) + np.uint64(7)
        again = exact_dedup.decode_filter(exact_dedup.encode_filter(fps, n))
        assert (again[0] == fps).all() and (again[1] == n).all()
        parts.append(exact_dedup.encode_filter(fps, n))
        total.update(dict(zip(fps.tolist(), n.tolist())))
    fps, n = exact_dedup.merge_filters(parts)
    assert dict(zip(fps.tolist(), n.tolist())) == total and (np.diff(fps.astype(object)) > 0).all()


# ------------------------------------------------------------------ personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or max(map(int, m[0].split("."))) <= 255,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), n, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_base_spans_equal_the_patterns():
    r, anchors = random.Random(5), pii.automaton()
    for _ in range(20_000):
        text = "".join(r.choice("ab@@..1234567890 -++()%é\n:/İ") for _ in range(r.randint(0, 45)))
        assert [s for s in pii.find(text, anchors) if s[0] in pii.BASE_KINDS] == brute_spans(text)


def test_added_spans_and_digest(spark):
    text = "IBAN: DE89 3704 0044 0532 0130 00 at HTTPS://a.example.com/x?y=1. Account no. 12345678, a@b.example 10.0.0.1 iban DE00"
    got = pii.personal_data(make(spark, [(1, text, None), (2, None, None), (2, "", None)])).orderBy("doc_id").collect()
    found = [(k, text[int(a) : int(b)]) for k, a, b in (x.split(":") for x in got[0].spans.split(","))]
    assert found == [
        ("account", "DE89 3704 0044 0532 0130 00"), ("url", "HTTPS://a.example.com/x?y=1"), ("account", "12345678"),
        ("email", "a@b.example"), ("ip", "10.0.0.1"),
    ]
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(text))
    assert got[0].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and got[0].n_email == 1
    assert [(r.spans, r.base_sha256) for r in got[1:]] == [("", hashlib.sha256(b"").hexdigest())] * 2


def test_long_runs_take_linear_time():
    anchors = pii.automaton()
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "iban " * 60_000, "http://" * 50_000):
        pii.find(text, anchors)


# ------------------------------------------------------------------ packing


def test_packing_covers_every_id_once(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {(i, t): tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _ in rows}
    got = packing.pack(docs, tokenizer_path(), capacity=256).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for doc_id, pieces in by_doc.items():
        want = [ids[i, t] for i, t, _ in rows if i == doc_id]
        assert sum(r.length for r in pieces) == sum(map(len, want))
        every = [(a, b, zlib.crc32(np.array(x[a : a + b], "<u4").tobytes()), len(x)) for x in want for a, b in _pieces(len(x))]
        assert bag((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == bag(every)
    assert set(by_doc) == {i for i, _, _ in rows}
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 256
    full = sum(r.length for r in got)
    assert 256 * len(sequences) <= 1.02 * full + 256 * packing.RANGES


def _pieces(n, capacity=256, tail=16):
    at = 0
    for length, _ in packing.cuts(n, capacity, tail):
        yield at, length
        at += length


def test_cuts_stay_in_their_class():
    for capacity in (64, 256, 2048):
        for n in range(1, 3 * capacity):
            found = list(packing.cuts(n, capacity, 16))
            assert sum(a for a, _ in found) == n
            assert all(capacity // (k + 1) < a <= capacity // k for a, k in found)


def test_words_give_the_texts_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    words, r = packing.Words(tokenizer_path(), False, most=50), random.Random(2)
    for _ in range(5000):
        text = "".join(r.choice("ab'sé́ΣσÉ İßﬁ  \x1c\x85\n\t .,.,!12٣漢字'lltmre<|>endoftxs") for _ in range(r.randint(0, 20)))
        assert np.frombuffer(words.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_tokens_in_any_case():
    """Special tokens are looked for before case is lowered, also inside words."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    words, r = packing.Words(tokenizer_path(), False), random.Random(3)
    pieces = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|StartOfText|>", "<|EndOfText|>", "see", "Here", "É", " ", "\n", "<|", "|>", ".", "'s", "12", "漢"]
    texts = ["see <|ENDOFTEXT|> here", "a<|endoftext|>B", "<|STARTOFTEXT|><|startoftext|>", "x<|EndOfText|>y <|endoftext|>"]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n_words", [0, 1, 3, 10])
def test_short_texts_leave_little_padding(spark, n_words):
    texts = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(" ".join(["cat"] * n_words)).alias("text")).repartition(6)
    got = packing.pack(texts, tokenizer_path()).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert sum(r.n for r in got) == 20_000 * (n_words + 1) and all(r.n == r.end <= 2048 for r in got)
    assert len(got) * 2048 <= 1.02 * 20_000 * (n_words + 1) + 2048 * packing.RANGES


# ------------------------------------------------------------------ language model


def brute_counts(rows, order):
    learned = [i for i, (k, _, _) in enumerate(rows) if fold(k, 10)]
    tokens = [[*(t or "").lower().split(), None] for _, t, _ in rows]
    counts = [collections.Counter(), collections.Counter()]  # all learned; without the deleted fold
    for i in learned:
        for n in range(1, order + 1):
            padded = [""] + tokens[i]
            for j in range(1, len(padded)):
                gram = tuple(padded[max(0, j - n + 1) : j + 1]) if n > 1 else (padded[j],)
                counts[0][n, gram] += 1
                counts[1][n, gram] += fold(rows[i][0], 10) != 1
    return learned, tokens, counts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_against_brute_force(docs, rows, order):
    learned, tokens, (every, rest) = brute_counts(rows, order)
    n = {w: c for w, c in (("N", sum(c for (k, _), c in every.items() if k == 1)), ("V", sum(k == 1 for k, _ in every)))}
    docs_all, docs_rest = len(learned), sum(fold(rows[i][0], 10) != 1 for i in learned)

    def estimates(counts, i, total, n_docs):
        padded, out = [""] + tokens[i], []
        for j in range(1, len(padded)):
            p, context = [1 / (n["V"] + 1), counts[1, (padded[j],)] / max(total, 1)], total
            for k in range(2, order + 1):
                gram = tuple(padded[max(0, j - k + 1) : j + 1])
                before = gram[:-1]
                # A context at the start is the document's beginning, of any length.
                if len(before) == 1:
                    context = n_docs if before == ("",) else counts[1, before]
                else:
                    context = counts[len(before), before]
                p.append(counts[k, gram] / context if context else 0.0)
            out.append((context, p))
        return out

    cells = []
    total_rest = sum(c for (k, _), c in rest.items() if k == 1)
    for i in learned:
        if fold(rows[i][0], 10) == 1:
            for context, p in estimates(rest, i, total_rest, docs_rest):
                cells.append({"b": int(lm_scoring.bucket(np.array([context]))[0]), "n": 1.0, **{f"s{k}": p[k] for k in range(1, order + 1)}})
    weights = lm_scoring.learn_weights(cells, order, 1 / (n["V"] + 1))
    want = []
    for i, (doc_id, _, _) in enumerate(rows):
        base = sum(math.log10((every[1, (w,)] + 0.1) / (n["N"] + 0.1 * (n["V"] + 1))) for w in tokens[i])
        model = sum(math.log10(weights[int(lm_scoring.bucket(np.array([c]))[0])] @ p) for c, p in estimates(every, i, n["N"], docs_all))
        want.append((doc_id, fold(doc_id, 10) == 0, len(tokens[i]), sum(every[1, (w,)] > 0 for w in tokens[i]), n["N"], base, model))
    got = lm_scoring.score_documents(docs, order=order, block_tokens=200, part_ngrams=50).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=2e-2)  # EM reads its counts on a grid


def test_weights_follow_the_held_out_counts():
    cells = [{"b": 3, "n": 100.0, "s1": 1.0, "s2": 50.0}, {"b": 5, "n": 100.0, "s1": 20.0, "s2": 0.0}]
    w = lm_scoring.learn_weights(cells, 2, 1e-3)
    assert w[3, 2] > 0.99 and w[5, 1] > 0.99 and np.allclose(w.sum(1), 1)


# ------------------------------------------------------------------ nearest neighbours


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for a, (q, x) in enumerate(good):
        if q % 20 == 0:
            scored = sorted((-float((x * y).sum()), i) for b, (i, y) in enumerate(good) if a != b)[:k]
            out[q] = scored
    return out


@pytest.mark.parametrize("n", [5, 400])
def test_neighbours_against_brute_force(spark, n):
    r = np.random.default_rng(n)
    vectors = [(int(i), [float(x) for x in v]) for i, v in enumerate(r.normal(size=(n, 8)).astype(np.float32))]
    vectors += [(1000 + i, vectors[0][1]) for i in range(0, 60)]  # copies of a query
    vectors += [(2000, None), (2020, [0.0] * 8), (2040, [None] + [1.0] * 7), (2060, [float("nan")] * 8), (2080, [float("inf")] * 8), (2100, [1.0]), (None, [1.0] * 8), (2120, [])]
    df = spark.createDataFrame([(i, v, "x", "x") for i, v in vectors], "vec_id bigint, embedding array<float>, entry string, list string").repartition(4)
    got = collections.defaultdict(list)
    for x in ann.nearest(df, list_size=20, list_rows=30, query_rows=5).collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    want = brute_nearest(vectors, 20)
    assert set(got) == set(want)
    hits = total = 0
    for q, found in want.items():
        mine = sorted(got[q])
        assert [x[0] for x in mine] == list(range(1, len(found) + 1))
        assert [(-round(s, 9), i) for _, i, s in mine] == sorted((-round(s, 9), i) for _, i, s in mine)
        hits += len({i for _, i in found} & {i for _, i, _ in mine})
        total += len(found)
    assert hits >= (0.9 if n > 100 else 1.0) * total


def test_lists_read_grow_with_their_number(spark):
    """Noise has no clusters: 2 of 100 lists hold few of the neighbours."""
    r = np.random.default_rng(1)
    v = r.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(set)
    for x in ann.nearest(df, list_size=30, max_sample=600, probes=2, probe_ratio=1.0).collect():
        got[x.query_id].add(x.vec_id)
    hits = 0
    for q in range(0, 3000, 20):
        score = v @ v[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert all(len(x) == 20 for x in got.values()) and hits >= 0.9 * 20 * 150


def test_graph_search_finds_the_nearest_centroids():
    r = np.random.default_rng(3)
    centres, x = r.normal(size=(700, 8)), r.normal(size=(40, 8))
    graph = ann.Graph(centres)
    exact, apart = ann._order(x, centres)
    ids, found = graph.search(x, 64)
    assert ids.shape == (40, 64) and (ids >= 0).all() and (np.diff(found, axis=1) >= 0).all()
    assert all(len(set(i)) == 64 for i in ids.tolist())
    assert np.allclose(found, ((centres[ids] - x[:, None]) ** 2).sum(2))
    assert np.mean([len(set(a[:20]) & set(b[:20])) / 20 for a, b in zip(ids.tolist(), exact.tolist())]) > 0.95
    whole, _ = graph.search(x, 700)
    assert (whole == exact).all()


# ------------------------------------------------------------------ languages


def test_languages(docs, rows):
    got = language_id.language_id(docs).collect()
    assert len(got) == len(rows)
    lang = collections.defaultdict(set)
    for i, t, x in rows:
        lang[i].add((x, bool(t and any(c.isalpha() for c in t))))
    for r in got:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        if len(lang[r.doc_id]) == 1:
            (want, letters), = lang[r.doc_id]
            assert letters or (r.lang_pred, r.score) == ("und", 0.0)
            if letters and want and r.doc_id < 300:
                assert r.lang_pred == want
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns
    # 906, one letter 50,000 times, is like no language learned
    assert bag(kept.select("doc_id").collect()) == bag((i,) for i, t, _ in rows if t and any(c.isalpha() for c in t) and i != 906)


def test_mixed_document_and_tree_sum(spark, docs):
    model = language_id.train(docs.where("lang is not null"), fan_in=2)
    assert model.langs == ["en", "fr"]
    whole = language_id.train(docs.where("lang is not null").coalesce(1))
    assert np.allclose(model.log_p, whole.log_p)
    text = " ".join(WORDS * 3 + LOST)
    found = language_id.identify(make(spark, [(1, text, None)]), model, names=("p", "s", "m", "e")).first()
    assert found.p == "en" and 0.6 < found.s < 0.9 and "fr:" in found.m


def test_text_that_no_language_explains(spark):
    # with few learned n-grams a language hardly differs from the background
    learned = make(spark, corpus(2000)[:2000])
    model = language_id.train(learned)
    odd = ["これは日本語の文章です" * 5, "Это русский текст", "zqxj zqxj", "the cat sat on a mat and ran", "le chat noir dort", "の" * 5000, "12 34 a"]
    found = language_id.identify(make(spark, [(i, x, None) for i, x in enumerate(odd)]), model, names=("p", "s", "m", "e")).orderBy("doc_id").collect()
    assert [x.e >= 0.25 for x in found[:6]] == [False, False, False, True, True, False]
    assert all(x.s < 0.25 for x in found[:3]) and [found[3].p, found[4].p] == ["en", "fr"] and found[3].s > 0.9
    foreign = make(spark, [(5000, odd[0], None), (5001, odd[1], "ru"), (5002, odd[2], None)])
    kept = language_id.accepted(learned.union(foreign.where("doc_id != 5001")))
    assert kept.where("doc_id >= 5000").count() == 0 and kept.where("doc_id < 2000").count() == 2000


def brute_mixture(log_p, active, rounds):
    """EM of one document, word by word."""
    share = {j: 1 / len(active) for j in active}
    for _ in range(rounds):
        new = dict.fromkeys(active, 0.0)
        for row in log_p:
            joint = {j: math.exp(row[j] - max(row)) * share[j] for j in active}
            for j in active:
                new[j] += joint[j] / sum(joint.values()) / len(log_p)
        share = new
    return share, sum(math.log(sum(math.exp(row[j] - max(row)) * share[j] for j in active)) for row in log_p)


def test_inference_against_brute_force():
    """Proportions and set by the same rule, one document and one word at a time, with
    no bound on the set."""
    r = np.random.default_rng(6)
    scores = []
    for n in (1, 3, 40, 120, 200):
        own = r.integers(0, r.integers(1, 7), n)  # up to six languages in a text
        x = r.normal(-30, 2, (n, 7))
        x[np.arange(n), own] += r.uniform(5, 15, n)
        scores.append(x)
    for x, got in zip(scores, language_id.infer(scores)):
        every, _ = brute_mixture(x, range(7), 8)
        order = sorted(range(6), key=lambda j: -every[j])
        sizes = max(1, sum(every[j] * len(x) > 0.1 for j in range(6)))
        tried = []
        for size in range(1, sizes + 1):
            share, log_l = brute_mixture(x, [*order[:size], 6], 8)
            tried.append((-2 * log_l + (size - 1) * math.log(len(x) + 1), share))
        want = min(tried, key=lambda y: y[0])[1]
        assert np.allclose(got, [want.get(j, 0.0) for j in range(7)], atol=1e-6)
    assert (language_id.infer(scores)[-1][:6] > 0.05).sum() > 4


def test_long_texts_are_inferred_in_bounded_units(docs):
    model = language_id.train(docs.where("lang is not null"))
    whole = model.word_scores(language_id._spaced("the cat sat on a mat " * 60_000))
    assert len(whole) <= language_id.MOST_UNITS
    some = model.word_scores(language_id._spaced("the cat sat on a mat " * 600))
    assert np.allclose(whole.sum(axis=0) / 100, some.sum(axis=0), rtol=1e-3)


# ------------------------------------------------------------------ toxicity


def test_toxicity(spark, docs, rows):
    r = random.Random(4)
    bad, extra = "vorkel zanth idiot".split(), []
    for i in range(3000, 3300):
        words = [r.choice(WORDS) for _ in range(30)]
        if i % 2:
            words[5:9] = r.choice(bad), "you", r.choice(bad), r.choice(bad)
        extra.append((i, " ".join(words), "en"))
    both = make(spark, extra).union(docs)
    labels = spark.createDataFrame([(i, i % 2, "x") for i, _, _ in extra] + [(None, 1, "x"), (905, None, "x"), (77777, 1, "x")], "doc_id bigint, toxic int, score string")
    got = toxicity.toxicity(both, toxicity.learn(both, labels, trees=5, depth=3)).collect()
    assert len(got) == len(extra) + len(rows)
    for x in got:
        assert x.held_out == (fold(x.doc_id, 5) == 0) and 0 <= x.score <= 1 and x.predicted == (x.score >= 0.5)
        if x.doc_id is not None and 3000 <= x.doc_id < 3300:
            assert x.predicted == x.doc_id % 2
    even = toxicity.toxicity(docs, toxicity.learn(docs, labels.limit(0))).select("score").distinct().collect()
    assert [x.score for x in even] == [0.0]


def test_toxicity_of_words_known_by_chance(spark):
    """Labels that nothing in the texts tells: the calibration sees no words learned from
    its own documents, so no score is sure."""
    r = random.Random(9)
    texts = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(40)), "en") for i in range(1200)]
    labels = spark.createDataFrame([(i, int(r.random() < 0.3)) for i, _, _ in texts], "doc_id bigint, toxic int")
    docs = make(spark, texts)
    got = [x.score for x in toxicity.toxicity(docs, toxicity.learn(docs, labels, trees=5, depth=3)).collect()]
    assert len(got) == 1200 and max(got) < 0.9 and 0.2 < sum(got) / len(got) < 0.4


def test_toxicity_features_of_a_long_text():
    words = ["you", "idiot", "plain", "WORD!"] * 50_000
    row = dict(zip(toxicity.FEATURES, toxicity.Features({}).row(" ".join(words))))
    again = dict(zip(toxicity.FEATURES, toxicity.Features({}, most=2).row(" ".join(words))))
    assert row == again
    hits = [i for i, w in enumerate(words) if w == "idiot"]
    values = list(row.values())
    assert values[1] == len(hits) and values[2] == len(hits) / len(words) and values[3] == 5.0 * len(hits)
    assert values[9] == 13  # of any 50 words in a row
    assert values[10] == 0.25 and values[11] == len(hits)


# ------------------------------------------------------------------ sharding


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_are_even_and_groups_together(docs, rows, shards):
    got = sharding.assign_shards(docs, shards=shards, block_rows=10).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.get(j, 0) for j in range(shards)) <= 1
    slots = collections.defaultdict(set)
    for r in got:
        slots[r.shard].add(r.slot)
    assert all(s == set(range(sizes[j])) for j, s in slots.items())
    assert bag((r.doc_id, r.size, r.text_crc32) for r in got) == bag((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    parts = collections.defaultdict(set)
    for r in got:
        parts[r.text_crc32].add(r.shard)
    groups = collections.Counter(zlib.crc32((t or "").encode()) for _, t, _ in rows)
    quota = len(rows) // shards
    for text, n in groups.items():  # a group that fits is whole, a larger one is in few parts
        assert len(parts[text]) <= max(1, -(-n // quota)) + (n > quota)


@pytest.mark.parametrize(
    "groups, single, cut",
    [
        ([200] * 12, 2400, 0),  # 0.67 of a quota each: none could move before
        ([1600] + [150] * 16, 800, 1),  # only the hot group, larger than a quota, is cut
        ([270, 210, 150] * 5, 1650, 0),  # 0.5 to 0.9 of a quota
        ([2] * 2400, 0, 0),  # only copies
        ([290] * 16 + [20] * 8, 0, 8),  # only copies, and the small ones fit nowhere whole
    ],
)
def test_large_groups_are_placed_whole(spark, groups, single, cut):
    texts = [f"g{g}" for g, n in enumerate(groups) for _ in range(n)] + [f"s{i}" for i in range(single)]
    random.Random(5).shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = sharding.assign_shards(docs, block_rows=500).collect()
    assert collections.Counter(r.shard for r in got) == {j: 300 for j in range(16)}
    assert {(r.shard, r.slot) for r in got} == {(j, i) for j in range(16) for i in range(300)}
    parts = collections.defaultdict(set)
    for r in got:
        parts[texts[r.doc_id]].add(r.shard)
    assert sum(len(parts[f"g{g}"]) > 1 for g in range(len(groups))) == cut
    assert len(parts["g0"]) <= max(1, -(-groups[0] // 300))


def test_small_groups_fill_the_rooms(spark):
    texts = [f"g{i // 3}" for i in range(3000)] + ["h"] * 72  # 768 a shard: groups of 3 are small
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sharding.assign_shards(docs, shards=4, block_rows=100).collect()
    assert {(r.shard, r.slot) for r in got} == {(j, i) for j in range(4) for i in range(768)}
    parts = collections.defaultdict(set)
    for r in got:
        parts[texts[r.doc_id]].add(r.shard)
    assert sum(len(p) > 1 for p in parts.values()) <= 3


def test_place_largest_first():
    rooms = [300] * 16
    pieces = sharding._place([(1, 1000), (2, 200), (3, 200)], rooms)
    assert sum(b - a for _, a, b, _ in pieces) == 1400 and sum(rooms) == 16 * 300 - 1400
    assert sorted(b - a for g, a, b, _ in pieces if g == 1) == [100, 300, 300, 300]
    assert {s for g, _, _, s in pieces if g == 3}.isdisjoint(s for g, _, _, s in pieces if g == 2)


# ------------------------------------------------------------------ mixing


def posteriors(spark, n=300, seed=1):
    r = np.random.default_rng(seed)
    p = np.round(r.dirichlet([0.3, 0.3, 0.3], n), 2)
    return spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(r.integers(0, 50, n), p)], "n_tokens bigint, p0 double, p1 double, p2 double")


def test_rates_meet_targets(spark):
    goal = [3000.0, 500.0, 1500.0]
    found, residual = mixing.fit_rates(posteriors(spark), goal)
    got = np.array([tuple(x) for x in found.collect()])
    assert len(got) == 300 and (got[:, 4] >= 0).all()
    assert np.allclose((got[:, 0] * got[:, 4]) @ got[:, 1:4], goal, rtol=1e-6) and np.abs(residual).max() < 1e-3
    # The same steps in numpy.
    rate, t = np.ones(300), got[:, 0]
    solve = np.linalg.pinv((got[:, 1:4].T * t) @ got[:, 1:4])
    for _ in range(400):
        rate = np.maximum(0, rate + got[:, 1:4] @ (solve @ (goal - (t * rate) @ got[:, 1:4])))
    assert np.allclose(rate, got[:, 4], atol=1e-6)


def brute_nnls(a, goal):
    """The least distance of nonnegative combinations of the columns of ``a`` to the
    goal, by trying every set of as many columns as there are rows."""
    import itertools

    best = np.linalg.norm(goal), np.zeros(len(goal))
    for n in range(1, len(goal) + 1):
        for some in itertools.combinations(range(a.shape[1]), n):
            x, *_ = np.linalg.lstsq(a[:, some], goal, rcond=None)
            if (x >= -1e-9).all():
                total = a[:, some] @ x
                best = min(best, (np.linalg.norm(goal - total), total), key=lambda y: y[0])
    return best


@pytest.mark.parametrize("goal", [[90_000.0, 6_000.0, 4_000.0], [0.0, 0.0, 70_000.0], [10_000.0, 60_000.0, 1_000.0]])
def test_targets_out_of_reach(spark, goal):
    """Where no rates reach the targets, the totals are those of nonnegative least
    squares, in tokens."""
    kinds = [(0.6, 0.3, 0.1), (0.5, 0.4, 0.1), (0.55, 0.25, 0.2)]
    rows = spark.createDataFrame([(100, *kinds[i % 3]) for i in range(1500)], "n_tokens bigint, p0 double, p1 double, p2 double")
    found, residual = mixing.fit_rates(rows, goal)
    got = np.array([tuple(x) for x in found.collect()])
    distance, total = brute_nnls(np.array(kinds).T, np.array(goal))
    mine = (got[:, 0] * got[:, 4]) @ got[:, 1:4]
    assert np.allclose(mine, total, atol=1e-6 * sum(goal) + 1) and np.allclose(np.linalg.norm(residual), distance, rtol=1e-6, atol=1)


def test_the_domain_to_keep_is_not_thinned_out(spark):
    """On a corpus that is nearly all good every good document stays."""
    kinds = ["toxic" if i % 60 == 0 else "low" if i % 60 == 1 else "good" for i in range(600)]
    texts = [(i, " ".join([*WORDS[i % 7 : i % 7 + 9], *{"good": [], "toxic": ["vorkel"], "low": ["zanth"]}[k]]), "en") for i, k in enumerate(kinds)]
    docs = make(spark, texts)
    labels = spark.createDataFrame([(i, int(k == "good"), int(k == "toxic")) for i, k in enumerate(kinds)], "doc_id bigint, quality int, toxic int")
    classifier = label_classifier(docs, labels)
    found = mixing.mix(docs, classifier, MIX_WEIGHTS, keep="good").collect()
    good = [x for x in found if kinds[x.doc_id] == "good"]
    assert min(x.copies for x in good) >= 1
    totals = {d: sum(x.n_tokens * x.rate * x[f"p_{d}"] for x in found) for d in MIX_WEIGHTS}
    for d, w in MIX_WEIGHTS.items():
        assert totals[d] + found[0][f"missed_{d}"] == pytest.approx(w * (sum(totals.values()) + sum(found[0][f"missed_{e}"] for e in MIX_WEIGHTS)), rel=1e-6)


def test_mix(spark, docs, rows):
    kinds = ["good", "good", "toxic", "low"]
    marked = [(4000 + i, " ".join([*WORDS[i % 7 : i % 7 + 9], *{"good": [], "toxic": ["vorkel"], "low": ["zanth"]}[kinds[i % 4]]]), "en") for i in range(200)]
    both = make(spark, marked).union(docs)
    labels = spark.createDataFrame([(4000 + i, int(kinds[i % 4] == "good"), int(kinds[i % 4] == "toxic"), "x") for i in range(200)] + [(None, 1, 1, "x"), (5, None, None, "x")], "doc_id bigint, quality int, toxic int, rate string")
    classifier = label_classifier(both, labels)
    assert classifier.markers["toxic"] == ["vorkel"] and classifier.markers["low"] == ["zanth"]
    found = mixing.mix(both, classifier, MIX_WEIGHTS)
    got = found.collect()
    assert len(got) == len(marked) + len(rows) and all(x.rate >= 0 and x.copies >= 0 for x in got)
    total = sum(x.n_tokens for x in got)
    for d, w in MIX_WEIGHTS.items():
        assert sum(x.n_tokens * x.rate * x[f"p_{d}"] for x in got) == pytest.approx(w * total, rel=1e-6)
    copies = collections.Counter()
    for x in got:
        copies[x.doc_id] += x.copies
    out = mixing.mixed(both, found)
    assert out.columns == both.columns
    assert collections.Counter(x.doc_id for x in out.collect()) == +copies
    unlabelled = mixing.learn(both, labels.limit(0), label_domain(), ["good", "low"])
    assert unlabelled.prior == [0.5, 0.5]


# ------------------------------------------------------------------ empty tables


def test_empty_tables(spark, none):
    assert simhash.near_duplicates(none).count() == simhash.keep_first(none).count() == 0
    assert exact_dedup.exact_duplicates(none).count() == exact_dedup.keep_first(none).count() == 0
    assert pii.personal_data(none).count() == sharding.assign_shards(none).count() == 0
    assert packing.pack(none, tokenizer_path()).count() == 0
    assert lm_scoring.score_documents(none).count() == 0
    assert language_id.language_id(none).count() == language_id.accepted(none).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity(none, toxicity.learn(none, labels)).count() == 0
    found = mixing.mix(none, label_classifier(none, labels), MIX_WEIGHTS)
    assert found.count() == mixing.mixed(none, found).count() == 0
