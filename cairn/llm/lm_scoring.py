"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates,

    P(w | u) = l0 / (V + 1) + l1 c(w) / N + l2 c(u w) / c(u)   (order 2),

whose weights depend on how often the context was seen (buckets of its frequency in
powers of two) and are learned by expectation-maximisation on held-out counts: part
of the learned documents (one fold) is deleted from the counts, and the weights are
those that make that part likeliest under the counts of the others. The counts used
for scores are those of all learned documents.

The counts grow with the corpus, so they are never broadcast. Documents are encoded
into blocks of about ``block_tokens`` tokens; a block asks for the counts of its
distinct n-grams. Requests are dealt out by the n-gram's hash, summed, and answered
to the block that asked. A frequent word is one request a block, so no key is hot,
and a block's scores need nothing but its own answers. N-grams are identified by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, pick, store, utf8

END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BUCKETS = 40
GRID = 8  # cells per power of two in the held-out counts that EM reads


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def _pack_sorted(x: np.ndarray) -> bytes:
    """Sorted uint64 values as differences, byte by byte, which leaves little of the
    high bytes."""
    steps = np.diff(x, prepend=np.uint64(0))
    return _pack(steps.view(np.uint8).reshape(-1, 8).T)


def _unpack_sorted(x: bytes) -> np.ndarray:
    planes = _unpack(x, "u1").reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8")[:, 0], dtype=np.uint64)


def bucket(context: np.ndarray) -> np.ndarray:
    """The bucket of a context's frequency: 0 if never seen, else 1 + floor(log2)."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def extended(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their contexts and last tokens."""
    x = context * np.uint64(0xFF51AFD7ED558CCD) ^ (last + np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def ngrams(tokens: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order`` the hash of the n-gram that ends at each token. A
    document's first tokens have start marks as context."""
    first = np.zeros(len(tokens), bool)
    first[np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)] = True
    out = [tokens]
    for _ in range(order - 1):
        context = np.r_[START, out[-1][:-1]]  # the shorter n-gram that ends one token before
        context[first] = START
        out.append(extended(context, tokens))
    return out


def _encoded(block_tokens: int):
    """Documents to blocks. Learned ones of the deleted fold have blocks of their own."""

    def block(at: int, deleted: bool, docs: list) -> pa.RecordBatch:
        words = np.concatenate([x for _, _, x in docs])
        vocabulary, tokens = np.unique(words, return_inverse=True)
        known = np.array([i is not None for i, _, _ in docs])
        row = {
            "block": pa.array([at], pa.int64()),
            "deleted": pa.array([deleted]),
            "ids": pa.array([np.array([i or 0 for i, _, _ in docs], np.int64).tobytes()], pa.binary()),
            "known_ids": pa.array([known.tobytes()], pa.binary()),
            "held_out": pa.array([np.array([h for _, h, _ in docs], bool).tobytes()], pa.binary()),
            "lengths": pa.array([np.array([len(x) for _, _, x in docs], np.int64).tobytes()], pa.binary()),
            "vocabulary": pa.array([_pack_sorted(vocabulary)], pa.binary()),
            "tokens": pa.array([_pack(tokens.astype(np.uint32))], pa.binary()),
            "n_tokens": pa.array([len(words)], pa.int64()),
            "n_learned": pa.array([sum(not h for _, h, _ in docs)], pa.int64()),
        }
        return pa.RecordBatch.from_pydict(row)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = TaskContext.get().partitionId(), 0
        waiting: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}
        known: dict[bytes, int] = {}
        for batch in rows:
            for doc_id, f, text in zip(batch["doc_id"].to_pylist(), batch["part"].to_pylist(), utf8(batch["text"])):
                words = text.lower().split()
                if len(known) > 400_000:
                    known.clear()
                known.update((w, xxhash.xxh64_intdigest(w)) for w in words if w not in known)
                hashes = np.empty(len(words) + 1, np.uint64)
                hashes[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                hashes[-1] = END
                deleted = f == 1
                waiting[deleted].append((doc_id, f == 0, hashes))
                size[deleted] += len(hashes)
                if size[deleted] >= block_tokens:
                    yield block(part << 32 | blocks, deleted, waiting[deleted])
                    waiting[deleted], size[deleted], blocks = [], 0, blocks + 1
        for deleted, docs in waiting.items():
            if docs:
                yield block(part << 32 | blocks, deleted, docs)
                blocks += 1

    return run


ENCODED = (
    "block bigint, deleted boolean, ids binary, known_ids binary, held_out binary, lengths binary, "
    "vocabulary binary, tokens binary, n_tokens bigint, n_learned bigint"
)


def _opened(row: dict, order: int) -> tuple:
    """lengths, held out by document, and by order the distinct n-grams and each token's."""
    lengths = np.frombuffer(row["lengths"], np.int64)
    tokens = _unpack_sorted(row["vocabulary"])[_unpack(row["tokens"], "u4")]
    grams = [np.unique(x, return_inverse=True) for x in ngrams(tokens, lengths, order)]
    return lengths, np.frombuffer(row["held_out"], bool), grams


def _requests(order: int, bits: int):
    """One row per block, order and part of the hash range: the block's distinct
    n-grams and how often its learned documents have them."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                lengths, held_out, grams = _opened(row, order)
                learned = np.repeat(~held_out, lengths)
                for n, (keys, at) in enumerate(grams, 1):
                    counts = np.bincount(at, weights=learned, minlength=len(keys)).astype(np.uint32)
                    parts = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    ids, starts = np.unique(parts, return_index=True)
                    ends = [*starts[1:], len(keys)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array(ids * 8 + n, pa.int64()),
                            "block": pa.array([row["block"]] * len(ids), pa.int64()),
                            "deleted": pa.array([row["deleted"]] * len(ids)),
                            "keys": pa.array([_pack_sorted(keys[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                            "counts": pa.array([_pack(counts[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                        }
                    )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Sums one part's requests and answers each block: counts over all learned
    documents and, to blocks of the deleted fold, over those outside it. The row of
    block -1 has the number of distinct n-grams seen and the sum of their counts."""
    keys = [_unpack_sorted(x.as_py()) for x in table["keys"]]
    deleted = table["deleted"].to_pylist()
    cut = np.cumsum([0, *map(len, keys)])
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    mine = [at[a:b] for a, b in zip(cut, cut[1:])]
    total, rest = np.zeros(len(every), np.uint64), np.zeros(len(every), np.uint64)
    for x, counts, d in zip(mine, table["counts"], deleted):  # a block has a key once
        total[x] += (n := _unpack(counts.as_py(), "u4"))
        if not d:
            rest[x] += n
    part = table["part"][0].as_py()
    return pa.table(
        {
            "block": pa.array([*table["block"].to_pylist(), -1], pa.int64()),
            "part": pa.array([part] * (len(mine) + 1), pa.int64()),
            "total": pa.array([*[_pack(total[x]) for x in mine], b""], pa.binary()),
            "rest": pa.array([*[_pack(rest[x]) if d else None for x, d in zip(mine, deleted)], None], pa.binary()),
            "n_seen": pa.array([None] * len(mine) + [int((total > 0).sum())], pa.int64()),
            "n_tokens": pa.array([None] * len(mine) + [int(total.sum())], pa.int64()),
            "n_rest": pa.array([None] * len(mine) + [int(rest.sum())], pa.int64()),
        }
    )


ANSWERS = "block bigint, part bigint, total binary, rest binary, n_seen bigint, n_tokens bigint, n_rest bigint"


def _counted(answers: pa.Table, which: str, order: int) -> list[np.ndarray]:
    """A block's answers by order, in the order of its sorted n-grams."""
    out: list[list] = [[] for _ in range(order)]
    for part, blob in sorted(zip(answers["part"].to_pylist(), answers[which].to_pylist())):
        out[part % 8 - 1].append(_unpack(blob, "<u8").astype(np.float64))
    return [np.concatenate(x) for x in out]


def _estimates(grams, counts, lengths, corpus: dict) -> tuple[np.ndarray, np.ndarray]:
    """Per token the frequency of its longest context and the maximum-likelihood
    estimates by order, the uniform one first."""
    of = [c[at] for c, (_, at) in zip(counts, grams)]
    first = np.zeros(len(of[0]), bool)
    first[np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)] = True
    p = [np.full(len(of[0]), 1 / (corpus["types"] + 1)), of[0] / max(corpus["tokens"], 1)]
    context = np.full(len(of[0]), float(corpus["tokens"]))
    for n in range(1, len(of)):
        # The context of an n-gram is the (n-1)-gram that ends one token before it.
        seen = np.r_[corpus["documents"], of[n - 1][:-1]]
        seen[first] = corpus["documents"]
        p.append(np.where(seen > 0, of[n] / np.maximum(seen, 1), 0))
        context = seen
    return context, np.stack(p, axis=1)


def _held_out_counts(order: int, corpus: dict):
    """Cells of the deleted fold's tokens: their bucket and the logarithms of their
    estimates on a grid, with the number of tokens and the estimates' sums."""

    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        names = [f"g{i}" for i in range(1, order + 1)]
        row = blocks.to_pylist()[0]
        lengths, _, grams = _opened(row, order)
        context, p = _estimates(grams, _counted(answers, "rest", order), lengths, corpus)
        grid = np.where(p > 0, np.round(GRID * np.log2(np.maximum(p, 1e-300))), 1).astype(np.int64)[:, 1:]
        cells, at = np.unique(np.c_[bucket(context), grid], axis=0, return_inverse=True)
        at = at.ravel()
        sums = [np.bincount(at, weights=p[:, i + 1], minlength=len(cells)) for i in range(order)]
        return pa.table({"b": cells[:, 0], **{g: cells[:, i + 1] for i, g in enumerate(names)}, "n": np.bincount(at).astype(np.float64), **{f"s{i + 1}": s for i, s in enumerate(sums)}})

    return run


def learn_weights(cells: list[dict], order: int, uniform: float, rounds: int = 200) -> np.ndarray:
    """Mixture weights, a row for each bucket, by EM on the held-out cells. A bucket
    without held-out tokens takes the weights learned over all of them; with none at
    all, weights are even. A little of the uniform estimate stays in every mixture."""
    even = np.full(order + 1, 1 / (order + 1))
    out = np.tile(even, (BUCKETS, 1))
    if not cells:
        return out
    b = np.array([c["b"] for c in cells])
    n = np.array([c["n"] for c in cells], float)
    p = np.stack([np.full(len(n), uniform)] + [np.array([c[f"s{i}"] for c in cells]) / n for i in range(1, order + 1)], axis=1)

    def learned(some: np.ndarray) -> np.ndarray:
        weights = even.copy()
        for _ in range(rounds):
            joint = weights * p[some]
            after = (n[some, None] * joint / np.maximum(joint.sum(1, keepdims=True), 1e-300)).sum(0)
            after /= after.sum()
            done = np.abs(after - weights).max() < 1e-9
            weights = after
            if done:
                break
        weights = np.maximum(weights, 1e-6)
        return weights / weights.sum()

    out[:] = learned(np.ones(len(n), bool))
    for x in np.unique(b):
        out[x] = learned(b == x)
    return out


def _scores(order: int, corpus: dict, weights: np.ndarray, train_tokens: int):
    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        lengths, held_out, grams = _opened(row, order)
        counts = _counted(answers, "total", order)
        context, p = _estimates(grams, counts, lengths, corpus)
        starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
        model = np.log10((weights[bucket(context)] * p).sum(1))
        c = counts[0][grams[0][1]]
        base = np.log10((c + 0.1) / (train_tokens + 0.1 * (corpus["types"] + 1)))
        known = np.frombuffer(row["known_ids"], bool)
        return pa.table(
            {
                "doc_id": pa.array(np.frombuffer(row["ids"], np.int64), mask=~known),
                "held_out": pa.array(held_out),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                "train_tokens": pa.array([train_tokens] * len(lengths), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, starts)),
                "score": pa.array(np.add.reduceat(model, starts)),
            }
        )

    return run


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
    part: Column | None = None,
    block_tokens: int = 800_000,
    part_ngrams: int = 1_000_000,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row
    per row of ``docs``.

    ``part`` (default: crc32 of the id as text, modulo 10) is 0 for documents that are
    not learned from, 1 for the deleted fold. A-Z count as a-z, words are separated by
    white space, and one end mark follows them: NULL and empty texts are one token.
    ``score`` is the model's log10 probability of the text, ``base_score`` that of a
    unigram model with 0.1 added to each count; ``n_known`` counts tokens seen in the
    ``train_tokens`` learned ones. Nothing learned: uniform over one unknown type. Ids
    are integers; repeated rows are scored, and learned, each. No documents, no rows.
    """
    if not 1 <= order <= 7:
        raise ValueError("order must be from 1 to 7")
    key = F.col("doc_id")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", key.cast("long"))
    rows = rows.withColumn("part", (fold(key, 10) if part is None else part).cast("int"))
    encoded = store(rows.mapInArrow(_encoded(block_tokens), ENCODED), "lm-blocks")
    size = encoded.agg(
        F.sum("n_tokens").alias("tokens"),
        F.sum("n_learned").alias("documents"),
        F.sum(F.when(~F.col("deleted"), F.col("n_learned"))).alias("rest"),
    ).first()
    # As many parts as keep one part's n-grams in a task's memory, at any input size.
    bits = max(0, (order * (size["tokens"] or 0) // part_ngrams).bit_length())
    requests = encoded.mapInArrow(_requests(order, bits), "part bigint, block bigint, deleted boolean, keys binary, counts binary")
    answers = store(requests.groupBy("part").applyInArrow(_answer, ANSWERS), "lm-answers")
    seen = answers.where("block = -1 and part % 8 = 1").agg(F.sum("n_seen"), F.sum("n_tokens"), F.sum("n_rest")).first()
    types, tokens, rest = (int(x or 0) for x in seen)
    asked = answers.where("block >= 0").select("block", "part", "total", "rest")

    deleted = encoded.where("deleted").groupBy("block").cogroup(asked.join(encoded.where("deleted").select("block"), "block", "left_semi").groupBy("block"))
    grid = ", ".join(f"g{i} bigint" for i in range(1, order + 1))
    sums = ", ".join(f"s{i} double" for i in range(1, order + 1))
    without = {"types": types, "tokens": rest, "documents": size["rest"] or 0}
    cells = deleted.applyInArrow(_held_out_counts(order, without), f"b bigint, {grid}, n double, {sums}")
    cells = cells.groupBy("b", *[f"g{i}" for i in range(1, order + 1)]).agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(1, order + 1)])
    # The grid bounds the cells that the driver gets, however large the corpus.
    weights = learn_weights([x.asDict() for x in cells.collect()], order, 1 / (types + 1))

    corpus = {"types": types, "tokens": tokens, "documents": size["documents"] or 0}
    whole = encoded.groupBy("block").cogroup(asked.groupBy("block"))
    return whole.applyInArrow(_scores(order, corpus, weights, tokens), SCORES)
