"""The pipeline's stages against brute force on a small written corpus."""

import collections
import re

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_fingerprint, corpus


def test_stages(spark, tmp_path):
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in corpus() if i is not None and i < 905 and i != 5]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, i % 2, int(i % 10 == 0)) for i in range(100)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, now, str(tmp_path)).write.parquet(out)
        columns, now = now.columns, spark.read.parquet(out)
        kept.append(now)
        assert name == "packing" or now.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert ids(kept[0]) == sorted(r[0] for r in lettered)
    first: dict[str, int] = {}
    for r in sorted(lettered):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r[0])
    assert ids(kept[1]) == sorted(first.values())
    fps = {r[0]: brute_fingerprint(r[1]) for r in lettered if r[0] in first.values()}
    root = brute_components(fps.values(), 3)
    least = collections.defaultdict(list)
    for i, f in fps.items():
        least[root[f]].append(i)
    assert ids(kept[2]) == sorted(map(min, least.values()))
    assert set(ids(kept[3])) <= set(ids(kept[2]))
    pieces = kept[4].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    copies = collections.Counter(ids(kept[3]))
    assert {r.doc_id: r["sum(length)"] for r in pieces} == {r.doc_id: copies[r.doc_id] * r["max(doc_tokens)"] for r in pieces}
    assert {r.doc_id for r in pieces} == set(copies)
