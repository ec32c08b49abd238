"""The corpus pipeline's stages against brute force."""

import re

import corpus_pipeline
from bunchflow.llm import packing, secrets


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    seen = [before]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = docs.collect()
        assert all(r.n_chars == len(r.text) for r in rows if r.text != before[r.doc_id])
        seen.append({r.doc_id: r.text for r in rows})
    _, good, single, clean, safe = seen

    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}

    sets = {i: shingles(t) for i, t in good.items()}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    assert len(single) == len({top(i) for i in sets}) and {top(i) for i in single} == {top(i) for i in sets}
    assert set(single) == set(clean) == set(safe)

    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))

    windows = {tuple(w[i : i + 10]) for t in items for w in [words(t)] for i in range(max(1, len(w) - 9))}
    for t in clean.values():
        w = words(t)
        # what a cut joins may not be an occurrence either way; nothing that stood there is left
        assert not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))
    for i, t in safe.items():
        assert not secrets.base_spans(t) or t == clean[i]
        assert (t != clean[i]) == bool(secrets.find(clean[i], secrets.default_formats()))

    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    ids = packing.encoder(packing.TOKENIZER, None)
    length = {}
    for r in rows:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {i: len(ids(t or "")) + 1 for i, t in safe.items()}
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
