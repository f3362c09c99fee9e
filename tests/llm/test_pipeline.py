"""The pipeline's stages, each on its own input, against plain versions."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from terraloom.llm import quality, secrets
from tests.llm.test_operators import check_packing, plain_components, plain_decontamination, words_of

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus() -> tuple[dict, dict, dict]:
    rng = np.random.default_rng(12)
    passage, texts, labels = words_of(30, 500), {}, {}
    for i in range(160):
        words = words_of(80, i)
        labels[i] = int(i % 4 != 0)
        texts[i] = " ".join(w + "%%%" if i % 4 == 0 else w for w in words)
    for i in range(160, 190):  # copies with few changes
        words = texts[i - 159 if (i - 159) % 4 else 1].split()
        words[int(rng.integers(0, 80))] = "changed"
        texts[i] = " ".join(words)
    for i in range(190, 200):  # benchmark passages among own words
        texts[i] = " ".join(words_of(60, 900 + i) + passage[:20])
    for i in range(200, 206):
        texts[i] = " ".join(words_of(50, 1200 + i)) + f' password="hunter{i}x"'
    texts |= {206: None, 207: "", 208: " ".join(words_of(9000, 1))}
    return texts, labels, {1: " ".join(passage), 2: None}


def test_stages(spark, tmp_path):
    texts, labels, items = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], DOCUMENTS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, v, 0) for i, v in labels.items()], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(items.items()), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in at.collect()}
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        rows = at.collect()
        if name == "packing":
            assert check_packing(before, rows) <= 4096
            assert {r.doc_id for r in rows} == {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
            continue
        assert at.columns == docs.columns
        after = {r.doc_id: r.text for r in rows}
        if name == "quality":
            scores = {r.doc_id: r.score for r in quality.score(docs, spark.read.parquet(str(tmp_path / "labels.parquet"))).collect()}
            assert set(after) == {i for i in before if scores[i] >= quality.THRESHOLD}
            assert sum(labels[i] for i in after if i in labels) >= 0.97 * sum(labels.values())
            assert sum(1 - labels[i] for i in after if i in labels) <= 2
        elif name == "near_dedup":
            assert set(after) == {i for i, (_, c) in plain_components(before).items() if i == c}
        elif name == "decontamination":
            assert set(after) == {i for i, v in plain_decontamination(before, items).items() if not v[4]}
            assert set(before) - set(after) >= set(range(190, 200)) & set(before)
        else:
            assert {i: secrets.masked(t) for i, t in before.items()} == after
            assert all("hunter" not in (t or "") for t in after.values()) and all(r.n_chars == len(r.text or "") for r in rows)
