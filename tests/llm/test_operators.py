"""Each operator against a plain version on small tables that hold nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re
import shutil
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terraloom.llm import decontamination, language_id, language_model, media, near_dedup, packing, quality, secrets, token_counts, toxicity
from terraloom.llm.common import hashed_words, labelled_sample, spaced_words
from terraloom.llm.tokens import encoded, vocabulary

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id bigint"


def words_of(n: int, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(n)]


def table(spark, texts: dict[int, str | None], langs: dict[int, str] | None = None):
    rows = [(i, t, (langs or {}).get(i), None if i % 2 else f"s{i % 3}", len(t or ""), 0.5, 7) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def passage() -> list[str]:
    return words_of(40, 1)


# --- decontamination ----------------------------------------------------------------------------------------------


def plain_decontamination(docs: dict, items: dict) -> dict:
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    windows: dict[tuple, set] = {}
    for item, text in items.items():
        w = split(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for doc, text in docs.items():
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_decontamination(spark, passage):
    other = words_of(400, 2)
    items = {10: " ".join(passage[:20]), 9: ", ".join(passage[5:30]).upper(), 3: "two words", 4: "...", 5: None, 6: " ".join(passage[:20])}
    docs = {
        1: " ".join(passage), 2: None, 3: "", 4: "?!", 5: " ".join(other), 6: " ".join(other[:100] + passage[2:18] + other[100:]), 7: "say Two-WORDS, two words!",
        8: " ".join(passage[:12]), 9: " ".join(other * 10 + passage[:14]), 10: "é" + " ".join(passage[:13]) + "é", 11: " ".join(passage[:13]).title(),
        12: " ".join(other * 50 + passage + other * 50), 13: "two words " * 10_000,
    }
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.report(table(spark, docs), bench).collect()}
    assert got == plain_decontamination(docs, items)
    joined = decontamination.scan(table(spark, docs), bench, broadcast_bytes=0)
    assert {(r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in joined.collect()} == {(i, *v[:3]) for i, v in got.items()}
    twice = table(spark, docs).unionByName(table(spark, docs))
    assert Counter((r.doc_id, r.n_words, r.n_hit) for r in decontamination.report(twice, bench).collect()) == Counter({(i, v[0], v[1]): 2 for i, v in got.items()})
    kept = decontamination.without_contaminated(table(spark, docs), bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, v in got.items() if not v[4]}
    assert kept.columns == table(spark, docs).columns
    cut = {r.doc_id: r.text for r in decontamination.without_spans(table(spark, docs), bench).collect()}
    assert cut[7] == "say " and cut[5] == docs[5] and cut[2] is None
    assert cut[6].split() == other[:100] + [w for k, w in enumerate(passage[2:18])][:0] + other[100:]
    empty = table(spark, {})
    assert decontamination.report(empty, bench).count() == 0
    assert {r.n_hit for r in decontamination.report(table(spark, docs), bench.limit(0)).collect()} == {0}


# --- token counts -------------------------------------------------------------------------------------------------


def test_token_counts(spark, tmp_path):
    texts = {1: "a b\na b\nc", 2: "a b\na b\nc", 3: None, 4: "", 5: "Hello, world", 6: "Hello, world", 7: "x " * 5000}
    rows = token_counts.measured(table(spark, texts)).cache()
    path = vocabulary("word_bpe_49k.json")
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"))
    got = {(r.source, r.tokenizer): (r.docs, r.tokens) for r in token_counts.maintained(rollup, rows).collect()}
    expected: dict = {}
    seen = set()
    for i, t in texts.items():
        if (t or "") in seen:
            continue
        seen.add(t or "")
        tidy = token_counts.tidied(t or "")
        for name, n in ((token_counts.WORDS, len(tidy.split())), (token_counts.BPE, len(encoded([tidy], path)[0]))):
            old = expected.get((None if i % 2 else f"s{i % 3}", name), (0, 0))
            expected[None if i % 2 else f"s{i % 3}", name] = (old[0] + 1, old[1] + n)
    assert got == expected
    before = sorted(map(tuple, rollup.totals().collect()), key=str)
    assert not rollup.commit("insert", token_counts.changes(rows, 1))
    rollup.compact()
    assert rollup.state() == (1, ["delete-copies", "insert", "revise"], [])
    assert not rollup.commit("insert", token_counts.changes(rows, 1))
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == before
    assert rollup.commit("more", token_counts.changes(rows, 1)) and rollup.commit("less", token_counts.changes(rows, -1))
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == before
    # A batch without its commit is not counted and can be sent again.
    shutil.rmtree(tmp_path / "rollup" / "commits" / "more")
    assert rollup.state()[2] == ["less"] and rollup.commit("more", token_counts.changes(rows, 1))
    rollup.compact()
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == before
    assert token_counts.Rollup(spark, str(tmp_path / "none")).totals().count() == 0
    with pytest.raises(ValueError):
        rollup.commit("../x", token_counts.changes(rows, 1))


# --- packing ------------------------------------------------------------------------------------------------------


def check_packing(texts: dict, pieces: list) -> int:
    """Asserts the round trip; returns the padding."""
    path = vocabulary("word_bpe_49k.json")
    windows, docs = {}, {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append(p)
        docs.setdefault(p.doc_id, []).append(p)
    assert set(docs) == set(texts)
    for i, t in texts.items():
        ids = np.append(encoded([t or ""], path)[0], np.uint32(2))
        at = 0
        for p in sorted(docs[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].astype("<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for own in windows.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_packing(spark):
    rng = np.random.default_rng(3)
    texts = {i: " ".join(words_of(int(rng.integers(1, 900)), i)) for i in range(60)}
    texts |= {60: None, 61: "", 62: " ".join(words_of(9000, 5)), 63: "Same", 64: "Same"}
    docs = table(spark, texts).repartition(3)
    pieces = packing.pack(docs).cache()
    padding = check_packing(texts, pieces.collect())
    assert padding <= 4096
    facts = packing.padding(pieces).first()
    assert facts["padding"] == padding
    # Windows of a tier are dealt evenly over groups.
    deal = Counter((r.context, r.step_group) for r in pieces.where("offset = 0 AND context = 4096").collect())
    assert max(deal.values()) <= 1 + min(1, len(deal))
    assert packing.pack(table(spark, {})).count() == 0
    again = packing.pack(docs.unionByName(docs)).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] for r in again} == {p.doc_id: 2 * p.doc_tokens for p in pieces.collect()}


def test_packing_holds_few_empty_texts(spark, monkeypatch):
    """Empty texts count as rows: the pool of open pieces stays small whatever their number."""
    most, plainly = [0], packing.Packer.fill

    def watched(self, last=False):
        most[0] = max(most[0], len(self.pool))
        return plainly(self, last)

    monkeypatch.setattr(packing.Packer, "fill", watched)
    packer, n = packing.Packer(0), 60_000
    for i in range(n):
        packer.add(i, np.array([packing.END], np.uint32))
    assert len(packer.fill(last=True)) == n
    empties = spark.range(n, numPartitions=1).selectExpr("id AS doc_id", "CAST(NULL AS string) AS text")
    got = packing.pack(empties)
    assert got.count() == n and got.agg({"length": "sum"}).first()[0] == n
    windows = got.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert len(windows) == -(-n // 512) or max(r[1] for r in windows) <= 4096


def test_tokens_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rng = np.random.default_rng(17)
    letters = list("abc XYZ  \n\t.,'-_0123éßİΣ中文 \u200d\u0301😀")
    texts = ["", " ", "Hello, World!", "don't STOP", "a" * 400] + ["".join(rng.choice(letters, int(rng.integers(1, 60)))) for _ in range(400)]
    for text, ids in zip(texts, encoded(texts, path), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


# --- classifiers --------------------------------------------------------------------------------------------------


def good_and_bad(n: int) -> tuple[dict, dict]:
    texts, labels = {}, {}
    for i in range(n):
        words = words_of(60, i)
        bad = i % 4 == 0
        texts[i] = " ".join(w + "%%%" if bad else w for w in words)
        labels[i] = 0 if bad else 1
    return texts, labels


def accuracy(rows, labels: dict) -> float:
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    return float(np.mean([r.predicted == labels[r.doc_id] for r in held]))


def test_quality(spark):
    texts, labels = good_and_bad(200)
    texts |= {1000: None, 1001: "", 1002: "%%% " * 40_000}
    docs = table(spark, texts)
    marks = spark.createDataFrame([(i, v, 0) for i, v in labels.items()], "doc_id bigint, quality int, toxic int")
    rows = quality.score(docs, marks).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert accuracy(rows, labels) > 0.95
    kept = quality.accepted(docs, marks)
    assert kept.columns == docs.columns and 1002 not in {r.doc_id for r in kept.collect()}
    assert {r.score for r in quality.score(docs, marks.limit(0)).collect()} == {0.5}
    assert quality.score(table(spark, {}), marks).count() == 0


def plain_quality(net: quality.Network, text: bytes) -> float:
    """One text, one chunk and one filter place at a time."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    n = max(2, -(-len(text) // 64)) * 64
    data = text + bytes(n + 4 - len(text))
    answers = np.array([p["bias"] + np.concatenate([p["embed"][b] for b in data[at : at + 8]]) @ np.concatenate([p["first"], p["second"]]) for at in range(0, n, 4)])
    hidden = []
    for chunk in range(0, n - 64, 64):
        pooled = np.maximum(answers[chunk // 4 : chunk // 4 + 32].max(axis=0), 0)
        hidden.append(np.maximum(pooled @ p["mix"] + p["mix_bias"], 0))
    return float(1 / (1 + np.exp(-(np.mean(hidden, axis=0) @ p["out"] + p["out_bias"][0]))))


def test_quality_scores_are_those_of_a_plain_network(monkeypatch):
    net = quality.Network(3)
    net.fitted = True
    texts = [b"", b"x", b"short text", " ".join(words_of(30, 1)).encode(), " ".join(words_of(90, 2)).encode(), "é中".encode() * 50, b"y" * 128, b"z" * 129]
    plain = [plain_quality(net, t) for t in texts]
    arrays = [np.frombuffer(t, np.uint8) for t in texts]
    assert np.allclose(net.scores(arrays), plain, atol=1e-5)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 128)
    assert np.allclose([net.scores([t])[0] for t in arrays], plain, atol=1e-5)


def peak_mb(code: str) -> float:
    """The most memory that a fresh interpreter takes for a piece of code, beyond what it had before."""
    lines = ["import resource, numpy as np", "peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024", *code.strip().splitlines(), "print(peak() - before)"]
    return float(subprocess.run([sys.executable, "-c", "\n".join(lines)], capture_output=True, check=True, text=True).stdout)


def test_long_texts_take_bounded_memory():
    data = "text = np.frombuffer(b'some words, and more of them 123 ' * (1 << 21), np.uint8)\nbefore = peak()"
    assert peak_mb(f"from terraloom.llm import quality\nnet = quality.Network()\nnet.fitted = True\n{data}\nnet.scores([text])") < 300
    assert peak_mb(f"from terraloom.llm import toxicity\nc = toxicity.Classifier()\nc.fitted = True\n{data}\nc.scores(text, np.array([0, len(text)]))") < 300


def test_quality_gradients():
    net = quality.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = [np.frombuffer(t.encode(), np.uint8) for t in ("short", " ".join(words_of(80, 1)), "")]
    y = np.array([0.0, 1.0, 1.0])

    def loss() -> float:
        p = quality.sigmoid(net.logits(texts).astype(float))
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    found = net.gradients(texts, y)
    rng = np.random.default_rng(0)
    for name, g in found.items():
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in g.shape)
            old, step = net.p[name][at], 1e-5
            net.p[name][at] = old + step
            up = loss()
            net.p[name][at] = old - step
            slope = (up - loss()) / (2 * step)
            net.p[name][at] = old
            assert slope == pytest.approx(float(g[at]), abs=1e-4), name


def test_toxicity(spark):
    texts, labels = {}, {}
    for i in range(300):
        words = words_of(40, i)
        if i % 5 == 0:
            words[i % 37] = "worthless"
            words[(i * 7) % 31] = "stupid"
        texts[i], labels[i] = " ".join(words), int(i % 5 == 0)
    texts |= {1000: None, 1001: "", 1002: "...", 1003: "abc worthles stupidd " + " ".join(words_of(30, 7777))}
    docs = table(spark, texts)
    marks = spark.createDataFrame([(i, 1, v) for i, v in labels.items()], "doc_id bigint, quality int, toxic int")
    rows = toxicity.score(docs, marks).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert accuracy(rows, labels) > 0.95
    assert by_id[1003].predicted == 1 and by_id[1001].score == by_id[1000].score == by_id[1002].score < 0.3
    assert {r.score for r in toxicity.score(docs, marks.limit(0)).collect()} == {0.0}


def plain_toxicity(c: toxicity.Classifier, text: str) -> float:
    """One word and one gram at a time."""
    words = [w for w in re.split(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.encode().translate(bytes(toxicity._FOLDED.tolist()))) if w.strip()]
    words = [w for w in b" ".join(words).split(b" ") if w]

    def bucket(gram: bytes) -> int:
        h = len(gram)
        for b in gram:
            h = ((h ^ b) * 0x01000193) & 0xFFFFFFFF
            h ^= h >> 15
        return h & (toxicity.BUCKETS - 1)

    logits = []
    for at in range(0, len(words), 3):
        grams = [(b" " + w + b" ")[i : i + n] for w in words[at : at + 3] for n in (3, 4, 5) for i in range(len(w) + 3 - n)]
        logits.append(sum(float(c.weights[bucket(g)]) for g in grams) / max(len(grams), 1) + c.bias)
    if not logits:
        return float(toxicity.sigmoid(np.array([c.bias]))[0])
    share = np.exp(np.array(logits) - max(logits))
    return float(toxicity.sigmoid(np.array([(share * logits).sum() / share.sum()]))[0])


def test_toxicity_scores_are_those_of_a_plain_sum(monkeypatch):
    c = toxicity.Classifier()
    c.weights = np.random.default_rng(2).normal(0, 3, toxicity.BUCKETS).astype(np.float32)
    c.bias, c.fitted = -0.7, True
    texts = ["", "...", "a", "Hello", "one Two three FOUR", ", ".join(words_of(50, 3)), "é中 x" * 30, "a" * 300, " a b ", "x-y_z 12 " * 40]
    plain = [plain_toxicity(c, t) for t in texts]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in data])])
    assert np.allclose(c.scores(np.frombuffer(b"".join(data), np.uint8), offsets), plain, atol=1e-5)
    for block in (7, 64):
        monkeypatch.setattr(toxicity, "BLOCK_BYTES", block)
        assert np.allclose([c.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in data], plain, atol=1e-5)


def test_toxicity_learns_down_the_slope():
    """Training lowers the loss of what it is trained on."""
    sample = [(" ".join(words_of(12, i) + (["stupid"] if i % 3 == 0 else [])), int(i % 3 == 0)) for i in range(60)]
    loss = lambda c: np.mean([-np.log(p if v else 1 - p) for (t, v), p in ((x, np.clip(plain_toxicity(c, x[0]), 1e-9, 1 - 1e-9)) for x in sample)])
    assert loss(toxicity.Classifier().fit(sample)) < 0.1


def test_samples_skip_long_texts_before_they_are_bounded(spark):
    texts = {i: "long " * 4000 if i < 40 else " ".join(words_of(9, i)) for i in range(60)}
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in texts] * 2, "doc_id bigint, quality int, toxic int")
    for per, expected in ((5, 5), (100, 10)):
        got = labelled_sample(table(spark, texts), marks, "quality", F.lit(True), {0: per, 1: per}, 8000)
        assert Counter(v for _, v in got) == {0: expected, 1: expected}, got
    none = table(spark, {})
    assert toxicity.score(none, marks).count() == 0 and language_id.predict(none).count() == 0
    twice = table(spark, {1: "a b", 2: None})
    assert sorted(r.doc_id for r in toxicity.score(twice.unionByName(twice), marks).collect()) == [1, 1, 2, 2]
    assert sorted(r.doc_id for r in quality.score(twice.unionByName(twice), marks).collect()) == [1, 1, 2, 2]


def test_language_scores_are_those_of_a_plain_ridge():
    rng = np.random.default_rng(4)
    sample = [("".join(rng.choice(list(letters), 60)), lang) for lang, letters in (("aa", "abcd "), ("bb", "cdef ")) for _ in range(30)]
    table_ = language_id.alphabet_of([t for t, _ in sample])
    model = language_id.Model(table_, sample)
    sets = lambda t: set(np.concatenate(language_id.codes(t, table_)[0]).tolist())
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    every = [sets(t) for t, _ in sample]
    # Landmarks are all 60 texts, so the approximation is the kernel itself: solve by duals.
    gram = np.array([[kernel(a, b) for b in every] for a in every])
    y = np.array([[1.0 if v == k else -1.0 for k in ("aa", "bb")] for _, v in sample])
    dual = np.linalg.solve(gram + language_id.RIDGE * len(sample) * np.eye(len(sample)), y - y.mean(axis=0))
    fresh = ["".join(rng.choice(list("abcdef "), 50)) for _ in range(20)]
    margins = np.array([[kernel(sets(t), b) for b in every] for t in fresh]) @ dual + y.mean(axis=0)
    names, scores = model.predictions(fresh)
    assert names == [("aa", "bb")[k] for k in margins.argmax(axis=1)]
    raised = np.exp(language_id.SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
    assert np.allclose(scores, raised.max(axis=1) / raised.sum(axis=1), atol=1e-3)


def test_language_bounds(spark, monkeypatch):
    """With more languages than landmarks, each is still learned; with more than are taken, the rest are never said."""
    monkeypatch.setattr(language_id, "LANDMARKS_IN_ALL", 8)
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts, langs = {}, {}
    for i in range(390):
        rng, k = np.random.default_rng(i), i % 13
        texts[i], langs[i] = "".join(rng.choice(list(letters[2 * k : 2 * k + 2] + " "), 40)), f"l{k:02}"
    rows = language_id.predict(table(spark, texts, langs)).collect()
    seen = {r.lang_pred for r in rows}
    assert len(seen) <= 12
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and langs[r.doc_id] in seen]
    assert np.mean(held) > 0.9


def test_language_id(spark):
    texts, langs = {}, {}
    alphabets = {"aa": "abcdefg ", "bb": "defghij ", "cc": "ghijklé "}
    for i in range(150):
        lang = list(alphabets)[i % 3]
        rng = np.random.default_rng(i)
        texts[i], langs[i] = "".join(rng.choice(list(alphabets[lang]), 120)), lang
    texts |= {1000: None, 1001: "", 1002: "12 ...", 1003: "中文", 1004: "abc " * 30_000}
    docs = table(spark, texts, langs)
    rows = {r.doc_id: r for r in language_id.predict(docs).collect()}
    assert len(rows) == len(texts)
    held = [r for r in rows.values() if r.held_out and r.doc_id in langs]
    assert held and all(r.lang_pred == langs[r.doc_id] for r in held)
    assert [rows[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert rows[1003].lang_pred in alphabets and rows[1004].lang_pred == "aa"
    assert {r.lang_pred for r in language_id.predict(table(spark, texts)).collect()} == {"und"}


def test_language_kernel_matches_sets():
    texts = ["Abc é", "abd", "xyz abc"]
    sample = [(t, str(i)) for i, t in enumerate(texts)]
    table_ = language_id.alphabet_of(texts)
    model = language_id.Model(table_, sample)
    sets = [set(np.concatenate(language_id.codes(t, table_)[0]).tolist()) for t in texts]
    kernel = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    assert np.allclose(model.marks.T @ model.marks, kernel, atol=1e-6)
    phi, _ = model.features(texts)
    assert np.allclose(phi @ phi.T, kernel, atol=1e-5)


# --- near-duplicates ----------------------------------------------------------------------------------------------


def plain_components(texts: dict) -> dict:
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("block", [2048, 16])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = np.random.default_rng(9)
    texts: dict[int, str | None] = {0: None, 1: "", 2: " \n", 3: "one two", 4: "One TWO", 5: "one two three"}
    base, at = words_of(200, 77), 10
    for k in range(120):  # a group of copies with up to a tenth of the words changed, and exact copies of some
        own = list(base)
        for j in rng.integers(0, 200, int(rng.integers(0, 14))):
            own[j] = f"new{k}x{j}"
        texts[at] = " ".join(own)
        at += 1
        if k % 10 == 0:
            texts[at] = " ".join(own).upper()
            at += 1
    for k in range(30):  # documents that share a passage only
        texts[at] = " ".join(words_of(60, 1000 + k) + base[:50])
        at += 1
    texts[at] = " ".join(words_of(30_000, 4242))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table(spark, texts)).collect()}
    assert got == plain_components(texts)
    kept = near_dedup.without_near_duplicates(table(spark, texts))
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in got.items() if i == c}
    assert near_dedup.near_duplicates(table(spark, {})).count() == 0


def test_near_duplicates_without_or_with_repeated_ids(spark):
    a, b, c, d = (" ".join(words_of(40, seed)) for seed in (201, 202, 203, 204))
    near = lambda t: t.rsplit(" ", 1)[0]
    rows = [(None, a), (None, b), (1, a), (2, c), (2, c), (3, c), (4, b), (4, near(a)), (5, d), (5, near(b)), (6, None), (6, d), (5, None), (7, near(d)), (7, near(c)), (7, "")]
    # Each row is a document of its own; a plain run over row numbers gives its component, which bears the least id.
    numbered = {i: t for i, (k, t) in enumerate(rows) if k is not None}
    plain = {i: c for i, (_, c) in plain_components(numbered).items()}
    name = {c: min(rows[i][0] for i in plain if plain[i] == c) for c in plain.values()}
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id bigint, text string, digest int, first string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect())
    assert got == Counter((k, name[plain[i]] if i in plain else None, k is None or k == name[plain[i]]) for i, (k, _) in enumerate(rows))
    kept = near_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert found == Counter([(None, a), (None, b), (1, a), (2, c), (4, b), (5, d), (5, None), (6, None), (7, "")])


def test_near_duplicates_in_hot_buckets(spark, monkeypatch):
    """Texts of one template, near copies among them: no bucket is dealt block by block, all links are found."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "HOT", 16)
    template, texts = words_of(70, 300), {}
    for k in range(150):
        texts[k] = " ".join(template + words_of(40, 400 + k))
        if k % 3 == 0:
            texts[1000 + k] = " ".join(template[1:] + words_of(40, 400 + k))
    met = []
    plainly = near_dedup.crossing_pairs

    def watched(mixed, classes, closest, banded):
        met.append((banded, mixed.agg({"members": "max"}).first()[0] or 0))
        return plainly(mixed, classes, closest, banded)

    monkeypatch.setattr(near_dedup, "crossing_pairs", watched)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table(spark, texts)).collect()}
    assert got == plain_components(texts)
    assert any(not banded for banded, _ in met) and max(n for _, n in met) <= 16


def test_odd_sketch_estimates():
    rng = np.random.default_rng(4)
    for n in (60, 500, 5000):
        misses = 0
        for _ in range(40):
            shared = rng.integers(0, 1 << 63, int(n * 0.86), np.uint64)
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, n - len(shared), np.uint64)]) * np.uint64(2)) for _ in range(2))
            differing = int(np.bitwise_count(near_dedup._odd_sketch(a).view(np.uint64) ^ near_dedup._odd_sketch(b).view(np.uint64)).sum())
            misses += differing > near_dedup._most_bits(np.array([float(len(a))]), float(len(b)), near_dedup._ARRAYS)[0]
        assert misses == 0


def test_odd_sketch_allows_five_standard_errors_at_the_threshold():
    rng = np.random.default_rng(12)
    for n in (60, 500, 3000, 6000, 20_000):
        common, bits = round(n * 6 / 7), []  # a similarity of 0.75
        for _ in range(200):
            every = rng.integers(0, 1 << 64, 2 * n - common, np.uint64)
            a, b = (near_dedup._odd_sketch(np.sort(x)).view(np.uint64) for x in (every[:n], np.concatenate([every[:common], every[n:]])))
            bits.append(int(np.bitwise_count(a ^ b).sum()))
        most = float(near_dedup._most_bits(np.array([float(n)]), float(n), near_dedup._ARRAYS)[0])
        assert most - np.mean(bits) > 4.4 * np.std(bits), (n, most, np.mean(bits), np.std(bits))


# --- secrets ------------------------------------------------------------------------------------------------------


def der(tag: int, body: bytes) -> bytes:
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def rsa_key() -> bytes:
    return der(0x30, der(2, b"\0") + b"".join(der(2, bytes([i]) * 30) for i in range(1, 9)))


def test_secrets(spark):
    blob = base64.b64encode(rsa_key()).decode()
    lines = "\n".join(blob[i : i + 64] for i in range(0, len(blob), 64))
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': 'someone'})}.c2lnbmF0dXJl"
    fields = [b"none", b"none", b""]
    ssh = b"openssh-key-v1\0" + b"".join(len(f).to_bytes(4, "big") + f for f in fields) + (1).to_bytes(4, "big") + b"".join(len(f).to_bytes(4, "big") + f for f in (b"p" * 40, b"q" * 90))
    texts = {
        1: None, 2: "", 3: "é password = \"abc123\" and PASSWD:'x1' token=short", 4: "AKIA" + "A1" * 8 + " AKIAshort AKIAB", 5: "0" * 23 + " " + "ab" * 12 + "g",
        6: f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----", 7: f"x {token} y", 8: base64.b64encode(ssh).decode(), 9: "A" * 60, 10: rsa_key().hex(),
        11: f"{part({'typ': 'JWT'})}.{part({})}.x", 12: "secret: token: abcdef", 13: "ſecret=abcdefgh toKen=abcdefgh", 14: base64.b64encode(rsa_key()[:-3]).decode(), 15: "word " * 30_000 + "api_key=abcdefg",
    }
    rows = {r.doc_id: r for r in secrets.report(table(spark, texts)).collect()}
    assert len(rows) == len(texts)
    assert rows[1].spans == rows[2].spans == "" and rows[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[3].spans == "assign:2:20" and rows[3].n_assign == 1
    assert rows[4].spans == "access:0:20" and rows[4].n_access == 1
    assert rows[5].spans == "hex:24:48"
    start = texts[6].index(blob[:20])
    assert rows[6].spans == f"der:{start}:{start + len(lines)}"
    assert rows[7].spans == f"jwt:2:{2 + len(token)}"
    assert rows[8].spans.startswith("openssh:0:")
    assert rows[9].spans == rows[11].spans == rows[14].spans == ""
    assert rows[10].spans == f"hex:0:{len(texts[10])},der:0:{len(texts[10])}" and rows[10].n_hex == 1
    assert rows[12].spans == "" and rows[13].spans == "assign:16:30" and rows[15].spans == "assign:150000:150015"
    clean = {r.doc_id: r for r in secrets.redacted(table(spark, texts)).collect()}
    assert clean[3].text == "é [SECRET]\" and PASSWD:'x1' token=short" and clean[3].n_chars == len(clean[3].text)
    assert clean[9].text == texts[9] and clean[1].text is None and blob[:20] not in clean[6].text
    assert secrets.report(table(spark, {})).count() == 0


# --- language model -----------------------------------------------------------------------------------------------


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(language_model, "TABLE_ROWS", 30)
    monkeypatch.setattr(language_model, "CLUSTERED", 12)
    rng = np.random.default_rng(2)
    common = words_of(40, 3)
    texts: dict[int, str | None] = {i: " ".join(rng.choice(common, 50, p=np.arange(40, 0, -1) / 820)) + f" only{i} Two!" for i in range(60)}
    texts |= {100: None, 101: "", 102: " \n\t", 103: "unseen words here", 104: "the " * 40_000}
    scored = language_model.score(table(spark, texts))
    rows = {r.doc_id: r for r in scored.collect()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII_LOWER)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for i, t in tokens.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(counts[w] > 0 for w in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t), rel=1e-9)
        assert r.score < 0
    assert language_model.score(table(spark, {})).count() == 0


def test_counting_holds_no_batch_of_words(monkeypatch):
    """A batch of 1.2 million words is counted block by block: right sums, however often parts are passed on, and no arrays of all its words."""

    class Captured:  # a DataFrame that hands out the function it is given
        sparkContext = property(lambda self: self)
        sparkSession = property(lambda self: self)
        select = where = groupBy = agg = lambda self, *a: self
        broadcast = lambda self, value: type("Shared", (), {"value": value})

        def mapInArrow(self, run, schema):
            self.run = run
            return self

    monkeypatch.setattr(language_model, "_rows", lambda docs: docs)
    monkeypatch.setattr(language_model, "_in_training", lambda c: c)
    monkeypatch.setattr(language_model, "F", MagicMock())
    words = np.array(words_of(3000, 4))
    rng = np.random.default_rng(5)
    texts = [" ".join(words[rng.integers(0, 3000, 300)]) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts)], names=["doc_id", "text"])
    expected = Counter(" ".join(texts).split())
    list(spaced_words(np.zeros(1, np.uint8), np.array([0, 1])))
    hashed_words(np.zeros(1, np.uint8), np.zeros(0, int), np.zeros(0, int))  # its tables are made once

    def counted(function, *a) -> tuple[Counter, float]:
        docs, out = Captured(), Counter()
        function(docs, *a)
        tracemalloc.start()
        for part in docs.run(iter([batch])):
            for h, c in zip(part.column("h").to_pylist(), part.column("c").to_pylist(), strict=True):
                out[h] += c
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        return out, peak

    for most in (1 << 20, 5000):
        monkeypatch.setattr(language_model, "MOST_KEYS", most, raising=False)
        counts, peak = counted(language_model.token_counts)
        assert counts.pop(0) == 4000 and sorted(counts.values()) == sorted(expected.values())
        assert peak < 25
        known = np.sort(np.array(list(counts), np.int64).view(np.uint64))
        found, peak = counted(language_model.contexts, language_model.Classes(known, 4))
        assert found == {h: 2 * c for h, c in counts.items()}
        assert peak < 35


def test_class_model_is_a_distribution(spark, monkeypatch):
    """After any context, the probabilities of all words, one unseen word a shape and the end add up to one."""
    texts = {i: " ".join(words_of(30, i % 7) + words_of(12, 99)) for i in range(30)}
    monkeypatch.setattr(language_model, "CLUSTERED", 100)
    docs = table(spark, texts)
    counts = language_model.token_counts(docs).cache()
    for table_rows in (1 << 19, 40):
        monkeypatch.setattr(language_model, "TABLE_ROWS", table_rows)
        model = language_model.Model(counts, docs)
        classes = model.classes
        classed = {int(h): (int(c), e) for h, c, e in zip(classes.known.view(np.int64), classes.own, model.emission, strict=True) if c >= 0}
        assert len(classed) >= (100 if table_rows > 40 else 8)
        mass = np.zeros(classes.size)
        for c, e in classed.values():
            mass[c] += 10**e
        for r in counts.where("h <> 0").collect():
            if r.h not in classed:
                mass[classes.words + r["shape"]] += (r.c + 1) * 10 ** model.shape_emission[r["shape"]]
        mass[classes.words : classes.end] += 10**model.shape_emission
        mass[classes.end] += 1
        assert np.allclose((10**model.transitions) @ mass, 1)
        # Scores are plain sums over the words.
        rows = {r.doc_id: r.score for r in language_model.score(docs).collect()}
        seen = {r.h: r.c for r in counts.collect()}
        for i in (0, 3, 20):
            data = texts[i].encode()
            starts, ends, _ = spaced_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            before, total = classes.end, 0.0
            for h, shape in zip(hashed_words(np.frombuffer(data, np.uint8), starts, ends).view(np.int64).tolist(), language_model._shapes(np.frombuffer(data, np.uint8), starts, ends).tolist(), strict=True):
                own, log = classed.get(h, (classes.words + shape, model.shape_emission[shape] + math.log10(seen.get(h, 0) + 1)))
                total, before = total + model.transitions[before, own] + log, own
            assert rows[i] == pytest.approx(total + model.transitions[before, classes.end], rel=1e-9)


def test_further_words_raise_the_likelihood(spark, monkeypatch):
    """Words of three kinds in turn. Most are not clustered with each other; joining classes by their neighbours makes texts likelier, held-out ones too."""
    monkeypatch.setattr(language_model, "CLUSTERED", 30)
    monkeypatch.setattr(language_model, "CLASSES", 3)
    kinds = [words_of(80, k) for k in range(3)]
    rng = np.random.default_rng(1)
    share = 1 / np.arange(3, 83)
    docs = table(spark, {i: " ".join(kinds[k % 3][rng.choice(80, p=share / share.sum())] for k in range(150)) for i in range(80)})

    def likelihood() -> dict:
        return {r.held_out: r.s for r in language_model.score(docs).groupBy("held_out").agg(F.sum("score").alias("s")).collect()}

    model = language_model.Model(language_model.token_counts(docs), docs)
    assert (model.classes.own >= 0).sum() > 200
    found = likelihood()
    plainly = language_model.exchanged
    monkeypatch.setattr(language_model, "exchanged", lambda *a: plainly(*a).limit(0))
    bare = likelihood()
    assert all(found[fold] > 0.9 * bare[fold] for fold in (True, False)), (found, bare)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(6)
    kinds = rng.integers(0, 3, 30)
    bigrams = np.zeros((31 + language_model.SHAPES, 31 + language_model.SHAPES))
    for i in range(30):
        for j in range(30):
            bigrams[i, j] = rng.poisson(20 if kinds[j] == (kinds[i] + 1) % 3 else 0.2)
    of = language_model.exchange_clusters(bigrams, 30, classes=3, passes=10)

    def likelihood(of: np.ndarray) -> float:
        k = of.max() + 1
        t = np.zeros((k, k))
        np.add.at(t, (of[:, None], of[None, :]), bigrams)
        h = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
        return h(t) - h(t.sum(axis=1)) - h(t.sum(axis=0))

    start = np.concatenate([np.arange(30) % 3, of[30:]])
    assert likelihood(of) > likelihood(start)
    assert all(len({int(of[i]) for i in range(30) if kinds[i] == k}) == 1 for k in range(3))


# --- media --------------------------------------------------------------------------------------------------------


def test_corners_of_small_buckets_stay_off_the_disk(spark, monkeypatch):
    """Scratch tables hold the pairs that met in small buckets, not their corners, and no table is left in the catalogue."""
    rng = np.random.default_rng(12)
    gallery = media.gallery(spark.createDataFrame([(i, rng.normal(size=64).tolist()) for i in range(30)], "vec_id bigint, embedding array<float>"))
    kept, plainly = [], media.written
    monkeypatch.setattr(media, "written", lambda df, label: kept.append(plainly(df, label)) or kept[-1])
    assert media.copies(gallery).where("n_links > 0").count() == 60
    corners = media.described(gallery).selectExpr("sum(size(tests)) AS n").first().n
    assert sum(t.where("part IS NOT NULL").count() for t in kept if "part" in t.columns) < corners / 4
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("terraloom")]


def test_pairs_of_images_that_only_meet_are_not_written(spark, monkeypatch):
    """Unlike images with a match grow with the square of the images; only linked pairs come to the disk."""
    rng = np.random.default_rng(21)
    gallery = media.gallery(spark.createDataFrame([(i, rng.normal(size=64).tolist()) for i in range(60)], "vec_id bigint, embedding array<float>"))
    kept, plainly = [], media.written
    monkeypatch.setattr(media, "written", lambda df, label: kept.append(plainly(df, label)) or kept[-1])
    monkeypatch.setattr(media, "BLOCK", 50)
    links = media.copies(gallery).agg(F.sum("n_links")).first()[0] // 2
    assert 50 <= links and sum(t.where("a IS NOT NULL").count() for t in kept if {"a", "b"} <= {*t.columns}) <= links


def test_sketches_lose_no_match():
    """Squared distances of sketches are at most the number of differing tests, so the whole comparison of many images finds what the plain one finds."""
    rng = np.random.default_rng(22)
    pictures = np.stack([media.drawn(rng.normal(size=64).astype(np.float32)) for _ in range(12)])
    who, *places, bits = media.keypoints(pictures)
    order = np.argsort(who, kind="stable")
    tests = bits[order].view(np.uint64)
    block = media.Block(np.arange(12).tobytes(), np.bincount(who.astype(int)).astype(np.int64).tobytes(), np.stack(places)[:, order].astype(np.float32).tobytes(), tests.tobytes())
    axes = media._axes(tests)
    left, right = (media.Sketches(block, np.arange(12), axes, side) for side in (True, False))
    differing = np.bitwise_count(tests[:, None] ^ tests[None]).sum(axis=2, dtype=int)
    assert (left.vectors @ right.vectors.T <= differing + 0.5).all()
    i, j = media._near(tests, tests)
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*np.nonzero(differing <= media.MOST_DIFFERING), strict=True))


def test_media_copies(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(60)]
    gallery = media.gallery(spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>"))
    rows = {r.media_id: r for r in media.copies(gallery).collect()}
    assert len(rows) == 120
    together = sum(rows[2 * i].class_id == rows[2 * i + 1].class_id for i in range(60))
    assert together >= 54 and all(r.class_id // 2 == r.media_id // 2 for r in rows.values())


def test_media_edge_cases(spark):
    flat = bytes([128]) * 64 * 64
    rows = [(1, (64, 64, flat)), (2, (64, 64, flat)), (3, None), (4, (64, 64, b"short")), (5, (3, 3, bytes(9))), (6, (64, 64, bytes(64 * 64)))]
    table_ = spark.createDataFrame(rows, f"media_id bigint, image {media.IMAGE}")
    got = {r.media_id: (r.class_id, r.n_links) for r in media.copies(table_).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 3: (3, 0), 4: (4, 0), 5: (5, 0), 6: (6, 0)}
    assert media.copies(table_.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2048, 3])
def test_media_groups(spark, monkeypatch, block):
    """Groups of edited copies and unlike images with a common mark, against every image compared with every other."""
    monkeypatch.setattr(media, "BLOCK", block)
    monkeypatch.setattr(media, "IMAGES", block)
    rng = np.random.default_rng(5)
    base = [media.drawn(rng.normal(size=64).astype(np.float32)) for _ in range(6)]
    for image in base[1:]:
        image[:36, :36] = base[1][:36, :36] if image is not base[2] else image[:36, :36]
    pictures = {i: np.clip(base[0].astype(int) + 3 * i, 0, 255).astype(np.uint8) for i in range(7)}
    pictures |= {10 + i: image for i, image in enumerate(base[1:])} | {20 + i: image[8:, 8:].copy() for i, image in enumerate(base[1:])}
    gallery = spark.createDataFrame([(i, (*p.shape, p.tobytes())) for i, p in pictures.items()], f"media_id bigint, image {media.IMAGE}")
    corners = {r.id: (np.array(r.places).reshape(-1, 4), np.array(r.tests, np.int64).view(np.uint64)) for r in media.described(gallery).collect()}
    linked = {i: {j for j in corners if j != i and media.are_linked(corners[min(i, j)], corners[max(i, j)])} for i in corners}
    classes = {i: i for i in pictures}
    for _ in pictures:
        classes = {i: min([classes[i], *(classes[j] for j in linked[i])]) for i in classes}
    got = {r.media_id: (r.class_id, r.n_links) for r in media.copies(gallery).collect()}
    assert got == {i: (classes[i], len(linked[i])) for i in pictures}
    assert all(got[i] == (0, 6) for i in range(7))


def without_grain(side: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    canvas = np.full((side, side), 128, np.uint8)
    for _ in range(64 * side * side // 4096):
        y, x, h, w = *rng.integers(0, side, 2), *rng.integers(5, 21, 2)
        canvas[y : y + h, x : x + w] = rng.integers(0, 256)
    return canvas


def turned(image: np.ndarray, degrees: float) -> np.ndarray:
    turn, middle = np.deg2rad(degrees), (len(image) - 1) / 2
    y, x = np.mgrid[: len(image), : len(image)] - middle
    y, x = (np.clip(v + middle, 0, len(image) - 1.001) for v in (y * np.cos(turn) - x * np.sin(turn), y * np.sin(turn) + x * np.cos(turn)))
    r, c = y.astype(int), x.astype(int)
    rows = lambda c: image[r, c] * (1 - y + r) + image[r + 1, c] * (y - r)
    return np.rint(rows(c) * (1 - x + c) + rows(c + 1) * (x - c)).astype(np.uint8)


def recompressed(image: np.ndarray, step: int) -> np.ndarray:
    """Cosine coefficients of blocks of 8 x 8, rounded."""
    k, n = np.arange(8), len(image) // 8
    wave = np.sqrt(2 / 8) * np.cos((2 * k[None] + 1) * k[:, None] * np.pi / 16)
    wave[0] /= np.sqrt(2)
    steps = step * (1 + k[:, None] + k[None])
    blocks = wave @ image.astype(float).reshape(n, 8, n, 8).transpose(0, 2, 1, 3) @ wave.T
    back = wave.T @ (np.round(blocks / steps) * steps) @ wave
    return np.clip(back.transpose(0, 2, 1, 3).reshape(image.shape), 0, 255).astype(np.uint8)


def resized(image: np.ndarray, scale: float) -> np.ndarray:
    return np.rint(media._resized(image[None].astype(np.float32), scale)[0]).astype(np.uint8)


def test_media_recall():
    """Of copies of each kind nine tenths are linked when all images are compared, and nine tenths of these meet in the tables; unlike pictures are never linked."""

    def corners(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, y, x, size, angle, bits = media.keypoints(image[None])
        return np.stack([y, x, size, angle], axis=1), bits.view(np.uint64).reshape(-1, 4)

    def met(a: tuple, b: tuple) -> bool:
        near = np.bitwise_count(a[1][:, None] ^ b[1][None]).sum(axis=2, dtype=int) <= media.MOST_DIFFERING
        shared = (a[1].view(np.uint32)[:, None] == b[1].view(np.uint32)[None]).any(axis=2)
        return int((near & shared).sum()) >= media.LEAST_SHARED

    noise = np.random.default_rng(6)
    grainy = lambda seed: media.drawn(np.random.default_rng(seed).normal(size=64).astype(np.float32))
    kinds = {f"resized {f}": (64, lambda p, f=f: resized(p, f)) for f in (0.6, 0.7, 0.75, 0.9, 1.1, 1.5, 2.0)} | {f"turned {d}": (64, lambda p, d=d: turned(p, d)) for d in (5, 15, 20, 45)}
    kinds |= {
        "noisy": (64, lambda p: np.clip(p + noise.normal(0, 8, p.shape), 0, 255).astype(np.uint8)), "brighter": (64, lambda p: np.clip(p.astype(int) * 5 // 4 + 20, 0, 255).astype(np.uint8)),
        "cropped": (64, lambda p: p[8:56, 12:60].copy()), "recompressed": (64, lambda p: recompressed(p, 3)), "edited": (64, lambda p: media.edited(p, int(p.sum()) & 7)), "cut from a large one": (320, lambda p: p[130:194, 70:134]),
    }
    linked, found = {}, {}
    for kind, (side, edit) in kinds.items():
        for grain in (False, True)[: 1 + (side == 64)]:
            pictures = [grainy(seed) if grain else without_grain(side, seed) for seed in range(40)]
            left, right = [corners(p) for p in pictures], [corners(edit(p)) for p in pictures]
            ok = [media.are_linked(*p) for p in zip(left, right, strict=True)]
            linked[kind, grain], found[kind, grain] = sum(ok), sum(met(*p) for p, yes in zip(zip(left, right, strict=True), ok, strict=True) if yes)
            assert not any(media.are_linked(a, b) for i, a in enumerate(left) for b in right[i + 1 :]), kind
    assert min(linked.values()) >= 36, linked
    assert all(found[k] >= 0.9 * linked[k] for k in linked), found


def test_media_pairs_of_blocks_come_one_by_one(spark, monkeypatch):
    """A block that a task keeps holds its whole batch, so a batch has one pair of blocks; the setting is as before afterwards."""
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, media.written

    def noted(df, label):
        seen[label] = spark.conf.get(key)
        return write(df, label)

    monkeypatch.setattr(media, "written", noted)
    monkeypatch.setattr(media, "BLOCK", 3)
    before = spark.conf.get(key)
    rng = np.random.default_rng(8)
    vectors = spark.createDataFrame([(i, rng.normal(size=16).astype(float).tolist()) for i in range(4)], "vec_id bigint, embedding array<float>")
    rows = {r["media_id"]: r for r in media.copies(media.gallery(vectors)).collect()}
    assert seen["links"] == "1" and seen["nodes"] == before and spark.conf.get(key) == before
    assert len(rows) == 8


def test_media_points_that_repeat_count_once():
    """Of many pairs at once those agree that agree one by one, also where the corners of several scales share a place."""
    rng = np.random.default_rng(9)
    sides, sizes = ([], []), []
    for distinct in (3, 8, 9, 10, 11, 30, 60):
        for times in (1, 2, 5):
            places = np.repeat(np.concatenate([rng.uniform(0, 60, (distinct, 2)), np.tile([1.0, 0.5], (distinct, 1))], axis=1), times, axis=0)
            for side, moved in zip(sides, (places, places + [3, 4, 0, 0]), strict=True):
                side.append(moved)
            sizes.append(len(places))
    a, b = map(np.concatenate, sides)
    assert media._all_agreeing(a, b, np.array(sizes)) == [k for k in range(len(sizes)) if media._agrees(sides[0][k], sides[1][k])]
