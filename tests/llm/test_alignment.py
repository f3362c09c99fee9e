"""Tokens of two vocabularies that end together, against a plain version that encodes whole texts and counts in dictionaries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import accumulate

import pytest

from terraloom.llm import alignment
from terraloom.llm.tokens import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def plain(texts: list[tuple]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    a_of, b_of = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in seen)}
    rows, pairs = [], Counter()
    for doc_id, text in texts:
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        a_bytes = [bytes(to_byte[c] for c in a_of.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            rows.append((doc_id, 0, 0, [], ""))
            continue
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        shared = sorted(set(a_ends) & set(b_ends))
        a_at, b_at = {e: i for i, e in enumerate(a_ends)}, {e: i for i, e in enumerate(b_ends)}
        links = [(b[b_at[e]], a[a_at[e]]) for e in shared]
        groups, i, j = [], 0, 0
        for e in shared:
            groups.append(",".join(map(str, a[i : a_at[e] + 1])) + "|" + ",".join(map(str, b[j : b_at[e] + 1])))
            i, j = a_at[e] + 1, b_at[e] + 1
        pairs.update(links)
        rows.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best: dict[int, int] = {}
    for (b, _), n in pairs.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(((d, n_a, n_b, len(k), len(k), sum(pairs[x] == best[x[0]] for x in k), sum(pairs[x] for x in k), sha) for d, n_a, n_b, k, sha in rows), key=str)


def texts() -> list[tuple]:
    rng = random.Random(5)
    letters = ["the", "Straße", "naïve", "don't", "we'll", "12,345", "x", "日本語", "😀", "á", "<|endoftext|>", "<s>", "<0x41>", "\t", "\n", "\xa0", "　", "᠎", "​", "\x1c", "\x00", "▁", "ﬁ", "''", "...", "²", "word.", "a,b", "x=(1);", "5%", "_", "é.", "%%%***", "  ", "   ", " "]
    out = [(i, "".join(rng.choice(letters) + rng.choice([" ", " ", " ", "", "  ", "\n"]) for _ in range(rng.randint(1, 40)))) for i in range(400)]
    out += [(500, None), (501, ""), (502, " "), (503, "  lead"), (504, "trail "), (505, "\n"), (506, "the the the"), (506, "the the the"), (507, "a" * 5000), (508, "long words " * 20_000), (None, "no id")]
    return out


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", 1, 2, 3) for d, t in rows], "doc_id bigint, text string, kind string, batch int, stripe int, blob int")


@pytest.mark.parametrize("share, tasks", [(512, 1), (2, 9)])
def test_alignment(spark, monkeypatch, share, tasks):
    """Nine tasks make nine batches, which with shares of two go through both steps of counting and five shares of scoring."""
    monkeypatch.setattr(alignment, "SHARE", share)
    want = plain(texts())
    assert sum(r[1] == 0 for r in want) > 20 < sum(r[1] > 0 for r in want)
    got = alignment.report(docs(spark, texts()).repartition(tasks))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_no_rows(spark):
    assert alignment.report(docs(spark, texts()[:1]).where("false")).count() == 0


def test_chunks_give_what_whole_texts_give(spark):
    pair = alignment.Pair(A, B)
    assert pair.cut.split(' one two, x%%') == [' one', ' two', ',', ' x', '%%']
    for _, text in texts():
        if text:
            whole = pair.encode([" " + text])[0]
            parts = pair.texts([text])[0]
            assert sum(p[0] for p in parts) == (whole[0] if whole else 0)
            assert ";".join(p[3] for p in parts) == (whole[3] if whole else "")
