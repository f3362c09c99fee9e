"""Rows that repeat an id: samples are bounded by rows, labels come from the row, decisions are those of the contract; and SQL on tables with repeats."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from terraloom.llm import decontamination, divergence, language_id, near_dedup, queries, warc
from terraloom.llm.common import labelled_sample
from tests.llm.test_operators import plain_decontamination, table, words_of

#: crc32 of this id leaves no remainder of 0 by 5, so its rows may be learned from.
ID = 3


def test_samples_are_bounded_by_rows(spark):
    rows = spark.range(100_000).select(F.lit(ID).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    marks = spark.createDataFrame([(ID, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = labelled_sample(rows, marks, "quality", F.lit(True), {0: 50, 1: 70}, 8000)
    assert len(got) == 70 and {v for _, v in got} == {1}
    both = labelled_sample(rows.unionByName(rows.limit(30).withColumn("doc_id", F.lit(4).cast("bigint"))), marks.unionByName(spark.createDataFrame([(4, 0, 0), (4, 1, 1)], marks.schema)), "quality", F.lit(True), {0: 20, 1: 10}, 8000)
    assert Counter(v for _, v in both) == {0: 20, 1: 10}  # of several labels of an id the least counts


def test_languages_come_from_the_row(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "Model", lambda letters, sample: seen.extend(sample))
    rows = [(ID, "ab " * 9, "aa")] * 3 + [(ID, f"cd {i}", "bb") for i in range(3000)] + [(ID, "null lang", None)] * 3000
    language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert Counter(v for _, v in seen) == {"aa": 3, "bb": language_id.SAMPLE}
    assert {t[:2] for t, v in seen if v == "aa"} == {"ab"} and {t[:2] for t, v in seen if v == "bb"} == {"cd"}


def compared(spark, name: str, query, **tables) -> None:
    import duckdb

    db = duckdb.connect()
    for k, df in tables.items():
        db.register(k, df.toPandas())
    found = db.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    got = query()
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(str(r[c]) for c in sorted(names)) for r in got.collect()) == Counter(tuple(str(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall())


def test_sql_gives_the_same_rows(spark):
    a, b, passage = (" ".join(words_of(40, seed)) for seed in (701, 702, 703))
    texts = [(1, a), (1, a + " more"), (2, a + " other"), (2, b), (3, b + " end"), (3, b), (4, passage), (4, a + " " + passage), (5, ""), (5, "few words"), (6, "FEW words"), (7, "?"), (7, "few  words")]
    texts += [(100 + i, f"same source words {i % 7} and again") for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "", f"s{i % 4}") for i, t in texts], "doc_id bigint, text string, lang string, source string")
    items = spark.createDataFrame([(1, passage), (1, "few words"), (2, passage.upper()), (3, "")], "item_id bigint, text string")
    pages = spark.createDataFrame([(i, f"u {i}", t) for i, (_, t) in enumerate(texts)], "page_id bigint, url string, html string")
    compared(spark, "op8_near_dedup", lambda: near_dedup.near_duplicates(docs), documents=docs)
    compared(spark, "op11_divergence", lambda: divergence.audit(docs), documents=docs)
    compared(spark, "op12_warc", lambda: warc.revisited(pages), pages=pages)
    once = docs.dropDuplicates(["doc_id"])
    compared(spark, "op1_decontamination", lambda: decontamination.report(once, items), documents=once, benchmark=items)
    stays = near_dedup.without_near_duplicates(docs).where("doc_id < 4").collect()
    assert len(stays) == 2 and {r.doc_id for r in stays} == {1, 2}  # one row of each group of near copies


@pytest.mark.parametrize("words", [20_000])
def test_windows_beyond_the_broadcast(spark, words):
    """A document that quotes throughout: no exchange before the windows carries its words more than once."""
    quoted = words_of(words, 5)
    docs, items = {1: " ".join(quoted), 2: " ".join(quoted[:12]), 3: None}, {i: " ".join(quoted[i * 100 : i * 100 + 120]) for i in range(words // 100)}
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontamination.scan(table(spark, docs), bench, broadcast_bytes=0)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [x for x in plan.splitlines() if "Exchange" in x]
    assert any("here#" in x for x in lines) and not any("slice(" in x for x in lines), lines
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in found.collect()}
    assert got == {i: v[:3] for i, v in plain_decontamination(docs, items).items()}
