import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basinflow.llm import jaccard, pii, quality
from basinflow.llm.queries import oracle_sql, queries

from .helpers import documents, sentence

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages labels".split()


def plain(v):
    return (round(v, 9) if math.isfinite(v) else str(v)) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries()[name](spark, DATA)
    columns = sorted(df.columns)
    found = con.execute(oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")) == list(range(1, 11))


def without_repeats(texts, length, words):
    """The texts without bytes of windows of that many bytes, or of that many words, that are found twice."""
    raws = {k: t.encode() for k, t in texts.items()}
    places = {k: [m.span() for m in re.finditer(rb"[^ \t-\r]+", r)] for k, r in raws.items()}
    by_bytes = Counter(r[i : i + length] for r in raws.values() for i in range(len(r) - length + 1))
    windows = {k: [tuple(raws[k][a:b] for a, b in p[i : i + words]) for i in range(len(p) - words + 1)] for k, p in places.items()}
    by_words = Counter(x for own in windows.values() for x in own)
    out = {}
    for k, r in raws.items():
        flags = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if by_bytes[r[i : i + length]] > 1:
                flags[i : i + length] = True
        for i, x in enumerate(windows[k]):
            if by_words[x] > 1:
                flags[places[k][i][0] : places[k][i + words - 1][1]] = True
        out[k] = bytes(np.frombuffer(r, np.uint8)[~flags]).decode("utf-8", "ignore")
    return out


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    marks = spark.read.parquet(f"{DATA}/labels.parquet")
    columns = docs.columns
    (_, first), (_, second), (_, third), (_, fourth), (_, last) = corpus_pipeline.STAGES
    good = first(spark, docs, DATA).cache()
    judged = {r.doc_id for r in quality.quality_rules(docs, marks).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == judged and good.columns == columns
    single = second(spark, good, DATA).cache()
    linked = jaccard.jaccard_components(good, 5, 80).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in linked})
    stripped = third(spark, single, DATA).cache()
    texts = {r.doc_id: r.text or "" for r in single.collect()}
    assert {r.doc_id: r.text for r in stripped.collect()} == without_repeats(texts, 400, corpus_pipeline.PASSAGE_WORDS)
    clean = fourth(spark, stripped, DATA).cache()
    for r in clean.collect():
        assert r.n_chars == len(r.text) and not pii.base_spans(r.text)
    pieces = last(spark, clean, DATA).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in clean.collect()}
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    assert max(p.sequence_id for p in pieces) == math.ceil(sum(p.length for p in pieces) / 1024) - 1


@pytest.mark.parametrize("rows", ["none", "odd"])
def test_pipeline_over_odd_tables(spark, tmp_path, rows):
    """Empty tables; nulls in any column, repeated rows, very long texts, and columns with names that stages use."""
    long = " ".join(f"long{i}" for i in range(40_000))
    data = [(None, None), (1, None), (2, ""), (3, "x" * 200_000), (4, long), (5, long + " end"), (6, "a short one"), (None, "some words of a text without an id that stay here as they are"), (7, " " * 50_000)]
    docs = documents(spark, [t for _, t in data]).withColumn("doc_id", F.element_at(F.array(*[F.lit(i).cast("bigint") for i, _ in data]), (F.col("doc_id") + 1).cast("int")))
    docs = docs.unionByName(docs).withColumn("lang", F.lit(None).cast("string"))
    marks = spark.createDataFrame([(4, 1, 0), (3, 0, None), (None, 1, 1), (2, None, 1)], "doc_id bigint, quality int, toxic int")
    if rows == "none":
        docs, marks = docs.limit(0), marks.limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    marks.write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
    kept = sorted((r.doc_id is None, r.doc_id) for r in at.collect())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if rows == "none":
        assert kept == [] and pieces == []
    else:  # no words, too few words, or copies: the other rows go
        assert kept == [(False, 4), (True, None)]
        assert {p.doc_id for p in pieces} == {4, None} and all(p.length > 0 for p in pieces)


def test_intermediate_tables_go(spark):
    from basinflow.llm.common import folders

    before = len(folders())
    corpus_pipeline.run(spark, DATA)
    assert len(folders()) - before <= 3  # the last stage's input and its own tables


def test_a_cluster_must_name_a_shared_folder():
    from basinflow import session

    class Context:
        master = "spark://host:7077"

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_base(Session())


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.count() > 0 and "sequence_id" in out.columns and np.isfinite(out.agg({"length": "sum"}).first()[0])


def test_repeats_stage_takes_passages_of_more_than_50_words(spark):
    rng = random.Random(9)
    passages = {n: " ".join(f"{n}{rng.choice(['a', 'of', 'river'])}{i}"[-5 if n % 2 else -3 :] for i in range(n)) for n in (50, *range(51, 66))}
    assert max(map(len, passages.values())) < 395
    rows = [f"{sentence(rng, 20)} {n}x{k} {passages[n]} {n}y{k} {sentence(rng, 20)}" for n in passages for k in range(3)]
    out = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["repeats"](spark, documents(spark, rows, extra=False), DATA).collect()}
    for i, text in enumerate(rows):
        passage = list(passages.values())[i // 3]
        assert out[i].text == (text if i < 3 else text.replace(passage, "")) and out[i].n_chars == len(out[i].text)
