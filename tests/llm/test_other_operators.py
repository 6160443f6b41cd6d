import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basinflow.llm import ann, piece_scan, warc
from basinflow.llm.components import connected_components

from .helpers import documents, sentence, texts


# 7: nearest neighbours


def nearest(ids, vectors, k, every):
    out = []
    for i, q in zip(ids, vectors):
        if i % every == 0:
            scores = np.cumsum(vectors * q, axis=1)[:, -1]
            rank = 0
            for n in np.lexsort((ids, -scores)):
                if ids[n] != i and rank < k:
                    rank += 1
                    out.append((i, rank, int(ids[n]), float(scores[n])))
    return out


def table(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("norm", F.lit("x")).withColumn("rank", F.lit("y"))


def test_nearest_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(1500, 24)).astype(np.float32).astype(float)
    vectors[100:400] = vectors[100]  # one very common vector
    ids = np.arange(1500)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(table(spark, ids, vectors), 5, 20).collect())
    want = sorted(nearest(ids, vectors, 5, 20))
    hits = len({g[::2] for g in got} & {w[::2] for w in want})
    assert len(got) == len(want) and hits >= 0.99 * len(want)
    assert all(abs(g[3] - vectors[g[0]] @ vectors[g[2]]) < 1e-9 for g in got)


@pytest.mark.parametrize("block", [64 << 20, 1 << 17])
def test_recall_above_the_size_of_the_pilot(spark, block, monkeypatch):
    """More rows than PILOT * 64 * k, so that a pilot runs; clustered vectors of several lengths, and small blocks."""
    monkeypatch.setattr(ann, "BLOCK_BYTES", block)
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(40, 70))[rng.integers(0, 40, 11_000)] + 0.5 * rng.normal(size=(11_000, 70))) * rng.uniform(0.5, 2, (11_000, 1))
    vectors = vectors.astype(np.float32).astype(float)
    ids = rng.permutation(11_000)
    got = {(r.query_id, r.vec_id) for r in ann.nearest(table(spark, ids, vectors), 20, 200).collect()}
    want = {(g[0], g[2]) for g in nearest(ids, vectors, 20, 200)}
    assert len(got) == len(want) == 55 * 20 and len(got & want) >= 0.99 * len(want)


def test_products_of_packed_bits_are_within_their_error():
    rng = np.random.default_rng(7)
    for dim in (3, 64, 70, 130):
        signs, q = rng.random((50, dim)) < 0.5, rng.normal(size=(9, dim))
        got, error = ann.signs_times(ann.words(np.packbits(signs, axis=1)), q)
        want = (signs * 2.0 - 1) @ q.T
        assert (abs(got - want) <= error + 1e-4).all() and error.max() < 0.1 * dim


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (20, [0.0, 0.0]), (40, [2.0, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(df).collect())
    assert got == [(0, 1, 40, 2.0), (0, 2, 1, 0.5), (40, 1, 0, 2.0), (40, 2, 1, 1.5)]
    assert ann.nearest(df.limit(0)).count() == 0


def test_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(2)
    v, q = rng.normal(size=(2000, 48)), rng.normal(size=48)
    norm = np.sqrt((v * v).sum(1))
    turned = (v / norm[:, None]) @ ann.rotation(48).T
    fit = np.abs(turned).sum(1) / np.sqrt(48)
    estimate = norm * (np.sign(turned) @ (ann.rotation(48) @ q)) / np.sqrt(48) / fit
    bound = norm * np.sqrt(1 - fit**2) / fit * ann.EPSILON / np.sqrt(47) * np.sqrt(q @ q)
    assert (np.abs(estimate - v @ q) <= bound).mean() > 0.995


# 8: pieces


@pytest.fixture(scope="module")
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_scan_gives_the_library_encoding(spark, model_path):
    rows = texts(5) + ["  two  spaces ", "日本語\U0001f600x\n\tb", "▁"]
    want = {i: piece_scan.pieces(model_path).model.encode(t or "") for i, t in enumerate(rows)}
    got = {r.doc_id: r.ids for r in piece_scan.encode_documents(documents(spark, rows).unionByName(documents(spark, rows[-1:])), model_path, giant=200, chunk=97).collect()}
    assert got == want | {0: got[0]} and got[0] in (want[0], want[len(rows) - 1])
    back = {r.doc_id: r.text for r in piece_scan.decode_documents(piece_scan.encode_documents(documents(spark, rows), model_path), model_path).collect()}
    assert back == {i: piece_scan.pieces(model_path).model.decode(x) for i, x in want.items()}


def test_random_texts_over_chunks(model_path):
    model, rng = piece_scan.pieces(model_path), random.Random(9)
    bits = ["a", "e", " ", "  ", "the", "ing", "\n", "é", "日", "\U0001f600", "xx", "==", "0", "12", "▁", " " * 9]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40)))
        chunk = rng.choice((5, 17))
        whole, matrices, parts = piece_scan.normalised(model, text), [], []
        for start in range(0, len(whole), chunk):
            base, stop = max(0, start - model.longest), min(len(whole), start + chunk)
            part = whole[base : stop + model.longest]
            matrices.append([tuple(v + base for v in m) for m in piece_scan.transfer(model, part, start - base, stop - base)])
            parts.append((base, part, stop - base))
        states = []
        if matrices:
            total = piece_scan.product(matrices)
            left = matrices[0]
            for m in matrices[1:]:
                left = piece_scan.combined(left, m)
            assert sorted(total) == sorted(left)  # whatever the order of combination
            end = next(x for x in total if x[:2] == (0, 0) and x[3] == len(whole))
            states = piece_scan.path_of(matrices, (0, 0), end[2:])
        got = [p for (base, part, stop), a, b in zip(parts, states, states[1:]) for p in piece_scan.backtrace(model, part, (a[0] - base, a[1] - base), (b[0] - base, b[1] - base), stop)]
        assert [i for p in got for i in model.ids_of(p)] == model.model.encode(text)


@pytest.mark.parametrize("fan", [2, 16])
def test_giant_documents_are_combined_in_rounds(spark, model_path, fan, monkeypatch):
    monkeypatch.setattr(piece_scan, "state_at_bounds", lambda m, f=piece_scan.state_at_bounds: f(m, fan))
    rng = random.Random(3)
    rows = [sentence(rng, 6000), sentence(rng, 30), "x" * 5000, sentence(rng, 2000) + " é日" * 50]
    got = {r.doc_id: r.ids for r in piece_scan.encode_documents(documents(spark, rows), model_path, giant=1000, chunk=512).collect()}
    assert got == {i: piece_scan.pieces(model_path).model.encode(t) for i, t in enumerate(rows)}


def test_no_documents_no_pieces(spark, model_path):
    none = piece_scan.encode_documents(documents(spark, []), model_path)
    assert none.count() == 0 and piece_scan.encoding_digest(none, model_path).count() == 0 and piece_scan.decode_documents(none, model_path).count() == 0


def test_digest(spark, model_path):
    rows = [None, "", "river flow"]
    got = {r.doc_id: r for r in piece_scan.encoding_digest(piece_scan.encode_documents(documents(spark, rows), model_path), model_path).collect()}
    assert got[0].n_ids == got[1].n_ids == 0 and got[2].decoded_sha256 == hashlib.sha256(b"river flow").hexdigest()


# 9: WARC


PAGES = [(5, "http://a/x", "<p>é</p>"), (3, "http://b", "<p>é</p>"), (9, "http://b\r\nX: y", "<p>é</p>"), (4, None, None), (2, "u", ""), (7, "u", "only"), (11, "u", "x" * 100_000)]


def test_archive_rebuilds_records(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("payload", F.lit(1)).withColumn("header", F.lit(2)).withColumn("content_key", F.lit(3))
    path = str(tmp_path / "a")
    warc.write_archive(pages, path)
    got = {r.page_id: r for r in warc.archive_digest(spark, path).collect()}
    first = {}
    for i, _, html in sorted(PAGES):
        first.setdefault(html or "", i)
    for i, _, html in PAGES:
        raw = (html or "").encode()
        home = first[html or ""]
        want = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == home else "revisit", None if i == home else home)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want
    records = {r.page_id: r for r in warc.read_records(spark, path).collect()}
    assert bytes(records[9].payload) == "<p>é</p>".encode() and records[9].url == "http://b%0D%0AX: y"
    for i, r in records.items():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1") and body.endswith(b"\r\n\r\n") and len(body) - 4 == int(fields["Content-Length"])
        if r.record_type == "response":
            assert body[:-4] == bytes(r.payload)
    assert spark.read.parquet(f"{path}/payloads").count() == 4


def test_records_have_dates_and_ids_of_their_own(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame(PAGES + PAGES[:2] * 3 + [(None, "n", "only"), (None, "n", "none"), (None, "n", "none")], "page_id bigint, url string, html string")
    for path, few in (("f", 200_000), ("g", 0)):
        monkeypatch.setattr(warc, "BROADCAST_GROUPS", few)
        warc.write_archive(pages, str(tmp_path / path), date="2024-05-06T07:08:09Z")
        heads = [dict(x.split(": ", 1) for x in r.header.split("\r\n")[1:-1]) for r in warc.read_headers(spark, str(tmp_path / path)).collect()]
        assert len({h["WARC-Record-ID"] for h in heads}) == len(heads) == 16 and {h["WARC-Date"] for h in heads} == {"2024-05-06T07:08:09Z"}
        ids = {h["WARC-Record-ID"]: h for h in heads}
        for h in heads:
            if h["WARC-Type"] == "revisit":
                home = ids[h["WARC-Refers-To"]]
                assert home["WARC-Type"] == "response" and home["X-Payload-Key"] == h["X-Payload-Key"]
        assert sum(h["WARC-Type"] == "response" for h in heads) == 5 == spark.read.parquet(str(tmp_path / path / "payloads")).count()
        out = warc.archive_digest(spark, str(tmp_path / path)).collect()
        assert sorted(r.record_type for r in out if r.page_id == 3) == ["response"] + ["revisit"] * 3 and len(out) == 16


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_archive(pages, str(tmp_path / "b"), min_payload=1)
    got = {r.page_id: r.record_type for r in warc.archive_digest(spark, str(tmp_path / "b")).collect()}
    assert got[2] == got[4] == "response" and got[5] == "revisit"


def test_damage_is_found_and_empty_archives_read(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_archive(pages.limit(0), str(tmp_path / "e"))
    assert warc.archive_digest(spark, str(tmp_path / "e")).count() == 0
    warc.write_archive(pages, str(tmp_path / "c"))
    kept = spark.read.parquet(str(tmp_path / "c/payloads"))
    kept.withColumn("payload", F.lit(b"other")).write.parquet(str(tmp_path / "d/payloads"))
    spark.read.parquet(str(tmp_path / "c/headers")).write.parquet(str(tmp_path / "d/headers"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_records(spark, str(tmp_path / "d")).collect()


@pytest.mark.parametrize("field, kind", [("Content-Length", "response"), ("X-Payload-Length", "revisit"), ("WARC-Payload-Digest", "revisit")])
def test_digest_reads_the_rebuilt_records(spark, tmp_path, field, kind):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_archive(pages, str(tmp_path / "c"))
    spark.read.parquet(str(tmp_path / "c/payloads")).write.parquet(str(tmp_path / "d/payloads"))
    wrong = F.regexp_replace("header", rf"\n{field}: [^\r]*", f"\n{field}: 1")
    heads = spark.read.parquet(str(tmp_path / "c/headers"))
    heads.withColumn("header", F.when(F.col("header").contains(f"WARC-Type: {kind}"), wrong).otherwise(F.col("header"))).write.parquet(str(tmp_path / "d/headers"))
    with pytest.raises(Exception, match="record is not as its header states"):
        warc.archive_digest(spark, str(tmp_path / "d")).collect()


def test_digest_is_of_the_records_bytes(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    plain = warc.read_records
    cut_off = lambda s, p: plain(s, p).withColumn("record", F.expr("substring(record, 1, octet_length(record) - 5)"))
    monkeypatch.setattr(warc, "read_records", cut_off)
    with pytest.raises(Exception, match="record is not as its header states"):
        warc.archive_digest(spark, str(tmp_path / "a")).collect()


# components


def test_components_of_chains_stars_and_pairs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_sentence_helper_is_deterministic():
    assert sentence(random.Random(1), 3) == sentence(random.Random(1), 3)
