import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basinflow.llm import jaccard, packing, pii, quality, sharding, suffix_dedup, toxicity
from basinflow.llm.boosting import boost
from basinflow.llm.features import Rows, fit_logistic, platt
from basinflow.llm.suffixes import suffix_array

from .helpers import documents, labels, sentence, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# 1: quality rules


def base_counts(text):
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_match_plain_loops(spark):
    rows = texts() + ["x # y\nx # y\n\n \nz", "a b c d e f a b c d e g", "w\x1cx y\x85z q"]
    docs = documents(spark, rows)
    got = by_id(quality.quality_rules(docs, labels(spark)))
    for i, t in enumerate(rows):
        want = base_counts(t or "")
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept) and 0 <= r.quality <= 1


def test_quality_learns_held_out_rows(spark):
    rng = random.Random(4)
    rows = [sentence(rng, 60) if i % 2 else " ".join(w + rng.choice(("###", "$$$")) for w in sentence(rng, 60).split()) for i in range(240)]
    docs = documents(spark, rows, extra=False)
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(160)], "doc_id bigint, quality int, toxic int")
    got = by_id(quality.quality_rules(docs, marks))
    assert sum(got[i].kept == bool(i % 2) for i in range(160, 240)) >= 76


def test_keep_good_agrees_and_keeps_columns(spark):
    docs = documents(spark)
    kept = {r.doc_id for r in quality.quality_rules(docs, labels(spark)).where("kept").collect()}
    out = quality.keep_good(docs, labels(spark))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept


def test_logistic_and_calibration():
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.4).astype(float)
    rows = Rows(np.arange(401), np.where(y > 0, 1, np.where(rng.random(400) < 0.1, 1, 0)).astype(np.int32), None, 2)
    w, b = fit_logistic(rows.dot, rows.back, 2, y, 1e-6, 300, 0.1)
    z = rows.dot(w) + b
    a, c = platt(z, y)
    p = 1 / (1 + np.exp(-(a * z + c)))
    assert abs(p.mean() - y.mean()) < 0.02 and w[1] > w[0]


# 2: sharding


def least_capacity(sizes, k):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, used, now = (lo + hi) // 2, 1, 0
        for s in sizes:
            if now + s > mid:
                used, now = used + 1, 0
            now += s
        lo, hi = (lo, mid) if used <= k else (mid + 1, hi)
    return lo


def test_sharding_is_minimax_over_the_ordered_groups(spark):
    rng = random.Random(1)
    rows = [sentence(rng, rng.randrange(1, 60)) for _ in range(700)] + [None, "", ""]
    out = sharding.shard_documents(documents(spark, rows)).collect()
    sizes = Counter()
    keys = {}
    for r in out:
        t = rows[r.doc_id] or ""
        assert r.size == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode()) and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r.size
        keys.setdefault(int(hashlib.sha256(t.encode()).hexdigest()[:15], 16), []).append(r)
    assert all(len({r.shard for r in g}) == 1 for g in keys.values())
    ordered = [keys[k] for k in sorted(keys)]
    assert [g[0].shard for g in ordered] == sorted(g[0].shard for g in ordered)
    assert max(sizes.values()) == least_capacity([sum(r.size for r in g) for g in ordered], 8)
    for shard in sizes:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))


def test_one_hot_text_leaves_no_shard_empty(spark):
    rng = random.Random(2)
    rows = ["hot text " * 10] * 300 + [sentence(rng, 12) for _ in range(400)]
    sizes = Counter()
    for r in sharding.shard_documents(documents(spark, rows)).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 8
    hot = 300 * (len("hot text " * 10) + 1)
    others = sorted(v for v in sizes.values() if v < hot)
    # the two sides of the hot text share seven shards; the smaller side can leave one of them short
    assert len(others) == 7 and others[-1] < 1.1 * sum(others) / 6


def test_plan_of_runs_is_minimax():
    for seed in range(200):
        rng = random.Random(seed)
        w = [rng.randrange(1, 20) if rng.random() < 0.9 else rng.randrange(50, 300) for _ in range(rng.randrange(1, 60))]
        shards, _ = sharding.plan_cuts([sharding.Run(i, i + 1, x, 1) for i, x in enumerate(w)], 8)
        assert max(s[2] for s in shards) == least_capacity(w, 8) and len(shards) <= 8
        assert shards[0][0] == 0 and shards[-1][1] == len(w) and all(a[1] == b[0] for a, b in zip(shards, shards[1:]))


# 3: personal data

HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[ -]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    bits = ["a", "1", "23", "255", "256", "0001", "@", ".", "-", "+", "(", ")", " ", "b.c", "_", "4111111111111111", "é", "٣"]
    for _ in range(20_000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_personal_data_columns(spark):
    rows = ["mail é@x bob.b@mail.example.com or +1 (555) 010-9999, 10.0.0.1; 4111 1111 1111 1111", None, "", "call (555) 123-4567 now", f'the token = "{HEX}" goes']
    got = by_id(pii.find_personal_data(documents(spark, rows), redacted=True))
    base = pii.spell(plain_spans(rows[0]))
    assert (got[0].n_email, got[0].n_ip, got[0].n_card, got[0].n_phone) == (1, 1, 1, 1)
    assert got[0].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(got[0].spans.split(","))
    assert got[0].text == "mail é@x [EMAIL] or [PHONE], [IP]; [CARD]"
    assert [got[i].n_spans for i in range(5)] == [4, 0, 0, 1, 1]
    assert got[4].spans == "" and got[4].secrets == "secret:13:53" and got[4].text == 'the token = "[SECRET]" goes'
    assert got[1].spans == got[2].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].n_phone == 0 and got[3].spans.startswith("phone:5:") and got[3].text == "call [PHONE] now"
    out = pii.redact_documents(documents(spark, rows))
    assert by_id(out)[0].text == got[0].text and by_id(out)[1].text is None and by_id(out)[3].spans == "en"


def test_span_model_separates_its_examples():
    rows, y = pii.examples(2500, seed=99)
    model = pii.span_model()
    x = np.array([pii.describe(*r) for r in rows])
    p = model.probabilities(x)
    taken = np.array([q >= model.thresholds[int(k)] for q, k in zip(p, x[:, 0])])
    assert y[taken].mean() > 0.93 and taken[y > 0].mean() > 0.85


PLANTED = [
    (f'the river token = "{HEX}" rises', HEX), (f"api_key: {HEX}", HEX), ("Thing +1 (826) 555-4081 190.137.223.204 du", "+1 (826) 555-4081"),
    ("paid 7536784127813050 4845168114407329 today", "4845168114407329"), ("call (555) 123-4567 now", "(555) 123-4567"), ("write to jane.doe [at] example [dot] org please", "jane.doe [at] example [dot] org"),
    ("from host 10[.]20[.]30[.]40 again", "10[.]20[.]30[.]40"), ("card 4111.1111.1111.1111 ends", "4111.1111.1111.1111"),
]
CLEAN = ["see commit 04dbebab91ab85687d33eeaaf9ac699e1188f962 there", "sha 04dbebab91ab85687d33eeaaf9ac699e11", "paid 9807915762804490 today", "section 12.345.678 page 9", "a token of thanks: nothing", "étreai iertionieroupamenteux x", "cigall | losasmentementemente | uejad", "version 20.21.22 of a-b-c-d-e-f-g-h-i-j-k-l-m-n"]


def more(text, model=None):
    return [text[s:e] for s, _, e in pii.more_spans(text, pii.base_spans(text), model or pii.span_model())]


def test_planted_spans_are_found_and_clean_texts_left_alone():
    assert [t for t, want in PLANTED if want not in more(t)] == [] and [t for t in CLEAN if more(t)] == []


def test_trees_decide():
    """With one and the same score for all proposals, clean texts are hit, or nothing is."""
    model = pii.span_model()
    flat = pii.SpanModel(pii.Boosted(0.0, []), model.scale, model.shift, model.thresholds)
    lax, strict = (pii.SpanModel(flat.trees, 1.0, 0.0, (limit,) * len(pii.ALL_KINDS)) for limit in (0.5, 0.51))
    assert any(more(t, lax) for t in CLEAN) and not any(more(t, strict) for t, _ in PLANTED)


def test_proposals_may_overlap_base_spans_and_never_each_other():
    text = "x 4111 1111 1111 1111 4845168114407329 +1 (826) 555-4081 190.137.223.204 +1 (826) 555-4081"
    found = pii.more_spans(text, pii.base_spans(text), pii.span_model())
    assert all(a[2] <= b[0] for a, b in zip(found, found[1:])) and found == sorted(found)


def test_many_proposals_take_linear_time():
    text = " ".join(f"call ({i % 900 + 100}) 555-{i % 9000 + 1000} now" for i in range(30_000))
    assert len(pii.more_spans(text, pii.base_spans(text), pii.span_model())) > 20_000


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 200_000) == [] and pii.base_spans("1" * 200_000) == [] and pii.base_spans("a@" * 50_000) == []
    assert pii.proposals("a" * 400_000 + " 1") == pii.proposals("a-" * 200_000 + " 1") == []


def test_boosted_trees_fit_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((boost(x, y, 30).logits(x) > 0) == (y > 0)).mean() > 0.95


# 4: packing


def test_packing_rebuilds_every_document(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = texts() + ["with <|endoftext|> inside", "end"]
    docs = documents(spark, rows).repartition(5)
    pieces = packing.pack_documents(docs, path, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    found, filled = {}, {}
    for p in pieces:
        assert len(p.ids) == p.length and p.offset + p.length <= 1024 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4"))
        found.setdefault(p.doc_id, []).append(p)
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, t in enumerate(rows):
        want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(found[i], key=lambda p: p.start)
        assert [x for p in parts for x in p.ids] == want and all(p.doc_tokens == len(want) for p in parts)
        assert [p.start for p in parts] == list(np.cumsum([0, *(p.length for p in parts[:-1])]))
    assert sorted(filled) == list(range(len(filled)))
    for s, parts in filled.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 1024 or s == max(filled)


@pytest.fixture(scope="module")
def tokenizer_paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("blank", [" ", "\n", " \n\t", "\u3000\x85 "])
def test_very_long_blanks_are_encoded(tokenizer_paths, blank):
    text = f"before{blank * (2_000_000 // len(blank))}after"
    want = packing.tokenizer(tokenizer_paths[0]).encode(text, add_special_tokens=False).ids
    assert packing.encode(text, *tokenizer_paths) == want


def test_both_tokenizers_agree_on_random_text(tokenizer_paths):
    rng = random.Random(12)
    bits = [" ", "  ", "\n", "\t", "\u3000", "\x85", "\x1c", "a", "é", "日", "٣", "²", "'s", "'LL", "!?", "\U0001f600", "e\u0301", "\u200b", "\xa0", "word", "123", " " * 50, "\n" * 9_999]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 60)))
        assert packing.ranked(tokenizer_paths[1]).encode_ordinary(text) == packing.tokenizer(tokenizer_paths[0]).encode(text, add_special_tokens=False).ids


def test_a_document_of_blanks_is_packed(spark, tokenizer_paths):
    pieces = packing.pack_documents(documents(spark, [" " * 1_200_000, "end"]), *tokenizer_paths).collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == {0: len(packing.tokenizer(tokenizer_paths[0]).encode(" " * 1_200_000, add_special_tokens=False).ids) + 1, 1: 2}


# 5: repeated byte strings


def covered(raws, length):
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        flags = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                flags[i : i + length] = True
        out.append(flags)
    return out


@pytest.mark.parametrize("crowd", [6000, 2])
def test_repeats_match_all_windows(spark, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda t, n, f=suffix_dedup.repeated_spans: f(t, n, crowd))
    rows = texts(3)
    raws = [(t or "").encode() for t in rows]
    got = by_id(suffix_dedup.remove_repeats(documents(spark, rows)))
    for i, (raw, flags) in enumerate(zip(raws, covered(raws, 400))):
        kept = bytes(np.frombuffer(raw, np.uint8)[~flags])
        runs = int((np.diff(flags.astype(int), prepend=0) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(raw), int(flags.sum()), runs, hashlib.sha256(kept).hexdigest())


def test_planted_passages_of_400_bytes_and_more_are_all_caught(spark):
    """Each planted passage goes from each document, whatever stands around it; texts without one stay whole."""
    rng = random.Random(31)
    shared = {n: sentence(rng, 200).encode()[:n].decode() for n in (400, 401, 450, 700)}
    rows = [f"{sentence(rng, 30)}{k}|{shared[n]}|{k}{sentence(rng, 30)}" for n in shared for k in "xyz"]
    almost = sentence(rng, 200)[:397]  # with the bars 399 bytes
    clean = [f"{sentence(rng, 30)}{k}|{almost}|{k}{sentence(rng, 30)}" for k in "xyz"] + [sentence(rng, 300) for _ in range(5)]
    got = by_id(suffix_dedup.remove_repeats(documents(spark, rows + clean)))
    # the bars on both sides are shared as well
    assert [got[i].n_removed for i in range(12)] == [n + 2 for n in shared for _ in range(3)]
    assert all(got[i].n_removed == 0 for i in range(12, 20))


def test_strip_keeps_columns_and_nulls(spark):
    docs = documents(spark)
    out = suffix_dedup.strip_repeats(docs)
    digest = by_id(suffix_dedup.remove_repeats(docs))
    assert out.columns == docs.columns
    for r in out.collect():
        assert r.th == r.spans == "en" and (r.text is None) == (texts()[r.doc_id] is None)
        assert hashlib.sha256((r.text or "").encode()).hexdigest() == digest[r.doc_id].kept_sha256


@pytest.mark.parametrize("crowd", [6000, 2])
def test_passages_match_all_windows_of_words(spark, crowd, monkeypatch):
    plain = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda t, n, code=suffix_dedup.encoded: plain(t, n, crowd, code))
    rng = random.Random(5)
    shared = " ".join(f"a{i}" for i in range(70)).split(" ")
    rows = texts(3) + [f"é{sentence(rng, 9)} {(' ', chr(10))[k % 2].join(shared[k : k + 50 + k])}\t {sentence(rng, 9)}日" for k in range(6)] + ["日本語" * 60 + str(i) for i in range(2)] + ["w " * 60]
    got = by_id(suffix_dedup.strip_repeats(documents(spark, rows), words=51))
    raws = [(t or "").encode() for t in rows]
    at = [[m.span() for m in re.finditer(rb"[^ \t-\r]+", r)] for r in raws]
    windows = [[tuple(r[a:b] for a, b in w[i : i + 51]) for i in range(len(w) - 50)] for r, w in zip(raws, at)]
    seen = Counter(x for own in windows for x in own)
    for i, (raw, flags) in enumerate(zip(raws, covered(raws, 400))):
        for k, x in enumerate(windows[i]):
            if seen[x] > 1:
                flags[at[i][k][0] : at[i][k + 50][1]] = True
        assert (got[i].text or "").encode() == bytes(np.frombuffer(raw, np.uint8)[~flags]).decode("utf-8", "ignore").encode()


def test_pieces_of_a_long_text_give_the_same_contexts(monkeypatch):
    rng = random.Random(8)
    raw = sentence(rng, 3000).encode()
    raws = [raw, raw[1000:9000], b"x" * 2000]

    def windows():
        return {(t, a, p) for g in suffix_dedup.pieces(raws, 400) for t, a, _, lo, hi, _ in zip(*suffix_dedup.contexts(g, 400)) for p in range(lo, hi + 1)}

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "PIECE", 1500)
    assert windows() == whole and len(whole) == sum(len(r) - 399 for r in raws)


def test_suffix_array_sorts_suffixes():
    rng = random.Random(1)
    for _ in range(400):
        s = [rng.randrange(rng.choice([1, 2, 5, 255])) for _ in range(rng.randrange(60))]
        assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


# 6: toxicity


def test_toxicity_on_held_out_rows_and_identity_terms(spark):
    rng = random.Random(6)
    bad = ("idiot", "scum", "moron")
    rows = [sentence(rng, 30) + ("" if i % 4 else f" {rng.choice(bad)} {rng.choice(bad)}") + rng.choice(("", " women", " men")) for i in range(600)]
    docs = documents(spark, rows + [None, ""], extra=False)
    marks = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)], "doc_id bigint, quality int, toxic int")
    got = by_id(toxicity.toxicity(docs, marks))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in range(600) if got[i].held_out]
    assert sum(got[i].predicted == int(i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert 0 <= got[600].score == got[601].score < 0.3
    model = toxicity.fit_toxicity(docs, marks, where=~toxicity.held_out())
    a, b = model.scores(["the women met", "the men met"])
    assert abs(a - b) < 0.05 and max(a, b) < 0.3


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = documents(spark, [f"{'bad' if i % 3 == 0 else 'good'} words {i}" for i in range(120)], extra=False)
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id bigint, quality int, toxic int")
    other = marks.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {i: r.score for i, r in by_id(toxicity.toxicity(docs, marks)).items()} == {i: r.score for i, r in by_id(toxicity.toxicity(docs, other)).items()}


def plain_score(model, text):
    """The score of a text by loops over its words and their n-grams."""
    total = 0.0
    for w in toxicity.words_of(text):
        row = toxicity.word_rows([w])
        total += sum(float(model.weights[c]) for c in row.cols.tolist())
        assert len(row.cols) == 1 + sum(max(0, len(w.encode()) + 2 - n + 1) for n in toxicity.ORDERS)
    return 1 / (1 + math.exp(-(model.scale * (model.bias + total) + model.shift)))


def test_penalty_on_identity_swaps(spark):
    """A term that goes with the label moves the score without the penalty, and hardly with it; scores are as plain loops give them."""
    rng = random.Random(8)
    rows, toxic = [], []
    for i in range(800):
        bad = i % 3 == 0
        term = rng.choice(("muslim", "women")) if rng.random() < (0.7 if bad else 0.05) else rng.choice(("christian", "men")) if rng.random() < 0.3 else ""
        rows.append(f"{sentence(rng, 15)} {term} {rng.choice(('idiot', 'scum', 'moron')) if bad and rng.random() < 0.8 else ''} {sentence(rng, 5)}")
        toxic.append(int(bad))
    docs = documents(spark, rows, extra=False)
    marks = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id bigint, quality int, toxic int")
    gap = {}
    for penalty in (0.0, 1.0):
        model = toxicity.fit_toxicity(docs, marks, penalty=penalty)
        pairs = [(f"the {a} met here", f"the {b} met here") for a, b in (("muslim", "christian"), ("women", "men"))]
        gap[penalty] = max(abs(x - y) for x, y in (model.logits(list(p)) for p in pairs))
        insult = model.scores(["the scum and the idiot met here", "the river met here"])
        assert insult[0] > 0.3 > insult[1]
        probe = [*rows[:20], "", "É straße scum", "the muslim women"]
        assert np.allclose(model.scores(probe), [plain_score(model, t) for t in probe], atol=1e-6)
    assert gap[1.0] < 0.35 * gap[0.0]


# 10: Jaccard join


def components(sets, percent):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize("k,percent,task", [(3, 90, 200), (5, 80, 4), (2, 50, 200), (2, 50, 3)])
def test_jaccard_components_match_all_pairs(spark, k, percent, task):
    rows = texts(7) + ["one", "ONE", "two words", "two Words x"]
    sets = [shingles(t, k) for t in rows]
    want = components(sets, percent)
    got = by_id(jaccard.jaccard_components(documents(spark, rows).repartition(3), k, percent, task))
    assert {i: (len(sets[i]), want[i]) for i in range(len(rows))} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_local_join_matches_all_pairs():
    for seed in range(120):
        rng = random.Random(seed)
        base = [set(rng.sample(range(300), rng.randrange(5, 60))) for _ in range(4)]
        sets = set()
        for _ in range(rng.randrange(2, 40)):
            s = set(rng.choice(base))
            for _ in range(rng.randrange(5)):
                if rng.random() < 0.5 and len(s) > 1:
                    s.discard(rng.choice(sorted(s)))
                else:
                    s.add(rng.randrange(2000))
            sets.add(frozenset(s))
        sets = [set(s) for s in sets]
        df = Counter(t for s in sets for t in s)
        for percent in (60, 80, 90):
            ordered = [np.array(sorted((t for t in s if df[t] > 1), key=lambda t: (df[t], t)), np.int64) for s in sets]
            assert jaccard.join_sets(ordered, [len(s) for s in sets], percent) == components(sets, percent)


def test_keep_one_of_each_component(spark):
    rows = texts(7)
    docs = documents(spark, rows)
    docs = docs.unionByName(docs.where("doc_id IN (6, 7)"))  # repeated rows
    out = jaccard.keep_one(docs, 5, 80)
    want = components([shingles(t, 5) for t in rows], 80)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want)) and {r.th for r in out.collect()} == {"en"}


# all: empty tables


def test_empty_tables(spark):
    docs, marks = documents(spark, []), labels(spark, 0).limit(0)
    import public_tokenizers

    json_path = public_tokenizers.path("byte_bpe_50k.json")
    for df in (
        quality.quality_rules(docs, marks), sharding.shard_documents(docs), pii.find_personal_data(docs), packing.pack_documents(docs, json_path),
        quality.keep_good(docs, marks), pii.redact_documents(docs), suffix_dedup.strip_repeats(docs, words=51), suffix_dedup.remove_repeats(docs), toxicity.toxicity(docs, marks), jaccard.jaccard_components(docs), jaccard.keep_one(docs), suffix_dedup.strip_repeats(docs),
    ):
        assert df.count() == 0


def test_repeated_rows_and_null_ids(spark):
    docs = documents(spark, ["same text of a few words here " * 20, "other words " * 30], extra=False)
    docs = docs.unionByName(docs).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")))
    assert sharding.shard_documents(docs).count() == 5
    assert suffix_dedup.remove_repeats(docs).where("doc_id IS NULL").first().n_removed == len("same text of a few words here " * 20)
    assert quality.quality_rules(docs, labels(spark)).count() == toxicity.toxicity(docs, labels(spark)).count() == 5
    got = jaccard.jaccard_components(docs).where("doc_id IS NULL").first()
    assert got.component_id == 0
    assert pii.find_personal_data(docs).count() == 5
