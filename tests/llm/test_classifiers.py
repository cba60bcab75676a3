"""Language identification and weak-label quality: held-out accuracy and odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import xxhash

from veildesk.llm import language_id as L
from veildesk.llm import linear
from veildesk.llm import weak_quality as Q


def test_language_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = L.identify(docs).collect()
    assert len(found) == len(lang)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_prediction_ignores_label_and_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.fit(docs, L.crc_bucket("doc_id", 3) != 1)
    first = docs.first()
    found = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs).collect()}
    assert model.predict(first["text"])[0] == found[first["doc_id"]]


def test_languages_of_one_family_and_of_none():
    rng = np.random.default_rng(0)
    centres = {c: rng.random(linear.DIMENSIONS) for c in ("es", "fr", "pt", "xx", "en-GB")}
    labels = [c for c in centres for _ in range(30)]
    x = np.stack([centres[c] + 0.1 * rng.random(linear.DIMENSIONS) for c in labels])
    model = L.train(labels, (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32))
    assert model.families == ["germanic", "romance", "xx"]
    assert model.languages["romance"] == ["es", "fr", "pt"] and len(model.pairs["romance"]) == 3
    assert model.weights.shape == (linear.DIMENSIONS + 1, 6)
    assert L.train([], np.zeros((0, linear.DIMENSIONS))).predict("abc") == ("und", 0.0)


def test_language_odd_rows(spark, documents_of, odd_rows):
    docs = documents_of([*odd_rows, (9, "12345 -- 678"), (10, "ʰ")])
    found = L.identify(docs).collect()
    assert len(found) == len(odd_rows) + 2
    by = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (2, 3, 4, 9))
    assert all(by[i]["lang_pred"] == "en" for i in (1, 5, 6, 8, 10))
    assert L.identify(docs.where("1 = 0")).count() == 0
    unlabelled = docs.withColumn("lang", L.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in L.identify(unlabelled).collect()} == {"und"}


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    raw = bytes(np.random.default_rng(1).integers(0, 256, 5_000, dtype=np.uint8))
    whole = linear.hashed_ngrams(raw)
    for chunk in (7, 100, 2_499, 4_998, 4_999, 5_000):
        monkeypatch.setattr(linear, "_CHUNK", chunk)
        assert (linear.hashed_ngrams(raw) == whole).all()
    assert linear.hashed_ngrams(b"").sum() == 0 and linear.hashed_ngrams(b"a").sum() == 0


def test_bounded_sample(spark):
    rows = [("a", f"t{i % 50}") for i in range(500)] + [("b", "same")] * 100 + [("c", "x")]
    df = spark.createDataFrame(rows, "g string, t string")
    found = linear.bounded_sample(df, L.F.col("g"), L.F.col("t"), 20).collect()
    assert sorted(r["group"] for r in found) == ["a"] * 20 + ["b", "c"]
    assert len({r["text"] for r in found}) == 22


def test_weak_labels_find_the_classes():
    """Votes drawn from known rates: the estimate recovers them without labels."""
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    rates = np.array([[0.7, 0.6, 0.5, 0.8, 0.4], [0.02, 0.05, 0.01, 0.03, 0.02]])
    junk = rng.random((20_000, 5)) < rates[good.astype(int)]
    votes = np.where(rng.random((20_000, 5)) < 0.2, Q.SILENT, np.where(junk, Q.JUNK, Q.GOOD))
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, table, posterior = Q.estimate(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.02 and np.abs(table - rates).max() < 0.05
    assert ((posterior[place.reshape(-1)] > 0.5) == good).mean() > 0.95


def test_quality_against_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = Q.score_quality(docs).collect()
    assert len(found) == docs.count()
    clean = [r["kept"] for r in found if labels.get(r["doc_id"]) == 1]
    junk = [r["kept"] for r in found if labels.get(r["doc_id"]) == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.1


def test_quality_odd_rows(documents_of, odd_rows):
    docs = documents_of([*odd_rows, (9, "### $$$ %%% &&& *** <<< >>> ### $$$")])
    found = Q.score_quality(docs).collect()
    assert len(found) == len(odd_rows) + 1
    assert all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in found)
    assert Q.score_quality(docs.where("1 = 0")).count() == 0


def ngrams_by_hand(raw):
    """Unit vector of the roots of hashed bi- and trigram counts, one n-gram after the other."""
    mask, counts = (1 << 32) - 1, Counter()
    for i in range(len(raw) - 1):
        two = (raw[i] * 0x9E3779B1 & mask) ^ (raw[i + 1] * 0x85EBCA77 & mask)
        counts[two >> 20] += 1
        if i + 2 < len(raw):
            counts[(two ^ (raw[i + 2] * 0xC2B2AE3D & mask)) >> 20] += 1
    total = sum(counts.values())
    return {k: math.sqrt(n / total) for k, n in counts.items()}


def language_by_hand(model, text):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    kept = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in text)
    kept = "".join(c.lower() if "A" <= c <= "Z" else c for c in kept)
    x = ngrams_by_hand(f" {kept} ".encode())
    w = model.weights.astype(float)
    margin = [sum(v * w[k, c] for k, v in x.items()) + w[-1, c] for c in range(w.shape[1])]
    level = [math.exp(4 * min(5, max(-5, m))) for m in margin[: len(model.families)]]
    family = model.families[level.index(max(level))]
    score = max(level) / sum(level)
    names = model.languages[family]
    if len(names) == 1:
        return names[0], score
    won, trust = Counter(), Counter()
    for a, b, column in model.pairs[family]:
        sure = 1 / (1 + math.exp(-4 * margin[column]))
        won[a if sure >= 0.5 else b] += 1
        trust[a] += sure
        trust[b] += 1 - sure
    best = max(range(len(names)), key=lambda k: (won[k], trust[k], -k))
    return names[best], score * trust[best] / (len(names) - 1)


def test_languages_recomputed_from_the_weights(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.fit(docs, L.crc_bucket("doc_id", 3) != 1)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in L.identify(docs).collect():
        language, score = language_by_hand(model, texts[row["doc_id"]])
        assert row["lang_pred"] == language and math.isclose(row["score"], score, abs_tol=2e-4)


def posteriors_by_hand(counts):
    """Expectation and maximisation over ``{votes: documents}``, one vote after the other."""
    good = {v: 0.1 if Q.JUNK in v else 0.9 for v in counts}
    total = sum(counts.values())
    for _ in range(200):
        share, table = [], []
        for side in (0, 1):
            weight = {v: n * (good[v] if side else 1 - good[v]) for v, n in counts.items()}
            share.append((sum(weight.values()) + 0.5) / (total + 1))
            rates = []
            for k in range(len(next(iter(counts)))):
                junk = sum(w for v, w in weight.items() if v[k] == Q.JUNK)
                voted = sum(w for v, w in weight.items() if v[k] != Q.SILENT)
                rates.append((junk + 0.5) / (voted + 1))
            table.append(rates)
        new = {}
        for v in counts:
            odds = [
                math.log(share[side])
                + sum(
                    math.log(r if vote == Q.JUNK else 1 - r)
                    for vote, r in zip(v, table[side], strict=True)
                    if vote != Q.SILENT
                )
                for side in (0, 1)
            ]
            new[v] = 1 / (1 + math.exp(min(700, odds[0] - odds[1])))
        moved = max(abs(new[v] - good[v]) for v in counts)
        if moved < 1e-9:
            break
        good = new
    return good


def test_quality_recomputed(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    votes = {i: Q.labellers(Q.Shape(t)) for i, t in texts.items()}
    good = posteriors_by_hand(Counter(votes.values()))
    # The scorer's sample: of each side the distinct texts of smallest hash, here all of them.
    sample = {}
    for i, t in texts.items():
        side = good[votes[i]]
        if t and not Q.SURE < side < 1 - Q.SURE:
            h = xxhash.xxh64_intdigest(t.encode(), 42)
            sample[h] = (int(side > 0.5), t)
    assert len(sample) < 2 * (Q.SAMPLE_ROWS // 2)
    found = [(g, linear.packed(linear.hashed_ngrams(Q._raw(t)))) for g, t in sample.values()]
    groups, x = linear.unpacked(found)
    weights = linear.train_logistic(x, np.array(groups, float)).astype(float)
    for row in Q.score_quality(docs).collect():
        text, posterior = texts[row["doc_id"]], good[votes[row["doc_id"]]]
        assert math.isclose(row["posterior"], posterior, abs_tol=1e-6)
        x = ngrams_by_hand(f" {text} ".encode())
        margin = sum(v * weights[k] for k, v in x.items()) + weights[-1]
        score = 1 / (1 + math.exp(-margin)) if text else 0.0
        assert math.isclose(row["score"], score, abs_tol=1e-4)
        if abs(posterior + score - 1) > 1e-3:
            assert row["kept"] == ((posterior + score) / 2 > 0.5)
