"""Decontamination against a direct search for every window."""

import hashlib
import re

from veildesk.llm import decontamination as D


def words_by_hand(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def check(docs, items):
    windows = {}
    for item in items.select("item_id", "text").collect():
        words = words_by_hand(item["text"])
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item["item_id"])
    sizes = {len(w) for w in windows}
    want = []
    for row in docs.select("doc_id", "text").collect():
        words, hit, named = words_by_hand(row["text"]), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (got := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    named |= got
        ids = sorted(str(x) for x in named if x is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        want.append((row["doc_id"], len(words), len(hit), len(ids), digest, bool(hit)))
    found = [tuple(r) for r in D.decontaminate(docs, items).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    return want


def test_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    want = check(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)


def test_odd_rows(spark, documents_of, odd_rows):
    docs = documents_of(odd_rows)
    items = spark.createDataFrame(
        [
            (1, "Two, THREE four"),
            (1, "Two, THREE four"),
            (2, "beta gamma delta alpha beta gamma delta alpha beta gamma delta alpha"),
            (3, "漢字"),
            (4, None),
            (5, "..."),
            (None, "same text twice"),
            (6, "text"),
            (7, "text"),
        ],
        "item_id long, text string",
    )
    want = {w[0]: w for w in check(docs, items)}
    assert want[5][2] == 80_000 - 1 and want[8][3] == 1 and want[6][2:4] == (3, 2)
    check(docs, items.where("1 = 0"))
    check(docs.where("1 = 0"), items)
    clean = D.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == [0, 2, 3, 4]


def test_a_full_bitmap_only_makes_more_candidates(documents_of, odd_rows, spark):
    docs = documents_of(odd_rows[:1])
    items = spark.createDataFrame([(1, "seven eight nine")], "item_id long, text string")
    assert [r["n_hit"] for r in D.decontaminate(docs, items, slots=32_768).collect()] == [3]
    assert [r["n_hit"] for r in D.decontaminate(docs, items, slots=8).collect()] == [3]


def test_a_table_of_texts_alone(spark):
    window = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(f"x {window} y",), ("clean",), (None,), ("",)], "text string")
    items = spark.createDataFrame([(1, window)], "item_id long, text string")
    kept = D.clean_documents(docs, items)
    assert kept.columns == ["text"] and {r.text for r in kept.collect()} == {"clean", None, ""}
    assert D.clean_documents(docs, items.where("false")).count() == 4
