"""Quality rules: measures against plain Python and SQL, and the hosts' shrinkage."""

import re
from collections import defaultdict

import pytest

import veildesk.llm.queries as Q
from veildesk.checks.compare import connect, difference
from veildesk.llm import quality_hosts as H


def measures_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def check(docs):
    given = [(r["doc_id"], measures_by_hand(r["text"])) for r in docs.select("doc_id", "text").collect()]
    want = [(i, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]) for i, m in given]
    found = H.judge(docs).collect()
    assert sorted([tuple(r)[:7] for r in found], key=repr) == sorted(want, key=repr)
    assert not any(r["base_failed"] and r["kept"] for r in found)
    return found


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_sql(spark, sf_dir, scale):
    sf_dir = sf_dir.replace("sf0.001", scale)
    name = "op10_quality_rules"
    assert difference(Q.QUERIES[name](spark, sf_dir), connect(sf_dir), Q.ORACLES[name]) is None


def test_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    found = {r["doc_id"]: r for r in check(docs)}
    clean = [found[r["doc_id"]] for r in labels if r["quality"] == 1]
    junk = [found[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert all(r["kept"] or r["base_failed"] for r in clean)
    assert sum(not r["kept"] for r in junk) > 0.9 * len(junk)


def test_odd_rows(documents_of, odd_rows):
    repeated = "a b c d e f g h i j " * 3
    docs = documents_of(
        [*odd_rows, (20, repeated), (21, "x " * 7 + "x"), (22, "x " * 8 + "x"), (23, "a\n\na\n \n b\nb")]
    )
    check(docs)
    assert H.judge(docs.where("1 = 0")).count() == 0
    kept = H.kept_documents(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in H.judge(docs).where("kept").collect())
    assert sorted(r["doc_id"] for r in kept.collect()) == ids
    assert H.kept_documents(docs.where("1 = 0")).count() == 0


GOOD = "this is a plain sentence of quite ordinary words number {} that no rule should ever want to reject at all here"


def test_host_verdicts(documents_of):
    rows = [(i, GOOD.format(i), f"host{i % 10}") for i in range(200)]
    rows += [(1000 + i, "# # # # # # # #", "host3") for i in range(180)]
    rows += [(2000, GOOD.format("x"), None), (2001, "# #", "tiny"), (2002, GOOD.format("y"), "tiny")]
    rows += [(3000 + i, GOOD.format("# & # & #"), f"host{3 + i}") for i in range(2)]
    found = {r["doc_id"]: r for r in H.judge(documents_of(rows)).collect()}
    # Clean documents of a rejected host stay, borderline ones go; elsewhere they stay as well.
    assert found[3]["host_rate"] > 0.5 and found[3]["kept"]
    assert not found[3000]["kept"] and found[3001]["kept"]
    assert found[4]["kept"] and found[2000]["kept"]
    # One failure of two is little evidence: the rate is drawn towards the other hosts'.
    assert found[2001]["host_rate"] < 0.5 and found[2002]["kept"]
    kept = {r["doc_id"] for r in H.kept_documents(documents_of(rows)).collect()}
    assert kept == {i for i, r in found.items() if r["kept"]}


def test_clean_documents_of_the_only_source_stay(documents_of):
    rows = [(i, GOOD.format(i), "one") for i in range(49)]
    rows += [(100 + i, "# " * 40, "one") for i in range(51)]
    assert {r["doc_id"] for r in H.kept_documents(documents_of(rows)).collect()} == set(range(49))


def test_prior():
    alpha, beta = H.beta_prior(0.2, 0.2 * 0.8 / 11, 0.0)
    assert alpha == pytest.approx(2) and beta == pytest.approx(8)
    alpha, beta = H.beta_prior(0.2, 0.0, 0.1)  # no more spread than chance allows
    assert alpha / (alpha + beta) == pytest.approx(0.2) and alpha + beta > 1e5
    assert H.beta_prior(None, None, None) == (0.5, 0.5)
