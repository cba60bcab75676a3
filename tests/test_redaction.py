"""The whole plan, known values, placeholders, URLs and detectors."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from veildesk.functions.detectors import GazetteerDetector, TokenScoreDetector, run_detector
from veildesk.functions import spans as S
from veildesk.functions.text import needs_scan
from veildesk.functions.windows import token_table, window_bounds
from veildesk.plans import redaction as R
from veildesk.plans.propagation import first_words, propagate, scope_values
from veildesk.plans.vault import empty_vault, first_seen, number_values, pseudonym_key
from veildesk.schemas import SPANS, VAULT
from veildesk.sources.sinks import write_sanitized
from veildesk.staging import scratch_path

NAMES = GazetteerDetector(
    {"Olga": "PERSON_NAME", "Petrow": "PERSON_NAME", "Acme": "PROPER_NAME", "Suite": "PROPER_NAME"}
)


def clean(spark, rows, policy, columns=("body",), schema="id long, body string"):
    out = R.sanitize(spark.createDataFrame(rows, schema), ["id"], list(columns), policy)
    return [tuple(r)[1:] for r in out.frame.orderBy("id").collect()], out.vault


def test_sentence(spark):
    text = "Order for Olga Petrow (olga.p@shop.example) - call back on +49 30 1234 5678 please"
    out, _ = clean(spark, [(1, text)], R.Policy(detector=NAMES))
    assert out == [
        ("Order for [PERSON_NAME_1] ([EMAIL_ADDRESS_1]) - call back on [PHONE_NUMBER_1] please",)
    ]


def test_same_value_same_number_across_records_and_spellings(spark):
    rows = [(1, "Olga-Petrow"), (2, "olga petrow wrote, not Olga"), (3, "ask Olga_Petrow")]
    names = GazetteerDetector({**NAMES.terms, "olga": "PERSON_NAME", "petrow": "PERSON_NAME"})
    out, vault = clean(spark, rows, R.Policy(detector=names))
    assert out == [
        ("[PERSON_NAME_1]",),
        ("[PERSON_NAME_1] wrote, not [PERSON_NAME_2]",),
        ("ask [PERSON_NAME_1]",),
    ]
    assert vault.count() == 2


def test_known_value_of_one_field_is_redacted_in_another(spark):
    class FirstField(GazetteerDetector):
        def detect(self, model, texts):
            return [[(0, len(t), "PERSON_NAME")] if t == "Zed Quark" else [] for t in texts]

    rows = [(1, "Zed Quark", "mail from Zed Quark; Zed Quarks"), (2, "x1", "Zed Quark here")]
    schema = "id long, name string, body string"
    policy = R.Policy(detector=FirstField({}, "first"), pseudonyms=False)
    out, _ = clean(spark, rows, policy, ["name", "body"], schema)
    assert out == [
        ("[PERSON_NAME]", "mail from [PERSON_NAME]; Zed Quarks"),
        ("x1", "Zed Quark here"),
    ]
    wide = spark.createDataFrame(rows, schema).withColumn("desk", F.lit(1))
    policy = R.Policy(detector=FirstField({}, "first"), pseudonyms=False, scope=["desk"])
    got = R.sanitize_df(wide, ["id"], ["name", "body"], policy).orderBy("id").collect()
    assert got[1].body == "[PERSON_NAME] here"


def test_allow_and_keep(spark):
    policy = R.Policy(detector=NAMES, allow=["ACME"], keep=["email_address"], pseudonyms=False)
    out, _ = clean(spark, [(1, "Acme Suite of a@b.co")], policy)
    assert out == [("Acme [PROPER_NAME] of a@b.co",)]


def test_nested_columns_maps_and_json(spark):
    df = spark.sql("""
        select 1L as id,
               named_struct('n', 5, 'who', 'a@b.co', 'list', array('x', 'c@d.co', null)) as tree,
               map('a@b.co', 'mail a@b.co') as labels,
               parse_json('{"k": 7, "to": ["e@f.co", {"deep": "call a@b.co"}]}') as body""")
    row = R.sanitize_df(df, ["id"], ["tree", "labels", "body"]).select(
        "id", "tree", "labels", F.to_json("body").alias("body")
    ).first()
    assert (row.tree.n, row.tree.who) == (5, "[EMAIL_ADDRESS_1]")
    assert row.tree.list == ["x", "[EMAIL_ADDRESS_2]", None]
    assert row.labels == {"a@b.co": "mail [EMAIL_ADDRESS_1]"}
    assert row.body == '{"k":7,"to":["[EMAIL_ADDRESS_3]",{"deep":"call [EMAIL_ADDRESS_1]"}]}'


def test_deeply_nested_columns_with_every_option(spark):
    df = spark.sql("""
        select 1L as id, array(array(map('k', 'mail a@b.co'))) as deep,
               named_struct('list', array('x', 'https://d.example/t/c@d.co?x=a@b.co')) as tree""")
    policy = R.Policy(pseudonyms=False, site="https://d.example", allow=["never there"])
    row = R.sanitize_df(df, ["id"], ["deep", "tree"], policy).first()
    mail = "%5BEMAIL_ADDRESS%5D"
    assert row.deep == [[{"k": "mail [EMAIL_ADDRESS]"}]]
    assert row.tree.list == ["x", f"https://d.example/t/{mail}?x={mail}"]


def test_urls(spark):
    rows = [
        (1, "https://d.example/t/a%40b.co?x=1"),
        (2, "https://d.example/%zz/ok"),
        (3, "https://d.example/s?q=a@b.co&q=c&y=2"),
        (4, "https://other.example/u/a@b.co"),
        (5, "https://d.example/p?a=1#a@b.co"),
        (6, "see https://d.example/t/a@b.co now"),
    ]
    mail = "%5BEMAIL_ADDRESS%5D"
    out, _ = clean(spark, rows, R.Policy(pseudonyms=False, site="https://d.example"))
    assert [o for (o,) in out] == [
        f"https://d.example/t/{mail}?x=1",
        "https://d.example/%zz/ok",
        f"https://d.example/s?q={mail}&q=c&y=2",
        "https://other.example/u/[EMAIL_ADDRESS]",
        f"https://d.example/p?a=1#{mail}",
        "see https://d.example/t/[EMAIL_ADDRESS] now",
    ]
    strict = R.Policy(
        pseudonyms=False, site="https://d.example", scan_fragment=False, keep_repeated=False
    )
    out, _ = clean(spark, rows, strict)
    assert out[2] == (f"https://d.example/s?q={mail}&y=2",)
    assert out[4] == ("https://d.example/p?a=1#a@b.co",)


def test_plans_agree(spark, sf_dir):
    """Narrow, numbered and scoped plans redact the same places."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plain = R.sanitize_df(docs, ["doc_id"], ["text"], R.Policy(pseudonyms=False))
    numbered = R.sanitize_df(docs, ["doc_id"], ["text"]).withColumn(
        "text", F.regexp_replace("text", "_[0-9]+\\]", "]")
    )
    scoped = R.sanitize_df(
        docs, ["doc_id"], ["text"], R.Policy(pseudonyms=False, scope=["doc_id"])
    )
    assert plain.exceptAll(numbered).count() == 0
    assert plain.exceptAll(scoped).count() == 0


def test_nothing_detected_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = R.sanitize_df(docs, ["doc_id"], ["text"], R.Policy(pseudonyms=False))
    again = R.redaction_report(done, ["doc_id"], ["text"])
    assert again.count() == 0


# ------------------------------------------------------------------ known values


def known_by_hand(text, values):
    alternatives = "|".join(re.escape(v) for v in sorted(values, key=len, reverse=True))
    pattern = rf"(?<![^\W_])(?:{alternatives})(?![^\W_])"
    return [(m.start(), m.end(), values[m.group()]) for m in re.finditer(pattern, text)]


def test_known_values_match_brute_force(spark):
    rng = random.Random(3)
    words = ["ann", "bo", "+1", "x-y", "lee", "(zed)", "q.", "ann-lee", "12 34"]
    values = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(25)})
    values = {v: f"T{i % 3}" for i, v in enumerate(values) if re.search(r"[^\W_]", v)}
    texts = [
        rng.choice(["", "(", "x"]) + " ".join(rng.choices(words + ["annlee", "é"], k=30))
        for _ in range(30)
    ]
    cells = spark.createDataFrame(
        [((i,), (i % 2,), 0, t) for i, t in enumerate(texts)],
        "record struct<id:int>, scope struct<s:int>, cell int, text string",
    )
    known = spark.createDataFrame(
        [((s,), v, t) for v, t in values.items() for s in (0, 1)],
        "scope struct<s:int>, value string, type string",
    )
    expected = {i: known_by_hand(t, values) for i, t in enumerate(texts)}
    rows = propagate(cells, known).collect()
    got = {r.record.id: [(s.start, s.end, s.type) for s in r.spans] for r in rows}
    assert got == {i: spans for i, spans in expected.items() if spans}


def test_known_values_with_noncharacters_and_in_null_scopes(spark):
    value = "ann\uFDD0lee"
    cells = spark.createDataFrame(
        [((1,), (None,), 0, f"so {value}, and {value}"), ((2,), (7,), 0, value)],
        "record struct<id:int>, scope struct<s:int>, cell int, text string",
    )
    known = spark.createDataFrame(
        [((None,), value, "T")], "scope struct<s:int>, value string, type string"
    )
    rows = propagate(cells, known).collect()
    assert [(r.record.id, [(s.start, s.end) for s in r.spans]) for r in rows] == [
        (1, [(3, 10), (16, 23)])
    ]


def test_propagation_is_linear_in_a_text(spark):
    def seconds(n):
        text = " ".join(f"name{i % 997} word" for i in range(n))
        cells = spark.createDataFrame(
            [((1,), (1,), 0, text)],
            "record struct<id:int>, scope struct<s:int>, cell int, text string",
        )
        known = spark.createDataFrame(
            [((1,), f"name{i}", "T") for i in range(997)],
            "scope struct<s:int>, value string, type string",
        )
        start = time.perf_counter()
        assert propagate(cells, known).select(F.size("spans")).first()[0] == n
        return time.perf_counter() - start

    seconds(1_000)
    short, long = seconds(10_000), seconds(40_000)
    assert long < 10 * max(short, 1.0)


def test_words_shuffled_are_those_that_may_begin_a_value(spark):
    known = [(f"name{i} of {i}", "P") for i in range(300)]
    values = spark.createDataFrame(known, "value string, type string").withColumn("scope", F.lit(0))
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.concat(F.lit("w"), (F.col("id") * 200 + i).cast("string"))))
    cells = spark.range(500).select(
        F.col("id").alias("record"), F.lit(0).alias("scope"), F.lit(0).alias("cell"),
        F.concat(text, F.lit(" name"), (F.col("id") % 400).cast("string"), F.lit(" of "), (F.col("id") % 400).cast("string")).alias("text"),
    )
    anchors = values.select("scope", F.split("value", " ")[0].alias("word")).distinct()
    searched = cells.select("scope", "record", "cell", F.split("text", " ").alias("words"))
    passing = first_words(searched, anchors)
    real = passing.join(anchors, ["scope", "word"]).count()
    assert real == sum(i % 400 < 300 for i in range(500))
    # Of 101,500 words those that begin a value, and few others.
    assert real <= passing.count() <= 1.05 * real + 0.05 * 500
    plan = passing._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0].replace("ReusedExchange", "")
    assert propagate(cells, values).count() == real


@pytest.mark.parametrize("policy", [R.Policy(pseudonyms=False, scope=["id"]), R.Policy()], ids=["scoped", "numbered"])
def test_linear_in_the_texts_of_a_record(spark, policy):
    def seconds(n):
        texts = [f"turn {i} of user{i % 7}@mail.example" for i in range(n)]
        df = spark.createDataFrame([(1, texts)], "id long, turns array<string>")
        start = time.perf_counter()
        out = R.sanitize_df(df, ["id"], ["turns"], policy).first().turns
        assert len(out) == n and not any("@" in t for t in out)
        return time.perf_counter() - start

    seconds(500)
    short, long = seconds(4_000), seconds(8_000)
    assert long < 2.2 * max(short, 1.5)


def test_the_session_keeps_its_settings(spark):
    setting = "spark.sql.analyzer.maxIterations"
    before = spark.conf.get(setting)
    df = spark.createDataFrame([(1, "a@b.co")], "id long, body string")
    R.sanitize_df(df, ["id"], ["body"], R.Policy(pseudonyms=False))
    assert spark.conf.get(setting) == before


# ------------------------------------------------------------- keys of any kind

SECRETS = ("a@b.co", "c@d.co", "e@f.co")


@pytest.mark.parametrize(
    "policy",
    [
        R.Policy(pseudonyms=False),
        R.Policy(),
        R.Policy(pseudonyms=False, scope=["desk"]),
        R.Policy(scope=["desk"]),
        R.Policy(pseudonyms=False, detector=GazetteerDetector({})),
        R.Policy(detector=GazetteerDetector({})),
    ],
    ids=["narrow", "numbered", "scoped", "scoped-numbered", "detector", "detector-numbered"],
)
def test_null_repeated_and_composite_keys(spark, policy):
    rows = [
        (1, "x", 7, "mail a@b.co now"),
        (1, "x", 7, "c@d.co first, a longer text than the other of the same key"),
        (1, "x", 7, "mail a@b.co now"),
        (None, "y", 7, "to c@d.co"),
        (None, "y", None, "from e@f.co and a@b.co"),
        (None, None, None, "e@f.co"),
        (2, None, 8, "nothing here"),
        (3, None, 8, None),
    ]
    df = spark.createDataFrame(rows, "id long, part string, desk long, body string").repartition(5)
    out = R.sanitize_df(df, ["id", "part"], ["body"], policy).collect()
    assert len(out) == len(rows)
    mark = "[EMAIL_ADDRESS" + ("_" if policy.pseudonyms else "]")
    want = sorted("" if r[3] is None else re.sub(r"[a-z]@[a-z]\.co", "*", r[3]) for r in rows)
    assert sorted(re.sub(r"\[EMAIL_ADDRESS(_\d+)?\]", "*", r.body or "") for r in out) == want
    assert sum((r.body or "").count(mark) for r in out) == 7
    if policy.pseudonyms:
        assert {m for r in out for m in re.findall(r"_(\d)\]", r.body or "")} == {"1", "2", "3"}


def test_originals_of_nested_urls(spark):
    df = spark.createDataFrame(
        [
            (1, ["https://d.example/t/a@b.co", "https://d.example/ok"], "see https://d.example/t/c@d.co"),
            (2, None, "https://d.example/t/e@f.co"),
        ],
        "id long, links array<string>, body string",
    )
    done = R.sanitize(df, ["id"], ["links", "body"], R.Policy(site="https://d.example"))
    assert {(r.sanitized, r.original) for r in done.originals.collect()} == {
        ("https://d.example/t/%5BEMAIL_ADDRESS_1%5D", "https://d.example/t/a@b.co"),
        ("https://d.example/t/%5BEMAIL_ADDRESS_3%5D", "https://d.example/t/e@f.co"),
    }
    assert "original" not in done.frame.columns


def test_report_counts_what_the_policy_does(spark):
    df = spark.createDataFrame(
        [(1, ["Acme Suite", "mail a@b.co"]), (2, ["Acme"]), (3, [])], "id long, body array<string>"
    )
    policy = R.Policy(detector=NAMES, allow=["acme"], keep=["email_address"])
    rows = R.redaction_report(df, ["id"], ["body"], policy).collect()
    assert sorted(tuple(r) for r in rows) == [
        (1, "EMAIL_ADDRESS", 1, 1, 0), (1, "PROPER_NAME", 2, 0, 1), (2, "PROPER_NAME", 1, 0, 0),
    ]


def test_first_type_wins_in_a_scope(spark):
    hits = spark.createDataFrame(
        [((2,), (1,), 0, "Ann", [(0, 3, "B")]), ((1,), (1,), 0, "Ann", [(0, 3, "A")])],
        f"record struct<id:int>, scope struct<s:int>, cell int, text string, spans {SPANS}",
    )
    assert [r.type for r in scope_values(hits).collect()] == ["A"]


# ------------------------------------------------------------------ placeholders


def test_pseudonym_key(spark):
    values = ["Hans-Mueller", "hans  mueller", "Ａnn", "a_b.c", " x ", "ÉCOLE"]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(pseudonym_key("v"))
    assert [r[0] for r in rows.collect()] == [
        "hans mueller", "hans mueller", "ann", "a b c", "x", "école",
    ]


def seen_rows(spark, rows):
    return first_seen(spark.createDataFrame(rows, "key string, type string, seen long"))


def test_numbers_go_on_from_the_vault(spark):
    first = number_values(
        seen_rows(spark, [("a", "P", 1), ("b", "P", 2), ("a", "Q", 0), ("c", "Q", 9)]),
        empty_vault(spark),
    )
    rows = {r.key: r.placeholder for r in first.collect()}
    assert rows == {"a": "[Q_1]", "b": "[P_1]", "c": "[Q_2]"}
    second = number_values(seen_rows(spark, [("a", "P", 5), ("d", "Q", 3), ("e", "P", 4)]), first)
    assert {r.key: r.placeholder for r in second.collect()} == {"d": "[Q_3]", "e": "[P_2]"}


def test_numbering_of_a_type_in_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 16).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") % 10 == 0, "RARE").otherwise("COMMON").alias("type"),
        F.hash("id").alias("seen"),
    )
    got = number_values(first_seen(rows), empty_vault(spark)).join(
        rows.select("key", "seen"), "key"
    )
    for kind, n in (("RARE", 500), ("COMMON", 4500)):
        ranks = [r.n for r in got.where(F.col("type") == kind).orderBy("seen").collect()]
        assert ranks == list(range(1, n + 1))


def test_partitioning_does_not_change_the_result(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = R.sanitize_df(docs.coalesce(1), ["doc_id"], ["text"])
    many = R.sanitize_df(docs.repartition(13), ["doc_id"], ["text"])
    assert one.exceptAll(many).count() == 0


def test_texts_whose_values_stand_once_are_not_searched(spark):
    text, known = F.col("t"), F.col("k")
    kind = "array<struct<value:string,type:string>>"
    texts = ["mail a@b.co now", "a@b.co or a@b.co", "xa@b.co", "a@b.co of c.d@e.fr", "a@a.a@a.a"]
    values = [["a@b.co"], ["a@b.co"], [], ["a@b.co", "c.d@e.fr"], ["a@a.a"]]
    rows = [(i, t, [(x, "P") for x in v]) for i, (t, v) in enumerate(zip(texts, values))]
    df = spark.createDataFrame(rows, f"i int, t string, own {kind}")
    df = df.withColumn("k", F.when(F.col("i") == 2, F.array(F.struct(F.lit("a@b.co"), F.lit("P"))).cast(kind)).otherwise(F.col("own")))
    alone = df.select("i", F.exists(known, lambda k: ~S.only_there(text, k["value"], F.col("own"))).alias("searched"))
    assert [r.searched for r in alone.orderBy("i").collect()] == [False, True, True, False, True]
    found = df.select("i", F.size(S.match_known(text, known, F.col("own"))).alias("n"))
    assert [r.n for r in found.orderBy("i").collect()] == [0, 2, 0, 0, 1]


def test_records_of_one_file_are_dealt_to_many_tasks(spark):
    rows = spark.range(40_000).select("id", F.concat(F.lit("mail a"), "id", F.lit("@b.co")).alias("body"))
    tasks = R.with_rows(rows.coalesce(1)).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4 and sum(t["count"] for t in tasks) == 40_000


# -------------------------------------------------------------------- detectors


def test_windows():
    def sizes(text):
        return [b - a for a, b in window_bounds(token_table(text), text)]

    assert sizes(" ".join(["w"] * 199 + ["stop."] + ["w"] * 55)) == [200, 55]
    assert sizes(" ".join(["w"] * 255)) == [254, 1]
    assert sizes("one") == [1]
    assert sizes(" ".join(["w"] * 600)) == [254, 254, 92]
    assert sizes("") == []
    text = " ".join(["word"] * 200)
    pieces = token_table(text, lambda w: [3, 1])
    assert [b - a for a, b in window_bounds(pieces, text)] == [254, 146]
    assert [tuple(t) for t in token_table("john_smith.pdf")] == [(0, 4, 0), (5, 14, 1)]


def test_window_cuts_keep_words_whole():
    text = " ".join(["longword"] * 100)
    pieces = token_table(text, lambda w: [3, 3, 2])
    assert [b - a for a, b in window_bounds(pieces, text)] == [252, 48]


def test_token_scores(spark):
    def open_model():
        def score(texts, tables):
            out = []
            for text, tokens in zip(texts, tables):
                upper = np.array([text[s].isupper() for s, _, _ in tokens])
                out.append(np.stack([~upper * 4.0, upper * 3.0, upper * 3.0], axis=1))
            return out

        return score

    detector = TokenScoreDetector(open_model, ["O", "B-PERSON_NAME", "ORG"], name="upper")
    out, _ = clean(spark, [(1, "call Ann Lee or bob")], R.Policy(detector=detector))
    assert out == [("call [PERSON_NAME_1] or bob",)]


def test_detectors_of_one_name_keep_apart(spark):
    def opened(column):
        def open_model():
            def score(texts, tables):
                out = []
                for tokens in tables:
                    logits = np.full((len(tokens), 3), -9.0)
                    logits[:, column] = 9.0
                    out.append(logits)
                return out

            return score

        return open_model

    texts = spark.createDataFrame([("d1", "one two")], "digest string, text string").coalesce(1)
    labels = []
    for column in (1, 2, 1):
        detector = TokenScoreDetector(opened(column), ["O", "B-FIRST", "B-SECOND"])
        row = run_detector(texts, detector).first()
        labels.append({s.type for s in row.spans})
    assert labels == [{"FIRST"}, {"SECOND"}, {"FIRST"}]


def test_labelling_leaves_the_logits_alone():
    logits = np.array([[1.0, 2.0, 3.0]])
    TokenScoreDetector(lambda: None, ["O", "B-A", "B-B"]).label(logits)
    assert logits.tolist() == [[1.0, 2.0, 3.0]]


def test_each_distinct_text_is_detected_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    texts = R.distinct_texts(docs.union(docs).where(needs_scan(F.col("text"))))
    found = run_detector(texts, GazetteerDetector({"the": "X"}))
    assert found.count() == docs.distinct().count()


class Broken(GazetteerDetector):
    def detect(self, model, texts):
        return [None for _ in texts]


class Unloadable(GazetteerDetector):
    def load(self):
        raise OSError("no weights")


@pytest.mark.parametrize("detector", [Broken({}, "broken"), Unloadable({}, "unloadable")])
def test_failure_writes_nothing(spark, detector):
    path = scratch_path(spark, "never")
    df = spark.createDataFrame([(1, "Ann")], "id long, body string")
    with pytest.raises(Exception):
        write_sanitized(df, path, ["id"], ["body"], R.Policy(detector=detector))
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_numbers_and_nulls_pass_through(spark):
    df = spark.createDataFrame([(1, 4785380592391139, None, 2.5)], "id long, n long, s string, d double")
    assert R.sanitize_df(df, ["id"], ["n", "s", "d"]).first() == df.first()


def test_vault_schema(spark):
    assert empty_vault(spark).schema == spark.createDataFrame([], VAULT).schema


def test_a_detector_gets_texts_by_their_characters(spark):
    class Counts:
        name = "counts"

        def load(self):
            return None

        def detect(self, model, texts):
            return [[(0, len(texts), "N")] for _ in texts]

    texts = spark.range(6).select(F.col("id").cast("string").alias("digest"), F.repeat(F.lit("x"), 600_000).alias("text"))
    found = run_detector(texts.coalesce(1), Counts())
    assert found.count() == 6
    assert found.agg(F.max(F.col("spans")[0]["end"])).first()[0] <= 2
