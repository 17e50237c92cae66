"""The whole collection takes part, and repeated rows have a defined result."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import languages, packing, personal_information, subjects, term_counts, uniform_text
from tidemill.llm.leakage import leaking_documents, leaks


def test_subjects_train_on_every_judged_sentence(spark, monkeypatch):
    n = 21_000
    spell = F.translate(F.format_string("%05d", "id"), "0123456789", "abcdefghij")
    docs = spark.range(n).select(F.concat(F.lit("It was a quiet "), spell, F.lit(". Many people said hello to "), spell, F.lit(". Indeed.")).alias("text"))
    samples = spark.createDataFrame([("the judge upheld the clause", "law"), ("the team won the race", "sport")], "text string, subject string")
    trained = []

    def train(blocks, model, parts=1, **_):
        if isinstance(blocks, list):
            trained.append(sum(len(b[4]) // 4 for b in blocks))
            return model
        sizes = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum(F.length("lengths") / 4).alias("n")).collect()}
        assert len(sizes) == parts and max(sizes.values()) - min(sizes.values()) <= 8
        trained.append(sum(sizes.values()))
        return model

    monkeypatch.setattr(subjects, "train", train)
    subjects.fit(samples, docs, ["law", "sport"])
    assert trained == [2, 2 * n + 1 + 2]


def test_company_counts_documents_of_two_sentences(spark):
    docs = spark.createDataFrame([("The judge upheld it. She smiled. She smiled.",), ("One alone.",)], "text string")
    uses = {r.wording: r.n for r in subjects.company(subjects.parsed(docs, None), subjects.Model.fresh(["law", "sport"])).collect()}
    assert uses == {"the": 1, "judge": 1, "upheld": 1, "it": 1, "the judge": 1, "judge upheld": 1, "upheld it": 1, "she": 2, "smiled": 2, "she smiled": 2}


def test_judged_alike_however_marks_travel(spark, monkeypatch):
    r = random.Random(3)
    word = lambda: r.choice("abcdefghij") * r.randrange(1, 4)
    docs = spark.createDataFrame([("\n".join(" ".join(word() for _ in range(r.randrange(1, 9))) for _ in range(5)),) for _ in range(200)], "said string")
    wordings = {x for _ in range(60) for x in (word(), f"{word()} {word()}")}
    marks = spark.createDataFrame([(x, *(r.choice([0, 0, 1]) for _ in range(3)), r.choice([0, 0, 1])) for x in sorted(wordings)], "wording string, own_0 int, own_1 int, own_2 int, some int")
    found = []
    for most in (1000, 0):
        monkeypatch.setattr(subjects, "MAX_SENT_WORDINGS", most)
        found.append({(x.words, tuple(x.targets)) for x in subjects.judged(docs, marks, 3).collect()})
    assert found[0] == found[1] and len(found[0]) > 100


def test_words_are_told_by_all_their_letters():
    a, b = "x" * 50 + "a", "x" * 50 + "b"
    w = subjects.Words([f"{a} {b} {a}\nq", "", f"{b}"])
    assert w.word[0] == w.word[2] != w.word[1] == w.word[4] and w.doc.tolist() == [0, 0, 2] and w.first.tolist() == [0, 3, 4]
    assert [w.string(i) for i in range(5)] == [a, b, a, "q", b] and w.sentences(np.array([1, 2])) == ["q", b]
    assert subjects.word_buckets(a) != subjects.word_buckets(b)


def test_samples_are_bounded_by_class(spark, monkeypatch):
    monkeypatch.setattr(subjects, "MAX_SAMPLES", 4)
    samples = spark.createDataFrame([(f"text {'abcdefgh'[k]} here", s) for s in ("law", "sport") for k in range(6)] + [("x y", "other"), (None, "law")], "text string, subject string")
    rows = subjects.sample_rows(samples, ["law", "sport"], "text", "subject")
    assert sorted(t for _, t in rows) == [[0.0, 1.0]] * 2 + [[1.0, 0.0]] * 2


def test_leaks_of_repeated_items(spark):
    a, b = [" ".join(f"{x}{i}" for i in range(12)) for x in "ab"]
    docs = spark.createDataFrame([(1, a), (1, a), (2, b), (3, f"{a} {b}")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, a), (7, a), (8, a), (8, b)], "item_id bigint, text string")
    assert sorted(map(tuple, leaking_documents(docs, items, "doc_id", "item_id").collect())) == [(1, 7), (1, 8), (2, 8), (3, 7), (3, 8)]
    assert sorted(map(tuple, leaks(docs, items, "doc_id", "item_id").collect())) == [(1, 7, 3, 12), (1, 8, 3, 12), (2, 8, 3, 12), (3, 7, 3, 12), (3, 8, 6, 24)]


def test_cosines_are_those_of_the_bundles():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.choice([1, 3, 8, 60])))
    p = languages.fit_samples([(" ".join(word() for _ in range(40)), k) for k in "xyz" for _ in range(5)])
    said = [[word() for _ in range(n)] for n in (1, 2, 30, 7)]
    starts = np.r_[0, np.cumsum([len(s) for s in said])[:-1]]
    for most in (languages.BUNDLE, 3):
        languages.BUNDLE, before = most, languages.BUNDLE
        got, _ = p.cosines(p.rows([w for s in said for w in s]), starts)
        languages.BUNDLE = before
        for s, c in zip(said, got):
            v = np.sum([p.space.gram(g).astype(int) for w in s for g in languages.grams(w)], axis=0)
            assert np.abs(p.matrix @ v / np.linalg.norm(v) - c).max() < 0.12 * np.abs(c).max() + 1e-3
    a, b = "q" * 45 + "a", "q" * 45 + "b"
    assert languages.grams(a) != languages.grams(b)
    assert languages._may_change(np.array([1.0, -5, 2, 3, -1, 4, -9, 1]), np.array([0, 3, 6]), np.array([0, 0, 0, 1, 1, 1, 2, 2])).tolist() == [2, 6, 1]


def test_sparse_identifiers_are_numbered(spark):
    r = random.Random(2)
    ids = [r.randrange(-(1 << 62), 1 << 62) for _ in range(3000)]
    rows = [(i, " ".join(r.choice("abcdefg") * 2 for _ in range(4))) for i in ids] + [(ids[0], "twice aa"), (None, "aa none")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    index = term_counts.term_index(df, "id").where("term = 'aa'").collect()
    held = {}
    for i, t in rows:
        held.setdefault(i, set()).update(t.split())
    assert sum(x.card for x in index) == sum("aa" in v for v in held.values()) and len(index) <= 2 * 4
    assert term_counts.term_counts(df, "id").where("term = 'twice'").first().documents == 1


def test_utilisation(spark):
    items = spark.createDataFrame([(i, 4) for i in range(10)], "id bigint, n bigint")
    kinds = spark.createDataFrame([("k", 10)], "kind string, size bigint")
    out = packing.utilisation(packing.fill(items, kinds, "id", "n", "kind", "size"), kinds, "kind", "size").collect()
    assert [tuple(x) for x in out] == [("k", 5, 40, 0.8)]


def test_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "Café au lait " * 20_000, 1), (2, None, 1), (3, "", 1), (4, "Ｃafé au lait " * 20_000, 1)], "doc_id bigint, text string, h int")
    items = spark.createDataFrame([(1, "au lait café " * 6)], "item_id bigint, text string")
    assert leaking_documents(docs, items.limit(0), "doc_id", "item_id").count() == 0
    assert sorted(map(tuple, leaking_documents(docs, items, "doc_id", "item_id").collect())) == [(1, 1), (4, 1)]
    assert [tuple(r) for r in uniform_text.look_alike_pairs(docs, "doc_id").collect()] == [(1, 4)]
    samples = spark.createDataFrame([("the judge upheld the clause", "law"), ("the team won the race", "sport")], "text string, subject string")
    model = subjects.fit(samples, docs.limit(0), ["law", "sport"])
    assert subjects.subject_shares(docs, model, "doc_id").where("share > 1").count() == 0
    model = subjects.fit(samples, docs, ["law", "sport"])
    assert {r.doc_id for r in subjects.subject_shares(docs, model, "doc_id").collect()} <= {1, 4}
    profiles = languages.fit(spark.createDataFrame([("the dog is at home", "en"), ("der hund ist zu hause", "de")], "text string, lang string"), docs.limit(0).selectExpr("text", "'en' as lang"))
    assert languages.language_segments(docs, profiles, "doc_id").where("seg_no > 3").count() == 0
    for bad in (samples.limit(0),):
        with pytest.raises(ValueError):
            subjects.fit(bad, docs, ["law"])


def test_names_without_capitals_in_any_form(spark):
    given = spark.createDataFrame([("Marlo",)], "given_name string")
    rows = [(i, f"Ask for Marlo Thistlewood at the desk number {'abcdefgh'[i]}.") for i in range(8)]
    rows += [(10, "ask for marlo thistlewood now"), (11, "ask for mаrlo thistlewood now"), (12, "ask for ｍarlo thistlewood now"), (13, "ask for mar​lo thistlewood now"), (14, "marlo went home, thistlewood too")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = {(r.id, r.start_at) for r in personal_information.find_personal(df, given, "id").where("kind = 'person'").collect()}
    assert got == {(i, 9) for i in (*range(8), 10, 11, 12, 13)}
