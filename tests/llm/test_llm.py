import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.llm import languages, packing, personal_information, subjects, term_counts
from tidemill.llm.capping import cap_contributors, shortcode, water_fill
from tidemill.llm.leakage import leaking_documents, leaks, words
from tidemill.llm.packing import BestFit, fill, token_count
from tidemill.llm.personal_information import find_personal, sanitise
from tidemill.llm.top_n import top_n
from tidemill.llm.uniform_text import Transducer, look_alike_pairs, rules, skeleton, uniform, uniform_text


# 1 look-alike text
@pytest.mark.parametrize(
    ("a", "b"),
    [("ｐｅａｎｕｔ　ｐａｓｔｅ！", "peanut paste!"), ("café", "café"), ("th​e d­og", "the dog"), ("a b c　d", "a b c d"), ("Νо dоg", "No dog"), ("ﬁne", "fine"), ("е‌́", "é"), ("моя cеcтрa", "моя сестра")],
)
def test_same_look_same_form(a, b):
    assert skeleton(a) == skeleton(b) and uniform(a) == uniform(b)


@pytest.mark.parametrize(("a", "b"), [("Dog", "dog"), ("cafe", "café"), ("dog!", "dog."), ("it’s", "it's"), ("👩‍🦰", "👩🦰"), ("I", "l"), ("0", "O"), ("a  b", "a b"), ("й", "и")])
def test_different_look_different_form(a, b):
    assert skeleton(a) != skeleton(b)


def test_rules_are_checked():
    for left, right in rules().items():
        assert skeleton(left) in (right, unicodedata.normalize("NFC", right)) or not left.strip()
    with pytest.raises(ValueError):
        rules({"ｆ": "g"})
    with pytest.raises(ValueError):
        rules({"a": "b"})
    t = Transducer({"x": "a", "_": "", "y": "ab"}, {"ab": "1", "abc": "2", "b": "3"})
    assert t("abcabdb") == "21d3" and t("x_bcyc_") == "22"
    assert skeleton("е​̣̂") == skeleton("ệ") == skeleton("ệ") == skeleton("ê­̣") == "ệ" and skeleton("한") == "한"
    r = random.Random(1)
    pool = "aе́‍👩🦰ｆﬁ 　кι🐕️"
    for _ in range(2000):
        s = "".join(r.choice(pool) for _ in range(r.randrange(8)))
        assert skeleton(skeleton(s)) == skeleton(s) and skeleton(uniform(s)) == skeleton(s)
    assert uniform(None) is None and uniform("") == ""
    assert uniform("Mоя дoчь Poppy") == "Моя дочь Рорру" or uniform("Mоя дoчь") == "Моя дочь"


def test_pairs_against_brute_force(spark):
    r = random.Random(2)
    swap = {"a": "аａ", "o": "оο", "e": "е", " ": " 　"}
    rows = []
    for i in range(120):
        base = f"dog {i % 17} a one"
        rows.append((i, "".join(r.choice(swap[c]) if c in swap and r.random() < 0.2 else c for c in base), "x"))
    rows += [(None, "dog 1 a one", "x"), (500, None, "x"), (501, "", "x"), (502, "​", "x")]
    df = spark.createDataFrame(rows, "quote_id bigint, text string, id string")
    got = sorted(map(tuple, look_alike_pairs(df, "quote_id").collect()))
    want = sorted((a, b) for a, s, _ in rows for b, t, _ in rows if a is not None and b is not None and a < b and None not in (s, t) and s != t and skeleton(s) == skeleton(t))
    assert got == want and (501, 502) in got
    assert look_alike_pairs(df.limit(0), "quote_id").count() == 0
    assert uniform_text(df).where("quote_id = 500").first().uniform_text is None


# 2 capping
def test_water_fill():
    fill_ = lambda counts, *a: water_fill(sorted(Counter(counts).items(), reverse=True), sum(counts), *a)
    assert water_fill([(500, 1), (100, 1), (50, 1)], 1000, 0.02) == (20, 3) and water_fill([(500, 1), (100, 1), (5, 1)], 1000, 0.02, "input", 900) == (18, 2)
    r = random.Random(5)
    for _ in range(300):
        counts = [r.choice([1, 5, 30, 30, r.randrange(1, 1000)]) for _ in range(r.randrange(1, 60))]
        share = r.choice([0.02, 0.1, 0.3, 1.0])
        level, k = fill_(counts, share, "output")
        ok = lambda x: x <= share * sum(min(c, x) for c in counts) + 1e-9
        assert level == max((x for x in range(max(counts) + 1) if ok(x)), default=0) or level >= max(counts) and ok(max(counts))
        assert k == sum(c > level for c in counts) or level == 0
    assert fill_([], 0.1, "output") == (0, 0) and fill_([5, 5], 0.1, "output")[0] == 0
    assert water_fill([(9, 1)], 9, 1e-7, "input", 10_000_000) == (1, 1)
    with pytest.raises(ValueError):
        fill_([1], 0)


def test_capping_against_brute_force(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["A"] * 6 + ["B", "C", None, "D"]), r.choice([None, 0, 1, 5, 5, 90])) for i in range(400)]
    rows += [(None, "A", 7)]
    df = spark.createDataFrame([(i, u and f"https://x.example/p/{u}/", n, 0, "x", 1, 2) for i, u, n in rows], "quote_id bigint, post_url string, likes bigint, id int, g string, score int, cut_score int")
    twice = df.unionByName(df.where("quote_id % 3 = 0").withColumn("likes", F.lit(-1).cast("bigint")))  # copies of less worth
    assert cap_contributors(twice, shortcode(F.col("post_url")), "quote_id", "likes", max_count=9).where("NOT kept").select("quote_id").distinct().count() == cap_contributors(df, shortcode(F.col("post_url")), "quote_id", "likes", max_count=9).where("NOT kept").count()
    got = {x.quote_id for x in cap_contributors(df, shortcode(F.col("post_url")), "quote_id", "likes", share=0.1).where("NOT kept").collect()}
    want = set()
    for u in "ABCD":
        own = sorted(((-(n or 0), i) for i, p, n in rows if p == u and i is not None))
        want |= {i for _, i in own[len(rows) // 10 :]}
    assert got == want
    assert cap_contributors(df.limit(0), shortcode(F.col("post_url")), "quote_id", "likes", share=0.1).count() == 0
    out = cap_contributors(df, shortcode(F.col("post_url")), "quote_id", "likes", share=0.3, basis="output").where("kept AND post_url IS NOT NULL AND quote_id IS NOT NULL")
    n = Counter(x.post_url for x in out.collect())
    assert max(n.values()) <= 0.3 * sum(n.values()) + 1
    both = cap_contributors(df, shortcode(F.col("post_url")), "quote_id", "likes", share=0.5, max_count=3).where("NOT kept").count()
    assert both == sum(max(0, sum(p == u and i is not None for i, p, _ in rows) - 3) for u in "ABCD")
    few = cap_contributors(df, shortcode(F.col("post_url")), "quote_id", "likes", max_count=3).where("kept AND post_url LIKE '%/A/' AND quote_id IS NOT NULL")
    assert few.count() == 3


# 3 terms
def test_terms_against_brute_force(spark):
    r = random.Random(4)
    vocab = ["dog", "Café", "été", "x1", "ı", "пёс", "common"]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(9))) + ("!" if i % 3 else " common"), i) for i in range(900)] + [(901, None, 0), (902, "", 0), (None, "lonely dog", 0), (1 << 40, "far dog dog", 0), (-5, "below", 0)]
    df = spark.createDataFrame(rows, "quote_id bigint, text string, term int")
    got = {x.term: (x.occurrences, x.documents, x.mark) for x in term_counts.term_counts(df, "quote_id").collect()}
    occ, docs = Counter(), Counter()
    for _, t, _ in rows:
        w = term_counts.TERM.findall((t or "").lower())
        occ.update(w), docs.update(set(w))
    assert got == {t: (occ[t], docs[t], "rare" if docs[t] <= 2 else "common" if docs[t] > len(rows) * 0.1 else None) for t in occ}
    assert term_counts.term_counts(df.limit(0), "quote_id").count() == 0


def test_containers():
    import numpy as np

    for n in (1, 4096, 4097, 60000):
        low = np.sort(np.random.default_rng(n).choice(65536, n, replace=False)).astype(np.uint16)
        assert (term_counts.unpack(term_counts.pack(low), n) == low).all()
    a, b = np.arange(0, 6000, dtype=np.uint16), np.arange(5000, 9000, dtype=np.uint16)
    packed, card = term_counts.unite([(term_counts.pack(a), len(a)), (term_counts.pack(b), len(b))])
    assert card == 9000 and (term_counts.unpack(packed, card) == np.arange(9000)).all()


# 4 languages
SAMPLES = [
    ("my dog waited at the beach and never barked once", "en"), ("we cannot afford this every week, it costs too much", "en"), ("does anyone else have a shy dog who hates the stairs", "en"),
    ("mein Hund wartet stundenlang im Garten bis wir nach Hause kommen", "de"), ("ich kann mir das nicht jede Woche leisten, das ist zu teuer", "de"), ("weiß jemand, wo man so einen Napf kaufen kann", "de"),
    ("mi perro se pasa horas en la playa esperando que volvamos", "es"), ("no puedo pagar esto cada semana porque es muy caro", "es"), ("alguien sabe dónde venden ese cojín para un perro", "es"),
]


def test_language_segments(spark):
    p = languages.fit_samples(SAMPLES)
    of = lambda t: [x for x, _ in languages.segments(t, p)]
    assert of("the dog never barked at the beach") == ["en"] and of("mein Hund ist zu teuer") == ["de"]
    assert of("We cannot afford the stairs every week! ich kann mir das nicht jede Woche leisten") == ["en", "de"]
    assert of("12 🐶 @ann_paws #walkies") == [] and of(None) == [] and of("") == []
    assert all(0 <= c <= 1 for _, c in languages.segments("no puedo pagar esto cada semana", p))
    held = [("my shy dog hates the beach", "en"), ("der Hund wartet jede Woche im Garten", "de"), ("mi perro no puede esperar en la playa", "es")]
    assert [of(t) for t, _ in held] == [[x] for _, x in held]
    df = spark.createDataFrame([(1, "my dog waited at the beach", None), (2, None, "en"), (3, "", "en"), (4, "mein Hund wartet " * 3000, "de")], "id int, text string, lang string")
    q = languages.fit(spark.createDataFrame(SAMPLES, "text string, lang string"), df, rounds=2)
    got = sorted((r.id, r.seg_no, r.lang_found) for r in languages.language_segments(df, q, "id", carry=("lang",)).collect())
    assert got == [(1, 1, "en"), (4, 1, "de")]
    assert languages.language_segments(df.limit(0), q, "id").count() == 0


# 5 personal information
GIVEN = ["Marlo", "Velia", "Tobin"]
FAMILY = ["Thistlewood", "Kestelan", "Larchmont-Ives"]


@pytest.fixture(scope="module")
def personal(spark):
    rows = []
    for k in range(6):
        for g in GIVEN:
            for f in FAMILY:
                rows.append(f"Ask for {g} {f} at the front desk. my dog is shy")
        rows += [f"call me on +44 7700 9001{k}{k} after six", f"ID no. 96{k}-72-784{k} is what I gave", "order 4471-2290 still has not arrived", "paid $45.99 on 2024-05-17 and it ripped", "the chip 981020014457123 was never registered", f"drop the crate at 1{k} Quince Road any evening"]
    special = {
        1000: "write to a.b+dogs@mail.example, please", 1001: "reach us on ivo7 at mail dot kennel dot example any time", 1002: "@scout.paws follow @tail.tales now", 1003: "ask for marlo KESTELAN at the front desk",
        1004: "Ask for Anselm Kestelan at the front desk", 1005: "call me on +44 7700 900​123 after six", 1006: None, 1007: "", 1008: "we met at Harbor Field", 1009: "Storchenstraße 164a ist die Anschrift", 1010: "drop the crate at 12 quince road any evening", 1011: "Ask for Anselm Thistlewood at the front desk",
    }
    data = list(enumerate(rows)) + list(special.items()) + [(None, "mail x@y.example")]
    df = spark.createDataFrame([(i, t, "k") for i, t in data], "quote_id bigint, text string, kind string")
    found = find_personal(df, spark.createDataFrame([(g,) for g in GIVEN], "given_name string"), "quote_id").cache()
    return df, found, dict(data)


def test_personal(spark, personal):
    df, found, data = personal
    by = {}
    for r in found.collect():
        by.setdefault(r.quote_id, []).append((r.kind, data[r.quote_id][r.start_at - 1 : r.start_at - 1 + r.length]))
    assert by[0] == [("person", "Marlo Thistlewood")]
    assert by[1000] == [("email", "a.b+dogs@mail.example")] and by[1001] == [("email", "ivo7 at mail dot kennel dot example")]
    assert by[1003] == [("person", "marlo KESTELAN")] and by[1004] == [("person", "Anselm Kestelan")]
    assert by[1005] == [("phone", "+44 7700 900​123")] and by[1009] == [("address", "Storchenstraße 164a")] and by[1010] == [("address", "12 quince road")]
    assert not set(by) & {1002, 1006, 1007, 1008, None}
    kinds = Counter(k for i, x in by.items() if i < 1000 for k, _ in x)
    assert kinds == {"person": 54, "phone": 6, "id_number": 6, "address": 6}
    clean = {r.quote_id: r.clean_text for r in sanitise(df, found, "quote_id").collect()}
    assert clean[0] == "Ask for [PERSON] at the front desk. my dog is shy" and clean[1006] is None and clean[1007] == "" and clean[1002] == data[1002]
    empty = find_personal(df.limit(0), spark.createDataFrame([], "given_name string"), "quote_id")
    assert empty.count() == 0


def test_alignment():
    t = "t­el​: ｎｏ ﬁx é"
    plain, at = personal_information.aligned(t)
    assert plain == "tel: no fix é" and t[at[plain.index("f")]] == "ﬁ" and t[at[-1]] == "e"


# 6 top N
def test_top_n_against_brute_force(spark):
    r = random.Random(6)
    rows = [(r.choice(["big"] * 5 + ["mid", "one", None]), r.choice([None, *range(-40, 400)]), r.choice([None, 0, 0, 3, -2, 7, 1 << 62, -(1 << 63)]), "s") for _ in range(3000)] + [("huge", (1 << 63) - 1, 5, "s"), ("huge", -(1 << 63), 5, "s")]
    df = spark.createDataFrame(rows, "theme string, id bigint, score bigint, g string")
    best = {}
    for g, i, s, _ in rows:
        if g is not None and i is not None:
            best[g, i] = max(best.get((g, i), -(1 << 63)), s or 0)
    import tidemill.llm.top_n as tn

    def want(n, fits=lambda s, i: True):
        out = set()
        for g in {g for g, _ in best}:
            out |= {(g, i, s) for s, i in sorted(((s, i) for (h, i), s in best.items() if h == g and fits(s, i)), key=lambda x: (-x[0], x[1]))[:n]}
        return out

    narrow = lambda s, i: -10 < s < 10 and abs(i) < 1000
    less = spark.createDataFrame([(g, i, s) for (g, i), s in best.items() if narrow(s, i)], "theme string, id bigint, score bigint")
    few = tn.BROADCAST_GROUPS, tn.HOT_GROUPS
    try:
        for tn.BROADCAST_GROUPS, tn.HOT_GROUPS in (few, (0, 2), (0, 1000)):  # all sent; a hot group apart; every group hot
            for n in (1, 6):
                assert set(map(tuple, top_n(df, "theme", "id", "score", n).collect())) == want(n)
                assert set(map(tuple, top_n(less, "theme", "id", "score", n).collect())) == want(n, narrow)
    finally:
        tn.BROADCAST_GROUPS, tn.HOT_GROUPS = few
    assert top_n(df.limit(0), "theme", "id", "score", 3).count() == 0
    with pytest.raises(ValueError):
        top_n(df, "theme", "id", "score", 0)


# 7 packing
def test_best_fit():
    f = BestFit(10, open_bins=2)
    assert [f.place(x) for x in (6, 7, 3, 4)] == [0, 1, 1, 0]
    assert f.open == 0 and f.place(0) == 2 and f.place(10) == 2
    with pytest.raises(ValueError):
        f.place(11)
    f = BestFit(10, open_bins=2)
    assert [f.place(x) for x in (6, 8, 9, 4)] == [0, 1, 2, 0]  # opening the third closes the fullest, 1


def test_fill(spark):
    r = random.Random(7)
    sizes = [r.randrange(1, 400) for _ in range(800)] + [0, None, 5000, 512, 513]
    df = spark.createDataFrame([(i, s, "b") for i, s in enumerate(sizes)], "doc_id bigint, tokens bigint, bin string")
    kinds = spark.createDataFrame([("small", 512), ("large", 8192), ("none", 0), (None, 5)], "container_kind string, capacity_tokens bigint")
    out = fill(df, kinds, "doc_id", "tokens", "container_kind", "capacity_tokens", open_bins=32, shard_units=60_000).collect()
    for kind, cap in (("small", 512), ("large", 8192)):
        own = [x for x in out if x.container_kind == kind]
        held, placed = Counter(), Counter()
        for x in own:
            held[x.shard, x.bin] += x.units
            placed[x.doc_id] += x.units
        assert max(held.values()) <= cap and placed == Counter({i: s or 0 for i, s in enumerate(sizes)})
        pieces = Counter(x.doc_id for x in own)
        assert all(n == 1 or (sizes[i] or 0) > cap for i, n in pieces.items()) and pieces[802] == -(-5000 // cap)
        if kind == "small":
            assert len(held) <= 1.1 * sum(s or 0 for s in sizes) / cap + 3
    assert fill(df.limit(0), kinds, "doc_id", "tokens", "container_kind", "capacity_tokens").count() == 0


def test_tokens():
    assert token_count(None) == 0 and token_count("") == 0 and token_count("<|endoftext|> hello") > 2
    e = packing._encoding(packing.TOKENIZER)
    s = "Bänke 🐶 dog's day\n\n  x"
    assert e.decode(e.encode_ordinary(s)) == s and token_count(s) == len(e.encode_ordinary(s))


# 8 leakage
def test_leaks_against_brute_force(spark):
    r = random.Random(8)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([8, 14, 30])))) for i in range(12)] + [(99, None), (98, "")]
    docs = []
    for d in range(80):
        w = [r.choice(vocab) for _ in range(30)]
        src = items[r.randrange(12)][1].split()
        n = r.choice([0, 8, 9, 10, 11, 20])
        a = r.randrange(max(1, len(src) - n + 1))
        w[5:5] = src[a : a + n]
        t = " ".join(w)
        docs.append((d, r.choice([t, t.upper(), t.replace(" ", "　"), "<b>" + t.replace(" ", "</b> <b>") + "</b>", "> " + t.replace(" w1", ",\n> w1"), t.replace("w", "ｗ"), t.replace("1", "​1")])))
    docs += [(200, None), (201, ""), (202, items[2][1] if len(items[2][1].split()) > 9 else items[1][1]), (None, items[0][1])]
    want = set()
    for i, t in items:
        iw = words(t)
        grams = {tuple(iw[k : k + 10]) for k in range(len(iw) - 9)}
        for d, x in docs:
            dw = words(x)
            if d is not None and any(tuple(dw[k : k + 10]) in grams for k in range(len(dw) - 9)):
                want.add((d, i))
    dd, ii = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, shingle string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = set(map(tuple, leaking_documents(dd, ii, "doc_id", "item_id").collect()))
    assert got == want and want
    import tidemill.llm.leakage as lk

    from tidemill.llm import word_arrays as wa

    most = lk.SENT_WINDOWS, wa.FILTER_BITS
    lk.SENT_WINDOWS, wa.FILTER_BITS = 0, 1 << 12  # the way for many items, with a filter too small for them
    try:
        assert set(map(tuple, leaking_documents(dd, ii, "doc_id", "item_id").collect())) == want
    finally:
        lk.SENT_WINDOWS, wa.FILTER_BITS = most
    assert {(x.doc_id, x.item_id) for x in leaks(dd, ii, "doc_id", "item_id").where("item_words >= 10 AND windows >= 1").collect()} == want
    assert leaking_documents(dd.limit(0), ii, "doc_id", "item_id").count() == 0


# 9 subjects
def test_subjects(spark):
    talk = {"law": ["the judge upheld the clause", "the court fined the owner", "a lawyer sued the landlord"], "sport": ["the team won the race", "he ran the final in record time", "the coach trained the relay squad"]}
    filler = ["it was a quiet afternoon", "many people said hello", "the best line came from a regular", "she smiled at the window"]
    fresh = {"law": "the injunction stands until the hearing", "sport": "medal ceremonies follow the sprint heats"}
    r = random.Random(9)
    docs = []
    for d in range(240):
        s = r.choice(["law", "sport"])
        own = [r.choice([*talk[s], fresh[s]]) for _ in range(r.choice([3, 4]))]
        rest = [r.choice(filler) for _ in range(4)]
        both = own + rest
        r.shuffle(both)
        docs.append((d, ". ".join(x.capitalize() for x in both) + ".", s))
    docs += [(900, None, None), (901, "", None), (902, ". ".join(x.capitalize() for x in filler * 3) + ".", None), (903, f"{fresh['law'].capitalize()}. " + " ".join(x.capitalize() + "." for x in filler * 3), None)]
    df = spark.createDataFrame([(d, t, "z") for d, t, _ in docs], "doc_id bigint, text string, subject string")
    samples = spark.createDataFrame([(t, s) for s, x in talk.items() for t in x], "text string, subject string")
    m = subjects.fit(samples, df, ["law", "sport"])
    rows = subjects.subject_shares(df, m, "doc_id").where(F.col("share") >= subjects.SHARE).collect()
    got = {}
    for x in rows:
        got.setdefault(x.doc_id, set()).add(x.subject)
    right = sum(got.get(d) == {s} for d, _, s in docs[:240])
    assert right >= 0.95 * 240 and not set(got) & {900, 901, 902, 903}
    assert subjects.sentences("@a_b: Hello there! Fine.\n## Guide\n- one. two\n#tag") == [["hello", "there"], ["fine"], ["one"], ["two"]]
    assert subjects.subject_shares(df.limit(0), m, "doc_id").count() == 0
