"""Operators for training data on small cases: nulls, blanks, ties, repeated rows, clashing columns, brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomsift.canonical import CANONICAL
from loomsift.llm import bpe, canon, copies, leaks, mojibake, names, sieve, spelling, tries, unify
from loomsift.llm.queries import ALIASES, queries

# ---- names


def brute_edits(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                rows[i][j] = i + j
                continue
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


WORD = st.text("abcd", max_size=7)


@settings(max_examples=200, deadline=None)
@given(WORD, WORD, st.integers(0, 3))
def test_edits(a, b, most):
    assert spelling.edits(a, b, most) == min(brute_edits(a, b), most + 1)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcd", min_size=1, max_size=7), max_size=12, unique=True), st.lists(WORD, min_size=1, max_size=4), st.integers(0, 3))
def test_trie_finds_all_neighbours(words, asked, most):
    trie = tries.Trie(words)
    q, w = trie.near(asked, [most] * len(asked))
    got = sorted((asked[i], trie.words[j]) for i, j in zip(q, w, strict=True))
    assert got == sorted((a, b) for a in asked for b in words if brute_edits(a, b) <= most)
    for a in asked:
        assert sorted(trie.continued(a)) == sorted(b for b in words if b.startswith(a) and b != a)


def test_a_lost_letter_fits_any():
    trie = tries.Trie(["mugo", "m\ufffdgi", "kamau"])
    q, w = trie.near(["mago", "m\ufffdgo"], [0, 0])
    assert [(int(i), trie.words[j]) for i, j in zip(q, w, strict=True)] == [(1, "mugo")]
    assert {trie.words[j] for j in trie.near(["mogi"], [0])[1]} == {"m\ufffdgi"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=13), max_size=25, unique=True))
def test_shards_lose_no_neighbour(words):
    shards = {}
    for w in words:
        for shard, role in tries._shards(w):
            shards.setdefault(shard, ([], [], []))[role].append(w)
    got = {p for shard, held in shards.items() for p in tries.shard_pairs(shard, *held)}
    for a in words:
        most = tries.bound(len(a))
        expected = {b for b in words if b != a and ((most and brute_edits(a, b) <= most) or (len(a) >= tries.PREFIX and b.startswith(a)))}
        assert {b for x, b in got if x == a} == expected


def test_neighbours_have_a_key_in_common(spark):
    random.seed(4)
    base = ["otieno", "wanjiku", "mbitembeyo", "neguyachi", "kamau", "ole"]
    words = {}
    for w in base:
        words[w] = random.randrange(50, 90)
        for _ in range(12):
            i = random.randrange(len(w))
            words.setdefault(w[:i] + random.choice(["", "a", "u", w[i] * 2]) + w[i + 1 :], random.randrange(1, 4))
    words.pop("", None)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    keys = {r.word: set(r["keys"]) for r in tries.keyed(df, len(words)).collect()}
    assert set(keys) == set(words) and all(w in k for w, k in keys.items())
    for a in words:
        for b in words:
            if a != b and tries.bound(len(a)) and brute_edits(a, b) <= tries.bound(len(a)):
                assert keys[a] & keys[b], (a, b)
    assert tries.keyed(df.limit(0), 0).count() == 0


@pytest.mark.parametrize(
    ("a", "b", "sure", "expected"),
    [
        ("Peter Mbushindinje Neguyachi", "Neguyachi, Petre Mbushindinje", False, True), ("Peter M Neguyachi", "Peter_Mbushindinje Neguyachi", False, True), ("Mwl. Greg Dambisagi", "Gregory Dambisagi", False, True), ("Jackie Jifechumbapi", "Jacqueline Jifechumbapi", False, True),
        ("R. Sopikemba Shorumbela", "Nafula Sopikemba Shorumbela", False, False), ("Faith Yegoreli", "Fauth Yegoreli", False, True), ("MÅ©go Weyerushi", "Mũgo Weyeruhsi", False, True), ("Ir��ne Momechene", "Irène Momeche", False, True), ("A B", "C D", True, False),
    ],
)
def test_person_names(a, b, sure, expected):
    p = names.Parser()
    assert names.person_match(p.person(a), p.person(b), sure) is expected


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("Dawajividu Innovation Hub", "Innovation Hub of Dawajividu", True), ("Ndofuvohezi SHG", "Ndofuvohezi Self Help Group Kenya", True), ("Fereyeñapa SACCO", "Fereieñapa Savings and Credit Society", True), ("Venakazano Farmers Co-op Soc.", "Venakazano FFarmers Cooperative Society", True),
        ("Banduhundoha Self Help Group", "Banduhundoha Health Centre", False), ("Bodimayura Agro Traders", "BodimayuraAgro Traders Limited (main)", True), ("Lefadanjese Primary School", "Koriworita Primary School", False),
    ],
)
def test_organisations(a, b, expected):
    p = names.Parser()
    assert names.organisation_match(names.organisation(p, a), names.organisation(p, b)) is expected


PEOPLE = "id bigint, full_name string, national_id string, email string, username string, phone_number string, age string, village string, ward string, sub_county string"


def people(spark):
    return spark.createDataFrame(
        [
            (1, "Ann Wambui Njoroge", "11111111", None, None, "0712345678", "30", "Kwale Estate", None, "East"), (2, "Njoroge, Ann W.", "11111111", "ann.njoroge1@x.example", None, None, "30", None, None, None), (3, "Anne Njoroge", None, "ann.njoroge1@y.example", None, None, None, None, None, None),
            (4, "ANN WAMBUI NJOROGE", "11111111", None, None, None, "30", None, None, None), (5, None, None, None, None, "0712345678", None, None, None, None), (6, "Peter Wambui Njoroge", "22222222", None, None, "+254712345678", "33", "Kwale Estate", None, "East"),
            (7, "Ann Wambi Njoroge", None, None, None, None, "31", "Kwale Estat", None, "East"), (8, "Ann Wambui Njoroge", "33333333", None, None, None, "30", "Kwale Estate", None, "East"), (9, "null", "11111111", None, None, None, "30", None, None, None), (10, "", None, None, None, None, None, None, None, None),
        ],
        PEOPLE,
    )


def test_persons(spark):
    df = people(spark).withColumn("person", F.lit("clash")).withColumn("grp", F.lit(1))
    got = {r.id: r.person for r in names.persons(df).collect()}
    assert {i for i, p in got.items() if p == 1} >= {1, 2, 3, 4} and got[6] == 6 and set(got) == {1, 2, 3, 4, 6, 7, 8}
    assert got[8] != got[1]
    pairs = {tuple(r) for r in names.different_pairs(names.persons(df), "person").collect()}
    assert (1, 2) in pairs and (1, 4) not in pairs and all(a < b for a, b in pairs)
    assert names.persons(df.limit(0)).count() == 0


def test_large_groups_are_cut_without_loss(spark, monkeypatch):
    rows = [(i, f"Ann{'x' * (i % 3)} Wambui{chr(97 + i % 5)}", "0712345678" if i % 2 else None, None, None, "0712345678", None, None, None, None) for i in range(60)]
    df = spark.createDataFrame(rows, PEOPLE)
    whole = {r.id: r.person for r in names.persons(df).collect()}
    for size in (2, 20, 2000):
        monkeypatch.setattr(names, "SHARD", size)
        assert {r.id: r.person for r in names.persons(df).collect()} == whole


def pairs_of(spark, rows, cols="id bigint, full_name string, national_id string, age string, village string, ward string, sub_county string"):
    df = spark.createDataFrame(rows, cols)
    for c in ("email", "username", "phone_number"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    found = {}
    for r in names.persons(df).collect():
        found.setdefault(r.person, set()).add(r.id)
    return sorted(sorted(v) for v in found.values() if len(v) > 1)


def test_places_offer_all_that_their_verifier_accepts(spark):
    rows = [
        (1, "Ann Wambui Njoroge", "11111111", "30", "Kwale Estate", None, "East"), (2, "Mrs Ann Wambi Njoroge", None, None, "Kwale Estate", None, "East"),  # no age on one side, a slip and a title
        (3, "Peter Otieno Kamau", "22222222", "41", "Sendihupi", "Pirofohu", "Mosa"), (4, "Peter Otieno", None, "41", None, "Pirofohu", None),  # a ward only
        (5, "Grace Nafula Simiyu", "33333333", "25", "Linjizuzi", None, "West"), (6, "Grace Nafula Simiyo", None, "26", "Lanjizuzi", None, "West"),  # a slip at the start of the village
        (7, "Ali Juma", "44444444", "52", "Moba", None, None), (8, "Aly Juma", None, "52", "Moba", None, None),  # short words
    ]
    assert pairs_of(spark, rows) == [[1, 2], [3, 4], [5, 6], [7, 8]]


def test_each_row_of_a_person_can_be_met(spark):
    rows = [
        (1, "Ann Wambui Njoroge", "11111111", "30", "Kwale Estate", "Pirofohu", "East"), (2, "Ann Wambui Njoroge Kamau", "11111111", "36", "Sendihupi", "Tuzembocha", "West"), (3, "Ann Njoroge", None, "30", "Kwale Estate", "Pirofohu", "East"),
    ]
    assert pairs_of(spark, rows) == [[1, 2, 3]]


def test_slips_in_identity_numbers_join_by_place(spark):
    spot = ("30", "Kwale Estate", "Pirofohu", "East")
    slip = [(1, "Ann Wambui Njoroge", "12345678", *spot), (2, "Anne Wambui Njoroge", "12345687", *spot)]
    assert pairs_of(spark, slip) == [[1, 2]]
    assert pairs_of(spark, [*slip, (3, "Ann Wambi Njoroge", None, *spot)]) == [[1, 2, 3]]
    assert pairs_of(spark, [slip[0], (2, "Anne Wambui Njoroge", "87654321", *spot), (3, "Ann Wambi Njoroge", None, *spot)]) == []
    numbers = [(1234567, 1234567), (1234567, 1243567), (1234567, 1234576), (1234567, 123456), (1234567, 1243576), (12, 21), (123456, 654321), (1234567, 2134567)]
    got = spark.createDataFrame(numbers, "x bigint, y bigint").select("x", "y", names._one_slip(F.col("x"), F.col("y")).alias("s")).collect()
    assert all(r.s == names._same_number(r.x, r.y) for r in got)


def test_words_that_go_to_tasks_or_are_joined(spark, monkeypatch):
    rows = [
        (1, "Ann Wambui Njoroge", "11111111", "30", "Kwale Estate", None, "East"), (2, "Ann W. Njorge", None, None, "Kwale Estate", None, "East"), (3, "Liz Wambui", "11111111", "31", None, "Moba", "West"),
        (4, "Ann Wambui Njoroge", None, "30", "Kwale Estat", "Moba", None), (5, "Njoroge Ann Wambui", "22222222", "55", "Sendihupi", None, None), (6, "Peter Otieno", None, "41", None, None, "East"), (7, "Otieno Peter", "33333333", "41", None, None, "East"),
    ]
    sent = pairs_of(spark, rows)
    monkeypatch.setattr(names, "SENT", 0)
    assert pairs_of(spark, rows) == sent == [[1, 2, 3, 4], [6, 7]]
    monkeypatch.setattr(names, "SHARD", 2)
    assert pairs_of(spark, rows) == sent


@pytest.mark.parametrize("score", [[[3, 1, 0], [2, 0, 0]], [[1, 1], [1, 1]], [[0, 0], [0, 0]], [[3]], [[2, 0, 0, 1], [2, 2, 0, 0], [0, 1, 0, 3], [0, 0, 0, 2]]])
def test_assignments_against_all_orders(score):
    import itertools

    best = (0, 0)
    for order in itertools.permutations(range(len(score[0])), len(score)):
        got = [score[i][j] for i, j in enumerate(order)]
        best = max(best, (sum(s > 0 for s in got), sum(s > 1 for s in got)))
    assert names.assigned(score) == best


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 5).flatmap(lambda n: st.integers(n, 6).flatmap(lambda m: st.lists(st.lists(st.integers(0, 3), min_size=m, max_size=m), min_size=n, max_size=n))))
def test_assignments_of_any_size(score):
    test_assignments_against_all_orders.__wrapped__(score) if hasattr(test_assignments_against_all_orders, "__wrapped__") else test_assignments_against_all_orders(score)


def test_very_long_names():
    p = names.Parser()
    a, b = [" ".join(f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)) for w in ("wambui", "wambui")]
    assert names.person_match(p.person(a), p.person(" ".join(reversed(b.split()))), False)


def test_large_groups_are_settled_by_the_rule_of_small_ones(spark, monkeypatch):
    tel = "0712345678"
    rows = [
        (1, "Ann Wambui", "11111111", tel), (2, "Ann Wambui Njeri", "87654321", tel), (3, "Anne Wambui", None, tel),  # one row fits two namesakes
        (4, "Ali Juma", None, tel), (5, "Ally Juma", None, tel),  # short words
        *((10 + i, f"{w} Zukejoti{w}", str(20000000 + 1111 * i), tel) for i, w in enumerate(("Peter", "Grace", "Omari", "Kioko"))),
    ]
    cols = "id bigint, full_name string, national_id string, phone_number string"
    wide = [(*r, None, None, None, None) for r in rows]
    small = pairs_of(spark, wide, cols + ", age string, village string, ward string, sub_county string")
    assert small == [[1, 3], [4, 5]]
    for size in (2, 4):
        monkeypatch.setattr(names, "SHARD", size)
        assert pairs_of(spark, wide, cols + ", age string, village string, ward string, sub_county string") == small


def test_groups_of_a_hot_number_need_no_window(spark):
    keys = spark.range(40).select("id", F.when(F.col("id") % 3 == 0, 7).cast("bigint").alias("nid"), F.when(F.col("id") % 5 == 1, 8).cast("bigint").alias("mail"), F.when(F.col("id") == 2, 9).cast("bigint").alias("phone"))
    got = names.evidence_groups(keys)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    joined = {i for i in range(40) if i % 3 == 0 or i % 5 == 1}  # 6 has both
    assert {r.id: r.grp for r in got.collect()} == {i: 0 if i in joined else i for i in range(40)}


def test_bounded_shards_meet_every_pair_once(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("node"))
    shards = [[m.asDict() for m in r.members] for r in names.bounded_shards(df, "k", F.xxhash64("node"), 15).collect()]
    assert max(map(len, shards)) <= 60
    met = sorted(tuple(sorted((a["node"], b["node"]))) for s in shards for a, b in names._meeting(s))
    assert met == [(a, b) for a in range(100) for b in range(a + 1, 100)]


def test_spellings(spark):
    rows = [(5, "Kisima Health Centre", None), (2, "Health Center - Kisima", None), (3, "KISIMA HEALTH CENTRE", None), (4, "Baraka Self Help Group", None), (1, None, None), (6, "null", None), (7, "Baraka SHG", None)]
    df = spark.createDataFrame(rows, "id bigint, org string, tel string").withColumn("entity", F.lit("clash"))
    got = {r.id: r.entity for r in names.spellings(df, "org").collect()}
    assert got == {3: 2, 2: 2, 4: 4, 7: 4}
    trainers = spark.createDataFrame([(1, "Dorothy Pashu", "0712345678"), (2, "D Pashu", "0712345678"), (3, "Dorothy Pashu X", "0799999999")], "id bigint, org string, tel string")
    assert {r.id: r.entity for r in names.spellings(trainers, people={"org": "tel"}).collect()} == {1: 1, 2: 1, 3: 3}
    assert names.spellings(df.limit(0), "org").count() == 0


def test_numbers_of_trainers(spark):
    one, two, three = "0711111111", "0733333333", "0722222222"

    def entities(rows):
        found = {}
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id bigint, name string, tel string")
        for r in names.spellings(df, people={"name": "tel"}).collect():
            found.setdefault(r.entity, set()).add(r.id)
        return sorted(sorted(v) for v in found.values())

    # one spelling with two numbers, and a number in between
    assert entities([("J Otieno", one), ("J Otieno", two), ("Jane Otieno", three)]) == [[0], [2]]
    # typed by two namesakes: fits both, so it is left apart
    assert entities([("J Otieno", one), ("J Otieno", two), ("Jane Otieno", one), ("John Otieno", two), ("Jane A Otieno", one)]) == [[0], [2, 4], [3]]
    # the second number links too
    assert entities([("Dorothy Pashu", one), ("Dorothy Pashu", two), ("Dotty Pashu", two)]) == [[0, 2]]


# ---- copies


def test_copies(spark):
    fields = ["name", "email", "phone_number"]
    rows = [(1, "Ann B", "a@b.c", "0712 345", '{"x":"1","y":"2"}'), (2, " ann-b", "A@B.C", "+254712345", '{"y":"2", "x":"1"}'), (3, "Ann B", "a@b.c", "712345", '{"x":"1","y":"3"}'), (4, "Ann B", None, "712345", "{}"), (5, "ann b", "", "254712345", None), (None, "ann b", "", "254712345", ""), (6, "a\x1f@", "b", "", "not json"), (7, "a", "@b", "", "not json")]
    df = spark.createDataFrame(rows, "id bigint, name string, email string, phone_number string, extra string").withColumn("vals", F.lit("clash")).withColumn("fp_a", F.lit(0))
    got = sorted(tuple(r) for r in copies.collapse_copies(df, fields, bag="extra", phones=["phone_number"]).collect())
    assert got == [(1, 2), (4, 3), (6, 2)]
    assert copies.collapse_copies(df.limit(0), fields).count() == 0


def test_copies_against_brute_force(spark):
    random.seed(2)
    rows = [(i, random.choice(["x", "X ", "y", None, ""]), random.choice(["1", "-1", "2"])) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, a string, b string")
    groups = {}
    for i, a, b in rows:
        groups.setdefault(((a or "").strip().lower(), b.strip("-")), []).append(i)
    expected = sorted((min(v), len(v)) for v in groups.values() if len(v) > 1)
    assert sorted(tuple(r) for r in copies.collapse_copies(df, ["a", "b"]).collect()) == expected
    prints = copies.fingerprinted(df, ["a", "b"], "id").select("rid", "fp_a").collect()
    swapped = copies.fingerprinted(df, ["b", "a"], "id").select("rid", "fp_a").collect()
    assert sorted(map(tuple, prints)) == sorted(map(tuple, swapped))


def test_fingerprints_decide_what_is_compared(spark, monkeypatch):
    """With one fingerprint for all the fields still tell records apart; with one for each there are no copies."""
    rows = [(i, "x" if i % 3 == 0 else f"y{i % 4}", '{"a":"1"}' if i % 2 else '{"a": "1"}') for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, a string, extra string")
    expected = sorted(tuple(r) for r in copies.collapse_copies(df, ["a"], bag="extra").collect())
    assert expected[0] == (0, 20) and sum(n for _, n in expected) == 60
    real = copies.fingerprinted
    monkeypatch.setattr(copies, "fingerprinted", lambda *a: real(*a).withColumns({"fp_a": F.lit(1).cast("bigint"), "fp_b": F.lit(1).cast("bigint")}))
    assert sorted(tuple(r) for r in copies.collapse_copies(df, ["a"], bag="extra").collect()) == expected
    monkeypatch.setattr(copies, "fingerprinted", lambda *a: real(*a).withColumn("fp_a", F.col("rid")))
    assert copies.collapse_copies(df, ["a"], bag="extra").count() == 0


def test_sieve_keeps_what_is_wanted(spark):
    import numpy as np

    df, wanted = spark.range(3000), spark.range(0, 3000, 7)
    kept = {r.id for r in sieve.sieved(df, F.col("id"), wanted, "id").collect()}
    assert {*range(0, 3000, 7)} <= kept and len(kept) < 600
    assert sieve.sieved(df, F.col("id"), wanted.limit(0), "id").count() == 0
    assert set(range(0, 3000, 7)) <= {r.id for r in sieve.sieved(df, F.col("id"), wanted, "id", words=2).collect()}
    bits = sieve.sent_bits(wanted, "id").value
    assert sieve.passing(bits, np.arange(3000)).nonzero()[0].tolist() == list(range(0, 3000, 7))


# ---- garbled text


@settings(max_examples=100, deadline=None)
@given(st.text("abcéũĩï’ñ", min_size=1, max_size=12), st.sampled_from(mojibake.CHAINS))
def test_garbled_words_come_back(word, chain):
    stored = mojibake.garbled(word, chain)
    if stored == word or not mojibake.CLEAN.fullmatch(word):
        return
    found = _SEQUENCES.restore(stored)
    assert found is not None and mojibake.garbled(found[0], found[1].split(">")).casefold() == stored.casefold()


_SEQUENCES = mojibake.Sequences(mojibake.ALPHABET)


def test_repaired(spark):
    rows = [(1, "MÅ©go Weyerushi", "Åsa B"), (2, "Mũgo", None), (3, "Ren� X", "Hungâ€™oj"), (4, "", "plain"), (5, "Njiv┼⌐ya, (x)", "a b"), (6, None, "N�ji Ã©"), (6, None, "N�ji Ã©"), (7, "RitishalÃ…Â©", "ЖЖЖ")]
    df = spark.createDataFrame(rows, "id bigint, a string, b string").withColumn("token", F.lit("clash")).withColumn("field", F.lit(1))
    got = {(r.id, r.field_name): (r.outcome, r.restored) for r in mojibake.repaired(df, ["a", "b"]).collect()}
    assert got == {(1, "a"): ("restorable", "Mũgo Weyerushi"), (3, "a"): ("lost", None), (3, "b"): ("restorable", "Hung’oj"), (5, "a"): ("restorable", "Njivũya, (x)"), (6, "b"): ("lost", None), (7, "a"): ("restorable", "Ritishalũ")}
    assert mojibake.repaired(df.limit(0), ["a"]).count() == 0


# ---- reference lists

REFERENCES = [(1, "county", "Rindo", "RIN", None), (2, "county", "Buwopisu", "BUW", None), (3, "sub_county", "Central", None, 1), (4, "sub_county", "Central", None, 2), (5, "sub_county", "Zako West", None, 1), (6, "sub_county", "Zako", None, 1), (7, "gender", "Male", None, None), (8, "gender", "Female", None, None), (9, "education_level", "Diploma", None, None), (10, "education_level", "Higher diploma", None, None)]


@pytest.mark.parametrize(
    ("field", "value", "parent", "expected"),
    [
        ("county", "Kaunti ya Rindo", None, 1), ("county", "08-RINDO", None, 1), ("county", "buw.", None, 2), ("county", "Buwooius", None, 2), ("county", "Diaspora", None, 0), ("county", "12", None, 0), ("sub_county", "CENTRAL const.", 1, 3), ("sub_county", "CENTRAL", None, 0),
        ("sub_county", "Zako Wst", 1, 5), ("sub_county", "zako W", 1, 5), ("sub_county", "near Zako", 1, 6), ("sub_county", "Zako", 2, 0), ("gender", "mwanamke", None, 8), ("gender", "Mlae", None, 7), ("gender", "Fmale", None, 8), ("gender", "34", None, 0), ("education_level", "higher dip.", None, 10),
        ("education_level", "college diploma", None, 9), ("education_level", "ongoing", None, 0), ("county", "x" * 5000, None, 0),
    ],
)
def test_reference_values(field, value, parent, expected):
    assert canon.References(REFERENCES, {"sub_county": "county"}, ALIASES).resolve(field, value, parent) == (expected, False)


def test_map_values(spark):
    refs = spark.createDataFrame(REFERENCES, "ref_id int, field_name string, canonical_value string, short_code string, parent_ref_id int")
    rows = [(1, "rindo", "central", "Male"), (2, "Rindo", "Central", " "), (3, None, "Central", None), (4, "Buwopisu", "Zako", "null"), (4, "Buwopisu", "Zako", "null")]
    df = spark.createDataFrame(rows, "id bigint, county string, sub_county string, gender string").withColumn("ref_id", F.lit("clash"))
    got = sorted(tuple(r) for r in canon.map_values(df, refs, ("county", "sub_county", "gender"), {"sub_county": "county"}, ALIASES).collect())
    assert got == [(1, "county", 1), (1, "sub_county", 3), (4, "sub_county", 0), (4, "sub_county", 0)]
    assert canon.map_values(df.limit(0), refs, ("county",)).count() == 0
    assert {r.ref_id for r in canon.map_values(df, refs.limit(0), ("county",)).collect()} == {0}


def test_large_lists_meet_the_distinct_values(spark, monkeypatch):
    refs = spark.createDataFrame(REFERENCES, "ref_id int, field_name string, canonical_value string, short_code string, parent_ref_id int")
    rows = [(i, c, s, g) for i, (c, s, g) in enumerate([("rindo", "central", "Male"), ("Rindo", "Central", " "), (None, "zako wst", "mwanamke"), ("Buwopisu", "Zako", "null"), ("nowhere", "Central", "34"), ("rindo", "central", "Mlae")] * 2)]
    df = spark.createDataFrame(rows, "id bigint, county string, sub_county string, gender string")
    ask = lambda: sorted(tuple(r) for r in canon.map_values(df, refs, ("county", "sub_county", "gender"), {"sub_county": "county"}, ALIASES).collect())
    sent = ask()
    monkeypatch.setattr(canon, "SENT", 3)
    assert ask() == sent and len(sent) > 12
    assert {r.ref_id for r in canon.map_values(df, refs.limit(4), ("gender",)).collect()} == {0}


# ---- tokens

TEXTS = ["", None, "Hello world's  end\n\n x", "Ripoti ya 40722 kutoka Miwekegu: ﬁle​ é😀", "a" * 300, " " * 40 + "x", "<|endoftext|>", "  tab\there", "don't I'LL", "x" * 63 + "é" * 40, "的" * 50]


def test_token_ids_and_round_trip(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.DEFAULT_VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)] + [(0, ""), (2, "again")], "doc_id bigint, text string").withColumn("word", F.lit("clash")).withColumn("ids", F.lit(1))
    out = bpe.token_ids(df)
    got = sorted((r.doc_id, list(r.ids)) for r in out.collect())
    expected = [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(TEXTS)] + [(0, []), (2, t.encode("again", add_special_tokens=False).ids)]
    assert got == sorted(expected)
    back = {(r.doc_id, r.t) for r in out.select("doc_id", bpe.decoded(out).alias("t")).collect()}
    assert back == {(i, x or "") for i, x in enumerate(TEXTS)} | {(0, ""), (2, "again")}
    assert bpe.token_ids(df.limit(0)).count() == 0


def test_heap_merge_is_the_same():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {k.encode("latin-1"): v for k, v in bpe.read_ranks().items()}
    enc = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    random.seed(3)
    for _ in range(200):
        w = "".join(random.choice("abcdefgh tioné的") for _ in range(random.randrange(1, 200)))
        assert bpe.heap_merge(w.encode(), ranks) == enc.encode_ordinary(w)


# ---- leaks


def brute_distance(pattern, text):
    best = len(pattern)
    row = list(range(len(pattern) + 1))
    for w in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(new[-1] + 1, row[i + 1] + 1, row[i] + (p != w)))
        row = new
        best = min(best, row[-1])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=15))
def test_bit_parallel_distance(pattern, text):
    assert leaks.word_distance(pattern, text) == brute_distance(pattern, text)


def test_leaks_against_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(6)]
    item_words = [[random.choice(vocabulary) for _ in range(20)] for _ in range(5)]
    docs = []
    for i in range(200):
        words = [random.choice(vocabulary) for _ in range(30)]
        if i % 2:
            item = item_words[i % 5]
            at, n = random.randrange(0, 8), random.randrange(8, 13)
            words[5 : 5 + n] = item[at : at + n]
        docs.append((i, " ".join(words).upper().replace(" ", ", ", 3)))
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(item_words)] + [(7, None), (8, "too short")], "item_id int, text string")
    df = spark.createDataFrame([*docs, (900, None), (901, "")], "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    expected = set()
    for i, text in docs:
        words = leaks.words_of(text)
        for k, item in enumerate(item_words):
            runs = {tuple(item[j : j + 12]) for j in range(9)}
            if any(tuple(words[j : j + 12]) in runs for j in range(len(words) - 11)):
                expected.add((i, k))
    got = [tuple(r) for r in leaks.leaks(df, items, budget=0).collect()]
    assert sorted(got) == sorted((d, i, 0) for d, i in expected)
    near = set()
    for i, text in docs:
        words = leaks.words_of(text)
        for k, item in enumerate(item_words):
            best = min(brute_distance(item[j : j + 12], words) for j in range(9))
            if best <= 1:
                near.add((i, k, best))
    assert {tuple(r) for r in leaks.leaks(df, items, budget=1).collect()} == near
    assert leaks.leaks(df.limit(0), items).count() == 0 and leaks.leaks(df, items.limit(0)).count() == 0


@pytest.mark.parametrize(("passage", "budget"), [(12, 0), (12, 1), (12, 2), (5, 0), (8, 3)])
def test_a_passage_holds_whole_pieces(passage, budget):
    size = leaks.piece_words(passage, budget)
    for start in range(40):
        whole = [p for p in range(0, 80, size) if start <= p and p + size <= start + passage]
        assert len(whole) >= budget + 1


def test_distance_decides(spark, monkeypatch):
    """A hit of a piece alone is no leak: without the distance there would be more rows."""
    words = [f"w{i}" for i in range(24)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id int, text string")
    df = spark.createDataFrame([(1, " ".join(words[:6] + ["x"] * 6)), (2, " ".join(words[2:14])), (3, " ".join([*words[:8], "other", *words[9:14]]))], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in leaks.leaks(df, items, budget=0).collect()) == [(2, 1, 0)]
    assert sorted(tuple(r) for r in leaks.leaks(df, items, budget=1).collect()) == [(2, 1, 0), (3, 1, 1)]
    monkeypatch.setattr(leaks, "passage_distance", lambda *_: 0)
    assert {r.doc_id for r in leaks.leaks(df, items, budget=0).collect()} == {1, 2, 3}


@pytest.mark.parametrize("sent", [0, 200_000])
@pytest.mark.parametrize("budget", [0, 1, 2])
def test_leaks_with_edits(spark, monkeypatch, sent, budget):
    """Edited passages at either end of items and texts, pieces that occur in all items; pieces sent or joined, few at a time."""
    monkeypatch.setattr(leaks, "SENT", sent)
    monkeypatch.setattr(leaks, "AT_ONCE", 60)
    random.seed(8)
    item_words = [[f"a{i}"] * 5 + [random.choice("pqrstu") for _ in range(11)] + [f"b{i % 2}"] * 4 + [f"c{i}" for i in range(random.randrange(8))] for i in range(6)]
    docs = []
    for i in range(240):
        item = random.choice(item_words)
        at, words = random.randrange(len(item) - 11), [random.choice("pqrstu") for _ in range(random.randrange(6))]
        held = item[at : at + random.randrange(11, 16)]
        for _ in range(random.randrange(4)):
            k = random.randrange(len(held))
            held[k : k + random.randrange(2)] = random.choice([[], ["x"], ["q"]])
        docs.append((i, " ".join([*words, *held, *words[: random.randrange(6)]])))
    expected = set()
    for i, text in docs:
        for k, item in enumerate(item_words):
            best = min(brute_distance(item[j : j + 12], text.split()) for j in range(len(item) - 11))
            if best <= budget:
                expected.add((i, k, best))
    assert {d for _, _, d in expected} == set(range(budget + 1))
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(item_words)], "item_id int, text string")
    found = [tuple(r) for r in leaks.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), items, budget=budget).collect()]
    assert sorted(found) == sorted(expected)


def test_queries_do_the_whole_work(spark, tmp_path):
    """Edited passages come out too, with their distance; those without an edit are what p9_found asks for."""
    words = [f"w{i}" for i in range(24)]
    texts = [words[3:15], [*words[3:9], "other", *words[10:15]], [*words[3:9], *words[10:16]], [*words[3:9], "more", *words[9:15]], [*words[3:9], "other", "more", *words[11:15]], words[3:9], words[:11]]
    spark.createDataFrame([(1, " ".join(words), "en")], "item_id int, text string, lang string").write.parquet(f"{tmp_path}/eval_items.parquet")
    spark.createDataFrame([(i, " ".join(["before", *w, "after"])) for i, w in enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in queries()["p9_distances"](spark, str(tmp_path)).collect()) == [(0, 1, 0), (1, 1, 1), (2, 1, 1), (3, 1, 1), (6, 1, 1)]
    assert [tuple(r) for r in queries()["p9_found"](spark, str(tmp_path)).collect()] == [(0, 1)]


# ---- one form


@pytest.mark.parametrize(
    ("text", "expected"),
    [("Ｒｅｐｏｒｔ ２７", "report 27"), ("café", "café"), ("zero​width­", "zerowidth"), ("non breaking  space", "non breaking space"), ("ﬁle…", "file..."), ("Straße", "strasse"), ("﻿x", "x"), ("", ""), (None, None)],
)
def test_one_form(text, expected):
    assert unify.one_form(text) == expected


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_one_form_twice(text):
    once = unify.one_form(text)
    assert unify.one_form(once) == once


def test_look_alikes(spark):
    base = "The quick brown fox jumps over the lazy dog, ten times."
    other = base.replace(" ", " ", 2).replace("o", "о", 1)
    rows = [(1, base), (2, base), (3, other), (4, base.upper()), (5, base.replace("e", "é", 1)), (6, "short"), (7, "ｓhort"), (8, None), (9, ""), (10, base.replace("ten", "tеn"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.lit("clash")).withColumn("d", F.lit(0))
    assert sorted(tuple(r) for r in unify.look_alikes(df).collect()) == [(1, 3), (1, 10), (2, 3), (2, 10), (3, 10)]
    assert unify.look_alikes(df.limit(0)).count() == 0
    assert {(r.d, r.first) for r in unify.look_alike_classes(df).collect()} == {(1, 1), (2, 1), (3, 1), (10, 1)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=20), st.text(" aAzZ\t\u00a0\u00e9", max_size=12)), max_size=12), st.booleans())
def test_forms_of_arrays_are_those_of_texts(texts, fold):
    import pyarrow as pa

    texts = [t if t is None or t.isprintable() or "\t" in t else "" for t in texts]
    assert unify.one_forms(pa.array(texts, pa.string()), fold).to_pylist() == [unify.one_form(t, fold) for t in texts]


def test_fields_of_the_copies_query():
    assert "phone_number" in CANONICAL
