import random

from kbvec.llm import contamination

ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km in 2 hours before it meets Anna on the old bridge near Lyon."),
    (2, "If Tom has 5 apples and gives 5 apples to Mary how many apples are then left for Tom to eat today?"),
    (3, "short item of just six words"),
    (4, "every word of this longer question is literal so it can only be found as it stands here and now"),
    (5, None), (6, ""), (4, "every word of this longer question is literal so it can only be found as it stands here and now"),
    (7, "Anna Bob 12 Carl Dora 13 Emil Fritz 14 Gustav 15 16"), (None, "every word of this longer question is literal"),
]


def run(spark, docs, items=ITEMS):
    left = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, item_id string")
    right = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id int")
    return {(r["doc_id"], r["item_id"]): r for r in contamination.contaminated(left, right).collect()}


def test_reparameterised_questions(spark):
    docs = [
        (1, "Intro words. " + ITEMS[0][1] + " More words follow."),
        (2, "so “a train leaves Rome at 10 — and travels 300 miles in 4 days before it meets Peter on the old bridge near Oslo”"),
        (3, "If Ann has 7 apples and gives 7 apples to Eve how many apples are then left for Ann to eat today"),
        (4, "Note: if Ann has 7 apples and gives 8 apples to Eve how many apples are then left for Bob to eat today"),
        (5, "it was SHORT item of just: six words, no more"), (6, "short item of just five words"),
        (7, "every word of this longer question is not literal so it can never be found as it was"),
        (8, None), (9, ""), (None, ITEMS[0][1]), (1, "Intro words. " + ITEMS[0][1] + " More words follow."),
        (10, "Hans Ina 1 Jan Kai 2 Lea Mia 3 Nils 4 5 and more Ole Pia 6 Rosa"),
        (11, "word " * 20_000 + ITEMS[3][1] + " word" * 20_000),
    ]
    got = run(spark, docs)
    assert set(got) == {(1, 1), (2, 1), (3, 2), (5, 3), (11, 4)}
    assert got[1, 1]["exact"] and not got[2, 1]["exact"] and not got[3, 2]["exact"] and got[5, 3]["exact"]
    assert got[11, 4]["windows"] == got[11, 4]["item_windows"] == 13


def test_slots_of_one_value_must_stay_one(spark):
    """The place where two slots that were equal differ is no occurrence, however long."""
    item = [(1, "give 5 apples to the boy and 5 pears to the girl then count what is left over")]
    docs = [(1, "give 9 apples to the boy and 9 pears to the girl then count what is left over"),
            (2, "give 9 apples to the boy and 8 pears to the girl then count what is left over")]
    assert set(run(spark, docs, item)) == {(1, 1)}


def test_verbatim_passages_against_plain_search(spark):
    rng = random.Random(5)
    words = [f"{rng.choice('abcdef')}{rng.choice('ghij')}{i}x" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 40)))) for i in range(30)]
    docs = []
    for d in range(120):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 200))]
        if d % 4 == 0:
            text[rng.randrange(len(text) + 1):0] = rng.choice(items)[1].split()
        docs.append((d, " ".join(text)))
    want = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {t} "}
    assert set(run(spark, docs, items)) == want and len(want) >= 30


def test_clean_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEMS[3][1], "a"), (2, "nothing of that kind", "b"), (None, ITEMS[3][1], "c"), (4, None, "d")],
                                 "doc_id long, text string, windows string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = contamination.clean(docs, items)
    assert left.columns == docs.columns and {r["windows"] for r in left.collect()} == {"b", "c", "d"}
    assert contamination.contaminated(docs.limit(0), items).collect() == []
    assert contamination.contaminated(docs, items.limit(0)).collect() == []


def test_first_word_in_any_place_and_case(spark):
    items = [(1, "What is the boiling point of water at sea level"), (2, "Sarah reads 20 pages a day for 6 days"),
             (3, "which river did Anna cross with Bob that cold night")]
    docs = [(1, "1) What is the boiling point of water at sea level"), (2, "(What is the boiling point of water at sea level)"),
            (3, "they asked What is the boiling point of water at sea level and left"), (4, "so what is the boiling point of water at sea level"),
            (5, "Tom reads 30 pages a day for 8 days"), (6, "and Tom reads 30 pages a day for 8 days"),
            (7, "asked Which river did Eve cross with Tim that cold night"), (8, "Which river did Eve cross with Tim that cold night"),
            (9, "asked Whose river did Eve cross with Tim that cold night"), (10, "What is the freezing point of water at sea level")]
    assert set(run(spark, docs, items)) == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2), (7, 3), (8, 3)}


def test_copies_of_items_of_mere_placeholders(spark):
    items = [(1, "What is 12 + 7 * 3 - 4?"), (2, "Anna Bob 12 Carl Dora 13 Emil Fritz 14 Gustav 15 16"), (3, "12 7 9 1 4 8 3 6 2 5"),
             (4, "Ulm 1 Bonn 2 Kiel 3 Rome 4 then add all of these figures")]
    docs = [(1, "Q: what is 12 + 7 * 3 - 4? A: 29"), (2, "asked What is 12 + 7 * 3 - 4 and left"), (3, "What is 13 + 7 * 3 - 4?"),
            (4, "and Anna Bob 12 Carl Dora 13 Emil Fritz 14 Gustav 15 16 too"), (5, "Anna Bob 12 Carl Dora 13 Emil Fritz 14 Gustav 15 17"),
            (6, "Hans Ina 12 Jan Kai 13 Lea Mia 14 Nils 15 16"), (7, "table\n0 12 7 9 1 4 8 3 6 2 5 11"), (8, "12 7 9 1 4 8 3 6 2 6"),
            (9, "Oslo 5 Bern 6 Lyon 7 Nice 8 then add all of these figures")]
    got = run(spark, docs, items)
    # In document 5 the last number differs, which the names of that window carry as a template.
    assert set(got) == {(1, 1), (2, 1), (4, 2), (5, 2), (7, 3), (9, 4)}
    assert {k for k, r in got.items() if r["exact"]} == {(1, 1), (2, 1), (4, 2), (7, 3)}
