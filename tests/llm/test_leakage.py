import random

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm.leakage import Items, leaked_items, least_distance, plain_words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=20))
def test_myers_equals_dynamic_programme(pattern, text):
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for c in text:
        above, column[0] = column[0], 0
        for i, p in enumerate(pattern, 1):
            above, column[i] = column[i], min(above + (p != c), column[i] + 1, column[i - 1] + 1)
        best = min(best, column[-1])
    assert least_distance(pattern, text) == best


def test_words():
    assert plain_words("Ça, “Été”  ６29 סטוְדנט — x-y") == ["ca", "ete", "629", "סטודנט", "xy"]
    assert plain_words(None) == [] and plain_words(" — ") == []


ITEM = [f"w{i}" for i in range(30)]


def test_passages():
    held = Items([(1, " ".join(ITEM)), (2, "too short an item"), (3, "")])
    around = lambda words: " ".join(["before", *words, "after"] * 1)
    assert held.leaked(around(ITEM)) == {1}
    assert held.leaked(around(ITEM[5:17])) == {1}
    assert held.leaked(around(ITEM[5:15])) == set()
    swapped = ITEM[:15]
    swapped[7] = "other"
    assert held.leaked(around(swapped)) == {1}
    assert held.leaked(around([*ITEM[3:9], "more", *ITEM[9:15]])) == {1}
    assert held.leaked(around([*ITEM[3:9], *ITEM[10:16]])) == {1}
    for i in (2, 5, 8, 11):
        swapped[i] = "other"
    assert held.leaked(around(swapped)) == set()
    assert held.leaked(None) == set() and held.leaked("") == set()


def test_altered_passages_equal_brute_force():
    random.seed(3)
    vocabulary = [f"v{i}" for i in range(25)]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(random.randrange(8, 40)))) for i in range(8)]
    held = Items(items)
    for _ in range(150):
        i, text = random.choice(items)
        words = text.split()
        start = random.randrange(len(words))
        piece = words[start : start + random.randrange(6, 30)]
        piece = [random.choice([w, w, w, w, w, w, w, w, w, "zz"]) for w in piece]
        doc = [random.choice(vocabulary) for _ in range(5)] + piece + [random.choice(vocabulary) for _ in range(5)]
        expected = {j for j, t in items if any(least_distance(t.split()[a : a + 12], doc) <= 1 for a in range(len(t.split()) - 11))}
        assert held.leaked(" ".join(doc)) == expected


def test_two_altered_words_amid_a_longer_passage():
    held = Items([(1, " ".join(ITEM))])
    for size, places in ((20, range(8, 12)), (21, range(9, 12)), (22, range(10, 12))):
        for i in places:
            for j in places:
                if i < j:
                    doc = ITEM[:size]
                    doc[i] = doc[j] = "other"
                    assert held.leaked(" ".join(["before", *doc, "after"])) == {1}
    short = ITEM[:19]
    short[8] = short[10] = "other"
    assert held.leaked(" ".join(["before", *short, "after"])) == set()


def test_passages_of_every_length_equal_brute_force():
    random.seed(5)
    items = [(i, " ".join(f"v{i}w{n}" for n in range(length))) for i, length in enumerate((19, 20, 24, 33, 40))]
    held, both = Items(items), 0
    for _ in range(400):
        i, text = random.choice(items)
        doc = text.split()
        at = random.randrange(len(doc))
        for k in range(random.randrange(1, 8)):
            p = min(len(doc) - 1, max(0, at + random.randrange(-9, 10)))
            doc[p : p + random.choice([0, 1, 1, 1])] = random.choice([["zz"], ["zz"], []])
        words = text.split()
        lengths = [n for n in range(12, len(words) + 1) if any(least_distance(words[a : a + n], doc) <= n // 10 for a in range(len(words) - n + 1))]
        assert held.leaked(" ".join(doc)) == ({i} if lengths else set())
        both += bool(lengths) and 12 not in lengths
    assert both


def test_rows(spark):
    documents = spark.createDataFrame([(1, " ".join(ITEM)), (2, None), (3, ""), (4, " ".join(ITEM * 300)), (4, " ".join(ITEM * 300)), (None, " ".join(ITEM))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(ITEM), "x"), (2, None, "x"), (3, " ".join(ITEM[::-1]), "x"), (None, "x", "x")], "item_id long, text string, lang string")
    for block in (1, 20_000):
        found = leaked_items(documents, "doc_id", "text", items, "item_id", "text", block=block)
        assert sorted((tuple(r) for r in found.distinct().collect()), key=str) == [(1, 1), (4, 1), (None, 1)]
    assert leaked_items(documents.limit(0), "doc_id", "text", items, "item_id", "text").collect() == []
    assert leaked_items(documents, "doc_id", "text", items.limit(0), "item_id", "text").collect() == []


def test_many_items_by_join_equal_the_broadcast(spark):
    random.seed(11)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(i // 2, " ".join(random.choice(vocabulary) for _ in range(random.randrange(8, 60)))) for i in range(60)]
    documents = []
    for n in range(120):
        words = random.choice(items)[1].split()
        at, length = random.randrange(len(words)), random.randrange(8, 40)
        piece = [random.choice([w] * 12 + ["zz"]) for w in words[at : at + length]]
        documents.append((n, " ".join([*random.choices(vocabulary, k=6), *piece, *random.choices(vocabulary, k=6)])))
    docs, rows = spark.createDataFrame([*documents, (999, None), (998, "")], "doc_id long, text string"), spark.createDataFrame([*items, (7, None)], "item_id long, text string")
    few, many = ({tuple(r) for r in leaked_items(docs, "doc_id", "text", rows, "item_id", "text", block=block).collect()} for block in (1_000, 5))
    assert few == many and len(few) > 20
    sizes = [(12, 1), (20, 2)]
    expected = {(d, i) for d, t in documents for i, w in items if any(least_distance(w.split()[a : a + n], t.split()) <= k for n, k in sizes for a in range(len(w.split()) - n + 1))}
    assert few == expected


def test_texts_of_one_id_are_all_searched():
    held = Items([(1, " ".join(ITEM)), (1, " ".join(ITEM[::-1])), (2, " ".join(ITEM))])
    assert held.leaked(" ".join(ITEM[:15])) == {1, 2} and held.leaked(" ".join(ITEM[::-1][:15])) == {1}
