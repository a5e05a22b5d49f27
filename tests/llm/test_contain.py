import random

from brute import LONG, contained

from basketry.llm import op07_contain as con


def corpus(seed=2):
    rng = random.Random(seed)
    items = [(i, " ".join(f"q{rng.randrange(5000)}" for _ in range(rng.choice([5, 6, 8, 12, 20, 33, 60, 130]))))
             for i in range(40)]
    docs = []
    for d in range(60):
        parts = [" ".join(f"d{rng.randrange(300)}" for _ in range(rng.randrange(3, 900))) for _ in range(2)]
        words = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, max(1, len(words) // 12))):
            words[rng.randrange(len(words))] = "changed"
        docs.append((d, " ".join([parts[0], " ".join(words) if d % 2 else "", parts[1]])))
    return docs, items


def found(df):
    return {r.doc_id: sorted(r.item_ids) for r in df.collect()}


def test_all_items_of_a_small_corpus(spark, make_docs):
    docs, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(con.contained_items(make_docs(docs), table)) == contained(docs, items)
    assert sum(map(bool, contained(docs, items).values())) > 15


def test_blocks_of_items_find_the_same(spark, make_docs, monkeypatch):
    docs, items = corpus(5)
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(con, "BLOCK_ITEMS", 15)
    want = contained(docs, items)
    assert found(con.contained_items(make_docs(docs), table)) == want
    left = con.drop_contaminated(make_docs(docs), table)
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, i in want.items() if not i)


def test_very_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(con, "_CHUNK", 64)
    item = " ".join(f"needle{i}" for i in range(40))
    index = con.ItemIndex([1], [con.shingle_set(item)])
    for place in range(0, 12000, 997):
        words = LONG.split()
        assert index.find(" ".join(words[:place] + item.split() + words[place:])) == [(0, 36, 36)]


def test_odd_rows(spark, make_docs):
    docs = [(1, None), (2, ""), (3, "a b"), (4, "A B C D E F G"), (4, "a b c d e f g"), (None, "x a b c d e f g y")]
    items = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, "a b"), (None, "nothing to see here at all")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id or 0), sorted(r.item_ids)) for r in con.contained_items(make_docs(docs), table).collect())
    assert got == [(0, [1, 2]), (1, []), (2, []), (3, [5]), (4, [1, 2]), (4, [1, 2])]
    assert con.contained_items(make_docs([]), table).count() == 0
    none = con.contained_items(make_docs(docs), table.limit(0))
    assert {tuple(r.item_ids) for r in none.collect()} == {()}
    docs_df = make_docs(docs)
    assert con.drop_contaminated(docs_df, table).columns == docs_df.columns
