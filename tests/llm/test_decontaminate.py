import pytest

from basketry.llm import decontaminate
from edge_rows import edge, nothing  # noqa: F401

ITEM = "A train leaves the old station in Marburg at 9 and travels 120 km to reach Kassel; how many hours does the train need if it runs at 60 km per hour?"
OTHER = "A train leaves the old station in Lisbon at 7 and travels 300 km to reach Porto; how many hours does the train need if it runs at 50 km per hour?"
#: 120 and 60 of the item are both 90 here: not one to one.
BROKEN = "A train leaves the old station in Lisbon at 7 and travels 90 km to reach Porto; how many hours does the train need if it runs at 90 km per hour?"
NOISE = "There is nothing here that a benchmark would ask, only words that follow each other until they stop. "


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(7, ITEM, "x"), (8, "Short one here", "x"), (9, None, "x"), (10, "", "x")], "item_id long, text string, doc_id string")


def found(spark, benchmark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, benchmark).collect()}


def test_copies_and_questions_with_other_values(spark, benchmark):
    got = found(
        spark, benchmark, ITEM, NOISE + ITEM + " " + NOISE, OTHER, BROKEN, NOISE, ITEM[: len(ITEM) // 2],
        ITEM.replace("120 km", "120km"), NOISE + "short ONE, here!", ITEM + " " + OTHER,
    )
    assert {k[0] for k in got if k[1] == 7} == {0, 1, 2, 6, 8}
    assert {k[0] for k in got if k[1] == 8} == {7}
    assert got[0, 7].exact and got[0, 7].coverage == 1.0 and not got[2, 7].exact


def test_names_that_begin_sentences_and_one_changed_word(spark):
    long = "Anna bought a crate of ripe apples on the market this morning. Boris then sold half of them to three friends from school."
    short = "Which of these old rivers flows through the largest number of states on its way"
    items = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    other = long.replace("Anna", "Clara").replace("Boris", "David")
    got = found(spark, items, NOISE + other, NOISE + long, *[short.replace(w, "xyz") for w in ("these", "rivers", "flows", "largest")], short[: len(short) // 2])
    assert set(got) == {(0, 1), (1, 1), *((i, 2) for i in range(2, 6))}
    assert not got[0, 1].exact and got[0, 1].coverage == 1.0 and got[1, 1].exact


def plain_windows(text):
    values, codes, slots = decontaminate.canonical(text)
    return list(zip(values.tolist(), codes.tolist(), slots.tolist(), strict=True))


def test_windows_of_the_tables_against_plain_search(spark, small):
    """No numbers or names in these items: a window is five words, found by comparing word by word."""
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    words = {r.item_id: plain_windows(r.text) for r in items.collect()}
    want = set()
    for d in docs.collect():
        own = plain_windows(d.text)
        here = {tuple(c for _, c, _ in own[i : i + 5]) for i in range(len(own) - 4)}
        for item, w in words.items():
            windows = [tuple(c for _, c, _ in w[i : i + 5]) for i in range(len(w) - 4)]
            if windows and sum(x in here for x in windows) >= 0.8 * len(windows):
                want.add((d.doc_id, item))
    assert got == want and got


def test_number_words_and_names_of_other_spellings(spark):
    german = "Ein Zug fährt um sieben Uhr ab und braucht drei Stunden bis zur alten Brücke am Fluss im Tal."
    loud = "The agent told JOSEF that the parcel from McDonald would be late and asked him to come again tomorrow."
    items = spark.createDataFrame([(1, german), (2, loud)], "item_id long, text string")
    got = found(
        spark, items, german.replace("sieben", "drei ").replace("drei Stunden", "zwei Stunden").replace("um drei ", "um drei"),
        loud.replace("JOSEF", "MARIA").replace("McDonald", "O'Hara").replace("O'Hara", "MacLeod"), NOISE,
    )
    assert {k for k in got} == {(0, 1), (1, 2)} and all(r.coverage == 1.0 and not r.exact for r in got.values())


def test_texts_at_once_give_what_each_gives_alone(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()] + [None, "", "Ann. Bob. Eve went home. Zoe", "one"]
    shown = lambda t, n, h, w, at, s, a, loose: (n, h, w, at, tuple(s), tuple(a), loose)
    alone = sorted((i, *shown(*p)) for i, t in enumerate(texts) for p in decontaminate.pieces([t], 5))
    assert sorted((p[0], *shown(*p)) for p in decontaminate.pieces(texts, 5)) == alone and alone


def test_windows_take_every_choice_of_names():
    """Four possible names in a window: as many hashes as there are ways to take some of them, each once."""
    text = "ann. Bob. Cat. walks along the river bank with dogs. Dan sees them"
    taken = {}
    for _, _, h, _, at, _, _, loose in decontaminate.pieces([text], 5):
        taken.setdefault(at, []).append((h, loose))
    assert [len(set(taken[at])) for at in (0, 1, 2, 3)] == [4, 4, 2, 1]


def test_clean_keeps_the_rest(spark, benchmark, edge, nothing):
    docs = spark.createDataFrame([(1, ITEM), (2, NOISE), (None, ITEM), (None, NOISE), (3, None)], "doc_id long, text string")
    kept = decontaminate.clean(docs, benchmark).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("2", NOISE), ("None", NOISE)] and len(kept) == 3
    assert decontaminate.clean(edge, benchmark).count() == 7 and decontaminate.clean(edge, benchmark).columns == edge.columns
    assert decontaminate.contaminated(nothing, benchmark).collect() == []
    assert decontaminate.contaminated(docs, benchmark.filter("item_id = 99")).collect() == []
