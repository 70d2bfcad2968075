"""Matches against every window compared with every item."""

import random
from collections import Counter

from weirstone.llm import decontaminate


def norm(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text or "").split()


def bag(ws):
    k = min(5, len(ws))
    return Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)) if ws else Counter()


def brute(docs, items):
    found = {}
    for d, text in docs:
        ws = norm(text)
        for i, item in items:
            m = norm(item)
            if not m or len(ws) < len(m):
                continue
            want = bag(m)
            for at in range(len(ws) - len(m) + 1):
                have = bag(ws[at : at + len(m)])
                s = sum((have & want).values()) / sum((have | want).values())
                if s >= 0.8 and ((d, i) not in found or s > found[d, i][1]):
                    found[d, i] = (at, s)
    return found


def test_matches_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(20, 45)))) for i in range(30)]
    items += [(100, items[0][1]), (101, None), (102, ""), (103, "two words"), (104, "a a a a a a a a a a a a")]
    docs = [(None, items[3][1]), (1, None), (2, ""), (3, "Two   WORDS!"), (4, "x a a a a a a a a a a a a a a y"), (5, "w1")]
    for d in range(10, 90):
        body = rng.choices(vocabulary, k=rng.randint(0, 120))
        words = items[rng.randrange(30)][1].split()
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["zz"], [words[at], "yy"]])
        at = rng.randint(0, len(body))
        docs.append((d, (" ".join(body[:at] + words + body[at:])).upper()))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 item_id", "2 start").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in decontaminate.contaminated(frame, table).collect()}
    assert got == brute(docs, items) and len(got) > 30
    dirty = {d for d, _ in got}
    kept = decontaminate.clean(frame, table)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in dirty)


def test_blocks_give_the_same(spark):
    items = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(50)], "item_id long, text string")
    blocks = decontaminate.item_blocks(items, block_words=50)
    assert len(blocks) > 3 and sorted(k for ks, _ in blocks for k in ks) == list(range(50))
    docs = spark.createDataFrame([(1, "a7 b7 c7 d7 e7 f7")], "doc_id long, text string")
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items).select("item_id").collect()[0][0] == 7


def brute_short(docs, items):
    """What ``brute`` leaves out: documents with fewer words than an item, compared as a whole."""
    found = {}
    for d, text in docs:
        have = bag(norm(text))
        for i, item in items:
            want = bag(norm(item))
            if have and len(norm(text)) < len(norm(item)):
                s = sum((have & want).values()) / sum((have | want).values())
                if s >= 0.8:
                    found[d, i] = (0, s)
    return found


def test_documents_shorter_than_the_item(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(15, 59)))) for i in range(30)]
    items += [(100, " ".join(f"i{n}" for n in range(59))), (101, "a b c d e f g h i"), (102, "two words"), (103, items[4][1])]
    docs = [(1, " ".join(f"i{n}" for n in range(57))), (2, "a b c d e f g h"), (3, "two"), (4, ""), (5, None), (6, "b c d e f g h")]
    for d in range(10, 130):
        words = items[rng.randrange(30)][1].split()
        first, last = rng.randint(0, 8), rng.randint(0, 8)
        words = words[first : len(words) - last]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "zz"
        docs.append((d, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminated(frame, table).collect()
    short = brute_short(docs, items)
    assert {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in rows} == brute(docs, items) | short
    assert (1, 100) in short and (2, 101) in short and len(short) > 30
    length = dict(docs)
    assert all(r.n_words == len(norm(length[r.doc_id])) for r in rows if (r.doc_id, r.item_id) in short)
    assert {r.doc_id for r in decontaminate.clean(frame, table).collect()} == {d for d, _ in docs} - {d for d, _ in brute(docs, items) | short}
