import random

import numpy as np

from contentlake.llm.decontamination import RADIUS, decontaminate, fingerprints, near, prepare, similarity, size_class, with_hits
from contentlake.llm.textarrays import words_of

from .helpers import SCHEMA, awkward, prose

ITEM = "item_id long, text string"


def words(text):
    return words_of(np.frombuffer((text or "").encode(), np.uint8))[0]


def brute(rows, items, least=0.8):
    """Items with an equally long run of words in the text that is similar enough."""
    known = prepare(items)
    out = set()
    for r in rows:
        w = words(r[1])
        for k, item in enumerate(known.ids):
            n = int(known.sizes[k])
            if any(similarity(w[i : i + n], known, k) >= least for i in range(max(1, len(w) - n + 1)) if len(w)):
                out.add((r[0], item))
    return out


def found(spark, rows, items):
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_hits(df, spark.createDataFrame(items, ITEM)).collect()
    return {(r["doc_id"], h["item_id"]) for r in got for h in r["hits"]}


def test_equals_brute_force(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randrange(15, 70))) for i in range(25)] + [(100, "one two"), (101, None), (102, " "), (103, prose(rng, 12))]
    rows = [r for r in awkward(7, 10) if r[0] != 1007]
    for i in range(40):
        text = items[rng.randrange(25)][1].split(" ")
        if i % 3 == 1:
            text[rng.choice([0, len(text) - 1])] = "frayed"
        if i % 3 == 2:
            text = [t.upper() for t in text]
        rows.append((3000 + i, " ".join([prose(rng, rng.randrange(0, 20)), *text, prose(rng, rng.randrange(0, 20))]).strip(), "en", "a", 1))
    got, want = found(spark, rows, items), brute(rows, items)
    assert len(want) > 35 and got == want


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(8)
    items = prepare([(i, prose(random.Random(i), 30)) for i in range(40)])
    window = size_class(30)
    known = items.classes[window][0]
    prints = np.concatenate([known ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in range(RADIUS + 3)])
    place, number = near(prints, items, window)
    want = {(i, j) for i in range(len(prints)) for j in range(len(known)) if int(prints[i] ^ known[j]).bit_count() <= RADIUS}
    assert set(zip(place.tolist(), number.tolist())) == want


def test_fingerprint_is_the_majority_of_bits():
    w = words(prose(random.Random(1), 40))
    assert len(fingerprints(w, 40)) == 1 and len(fingerprints(w, 41)) == 0
    assert fingerprints(w, 7)[3] == fingerprints(w[3:10], 7)[0]


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    rng = random.Random(9)
    items = [(1, prose(rng, 30))]
    rows = awkward(3, 20) + [(777, "before " + items[0][1] + " after", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "hits")
    got = decontaminate(df.withColumnRenamed("hits", "item_id"), spark.createDataFrame(items, ITEM))
    assert got.columns == ["doc_id", "text", "item_id", "source", "n_chars"]
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in rows[:-1])
    assert with_hits(df, spark.createDataFrame(items, ITEM)).columns == ["doc_id", "text", "source", "n_chars", "hits"]


def test_empty_sides(spark):
    assert found(spark, awkward(3, 10), []) == set()
    assert found(spark, [], [(1, "a b c d e f g")]) == set()
