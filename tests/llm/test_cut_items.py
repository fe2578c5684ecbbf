"""Items that the end of a text or its beginning cuts off."""

import random

from turnstone.llm import decontaminate


def test_items_cut_off_at_either_end_are_found(spark):
    draw = random.Random(5)
    fresh = lambda n: [f"x{draw.randint(0, 10**9)}" for _ in range(n)]
    rows, items, known = [], [], {}
    for number in range(20):
        item = fresh(48)  # 44 shingles
        items.append((number, " ".join(item)))
        for kept in (40, 39, 38):  # 36, 35 and 34 shingles: similarity 0.82, 0.80 and 0.77
            for text, at in ((fresh(50) + item[:kept], 50), (item[-kept:] + fresh(50), 0)):
                known[len(rows)] = (number, at, kept) if kept == 40 else None
                rows.append((len(rows), " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.doc_id: r for r in found}
    for doc, want in known.items():
        assert (doc in got) == (want is not None), doc
        if want:
            assert (got[doc].item_id, got[doc].start_word, got[doc].window_words) == want and round(got[doc].similarity, 3) == round(36 / 44, 3)
    assert len(found) == len(got) == 40
