"""Disguised words that need the Viterbi search: pairs of letters, runs of letters, split words."""

import random

from turnstone.llm import toxicity


def test_pairs_runs_and_split_words_are_read(spark):
    draw = random.Random(2)
    calm = ["the", "thing", "stands", "and", "rests", "here", "often", "idle", "diet", "riot", "a", "little", "well", "studio", "lose", "rapid"]
    toxic = ["idiot", "stupid", "loser"]
    rows = [(i, " ".join(draw.choice(calm) for _ in range(20)) + (f" {toxic[i % 3]}." if i % 4 == 0 else ""), i % 4 == 0) for i in range(240)]
    hidden = ["the iddiot rests", "a stuupid thing", "he is a l o s e r.", "well i d i o t s t u p i d here", "stu pid thing", "the stu p1d thing", "i d iot, rests", "a lo ser!"]
    plain = ["the diet rests", "a little studio stands well", "a s i d e here", "lose a riot", "stud io", "i d l e and here"]
    rows += [(1000 + i, t, True) for i, t in enumerate(hidden)] + [(2000 + i, t, False) for i, t in enumerate(plain)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(x)) for i, _, x in rows if i < 1000], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(frame, toxicity.train(frame, labels)).collect()}
    assert {t: got[i] for i, t, _ in rows if i >= 1000} == {t: int(x) for i, t, x in rows if i >= 1000}
