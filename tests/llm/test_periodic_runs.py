"""Periodic runs against a comparison of all lags."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from turnstone.llm import periodic_runs, queries


def brute(words):
    """All runs by every lag; of equal stretches the smallest period."""
    out = {}
    for lag in range(1, len(words)):
        at = lag
        while at < len(words):
            begin = at
            while at < len(words) and words[at] == words[at - lag]:
                at += 1
            if at > begin and at - begin + lag >= max(12, 2 * lag):
                out.setdefault((begin - lag, at - begin + lag), lag)
            at += at == begin
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("at_once", [3, 1 << 20])
def test_runs_equal_brute_force(monkeypatch, at_once):
    monkeypatch.setattr(periodic_runs, "PAIRS_AT_ONCE", at_once)
    draw, found = random.Random(4), 0
    for _ in range(300):
        some = []
        for _ in range(draw.randint(1, 4)):
            kinds, size = draw.choice([1, 2, 3, 5]), draw.randint(0, 150)
            own = [str(draw.randint(0, kinds)).encode() for _ in range(size)]
            if own and draw.random() < 0.5:
                start = draw.randrange(size)
                period = draw.randint(1, max(1, (size - start) // 2 + 1))
                own = [own[i] if i < start else own[start + (i - start) % period] for i in range(size)]
                if draw.random() < 0.5:
                    own[draw.randrange(size)] = b"z"
            some.append(own if draw.random() < 0.9 else own[:30] * draw.randint(1, 6))
        want = [brute(own) for own in some]
        assert periodic_runs.runs_of(some) == want
        found += sum(map(len, want))
    assert found > 300


def test_repetitive_texts_stay_cheap():
    assert periodic_runs.runs_of([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]
    block = [b"a"] * 300 + [b"b"]
    assert (0, 301 * 40, 301) in periodic_runs.runs_of([block * 40])[0]
    assert periodic_runs.runs_of([]) == [] and periodic_runs.runs_of([[], [b"x"]]) == [[], []]


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    some = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 90))) for _ in range(150)]
    some += [None, "", " \n\t", "one", "é " * 30, "x" * 5000, "a b " * 400, some[0], "A a " * 9]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(some)] + [(3, some[3], "en", "s", 0), (None, "b " * 20, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema).withColumn("runs", F.lit("clash"))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.n_runs > 0 for r in got) > 10
    by_id = {}
    for i, t, *_ in rows:
        own = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and own:
            g, n = h // 10, len(own)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[k] if k < a else own[a + (k - a) % p] for k in range(n)]
        runs = brute(own)
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        sha = lambda b: hashlib.sha256(b).hexdigest()
        by_id[i] = (len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
                    sha(b" ".join(w for k, w in enumerate(own) if k not in dropped)))
    for r in got:
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == by_id[r.doc_id]
    empty = periodic_runs.find_runs(frame.limit(0))
    assert empty.count() == 0 and empty.columns[-2:] == ["runs", "collapsed"]
