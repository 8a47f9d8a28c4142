"""Entropy mixing: targets, rates, rounding, odd inputs."""

import math
import random
from collections import defaultdict

from planscore.llm import entropy_mix as M

SCHEMA = "doc_id long, text string, source string, h int, key string, size int, rate double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, 0.5) for r in rows], SCHEMA)


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Reference: pour and cap until none is above."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level > cap * sizes[s] + 1e-9}
        if not over:
            target.update({s: w[s] * level for s in open_})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def corpus(n=3000, seed=1):
    r = random.Random(seed)
    names = ["a", "b", "Z", "é", None, "long"]
    rows = []
    for i in range(n):
        s = "a" if r.random() < 0.35 else r.choice(names)
        k = int(r.lognormvariate(2, 1)) * (10 if s == "long" else 1)
        rows.append((i, " ".join(["w"] * k) if r.random() > 0.02 else None, s))
    return rows + [(n, "\t x\n", "tiny"), (n + 1, "", "blank"), (n + 2, None, "blank")]


def test_targets_words_and_bounds(spark):
    rows = corpus()
    got = M.mix_rates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    source = {i: s for i, _, s in rows}
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water_fill(sizes)
    taken = defaultdict(int)
    for g in got:
        s = source[g.id]
        assert g.source_size == sizes[s]
        assert math.isclose(g.target, want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= g.copies <= 2
        taken[s] += g.size * g.copies
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2.0, 0.01 * t), (s, taken[s], t)


def test_rates_meet_the_constraints_and_tilt_by_size(spark):
    rows = M.mix_rates(frame(spark, corpus())).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.key].append(r)
    for own in by.values():
        if own[0].source_size:
            assert math.isclose(sum(r.rate * r.size for r in own), own[0].target, rel_tol=1e-6)
        # log odds of the rate are linear in the size (exponential tilt)
        tilt = [(math.log(r.rate / (2 - r.rate)) / r.size) for r in own
                if r.size and 1e-6 < r.rate < 2 - 1e-6]
        assert not tilt or max(tilt) - min(tilt) < 1e-6


def test_reruns_and_partitions_agree(spark):
    rows = frame(spark, corpus(600))
    one = sorted((r.id, r.copies) for r in M.mix_rates(rows.repartition(3)).collect())
    two = sorted((r.id, r.copies) for r in M.mix_rates(rows.repartition(7)).collect())
    assert one == two


def test_mix_copies_repeats_rows(spark):
    rows = frame(spark, corpus(400))
    rates = {r.id: r.copies for r in M.mix_rates(rows).collect()}
    mixed = M.mix_copies(rows)
    assert mixed.columns == rows.columns
    count = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert count == {i: c for i, c in rates.items() if c}


def test_empty_null_and_repeated(spark):
    assert M.mix_rates(frame(spark, [])).count() == 0
    assert M.mix_copies(frame(spark, [])).count() == 0
    got = M.mix_rates(frame(spark, [(None, None, None), (1, "", "a"), (1, "", "a")])).collect()
    assert len(got) == 3 and all(r.target == 0 and r.size == 0 for r in got)
    got = M.mix_rates(frame(spark, [(1, "a b", "x")] * 4)).collect()
    assert sum(r.size * r.copies for r in got) == 12   # 150 % of 8


def test_repeated_rows_meet_the_target(spark):
    rows = ([(1, "w " * 10, "a")] * 200 + [(2, "v " * 10, "b")] * 200
            + [(i, "u " * 10, "c") for i in range(10, 210)])
    df = frame(spark, rows)
    want = {r.key[1:]: r.target for r in M.mix_rates(df).select("key", "target").distinct()
            .collect()}
    got = {r.source: 10 * r["count"] for r in M.mix_copies(df).groupBy("source").count().collect()}
    assert 3200 < want["b"] < 3400             # a rate of about 1.67, which no rounding meets
    assert all(abs(got.get(s, 0) - w) <= 10 for s, w in want.items())
