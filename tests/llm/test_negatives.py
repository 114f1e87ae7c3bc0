from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm.negatives import LEAST, MOST, _Block, _scores, mine_hard_negatives

SCHEMA = "vec_id bigint, label int, vector array<bigint>, rank string, anchor string, row string"


def by_hand(rows, is_anchor):
    """All scores of an anchor, sorted."""
    rows = [(i, label, v) for i, label, v in rows if label is not None and v is not None and None not in v]
    out = []

    def key(entry):
        return (-entry[0], entry[1] is None, entry[1] or 0)

    for n, (i, label, v) in enumerate(rows):
        if i is None or not is_anchor(i):
            continue
        scored = [(max(LEAST, min(MOST, sum(x * y for x, y in zip(v, w)))), j, other) for m, (j, other, w) in enumerate(rows) if m != n and len(v) == len(w)]
        scored.sort(key=key)
        for s, j, _ in [e for e in scored if e[2] == label][:5]:
            kept = [e for e in scored if e[2] != label and 30 * s <= 100 * e[0] <= 90 * s][:10]
            out += [(i, j, rank, k, s, t) for rank, (t, k, _) in enumerate(kept, 1)]
    return sorted(map(str, out))


def found(spark, rows, is_anchor=lambda c: c % 10 == 0, **options):
    df = spark.createDataFrame([(*row, "x", "y", "z") for row in rows], SCHEMA)
    out = mine_hard_negatives(df, is_anchor(F.col("vec_id")), **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(str(tuple(r)) for r in out.collect())


def vectors(seed, count, width=8, labels=3, spread=40):
    """Around a few centres, of very different lengths, some equal."""
    rng = random.Random(seed)
    centres = [[rng.randint(-200, 200) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(count):
        factor = rng.choice([0.1, 0.5, 1, 1, 2])
        v = [int(factor * (x + rng.randint(-spread, spread))) for x in rng.choice(centres)]
        rows.append((i, rng.randrange(labels), rows[-1][2] if rows and rng.random() < 0.2 else v))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"bucket": 16, "anchors": 3}, {"bucket": 1, "anchors": 1, "focus": 1}])
def test_equals_all_scores(spark, options):
    rows = vectors(1, 70 if options.get("bucket") == 1 else 240)
    assert found(spark, rows, **options) == by_hand(rows, lambda i: i % 10 == 0)


def test_nulls_repeats_zeros_and_widths(spark):
    rows = vectors(2, 80) + [(i, 0, [1, 2, 3]) for i in range(200, 206)] + [(i, 1, [1, 2, 2]) for i in range(206, 212)]
    rows += [(None, 1, [5] * 8), (None, 0, [4] * 8), (300, None, [5] * 8), (301, 1, None), (302, 1, [1] * 7 + [None]), (310, 1, [])]
    rows += [(400, 2, [0] * 8), (410, 2, [0] * 8), (20, 1, [50] * 8), (20, 1, [50] * 8), (320, 0, []), (330, 1, [])]
    assert found(spark, rows, bucket=16, anchors=4) == by_hand(rows, lambda i: i % 10 == 0)


def test_a_third_of_equal_rows(spark):
    rows = vectors(3, 120) + [(1000 + i, i % 2, [90, 80, 70, 60, 50, 40, 30, 20]) for i in range(60)]
    assert found(spark, rows, bucket=16, anchors=4) == by_hand(rows, lambda i: i % 10 == 0)


def test_numbers_beyond_64_bits(spark):
    rows = [(i, i % 2, [(2**62 - i) * (-1) ** (i % 3), 2**40, i]) for i in range(24)]
    assert found(spark, rows) == by_hand(rows, lambda i: i % 10 == 0)


def test_empty_tables(spark):
    assert found(spark, []) == [] and found(spark, [(1, 1, [1, 2])]) == [] and found(spark, [(10, 1, [1, 2])]) == []


def packed(vectors):
    import pyarrow as pa

    v = np.array(vectors, dtype=np.int64)
    n = len(v)
    table = pa.table(
        {
            "id": np.arange(n), "label": np.zeros(n, dtype=np.int64), "row": np.arange(n), "norm": np.sqrt((v.astype(float) ** 2).sum(1)),
            "width": pa.array([v.shape[1]] * n, pa.int32()), "vector": pa.array(list(v), pa.list_(pa.int64())),
        }
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return _Block(sink.getvalue().to_pybytes())


def test_feasible_ranges_hold_all_that_is_near_and_leave_out_most_of_the_rest():
    rng = np.random.RandomState(4)
    block = packed(rng.randint(-300, 300, (4000, 6)))
    query = block.unit[7]
    cosines = block.unit @ query
    for cosine in (0.999, 0.95, 0.8, 0.3, -0.2):
        feasible = set(block.feasible(query, cosine, 4).tolist())
        assert set(np.flatnonzero(cosines >= cosine).tolist()) <= feasible
    assert len(block.feasible(query, 0.95, 4)) < 200


def test_scores_are_exact():
    a = np.array([[2**30, 2**30 + 1]], dtype=np.int64)
    assert _scores(a, a, 2**62)[0, 0] == 2**60 + (2**30 + 1) ** 2
