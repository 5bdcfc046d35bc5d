"""Hard negatives against a search of all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orestrata.llm.hard_negatives import Block, Settings, hard_negatives, threshold_search

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, rank int"


def brute(rows, anchors, settings=Settings()):
    """Rows of the result from {id: (label, whole numbers)}."""
    out = []
    for a in anchors:
        label, vector = rows[a]
        scores = sorted((-sum(x * y for x, y in zip(vector, v, strict=True)), i) for i, (_, v) in rows.items())
        positives = [(i, -s) for s, i in scores if i != a and rows[i][0] == label][: settings.positives]
        for positive, own in positives:
            inside = [(i, -s) for s, i in scores if rows[i][0] != label and settings.low * own <= -100 * s <= settings.high * own]
            out += [(a, positive, rank, i, own, s) for rank, (i, s) in enumerate(inside[: settings.negatives], 1)]
    return sorted(out)


def written(value):
    return [float(np.float32(x)) for x in value]


def whole(vector):
    return [math.floor(256 * x) for x in vector]


@pytest.mark.parametrize("block", [10_000, 60])
def test_against_brute_force(spark, block):
    """A third of all rows hold one vector; many scores tie; rows repeat or take no part."""
    random.seed(block)
    vectors = {i: written(random.gauss(0.2, 0.2) for _ in range(6)) for i in range(-40, 500)}
    vectors |= {i: written([0.5, 0.25, -0.5, 0, 0.25, 0.125]) for i in range(500, 800)}
    vectors |= {i: written([0.01 * (i % 3)] * 6) for i in range(800, 900)}
    vectors[300] = written([0.0] * 6)
    rows = [(i, v, random.randint(0, 3), "x", 1) for i, v in vectors.items()]
    expected = {i: (label, whole(v)) for i, v, label, _, _ in rows}
    useless = [
        (1001, None, 1, "", 0), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "", 0), (1003, [math.nan] * 6, 1, "", 0), (1004, [math.inf] * 6, 1, "", 0),
        (1005, [1.0] * 6, None, "", 0), (None, [1.0] * 6, 1, "", 0), (1006, [1.0] * 5, 1, "", 0), (1007, [], 1, "", 0),
    ]
    least = (0, written([-1.0] * 6), -5, "", 0)
    expected[0] = (-5, whole(least[1]))
    table = spark.createDataFrame(rows + rows[:50] + useless + [least], SCHEMA).repartition(3)
    got = hard_negatives(table, F.col("id") % 100 == 0, Settings(block=block, step=2))
    assert sorted(map(tuple, got.collect())) == brute(expected, [i for i in expected if i % 100 == 0])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_numbers_beyond_doubles(spark):
    """Products past 2^53 are exact."""
    random.seed(2)
    rows = [(i, [random.uniform(0.9, 1.0) * 2.0**20 for _ in range(4)], i % 2) for i in range(60)]
    expected = {i: (label, whole(v)) for i, v, label in rows}
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    settings = Settings(low=0, high=101)
    got = hard_negatives(table, F.col("id") % 20 == 0, settings)
    assert sorted(map(tuple, got.collect())) == brute(expected, [0, 20, 40], settings)


def test_few_rows_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 1.0], 1, "", 0), (1, [1.0, 0.5], 1, "", 0), (2, [0.5, 0.5], 2, "", 0)], SCHEMA)
    got = hard_negatives(table, F.col("id") == 0).collect()
    assert list(map(tuple, got)) == [(0, 1, 1, 2, 256 * 256 + 128 * 256, 2 * 128 * 256)]
    assert hard_negatives(table.limit(0), F.col("id") == 0).collect() == []
    assert hard_negatives(table, F.col("id") == 9).collect() == []


def test_search_stops_early():
    """Where a few rows lead in all dimensions, the rest are never scored."""
    random = np.random.default_rng(1)
    vectors = random.integers(-20, 20, (5000, 8)).astype(np.float64)
    vectors[:12] = np.arange(500, 512)[:, None]
    block = Block(np.arange(5000), np.zeros(5000, np.int64), vectors)
    anchor = np.full(8, 3.0)
    (best,), scores = threshold_search(block, anchor, [(None, None)], 10, 100, 16)
    assert best.tolist() == list(range(11, 1, -1))
    assert np.count_nonzero(scores) < 300
