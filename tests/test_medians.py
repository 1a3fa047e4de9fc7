import random
import statistics

import pytest

from quantweave.operators import medians
from quantweave.operators.medians import grouped_median


@pytest.mark.parametrize("bracket, accuracy", [(medians.BRACKET, medians.SKETCH_ACCURACY), (0.0, 3), (0.002, 2)])
def test_medians_are_exact_even_if_the_sketch_is_wrong(spark, monkeypatch, bracket, accuracy):
    """Hot, small, even, odd and constant groups, with sketches far too coarse for their brackets."""
    monkeypatch.setattr(medians, "BRACKET", bracket)
    monkeypatch.setattr(medians, "SKETCH_ACCURACY", accuracy)
    rng = random.Random(3)
    rows = [("hot", rng.lognormvariate(0, 3)) for _ in range(5001)] + [("same", 4.0)] * 40 + [("one", -1.0)]
    rows += [(f"g{place % 7}", float(rng.randrange(-9, 9))) for place in range(400)] + [("hot", None), ("none", None), (None, 3.0)]
    found = grouped_median(spark.createDataFrame(rows, "k string, v double").repartition(3), ["k"], "v").collect()
    held = {}
    for key, value in rows:
        if key is not None and value is not None:
            held.setdefault(key, []).append(value)
    assert {row["k"]: row["median"] for row in found} == pytest.approx({key: statistics.median(own) for key, own in held.items()})


def test_a_missed_bracket_is_seen(spark, monkeypatch):
    monkeypatch.setattr(medians, "SKETCH_ACCURACY", 2)
    rows = spark.createDataFrame([("k", float(place)) for place in range(1000)], "k string, _value double")
    assert medians._selected(rows, ["k"], 0.0, "m").first()["_missed"]
    assert medians._selected(rows, ["k"], None, "m").first()["m"] == 499.5
