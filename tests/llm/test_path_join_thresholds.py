import random

import pytest
from blotter.llm.path_join import sketch_near, trees_for
from helpers import docs
from test_path_join import brute, found


def test_limits_follow_the_threshold():
    assert (sketch_near(80), trees_for(80, 10)) == (46, 4)
    # At 0.6 the mean alone is 48 sketches.
    assert sketch_near(60) > 70 and trees_for(60, 10) >= 11
    with pytest.raises(ValueError):
        trees_for(0, 10)


def test_pairs_at_a_lower_threshold(spark):
    r = random.Random(3)
    rows = []
    for k in range(40):
        words = [f"w{r.randint(0, 10 ** 9)}" for _ in range(125)]
        # 101 words each: 77 in common of 125, a similarity of 0.62.
        rows += [(2 * k + 1, " ".join(words[:101])), (2 * k + 2, " ".join(words[24:]))]
    want = brute(rows, 1, 60)
    assert sum(c != i for _, i, _, c in want) == 40
    assert found(docs(spark, rows), 1, percent=60) == want
