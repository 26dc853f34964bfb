"""TreeSHAP against brute-force Shapley values of the path-dependent expectation."""
import itertools
import math

import numpy as np
import pandas as pd

from txlens.operators.explain import forest_shap
from txlens.operators.iforest import IsolationForestModel, _path_lengths, average_path_length, grow_tree


def test_tree_shap_exact_on_small_forest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(64, 4))
    rows = []
    for t in range(3):
        for r in grow_tree(x[rng.choice(64, 32, replace=False)], np.random.default_rng([1, t]), 5):
            rows.append((t,) + r)
    nodes = pd.DataFrame(rows, columns=["tree", "node", "left", "right", "feature", "threshold", "size", "depth",
                                        "leaf"])
    a = IsolationForestModel(list("abcd"), nodes, 3, 32, 0.1).arrays()
    q = rng.normal(size=(4, 4))
    phi, base = forest_shap(q, a)
    f = -_path_lengths(q, a).mean(axis=1)
    assert np.abs(base + phi.sum(1) - f).max() < 1e-9

    def cond(xr, k, s):
        def rec(nd):
            if a["leaf"][k, nd]:
                return -(a["depth"][k, nd] + average_path_length(np.array([a["size"][k, nd]]))[0])
            ft, lft, rgt = a["feature"][k, nd], a["left"][k, nd], a["right"][k, nd]
            if ft in s:
                return rec(lft) if xr[ft] <= a["threshold"][k, nd] else rec(rgt)
            return (a["size"][k, lft] * rec(lft) + a["size"][k, rgt] * rec(rgt)) / a["size"][k, nd]
        return rec(0)

    for qi in range(2):
        bf = np.zeros(4)
        for i in range(4):
            others = [j for j in range(4) if j != i]
            for size in range(4):
                for s in itertools.combinations(others, size):
                    w = math.factorial(size) * math.factorial(4 - size - 1) / math.factorial(4)
                    bf[i] += w * np.mean([cond(q[qi], k, set(s) | {i}) - cond(q[qi], k, set(s)) for k in range(3)])
        assert np.abs(bf - phi[qi]).max() < 1e-9
