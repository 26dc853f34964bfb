"""Hard negatives, conversation trie and license scans against brute force."""

import collections
import hashlib
import math
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import nasty  # noqa: E402

from txlens.llm import common, hard_negatives, licenses, trie  # noqa: E402


@pytest.mark.parametrize("width,most", [(1, 3), (64, 256), (300, 1000), (700, 30_000)])
def test_residue_scores_are_exact(width, most):
    rng = np.random.default_rng(width)
    a, b = rng.integers(-most, most + 1, (7, width)), rng.integers(-most, most + 1, (9, width))
    bound = int(max((a ** 2).sum(1).max(), (b ** 2).sum(1).max()))
    primes = hard_negatives.primes_for(bound, width)
    assert len(set(primes)) == len(primes) and math.prod(primes) > 2 * bound + 1
    assert all((p // 2) ** 2 * min(width, hard_negatives.CHUNK) <= 1 << 24 for p in primes)
    got = hard_negatives.scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
    assert (got == a @ b.T).all()


def _vectors():
    r = random.Random(3)
    out = [(i, r.randrange(4), [r.gauss(0, 0.2) + (0.3 if j == i % 4 else 0) for j in range(6)]) for i in range(400)]
    same = [0.5, 0.25, 0.0, 0.0, 0.0, 0.125]
    out += [(1000 + i, i % 2, same) for i in range(150)]                            # ties, a hot vector
    out += [(1000, 0, same), (1050, 1, same), (1050, 1, same)]                      # repeated ids
    out += [(2000, None, same), (2050, 1, None), (2100, 1, [float("nan")] * 6), (2150, 1, [1.0, float("inf")]), (2200, 1, [None, 1.0]),
            (None, 1, same), (2250, 1, []), (2300, 1, [2.0, -1.0]), (2350, 9, same), (-50, 1, [-0.5, -0.5])]
    return out


def _mined(rows):
    kept = [(i, label, np.floor(256 * np.array(v, float)).astype(int).tolist()) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, label, q in kept:
        if anchor % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, other) for i, other, p in kept)
        for ps, positive, _ in [x for x in scored if x[2] == label and x[1] != anchor][:5]:
            window = [(i, -s) for s, i, other in scored if other != label and 50 * -ps <= 100 * -s <= 95 * -ps]
            out += [(anchor, positive, k + 1, i, -ps, s) for k, (i, s) in enumerate(window[:3])]
    return out


def _embeddings(spark, rows):
    return spark.createDataFrame([(i, v, label, 1.5, 2, 3) for i, label, v in rows],
                                 "vec_id long, embedding array<float>, label int, score double, anchor long, place int").repartition(5)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rows = [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in _vectors()]
    want = collections.Counter(_mined(rows))
    assert len(want) > 100
    for cells, batch in ((1 << 23, 13), (300, 13)):
        monkeypatch.setattr(hard_negatives, "RUN_CELLS", cells)
        monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 4)
        got = collections.Counter(map(tuple, hard_negatives.mine(hard_negatives.quantised(_embeddings(spark, rows))).collect()))
        assert got == want
    assert hard_negatives.mine(hard_negatives.quantised(_embeddings(spark, []))).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(hard_negatives.quantised(_embeddings(spark, [(0, 1, [1e30])])))


def _conversations():
    r = random.Random(5)
    out = []
    for c in [*range(0, 40), *range(100, 130), 200, 205, 377, -3, -100, -104]:
        for t in range(r.choice([1, 1, 2, 3, 4, 6, 9, 17])):
            out.append((c, t, r.choice(["user", "bot", None]), r.choice(["hi", "yes é", "", None, "no"])))
    for c, n in ((700, 300), (703, 300), (704, 299), (705, 200), (706, 128), (707, 129), (708, 16), (709, 8), (800, 2100), (801, 2100)):
        out += [(c, t, "user", f"turn {t}" if t != 250 or c != 703 else "other") for t in range(n)]
    out += [(900, None, "user", "a"), (900, 1, "user", "b"), (901, 5, "user", "late"), (None, 1, "user", "lost")]
    return out


def _trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:]
    assert any(not p for p in built.values())
    # Prefixes by an id each, as whole tuples of long conversations would not fit.
    ids, members, length, chars, parent = {}, collections.defaultdict(list), {}, {}, {}
    for c, p in built.items():
        at = ids.setdefault(None, 0)
        length[at], chars[at], parent[at] = 0, 0, None
        members[at].append(c)
        for d, turn in enumerate(p, 1):
            up, at = at, ids.setdefault((at, turn), len(ids))
            length[at], chars[at], parent[at] = d, len(turn[1]), up
            members[at].append(c)
    kids = collections.Counter(parent.values())
    leaves, saved = collections.Counter(), collections.Counter()
    for at in sorted(members, key=lambda x: -length[x]):
        leaves[at] += 0 if kids[at] else 1
        saved[at] += (len(members[at]) - 1) * chars[at]
        if parent[at] is not None:
            leaves[parent[at]] += leaves[at]
            saved[parent[at]] += saved[at]
    return {(min(m), length[at], None if parent[at] is None else min(members[parent[at]]), len(m), kids[at], leaves[at], saved[at],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == length[at]))).encode()).hexdigest()) for at, m in members.items()}


def _turns(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, "n", 3, "i") for x in rows],
                                 "conv_id long, turn int, role string, text string, pos long, block long, node string, len long, id string").repartition(5)


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_trie_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(trie, "PART", 3)  # many parts to a digest
    monkeypatch.setattr(common.fits_broadcast, "__defaults__", (limit,))
    rows = _conversations()
    rows += [(5000 + i, 0, "user", "same") for i in range(60)]  # copies
    got = trie.prefix_trie(trie.with_shared_heads(trie.turns(_turns(spark, rows)))).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == _trie(rows)


def test_trie_of_no_conversations_and_of_tied_turns(spark):
    assert trie.prefix_trie(trie.with_shared_heads(trie.turns(_turns(spark, [])))).count() == 0
    tied = [(c, 1, "user", x) for c in (1, 2) for x in (("a", "b", "c") if c == 1 else ("c", "a", "b"))]
    nodes = trie.prefix_trie(trie.turns(_turns(spark, tied))).collect()
    assert len(nodes) == 4 and all(n.n_convs == 2 for n in nodes)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def _licensed():
    mit = dict(licenses.NOTICES)["mit-text"]
    gpl = dict(licenses.NOTICES)["gpl-text"]
    r = random.Random(8)
    cut = mit.split()
    for i in r.sample(range(len(cut)), 12):
        cut[i] = "changed"
    out = ["The MIT  License, the mit-license; MIT\nLICENSE_mit license", "mit licenses", "license mit", "İ MIT License", "under the mit lıcense apache license x",
           "mit Kelvin K license", nasty.prose(300, 1) + " " + mit + " " + nasty.prose(300, 2), " ".join(cut), mit[:len(mit) // 2], nasty.prose(77, 3) + gpl.upper(),
           "general general public public license", "General\tPublic, License v3 general public license", "licensed cc by nc 4 0 under", "Licensed under CC BY-SA 4.0",
           "GENERAL PUBLIC " * 40 + "LICENSE", "x " * 7 + "mit license " * 3, "mit " * 50 + "license " * 50, "\x00mit\x01license\x7f"]
    return [(100 + i, t, "a") for i, t in enumerate(out)] + [(200 + i, out[6], "a") for i in range(40)] + nasty.texts()


def _license_results(text):
    w, names, labels, best = _words(text), [], set(), 0.0
    for label, name in licenses.NAMES:
        n = _words(name)
        names += [(i, label) for i in range(len(w)) if w[i:i + len(n)] == n]
    for label, notice in licenses.NOTICES:
        n = _words(notice)
        s, need = 2 ** math.ceil(math.log2(len(n))), len(set(n)) if len(set(n)) < licenses.WHOLE else math.ceil(len(set(n)) * licenses.NOTICE_SHARE - 1e-9)
        for a in range(0, len(w), s):
            common_words = len(set(n) & set(w[a:a + 2 * s]))
            if common_words >= need:
                labels.add(label)
                best = max(best, common_words / len(set(n)))
    base = {x for _, x in names}
    at = [i for i, _ in names]
    return len(w), len(at), min(at, default=None), max(at, default=None), sorted(base), sorted(base | labels), 1.0 if at else best


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_licenses_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(common.fits_broadcast, "__defaults__", (limit,))
    rows = _licensed()
    docs = nasty.docs(spark, rows).withColumn("license", F.lit("old")).withColumn("key", F.lit(1)).withColumn("word", F.lit(2))
    out = licenses.scan(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    got = collections.Counter((r.doc_id, r.text, *[tuple(x) if isinstance(x, list) else x for x in r.license]) for r in out.collect())
    want = collections.Counter((i, t, *[tuple(x) if isinstance(x, list) else x for x in _license_results(t)]) for i, t, _ in rows)
    assert got == want
    assert sum(1 for k in want if k[3]) > 8 and any("mit-text" in k[7] for k in want)


def test_licenses_of_no_documents_and_without_python(spark):
    none = nasty.docs(spark, [])
    assert licenses.scan(none).count() == 0
    plan = licenses.scan(nasty.docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
