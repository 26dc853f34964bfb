"""Toxicity, WARC archive, preference formatting and the pipeline."""

import collections
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
import nasty  # noqa: E402

from txlens.llm import preference, toxicity, warc  # noqa: E402
from txlens.llm.common import shared_path  # noqa: E402


def test_marginals_equal_enumeration():
    """Forward-backward over chains laid end to end against all label sequences of each chain."""
    import itertools
    rng = np.random.default_rng(1)
    for lengths in ([1], [3, 1, 4], [2] * 9, [7, 6]):
        n = sum(lengths)
        emit, trans, start = rng.normal(size=n) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
        first = np.zeros(n, bool)
        first[np.cumsum([0, *lengths[:-1]])] = True
        want, pair, at = [], np.zeros((2, 2)), 0
        for m in lengths:
            weight, p, q = 0.0, np.zeros(m), np.zeros((2, 2))
            for ys in itertools.product((0, 1), repeat=m):
                w = np.exp(start[ys[0]] + sum(trans[a, b] for a, b in zip(ys, ys[1:])) + sum(e for e, y in zip(emit[at:at + m], ys) if y))
                weight, p = weight + w, p + w * np.array(ys)
                for a, b in zip(ys, ys[1:]):
                    q[a, b] += w
            want, pair, at = [*want, *(p / weight)], pair + q / weight, at + m
        got, xi = toxicity.marginals(emit, first, trans, start, pairs=True)
        assert np.allclose(got, want) and np.allclose(xi, pair)


def _labelled(spark, n=240):
    r = random.Random(4)
    rows = []
    for i in range(n):
        w = nasty.prose(60, 1000 + i).split(" ")
        if i % 4 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vilewort", "Rottenius!", "grubbler"]))
        rows.append((i, " ".join(w), "a"))
    docs = nasty.docs(spark, rows)
    return docs, docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0).alias("toxic"))


def test_toxicity_finds_words_it_has_not_been_told(spark):
    docs, labels = _labelled(spark)
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    got = docs.select("doc_id", "text", model.result(F.col("text")).alias("r"), toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert any(r.h for r in got)
    for r in got:
        assert (r.r.score >= 0.5) == (r.doc_id % 4 == 0)
        words = {r.text[s.start:s.end] for s in r.r.spans}
        assert bool(words) == (r.doc_id % 4 == 0)
        for span in words:
            assert all(toxicity.normal(w) in ("vilewort", "rottenius", "grubbler") for w in span.split())
    # awkward rows, no rows, and labels of one kind alone
    odd = nasty.docs(spark).select("doc_id", "text", model.result(F.col("text")).alias("r")).collect()
    assert len(odd) == len(nasty.texts()) and all(0 <= r.r.score <= 1 for r in odd)
    assert all(r.r.spans == [] for r in odd if not r.text)
    assert nasty.docs(spark, []).select(model.result(F.col("text")).alias("r")).count() == 0
    clean = toxicity.fit(toxicity.training_rows(docs, labels.withColumn("toxic", F.lit(0))))
    assert docs.select(model.result(F.col("text"))["score"].alias("s"), clean.result(F.col("text"))["score"].alias("c")).where("c > 0.01").count() == 0
    empty = toxicity.fit(toxicity.training_rows(docs, labels.limit(0)))
    assert empty.score(["a", None, ""]).score.max() < 0.01


def test_toxicity_without_words_in_the_sample(spark):
    rows = [(i, " \t" if i % 2 else "", "a") for i in range(8)]
    docs = nasty.docs(spark, rows)
    model = toxicity.fit(docs.withColumn("toxic", F.when(F.col("doc_id") < 2, 1).otherwise(0)))
    scores = {r.s for r in nasty.docs(spark, [(1, "", "a"), (2, "some words", "a")]).select(model.result(F.col("text")).alias("f")).select(F.col("f.score").alias("s")).collect()}
    assert max(abs(s - 0.25) for s in scores) < 1e-6


def test_toxicity_scores_do_not_depend_on_batches(spark):
    docs, labels = _labelled(spark, 80)
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    texts = [t for _, t, _ in nasty.texts()] + [r.text for r in docs.select("text").collect()]
    whole = model.score(texts)
    alone = [model.score([t]).score[0] for t in texts]
    assert np.allclose(whole.score, alone)


def test_warc_archive(spark):
    big, small = "<p>" + "b" * 2000, "<p>s"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/\r\nX-Evil: 1", small), (5, "u", small), (6, "u", None),
            (7, "u", ""), (None, "n", big), (None, "n", "lone" * 400), (8, "é", "é" * 500), (9, "é", "é" * 499), (10, "é", "é" * 500),
            (11, "r", "rep" * 500), (11, "r", "rep" * 500), (12, "l", "x" * 300_000), (13, "p", "\r\nWARC-Type: fake\r\n" * 100)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, _id int")
    folder = shared_path(spark, "test-warc")
    warc.write_archive(pages, folder)
    got = warc.read_archive(spark, folder).collect()
    groups = collections.defaultdict(list)
    for i, _, t in rows:
        groups[(t or "").encode()].append(i)
    want = collections.Counter()
    for i, u, t in rows:
        data = (t or "").encode()
        top = max((x for x in groups[data] if x is not None), default=None)
        again = len(data) >= 1000 and top is not None and i != top
        want[(i, data, "revisit" if again else "response", top if again else None, hashlib.sha1(data).hexdigest())] += 1
    assert collections.Counter((r.page_id, bytes(r.payload), r.record_type, r.refers_to, r.payload_digest) for r in got) == want
    for r in got:
        head, record = bytes(r.header).decode(), bytes(r.record)
        assert head.startswith("WARC/1.1\r\n") and "X-Evil" not in [line.split(":")[0] for line in head.split("\r\n")]
        warc_head, rest = record.split(b"\r\n\r\n", 1)
        length = int(next(x for x in warc_head.split(b"\r\n") if x.startswith(b"Content-Length"))[15:])
        assert len(rest) == length
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == len(groups)
    nothing = shared_path(spark, "test-warc")
    warc.write_archive(pages.limit(0), nothing)
    assert warc.read_archive(spark, nothing).count() == 0


def test_warc_archive_refuses_damage(spark):
    folder = shared_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string"), folder)
    spark.createDataFrame([(hashlib.sha256(b"payload").hexdigest(), bytearray(b"paYload"))], "digest string, payload binary") \
        .write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="does not hash"):
        warc.read_archive(spark, folder).collect()


def _format(chosen, rejected):
    """Plain version of the formatter for one pair of turn lists."""
    def show(turns):
        return "".join(f"<|start|>{r}\n{t}<|end|>\n" for r, t in turns)
    k = 0
    while k < min(len(chosen), len(rejected)) and chosen[k] == rejected[k]:
        k += 1
    def spans(turns):
        out, at = [], 0
        for r, t in turns:
            begin = at + len(f"<|start|>{r}\n")
            at = begin + len(f"{t}<|end|>\n")
            if r == "assistant":
                out.append((begin, at))
        return out
    return k, show(chosen[:k]), show(chosen[k:]), show(rejected[k:]), spans(chosen[k:]), spans(rejected[k:]), not chosen[k:] and not rejected[k:]


def test_preferences_match_a_plain_version(spark):
    r = random.Random(8)
    sides = {}
    for p in range(60):
        base = [(r.choice(["user", "assistant", "system", ""]), r.choice(["", "hi", "é 日本", "same", "x" * 3000])) for _ in range(r.randint(1, 6))]
        other = [(a, b if r.random() < 0.8 else "else") for a, b in base[:r.randint(1, 6)]]
        sides[p] = (base, other)
    rows = [(p, s == 0, n, a, b, 1, "h") for p, both in sides.items() for s, turns in enumerate(both) for n, (a, b) in enumerate(turns)]
    rows += [(900, True, 0, "user", "alone", 1, "h"), (None, True, 0, "user", "x", 1, "h"), (None, False, 0, "user", "x", 1, "h"), (901, None, 0, "user", "x", 1, "h"),
             (902, True, None, None, None, 1, "h"), (902, False, None, None, None, 1, "h"), (903, True, 1, "user", "tie b", 1, "h"), (903, True, 1, "user", "tie a", 1, "h"),
             (903, False, 1, "user", "tie a", 1, "h"), (903, False, 1, "user", "tie a", 1, "h")]
    sides[902], sides[903] = ([("", "")], [("", "")]), ([("user", "tie a"), ("user", "tie b")], [("user", "tie a"), ("user", "tie a")])
    df = spark.createDataFrame(rows, "pair_id long, chosen boolean, turn long, role string, text string, k int, head string").repartition(5)
    got = {x.pair_id: (x.n_common, x.prompt, x.chosen, x.rejected, [tuple(s) for s in x.chosen_spans], [tuple(s) for s in x.rejected_spans], x.tied)
           for x in preference.format_preferences(df).collect()}
    assert got == {p: _format(*both) for p, both in sides.items()}
    assert preference.format_preferences(df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain version of its decision, on the stage's own input."""
    import corpus_pipeline
    docs, labels = _labelled(spark, 120)
    extra = [(1000 + i, t, s) for i, (_, t, s) in enumerate(nasty.texts())] + [(5000, None, None), (5001, "", "a")]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.unionByName(nasty.docs(spark, extra)).select(columns).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or now.columns == columns
        kept.append(now.collect())
    assert {r.doc_id for r in kept[0]} == {i for i in range(120) if i % 4} | {i for i, _, _ in extra}
    texts = collections.defaultdict(list)
    for r in kept[0]:
        texts[r.text or ""].append(r.doc_id)
    assert sorted(r.doc_id for r in kept[1]) == sorted(max(g) for g in texts.values())
    sys.path.insert(0, str(Path(__file__).parent))
    from test_documents import _links
    component = _links([(r.doc_id, r.text) for r in kept[1]], width=5, percent=80)
    assert sorted(r.doc_id for r in kept[2]) == sorted(i for i, (_, c) in component.items() if i == c)
    counts = collections.Counter(r.doc_id for r in kept[3])
    assert set(counts) <= {r.doc_id for r in kept[2]} and max(counts.values()) <= 3
    pieces = collections.Counter(r.doc_id for r in kept[4] if r.piece == 0)
    assert pieces == counts


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
