"""Operators on whole documents against brute force, on awkward rows and on empty tables."""

import collections
import hashlib
import random
import re
import struct
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import nasty  # noqa: E402

from txlens.llm import exact_dedup, imatch, jaccard_join, mixing, packing, records, secret_scan  # noqa: E402
from txlens.llm.common import shared_path, with_rank  # noqa: E402
from txlens.llm.tokens import default_tokenizer_path  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return nasty.docs(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return nasty.docs(spark, [])


def _ids(text):
    from tokenizers import Tokenizer
    t = _ids.__dict__.setdefault("t", Tokenizer.from_file(default_tokenizer_path()))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def _crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_exact_dedup_matches_brute_force(spark, docs, none):
    rows = nasty.texts()
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    top = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    got = exact_dedup.refine(docs, prefix_chars=4, hash_all=True).collect()
    want = collections.Counter((i, top[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.full_hash) for r in got) == want
    kept = collections.Counter(r.full_hash for r in got if r.kept)
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((t, str(i)) for i, t in left.select("doc_id", "text").na.fill("").collect()) == sorted((t, str(i)) for t, i in top.items())
    assert exact_dedup.refine(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_exact_dedup_by_shuffle(spark, docs, monkeypatch):
    want = sorted(map(str, exact_dedup.refine(docs).drop("full_hash", "kept").collect()))
    monkeypatch.setattr(exact_dedup, "fits_broadcast", lambda *a: False)
    assert sorted(map(str, exact_dedup.refine(docs).drop("full_hash", "kept").collect())) == want
    texts = {t or "" for _, t, _ in nasty.texts()}
    left = exact_dedup.drop_copies(docs).select(F.coalesce("text", F.lit("")).alias("t")).collect()
    assert len(left) == len(texts) and {r.t for r in left} == texts


@pytest.mark.parametrize("small", [True, False])
def test_full_content_is_read_for_survivors_alone(spark, monkeypatch, small):
    """Whatever the number of surviving keys: by the key table, or by a bitmap of fixed size (a few others may pass that)."""
    monkeypatch.setattr(exact_dedup, "fits_broadcast", lambda *_: small)
    rows = spark.range(5000).select((F.col("id") % 997).alias("_len"), F.xxhash64("id").alias("_prefix"), F.col("id").cast("string").alias("_text"))
    keys = rows.where(F.col("_text").cast("int") % 10 == 0).select("_len", "_prefix")
    got = exact_dedup._marked(rows.withColumn("number", F.col("_text").cast("int")), keys, ["_len", "_prefix"], 32, {"_sha": F.sha2("_text", 256)}).collect()
    assert len(got) == 5000 and all(r._in == (r.number % 10 == 0) for r in got)
    assert all(r._sha == hashlib.sha256(str(r.number).encode()).hexdigest() for r in got if r._in)
    assert sum(r._sha is not None for r in got) <= 500 + (0 if small else 20)


def _links(rows, width=4, percent=85):
    sets = {}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_join_matches_brute_force(spark, docs, none):
    got = jaccard_join.jaccard_components(docs).collect()
    want = _links([(i, t) for i, t, _ in nasty.texts() if i is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert len({c for _, c in want.values()}) < len(want) - 5
    assert len(got) == len(nasty.texts())
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert jaccard_join.jaccard_components(none).count() == 0


def test_jaccard_join_with_hot_blocks(spark, monkeypatch):
    """A family larger than HOT, and unrelated documents around one shared passage, lose no link."""
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    base, passage = nasty.prose(80, 1), nasty.prose(60, 2)
    rows = [(i, nasty.edited(base, 0.01 + 0.012 * (i % 4), i), "a") for i in range(24)]
    rows += [(100 + i, passage + " " + nasty.prose(5 + i, 50 + i), "a") for i in range(24)]
    got = jaccard_join.jaccard_components(nasty.docs(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _links([(i, t) for i, t, _ in rows])


def test_jaccard_join_by_shuffle_alone(spark, docs, monkeypatch):
    """With every size limit at 0, as for tables too large to broadcast."""
    from txlens.llm import common
    monkeypatch.setattr(common, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(jaccard_join, "fits_broadcast", lambda *_: False)
    got = jaccard_join.jaccard_components(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == _links([(i, t) for i, t, _ in nasty.texts() if i is not None])


@pytest.mark.parametrize("outsiders", [1, 4])
def test_jaccard_join_with_an_outsider_in_a_hot_key(spark, monkeypatch, outsiders):
    """A family of copies and documents that hold most, but not enough, of its text: no pairs inside the family."""
    monkeypatch.setattr(jaccard_join, "HOT", 10_000)  # every key takes part
    base = nasty.prose(300, 5)
    family = [nasty.edited(base, 0.004, i) for i in range(90)]
    rows = [(i, t, "a") for i, t in enumerate(family)]
    rows += [(500 + i, base + " " + nasty.prose(62 + i, 70 + i), "a") for i in range(outsiders)]
    sizes = collections.Counter()
    plain = jaccard_join.stage

    def counted(df, label):
        out = plain(df, label)
        sizes[label] = max(sizes[label], out.count())
        return out
    monkeypatch.setattr(jaccard_join, "stage", counted)
    got = jaccard_join.jaccard_components(nasty.docs(spark, rows)).collect()
    want = _links([(i, t) for i, t, _ in rows])
    assert len({c for _, c in want.values()}) == 1 + outsiders
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert sizes["jaccard-rest"] <= outsiders * (90 + outsiders) and sizes["jaccard-pairs"] < 90 * 89 / 4


@pytest.mark.parametrize("broadcast", [True, False])
def test_jaccard_join_builds_sets_of_likely_pairs_alone(spark, monkeypatch, broadcast):
    """Texts that share a passage, and so blocks, but are far from linked: their sketches tell, and their sets are not built."""
    passage = nasty.prose(60, 3)
    rows = [(i, passage + " " + nasty.prose(60, 300 + i), "a") for i in range(40)]
    rows += [(100 + i, nasty.edited(rows[i][1], 0.01, i), "a") for i in range(3)]
    sizes = collections.Counter()
    plain, fits = jaccard_join.stage, jaccard_join.fits_broadcast

    def counted(df, label):
        out = plain(df, label)
        sizes[label] = max(sizes[label], out.count())
        return out
    monkeypatch.setattr(jaccard_join, "stage", counted)
    monkeypatch.setattr(jaccard_join, "fits_broadcast", lambda *a: broadcast and fits(*a))
    got = jaccard_join.jaccard_components(nasty.docs(spark, rows)).collect()
    want = _links([(i, t) for i, t, _ in rows])
    assert sorted(c for i, (_, c) in want.items() if i >= 100) == [0, 1, 2]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert sizes["jaccard-groups"] > 100 and sizes["jaccard-full"] <= 10


def test_jaccard_join_keeps_hot_keys_that_bring_pairs_together(spark, monkeypatch):
    """A family larger than HOT: its keys in the band below, where no set is the smaller one of a pair, and as many hot keys of each set as spare blocks stay out."""
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    base = nasty.prose(140, 8)
    rows = [(i, nasty.edited(base, 0.01 + 0.012 * (i % 3), 40 + i), "a") for i in range(24)]
    seen = {}
    plain = jaccard_join.stage

    def kept(df, label):
        seen[label] = plain(df, label)
        return seen[label]
    monkeypatch.setattr(jaccard_join, "stage", kept)
    got = jaccard_join.jaccard_components(nasty.docs(spark, rows)).collect()
    want = _links([(i, t) for i, t, _ in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < 24
    bands = {jaccard_join.band_of(n) for n, _ in want.values()}
    assert len(bands) == 1 and seen["jaccard-texts"].select("band").distinct().count() == 2
    assert {r.band for r in seen["jaccard-members"].select("band").distinct().collect()} == bands
    spare = jaccard_join.blocks_of(bands.pop())[1]
    before = collections.Counter(r.u for r in seen["jaccard-members"].collect() if r.c > 3)
    empty = {r.u: r.empty for r in seen["jaccard-members"].collect()}
    cool = collections.Counter(r.u for r in seen["jaccard-members"].collect() if r.c <= 3)
    after = collections.Counter(r.u for r in seen["jaccard-groups"].collect())
    assert all(after[u] == cool[u] + before[u] - min(before[u], max(0, spare - empty[u])) for u in before)
    assert sum(after.values()) < sum(before.values()) + sum(cool.values())


@pytest.mark.parametrize("hot", [2, 32])
def test_jaccard_join_across_a_band_edge(spark, monkeypatch, hot):
    """Links between sets of different own bands, in hot keys and others; also of an id that repeats."""
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rows = []
    for f in range(3):
        words = nasty.prose(230, 900 + f).split(" ")
        rows += [(100 * f + i, nasty.edited(" ".join(words[:180 + 4 * i]), 0.006 * (i % 4), 7 * f + i), "a") for i in range(12)]
    rows.append(rows[3])
    got = jaccard_join.jaccard_components(nasty.docs(spark, rows)).collect()
    want = _links([(i, t) for i, t, _ in rows])
    assert len({jaccard_join.band_of(n) for n, _ in want.values()}) == 2
    assert len(got) == len(rows) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_sketch_bounds():
    """Blocks that differ, and the narrow sketch's Hamming distance, never exceed the symmetric difference."""
    import numpy as np
    rng = np.random.default_rng(3)
    for n in (1, 3, 7, 40, 333):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = max(0, int(0.05 * n))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop).astype(np.uint64)]))
        differ = len(np.setxor1d(a, b))
        one = {s[0]: s for s in jaccard_join.sketch(a)}
        two = {s[0]: s for s in jaccard_join.sketch(b)}
        assert one.keys() & two.keys()
        for band in one.keys() & two.keys():
            blocks, z, _ = jaccard_join.blocks_of(band)
            assert len(set(one[band][3]) & set(two[band][3])) + min(one[band][1], two[band][1]) >= blocks - differ > z
            assert sum(int(x).bit_count() for x in (one[band][4] ^ two[band][4]).view(np.uint64)) <= differ


def test_imatch_matches_brute_force(spark, docs, none):
    got = imatch.edited_fingerprints(docs).collect()
    rows = nasty.texts()
    assert len(got) == len(rows)
    order = sorted({(i, t or "") for i, t, _ in rows if i is not None}, reverse=True)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for (i, t), (_, after) in zip(order, order[1:]):
        k = len(t) // 3
        assert by_id[i].n_chars == len(t)
        assert by_id[i].edited_sha256 == hashlib.sha256((t[:len(t) - k] + after[:k]).encode()).hexdigest()
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[r.doc_id] = r.fingerprint
    assert prints[4] == prints[5] and prints[20] == prints[21] and prints[20] != prints[26]
    assert by_id[21].near_next == 1.0  # the next document is its exact copy
    assert imatch.edited_fingerprints(none).count() == 0
    one = imatch.edited_fingerprints(nasty.docs(spark, [(1, "abcdef", "a")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def _xx(*parts):
    """Spark's xxhash64 of strings, longs (int) and small constants (in a 1-tuple), as a signed number."""
    import xxhash
    h = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else struct.pack("<i", p[0]) if isinstance(p, tuple) else struct.pack("<q", p)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def _print_of(text, lexicon):
    terms = sorted({_xx(w) for w in re.split("[\x20\x09-\x0D]+", text.lower()) if w})
    n = imatch.SUBSETS * imatch.LEVELS
    ours, every = [0] * n, [0] * n
    for t in terms:
        place, half = _xx(t, (1,)), _xx(t, (2,)) & 0x7FFFFFFF
        for lv in range(imatch.LEVELS):
            j = place & (imatch.SUBSETS * 4 ** lv - 1)
            if j < imatch.SUBSETS:
                every[lv * imatch.SUBSETS + j] ^= half
                ours[lv * imatch.SUBSETS + j] ^= half if t in lexicon else 0
    known = sum(t in lexicon for t in terms)
    if known < imatch.FEW_TERMS or known < imatch.LEAST_KNOWN * len(terms):
        ours = [0] * n
    return _xx(*terms) & (1 << 64) - 1, ours, every


def _alike(a, b):
    if a[0] == b[0]:
        return 1.0
    one, two = (a[1], b[1]) if any(a[1]) and any(b[1]) else (a[2], b[2])
    pairs = [x == y if x or y else None for x, y in zip(one, two)]
    levels = [[x for x in pairs[k:k + imatch.SUBSETS] if x is not None] for k in range(0, len(pairs), imatch.SUBSETS)]
    good = [sum(x) / len(x) for x in levels if len(x) >= imatch.MIN_INFORMED]
    rest = [x for x in pairs if x is not None]
    return max(good) if good else sum(rest) / len(rest) if rest else 0.0


@pytest.mark.parametrize("limit", [None, 0])
def test_imatch_fingerprints_equal_brute_force(spark, docs, monkeypatch, limit):
    """``fingerprint``, ``near_edited`` and ``near_next`` of every row, the fallback to all terms included."""
    if limit is not None:
        monkeypatch.setattr(imatch, "fits_broadcast", lambda *_: False)
    rows = sorted({(i is None, -(i or 0), _xx(t or ""), t or "") for i, t, _ in nasty.texts()})
    texts = [t for *_, t in rows]
    df = collections.Counter(x for t in set(texts) for x in {_xx(w) for w in re.split("[\x20\x09-\x0D]+", t.lower()) if w})
    least, most = 0.02, 0.95
    n = len(set(texts))
    lexicon = {x for x, c in df.items() if max(2.0, least * n) <= c <= max(2.0, most * n)}
    want = {}
    for (null, minus, _, t), after in zip(rows, texts[1:] + texts[:1]):
        k = len(t) // 3
        own, edited, nxt = (_print_of(x, lexicon) for x in (t, t[:len(t) - k] + after[:k], after))
        said = "-".join([f"{own[0]:016x}", *["".join(f"{m:08x}" for m in half) for half in own[1:]]])
        want[None if null else -minus, len(t), said] = (_alike(own, edited), _alike(own, nxt))
    got = imatch.edited_fingerprints(docs, least=least, most=most).collect()
    assert {(r.doc_id, r.n_chars, r.fingerprint) for r in got} == set(want)
    assert any(any(_print_of(t, lexicon)[1]) for t in texts) and any(not any(_print_of(t, lexicon)[1]) for t in texts if t)
    for r in got:
        assert (r.near_edited, r.near_next) == pytest.approx(want[r.doc_id, r.n_chars, r.fingerprint])


def test_imatch_in_a_family_that_holds_a_third_of_the_rows(spark):
    """Near copies, and exact copies, of one text make its terms frequent; its likenesses stay."""
    base = " ".join(f"base{k}" for k in range(300))
    shared = [f"word{k}" for k in range(400)]
    pick = lambda i: " ".join(random.Random(i).sample(shared, 15) + [f"own{i}x{k}" for k in range(5)])
    other = [(2 * i, pick(i), "a") for i in range(200)]
    for family in ([base.replace("base299", f"end{i}", 1) for i in range(100)], [base] * 100,
                   [nasty.edited(base, 0.05, i).replace("edit", "word0") + " " + " ".join(shared[i:i + 12]) for i in range(100)]):
        rows = other + [(2 * (i % 50) + 1 + 400 * (i // 50), t, "a") for i, t in enumerate(family)]
        got = {r.doc_id: r for r in imatch.edited_fingerprints(nasty.docs(spark, rows)).collect()}
        ours = [got[i] for i, _, _ in rows if i % 2]
        assert min(r.near_edited for r in ours) > 0.1
        inside = [r.near_next for r in ours if r.doc_id > 401]
        assert len(inside) == 49 and min(inside) > 0.3
        assert max(r.near_next for r in ours if r.doc_id < 100) < 0.1  # a document of another kind


def test_imatch_counts_copies_once(spark):
    rows = [(i, "copied text here", "a") for i in range(60)] + [(100 + i, f"copied plus{i}", "a") for i in range(1)]
    rows += [(200 + i, f"text{i} shared{i // 2}", "a") for i in range(59)]
    rows += [(None, None, "a"), (301, "", "a")]
    word = lambda w: spark.range(1).select(imatch.terms(F.lit(w)).alias("t")).first().t[0]
    kept = {r.term for r in imatch.lexicon(nasty.docs(spark, rows)).collect()}
    assert kept == {word(w) for w in ["copied"] + [f"shared{k}" for k in range(29)]}


def test_imatch_runs_no_python(docs):
    plan = imatch.edited_fingerprints(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def _base_spans(text):
    rules = [("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
             ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]
    out = []
    for k, (kind, p, g, least) in enumerate(rules):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(p, text) if len(m.group(g)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def test_secret_scan_matches_regular_expressions(spark):
    import random
    rng = random.Random(5)
    parts = ["token", "Secret", "api_key", "apikey", "passwd", "PASSWORD", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH01", "0123456789abcdef",
             "deadbeef", "é", "日本", "-", "abcdefghijkl", "\n", "==", "AKIAAKIA", "ghp_" + "a1" * 20, "xoxb-1234567890ab"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 14))), "a") for i in range(1500)]
    rows += [(9001, None, "a"), (9002, "", None), (9003, "token=" + "x" * 100_000, "a"), (None, "secret:abcdefghijklmnop", "a"), (9004, "secret:abcdefghijklmnop", "a")]
    docs = nasty.docs(spark, rows)
    got = secret_scan.with_spans(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        base = [(s["kind"], s["start"], s["end"]) for s in r.spans if s["kind"] in secret_scan.BASE_KINDS]
        assert base == _base_spans(r.text or ""), r.text
    assert any(s["kind"] == "github" for r in got for s in r.spans)
    hidden = {r.doc_id: r.text for r in secret_scan.redact(docs.where("doc_id in (9003, 9004, 9002) or doc_id < 40")).collect()}
    assert hidden[9003] == "[SECRET]" and hidden[9002] == "" and not any(_base_spans(t) for t in hidden.values() if t)
    assert secret_scan.with_spans(nasty.docs(spark, [])).count() == 0


def test_token_records_round_trip(spark, docs, none):
    folder = shared_path(spark, "test-records")
    manifest = records.write_token_records(docs, folder)
    rows = sorted(((i, t or "") for i, t, _ in nasty.texts()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = records.read_token_records(spark, folder, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    want = collections.Counter((i, len(_ids(t)), _crc(_ids(t))) for i, t in rows)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    mixed = records.read_shuffled(spark, folder, seed=3).collect()
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in mixed) == collections.Counter((r.doc_id, tuple(r.ids)) for r in got)
    assert [r.doc_id for r in sorted(mixed, key=lambda r: r.order)] != [r.doc_id for r in got]
    empty = shared_path(spark, "test-records")
    records.write_token_records(none, empty)
    assert records.read_token_records(spark, empty).count() == 0


def test_records_refuse_ids_that_do_not_fit(spark, docs):
    folder = shared_path(spark, "test-records")
    with pytest.raises(Exception, match="needs wide=True"):
        records.write_token_records(docs, folder, end_id=70_000)
    wide = shared_path(spark, "test-records")
    records.write_token_records(docs, wide, end_id=70_000, wide=True)
    assert all(r.ids[-1] == 70_000 for r in records.read_token_records(spark, wide, wide=True, with_ids=True).collect())


def test_records_refuse_damage():
    import io
    whole = records.frame(b"abc")
    assert records.unframe(io.BytesIO(whole)) == b"abc"
    for at in range(len(whole)):
        broken = bytearray(whole)
        broken[at] ^= 1
        with pytest.raises((ValueError, OverflowError, MemoryError)):
            records.unframe(io.BytesIO(bytes(broken)))
    with pytest.raises(ValueError):
        records.unframe(io.BytesIO(whole[:-1]))


def test_packing(spark, docs, none):
    got = packing.pack_documents(docs, capacity=256, block=40).collect()
    whole = collections.Counter()
    for i, t, _ in nasty.texts():
        ids = _ids(t)
        bounds = [0, *range((len(ids) - 1) % 256 + 1, len(ids) + 1, 256)]
        whole.update((i, k, a, b - a, _crc(ids[a:b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:])))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == whole
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 256) + 2
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("sizes,most", [([34, 33, 35, 40] * 150, 302), ([60] * 70 + [1] * 50, 71), ([1] * 900, 10), ([7] * 5, 1)])
def test_packing_where_few_bins_fill(spark, monkeypatch, sizes, most):
    """Bins of two or three thirds never fill up: blocks close but for one bin each, which go on until one block is left."""
    monkeypatch.setattr(packing, "LEVELS", 2)
    monkeypatch.setattr(packing, "LEAST_BINS", 3)
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long").repartition(3)
    got = packing.pack(pieces, capacity=100, block=16).collect()
    assert sorted(r.uid for r in got) == list(range(len(sizes)))
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, sizes[r.uid]))
    for b in bins.values():
        ends = [0]
        for offset, n in sorted(b):
            assert offset == ends[-1]
            ends.append(offset + n)
        assert ends[-1] <= 100
    assert len(bins) <= most


def test_packing_of_a_table_with_an_id_column_named_uid(spark, docs):
    renamed = docs.drop("u", "k").withColumnRenamed("doc_id", "uid").drop("row")
    assert packing.pack_documents(renamed, id_col="uid", capacity=256).columns[0] == "uid"


def test_packing_crossover_keeps_every_piece():
    import random
    rng = random.Random(2)
    sizes = [rng.randint(1, 99) for _ in range(300)]
    people = packing.found(sizes, 100, rng, 4)
    for _ in range(20):
        child = packing.cross(*rng.sample(people, 2), rng)
        assert sorted(p for b in child.bins for p in b) == list(range(300))
        assert all(sum(sizes[p] for p in b) + r == 100 for b, r in zip(child.bins, child.room))
    first = max(map(packing.Bins.fitness, people))
    assert packing.evolve(people, rng, 10, 4)[0].fitness() >= first


def test_mixing(spark, docs, none):
    got = mixing.mix(docs).collect()
    rows = nasty.texts()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert collections.Counter((r.doc_id, r.source, r.size) for r in got) == collections.Counter((i, s, size(t)) for i, t, s in rows)
    total = collections.Counter()
    for _, t, s in rows:
        total[s] += size(t)
    order = sorted((s for s in total if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(total.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
        free -= over
    taken = collections.Counter()
    for r in got:
        assert r.source_size == total[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s in order:
        # The nearest sum that whole copies, 0 to 3 of each text, can reach: bit k is set if k words can be taken.
        reach = 1
        for _, t, x in rows:
            if x == s:
                for _ in range(3):
                    reach |= reach << size(t)
        best = min(abs(k - target[s]) for k, bit in enumerate(bin(reach)[:1:-1]) if bit == "1")
        assert abs(taken[s] - target[s]) <= best + max(60, 0.03 * target[s])
    again = collections.Counter(map(str, mixing.mix(docs).collect()))
    assert again == collections.Counter(map(str, got))
    assert mixing.mix(none).count() == 0
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in got if r.doc_id not in (None, 10)}
    seen = collections.Counter(r.doc_id for r in out.select("doc_id").collect())
    assert all(seen[i] == c for i, c in copies.items())


def test_mixing_splits_a_hot_size(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    got = mixing.mix(nasty.docs(spark, [(i, "same size", "a" if i < 90 else "b") for i in range(100)])).collect()
    for s in "ab":
        rows = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
        assert max(r.copies for r in rows) - min(r.copies for r in rows) <= 1


def test_global_rank(spark):
    df = spark.createDataFrame([(i % 17,) for i in range(200)], "x int")
    got = with_rank(df, [df["x"].desc()], "test-rank").orderBy("_rank").collect()
    assert [r["_rank"] for r in got] == list(range(200))
    assert [r.x for r in got] == sorted((i % 17 for i in range(200)), reverse=True)


def test_balance_with_moments_that_couple_the_sources(spark):
    """Targets and shares are met, and the rates have the one form that the entropy's minimum has."""
    import math
    r = random.Random(12)
    rows = [(i, nasty.prose(r.randrange(5, 60), i), r.choice(["en", "de", "fr", None]), r.choice(["a", "b", "c", None]), 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    sources = mixing._rows(docs, "doc_id", "text", "source").groupBy("_none", "_source").agg(F.sum("_size").alias("_total"))
    goals = mixing.targets(sources)
    rates, mu = mixing.balance(docs, goals, {"lang": {"en": 0.5, "de": 0.2, "none such": 0.1}})
    got = rates.collect()
    target = {(x._none, x._source): x._target for x in goals.collect()}
    tokens = lambda x: x._n * x._size * x._rate
    for key, goal in target.items():
        assert sum(tokens(x) for x in got if (x._none, x._source) == key) == pytest.approx(goal, rel=1e-6)
    whole = sum(target.values())
    for i, share in enumerate((0.5, 0.2)):
        assert sum(tokens(x) for x in got if x._values[i]) == pytest.approx(share * whole, rel=1e-6)
    for key in target:  # log rate = lambda of the source + mu of the language
        lam = {round(math.log(x._rate) - sum(m for m, v in zip(mu.values(), x._values) if v), 6) for x in got if (x._none, x._source) == key}
        assert len(lam) == 1
    assert mu["lang", "en"] != 0 and mu["lang", "none such"] == 0
    alone, none = mixing.balance(docs, goals, {})
    assert none == {} and {(x._none, x._source): round(x._rate, 6) for x in alone.collect()} == {
        k: round(g / sum(x._n * x._size for x in got if (x._none, x._source) == k), 6) for k, g in target.items()}
    with pytest.raises(ValueError):
        mixing.balance(docs, goals, {"lang": {"en": 0.9, "de": 0.9}}, rounds=8)
    empty, _ = mixing.balance(docs.limit(0), mixing.targets(sources.limit(0)), {"lang": {"en": 0.5}})
    assert empty.count() == 0
