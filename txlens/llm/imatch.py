"""I-Match fingerprints with randomised lexicons, in DataFrame operations only.

Terms are the distinct lower-cased words of a text, held as 64-bit hashes. The
lexicon keeps terms whose inverse document frequency, over distinct texts, lies in a
band; the band's upper end is a share of the texts, so the lexicon has at most (mean distinct
terms of a text / share) entries however many texts there are. A fingerprint is the
list of hashes of a text's distinct lexicon terms inside several random subsets of
the lexicon, ``SUBSETS`` at each of several rates: a long text agrees with an edited
one in sparse subsets, a short one in dense subsets. The same subsets are hashed over
all terms too: two texts are compared by these when the lexicon misses most of either,
as it does for a family of near copies whose terms are frequent by the family alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, stage, with_rank

MOST_SHARE = 0.05      # lowest inverse document frequency kept: ln(1 / 0.05)
LEAST_SHARE = 0.0005   # highest: ln(1 / 0.0005)
SUBSETS = 8
LEVELS = 5             # level l takes one term in 8 * 4^l into each of its subsets
FEW_TERMS = 10         # a text with fewer lexicon terms is compared by all its terms,
LEAST_KNOWN = 0.25     # and so is one whose lexicon terms are a smaller share of its terms
MIN_INFORMED = 4       # subsets of a level that must hold terms for the level to count


def terms(text: Column) -> Column:
    """Distinct hashed terms of a text, sorted; empty for null."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, text_col: str = "text", least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Staged ``term`` hashes whose document frequency is within the band, counted over all distinct texts.

    A term must occur in two texts at least. Texts are not shuffled: of those that have copies, the terms are, each
    once from a map task.
    """
    rows = docs.select(F.coalesce(text_col, F.lit("")).alias("_t")).select(F.xxhash64("_t").alias("_h"), "_t")
    hashes = stage(rows.groupBy("_h").agg(F.count(F.lit(1)).alias("times")), "imatch-texts")
    n = hashes.count()
    copied = stage(hashes.where("times > 1").select("_h"), "imatch-copied")
    few = F.broadcast(copied) if fits_broadcast(copied, 16) else copied
    once = rows.join(few, "_h", "left_anti").select(F.explode_outer(terms(F.col("_t"))).alias("term"))
    # Of copies only terms are aggregated, never texts: each (text, term) counts once.
    copies = rows.join(few, "_h", "left_semi").select("_h", terms(F.col("_t")).alias("_l")).select("_h", F.explode_outer("_l").alias("term"))
    every = once.unionByName(copies.distinct().select("term")).where(F.col("term").isNotNull())
    df = every.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = df.where((F.col("df") >= max(2.0, least * n)) & (F.col("df") <= max(2.0, most * n))).select("term")
    return stage(kept, "imatch-lexicon")


def fingerprint(texts: DataFrame, keys: list[str], text_col: str, lex: DataFrame) -> DataFrame:
    """``keys, whole, marks`` for rows that are unique by ``keys``.

    ``whole`` hashes all distinct terms; ``marks`` holds the subset hashes of the
    lexicon terms, level after level, then those of all terms, 0 for a subset without
    terms. The lexicon's half is 0 throughout for a text with fewer lexicon terms than
    ``FEW_TERMS`` or than a ``LEAST_KNOWN`` share of its terms. The hash of a subset's terms is
    the exclusive-or of the terms' own hashes, which needs no order, so no list of terms is
    gathered: each term adds to its subset of each level, to all terms' hash in
    the upper half of a long and to the lexicon's in the lower. Rows already dealt
    by (some of) ``keys`` are not shuffled for it.
    """
    # The hash of all terms is computed before they are dealt out: once a text, not once a term.
    found = texts.select(*keys, terms(F.col(text_col)).alias("_t")).select(*keys, "_t", F.xxhash64("_t").alias("whole"))
    found = found.select(*keys, "whole", F.explode_outer("_t").alias("term"))
    marked = lex.withColumn("_in", F.lit(True))
    rows = found.join(F.broadcast(marked) if fits_broadcast(lex, 16, 32 << 20) else marked, "term", "left")
    rows = rows.select(*keys, "whole", "term", "_in", F.when(F.col("term").isNotNull(), F.xxhash64("term", F.lit(1))).alias("_place"),
                       F.xxhash64("term", F.lit(2)).bitwiseAND(F.lit(0x7FFFFFFF)).alias("_half"))
    rows = rows.select(*keys, "whole", "term", "_in", F.col("_place").bitwiseAND(F.lit(SUBSETS - 1)).alias("_j"), F.shiftright("_place", 3).alias("_place"),
                       F.shiftleft("_half", 32).bitwiseOR(F.when(F.col("_in"), F.col("_half")).otherwise(F.lit(0).cast("long"))).alias("_hash"))
    # Level l deals the lexicon into 8 * 4^l parts and uses its first 8 as subsets: a term's number among
    # them is the low bits of its place at every level, so it is aggregated by that number, once per level.
    part = rows.groupBy(*keys, "whole", "_j").agg(
        F.count("_in").alias("_known"), F.count("term").alias("_size"),
        *[F.bit_xor(F.when(F.col("_place").bitwiseAND(F.lit(4 ** lv - 1)) == 0, F.col("_hash"))).alias(f"_l{lv}") for lv in range(LEVELS)])
    got = part.groupBy(*keys, "whole").agg(
        F.sum("_known").alias("_known"), F.sum("_size").alias("_size"),
        *[F.max(F.when(F.col("_j") == j, F.col(f"_l{lv}"))).alias(f"_s{lv * SUBSETS + j}") for lv in range(LEVELS) for j in range(SUBSETS)])
    known = (F.col("_known") >= FEW_TERMS) & (F.col("_known") >= LEAST_KNOWN * F.col("_size"))
    half = lambda c: F.coalesce(c.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"), F.lit(0))
    ours = [F.col(f"_s{i}") for i in range(SUBSETS * LEVELS)]
    return got.select(*keys, "whole", F.array(*[F.when(known, half(c)).otherwise(0) for c in ours], *[half(F.shiftright(c, 32)) for c in ours]).alias("marks"))


def shown(whole: str, marks: str) -> Column:
    """A fingerprint as text: 16 hex digits of all terms, then 8 for each subset of the lexicon terms, then 8 for each of all terms."""
    digits = lambda c, n: F.lower(F.lpad(F.hex(c), n, "0"))
    part = lambda k: F.array_join(F.transform(F.slice(marks, k * SUBSETS * LEVELS + 1, SUBSETS * LEVELS), lambda m: digits(m, 8)), "")
    return F.concat_ws("-", digits(F.col(whole), 16), part(0), part(1))


def likeness(whole1: str, marks1: str, whole2: str, marks2: str) -> Column:
    """0 to 1: the best share of equal subset hashes over the levels that inform.

    Subsets of the lexicon terms are compared if both texts have them, else those of all terms.
    A level counts its subsets that hold terms of either text, and informs with
    ``MIN_INFORMED`` of them; without such a level the share is over all
    subsets. Without any terms in subsets, equal term sets are alike (1), others not.
    """
    n = SUBSETS * LEVELS
    both = F.exists(F.slice(marks1, 1, n), lambda m: m != 0) & F.exists(F.slice(marks2, 1, n), lambda m: m != 0)
    half = lambda marks: F.slice(marks, F.when(both, 1).otherwise(n + 1), n)
    pairs = F.zip_with(half(marks1), half(marks2), lambda a, b: F.when((a == 0) & (b == 0), F.lit(None).cast("int")).otherwise((a == b).cast("int")))
    def share(part: Column, least: int) -> Column:
        known = F.filter(part, lambda x: x.isNotNull())
        return F.when(F.size(known) >= least, F.aggregate(known, F.lit(0), lambda acc, x: acc + x) / F.size(known))
    levels = [share(F.slice(pairs, lv * SUBSETS + 1, SUBSETS), MIN_INFORMED) for lv in range(LEVELS)]
    return F.when(F.col(whole1) == F.col(whole2), F.lit(1.0)).otherwise(
        F.coalesce(F.greatest(*levels), share(pairs, 1), F.lit(0.0)))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SHARE,
                        most: float = MOST_SHARE) -> DataFrame:
    """Fingerprints of every text and of its edited text, compared with each other and with the next document's.

    Columns ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The next document is the next one by descending id (after
    the last: the first; null ids last). The edited text has its last floor(n_chars / 3)
    code points replaced by the first as many of the next document's. Null texts
    are empty. Rows that repeat id and text share one place in the order and are
    all returned. A single row is its own next. Other columns are ignored.

    The text is shuffled once, by row, and a third of it again as the next
    documents' beginnings.
    """
    key = ["_i", "_null", "_h"]
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.coalesce(id_col, F.lit(0)).cast("long").alias("_i"), F.col(id_col).isNull().alias("_null"),
                       F.xxhash64(text).alias("_h"), text.alias("_text"))
    narrow = rows.groupBy(*key, F.char_length("_text").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("times"))
    narrow = with_rank(narrow, [F.col("_null"), F.col("_i").desc()], "imatch-order")
    narrow = stage(narrow, "imatch-rows")
    size = narrow.count()
    if narrow.where("times > 1").limit(1).count():
        rows = rows.dropDuplicates(key)
    after = narrow.select(*[F.col(c).alias(f"next{c}") for c in key], F.col("_rank").alias("_r"))
    order = narrow.withColumn("_r", (F.col("_rank") + 1) % max(size, 1)).join(after, "_r").drop("_r", "_rank")
    order = stage(order, "imatch-next")
    lex = lexicon(docs, text_col, least, most)

    give = order.select(*[F.col(f"next{c}").alias(c) for c in key], *[F.col(c).alias(f"to{c}") for c in key],
                        F.floor(F.col("n") / 3).cast("int").alias("_k"))
    heads = rows.join(give, key).select(*[F.col(f"to{c}").alias(c) for c in key], F.expr("left(_text, _k)").alias("_head"))
    both = rows.join(heads, key).withColumn("_edited", F.concat(
        F.expr("left(_text, cast(char_length(_text) - char_length(_text) div 3 as int))"), F.col("_head")))
    versions = both.select(*key, F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("_text").alias("t")),
                                                   F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")))).alias("e"))
    versions = versions.select(*key, F.col("e.v").alias("v"), F.col("e.t").alias("t"))
    marks = fingerprint(versions, [*key, "v"], "t", lex)
    pick = lambda v, c: F.max(F.when(F.col("v") == v, F.col(c)))
    marks = marks.groupBy(*key).agg(pick(0, "whole").alias("w0"), pick(0, "marks").alias("m0"), pick(1, "whole").alias("w1"), pick(1, "marks").alias("m1"))
    # One job for both, so that the text is dealt once.
    marks = stage(marks.join(both.select(*key, F.sha2("_edited", 256).alias("edited_sha256")), key), "imatch-marks")
    own = marks.select(*key, "w0", "m0")
    nxt = own.select(*[F.col(c).alias(f"next{c}") for c in key], F.col("w0").alias("w2"), F.col("m0").alias("m2"))
    out = order.join(marks, key).join(nxt, [f"next{c}" for c in key])
    out = out.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select(F.when(~F.col("_null"), F.col("_i")).alias(id_col), F.col("n").alias("n_chars"), "edited_sha256",
                      shown("w0", "m0").alias("fingerprint"), shown("w1", "m1").alias("edited_fingerprint"),
                      likeness("w0", "m0", "w1", "m1").alias("near_edited"), likeness("w0", "m0", "w2", "m2").alias("near_next"))
