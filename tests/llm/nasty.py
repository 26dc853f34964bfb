"""Small awkward inputs shared by the operator tests."""

import random

EXTRA = "u long, k long, _id string, _text string, _size long, keep_id long, copies int, score double, spans string, row string, component string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
WORDS = [a + b for a in ("al", "be", "co", "du", "en", "fi", "go", "hu", "in", "jo") for b in ("ra", "sta", "mor", "n", "lop", "quit", "va", "xe")]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, share, seed):
    r = random.Random(seed)
    w = text.split(" ")
    for i in r.sample(range(len(w)), max(1, int(len(w) * share))):
        w[i] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def texts():
    """id, text, source: nulls, empties, ties, repeated rows, a very long text, families of near copies."""
    out = [(1, None, "a"), (2, "", None), (3, " \t\n ", "a"), (4, "one", "b"), (5, "one", "b"), (6, "One two three", "b"),
           (7, "one TWO three", None), (8, "é " * 5 + "ß", "c"), (9, prose(30_000, 9), "c"), (None, "no id", "a"), (None, None, None),
           (10, "repeated row", "a"), (10, "repeated row", "a"), (11, "x" * 50_000, "a"), (12, "a  b\n\n c", "b"), (13, "İstanbul   \x00 tail", "c")]
    i = 20
    for family in range(6):
        base = prose(40 + 25 * family, 100 + family)
        out.append((i, base, "abc"[family % 3]))
        for j in range(5):
            i += 1
            out.append((i, base if j == 0 else edited(base, 0.012 * j, family * 10 + j), "abc"[j % 3]))
        i += 1
    for _ in range(30):
        out.append((i, prose(60, i), "abc"[i % 3]))
        i += 1
    return out


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", s, len(t or ""), 7, 8, "x", "y", 1, 2, 3, 0.5, "s", "r", "c") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
