"""Small tables with nulls, empty and long texts, ties, copies and clashing columns."""

import random
import re

SEP = re.compile("[^\x20\x09-\x0D]+")


def vocabulary(seed, n=300):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgéß") for _ in range(r.randint(2, 9))) for _ in range(n)]


def texts(seed=1, n=60):
    """Documents: (doc_id, text) with planted copies, near copies and shared passages."""
    r, v = random.Random(seed), vocabulary(seed)
    passage = " ".join(r.choice(v) for _ in range(60))
    out = []
    for i in range(n):
        words = [r.choice(v) for _ in range(r.randint(1, 160))]
        if i % 5 == 0:
            words[r.randint(0, len(words)):0] = passage.split()
        t = " ".join(words)
        if i % 7 == 3:
            t = out[i // 2][1] or ""
        elif i % 7 == 5:
            w = (out[i // 2][1] or "").split(" ")
            if len(w) > 3:
                w[r.randrange(len(w))] = "changed"
            t = " ".join(w)
        if i % 3 == 0:
            t = t.replace(" ", "\n", 2).replace(" ", "\t\xa0", 1)
        out.append((i, t))
    out += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, out[4][1]), (n + 3, out[4][1]),
            (n + 4, "long " + " ".join(r.choice(v) for _ in range(5000))), (n + 5, "aaaa " * 400),
            (n + 6, "x" * 3000), (n + 7, "x" * 1000), (None, out[6][1])]
    return out


def frame(spark, rows, clash=()):
    """documents with columns whose names clash with those the operators use."""
    cols = "doc_id long, text string, lang string, source string, n_chars long, block long, id string, kept string"
    return spark.createDataFrame(
        [(i, t, "en" if (i or 0) % 2 else None, f"s{(i or 0) % 3}", len(t) if t else None, 7, "x", "y") for i, t in rows], cols)
