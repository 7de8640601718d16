import random

import pytest

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


def prose(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "zeta", "eta",
             "theta", "iota", "rho", "tau", "phi", "chi", "psi", "mu", "nu", "xi"]
    out = []
    while len(out) < n:
        k = min(rng.randint(4, 9), n - len(out))
        s = [rng.choice(words) + rng.choice(["", "", "a", "en", "is"]) for _ in range(k)]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."] if k > 1 else [s[0] + "."]
    return " ".join(out)


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, nulls, blanks, ties, one very long
    text, repeated rows and an extra column whose name clashes with outputs."""
    rng = random.Random(5)
    out, passage = [], prose(rng, 60)
    for i in range(60):
        text = prose(rng, rng.randint(20, 200))
        if i % 6 == 0:
            text += "\n" + passage
        out.append((i, text, "en" if i % 3 else "de", f"s{i % 4}"))
    base = out[7][1]
    for i in range(60, 80):      # exact copies
        out.append((i, base, "en", "s0"))
    for i in range(80, 100):     # near copies
        w = out[9][1].split()
        w[rng.randrange(len(w))] = f"new{i}"
        out.append((i, " ".join(w), "en", "s1"))
    out += [(100, None, "en", "s1"), (101, "", None, None), (102, " \n\t ", "en", None),
            (103, "one two", "en", "s2"), (104, "One  Two", "en", "s2"), (105, "one two three", None, "s3"),
            (None, prose(rng, 80), "en", "s2"), (106, prose(rng, 30_000), "fr", "s3"),
            (107, "Żółć ÉCOLE straße 東京 " * 20, "xx", "s3"),
            (108, "x" * 50_000, "en", "s2"), (109, "dup line here\n" * 40, "en", "s2")]
    out += [out[3], out[3], out[66]]  # repeated rows
    return [(i, t, la, s, len(t or ""), "clash") for i, t, la, s in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, EDGE_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
