import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, row string, part int, key string, th int, size string, shard_ string")

WORDS = ["alpha", "beta", "gamma", "delta", "Été", "straße", "omega", "kappa", "zeta", "theta", "iota", "mu",
         "nu", "xi", "rho", "sigma", "tau", "phi", "chi", "psi"]


def document_rows():
    """Copies, near copies, blanks, nulls, repeated rows, ties, one very long text and one hot source."""
    r = random.Random(4)

    def prose(n):
        return " ".join(r.choice(WORDS) + str(r.randint(0, 60)) for _ in range(n))
    base, passage = prose(120), prose(60)
    texts = [base, base, base.replace(" ", "  "), base + " ", None, "", "   \n\t", "one two", "One  two", "x"]
    for _ in range(12):                                  # near copies of one text, at several rates
        w = base.split()
        for _ in range(r.randint(1, 6)):
            w[r.randrange(len(w))] = "changed" + str(r.randint(0, 99))
        texts.append(" ".join(w))
    texts += [prose(30) + " " + passage + " " + prose(30) for _ in range(8)]
    texts += [prose(r.randint(1, 90)) for _ in range(20)]
    texts += [prose(4000), "ab " * 400, "é" * 300, "z" * 500]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (3, texts[3]), (7, "another text of a repeated id"), (None, base), (None, "no id"),
             (None, None)]
    return [(i, t, "en", None if k % 11 == 5 else ("hot" if k % 3 else f"s{k % 7}"), None if t is None else len(t),
             "i", "r", k, "k", 1, "s", "h") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
