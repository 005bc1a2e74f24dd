import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key long, size string, kept string"


def prose(rng, n):
    return " ".join(rng.choice("an be con de er fo ga hi in jo ku la").replace("a", rng.choice("aeiou")) + str(rng.randrange(400))
                    for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows, periodic text, odd spaces."""
    rng = random.Random(5)
    texts = [None, "", "   \n\t", "one two three", "One TWO three", prose(rng, 40), "x" * 500, "ab " * 300, "a b c d e " * 60,
             "Ünï çödé " * 30 + prose(rng, 60), prose(rng, 6000)]
    base, passage = prose(rng, 300), prose(rng, 60)
    texts += [base, base, base + "\n", base.replace(" ", "  ")]
    for k in range(12):  # near copies of each other, some below the limit
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = f"new{rng.randrange(99)}"
        texts.append(" ".join(w))
    texts += [prose(rng, rng.randrange(5, 120)) + "\n" + passage + "\n" + prose(rng, rng.randrange(5, 120)) for _ in range(12)]
    texts += [prose(rng, n) for n in range(1, 45)]
    line = "mail me at jo.doe+x@mail.example.org_z@b.co or +49 (30) 1234-5678 x 4111 1111 1111 1111, 10.0.0.255 300.1.1.1 "
    texts += [line, line + "1.2.3.4.5.6.7.8 4111-1111-1111-1112 @ a@b a@b.c +1 2 é" + line, "iban DE89 3704 0044 0532 0130 00 x",
              "account GB82WEST12345698765432.", "ssn 123-45-6789", "part 123-45-6789", "GB82WEST12345698765433"]
    rows = [(None if i == 20 else i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S", None]), 0, 1, 2, "x", "y")
            for i, t in enumerate(texts)]
    return rows + [rows[11], rows[11], rows[5], rows[0]]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
