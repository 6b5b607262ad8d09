import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with nulls in any column, empty and long texts, ties and repeats, and extra
    columns named like the operators' own."""

    def make(rows, extra=True):
        full = [(d, t, g, s, None if t is None else len(t)) for d, t, g, s in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            from pyspark.sql import functions as F

            for c in ("size", "key", "bucket", "fp", "node", "root", "words", "score", "kept", "item_id", "row", "target", "hash", "uid", "toxic", "quality"):
                df = df.withColumn(c, F.lit("clash"))
        return df

    return make


def prose(rng: random.Random, n: int, letters: str = "abcdefghilmnoprstu") -> str:
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    rng = random.Random(5)
    rows = [(k, prose(rng, rng.randint(1, 60)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "ç", None])) for k in range(60)]
    base = prose(rng, 80)
    rows += [(100 + k, base, "en", "hot") for k in range(40)]
    rows += [(200 + k, base.replace(base.split()[k + 3], "changed", 1), "en", "hot") for k in range(10)]
    rows += [(300, None, None, None), (301, "", "en", "a"), (302, " \t\n", "en", "a"), (None, "no id at all", "en", "b"), (None, None, None, None)]
    rows += [(303, prose(rng, 30_000), "en", "b"), (304, "x" * 200_000, "en", "b"), (305, "ünï ćodé 漢字 \U0001f600 text", "en", "a")]
    rows += [rows[0], rows[0]]
    return rows
