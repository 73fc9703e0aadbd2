import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from ``(id, text)`` pairs."""

    def build(*rows, partitions=3):
        full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return build


@pytest.fixture
def clashing(documents):
    """The same with more columns, called as the operators call their own."""

    def build(*rows):
        from pyspark.sql import functions as F

        names = "digest kept score n_words failed_rules bucket key label row text_digest component_id n"
        return documents(*rows).withColumns({n: F.lit(f"own {n}") for n in names.split()})

    return build


@pytest.fixture
def letters():
    """Random texts of few different words."""

    def build(seed, n, words=(0, 40), alphabet="ab c\n\tÉé日!."):
        rnd = random.Random(seed)
        return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(*words))) for _ in range(n)]

    return build
