import random

import pytest


@pytest.fixture(autouse=True, scope="session")
def shared_folder(spark, tmp_path_factory):
    """The folder a cluster would name."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


PROSE = "the quick brown fox jumps over a lazy dog while nine old men play chess near the river bank at dawn".split()


def prose(seed: int, words: int) -> str:
    mix = random.Random(seed)
    return " ".join(mix.choice(PROSE) for _ in range(words))


ODD_TEXTS = [
    None, "", " \n\t ", "a", "a b", prose(1, 40), prose(1, 40), prose(1, 40) + ".", "x" * 200_000, "é ß 😀 　 \x00 \x1c" * 20,
    "+1 (743) 555-3824, a@b.co, 1.2.3.4, 4111 1111 1111 1111", "9" * 5000, "1." * 3000, "@" * 300, "\n".join(["Released under the MIT Licence."] * 3),
    prose(2, 30_000), "<|endoftext|> <s> [EMAIL]", "... !!! ???",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, a repeated row, a missing id, and extra columns with names the operators use."""
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), 1, "spans", 2.0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "no id here", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, component long, spans string, score double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
