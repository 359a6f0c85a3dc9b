import random

import pytest

#: (doc_id, text, lang, source, extra columns with names that operators also use)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, rid string, value string"


@pytest.fixture(scope="session")
def make():
    def frame(spark, rows):
        return spark.createDataFrame([(*r, len(r[1] or ""), -1, False, "x", "y") for r in rows], SCHEMA).repartition(3)

    return frame


@pytest.fixture(scope="session")
def corpus():
    """Documents with copies, near copies, nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))

    rows = [(i, prose(rng.randint(1, 200)), rng.choice(["de", "en", None]), rng.choice(["a", "b", "c", None])) for i in range(60)]
    rows += [(100 + i, rows[3][1], "en", "hot") for i in range(40)]  # copies
    for i in range(30):  # near copies
        w = rows[5][1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w), "en", "hot"))
    rows += [(300, None, None, None), (301, "", "de", "a"), (302, " \n\t", "de", "a"), (303, "one", "en", "b"), (304, "a b c", "en", "b")]
    rows += [(305, prose(20000), "en", "b"), (306, "ß é 漢字 \U0001f600 word", "de", "a"), (307, "x " * 3000, "en", "c")]
    rows += [rows[7], rows[7], (None, "no id here", "en", "a"), (None, None, "en", "a")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus, make):
    from premia.llm.common import ship

    ship(spark)
    return make(spark, corpus)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
