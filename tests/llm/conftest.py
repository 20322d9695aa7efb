import random

import pytest

@pytest.fixture(autouse=True)
def importable(spark):
    from stormmart.llm.common import workers_can_import

    workers_can_import(spark)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(7)
    return ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 4)))
            for _ in range(300)]


@pytest.fixture(scope="session")
def corpus(words):
    """Texts with exact copies, near copies, shared passages, repeats, odd cases."""
    rng = random.Random(11)

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = text(40)
    rows = [(i, text(rng.choice([1, 2, 4, 9, 30, 120, 400]))) for i in range(40)]
    base = text(150)
    for i in range(40, 60):  # near copies of one text, each with a few changes
        w = base.split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(60 + i, text(20) + "\n" + passage + "\n" + text(10)) for i in range(8)]
    rows += [(70, passage + " " + passage), (71, "ab" * 400), (72, None), (73, ""), (74, " \t\n"),
             (75, "É ñ ü ß 漢字 😀 " * 30), (76, "..., !!! 123"), (77, rows[3][1]), (78, text(9000)),
             (79, base.upper())]
    return rows
