import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rnd, n, letters="abcdefgh"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Odd texts beside ordinary, copied, nearly copied and overlapping ones."""
    rnd = random.Random(5)
    texts = [None, "", " \n\t ", "one", "One two\x0bthree", "é ü ß", "x " * 3000, sentence(rnd, 9000)]
    base = [sentence(rnd, rnd.randint(15, 120)) for _ in range(25)]
    passage = sentence(rnd, 60)
    for i in range(110):
        words = base[i % 25].split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(["zz", "YY", "xx"])
        if i % 7 == 0:
            words[5:5] = passage.split()
        texts.append(" ".join(words) if i % 3 else "\n".join([" ".join(words[:9]), " ".join(words[9:])]))
    texts += [base[0]] * 30 + [base[1].upper()] * 3
    return [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture()
def documents(spark, corpus):
    return spark.createDataFrame(corpus, DOCUMENTS).repartition(5)
