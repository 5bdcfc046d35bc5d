import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, id int"


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, personal data, blanks, nulls, repeated rows, a long text, and
    columns whose names clash with those that operators use inside."""
    random.seed(4)
    words = ["".join(random.choices("abcdefgh", k=random.randint(2, 6))) for _ in range(300)]
    texts = [" ".join(random.choices(words, k=random.randint(20, 90))) + ".\n" for _ in range(30)]
    near = texts[0].split()
    for i in range(6):
        changed = list(near)
        changed[i * 3] = f"edit{i}"
        texts.append(" ".join(changed))
    texts += [texts[1], texts[1].upper(), texts[2]]
    texts += ["mail me: a.b@c-d.example.org or call +1 (555) 123-4567 now", "card 4111 1111 1111 1111, ip 10.0.0.255 and 1.2.3.456"]
    texts += ["", " \t\n", None, "one two", "ONE two", " ".join(words * 30)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "r", 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def nothing(docs):
    return docs.limit(0)
