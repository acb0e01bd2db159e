import time

import pytest

from onsetlake.llm import registry, secrets

RULE = next(r for r in secrets.RULES if r.kind == "address")


@pytest.mark.parametrize("user,word", [(4, 3), (4, 65), (65, 12), (300, 5_000)])
def test_long_users_and_passwords(user, word):
    text = f"see postgres://{'u' * user}:{'p' * word}@db.host now"
    assert [text[a:b] for a, b in secrets.spans(text, RULE)] == [text[4:-4]]


def test_documents(spark):
    text = "x postgres://user:" + "k9" * 40 + "@db.host y"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert registry.secret_digest(docs).first().spans == f"address:2:{len(text) - 2}"


@pytest.mark.parametrize("text", ["ab://" * 40_000, "ab://u:" * 30_000, "ab://" + "u" * 200_000, "a" * 200_000,
                                  "ab://u:" + "p" * 200_000, "ab://x" * 30_000 + ":ppp"])
def test_long_texts_take_no_square_time(text):
    start = time.process_time()
    assert secrets.spans(text, RULE) == []
    assert time.process_time() - start < 5
