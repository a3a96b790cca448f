import hashlib
import random
import re

import pytest


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text, ...) as a frame in three partitions."""
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


@pytest.fixture
def rng():
    return random.Random(11)


#: texts that every operator must take: null, empty, blank, one letter, no letter, beyond ASCII, one endless word, very long
ODD = [None, "", " \n\t ", "a", "12 ## --", "ñandú éè 你好 🙂 straße", "x" * 5000, "word " * 30000, "\x00\x01 a\x7fb"]
