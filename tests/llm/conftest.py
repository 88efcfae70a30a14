import os
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
# Workers import the package from here, wherever pytest was started.
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[2]}:{os.environ.get('PYTHONPATH', '')}"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns with names that the operators use inside.
CLASHING = ("mark", "node", "bucket", "keys", "sig", "sketch", "line", "removed", "runs", "kind",
            "low", "block", "word", "c", "slice", "guest", "signs", "words", "hashes", "window",
            "terms", "piece", "shard", "score", "quality", "variant", "_gone", "_doc")


def sample_texts():
    """Random texts over a small vocabulary with copies, edits, repeats and awkward cases."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeilmnorstuü") for _ in range(rng.randint(2, 9)))
                  for _ in range(700)] + ["the", "of", "and", "der", "la"] * 30
    fresh = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = ["\n".join(fresh(rng.randint(3, 25)) for _ in range(rng.randint(1, 6))) for _ in range(24)]
    passage = fresh(40)
    for k in range(5):
        texts.append(f"{fresh(12)}\n{passage}\n{fresh(12)}")
        words = texts[k].split(" ")
        words[len(words) // 2] = "edited"
        texts += [texts[k], " ".join(words)]
    texts += ["", None, " ", "\n\n", "x", "Licensed under CC BY-NC 4.0.", "All rights reserved.",
              f"{fresh(6)} Released under the MIT License. {fresh(30)}",
              "a" * 400, "ab" * 300, "é" * 120, "▁ block ▁ sign  two\t tabs\x0b 😀 日本 é",
              fresh(30) + "\n" + fresh(30), fresh(6000), "the of and", "THE Of tHe " + passage.upper()]
    return texts


@pytest.fixture(scope="session")
def rows():
    return [(3 * k if k != 7 else -5, text) for k, text in enumerate(sample_texts())]


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(d, t, "en", f"s{d % 3}", len(t) if t is not None else None) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark, docs):
    """Documents with clashing columns, an id that repeats a row, and rows of nulls."""
    from pyspark.sql import functions as F

    extra = spark.createDataFrame(
        [(3, "again", None, None, None), (None, "no id at all", None, None, None),
         (None, None, None, None, None)], SCHEMA)
    same = docs.filter("doc_id = 0")
    wide = docs.filter("doc_id < 60 AND doc_id <> 3").union(same).union(extra)
    return wide.withColumns({name: F.lit(name) for name in CLASHING}).cache()
