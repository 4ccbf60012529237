"""Small tables for the operators' tests."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so", "vi", "ne") for b in ("n", "rd", "st", "m", "le", "ck")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, extra=False):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts)]
        df = spark.createDataFrame(rows, DOCS)
        if extra:  # columns that an operator also makes
            for c in ("score", "key", "norm", "fp", "cell", "grp", "length", "kept", "y", "__kept", "__grp", "__cell", "row_a", "row_b", "row",
                      "group_of", "a", "one", "root", "id", "c0"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, repeats, many scripts, one very long text."""
    rng = random.Random(4)
    base = prose(rng, 120)
    long = prose(rng, 20_000)
    return [None, "", "   \n\t", base, base, base.upper(), base[:300] + " changed " + base[300:], long, "日本語 のテキスト、です。", "a▁b  c",
            "x" * 5000, "ab " * 400, prose(rng, 80) + " " + base[100:400], "é" * 70 + base[50:200], "  nbsp 's it's", None, "", long[:9000]]
